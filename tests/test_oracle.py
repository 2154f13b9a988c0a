"""Every registered query with an oracle statement equals DuckDB on the
same tables (sf0.001): row count, column names and exact values; the
others run and return rows."""
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

from oracle_check import check, duck_con  # noqa: E402
from riskloom.plans.catalog import load_all  # noqa: E402

SF = "/root/testdata/sf0.001"
CAT = load_all()
NAMES = list(CAT)


@pytest.fixture(scope="module")
def con():
    return duck_con(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    status, info, _ = check(spark, con, name, CAT[name], SF)
    assert status in ("OK", "rows-only"), f"{name}: {status} {info}"
    if status == "rows-only":
        assert info > 0
