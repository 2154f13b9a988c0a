"""Row-wise rules (missing values, clip, bins, ratios) on hand-made rows."""
import math

import pytest
from pyspark.sql import functions as F

from riskloom.operators.clean import clean_codes, clean_table, drop_columns, rename_target
from riskloom.operators.features import build_features, serving_features
from riskloom.schema import CREATED_NUMERIC, PAY, BILL, PAMT


def _row(**kw):
    base = {c: None for c in ["ID", "LIMIT_BAL", "SEX", "EDUCATION", "MARRIAGE", "AGE", *PAY, *BILL, *PAMT,
                              "is_default"]}
    base.update(kw)
    return base


SCHEMA = ("ID long, LIMIT_BAL double, SEX int, EDUCATION int, MARRIAGE int, AGE int, "
          + ", ".join(f"{c} int" for c in PAY) + ", " + ", ".join(f"{c} double" for c in BILL + PAMT)
          + ", is_default int")


def _df(spark, rows):
    cols = [c.split()[0] for c in SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], SCHEMA)


def test_clean_dirty_codes(spark):
    df = spark.createDataFrame([(1, e, m) for e, m in zip([1, 2, 0, 5, 6], [1, 2, 0, 3, 1])] + [(9, None, None)],
                               "ID long, EDUCATION int, MARRIAGE int")
    out = {r.ID: (r.EDUCATION, r.MARRIAGE) for r in clean_codes(df).collect()}
    assert {e for e, _ in out.values() if e is not None} <= {1, 2, 3, 4}
    assert {m for _, m in out.values() if m is not None} <= {1, 2, 3}
    assert out[9] == (None, None)          # clip keeps NULL


def test_drop_and_rename(spark):
    df = spark.createDataFrame([(1, 10000.0, 0)], "ID long, LIMIT_BAL double, `default.payment.next.month` int")
    out = rename_target(drop_columns(df, ["ID", "missing_col"]))
    assert out.columns == ["LIMIT_BAL", "is_default"]
    assert clean_table(df).columns == ["LIMIT_BAL", "is_default"]


def test_missing_value_rules(spark):
    rows = [_row(ID=1, LIMIT_BAL=50000.0, AGE=25, EDUCATION=4, PAY_0=2, PAY_2=None, PAY_3=1,
                 BILL_AMT1=100.0, PAY_AMT1=None),
            _row(ID=2, LIMIT_BAL=0.0, AGE=0, EDUCATION=1)]
    f = {r.ID: r for r in build_features(_df(spark, rows)).collect()}
    r1, r2 = f[1], f[2]
    assert r1.PAYMENT_MEAN == pytest.approx(1.5)             # (2 + 1) / 2 present values
    assert r1.PAYMENT_MAX_DELAY == 2 and r1.PAYMENT_MIN_DELAY == 1
    assert r1.PAYMENT_STD == pytest.approx(math.sqrt(0.5))   # sample std of {2, 1}
    assert r1.PAYMENT_DELAY_COUNT == 2 and r1.PAYMENT_SEVERITY == 1
    assert r1.BILL_AMT_STD is None                           # one value → NULL
    assert r1.PAY_AMT_SUM == 0.0 and r1.PAY_AMT_MEAN is None  # all missing
    assert r1.AGE_GROUP == "18-25"                           # right-closed (0, 25]
    assert r2.AGE_GROUP is None                              # AGE 0 is outside the bins
    assert r2.PAYMENT_DELAY_COUNT == 0                       # missing compares false
    assert r2.BILL_AMT_TO_LIMIT_RATIO is None                # NULL mean, no ANSI error
    assert r2.LIMIT_BAL_PER_AGE == pytest.approx(0.0)
    risk = 2 * 0.3 + 2 * 0.2 + r1.BILL_AMT_TO_LIMIT_RATIO * 0.2 + 0.1 + 0.1 + 0.0
    assert r1.RISK_SCORE_1 == pytest.approx(risk)


def test_zero_limit_ratio(spark):
    rows = [_row(ID=1, LIMIT_BAL=0.0, AGE=30, BILL_AMT1=10.0)]
    r = build_features(_df(spark, rows)).collect()[0]
    assert r.BILL_AMT_TO_LIMIT_RATIO == pytest.approx(10.0 / 1e-6)


def test_partial_columns_need_strict_false(spark):
    df = spark.createDataFrame([(0, 0, 0, 1000.0, 1000.0, 50000.0, 25, 1, 2, 1, 0)],
                               "PAY_0 int, PAY_2 int, PAY_3 int, BILL_AMT1 double, BILL_AMT2 double, "
                               "LIMIT_BAL double, AGE int, SEX int, EDUCATION int, MARRIAGE int, is_default int")
    with pytest.raises(ValueError):
        build_features(df)
    out = build_features(df, strict=False)
    for c in ["PAYMENT_MEAN", "BILL_AMT_MEAN", "PAY_AMT_MEAN", "RISK_SCORE_1"]:
        assert c in out.columns
    assert out.count() == 1
    assert out.collect()[0].PAYMENT_MEAN == 0.0


def test_serving_subset_matches_full(spark):
    rows = [_row(ID=i, LIMIT_BAL=10000.0 * i, AGE=20 + i, EDUCATION=2, PAY_0=i % 3, PAY_2=1, BILL_AMT1=5.0 * i)
            for i in range(1, 5)]
    df = _df(spark, rows)
    full = {r.ID: r for r in build_features(df).collect()}
    for r in serving_features(df).collect():
        assert r.RISK_SCORE_1 == full[r.ID].RISK_SCORE_1
    assert len(CREATED_NUMERIC) == 22
