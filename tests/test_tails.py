"""p-value tails against textbook critical values."""
import pytest

from riskloom.functions import tails as T


@pytest.mark.parametrize("fn,args,expected", [
    (T.norm_two_sided, (1.959963984540054,), 0.05),
    (T.t_two_sided, (2.228138851986274, 10.0), 0.05),
    (T.chi2_sf, (3.841458820694124, 1.0), 0.05),
    (T.chi2_sf, (18.307038053275146, 10.0), 0.05),
    (T.f_sf, (4.964602743730711, 1.0, 10.0), 0.05),
])
def test_critical_values(fn, args, expected):
    assert fn(*args) == pytest.approx(expected, rel=1e-7)


def test_kolmogorov_limits():
    assert T.kolmogorov_sf(0.0, 100, 100) == 1.0
    assert T.kolmogorov_sf(1.0, 100, 100) < 1e-10
    assert 0.0 < T.kolmogorov_sf(0.2, 100, 100) < 0.05


def test_significance_pvalues_consistent(spark):
    from riskloom.plans.catalog import load_all
    rows = load_all()["feature_significance_pvalues"].fn(spark, "/root/testdata/sf0.001").collect()
    assert rows
    for r in rows:
        if r.p_value is not None:
            assert 0.0 <= r.p_value <= 1.0
            assert r.significant == (r.p_value < 0.05)
