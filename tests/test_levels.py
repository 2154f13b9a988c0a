"""String features in the drift reports: PSI and chi-square over their levels."""
from math import log

import pytest
from pyspark.sql import functions as F

from riskloom.operators import drift as D
from riskloom.operators.reshape import long_format, long_levels


def _samples(spark):
    ref = [("18-25", 10)] * 60 + [("26-35", 20)] * 30 + [(None, 30)] * 10
    cur = [("18-25", 10)] * 20 + [("26-35", 20)] * 60 + [("55+", 30)] * 20
    rows = [(0, *r, None, "x") for r in ref] + [(1, *r, None, None) for r in cur]
    return spark.createDataFrame(rows, "side int, AGE_GROUP string, n int, empty string, one string")


def test_a_shift_of_levels_is_reported(spark):
    f = _samples(spark)
    report = D.feature_drift_report(long_format(f, ["n"], ids=["side"]),
                                    levels=long_levels(f, ["AGE_GROUP", "empty", "one"], ids=["side"]))
    got = {r.feature: r for r in report.collect()}
    s = 0.0001
    pairs = [((x + s) / (90 + 3 * s), (y + s) / (100 + 3 * s)) for x, y in ((60, 20), (30, 60), (0, 20))]
    assert got["AGE_GROUP"].psi == pytest.approx(sum((a - e) * log(a / e) for e, a in pairs))
    assert got["AGE_GROUP"].drift_detected and got["AGE_GROUP"].reference_mean is None
    assert got["AGE_GROUP"].chi2_statistic == float("inf")          # a level the reference lacks
    assert got["empty"].psi == got["one"].psi == float("inf")       # no value on a side, as for numbers
    assert got["n"].reference_mean == 15.0
    assert D.drift_summary(report).first().total_features == 4


def test_equal_levels_do_not_drift(spark):
    f = _samples(spark).filter("side = 0")
    f = f.unionByName(f.withColumn("side", F.lit(1)))
    r = D.feature_drift_report(long_format(f, ["n"], ids=["side"]),
                               levels=long_levels(f, ["AGE_GROUP"], ids=["side"])).filter("feature = 'AGE_GROUP'").first()
    assert (r.psi, r.drift_detected, r.chi2_statistic) == (0.0, False, 0.0)


def test_moments_of_every_numeric_feature(spark):
    from riskloom.plans.catalog import load_all
    from riskloom.plans.q_stats import FEAT_NUM
    rows = load_all()["sample_moments_all"].fn(spark, "/root/testdata/sf0.001").collect()
    assert {r.feature for r in rows} == set(FEAT_NUM) and len(FEAT_NUM) == 45
