"""Drift measures when a feature has values on one side only, or none."""

from riskloom.operators import drift as D
from riskloom.operators import twosample as TS


def rows(spark):
    data = [("both", s, float(v)) for s in (0, 1) for v in range(20)]
    data += [("ref", 0, float(v)) for v in range(20)] + [("ref", 1, None)]
    data += [("cur", 1, float(v)) for v in range(20)] + [("cur", 0, None)]
    data += [("none", 0, None), ("none", 1, None)]
    return spark.createDataFrame(data, "feature string, side int, value double")


def test_psi_keeps_every_feature(spark):
    lf = rows(spark)
    for method in ("smoothed", "smoothed_strict"):
        got = {r.feature: r.psi for r in D.psi(lf, method).collect()}
        assert got == {"both": got["both"], "ref": float("inf"), "cur": float("inf"), "none": float("inf")}
    got = {r.feature: r.psi for r in D.psi(lf, "floor").collect()}
    assert abs(got["both"]) < 1e-9 and (got["ref"], got["cur"], got["none"]) == (None, None, None)


def test_report_and_tests_do_not_fail(spark):
    lf = rows(spark)
    report = {r.feature: r for r in D.feature_drift_report(lf).collect()}
    assert set(report) == {"both", "ref", "cur", "none"} and report["cur"].drift_detected
    ks = {r.feature: r for r in TS.ks_two_sample(lf.filter("value is not null")).collect()}
    assert ks["both"]["statistic"] == 0.0
    chi = {r.feature: r.chi2_statistic for r in TS.chi_square_gof(lf).collect()}
    assert chi["both"] == 0.0 and chi["ref"] is None and chi["cur"] is None


def test_kl_and_key_features_keep_every_feature(spark):
    lf = rows(spark)
    assert {r.feature for r in D.kl_divergence(lf).collect()} == {"both", "ref", "cur", "none"}
    target = spark.createDataFrame([(0.1,)], "target_drift double")
    got = {r.feature: r for r in D.key_feature_drift(lf, target).collect()}
    assert set(got) == {"both", "ref", "cur", "none"}
    assert got["both"].ks == 0.0 and got["both"].ks_p_value == 1.0 and got["both"].drift_status == "low"
    assert all(got[f].psi is None and got[f].ks is None and got[f].ks_p_value is None for f in ("ref", "cur", "none"))
