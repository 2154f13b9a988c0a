"""Streaming: windows do not depend on the session time zone, and the
stream's result equals its batch twin."""
from riskloom.plans.catalog import load_all

SF = "/root/testdata/sf0.001"


def test_windows_independent_of_session_zone(spark):
    cat = load_all()
    out = {}
    try:
        for tz in ["UTC", "Asia/Kolkata", "America/Los_Angeles"]:
            spark.conf.set("spark.sql.session.timeZone", tz)
            out[tz] = sorted(tuple(r) for r in cat["drift_stream_batch"].fn(spark, SF).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert out["UTC"] == out["Asia/Kolkata"] == out["America/Los_Angeles"]


def test_stream_equals_batch_twin(spark):
    cat = load_all()
    a = sorted(tuple(r) for r in cat["drift_stream"].fn(spark, SF).collect())
    b = sorted(tuple(r) for r in cat["drift_stream_batch"].fn(spark, SF).collect())
    assert a == b and len(a) > 0


def test_group_unseen_in_the_reference_is_reported(spark):
    from riskloom.streaming.drift_stream import reference_profile, windowed_psi
    ref = spark.createDataFrame([("a", float(i), "2024-01-01 00:00:00") for i in range(40)], "g string, v double, ts string")
    now = spark.createDataFrame([("a", 3.0, "2024-02-01 00:00:00"), ("new", 1.0, "2024-02-01 00:00:00"),
                                 (None, 1.0, "2024-02-01 00:00:00")], "g string, v double, ts string")
    out = windowed_psi(now.selectExpr("g", "v", "cast(ts as timestamp_ntz) ts"), reference_profile(ref, "g", "v"), "g", "v", "ts")
    got = {r["g"]: (r["n"], r["psi"]) for r in out.collect()}
    assert got["new"] == (1, None) and got[None] == (1, None)
    assert got["a"][0] == 1 and got["a"][1] > 0
