"""The append-only report table, and the drift stream that writes to it."""
from datetime import date, datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.operators.reports import ReportTable
from riskloom.session import scratch_path
from riskloom.streaming import drift_stream as DS

SCHEMA = T.StructType([T.StructField("name", T.StringType()), T.StructField("auc", T.DoubleType())])


def test_runs_are_committed_once_and_days_are_pruned(spark):
    table = ReportTable(spark, scratch_path(spark, "log"), SCHEMA)
    assert table.read().count() == 0 and table.newest_day().count() == 0
    rows = spark.createDataFrame([("a", 0.5), ("b", 0.6)], SCHEMA)
    assert table.commit(rows, date(2024, 1, 1), "r1") and table.commit(rows.limit(1), "2024-01-02", "r2")
    assert not table.commit(rows, "2024-01-01", "r1")                 # a repeated run adds nothing
    assert table.days() == ["2024-01-01", "2024-01-02"] and table.runs("2024-01-01") == ["r1"]
    assert table.read().count() == 3 and table.newest_day().count() == 1
    plan = table.newest_day()._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert {r["name"]: r["run"] for r in table.newest("name", "day").collect()} == {"a": "r2", "b": "r1"}


def test_rows_are_dealt_to_their_days(spark):
    table = ReportTable(spark, scratch_path(spark, "log"), SCHEMA)
    rows = spark.createDataFrame([("a", 0.5, date(2024, 1, 1)), ("b", 0.6, date(2024, 1, 3))], "name string, auc double, d date")
    assert table.commit_by_day(rows.filter("name = 'a'"), "d", "r") == ["2024-01-01"]
    assert table.commit_by_day(rows, "d", "r") == ["2024-01-03"]      # the ended run is completed
    assert table.commit_by_day(rows, "d", "r") == []
    assert sorted((r["name"], r["day"]) for r in table.read().collect()) == [("a", date(2024, 1, 1)), ("b", date(2024, 1, 3))]


def _day(n, hour=0):
    return datetime(2024, 1, 1 + n, hour) if n < 31 else datetime(2024, 2, n - 30, hour)


def test_append_stream_late_row_new_group_and_restart(spark):
    """Files that arrive one by one: windows are reported once closed, a late row
    is counted and left out, a group unseen in the reference is reported, and a
    restart adds only what is new."""
    src, out, ck = (scratch_path(spark, n) for n in ("src", "out", "ck"))
    schema = "g string, v double, ts timestamp"
    ref = spark.createDataFrame([("a", float(i)) for i in range(50)], "g string, v double")
    profile = DS.reference_profile(ref, "g", "v")
    table = DS.report_table(spark, out)
    seen = []

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        seen.extend(rows)

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
        q = DS.append_windows(DS.windowed_psi(stream, profile, "g", "v", "ts", "1 day", "1 hour"), "g", table, ck)
        q.awaitTermination()
        return DS.state_history(q)

    held = []
    for day in range(6):
        arrive([("a", float(day), _day(day, h)) for h in range(0, 24, 3)] + ([("new", 1.0, _day(day, 5))] if day == 2 else []))
        held += run()
    assert max(h["state_rows"] for h in held) <= 3                    # flat: one or two open windows
    arrive([("a", 9.0, _day(0, 1)), ("a", 1.0, _day(6, 2))])          # the first row's window was reported long ago
    late = sum(h["late_rows"] for h in run())
    assert late == 1
    got = {(r.window_start, r.group): (r.n, r.psi) for r in table.read().collect()}
    assert table.read().count() == len(got)                           # every window once
    fresh = [r for r in seen if r != ("a", 9.0, _day(0, 1))]
    batch = DS.windowed_psi(spark.createDataFrame(fresh, schema), profile, "g", "v", "ts", "1 day")
    closed = {(r.window_start, r.g): (r.n, r.psi) for r in batch.filter(F.col("window_end") <= F.lit(_day(6, 1)).cast("timestamp_ntz")).collect()}
    assert got == closed and (_day(2), "new") in got and got[_day(2), "new"] == (1, None)
    run()
    assert table.read().count() == len(got)                           # a restart without news adds nothing
