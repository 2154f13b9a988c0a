"""Registered queries: sources/sinks (§2.1) and streaming (§2.9, §2.10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.rowwise import rnd
from ..operators import validate as V
from ..schema import LABEL, processed_schema, request_schema
from ..session import scratch_path
from ..sources import files as FS
from ..sources.tables import read_table
from ..streaming import drift_stream as DS
from ..streaming import score_stream as SS
from . import base as B
from .catalog import register
from .oracle_base import with_base
from .q_ml import score_rules
from .q_validate import round_rows, suite_sql

RAW_COLS = ["ID", "LIMIT_BAL", "SEX", "EDUCATION", "MARRIAGE", "AGE", "PAY_0", "PAY_2", "PAY_3", "PAY_4",
            "PAY_5", "PAY_6", *[f"BILL_AMT{i}" for i in range(1, 7)], *[f"PAY_AMT{i}" for i in range(1, 7)], LABEL]


# --- §2.1 sources and sinks -----------------------------------------------------
@register("read_csv_table", with_base() + f"SELECT {', '.join(RAW_COLS)} FROM credit")
def q_read_csv_table(spark, sf_dir):
    path = scratch_path(spark, "csv")
    FS.write_table(B.credit(spark, sf_dir).select(*RAW_COLS), path, fmt="csv")
    return FS.read_csv_table(spark, path, processed_schema(with_id=True))


@register("write_table", with_base() + f"SELECT {', '.join(RAW_COLS)}, is_test FROM credit")
def q_write_table(spark, sf_dir):
    path = scratch_path(spark, "parquet")
    FS.write_table(B.credit(spark, sf_dir), path, fmt="parquet")
    return spark.read.parquet(path)


_REQ = [f.name for f in request_schema().fields]


@register("read_json_records", with_base() + f"SELECT {', '.join(_REQ)}, CAST(NULL AS VARCHAR) AS _corrupt_record FROM credit")
def q_read_json_records(spark, sf_dir):
    path = scratch_path(spark, "json")
    FS.write_table(B.credit(spark, sf_dir).select(*_REQ), path, fmt="json")
    return FS.read_json_records(spark, path, request_schema())


def _report_path(spark, sf_dir):
    path = scratch_path(spark, "report")
    res = V.validate_table(B.credit(spark, sf_dir).select(*RAW_COLS, "is_test"), V.credit_suite(RAW_COLS + ["is_test"]))
    FS.write_report_json(res, path)
    return path, res.schema


_REPORT_SQL = with_base() + suite_sql(V.credit_suite(RAW_COLS + ["is_test"]), "credit", RAW_COLS + ["is_test"])


@register("write_report_json", _REPORT_SQL)
def q_write_report_json(spark, sf_dir):
    """The validation report written as JSON records; the result is what the
    files hold, read with the report's own schema."""
    path, schema = _report_path(spark, sf_dir)
    return round_rows(FS.read_report_json(spark, path, schema))


@register("read_report_json", _REPORT_SQL)
def q_read_report_json(spark, sf_dir):
    """The same report read without a declared schema (types are inferred)."""
    path, _ = _report_path(spark, sf_dir)
    return round_rows(FS.read_report_json(spark, path).withColumn("rule_id", F.col("rule_id").cast("int")))


# --- streaming ---------------------------------------------------------------------
def _events_stream(spark, sf_dir):
    schema = read_table(spark, sf_dir, "events").schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
            .option("maxFilesPerTrigger", 1).parquet(sf_dir))


def _reference_events(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    t0 = ev.agg(F.min("ts").alias("_t0"))
    return (ev.crossJoin(F.broadcast(t0))
            .filter(F.col("ts") < F.col("_t0") + F.expr("INTERVAL 7 DAYS")).drop("_t0"))


def _round_windows(df):
    return df.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                     F.col("window_end").cast("timestamp_ntz").alias("window_end"),
                     "event_type", F.col("n").cast("bigint").alias("n"), rnd(F.col("psi")).alias("psi"))


def _bin_sql(v="value"):
    return (f"CASE WHEN len(list_filter(edges, lambda e: e <= {v})) >= 1 AND {v} <= edges[len(edges)] "
            f"AND len(edges) >= 2 THEN least(len(list_filter(edges, lambda e: e <= {v})), len(edges) - 1) - 1 "
            f"ELSE -1 END")


def _psi_sql():
    e = [f"(ref_counts[{k + 1}] + 0.0001)" for k in range(10)]
    a = [f"(c{k} + 0.0001)" for k in range(10)]
    m = [f"({k} < len(edges) - 1)" for k in range(10)]
    se = "(0.0" + "".join(f" + CASE WHEN {mm} THEN {x} ELSE 0.0 END" for mm, x in zip(m, e)) + ")"
    sa = "(0.0" + "".join(f" + CASE WHEN {mm} THEN {x} ELSE 0.0 END" for mm, x in zip(m, a)) + ")"
    terms = "".join(f" + CASE WHEN {mm} THEN ({x} / {sa} - {y} / {se}) * ln(({x} / {sa}) / ({y} / {se})) ELSE 0.0 END"
                    for mm, x, y in zip(m, a, e))
    return f"CASE WHEN edges IS NOT NULL THEN greatest(0.0{terms}, 0.0) END"


_PROBS = ", ".join(str(i / 10) for i in range(11))
DRIFT_STREAM_CTES = f"""
WITH m AS (SELECT min(ts) AS t0 FROM events),
ref AS (SELECT event_type, CAST(value AS DOUBLE) AS value FROM events, m
        WHERE ts < t0 + INTERVAL 7 DAY AND value IS NOT NULL AND NOT isnan(value)),
pe AS (SELECT event_type, list_sort(list_distinct(quantile_cont(value, [{_PROBS}]))) AS edges FROM ref GROUP BY event_type),
rb AS (SELECT ref.event_type, {_bin_sql()} AS bin FROM ref JOIN pe ON ref.event_type = pe.event_type),
rc AS (SELECT event_type, [{", ".join(f"count_if(bin = {k})" for k in range(10))}] AS ref_counts FROM rb GROUP BY event_type),
prof AS (SELECT pe.event_type, edges, ref_counts FROM pe JOIN rc ON pe.event_type = rc.event_type),
wb AS (SELECT time_bucket(INTERVAL 7 DAY, ev.ts, TIMESTAMP '1970-01-01') AS ws, ev.event_type,
              {_bin_sql('CAST(ev.value AS DOUBLE)')} AS bin
       FROM events ev LEFT JOIN prof ON ev.event_type = prof.event_type),
wc AS (SELECT ws, event_type, count(*) AS n, {", ".join(f"count_if(bin = {k}) AS c{k}" for k in range(10))}
       FROM wb GROUP BY ws, event_type),
res AS (SELECT CAST(ws AS TIMESTAMP) AS window_start, CAST(ws + INTERVAL 7 DAY AS TIMESTAMP) AS window_end,
               wc.event_type, CAST(n AS BIGINT) AS n, {B.r(_psi_sql())} AS psi
        FROM wc LEFT JOIN prof ON wc.event_type = prof.event_type)
"""


@register("drift_stream", DRIFT_STREAM_CTES + "SELECT * FROM res")
def q_drift_stream(spark, sf_dir):
    """Events streamed file by file; complete-mode windowed PSI, written by
    foreachBatch to a table in the shared folder, read back."""
    prof = DS.reference_profile(_reference_events(spark, sf_dir), "event_type", "value")
    res = DS.windowed_psi(_events_stream(spark, sf_dir), prof, "event_type", "value", "ts", "7 days", "1 day")
    out, ck = scratch_path(spark, "drift-out"), scratch_path(spark, "drift-ckpt")
    q = SS.start_complete_table(res, out, ck)
    q.awaitTermination()
    return _round_windows(spark.read.parquet(out))


@register("drift_stream_batch", DRIFT_STREAM_CTES + "SELECT * FROM res")
def q_drift_stream_batch(spark, sf_dir):
    """The batch twin of drift_stream (same function on a static table)."""
    prof = DS.reference_profile(_reference_events(spark, sf_dir), "event_type", "value")
    res = DS.windowed_psi(read_table(spark, sf_dir, "events"), prof, "event_type", "value", "ts", "7 days")
    return _round_windows(res)


_CLOSED_SQL = DRIFT_STREAM_CTES + """
SELECT * FROM res WHERE window_end <= (SELECT max(ts) - INTERVAL 1 DAY FROM events)"""


@register("drift_stream_append", _CLOSED_SQL)
def q_drift_stream_append(spark, sf_dir):
    """The windows that the watermark has closed, each committed once to the
    report table; their counts have left the state."""
    prof = DS.reference_profile(_reference_events(spark, sf_dir), "event_type", "value")
    res = DS.windowed_psi(_events_stream(spark, sf_dir), prof, "event_type", "value", "ts", "7 days", "1 day")
    table = DS.report_table(spark, scratch_path(spark, "drift-reports"))
    DS.append_windows(res, "event_type", table, scratch_path(spark, "drift-ckpt")).awaitTermination()
    return _round_windows(table.read().withColumnRenamed("group", "event_type"))


def _drift_reports(spark, sf_dir):
    """Every window's report in the append-only table, committed as one run by day."""
    prof = DS.reference_profile(_reference_events(spark, sf_dir), "event_type", "value")
    res = DS.windowed_psi(read_table(spark, sf_dir, "events"), prof, "event_type", "value", "ts")
    table = DS.report_table(spark, scratch_path(spark, "drift-reports"))
    rows = DS.as_report(_round_windows(res), "event_type").withColumn("_day", F.col("window_end").cast("date"))
    table.commit_by_day(rows, "_day", "batch")
    return table


@register("latest_drift_report", DRIFT_STREAM_CTES + """
SELECT event_type, arg_max(window_start, window_end) AS window_start, max(window_end) AS window_end,
       arg_max(n, window_end) AS n, arg_max(psi, window_end) AS psi FROM res GROUP BY event_type""")
def q_latest_drift_report(spark, sf_dir):
    return (_drift_reports(spark, sf_dir).newest("group", "window_end").withColumnRenamed("group", "event_type")
            .select("event_type", "window_start", "window_end", "n", "psi"))


@register("newest_drift_day", DRIFT_STREAM_CTES + """
SELECT event_type, window_start, window_end, n, psi FROM res WHERE window_end = (SELECT max(window_end) FROM res)""")
def q_newest_drift_day(spark, sf_dir):
    """The newest day's reports, from that day's files alone."""
    return (_drift_reports(spark, sf_dir).newest_day().withColumnRenamed("group", "event_type")
            .select("event_type", "window_start", "window_end", "n", "psi"))


@register("score_stream", with_base() + """
SELECT ID, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS prediction, p AS probability,
       CASE WHEN p < 0.1 THEN 'very low' WHEN p < 0.2 THEN 'low' WHEN p < 0.4 THEN 'medium'
            WHEN p < 0.6 THEN 'high' ELSE 'very high' END AS risk_level, 'rules' AS model_status
FROM (SELECT ID, CAST(CASE WHEN PAY_0 <= 0 AND LIMIT_BAL > 100000 THEN 0.05
                           WHEN PAY_0 <= 1 AND LIMIT_BAL > 50000 THEN 0.15
                           WHEN PAY_0 >= 2 OR LIMIT_BAL < 20000 THEN 0.75 ELSE 0.3 END AS DOUBLE) AS p FROM clean)""")
def q_score_stream(spark, sf_dir):
    """Requests (the cleaned borrower rows as JSON files) scored as a stream."""
    src = scratch_path(spark, "requests")
    B.cleaned(spark, sf_dir).select(*_REQ).write.json(src)
    out, ck = scratch_path(spark, "scores"), scratch_path(spark, "scores-ckpt")
    q = SS.score_stream(spark, src, request_schema(), score_rules, out, ck)
    q.awaitTermination()
    return spark.read.parquet(out)

