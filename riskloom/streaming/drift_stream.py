"""Windowed drift of a live stream against fixed reference edges.

Reference edges and bin shares come from a batch over the reference period
(exact deciles, per group). The stream is then ONE stateful aggregation —
per (tumbling window, group): total and count per bin — and PSI is a
projection of those counts, so no second aggregation chains state. The same
function runs on a static DataFrame (the batch twin).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.drift import MAX_FEATURES, small_table
from ..operators.ranks import bounded_broadcast, count_le, quantile_arrays
from ..operators.reports import ReportTable
from ..schema import PSI_SMOOTH

N_BINS = 10


def reference_profile(ref: DataFrame, group: str, value: str, buckets: int = N_BINS) -> DataFrame:
    """(group, edges, ref_counts array) from the reference rows (batch)."""
    lf = ref.select(F.col(group).alias("feature"), F.col(value).cast("double").alias("value")) \
        .filter(F.col("value").isNotNull() & ~F.isnan("value"))
    q = quantile_arrays(lf, ["feature"], [i / buckets for i in range(buckets + 1)], n_keys_bound=MAX_FEATURES)
    edges = q.select(F.col("feature").alias(group), F.array_distinct("quantiles").alias("edges"))
    b = lf.withColumnRenamed("feature", group).join(bounded_broadcast(edges, MAX_FEATURES), group)
    b = b.withColumn("_bin", _bin_expr())
    counts = b.groupBy(group).agg(*[F.count_if(F.col("_bin") == k).alias(f"_r{k}") for k in range(buckets)])
    return small_table(edges.join(counts, group).select(
        group, "edges", F.array(*[F.col(f"_r{k}") for k in range(buckets)]).alias("ref_counts")))


def _bin_expr(value: str = "value") -> F.Column:
    nb = F.size("edges") - 1
    k = count_le("edges", F.col(value), N_BINS + 1)
    inside = (k >= 1) & (F.col(value) <= F.element_at("edges", -1)) & (nb >= 1)
    return F.when(inside, F.least(k, nb) - 1).otherwise(F.lit(-1))


def windowed_psi(events: DataFrame, profile: DataFrame, group: str, value: str, ts: str,
                 window: str = "7 days", watermark: str | None = "1 day", buckets: int = N_BINS) -> DataFrame:
    """(window_start, window_end, group, n, psi) — smoothed PSI of each
    window's values against the reference shares; a group that the reference
    doesn't hold is reported with a NULL psi. Works on streaming and static
    DataFrames alike."""
    ev = events.select(utc_instant(events, ts).alias("_ts"), F.col(group),
                       F.col(value).cast("double").alias("value"))
    if watermark and events.isStreaming:
        ev = ev.withWatermark("_ts", watermark)
    side = bounded_broadcast(profile, profile.count())   # the written profile's own row count
    j = ev.join(side, group, "left").withColumn("_bin", _bin_expr())
    agg = (j.groupBy(F.window("_ts", window).alias("w"), group)
           .agg(F.count(F.lit(1)).alias("n"),
                *[F.count_if(F.col("_bin") == k).alias(f"_c{k}") for k in range(buckets)])
           .join(side, group, "left"))     # counts alone are kept as state
    # shares, totals and the PSI sum as three projections: each expression is
    # referenced by name, so no method inlines the totals into every term
    nb = F.size("edges") - 1
    in_bins = [F.lit(k) < nb for k in range(buckets)]
    agg = agg.select("w", group, "n", *[
        F.when(m, F.element_at("ref_counts", k + 1) + F.lit(PSI_SMOOTH)).otherwise(F.lit(0.0)).alias(f"_e{k}")
        for k, m in enumerate(in_bins)], *[
        F.when(m, F.col(f"_c{k}") + F.lit(PSI_SMOOTH)).otherwise(F.lit(0.0)).alias(f"_a{k}")
        for k, m in enumerate(in_bins)], nb.alias("_nb"), F.col("edges").isNotNull().alias("_known"))
    agg = agg.select("*", sum((F.col(f"_e{k}") for k in range(buckets)), F.lit(0.0)).alias("_se"),
                     sum((F.col(f"_a{k}") for k in range(buckets)), F.lit(0.0)).alias("_sa"))
    terms = [F.when(F.lit(k) < F.col("_nb"),
                    (F.col(f"_a{k}") / F.col("_sa") - F.col(f"_e{k}") / F.col("_se"))
                    * F.log((F.col(f"_a{k}") / F.col("_sa")) / (F.col(f"_e{k}") / F.col("_se"))))
             .otherwise(F.lit(0.0)) for k in range(buckets)]
    psi = F.when(F.col("_known"), F.greatest(sum(terms, F.lit(0.0)), F.lit(0.0)))
    return agg.select(utc_wall(F.col("w.start")).alias("window_start"), utc_wall(F.col("w.end")).alias("window_end"),
                      group, "n", psi.alias("psi"))


def utc_instant(df: DataFrame, ts: str) -> F.Column:
    """Event time as an instant. A zone-less (TIMESTAMP_NTZ) column is read as
    UTC wall-clock whatever the session zone, so windows align the same way
    in every session (watermarks need an instant)."""
    c = F.col(ts)
    if dict(df.dtypes)[ts] == "timestamp_ntz":
        return F.convert_timezone(F.lit("UTC"), F.current_timezone(), c).cast("timestamp")
    return c.cast("timestamp")


def utc_wall(instant: F.Column) -> F.Column:
    """Instant → zone-less UTC wall-clock (the inverse of ``utc_instant``)."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))


REPORT = T.StructType([T.StructField("window_start", T.TimestampNTZType()), T.StructField("window_end", T.TimestampNTZType()),
                       T.StructField("group", T.StringType()), T.StructField("n", T.LongType()),
                       T.StructField("psi", T.DoubleType())])


def report_table(spark: SparkSession, path: str) -> ReportTable:
    """The append-only table of window reports, by day of the window's end."""
    return ReportTable(spark, path, REPORT)


def as_report(windows: DataFrame, group: str) -> DataFrame:
    return windows.select("window_start", "window_end", F.col(group).alias("group"), "n", "psi")


def append_windows(windows: DataFrame, group: str, table: ReportTable, checkpoint: str, available_now: bool = True):
    """Start the drift stream in append mode: a window is reported once, when
    the watermark has passed its end, and its counts leave the state. Each
    micro-batch is one committed run, so readers never meet a half-written
    batch and one repeated after a failure adds nothing."""
    def write(batch: DataFrame, epoch: int) -> None:
        rows = as_report(batch, group)
        table.commit_by_day(rows.withColumn("_day", F.col("window_end").cast("date")), "_day", f"batch-{epoch}")
    w = windows.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")).start()


def state_history(query) -> list[dict]:
    """Per micro-batch: rows held as state, and late rows dropped by the watermark."""
    out = []
    for p in query.recentProgress:
        ops = p["stateOperators"]
        out.append({"batch": p["batchId"], "state_rows": sum(o["numRowsTotal"] for o in ops),
                    "late_rows": sum(o["numRowsDroppedByWatermark"] for o in ops)})
    return out


def latest_report(reports: DataFrame, group: str, ts: str = "window_end") -> DataFrame:
    """Newest report row per group from an append-only report table."""
    cols = [c for c in reports.columns if c != group]
    return (reports.groupBy(group).agg(F.max_by(F.struct(*cols), F.col(ts)).alias("r"))
            .select(group, "r.*"))
