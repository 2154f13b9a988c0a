"""Profiling (§2.4): every report is one Spark query over a long
(feature, value) form, so the number of shuffles does not grow with the number
of columns. Outputs are flat tables, one row per feature (or per bin/class).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import ALLOWED_CODES
from .ranks import bounded_broadcast, count_le, exact_quantiles
from .reshape import long_format


def table_shape(df: DataFrame) -> DataFrame:
    n_cols = len(df.columns)
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", F.lit(n_cols).alias("n_columns"))


def dtype_counts(df: DataFrame) -> DataFrame:
    """Columns per data type (schema metadata only; no scan)."""
    counts: dict[str, int] = {}
    for f in df.schema.fields:
        counts[f.dataType.simpleString()] = counts.get(f.dataType.simpleString(), 0) + 1
    spark = df.sparkSession
    return spark.createDataFrame(sorted(counts.items()), "dtype string, n_columns int")


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """(value, n, percent) — percent of all rows, total joined as one row."""
    counts = df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    return (counts.crossJoin(F.broadcast(total))
            .select("value", "n", (F.col("n") * 100.0 / F.col("_total")).alias("percent")))


def imbalance_ratio(df: DataFrame, label: str) -> DataFrame:
    """min class count / max class count."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.min("n").alias("minority"), F.max("n").alias("majority"),
                      (F.min("n") / F.max("n")).alias("imbalance_ratio"))


def null_counts(df: DataFrame, cols=None) -> DataFrame:
    """(column, null_count): one aggregate over all columns, then unpivot."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], cols, "column", "null_count")


def describe_numeric(df: DataFrame, cols: list[str], buckets: int | None = None) -> DataFrame:
    """count, mean, std (n-1), min, 25/50/75 % (exact, linear), max per column."""
    lf = long_format(df, cols)
    mom = (lf.groupBy("feature")
           .agg(F.count("value").alias("count"), F.avg("value").alias("mean"),
                F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
                F.max("value").alias("max")))
    q = exact_quantiles(lf, ["feature"], [0.25, 0.5, 0.75], buckets=buckets, n_keys_bound=len(cols))
    qw = (q.groupBy("feature")
          .agg(F.max(F.when(F.col("q") == 0.25, F.col("quantile"))).alias("p25"),
               F.max(F.when(F.col("q") == 0.5, F.col("quantile"))).alias("p50"),
               F.max(F.when(F.col("q") == 0.75, F.col("quantile"))).alias("p75")))
    return (mom.join(bounded_broadcast(qw, len(cols)), "feature", "left")
            .select("feature", "count", "mean", "std", "min", "p25", "p50", "p75", "max"))


def iqr_outliers(df: DataFrame, cols: list[str], threshold_pct: float = 5.0,
                 buckets: int | None = None) -> DataFrame:
    """Share of rows outside [Q1 − 1.5·IQR, Q3 + 1.5·IQR] per column
    (percent of all rows, NULLs included in the denominator); flagged > 5 %."""
    lf = long_format(df, cols)
    q = exact_quantiles(lf, ["feature"], [0.25, 0.75], buckets=buckets, n_keys_bound=len(cols))
    bounds = (q.groupBy("feature")
              .agg(F.max(F.when(F.col("q") == 0.25, F.col("quantile"))).alias("q1"),
                   F.max(F.when(F.col("q") == 0.75, F.col("quantile"))).alias("q3"))
              .withColumn("lower", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")))
              .withColumn("upper", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))))
    out = (lf.join(bounded_broadcast(bounds, len(cols)), "feature", "left")
           .groupBy("feature")
           .agg(F.count(F.lit(1)).alias("n_rows"),
                F.count_if((F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))).alias("n_outliers"),
                F.first("q1").alias("q1"), F.first("q3").alias("q3")))
    return (out.withColumn("outlier_percent", F.col("n_outliers") * 100.0 / F.col("n_rows"))
            .withColumn("significant", F.col("outlier_percent") > F.lit(threshold_pct)))


def invalid_categories(df: DataFrame, allowed: dict[str, list[int]] = ALLOWED_CODES) -> DataFrame:
    """(column, value) for every distinct value outside the allowed set
    (NULL counts as unexpected): distinct values, then a left-anti join
    with the (tiny, fixed) allowed table."""
    cols = [c for c in allowed if c in df.columns]
    spark = df.sparkSession
    ok = spark.createDataFrame([(c, float(v)) for c in cols for v in allowed[c]],
                               "feature string, value double")
    vals = long_format(df, cols).select("feature", "value").distinct()
    return (vals.join(F.broadcast(ok), (vals.feature == ok.feature) & (vals.value == ok.value), "left_anti")
            .select(F.col("feature").alias("column"), F.col("value")))


def corr_with_target(df: DataFrame, cols: list[str], label: str) -> DataFrame:
    """Pearson r of each column with the label over pairwise-complete rows;
    a constant column gives NULL (not an error under ANSI mode)."""
    base = df.select(F.col(label).cast("double").alias("_y"), *[F.col(c) for c in cols])
    lf = long_format(base, cols, ids=["_y"])
    pair = lf.filter(F.col("value").isNotNull() & F.col("_y").isNotNull())
    agg = (pair.groupBy("feature")
           .agg(F.covar_samp("value", "_y").alias("_cov"),
                F.stddev_samp("value").alias("_sx"), F.stddev_samp("_y").alias("_sy")))
    r = F.try_divide(F.col("_cov"), F.col("_sx") * F.col("_sy"))
    return agg.select("feature", r.alias("corr"))


def topk_by_abs(df: DataFrame, col: str, k: int, name: str = "feature") -> DataFrame:
    """Top k rows by |col| (ties by name), with their rank: a TakeOrdered."""
    top = df.filter(F.col(col).isNotNull()).orderBy(F.abs(F.col(col)).desc(), F.col(name)).limit(k)
    w = Window.orderBy(F.abs(F.col(col)).desc(), F.col(name))   # k rows only
    return top.withColumn("rank", F.row_number().over(w))


def corr_bands(corr: DataFrame, top_n: int = 10, high: float = 0.1, medium: float = 0.05) -> DataFrame:
    """Within the top-n by |r|: band 'high' (> 0.1), 'medium' (0.05, 0.1], else 'low'."""
    a = F.abs(F.col("corr"))
    return (topk_by_abs(corr, "corr", top_n)
            .withColumn("band", F.when(a > high, "high").when(a > medium, "medium").otherwise("low")))


GRAM = ("n", "sx", "sy", "sxx", "syy", "sxy")


def pair_sums(df: DataFrame, cols: list[str]) -> DataFrame:
    """(feature_a, feature_b, n, sx, sy, sxx, syy, sxy) for every pair of columns
    over the rows where both have a value, about the columns' means.

    A task folds its batches into six square matrices (products of the value
    matrix and its mask) and hands on one row per pair, so no row is ever
    exploded and the shuffle holds #pairs rows per task. NaN counts as missing."""
    import numpy as np
    import pyarrow as pa
    wide = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in cols])
    mean = wide.agg(*[F.avg(c).alias(c) for c in cols]).collect()[0]    # one row
    about = np.array([[mean[c] if mean[c] is not None and abs(mean[c]) < float("inf") else 0.0 for c in cols]])

    def fold(batches):
        total = None
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns]) - about
            seen = ~np.isnan(x)
            x = np.where(seen, x, 0.0)
            m = seen.astype(np.float64)
            first, square = x.T @ m, (x * x).T @ m
            part = np.stack([m.T @ m, first, first.T, square, square.T, x.T @ x])
            total = part if total is None else total + part
        if total is not None:
            at = np.tril_indices(len(cols), -1)
            yield pa.RecordBatch.from_arrays(
                [pa.array([cols[i] for i in at[0]]), pa.array([cols[j] for j in at[1]]),
                 *[pa.array(total[k][at]) for k in range(len(GRAM))]], ["feature_a", "feature_b", *GRAM])
    rows = wide.mapInArrow(fold, "feature_a string, feature_b string, " + ", ".join(f"{g} double" for g in GRAM))
    return rows.groupBy("feature_a", "feature_b").agg(*[F.sum(g).alias(g) for g in GRAM])


def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Lower triangle (i > j) of the Pearson matrix over pairwise-complete rows.
    NULL where a column is constant there (its squares about its mean are below
    the rounding of its squares), or with fewer than two rows."""
    s = pair_sums(df, cols)
    xx, yy = (F.col(f"s{v}{v}") - F.try_divide(F.col(f"s{v}") * F.col(f"s{v}"), F.col("n")) for v in "xy")
    xy = F.col("sxy") - F.try_divide(F.col("sx") * F.col("sy"), F.col("n"))
    s = s.select("*", xx.alias("_xx"), yy.alias("_yy"), xy.alias("_xy"))
    varied = (F.col("n") > 1) & (F.col("_xx") > F.col("sxx") * 1e-12) & (F.col("_yy") > F.col("syy") * 1e-12)
    return s.select("feature_a", "feature_b",
                    F.when(varied, F.try_divide(F.col("_xy"), F.sqrt("_xx") * F.sqrt("_yy"))).alias("corr"))


def histogram(df: DataFrame, col: str, bins: int = 50, group: str | None = None) -> DataFrame:
    """Equal-width histogram over [min, max] (per group when given): bins are
    [a, b) except the last, [a, b]; every bin is returned, empty ones as 0.
    Only finite values are counted.
    Edges follow numpy: edge_i = min + i·((max − min)/bins), last = max; a
    constant column has the range from half below it to half above."""
    keys = [group] if group else []
    v = F.col(col).cast("double")
    finite = F.col("_v").isNotNull() & ~F.isnan("_v") & (F.abs("_v") < float("inf"))
    base = df.select(*keys, v.alias("_v")).filter(finite)
    rng = base.groupBy(*keys).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    half = F.when(F.col("_lo") == F.col("_hi"), F.lit(0.5)).otherwise(F.lit(0.0))
    rng = rng.select(*keys, (F.col("_lo") - half).alias("_lo"), (F.col("_hi") + half).alias("_hi"))
    step = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    edges = rng.withColumn(
        "_edges", F.transform(F.sequence(F.lit(0), F.lit(bins)),
                              lambda i: F.when(i == bins, F.col("_hi")).otherwise(i * step + F.col("_lo"))))
    eb = F.broadcast(edges) if group is None else bounded_broadcast(edges, 10_000)
    j = base.crossJoin(eb) if not keys else base.join(eb, keys)
    j = j.withColumn("_bin", F.least(count_le("_edges", F.col("_v"), bins + 1), F.lit(bins)) - 1)
    counts = j.groupBy(*keys, "_bin").agg(F.count(F.lit(1)).alias("count"))
    allbins = edges.select(*keys, F.posexplode(F.slice("_edges", 1, bins)).alias("bin", "lower"),
                           "_edges").withColumn("upper", F.element_at("_edges", F.col("bin") + 2)).drop("_edges")
    return (allbins.join(counts.withColumnRenamed("_bin", "bin"), [*keys, "bin"], "left")
            .select(*keys, "bin", "lower", "upper", F.coalesce(F.col("count"), F.lit(0)).alias("count")))


def group_means(df: DataFrame, cols: list[str], label: str) -> DataFrame:
    """(feature, class, mean): one shuffle of partial aggregates."""
    lf = long_format(df, cols, ids=[label])
    return (lf.groupBy("feature", label).agg(F.avg("value").alias("mean"))
            .withColumnRenamed(label, "class"))


def distinct_profile(df: DataFrame, cols=None, max_levels: int = 20) -> DataFrame:
    """(column, n_distinct, is_categorical): categorical when the column is a
    string or has fewer than 20 distinct non-null values. Exact distinct
    counts from (column, value) groups — no group ever holds a column."""
    cols = list(cols or df.columns)
    strings = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    base = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])).alias("s")
    ).select("s.*").filter(F.col("value").isNotNull())
    nd = base.distinct().groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))
    spark = df.sparkSession
    allc = spark.createDataFrame([(c, c in strings) for c in cols], "column string, is_string boolean")
    return (allc.join(nd, "column", "left")
            .select("column", F.coalesce(F.col("n_distinct"), F.lit(0)).alias("n_distinct"),
                    (F.col("is_string") | (F.coalesce(F.col("n_distinct"), F.lit(0)) < max_levels))
                    .alias("is_categorical")))


def distinct_flags(df: DataFrame, cols=None, max_levels: int = 20, margin: int = 8) -> DataFrame:
    """(column, n_distinct, is_categorical), the count given for categorical
    columns only. One aggregate of mergeable distinct-count sketches sets the
    columns apart that have far more than ``max_levels`` values (``margin`` times;
    the sketch's error is a few percent); only the others' values are grouped and
    counted exactly, so an id column is never shuffled. Strings are categorical
    whatever their count and are counted if they are near the limit, else by the
    sketch's verdict."""
    cols = list(cols or df.columns)
    strings = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    rough = df.agg(*[F.approx_count_distinct(c, 0.05).alias(c) for c in cols]).collect()[0]   # one row
    near = [c for c in cols if rough[c] <= margin * max_levels]
    spark = df.sparkSession
    names = spark.createDataFrame([(c, c in strings, c in near) for c in cols],
                                  "column string, is_string boolean, _near boolean")
    if near:
        vals = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                                             for c in near])).alias("s")).select("s.*")
        found = (vals.filter(F.col("value").isNotNull()).distinct()
                 .groupBy("column").agg(F.count(F.lit(1)).alias("_n")))
    else:
        found = spark.createDataFrame([], "column string, _n long")
    few = F.col("_near") & (F.coalesce("_n", F.lit(0)) < max_levels)
    return (names.join(found, "column", "left")
            .select("column", F.when(few, F.coalesce("_n", F.lit(0))).alias("n_distinct"),
                    (F.col("is_string") | few).alias("is_categorical")))


def sample_moments(lf_sides: DataFrame, side: str = "side") -> DataFrame:
    """(feature, side, n, mean, std) from a long table with a side column."""
    return (lf_sides.filter(F.col("value").isNotNull())
            .groupBy("feature", side)
            .agg(F.count("value").alias("n"), F.avg("value").alias("mean"),
                 F.stddev_samp("value").alias("std")))


def table_summary(df: DataFrame, label: str) -> DataFrame:
    n_cols = len(df.columns)
    return df.agg(F.count(F.lit(1)).alias("n_records"), F.avg(F.col(label)).alias("label_rate"),
                  F.lit(n_cols).alias("n_columns"))
