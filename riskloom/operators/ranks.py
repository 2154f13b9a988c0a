"""Exact cumulative counts, mid-ranks and quantiles without a global sort.

A ``Window.orderBy(value)`` without a partition key puts every row on one
task. Cumulative counts go another way:

1. ``groupBy(keys, value)`` → one row per distinct value with its counts
   (partial aggregation first, so a value held by a third of all rows costs
   one row per map task);
2. as many buckets per key as keep a running-sum window at ``WINDOW_ROWS``
   distinct values: one for small tables, else approximate quantiles of the
   distinct values give the edges (only for balance: the result is exact
   whatever the edges);
3. per-bucket totals → prefix offsets (#keys × #buckets rows);
4. a running sum inside ``Window.partitionBy(keys, bucket).orderBy(value)``
   plus the bucket's offset gives the exact inclusive cumulative count.

Quantiles need the ranks around a few targets only. A mergeable quantile sketch
brackets each target; one pass counts the rows between the brackets and the
values inside them, so about 4 / accuracy of the rows are shuffled per target,
and the exact order statistics are read off inside.

The small tables (edges, offsets) are broadcast only when their structural row
bound is below ``BROADCAST_ROWS``, else they are shuffle-joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

BROADCAST_ROWS = 2_000_000
BUCKETS_CONF = "spark.riskloom.kernel.buckets"
#: Distinct values that one running-sum window should hold.
WINDOW_ROWS = 200_000
MAX_BUCKETS = 4096
#: Sketch accuracy of the brackets, and rows of a key up to which all values are taken.
ACCURACY = 10_000
WHOLE_ROWS = 4 * ACCURACY


def kernel_buckets(counts: DataFrame, keys: list[str], buckets: int | None = None) -> int:
    """Buckets per key: explicit argument, else the session setting
    ``spark.riskloom.kernel.buckets``, else what the largest key of ``counts``
    (a written table of distinct values) needs at ``WINDOW_ROWS`` each."""
    if buckets:
        return int(buckets)
    fixed = counts.sparkSession.conf.get(BUCKETS_CONF, None)
    if fixed:
        return int(fixed)
    per = counts.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    most = per.agg(F.max("n")).collect()[0][0] or 0
    return max(1, min(MAX_BUCKETS, -(-most // WINDOW_ROWS)))


def bounded_broadcast(df: DataFrame, max_rows_bound: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only when the table's row count is bounded (by
    construction, e.g. #features × #buckets) below ``limit``; otherwise leave
    the join to Catalyst/AQE (sort-merge or shuffled hash)."""
    return F.broadcast(df) if max_rows_bound <= limit else df


def count_le(edges: str, v: Column, n: int | None = None) -> Column:
    """#(edges[k] <= v) for an array of edges. With ``n``, its maximum length
    if at most 24, a sum of comparisons that stays in generated code."""
    if n and n <= 24:
        hits = [F.coalesce((F.get(edges, F.lit(k)) <= v).cast("int"), F.lit(0)) for k in range(n)]
        return F.when(v.isNotNull(), sum(hits[1:], hits[0])).otherwise(F.lit(0))
    return F.size(F.filter(edges, lambda e: e <= v))


def value_counts(df: DataFrame, keys: list[str], value: str = "value", side: str | None = None,
                 sides=(0, 1), weight: str | None = None) -> DataFrame:
    """(keys..., value, n[, n_<s> per side]) — one row per distinct value.
    NULL values are dropped."""
    w = F.col(weight) if weight else F.lit(1)
    aggs = [F.sum(w).cast("bigint" if weight is None else "double").alias("n")]
    if side is not None:
        for s in sides:
            aggs.append(F.sum(F.when(F.col(side) == F.lit(s), w).otherwise(F.lit(0)))
                        .cast("bigint" if weight is None else "double").alias(f"n_{s}"))
    return (df.filter(F.col(value).isNotNull())
            .groupBy(*keys, value).agg(*aggs))


def cumulative_counts(counts: DataFrame, keys: list[str], weights: list[str], value: str = "value",
                      buckets: int | None = None, n_keys_bound: int = 1000,
                      descending: bool = False) -> DataFrame:
    return _cumulative(counts, keys, weights, value, buckets, n_keys_bound, descending)[0]


def _cumulative(counts: DataFrame, keys: list[str], weights: list[str], value: str = "value",
                buckets: int | None = None, n_keys_bound: int = 1000,
                descending: bool = False) -> tuple[DataFrame, DataFrame]:
    """Adds ``cum_<w>`` (inclusive running sum of w in value order) and
    ``tot_<w>`` (per-key total) for each weight column.

    ``descending=True`` accumulates from the largest value down (ROC curves).
    ``n_keys_bound`` is the caller's bound on the number of distinct keys; it
    sizes the broadcast decision for the small side tables.
    """
    keys = list(keys)
    buckets = kernel_buckets(counts, keys, buckets)
    v = F.col(value)
    ordv = -v if descending else v
    if buckets == 1:
        whole = Window.partitionBy(*keys)
        run = whole.orderBy(ordv).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        out = counts.select("*", *[F.sum(w).over(run).alias(f"cum_{w}") for w in weights],
                            *[F.sum(w).over(whole).alias(f"tot_{w}") for w in weights])
        return out, counts.groupBy(*keys).agg(*[F.sum(w).alias(f"tot_{w}") for w in weights])
    probs = [i / buckets for i in range(1, buckets)]
    small = n_keys_bound * buckets

    edges = (counts.groupBy(*keys)
             .agg(F.percentile_approx(ordv, probs, 10000).alias("_edges")))
    if not keys:
        c = counts.crossJoin(edges)   # one row of edges
    else:
        c = counts.join(bounded_broadcast(edges, n_keys_bound), keys)
    c = c.withColumn("_b", count_le("_edges", ordv)).drop("_edges")

    bt = c.groupBy(*keys, "_b").agg(*[F.sum(w).alias(f"_bt_{w}") for w in weights])
    wk = Window.partitionBy(*keys).orderBy("_b") if keys else Window.orderBy("_b")
    wk_prev = wk.rowsBetween(Window.unboundedPreceding, -1)
    wk_all = Window.partitionBy(*keys) if keys else Window.partitionBy()
    off = bt.select(*keys, "_b",
                    *[F.coalesce(F.sum(f"_bt_{w}").over(wk_prev), F.lit(0)).alias(f"_off_{w}") for w in weights],
                    *[F.sum(f"_bt_{w}").over(wk_all).alias(f"tot_{w}") for w in weights])

    c = c.join(bounded_broadcast(off, small), [*keys, "_b"])
    wv = (Window.partitionBy(*keys, "_b").orderBy(ordv)
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = c.select(*counts.columns,
                   *[(F.sum(w).over(wv) + F.col(f"_off_{w}")).alias(f"cum_{w}") for w in weights],
                   *[F.col(f"tot_{w}") for w in weights])
    totals = off.groupBy(*keys).agg(*[F.max(f"tot_{w}").alias(f"tot_{w}") for w in weights])
    return out, totals


def _brackets(base: DataFrame, keys: list[str], probs: list[float], value: str, accuracy: int,
              whole_rows: int) -> DataFrame:
    """(keys..., _los, _his): bounds around each target rank. The sketch's rank
    error is rows / accuracy, and the bounds lie twice as far out; keys of few
    rows are taken whole."""
    slack = 2.0 / accuracy
    asked = [max(0.0, p - slack) for p in probs] + [min(1.0, p + slack) for p in probs]
    k = len(probs)
    found = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), F.min(value).alias("_mn"),
                                    F.max(value).alias("_mx"), F.percentile_approx(value, asked, accuracy).alias("_a"))
    whole = F.col("_rows") <= whole_rows
    return found.select(
        *keys, F.when(whole, F.array_repeat("_mn", k)).otherwise(F.slice("_a", 1, k)).alias("_los"),
        F.when(whole, F.array_repeat("_mx", k)).otherwise(F.slice("_a", k + 1, k)).alias("_his"))


def bracket_counts(base: DataFrame, brackets: DataFrame, keys: list[str], value: str, n: int,
                   n_keys_bound: int = 1000) -> DataFrame:
    """(keys..., _seg, _out, value, n): every value inside a bracket with its
    rows, and for the rows between brackets one row per gap (value NULL). In the
    order of (_seg, _out, value) the rows are sorted by value: _seg is the number
    of lower bounds at or below a value."""
    j = base.join(bounded_broadcast(brackets, n_keys_bound), keys) if keys else base.crossJoin(F.broadcast(brackets))
    j = j.withColumn("_seg", count_le("_los", F.col(value), n))
    inside = (F.col("_seg") > 0) & (F.col(value) <= F.get("_his", F.col("_seg") - 1))
    return (j.select(*keys, "_seg", (~inside).cast("int").alias("_out"), F.when(inside, F.col(value)).alias(value))
            .groupBy(*keys, "_seg", "_out", value).agg(F.count(F.lit(1)).alias("n")))


def exact_quantiles(df: DataFrame, keys: list[str], probs: list[float], value: str = "value",
                    buckets: int | None = None, n_keys_bound: int = 1000, accuracy: int = ACCURACY,
                    whole_rows: int | None = None) -> DataFrame:
    """(keys..., q, quantile) with linear interpolation between order
    statistics: pos = (n-1)·q, lo + (hi - lo)·(pos - floor(pos)) — the same
    definition as numpy's default, Spark's ``percentile`` and DuckDB's
    ``quantile_cont``. ``buckets`` is kept for callers of the earlier form and
    not used. A key for which the sketch missed a target (its bound is checked,
    not trusted) is done again whole."""
    keys, probs = list(keys), [float(p) for p in probs]
    order = sorted(set(probs))
    base = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias(value))
    whole_rows = 4 * accuracy if whole_rows is None else whole_rows
    brackets = _brackets(base, keys, order, value, accuracy, whole_rows)
    counts = materialize(bracket_counts(base, brackets, keys, value, len(order), n_keys_bound), spread=False)
    found = materialize(_read_off(counts, keys, order, value, n_keys_bound), spread=False)
    missed = found.filter(~F.col("_ok")).select(*keys)
    if missed.isEmpty():
        out = found
    else:
        again = base.join(missed, keys, "left_semi") if keys else base
        full = _brackets(again, keys, order, value, accuracy, 1 << 62)
        rest = bracket_counts(again, full, keys, value, len(order), n_keys_bound)
        out = found.filter("_ok").unionByName(_read_off(materialize(rest), keys, order, value, n_keys_bound))
    return out.select(*keys, F.explode("_q").alias("_s")).select(*keys, "_s.q", "_s.quantile")


def _read_off(counts: DataFrame, keys: list[str], probs: list[float], value: str, n_keys_bound: int) -> DataFrame:
    """(keys..., _q array of (q, quantile), _ok) from ``bracket_counts``."""
    seg = [*keys, "_seg", "_out"]
    totals = counts.groupBy(*seg).agg(F.sum("n").alias("_t"))       # #keys × (2 · #targets + 1) rows
    by_key = Window.partitionBy(*keys)
    before = by_key.orderBy("_seg", "_out").rowsBetween(Window.unboundedPreceding, -1)
    off = totals.select(*seg, F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_off"),
                        F.sum("_t").over(by_key).alias("_n"))
    run = Window.partitionBy(*seg).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    c = counts.filter("_out = 0").join(bounded_broadcast(off, n_keys_bound * (2 * len(probs) + 1)), seg)
    c = c.withColumn("_cum", F.col("_off") + F.sum("n").over(run)).withColumn("_prev", F.col("_cum") - F.col("n"))

    def at(ix: Column) -> Column:
        return F.max(F.when((ix >= F.col("_prev")) & (ix < F.col("_cum")), F.col(value)))
    pos = [(F.col("_n") - 1).cast("double") * F.lit(p) for p in probs]
    got = c.groupBy(*keys).agg(F.max("_n").alias("_n"), *[at(F.floor(x)).alias(f"_lo{i}") for i, x in enumerate(pos)],
                               *[at(F.ceil(x)).alias(f"_hi{i}") for i, x in enumerate(pos)])
    quantiles, ok = [], F.lit(True)
    for i, x in enumerate(pos):
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        q = F.when(F.floor(x) == F.ceil(x), lo).otherwise(lo + (hi - lo) * (x - F.floor(x)))
        quantiles.append(F.struct(F.lit(probs[i]).alias("q"), q.alias("quantile")))
        ok = ok & lo.isNotNull() & hi.isNotNull()
    return got.select(*keys, F.array(*quantiles).alias("_q"), ok.alias("_ok"))


def quantile_arrays(df: DataFrame, keys: list[str], probs: list[float], value: str = "value",
                    buckets: int | None = None, n_keys_bound: int = 1000) -> DataFrame:
    """(keys..., quantiles array<double> in ``probs`` order)."""
    q = exact_quantiles(df, keys, probs, value, buckets, n_keys_bound)
    arr = F.transform(F.array_sort(F.collect_list(F.struct("q", "quantile"))), lambda s: s["quantile"])
    return q.groupBy(*keys).agg(arr.alias("quantiles"))   # one row per target


def midrank_sums(df: DataFrame, keys: list[str], side: str, value: str = "value",
                 buckets: int | None = None, n_keys_bound: int = 1000) -> DataFrame:
    """Two-sample rank statistics per key from one pass of cumulative counts:
    n0, n1, U0 (= Σ n0·(c1 − n1/2)), U1, tie term Σ(t³ − t), and the
    Kolmogorov–Smirnov distance max |C0/N0 − C1/N1|. Side values are 0/1."""
    counts = materialize(value_counts(df, keys, value, side=side), spread=False)
    cum = cumulative_counts(counts, keys, ["n_0", "n_1"], value, buckets, n_keys_bound)
    t = F.col("n_0") + F.col("n_1")
    return (cum.groupBy(*keys)
            .agg(F.max("tot_n_0").alias("n0"), F.max("tot_n_1").alias("n1"),
                 F.sum(F.col("n_0") * (F.col("cum_n_1") - F.col("n_1") / 2.0)).alias("u0"),
                 F.sum(F.col("n_1") * (F.col("cum_n_0") - F.col("n_0") / 2.0)).alias("u1"),
                 F.sum(t.cast("double") * t * t - t).alias("tie_term"),
                 F.max(F.abs(F.try_divide(F.col("cum_n_0"), F.col("tot_n_0"))
                       - F.try_divide(F.col("cum_n_1"), F.col("tot_n_1"))))
                 .alias("ks")))
