"""Mixing sources to target weights by Pareto order sampling.

Sources share 100 % of all words by their weights; a source gives at most
``MOST`` times its words, and what it can't give goes to the others by weight.
Inside a source a document's expected copies grow with the bits of its size
(log2), up to ``MOST``, so that the source's expected words are its target.
The whole part is certain copies. The fraction p is an inclusion probability:
documents are ranked by the odds of a uniform hash divided by the odds of p,
and taken in this order until the next one would pass the source's target;
the room that is left goes, in ``PASSES`` - 1 further passes, to the next
ranked documents that fit it. So no source passes its target, and what is
missing is less than a small document.

Only DataFrame operations. No source is sorted whole: rank keys are counted in
``BINS`` bins a source, a running sum over the bins finds the one that holds
the cut, and only that bin's documents are ranked one by one.

A null or empty text has size 0, is ranked last and adds no words. A null
source is a source of its own, last in order. Rows that repeat an id are drawn
with the same random number; rows equal in id and size are taken or left
together. An empty table gives an empty result. Helper
columns start with ``_mix``; an input column named like an output column is
replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, written

WEIGHTS, MOST, BINS, PASSES = (5, 2, 1), 3, 4096, 4


def sized(docs: DataFrame) -> DataFrame:
    """``docs`` with ``size``: the number of words."""
    return docs.withColumn("size", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"))


def _bits(size: Column) -> Column:
    """Binary digits of the size; 0 for an empty text."""
    return F.when(size > 0, F.length(F.bin(size))).otherwise(F.lit(0)).cast("long")


def targets(rows: DataFrame) -> DataFrame:
    """source, source_size, target: from rows (source, size).

    The resharing ends where every source has min(most, level * weight); the
    level follows from running sums over the sources in order of most / weight."""
    per = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((place - 1) % len(WEIGHTS) + 1).cast("int")).cast("long")
    w = per.withColumn("_w", weight).withColumn("_most", MOST * F.col("source_size"))
    order = Window.orderBy((F.col("_most") / F.col("_w")), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    got = (w.withColumn("_total", F.sum("source_size").over(whole))
           .withColumn("_left", F.col("_total") - F.coalesce(F.sum("_most").over(before), F.lit(0)))
           .withColumn("_rest", F.sum("_w").over(whole) - F.coalesce(F.sum("_w").over(before), F.lit(0)))
           # the first source, in this order, that its share does not fill sets the level
           .withColumn("_open", F.col("_left").cast("double") * F.col("_w")
                       <= F.col("_most").cast("double") * F.col("_rest"))
           .withColumn("_nth", F.row_number().over(order))
           .withColumn("_at", F.min(F.when(F.col("_open"), F.struct("_nth", "_left", "_rest")))
                       .over(whole)))
    share = F.col("_w").cast("double") * F.col("_at._left") / F.col("_at._rest")
    return got.select("source", "source_size", F.least(F.col("_most").cast("double"),
                                                       F.coalesce(share, F.col("_most").cast("double"))).alias("target"))


def _factors(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """source, factor: copies expected per bit of size, so that with the limit
    of ``MOST`` copies the source's words come to its target."""
    words = rows.groupBy("source", _bits(F.col("size")).alias("_b")).agg(F.sum("size").alias("_w")).filter("_b > 0")
    j = words.join(goals, words.source.eqNullSafe(goals.source)).select(goals.source, "_b", "_w", "target")
    before = Window.partitionBy("source").orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("source").orderBy(F.desc("_b")).rowsBetween(0, Window.unboundedFollowing)
    c = (F.col("target") - MOST * F.coalesce(F.sum("_w").over(before), F.lit(0))) \
        / F.sum(F.col("_b") * F.col("_w")).over(after)
    return (j.withColumn("_c", c).filter(F.col("_c") * F.col("_b") <= MOST)
            .groupBy("source").agg(F.max_by("_c", "_b").alias("factor")))


def uniform(key: str) -> Column:
    """A number in (0, 1) from the md5 of the key as text."""
    bits = F.conv(F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit("null")).cast("binary")), 1, 13), 16, 10)
    return (bits.cast("long") + 0.5) / F.lit(float(1 << 52))


def copies(docs: DataFrame, rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` (with ``size``) plus source_size, target and ``copies``.
    ``rows`` holds (key, source, size) of the same rows, cheap to read again."""
    goals = written(targets(rows))
    factors = _factors(rows, goals)
    per = goals.join(factors.withColumnRenamed("source", "_fs"), goals.source.eqNullSafe(F.col("_fs")), "left") \
        .select("source", "source_size", "target", F.coalesce("factor", F.lit(float(MOST))).alias("factor"))
    per = written(per)

    def ranked(df: DataFrame) -> DataFrame:
        side = per.withColumnRenamed("source", "_mix_s")
        df = df.join(side, df.source.eqNullSafe(F.col("_mix_s"))).drop("_mix_s")
        e = F.least(F.lit(float(MOST)), F.col("factor") * _bits(F.col("size")))
        df = df.withColumn("_mix_sure", F.floor(e)).withColumn("_mix_p", e - F.col("_mix_sure"))
        u = uniform(key)
        odds = F.try_divide(u * (1 - F.col("_mix_p")), (1 - u) * F.col("_mix_p"))
        return df.withColumn("_mix_q", odds).withColumn(
            "_mix_bin", F.least(F.lit(BINS - 1), F.floor(F.lit(BINS) * F.col("_mix_q") / (1 + F.col("_mix_q")))))

    small = ranked(rows)
    mine = lambda df: F.struct(df["_mix_q"], df[key], df["size"])
    sure = small.groupBy("source").agg(F.sum(F.col("_mix_sure") * F.col("size")).alias("_sure"))
    cuts = written(per.join(sure.withColumnRenamed("source", "_os"), per.source.eqNullSafe(F.col("_os"))).select(
        F.col("source").alias("_mix_s"), (F.col("target") - F.col("_sure")).alias("_mix_room0")))

    def after(df: DataFrame, k: int) -> Column:
        """Ranked behind the cut of pass k."""
        return F.col(f"_mix_bin{k}").isNotNull() & (
            (F.col("_mix_bin") > F.col(f"_mix_bin{k}")) | ((F.col("_mix_bin") == F.col(f"_mix_bin{k}"))
            & (F.col(f"_mix_edge{k}").isNull() | (mine(df) > F.col(f"_mix_edge{k}")))))

    def open_to(df: DataFrame, k: int) -> Column:
        """Up for pass k: behind the earlier cut and not larger than the room."""
        fits = (F.col("_mix_q").isNotNull()) & (F.col("size") <= F.col(f"_mix_room{k}"))
        return fits & after(df, k - 1) if k else fits

    for k in range(PASSES):
        both = small.join(cuts, small.source.eqNullSafe(F.col("_mix_s")))
        up = both.filter(open_to(both, k)).withColumn("_mix_room", F.col(f"_mix_room{k}"))
        bins = up.groupBy("source", "_mix_bin", "_mix_room").agg(F.sum("size").alias("_words"))
        run = F.sum("_words").over(Window.partitionBy("source").orderBy("_mix_bin"))
        first = F.min(F.when(F.col("_run") > F.col("_mix_room"), F.struct("_mix_bin", "_run", "_words")))
        at = written(bins.withColumn("_run", run).groupBy("source").agg(first.alias("_c"), F.max("_run").alias("_all"))
                     .select(F.col("source").alias("_as"), F.col("_c._mix_bin").alias(f"_mix_bin{k}"),
                             F.coalesce(F.col("_c._run") - F.col("_c._words"), F.col("_all")).alias("_before")))
        edge_in = up.join(at, up.source.eqNullSafe(F.col("_as")) & (F.col("_mix_bin") == F.col(f"_mix_bin{k}")))
        order = Window.partitionBy("source").orderBy("_mix_q", key, "size")
        edge = (edge_in.withColumn("_run", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
                .filter(F.col("_before") + F.col("_run") <= F.col("_mix_room")).groupBy("_as")
                .agg(F.max(F.struct("_mix_q", key, "size")).alias(f"_mix_edge{k}"), F.max("_run").alias("_in"))
                .withColumnRenamed("_as", "_es"))
        cuts = written(cuts.join(at, F.col("_mix_s").eqNullSafe(F.col("_as")), "left")
                       .join(edge, F.col("_mix_s").eqNullSafe(F.col("_es")), "left")
                       .withColumn(f"_mix_room{k + 1}", F.col(f"_mix_room{k}") - F.coalesce("_before", F.lit(0))
                                   - F.coalesce("_in", F.lit(0))).drop("_as", "_es", "_before", "_in"))
    big = ranked(docs)
    big = big.join(cuts, big.source.eqNullSafe(F.col("_mix_s")), "left")
    extra = F.lit(False)
    for k in range(PASSES):
        extra = extra | (open_to(big, k) & ~F.coalesce(after(big, k), F.lit(False)))
    return big.withColumn("copies", F.col("_mix_sure") + F.coalesce(extra, F.lit(False)).cast("long")).drop(
        *(c for c in big.columns if c.startswith("_mix")), "factor")
