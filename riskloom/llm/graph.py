"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over undirected edges (hi, lo), hi > lo: every node's
    larger (or smaller) neighbours are hung on the node's least neighbour."""
    if large:
        near = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(edges.select("lo", "hi"))
    else:
        near = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    hung = near.join(least, "u")
    if large:
        out = hung.filter("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
    else:
        out = hung.select(F.col("v").alias("hi"), F.col("m").alias("lo")).unionAll(
            least.select(F.col("u").alias("hi"), F.col("m").alias("lo")))
    return out.filter("hi <> lo").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); component is the
    least node that can be reached. Self-links and repeats are harmless."""
    state = written(edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
                    .filter("hi <> lo").distinct())
    seen = None
    while True:
        mark = state.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(20,0)"))).first()
        if seen == tuple(mark):
            return state.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionAll(
                state.select("lo").distinct().select(F.col("lo").alias("node"), F.col("lo").alias("component")))
        seen = tuple(mark)
        state = written(_stars(_stars(state, large=True), large=False))
