"""The passes over a two-sample table's values, and its bins of equal width."""
import math

import numpy as np
from pyspark.sql import functions as F

from riskloom.operators import drift as D

LONG = "feature string, side int, value double"


def test_kl_reads_the_values_twice(spark):
    """Once for the ranges, once for the bins."""
    read = spark.sparkContext.accumulator(0)
    rows = [("a", i % 2, float(i % 13)) for i in range(200)]

    def counted(parts):
        for p in parts:
            read.add(p.num_rows)
            yield p
    lf = spark.createDataFrame(rows, LONG).mapInArrow(counted, LONG)
    got = D.kl_divergence(lf).collect()
    assert len(got) == 1 and got[0].kl is not None
    assert read.value <= 2 * len(rows)


def test_equal_width_bins_are_numpys(spark):
    """Values on the edges, one ulp beside them, in a range too narrow for its
    edges to differ, in an infinite one, and all equal."""
    def around(mn, mx):
        step = (mx - mn) / 19.0
        edges = [i * step + mn for i in range(19)] + [mx]
        return sorted({min(max(w, mn), mx) for e in edges for w in (e, np.nextafter(e, -np.inf), np.nextafter(e, np.inf))
                       if math.isfinite(w)})
    values = {"plain": around(0.1, 7.3), "negative": around(-3.7, -0.2), "narrow": [1e16, 1e16 + 2, 1e16 + 4],
              "infinite": [-1.7e308, 0.0, 1.7e308], "equal": [5.0, 5.0]}
    lf = spark.createDataFrame([(f, 0, float(v)) for f, vs in values.items() for v in vs], LONG)
    step = (F.col("_mx") - F.col("_mn")) / F.lit(19.0)
    edges = (lf.groupBy("feature").agg(F.min("value").alias("_mn"), F.max("value").alias("_mx")).withColumn("_step", step)
             .withColumn("edges", F.transform(F.sequence(F.lit(0), F.lit(19)), lambda i: F.when(
                 i == 19, F.col("_mx")).otherwise(i * F.col("_step") + F.col("_mn")))).drop("_mx"))
    even = {(r.feature, r.value, r.bin) for r in D.assign_bins(lf, edges).collect()}
    looked_up = {(r.feature, r.value, r.bin) for r in D.assign_bins(lf, edges.select("feature", "edges")).collect()}
    assert even == looked_up
    for f in ("plain", "negative"):
        e = edges.filter(F.col("feature") == f).collect()[0].edges
        want = {(f, v, min(int(np.searchsorted(e, v, "right")), 19) - 1) for v in values[f]}
        assert {t for t in even if t[0] == f} == want
