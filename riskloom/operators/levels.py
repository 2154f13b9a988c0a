"""One-hot encoding of columns with any number of levels.

The levels are a table (feature, level, position), never a list on the driver:
distinct values are numbered inside hash buckets of bounded size, and the
buckets are put one after the other by their totals. Data meet the table by a
join (broadcast by Spark where its measured size allows, else shuffled), and
each column becomes one sparse vector. A level that the fit didn't see, and a
NULL, give the zero vector.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import SparkContext
from pyspark.ml.feature import OneHotEncoderModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

#: Levels of one bucket, numbered by one sorted run.
BUCKET_LEVELS = 100_000


@dataclass
class LevelEncoder:
    """``levels`` (feature, level, position) and the number of levels of each column."""

    cols: list[str]
    levels: DataFrame
    sizes: dict[str, int]

    def transform(self, df: DataFrame, suffix: str = "_levels") -> DataFrame:
        """``df`` with a sparse vector column ``<col><suffix>`` for each column."""
        out = df
        for i, c in enumerate(self.cols):
            at = self.levels.filter(F.col("feature") == c).select(F.col("level").alias(f"_l{i}"),
                                                                  F.col("position").alias(f"_p{i}"))
            out = (out.withColumn(f"_l{i}", F.col(c).cast("string")).join(at, f"_l{i}", "left").drop(f"_l{i}")
                   .withColumn(f"_p{i}", F.coalesce(F.col(f"_p{i}").cast("double"), F.lit(-1.0))))
        marks = [f"_p{i}" for i in range(len(self.cols))]
        return self._vectors(marks, [c + suffix for c in self.cols]).transform(out).drop(*marks)

    def _vectors(self, inputs: list[str], outputs: list[str]) -> OneHotEncoderModel:
        """Spark's encoder with the sizes known, so it needs no fit. A position
        outside a column's range (kept, then dropped as the last) is all zeros."""
        sc = SparkContext._active_spark_context
        sizes = sc._gateway.new_array(sc._gateway.jvm.int, len(self.cols))
        for i, c in enumerate(self.cols):
            sizes[i] = self.sizes[c]
        java = sc._jvm.org.apache.spark.ml.feature.OneHotEncoderModel("levels", sizes)
        model = OneHotEncoderModel(java)
        for name, value in (("inputCols", inputs), ("outputCols", outputs), ("handleInvalid", "keep"), ("dropLast", True)):
            model._set(**{name: value})
        return model


def fit_levels(df: DataFrame, cols: list[str]) -> LevelEncoder:
    """The levels of ``cols`` (as text) and their positions, in the order of the
    text within a bucket; one bucket, so the order of the text, up to
    ``BUCKET_LEVELS`` levels."""
    rows = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("level"))
                                         for c in cols])).alias("s")).select("s.*").filter(F.col("level").isNotNull())
    found = materialize(rows.distinct(), spread=False)
    sizes = {r["feature"]: r["n"] for r in found.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
    buckets = max(1, -(-max(sizes.values(), default=0) // BUCKET_LEVELS))
    marked = found.withColumn("_b", F.pmod(F.xxhash64("level"), F.lit(buckets)))
    per = marked.groupBy("feature", "_b").agg(F.count(F.lit(1)).alias("_t"))
    before = Window.partitionBy("feature").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select("feature", "_b", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_off"))
    run = Window.partitionBy("feature", "_b").orderBy("level")
    levels = (marked.join(offsets, ["feature", "_b"])
              .select("feature", "level", (F.col("_off") + F.row_number().over(run) - 1).alias("position")))
    return LevelEncoder(list(cols), materialize(levels, spread=False), {c: sizes.get(c, 0) for c in cols})
