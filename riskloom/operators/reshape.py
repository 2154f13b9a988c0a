"""Wide → long reshaping: one unpivot turns a per-column loop into a single
job keyed by ``feature``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def long_format(df: DataFrame, cols: list[str], ids=(), feature: str = "feature",
                value: str = "value") -> DataFrame:
    """(ids..., feature, value double) — one row per input row and column."""
    ids = list(ids)
    base = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols])
    return base.unpivot(ids, cols, feature, value)


def long_levels(df: DataFrame, cols: list[str], ids=(), feature: str = "feature",
                value: str = "value") -> DataFrame:
    """(ids..., feature, value string): as ``long_format``, for string columns."""
    ids = list(ids)
    base = df.select(*ids, *[F.col(c).cast("string").alias(c) for c in cols])
    return base.unpivot(ids, cols, feature, value)
