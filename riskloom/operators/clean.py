"""Cleaning, projection and filtering operators (all narrow: no shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rowwise import clip_keep_null
from ..schema import LABEL, RAW_LABEL, TARGET_CANDIDATES


def drop_columns(df: DataFrame, cols=("ID",)) -> DataFrame:
    """Drop columns; names that do not exist are ignored."""
    return df.drop(*cols)


def rename_target(df: DataFrame, src: str = RAW_LABEL, dst: str = LABEL) -> DataFrame:
    return df.withColumnRenamed(src, dst)


def resolve_target(df: DataFrame, candidates=TARGET_CANDIDATES) -> str:
    """First existing label column among the candidates (plan-time lookup)."""
    for c in candidates:
        if c in df.columns:
            return c
    raise ValueError(f"no target column among {list(candidates)}")


def recode_education(df: DataFrame, col: str = "EDUCATION") -> DataFrame:
    c = F.col(col)
    return df.withColumn(col, F.when(c.isin(0, 5, 6), F.lit(4)).otherwise(c))


def recode_marriage(df: DataFrame, col: str = "MARRIAGE") -> DataFrame:
    c = F.col(col)
    return df.withColumn(col, F.when(c == 0, F.lit(3)).otherwise(c))


def clip_range(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Clip to [lo, hi]; NULL stays NULL."""
    return df.withColumn(col, clip_keep_null(F.col(col), lo, hi))


def clean_codes(df: DataFrame) -> DataFrame:
    """EDUCATION 0,5,6 → 4 then clip 1..4; MARRIAGE 0 → 3 then clip 1..3."""
    out = df
    if "EDUCATION" in df.columns:
        out = clip_range(recode_education(out), "EDUCATION", 1, 4)
    if "MARRIAGE" in df.columns:
        out = clip_range(recode_marriage(out), "MARRIAGE", 1, 3)
    return out


def clean_table(df: DataFrame, drop=("ID",), label_from: str = RAW_LABEL,
                label_to: str = LABEL) -> DataFrame:
    """Recode/clip codes, drop columns, rename the label: one projection."""
    return rename_target(drop_columns(clean_codes(df), drop), label_from, label_to)


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def select_numeric(df: DataFrame, exclude=()) -> DataFrame:
    return df.select(*numeric_columns(df, exclude))


def common_columns(a: DataFrame, b: DataFrame) -> list[str]:
    """Columns present in both samples, in the order of the first."""
    bs = set(b.columns)
    return [c for c in a.columns if c in bs]


def filter_mask(df: DataFrame, predicate) -> DataFrame:
    return df.filter(predicate)


def drop_non_finite(df: DataFrame, col: str = "value", nan_only: bool = False) -> DataFrame:
    """Remove NULL, NaN (and ±inf unless nan_only) from a numeric column."""
    c = F.col(col)
    cond = c.isNotNull() & ~F.isnan(c)
    if not nan_only:
        cond = cond & (F.abs(c) < F.lit(float("inf")))
    return df.filter(cond)


def nan_to_null(df: DataFrame, cols=None) -> DataFrame:
    """Turn NaN into NULL in floating columns (read-time normalisation)."""
    fl = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    cols = [c for c in (cols or df.columns) if c in fl]
    if not cols:
        return df
    return df.select(*[F.nanvl(F.col(c), F.lit(None).cast("double")).alias(c) if c in cols else F.col(c)
                       for c in df.columns])
