"""Row-wise statistics over a group of columns, as plain Column expressions
(JVM-side, inside whole-stage codegen; no UDF).

Null rules (the source's pandas semantics): missing values are skipped; the
mean and std of an all-missing row are NULL; the sum of an all-missing row is
0; a comparison with a missing value counts as false; std is the sample std and
NULL for fewer than two values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _add(terms: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, terms)


def row_count(cols) -> Column:
    """Number of non-null values in the row."""
    cs = _cols(cols)
    return _add([F.when(c.isNotNull(), F.lit(1)).otherwise(F.lit(0)) for c in cs])


def row_sum(cols) -> Column:
    """Σ of non-null values; 0 when all are missing."""
    cs = _cols(cols)
    if not cs:
        return F.lit(0.0)
    return _add([F.coalesce(c.cast("double"), F.lit(0.0)) for c in cs])


def row_mean(cols) -> Column:
    """Mean of non-null values; NULL when all are missing."""
    cs = _cols(cols)
    if not cs:
        return F.lit(None).cast("double")
    return F.try_divide(row_sum(cs), row_count(cs).cast("double"))


def row_std(cols) -> Column:
    """Sample standard deviation (n-1), two-pass; NULL for n < 2."""
    cs = _cols(cols)
    if not cs:
        return F.lit(None).cast("double")
    m = row_mean(cs)
    devs = [c.cast("double") - m for c in cs]
    ss = _add([F.coalesce(d * d, F.lit(0.0)) for d in devs])
    n = row_count(cs)
    return F.when(n >= 2, F.sqrt(ss / (n - 1).cast("double")))


def row_max(cols) -> Column:
    cs = _cols(cols)
    if not cs:
        return F.lit(None)
    return cs[0] if len(cs) == 1 else F.greatest(*cs)


def row_min(cols) -> Column:
    cs = _cols(cols)
    if not cs:
        return F.lit(None)
    return cs[0] if len(cs) == 1 else F.least(*cs)


def row_count_above(cols, threshold) -> Column:
    """Number of values > threshold; a missing value counts as false."""
    cs = _cols(cols)
    if not cs:
        return F.lit(0)
    return _add([F.when(F.coalesce(c > F.lit(threshold), F.lit(False)), F.lit(1)).otherwise(F.lit(0))
                 for c in cs])


def safe_ratio(num: Column, den: Column, eps: float = 1e-6) -> Column:
    """num / (den + eps); eps is added (not a null guard), and try_divide keeps
    ANSI mode from raising where den + eps is exactly zero."""
    return F.try_divide(num.cast("double"), den.cast("double") + F.lit(eps))


def flag(cond: Column) -> Column:
    """Boolean → 0/1 int; NULL (missing compared) → 0."""
    return F.when(F.coalesce(cond, F.lit(False)), F.lit(1)).otherwise(F.lit(0))


def clip_keep_null(c: Column, lo, hi) -> Column:
    """clip to [lo, hi], keeping NULL."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


def rnd(c: Column, digits: int = 6) -> Column:
    """Round a double for reports (and kill -0.0)."""
    return F.round(c.cast("double"), digits) + F.lit(0.0)
