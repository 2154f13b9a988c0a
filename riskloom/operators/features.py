"""Row-wise feature building: 22 numeric features and AGE_GROUP in one
projection (no shuffle, one codegen stage). The serving subset is the same
function; Catalyst prunes the columns a caller does not select."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rowwise as R
from ..schema import (AGE_BIN_EDGES, AGE_BIN_LABELS, BILL, CREATED_NUMERIC, PAMT, PAY,
                      RATIO_EPS, SERVING_FEATURES)


def _group(df: DataFrame, names: list[str], strict: bool) -> list[str]:
    present = [c for c in names if c in df.columns]
    if strict and len(present) != len(names):
        missing = [c for c in names if c not in df.columns]
        raise ValueError(f"missing columns {missing}; pass strict=False to use the columns present")
    return present


def _col_or_null(df: DataFrame, name: str, strict: bool) -> Column:
    if name in df.columns:
        return F.col(name)
    if strict:
        raise ValueError(f"missing column {name}; pass strict=False")
    return F.lit(None).cast("double")


def age_group(age: Column) -> Column:
    """Right-closed bins (0,25],(25,35],(35,45],(45,55],(55,100]; else NULL."""
    e, lab = AGE_BIN_EDGES, AGE_BIN_LABELS
    expr = None
    for i in range(len(lab)):
        cond = (age > F.lit(e[i])) & (age <= F.lit(e[i + 1]))
        expr = F.when(cond, F.lit(lab[i])) if expr is None else expr.when(cond, F.lit(lab[i]))
    return expr


def feature_columns(df: DataFrame, strict: bool = True) -> dict[str, Column]:
    """name → expression for every created feature, in the source order."""
    pay, bill, pamt = (_group(df, g, strict) for g in (PAY, BILL, PAMT))
    limit = _col_or_null(df, "LIMIT_BAL", strict)
    age = _col_or_null(df, "AGE", strict)
    edu = _col_or_null(df, "EDUCATION", strict)
    pay0 = _col_or_null(df, "PAY_0", strict)

    f: dict[str, Column] = {}
    f["PAYMENT_MEAN"] = R.row_mean(pay)
    f["PAYMENT_MAX_DELAY"] = R.row_max(pay)
    f["PAYMENT_MIN_DELAY"] = R.row_min(pay)
    f["PAYMENT_STD"] = R.row_std(pay)
    f["PAYMENT_DELAY_COUNT"] = R.row_count_above(pay, 0)
    f["PAYMENT_SEVERITY"] = R.row_count_above(pay, 1)

    f["BILL_AMT_MEAN"] = R.row_mean(bill)
    f["BILL_AMT_STD"] = R.row_std(bill)
    f["BILL_AMT_MAX"] = R.row_max(bill)
    f["BILL_AMT_MIN"] = R.row_min(bill)
    f["BILL_AMT_TO_LIMIT_RATIO"] = R.safe_ratio(f["BILL_AMT_MEAN"], limit, RATIO_EPS)
    f["BILL_AMT_UTILIZATION"] = R.safe_ratio(f["BILL_AMT_MAX"], limit, RATIO_EPS)

    f["PAY_AMT_MEAN"] = R.row_mean(pamt)
    f["PAY_AMT_SUM"] = R.row_sum(pamt)
    f["PAY_AMT_STD"] = R.row_std(pamt)
    f["PAY_AMT_MAX"] = R.row_max(pamt)
    f["PAYMENT_TO_BILL_RATIO"] = R.safe_ratio(f["PAY_AMT_MEAN"], f["BILL_AMT_MEAN"], RATIO_EPS)
    f["PAYMENT_TO_LIMIT_RATIO"] = R.safe_ratio(f["PAY_AMT_MEAN"], limit, RATIO_EPS)

    f["AGE_GROUP"] = age_group(age)
    f["LIMIT_BAL_PER_AGE"] = R.safe_ratio(limit, age, RATIO_EPS)
    f["LIMIT_BAL_LOG"] = F.log1p(limit.cast("double"))

    f["RISK_SCORE_1"] = (pay0 * F.lit(0.3)
                         + f["PAYMENT_DELAY_COUNT"] * F.lit(0.2)
                         + f["BILL_AMT_TO_LIMIT_RATIO"] * F.lit(0.2)
                         + R.flag(age < F.lit(30)) * F.lit(0.1)
                         + R.flag(edu == F.lit(4)) * F.lit(0.1)
                         + R.flag(limit < F.lit(50000)) * F.lit(0.1))
    f["CRITICAL_DEBT"] = R.flag((f["PAYMENT_MAX_DELAY"] > F.lit(2))
                                & (f["BILL_AMT_TO_LIMIT_RATIO"] > F.lit(0.8)))
    for k in ("PAYMENT_MEAN", "PAYMENT_STD", "BILL_AMT_MEAN", "BILL_AMT_STD", "BILL_AMT_MAX",
              "BILL_AMT_MIN", "PAY_AMT_MEAN", "PAY_AMT_SUM", "PAY_AMT_STD", "PAY_AMT_MAX",
              "RISK_SCORE_1"):
        f[k] = f[k].cast("double")
    for k in ("PAYMENT_MAX_DELAY", "PAYMENT_MIN_DELAY", "PAYMENT_DELAY_COUNT",
              "PAYMENT_SEVERITY", "CRITICAL_DEBT"):
        f[k] = f[k].cast("int")
    return f


def build_features(df: DataFrame, strict: bool = True, only=None) -> DataFrame:
    """Input columns + the created features (or only the ``only`` subset)."""
    exprs = feature_columns(df, strict)
    names = list(exprs) if only is None else list(only)
    return df.select("*", *[exprs[n].alias(n) for n in names])


def serving_features(df: DataFrame, strict: bool = True) -> DataFrame:
    return build_features(df, strict, only=SERVING_FEATURES)


def created_feature_names() -> list[str]:
    return list(CREATED_NUMERIC)
