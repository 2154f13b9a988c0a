"""Rule-based validation (§2.7). All column rules of a suite are evaluated in
ONE aggregate (count / count_if per rule) and then unpivoted into rows, so a
suite costs one scan whatever its size. The suite is a boolean gate and removes
no row; ``split_valid_invalid`` sets the rows apart that break a row rule.

Semantics: NULL passes ``in_set`` and ``between`` (it is not counted as
unexpected, and the percentage is over non-null values); ``not_null`` counts
NULLs over all rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import (ALLOWED_CODES, BETWEEN_RULES, IN_SET_RULES, LABEL, NOT_NULL_RULES,
                      PROCESSED_COLUMNS)
from .profile import invalid_categories, iqr_outliers, null_counts

ORDERED = "expect_table_columns_to_match_ordered_list"
NOT_NULL = "expect_column_values_to_not_be_null"
IN_SET = "expect_column_values_to_be_in_set"
BETWEEN = "expect_column_values_to_be_between"
EXISTS = "expect_column_to_exist"
ROWS_POSITIVE = "expect_table_row_count_to_be_positive"
NOT_ALL_NULL = "expect_column_values_to_not_be_all_null"


@dataclass
class Rule:
    kind: str
    column: str | None = None
    values: list = field(default_factory=list)
    lo: float | None = None
    hi: float | None = None


def credit_suite(columns=PROCESSED_COLUMNS) -> list[Rule]:
    """The nine expectations of the processed credit table."""
    rules = [Rule(ORDERED, None, list(columns))]
    rules += [Rule(NOT_NULL, c) for c in NOT_NULL_RULES]
    rules += [Rule(IN_SET, c, list(v)) for c, v in IN_SET_RULES]
    rules += [Rule(BETWEEN, c, lo=lo, hi=hi) for c, lo, hi in BETWEEN_RULES]
    return rules


def quality_suite_raw(label: str = LABEL) -> list[Rule]:
    return [Rule(ROWS_POSITIVE), Rule(EXISTS, label)]


def quality_suite_features(label: str = LABEL) -> list[Rule]:
    rules = [Rule(NOT_NULL, c) for c in ("LIMIT_BAL", "AGE", "PAY_0", label)]
    rules += [Rule(NOT_ALL_NULL, c) for c in ("PAYMENT_MEAN", "BILL_AMT_MEAN")]
    return rules


def _rule_aggs(df: DataFrame, i: int, r: Rule):
    """(unexpected, denominator) aggregate expressions, or None for plan-time rules."""
    if r.kind in (ORDERED, EXISTS):
        return None
    if r.kind == ROWS_POSITIVE:
        return (F.lit(0), F.count(F.lit(1)))
    if r.column not in df.columns:
        return (F.lit(None).cast("bigint"), F.lit(None).cast("bigint"))
    c = F.col(r.column)
    if r.kind == NOT_NULL:
        return (F.count_if(c.isNull()), F.count(F.lit(1)))
    if r.kind == NOT_ALL_NULL:
        return (F.when(F.count(c) == 0, F.count(F.lit(1))).otherwise(F.lit(0)), F.count(F.lit(1)))
    if r.kind == IN_SET:
        return (F.count_if(c.isNotNull() & ~c.isin(*r.values)), F.count(c))
    if r.kind == BETWEEN:
        return (F.count_if(c.isNotNull() & ((c < F.lit(r.lo)) | (c > F.lit(r.hi)))), F.count(c))
    raise ValueError(f"unknown rule {r.kind}")


def broken_rules(df: DataFrame, rules: list[Rule]) -> Column:
    """``kind:column`` of every row rule (not null, in set, between) that a row
    breaks, in the suite's order. A missing column breaks its rule in every
    row; rules on the whole table break none."""
    marks = []
    for r in rules:
        if r.kind not in (NOT_NULL, IN_SET, BETWEEN):
            continue
        name = F.lit(f"{r.kind}:{r.column}")
        if r.column not in df.columns:
            marks.append(name)
            continue
        c = F.col(r.column)
        if r.kind == NOT_NULL:
            broken = c.isNull()
        elif r.kind == IN_SET:
            broken = c.isNotNull() & ~c.isin(*r.values)
        else:
            broken = c.isNotNull() & ((c < F.lit(r.lo)) | (c > F.lit(r.hi)))
        marks.append(F.when(broken, name))
    return F.array_compact(F.array(*marks)) if marks else F.array().cast("array<string>")


def split_valid_invalid(df: DataFrame, rules: list[Rule],
                        column: str = "failed_rules") -> tuple[DataFrame, DataFrame]:
    """Rows that keep every row rule, and the quarantine: the other rows with
    the rules they break in ``column``. Every row is in exactly one of the two;
    repeated rows stay repeated. Both are narrow filters over ``df``."""
    if column in df.columns:
        raise ValueError(f"the table has a column {column} already; name another")
    marked = df.withColumn(column, broken_rules(df, rules))
    return marked.filter(F.size(column) == 0).drop(column), marked.filter(F.size(column) > 0)


def validate_table(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per rule: rule_id, expectation_type, column, element_count,
    unexpected_count, unexpected_percent, success."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, r in enumerate(rules):
        a = _rule_aggs(df, i, r)
        if a is not None:
            aggs += [a[0].cast("bigint").alias(f"_u{i}"), a[1].cast("bigint").alias(f"_d{i}")]
    wide = df.agg(*aggs)
    rows = []
    for i, r in enumerate(rules):
        col = F.lit(r.column if r.column else "N/A")
        if r.kind == ORDERED:
            ok = list(df.columns) == list(r.values)
            rows.append(F.struct(F.lit(i).alias("rule_id"), F.lit(r.kind).alias("expectation_type"),
                                 col.alias("column"), F.col("_n").alias("element_count"),
                                 F.lit(None).cast("bigint").alias("unexpected_count"),
                                 F.lit(None).cast("double").alias("unexpected_percent"),
                                 F.lit(ok).alias("success")))
            continue
        if r.kind == EXISTS:
            ok = r.column in df.columns
            rows.append(F.struct(F.lit(i).alias("rule_id"), F.lit(r.kind).alias("expectation_type"),
                                 col.alias("column"), F.col("_n").alias("element_count"),
                                 F.lit(None).cast("bigint").alias("unexpected_count"),
                                 F.lit(None).cast("double").alias("unexpected_percent"),
                                 F.lit(ok).alias("success")))
            continue
        u, d = F.col(f"_u{i}"), F.col(f"_d{i}")
        ok = (F.col("_n") > 0) if r.kind == ROWS_POSITIVE else F.coalesce(u == 0, F.lit(False))
        rows.append(F.struct(F.lit(i).alias("rule_id"), F.lit(r.kind).alias("expectation_type"),
                             col.alias("column"), F.col("_n").alias("element_count"),
                             u.alias("unexpected_count"),
                             F.when(d > 0, u * 100.0 / d).otherwise(F.lit(0.0)).alias("unexpected_percent"),
                             ok.alias("success")))
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def validation_summary(results: DataFrame) -> DataFrame:
    """success, evaluated, successful, unsuccessful, success_percent, failed."""
    failed = F.array_sort(F.collect_list(
        F.when(~F.col("success"), F.concat_ws(":", "expectation_type", "column"))))
    return results.agg(
        F.bool_and("success").alias("success"),
        F.count(F.lit(1)).alias("evaluated"),
        F.count_if(F.col("success")).alias("successful"),
        F.count_if(~F.col("success")).alias("unsuccessful"),
        (F.count_if(F.col("success")) * 100.0 / F.count(F.lit(1))).alias("success_percent"),
        failed.alias("failed"))


def quality_gate(raw: DataFrame, feats: DataFrame, label: str = LABEL) -> DataFrame:
    """The gate on the raw and the feature table, as rule rows with a stage."""
    a = validate_table(raw, quality_suite_raw(label)).withColumn("stage", F.lit("raw"))
    b = validate_table(feats, quality_suite_features(label)).withColumn("stage", F.lit("features"))
    return a.unionByName(b)


def data_issues(df: DataFrame, numeric_cols: list[str], allowed=ALLOWED_CODES,
                outlier_pct: float = 5.0) -> DataFrame:
    """Issue rows (issue_type, column, value): columns with NULLs (count),
    columns with > 5 % IQR outliers (percent), and codes outside the allowed
    sets (the code)."""
    miss = (null_counts(df).filter(F.col("null_count") > 0)
            .select(F.lit("missing").alias("issue_type"), "column",
                    F.col("null_count").cast("double").alias("value")))
    out = (iqr_outliers(df, numeric_cols, outlier_pct).filter(F.col("significant"))
           .select(F.lit("outliers").alias("issue_type"), F.col("feature").alias("column"),
                   F.col("outlier_percent").alias("value")))
    inv = (invalid_categories(df, allowed)
           .select(F.lit("invalid_category").alias("issue_type"), "column", "value"))
    return miss.unionByName(out).unionByName(inv)
