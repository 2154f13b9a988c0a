"""Registered queries: data validation (§2.7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.rowwise import rnd
from ..operators import validate as V
from ..schema import LABEL, PROCESSED_COLUMNS
from . import base as B
from .catalog import register
from .oracle_base import with_base


def round_rows(df):
    return df.select("rule_id", "expectation_type", "column", "element_count", "unexpected_count",
                     rnd(F.col("unexpected_percent")).alias("unexpected_percent"), "success")


def _rule_sql(i, r, src, columns):
    n = f"(SELECT count(*) FROM {src})"
    head = f"SELECT {i} AS rule_id, '{r.kind}' AS expectation_type, '{r.column or 'N/A'}' AS column, " \
           f"CAST({n} AS BIGINT) AS element_count, "
    if r.kind == V.ORDERED:
        ok = "TRUE" if list(columns) == list(r.values) else "FALSE"
        return head + f"CAST(NULL AS BIGINT) AS unexpected_count, CAST(NULL AS DOUBLE) AS unexpected_percent, {ok} AS success"
    if r.kind == V.EXISTS:
        ok = "TRUE" if r.column in columns else "FALSE"
        return head + f"CAST(NULL AS BIGINT) AS unexpected_count, CAST(NULL AS DOUBLE) AS unexpected_percent, {ok} AS success"
    if r.kind == V.ROWS_POSITIVE:
        return head + f"CAST(0 AS BIGINT) AS unexpected_count, {B.r('0')} AS unexpected_percent, {n} > 0 AS success"
    c = r.column
    if r.kind == V.NOT_NULL:
        u, d = f"count_if({c} IS NULL)", "count(*)"
    elif r.kind == V.NOT_ALL_NULL:
        u, d = f"(CASE WHEN count({c}) = 0 THEN count(*) ELSE 0 END)", "count(*)"
    elif r.kind == V.IN_SET:
        u, d = f"count_if({c} IS NOT NULL AND {c} NOT IN ({', '.join(str(v) for v in r.values)}))", f"count({c})"
    else:
        u, d = f"count_if({c} IS NOT NULL AND ({c} < {r.lo} OR {c} > {r.hi}))", f"count({c})"
    return (head + f"CAST({u} AS BIGINT) AS unexpected_count, "
            f"{B.r(f'CASE WHEN {d} > 0 THEN {u} * 100.0 / {d} ELSE 0.0 END')} AS unexpected_percent, "
            f"coalesce({u} = 0, FALSE) AS success FROM {src}")


def suite_sql(rules, src, columns):
    return " UNION ALL ".join(_rule_sql(i, r, src, columns) for i, r in enumerate(rules))


_CLEAN24 = f"clean24 AS (SELECT {', '.join(PROCESSED_COLUMNS)} FROM clean)"
RAW_COLUMNS = ["ID", "LIMIT_BAL", "SEX", "EDUCATION", "MARRIAGE", "AGE", "PAY_0", "PAY_2", "PAY_3", "PAY_4",
               "PAY_5", "PAY_6", *[f"BILL_AMT{i}" for i in range(1, 7)], *[f"PAY_AMT{i}" for i in range(1, 7)],
               LABEL, "is_test"]


def _clean24(spark, sf_dir):
    return B.cleaned(spark, sf_dir).select(*PROCESSED_COLUMNS)


def _register_rules(name, rules_fn, raw: bool, headline=False):
    rules = rules_fn()
    src, cols = ("credit", RAW_COLUMNS) if raw else ("clean24", PROCESSED_COLUMNS)

    def fn(spark, sf_dir):
        df = B.credit(spark, sf_dir) if raw else _clean24(spark, sf_dir)
        return round_rows(V.validate_table(df, rules))
    register(name, with_base(_CLEAN24) + suite_sql(rules, src, cols), headline)(fn)


_register_rules("expect_columns_ordered", lambda: [V.credit_suite()[0]], raw=False)
_register_rules("expect_not_null", lambda: [r for r in V.credit_suite() if r.kind == V.NOT_NULL], raw=True)
_register_rules("expect_in_set", lambda: [r for r in V.credit_suite() if r.kind == V.IN_SET], raw=True)
_register_rules("expect_between", lambda: [r for r in V.credit_suite() if r.kind == V.BETWEEN], raw=True)
_register_rules("validate_table", V.credit_suite, raw=False, headline=True)
_register_rules("validate_raw_table", lambda: V.credit_suite(RAW_COLUMNS), raw=True)


@register("validation_summary", with_base(_CLEAN24, f"res AS ({suite_sql(V.credit_suite(RAW_COLUMNS), 'credit', RAW_COLUMNS)})") + f"""
SELECT bool_and(success) AS success, CAST(count(*) AS BIGINT) AS evaluated,
       CAST(count_if(success) AS BIGINT) AS successful, CAST(count_if(NOT success) AS BIGINT) AS unsuccessful,
       {B.r('count_if(success) * 100.0 / count(*)')} AS success_percent,
       list_sort(list(expectation_type || ':' || "column") FILTER (WHERE NOT success)) AS failed
FROM res""")
def q_validation_summary(spark, sf_dir):
    res = V.validate_table(B.credit(spark, sf_dir), V.credit_suite(RAW_COLUMNS))
    s = V.validation_summary(res)
    return s.select("success", "evaluated", "successful", "unsuccessful",
                    rnd(F.col("success_percent")).alias("success_percent"), "failed")


@register("quality_gate", with_base() + "SELECT *, 'raw' AS stage FROM (" + suite_sql(
    V.quality_suite_raw(), "credit", RAW_COLUMNS) + ") UNION ALL SELECT *, 'features' AS stage FROM (" + suite_sql(
    V.quality_suite_features(), "feat", []) + ")")
def q_quality_gate(spark, sf_dir):
    g = V.quality_gate(B.credit(spark, sf_dir), B.features(spark, sf_dir))
    return g.select("rule_id", "expectation_type", "column", "element_count", "unexpected_count",
                 rnd(F.col("unexpected_percent")).alias("unexpected_percent"), "success", "stage")


def _broken_sql(r):
    c, name = r.column, f"'{r.kind}:{r.column}'"
    if r.kind == V.NOT_NULL:
        broken = f"{c} IS NULL"
    elif r.kind == V.IN_SET:
        broken = f"{c} NOT IN ({', '.join(str(v) for v in r.values)})"
    else:
        broken = f"{c} NOT BETWEEN {r.lo} AND {r.hi}"
    return f"CASE WHEN {broken} THEN {name} END"


_ROW_RULES = [r for r in V.credit_suite() if r.kind != V.ORDERED]


@register("split_valid_invalid", with_base() + f"""
SELECT ID, failed = '' AS is_valid, failed AS failed_rules
FROM (SELECT ID, concat_ws(',', {', '.join(_broken_sql(r) for r in _ROW_RULES)}) AS failed FROM credit)""")
def q_split_valid_invalid(spark, sf_dir):
    raw = B.credit(spark, sf_dir)
    valid, invalid = V.split_valid_invalid(raw, V.credit_suite(RAW_COLUMNS))
    return valid.select("ID", F.lit(True).alias("is_valid"), F.lit("").alias("failed_rules")).unionByName(
        invalid.select("ID", F.lit(False).alias("is_valid"), F.concat_ws(",", "failed_rules").alias("failed_rules")))
