"""Registered queries: credit view, cleaning (§2.2) and row-wise features (§2.3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.bands import risk_level, rule_score
from ..functions.rowwise import rnd
from ..operators import clean as C
from ..operators.features import build_features, serving_features
from ..operators.split import sample_n, split_info, stratified_split
from ..operators.reshape import long_format
from ..schema import BILL, CREATED_NUMERIC, LABEL, PAMT, PAY, PROCESSED_COLUMNS, SERVING_FEATURES
from . import base as B
from .catalog import register
from .oracle_base import FEATURE_NAMES, with_base

RAW_COLS = ["ID", "LIMIT_BAL", "SEX", "EDUCATION", "MARRIAGE", "AGE", *PAY, *BILL, *PAMT, LABEL]
ALL_FEAT_COLS = RAW_COLS + FEATURE_NAMES


def _feat_query(name, cols, headline=False):
    cols = ["ID", *cols]

    def fn(spark, sf_dir):
        return B.spark_round(B.features(spark, sf_dir), cols)
    register(name, with_base() + f"SELECT {B.sql_round(cols)} FROM feat", headline)(fn)


# --- the flagship: default rate by age group --------------------------------
@register("default_rate_by_age_group", with_base() + f"""
SELECT AGE_GROUP, CAST(count(*) AS BIGINT) AS n_borrowers,
       CAST(sum(is_default) AS BIGINT) AS n_default,
       {B.r('avg(is_default)')} AS default_rate,
       {B.r('avg(RISK_SCORE_1)')} AS mean_risk_score
FROM feat GROUP BY AGE_GROUP""", headline=True)
def default_rate_by_age_group(spark, sf_dir):
    return (B.features(spark, sf_dir).groupBy("AGE_GROUP")
            .agg(F.count(F.lit(1)).alias("n_borrowers"),
                 F.sum(LABEL).cast("bigint").alias("n_default"),
                 rnd(F.avg(LABEL)).alias("default_rate"),
                 rnd(F.avg("RISK_SCORE_1")).alias("mean_risk_score")))


# --- sources as tables -------------------------------------------------------
@register("credit_view", with_base() + "SELECT * FROM credit")
def q_credit_view(spark, sf_dir):
    return B.credit(spark, sf_dir)


# --- §2.2 cleaning -----------------------------------------------------------
@register("drop_columns", with_base() + "SELECT * EXCLUDE (ID, is_test) FROM credit")
def q_drop_columns(spark, sf_dir):
    return C.drop_columns(B.credit(spark, sf_dir), ["ID", "is_test", "NOT_A_COLUMN"])


_RENAMED = [c if c != LABEL else "target" for c in RAW_COLS]


@register("rename_target", with_base() + "SELECT " + ", ".join(
    c if c != LABEL else f"{LABEL} AS target" for c in RAW_COLS) + " FROM credit")
def q_rename_target(spark, sf_dir):
    return C.rename_target(B.credit(spark, sf_dir).select(*RAW_COLS), LABEL, "target")


@register("recode_education", with_base() + """
SELECT ID, CASE WHEN EDUCATION IN (0, 5, 6) THEN 4 ELSE EDUCATION END AS EDUCATION FROM credit""")
def q_recode_education(spark, sf_dir):
    return C.recode_education(B.credit(spark, sf_dir).select("ID", "EDUCATION"))


@register("recode_marriage", with_base() + """
SELECT ID, CASE WHEN MARRIAGE = 0 THEN 3 ELSE MARRIAGE END AS MARRIAGE FROM credit""")
def q_recode_marriage(spark, sf_dir):
    return C.recode_marriage(B.credit(spark, sf_dir).select("ID", "MARRIAGE"))


@register("clip_range", with_base() + """
SELECT ID, CASE WHEN PAY_6 IS NULL THEN NULL ELSE least(greatest(PAY_6, -1), 2) END AS PAY_6,
       CASE WHEN EDUCATION IS NULL THEN NULL ELSE least(greatest(EDUCATION, 1), 4) END AS EDUCATION
FROM credit""")
def q_clip_range(spark, sf_dir):
    df = B.credit(spark, sf_dir).select("ID", "PAY_6", "EDUCATION")
    return C.clip_range(C.clip_range(df, "PAY_6", -1, 2), "EDUCATION", 1, 4)


@register("clean_table", with_base() + "SELECT " + ", ".join(PROCESSED_COLUMNS) + " FROM clean")
def q_clean_table(spark, sf_dir):
    raw = B.credit(spark, sf_dir).drop("is_test")
    return C.clean_table(raw, drop=("ID",), label_from=LABEL, label_to=LABEL)


_NUMERIC_FEAT = [c for c in ALL_FEAT_COLS if c != "AGE_GROUP"]


@register("select_numeric", with_base() + f"SELECT {B.sql_round(_NUMERIC_FEAT)} FROM feat")
def q_select_numeric(spark, sf_dir):
    df = C.select_numeric(B.features(spark, sf_dir))
    return B.spark_round(df, df.columns)


@register("filter_mask", with_base() + """
SELECT ID, LIMIT_BAL, PAY_0 FROM clean WHERE is_default = 1 AND PAY_0 >= 1""")
def q_filter_mask(spark, sf_dir):
    df = B.cleaned(spark, sf_dir)
    return C.filter_mask(df, (F.col(LABEL) == 1) & (F.col("PAY_0") >= 1)).select("ID", "LIMIT_BAL", "PAY_0")


@register("drop_null_values", with_base() + "SELECT ID, feature, value FROM (" + " UNION ALL ".join(
    f"SELECT ID, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM clean" for c in PAY)
    + ") WHERE value IS NOT NULL")
def q_drop_null_values(spark, sf_dir):
    lf = long_format(B.cleaned(spark, sf_dir), PAY, ids=["ID"])
    return lf.filter(F.col("value").isNotNull()).select("ID", "feature", "value")


_RATIOS = ["BILL_AMT_TO_LIMIT_RATIO", "PAYMENT_TO_BILL_RATIO", "PAYMENT_TO_LIMIT_RATIO"]


@register("drop_non_finite", with_base() + "SELECT ID, feature, round(value, 6) + 0.0 AS value FROM (" + " UNION ALL ".join(
    f"SELECT ID, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM feat" for c in _RATIOS)
    + ") WHERE value IS NOT NULL AND NOT isnan(value) AND abs(value) < 'inf'::DOUBLE")
def q_drop_non_finite(spark, sf_dir):
    lf = long_format(B.features(spark, sf_dir), _RATIOS, ids=["ID"])
    return C.drop_non_finite(lf).select("ID", "feature", rnd(F.col("value")).alias("value"))


@register("sample_n", with_base() + """
SELECT ID, LIMIT_BAL, is_default FROM credit
ORDER BY md5(CAST(ID AS VARCHAR) || ':42') LIMIT 1000""")
def q_sample_n(spark, sf_dir):
    return sample_n(B.credit(spark, sf_dir), 1000, seed=42, key="ID").select("ID", "LIMIT_BAL", LABEL)


_SPLIT_SQL = """
split AS (
  SELECT *, CASE WHEN substr(md5(CAST(ID AS VARCHAR) || ':42'), 1, 8) < '33333333'
                 THEN 'test' ELSE 'train' END AS split
  FROM clean)"""


@register("stratified_split", with_base(_SPLIT_SQL) + "SELECT ID, is_default, split FROM split")
def q_stratified_split(spark, sf_dir):
    return stratified_split(B.cleaned(spark, sf_dir), test_frac=0.2, seed=42).select("ID", LABEL, "split")


@register("split_info", with_base(_SPLIT_SQL) + f"""
SELECT split, CAST(count(*) AS BIGINT) AS n_rows, {B.r('avg(is_default)')} AS default_rate
FROM (SELECT split, is_default FROM split UNION ALL SELECT 'full' AS split, is_default FROM clean)
GROUP BY split""")
def q_split_info(spark, sf_dir):
    return split_info(stratified_split(B.cleaned(spark, sf_dir), test_frac=0.2, seed=42))


# --- §2.3 row-wise features ----------------------------------------------------
_feat_query("row_mean", ["PAYMENT_MEAN", "BILL_AMT_MEAN", "PAY_AMT_MEAN"])
_feat_query("row_max", ["PAYMENT_MAX_DELAY", "BILL_AMT_MAX", "PAY_AMT_MAX"])
_feat_query("row_min", ["PAYMENT_MIN_DELAY", "BILL_AMT_MIN"])
_feat_query("row_std", ["PAYMENT_STD", "BILL_AMT_STD", "PAY_AMT_STD"])
_feat_query("row_sum", ["PAY_AMT_SUM"])
_feat_query("row_count_above", ["PAYMENT_DELAY_COUNT", "PAYMENT_SEVERITY"])
_feat_query("ratio_features", ["BILL_AMT_TO_LIMIT_RATIO", "BILL_AMT_UTILIZATION", "PAYMENT_TO_BILL_RATIO",
                               "PAYMENT_TO_LIMIT_RATIO", "LIMIT_BAL_PER_AGE"])
_feat_query("log_feature", ["LIMIT_BAL_LOG"])
_feat_query("bin_age", ["AGE", "AGE_GROUP"])
_feat_query("risk_score", ["RISK_SCORE_1"])
_feat_query("critical_debt", ["CRITICAL_DEBT"])
_feat_query("build_features", ALL_FEAT_COLS[1:] + ["is_test"])

_SERVE = ["PAYMENT_MEAN", "PAYMENT_MAX_DELAY", "PAYMENT_DELAY_COUNT", "PAYMENT_SEVERITY",
          "BILL_AMT_MEAN", "BILL_AMT_MAX", "BILL_AMT_TO_LIMIT_RATIO", "BILL_AMT_UTILIZATION",
          "LIMIT_BAL_PER_AGE", "LIMIT_BAL_LOG", "RISK_SCORE_1", "CRITICAL_DEBT"]
assert _SERVE == SERVING_FEATURES


@register("serving_features", with_base() + f"SELECT {B.sql_round(['ID', *_SERVE])} FROM feat")
def q_serving_features(spark, sf_dir):
    df = serving_features(B.cleaned(spark, sf_dir).drop(LABEL))
    return B.spark_round(df, ["ID", *_SERVE])


_RULE_SQL = """
CASE WHEN PAY_0 <= 0 AND LIMIT_BAL > 100000 THEN 0.05
     WHEN PAY_0 <= 1 AND LIMIT_BAL > 50000 THEN 0.15
     WHEN PAY_0 >= 2 OR LIMIT_BAL < 20000 THEN 0.75
     ELSE 0.3 END"""


@register("rule_score", with_base() + f"""
SELECT ID, CAST(p AS DOUBLE) AS probability, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS prediction
FROM (SELECT ID, {_RULE_SQL} AS p FROM clean)""")
def q_rule_score(spark, sf_dir):
    df = B.cleaned(spark, sf_dir)
    p = rule_score(F.col("PAY_0"), F.col("LIMIT_BAL"))
    return df.select("ID", p.alias("probability"),
                     F.when(p > 0.5, 1).otherwise(0).alias("prediction"))


@register("risk_level", with_base() + f"""
SELECT ID, CASE WHEN p < 0.1 THEN 'very low' WHEN p < 0.2 THEN 'low' WHEN p < 0.4 THEN 'medium'
                WHEN p < 0.6 THEN 'high' ELSE 'very high' END AS risk_level
FROM (SELECT ID, CAST({_RULE_SQL} AS DOUBLE) AS p FROM clean)""")
def q_risk_level(spark, sf_dir):
    df = B.cleaned(spark, sf_dir)
    return df.select("ID", risk_level(rule_score(F.col("PAY_0"), F.col("LIMIT_BAL"))).alias("risk_level"))


@register("stratified_split_exact", with_base() + """
SELECT ID, is_default,
       CASE WHEN row_number() OVER (PARTITION BY is_default ORDER BY h) <= floor(count(*) OVER (PARTITION BY is_default) * 0.2 + 0.5)
            THEN 'test' ELSE 'train' END AS split
FROM (SELECT ID, is_default,
             CAST(CAST(('0x' || substr(md5(CAST(ID AS VARCHAR) || ':42'), 1, 13)) AS BIGINT) AS DOUBLE) AS h FROM clean)""")
def q_stratified_split_exact(spark, sf_dir):
    """Exactly round(0.2 · n_class) test rows per class (smallest key hashes)."""
    return stratified_split(B.cleaned(spark, sf_dir), test_frac=0.2, seed=42, exact=True).select("ID", LABEL, "split")
