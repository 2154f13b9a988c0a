"""Registered queries: profiling (§2.4) and sort/top-k (§2.10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.rowwise import rnd
from ..operators import profile as P
from ..operators.clean import numeric_columns
from ..schema import ALLOWED_CODES, CREATED_CATEGORICAL, CREATED_NUMERIC, LABEL
from . import base as B
from .catalog import CATALOG, register
from .oracle_base import with_base

RAW_NUMERIC = ["ID", "LIMIT_BAL", "SEX", "EDUCATION", "MARRIAGE", "AGE",
               "PAY_0", "PAY_2", "PAY_3", "PAY_4", "PAY_5", "PAY_6",
               *[f"BILL_AMT{i}" for i in range(1, 7)], *[f"PAY_AMT{i}" for i in range(1, 7)], LABEL]
RAW_ALL = RAW_NUMERIC + ["is_test"]


def sql_long(cols, src, ids=(), value_cast="DOUBLE"):
    idl = "".join(f"{i}, " for i in ids)
    return "(" + " UNION ALL ".join(
        f"SELECT {idl}'{c}' AS feature, CAST({c} AS {value_cast}) AS value FROM {src}" for c in cols) + ")"


def _raw_numeric(spark, sf_dir):
    df = B.credit_m(spark, sf_dir)
    return df, numeric_columns(df)


@register("table_shape", with_base() + "SELECT CAST(count(*) AS BIGINT) AS n_rows, 26 AS n_columns FROM credit")
def q_table_shape(spark, sf_dir):
    return P.table_shape(B.credit(spark, sf_dir))


@register("value_counts", with_base() + f"""
SELECT is_default AS value, CAST(count(*) AS BIGINT) AS n,
       {B.r('count(*) * 100.0 / (SELECT count(*) FROM credit)')} AS percent
FROM credit GROUP BY is_default""")
def q_value_counts(spark, sf_dir):
    vc = P.value_counts(B.credit(spark, sf_dir), LABEL)
    return vc.select("value", "n", rnd(F.col("percent")).alias("percent"))


@register("imbalance_ratio", with_base() + f"""
SELECT CAST(min(n) AS BIGINT) AS minority, CAST(max(n) AS BIGINT) AS majority,
       {B.r('min(n) / max(n)')} AS imbalance_ratio
FROM (SELECT is_default, count(*) AS n FROM credit GROUP BY is_default)""")
def q_imbalance_ratio(spark, sf_dir):
    ir = P.imbalance_ratio(B.credit(spark, sf_dir), LABEL)
    return ir.select("minority", "majority", rnd(F.col("imbalance_ratio")).alias("imbalance_ratio"))


@register("null_counts", with_base() + " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(count_if({c} IS NULL) AS BIGINT) AS null_count FROM credit" for c in RAW_ALL))
def q_null_counts(spark, sf_dir):
    return P.null_counts(B.credit(spark, sf_dir))


_IQR_SQL = with_base(f"lf AS {sql_long(RAW_NUMERIC, 'credit')}", """
b AS (SELECT feature, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
      FROM lf GROUP BY feature),
o AS (SELECT lf.feature, CAST(count(*) AS BIGINT) AS n_rows,
             CAST(count_if(value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS BIGINT) AS n_outliers,
             any_value(q1) AS q1, any_value(q3) AS q3
      FROM lf JOIN b ON lf.feature = b.feature GROUP BY lf.feature)""")


@register("iqr_outliers", _IQR_SQL + f"""
SELECT feature, n_rows, n_outliers, {B.r('q1')} AS q1, {B.r('q3')} AS q3,
       {B.r('n_outliers * 100.0 / n_rows')} AS outlier_percent,
       n_outliers * 100.0 / n_rows > 5 AS significant
FROM o""")
def q_iqr_outliers(spark, sf_dir):
    df, cols = _raw_numeric(spark, sf_dir)
    o = P.iqr_outliers(df, cols)
    return o.select("feature", "n_rows", "n_outliers", rnd(F.col("q1")).alias("q1"), rnd(F.col("q3")).alias("q3"),
                    rnd(F.col("outlier_percent")).alias("outlier_percent"), "significant")


_ALLOWED_SQL = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({v} AS DOUBLE) AS value"
                                  for c, vs in ALLOWED_CODES.items() for v in vs)
_INVALID_SQL = f"""
inv AS (SELECT DISTINCT feature AS "column", value FROM {sql_long(list(ALLOWED_CODES), 'credit')} l
        WHERE NOT EXISTS (SELECT 1 FROM ({_ALLOWED_SQL}) a WHERE a.feature = l.feature AND a.value = l.value))"""


@register("invalid_categories", with_base(_INVALID_SQL) + 'SELECT "column", value FROM inv')
def q_invalid_categories(spark, sf_dir):
    return P.invalid_categories(B.credit(spark, sf_dir))


@register("data_issues", _IQR_SQL.rstrip() + "," + _INVALID_SQL + f"""
SELECT 'missing' AS issue_type, "column", CAST(null_count AS DOUBLE) AS value FROM ({" UNION ALL ".join(
    f"SELECT '{c}' AS column, count_if({c} IS NULL) AS null_count FROM credit" for c in RAW_ALL)}) WHERE null_count > 0
UNION ALL
SELECT 'outliers', feature, {B.r('n_outliers * 100.0 / n_rows')} FROM o WHERE n_outliers * 100.0 / n_rows > 5
UNION ALL
SELECT 'invalid_category', "column", value FROM inv""")
def q_data_issues(spark, sf_dir):
    from ..operators.validate import data_issues
    df, cols = _raw_numeric(spark, sf_dir)
    return data_issues(df, cols).select("issue_type", "column", rnd(F.col("value")).alias("value"))


@register("describe_numeric", with_base(f"lf AS {sql_long(RAW_NUMERIC, 'credit')}") + f"""
SELECT feature, CAST(count(value) AS BIGINT) AS count, {B.r('avg(value)')} AS mean,
       {B.r('stddev_samp(value)')} AS std, {B.r('min(value)')} AS min,
       {B.r('quantile_cont(value, 0.25)')} AS p25, {B.r('quantile_cont(value, 0.5)')} AS p50,
       {B.r('quantile_cont(value, 0.75)')} AS p75, {B.r('max(value)')} AS max
FROM lf GROUP BY feature""", headline=True)
def q_describe_numeric(spark, sf_dir):
    df, cols = _raw_numeric(spark, sf_dir)
    d = P.describe_numeric(df, cols)
    return d.select("feature", "count", *[rnd(F.col(c)).alias(c)
                                          for c in ["mean", "std", "min", "p25", "p50", "p75", "max"]])


def _corr_sql(src, cols, label):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, covar_samp(CAST({c} AS DOUBLE), CAST({label} AS DOUBLE)) "
        f"/ nullif(stddev_samp(CASE WHEN {label} IS NOT NULL THEN CAST({c} AS DOUBLE) END) "
        f"* stddev_samp(CASE WHEN {c} IS NOT NULL THEN CAST({label} AS DOUBLE) END), 0) AS corr FROM {src}"
        for c in cols)


_RAW_X = [c for c in RAW_NUMERIC if c != LABEL]


@register("corr_with_target", with_base() + f"SELECT feature, {B.r('corr')} AS corr FROM ({_corr_sql('credit', _RAW_X, LABEL)})")
def q_corr_with_target(spark, sf_dir):
    df = B.credit(spark, sf_dir)
    return P.corr_with_target(df, _RAW_X, LABEL).select("feature", rnd(F.col("corr")).alias("corr"))


@register("corr_bands", with_base() + f"""
SELECT feature, {B.r('corr')} AS corr, CAST(rank AS INTEGER) AS rank,
       CASE WHEN abs(corr) > 0.1 THEN 'high' WHEN abs(corr) > 0.05 THEN 'medium' ELSE 'low' END AS band
FROM (SELECT feature, corr, row_number() OVER (ORDER BY abs(corr) DESC, feature) AS rank
      FROM ({_corr_sql('credit', _RAW_X, LABEL)}) WHERE corr IS NOT NULL)
WHERE rank <= 10""")
def q_corr_bands(spark, sf_dir):
    c = P.corr_with_target(B.credit(spark, sf_dir), _RAW_X, LABEL)
    return P.corr_bands(c, 10).select("feature", rnd(F.col("corr")).alias("corr"), "rank", "band")


_FEAT_NUM = [c for c in ["LIMIT_BAL", "SEX", "EDUCATION", "MARRIAGE", "AGE", "PAY_0", "PAY_2", "PAY_3", "PAY_4",
                         "PAY_5", "PAY_6", *[f"BILL_AMT{i}" for i in range(1, 7)],
                         *[f"PAY_AMT{i}" for i in range(1, 7)], LABEL, *CREATED_NUMERIC]]


@register("topk_by_abs", with_base() + f"""
SELECT feature, {B.r('corr')} AS corr, CAST(rank AS INTEGER) AS rank
FROM (SELECT feature, corr, row_number() OVER (ORDER BY abs(corr) DESC, feature) AS rank
      FROM ({_corr_sql('feat', _FEAT_NUM, LABEL)}) WHERE corr IS NOT NULL)
WHERE rank <= 10""")
def q_topk_by_abs(spark, sf_dir):
    c = P.corr_with_target(B.features(spark, sf_dir), _FEAT_NUM, LABEL)
    return P.topk_by_abs(c, "corr", 10).select("feature", rnd(F.col("corr")).alias("corr"), "rank")


@register("features_info", with_base() + f"""
SELECT feature, {B.r('corr')} AS corr, CAST(rank AS INTEGER) AS rank,
       {len(_FEAT_NUM) + 1} AS total_features, {len(CREATED_NUMERIC)} AS numeric_features_created,
       {len(CREATED_CATEGORICAL)} AS categorical_features_created
FROM (SELECT feature, corr, row_number() OVER (ORDER BY abs(corr) DESC, feature) AS rank
      FROM ({_corr_sql('feat', _FEAT_NUM, LABEL)}) WHERE corr IS NOT NULL)
WHERE rank <= 10""")
def q_features_info(spark, sf_dir):
    feats = B.features(spark, sf_dir).drop("ID", "is_test")
    c = P.corr_with_target(feats, _FEAT_NUM, LABEL)
    return (P.topk_by_abs(c, "corr", 10)
            .select("feature", rnd(F.col("corr")).alias("corr"), "rank",
                    F.lit(len(feats.columns)).alias("total_features"),
                    F.lit(len(CREATED_NUMERIC)).alias("numeric_features_created"),
                    F.lit(len(CREATED_CATEGORICAL)).alias("categorical_features_created")))


_CM_COLS = [c for c in RAW_NUMERIC if c != "ID"]


def _cm_sql():
    parts = []
    for i, a in enumerate(_CM_COLS):
        for b in _CM_COLS[:i]:
            xa = f"CASE WHEN {b} IS NOT NULL THEN CAST({a} AS DOUBLE) END"
            xb = f"CASE WHEN {a} IS NOT NULL THEN CAST({b} AS DOUBLE) END"
            parts.append(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, "
                         f"{B.r(f'covar_samp({xa}, {xb}) / nullif(stddev_samp({xa}) * stddev_samp({xb}), 0)')} AS corr FROM credit")
    return " UNION ALL ".join(parts)


@register("corr_matrix", with_base() + _cm_sql())
def q_corr_matrix(spark, sf_dir):
    m = P.corr_matrix(B.credit(spark, sf_dir), _CM_COLS)
    return m.select("feature_a", "feature_b", rnd(F.col("corr")).alias("corr"))


def _hist_sql(src, col, bins, group=None):
    g = f"{group}, " if group else ""
    gj = f"USING ({group})" if group else "ON TRUE"
    return f"""
hv AS (SELECT {g}CAST({col} AS DOUBLE) AS v FROM {src} WHERE {col} IS NOT NULL AND NOT isnan(CAST({col} AS DOUBLE))),
hr AS (SELECT {g}min(v) AS lo, max(v) AS hi FROM hv {"GROUP BY " + group if group else ""}),
he AS (SELECT {g}lo, hi, list_transform(range(0, {bins} + 1), lambda i: CASE WHEN i = {bins} THEN hi
                 ELSE i * ((hi - lo) / {float(bins)}) + lo END) AS edges FROM hr),
hb AS (SELECT {g}least(len(list_filter(edges, lambda e: e <= v)), {bins}) - 1 AS bin FROM hv JOIN he {gj}),
hc AS (SELECT {g}bin, count(*) AS c FROM hb GROUP BY {g}bin),
ha AS (SELECT {g}CAST(i AS INTEGER) AS bin, edges[i + 1] AS lower, edges[i + 2] AS upper
       FROM he, range(0, {bins}) t(i))"""


@register("histogram", with_base(_hist_sql("credit", "LIMIT_BAL", 50).strip()) + f"""
SELECT ha.bin, {B.r('lower')} AS lower, {B.r('upper')} AS upper, CAST(coalesce(c, 0) AS BIGINT) AS count
FROM ha LEFT JOIN hc ON ha.bin = hc.bin""")
def q_histogram(spark, sf_dir):
    h = P.histogram(B.credit(spark, sf_dir), "LIMIT_BAL", 50)
    return h.select("bin", rnd(F.col("lower")).alias("lower"), rnd(F.col("upper")).alias("upper"), "count")


_GM_COLS = [c for c in _FEAT_NUM if c != LABEL]


@register("group_means", with_base(f"lf AS {sql_long(_GM_COLS, 'feat', ids=[LABEL])}") + f"""
SELECT feature, {LABEL} AS class, {B.r('avg(value)')} AS mean FROM lf GROUP BY feature, {LABEL}""")
def q_group_means(spark, sf_dir):
    g = P.group_means(B.features(spark, sf_dir), _GM_COLS, LABEL)
    return g.select("feature", "class", rnd(F.col("mean")).alias("mean"))


_DP_COLS = ["ID", *_FEAT_NUM, "AGE_GROUP"]


@register("distinct_profile", with_base() + " UNION ALL ".join(
    f"SELECT '{c}' AS column, CAST(count(DISTINCT {c}) AS BIGINT) AS n_distinct, "
    f"{'TRUE' if c == 'AGE_GROUP' else f'count(DISTINCT {c}) < 20'} AS is_categorical FROM feat"
    for c in _DP_COLS))
def q_distinct_profile(spark, sf_dir):
    return P.distinct_profile(B.features(spark, sf_dir), _DP_COLS)


@register("distinct_flags", with_base() + " UNION ALL ".join(
    f"SELECT '{c}' AS column, CASE WHEN count(DISTINCT {c}) < 20 THEN CAST(count(DISTINCT {c}) AS BIGINT) END AS n_distinct, "
    f"{'TRUE' if c == 'AGE_GROUP' else f'count(DISTINCT {c}) < 20'} AS is_categorical FROM feat"
    for c in _DP_COLS))
def q_distinct_flags(spark, sf_dir):
    """The categorical flag alone: columns far above the limit are told by a sketch."""
    return P.distinct_flags(B.features_m(spark, sf_dir), _DP_COLS)


_SM_COLS = [c for c in RAW_NUMERIC if c not in ("ID", LABEL)] + CREATED_NUMERIC


@register("sample_moments", with_base(f"lf AS {sql_long(_SM_COLS, 'feat', ids=['CAST(is_test AS INTEGER) AS side'])}") + f"""
SELECT feature, side, CAST(count(value) AS BIGINT) AS n, {B.r('avg(value)')} AS mean,
       {B.r('stddev_samp(value)')} AS std
FROM lf WHERE value IS NOT NULL GROUP BY feature, side""")
def q_sample_moments(spark, sf_dir):
    from ..operators.reshape import long_format
    f = B.features(spark, sf_dir).withColumn("side", F.col("is_test").cast("int"))
    m = P.sample_moments(long_format(f, _SM_COLS, ids=["side"]))
    return m.select("feature", "side", "n", rnd(F.col("mean")).alias("mean"), rnd(F.col("std")).alias("std"))


register("sample_moments_all", CATALOG["sample_moments"].sql)(q_sample_moments)   # its earlier name


@register("table_summary", with_base() + f"""
SELECT CAST(count(*) AS BIGINT) AS n_records, {B.r('avg(is_default)')} AS label_rate, 26 AS n_columns FROM credit""")
def q_table_summary(spark, sf_dir):
    s = P.table_summary(B.credit(spark, sf_dir), LABEL)
    return s.select("n_records", rnd(F.col("label_rate")).alias("label_rate"), "n_columns")
