"""Registered queries: two-sample tests (§2.5) and drift (§2.6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.rowwise import rnd
from ..operators import drift as D
from ..operators import insights as I
from ..operators import twosample as TS
from ..operators.reshape import long_format, long_levels
from ..operators.split import stratified_split
from ..schema import CREATED_CATEGORICAL, CREATED_NUMERIC, KEY_DRIFT_FEATURES, LABEL, TTEST_FEATURES
from . import base as B
from .catalog import CATALOG, register
from .oracle_base import with_base
from .q_profile import RAW_NUMERIC

# --- inputs ------------------------------------------------------------------
SIG_U = [c for c in RAW_NUMERIC if c not in (LABEL, *TTEST_FEATURES)]
FEAT_NUM = ["LIMIT_BAL", "SEX", "EDUCATION", "MARRIAGE", "AGE", "PAY_0", "PAY_2", "PAY_3", "PAY_4", "PAY_5",
            "PAY_6", *[f"BILL_AMT{i}" for i in range(1, 7)], *[f"PAY_AMT{i}" for i in range(1, 7)],
            *CREATED_NUMERIC]
CAT_FEATURES = ["SEX", "EDUCATION", "MARRIAGE", "PAY_0", "PAYMENT_DELAY_COUNT", "PAYMENT_SEVERITY"]


def _lf_by_label(spark, sf_dir, cols):
    """raw credit table, side = label."""
    df = B.credit_m(spark, sf_dir)
    return long_format(df, cols, ids=[LABEL]).withColumnRenamed(LABEL, "side")


def _lf_split(spark, sf_dir, cols):
    """feature table, side = 1 for the test split (reference = train)."""
    f = stratified_split(B.features_m(spark, sf_dir))
    f = f.withColumn("side", F.when(F.col("split") == "test", 1).otherwise(0))
    return long_format(f, cols, ids=["side"])


def _lf_is_test(spark, sf_dir, cols):
    f = B.features_m(spark, sf_dir).withColumn("side", F.col("is_test").cast("int"))
    return long_format(f, cols, ids=["side"])


def _lf_age(spark, sf_dir, cols):
    f = B.features_m(spark, sf_dir).withColumn("side", F.when(F.col("AGE") >= 40, 1).otherwise(0))
    return long_format(f, cols, ids=["side"])


def sql_long(cols, src, side_expr):
    return "(" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {side_expr} AS side, CAST({c} AS DOUBLE) AS value FROM {src}"
        for c in cols) + ")"


SPLIT_CTE = """
splitf AS (SELECT *, CASE WHEN substr(md5(CAST(ID AS VARCHAR) || ':42'), 1, 8) < '33333333'
                     THEN 1 ELSE 0 END AS side FROM feat)"""


def lf_label_sql(cols):
    return f"lf AS {sql_long(cols, 'credit', 'is_default')}"


def lf_split_sql(cols):
    return SPLIT_CTE.strip() + f",\nlf AS {sql_long(cols, 'splitf', 'side')}"


def lf_is_test_sql(cols):
    return f"lf AS {sql_long(cols, 'feat', 'CAST(is_test AS INTEGER)')}"


def lf_age_sql(cols):
    return f"lf AS {sql_long(cols, 'feat', 'CASE WHEN AGE >= 40 THEN 1 ELSE 0 END')}"


# --- oracle building blocks -----------------------------------------------------
def t_sql(src="lf"):
    return f"""
SELECT feature, CAST(n0 AS BIGINT) AS n0, CAST(n1 AS BIGINT) AS n1, {B.r('m0')} AS mean_0, {B.r('m1')} AS mean_1,
       {B.r('(m0 - m1) / sqrt(((n0 - 1) * v0 + (n1 - 1) * v1) / (n0 + n1 - 2) * (1.0 / n0 + 1.0 / n1))')} AS statistic,
       CAST(n0 + n1 - 2 AS DOUBLE) AS df
FROM (SELECT feature, count(value) FILTER (WHERE side = 0) AS n0, count(value) FILTER (WHERE side = 1) AS n1,
             avg(value) FILTER (WHERE side = 0) AS m0, avg(value) FILTER (WHERE side = 1) AS m1,
             var_samp(value) FILTER (WHERE side = 0) AS v0, var_samp(value) FILTER (WHERE side = 1) AS v1
      FROM {src} WHERE value IS NOT NULL GROUP BY feature)"""


RANK_CTES = """
vc AS (SELECT feature, value, count_if(side = 0) AS c0, count_if(side = 1) AS c1
       FROM lf WHERE value IS NOT NULL GROUP BY feature, value),
cum AS (SELECT *, sum(c0) OVER (PARTITION BY feature ORDER BY value) AS k0,
               sum(c1) OVER (PARTITION BY feature ORDER BY value) AS k1,
               sum(c0) OVER (PARTITION BY feature) AS t0, sum(c1) OVER (PARTITION BY feature) AS t1 FROM vc),
rs AS (SELECT feature, CAST(any_value(t0) AS BIGINT) AS n0, CAST(any_value(t1) AS BIGINT) AS n1,
              sum(c0 * (k1 - c1 / 2.0)) AS u0, sum(c1 * (k0 - c0 / 2.0)) AS u1,
              sum(CAST(c0 + c1 AS DOUBLE) * (c0 + c1) * (c0 + c1) - (c0 + c1)) AS tie,
              max(abs(k0 / t0 - k1 / t1)) AS ks
       FROM cum GROUP BY feature)"""


def mwu_sql():
    z = ("(greatest(u0, u1) - n0 * n1 / 2.0 - 0.5) / sqrt(n0 * n1 / 12.0 * "
         "((CAST(n0 + n1 AS DOUBLE) + 1) - tie / (CAST(n0 + n1 AS DOUBLE) * (n0 + n1 - 1))))")
    return f"SELECT feature, n0, n1, {B.r('u0')} AS statistic, {B.r(z)} AS z FROM rs"


def psi_sql_ctes(method: str) -> str:
    """CTEs over ``lf(feature, side, value)`` ending in psi_res(feature, psi)."""
    if method == "smoothed":
        cond = "value IS NOT NULL AND NOT isnan(value) AND abs(value) < 'inf'::DOUBLE"
    else:
        cond = "value IS NOT NULL AND NOT isnan(value)"
    probs = ", ".join(str(i / 10) for i in range(11))
    fallback = method != "smoothed_strict"
    edges = ("CASE WHEN len(qe) < 2 THEN list_transform(range(0, 11), lambda i: CASE WHEN i = 10 THEN mx "
             "ELSE i * ((mx - mn) / 10.0) + mn END) ELSE qe END") if fallback else "qe"
    s = f"""
pb AS (SELECT feature, side, value FROM lf WHERE {cond}),
pq AS (SELECT feature, list_sort(list_distinct(quantile_cont(value, [{probs}]))) AS qe,
              min(value) AS mn, max(value) AS mx FROM pb WHERE side = 0 GROUP BY feature),
pe AS (SELECT feature, {edges} AS edges FROM pq),
pbin AS (SELECT pb.feature, pb.side,
                CASE WHEN len(list_filter(edges, lambda e: e <= value)) >= 1 AND value <= edges[len(edges)]
                          AND len(edges) >= 2
                     THEN least(len(list_filter(edges, lambda e: e <= value)), len(edges) - 1) - 1
                     ELSE -1 END AS bin
         FROM pb JOIN pe ON pb.feature = pe.feature),
pcnt AS (SELECT feature, bin, count_if(side = 0) AS c_ref, count_if(side = 1) AS c_cur FROM pbin GROUP BY feature, bin),
psz AS (SELECT feature, sum(c_ref) AS n_ref, sum(c_cur) AS n_cur FROM pcnt GROUP BY feature),
pall AS (SELECT feature, unnest(range(0, len(edges) - 1)) AS bin FROM pe),
pt AS (SELECT pe.feature, pall.bin, coalesce(pcnt.c_ref, 0) AS c_ref, coalesce(pcnt.c_cur, 0) AS c_cur,
              coalesce(psz.n_ref, 0) AS n_ref, coalesce(psz.n_cur, 0) AS n_cur
       FROM pe LEFT JOIN psz ON pe.feature = psz.feature
       LEFT JOIN pall ON pe.feature = pall.feature
       LEFT JOIN pcnt ON pall.feature = pcnt.feature AND pall.bin = pcnt.bin),"""
    if method == "floor":
        s += """
pf AS (SELECT feature, n_ref, n_cur, bin,
              CASE WHEN c_ref / n_ref = 0 THEN 0.0001 ELSE c_ref / n_ref END AS e,
              CASE WHEN c_cur / n_cur = 0 THEN 0.0001 ELSE c_cur / n_cur END AS a FROM pt),
psi_res AS (SELECT feature, CASE WHEN any_value(n_ref) > 0 AND any_value(n_cur) > 0
                                 THEN sum((e - a) * ln(e / a)) END AS psi FROM pf GROUP BY feature)"""
    else:
        s += """
pf AS (SELECT feature, n_ref, n_cur, bin,
              (c_ref + 0.0001) / sum(c_ref + 0.0001) OVER (PARTITION BY feature) AS e,
              (c_cur + 0.0001) / sum(c_cur + 0.0001) OVER (PARTITION BY feature) AS a FROM pt),
psi_res AS (SELECT feature, CASE WHEN any_value(n_ref) = 0 OR any_value(n_cur) = 0 THEN 'inf'::DOUBLE
                                 ELSE greatest(coalesce(sum(CASE WHEN bin IS NOT NULL THEN (a - e) * ln(a / e) END), 0.0), 0.0)
                            END AS psi FROM pf GROUP BY feature)"""
    return s


# --- §2.5 two-sample tests ------------------------------------------------------
@register("t_test", with_base(lf_label_sql(TTEST_FEATURES)) + t_sql())
def q_t_test(spark, sf_dir):
    t = TS.t_test(_lf_by_label(spark, sf_dir, TTEST_FEATURES), p_values=False)
    return t.select("feature", "n0", "n1", rnd(F.col("mean_0")).alias("mean_0"), rnd(F.col("mean_1")).alias("mean_1"),
                    rnd(F.col("statistic")).alias("statistic"), "df")


@register("mann_whitney_u", with_base(lf_label_sql(SIG_U), RANK_CTES.strip()) + mwu_sql(), headline=True)
def q_mann_whitney_u(spark, sf_dir):
    u = TS.mann_whitney_u(_lf_by_label(spark, sf_dir, SIG_U), p_values=False)
    return u.select("feature", "n0", "n1", rnd(F.col("statistic")).alias("statistic"), rnd(F.col("z")).alias("z"))


_SIG_ALL = TTEST_FEATURES + SIG_U


@register("feature_significance", with_base(lf_label_sql(_SIG_ALL), RANK_CTES.strip(), f"""
mom AS (SELECT feature, avg(value) FILTER (WHERE side = 0) AS m0, avg(value) FILTER (WHERE side = 1) AS m1
        FROM lf WHERE value IS NOT NULL GROUP BY feature),
tt AS ({t_sql()})""") + f"""
SELECT tt.feature, 't_test' AS test, tt.statistic, {B.r('m0')} AS mean_0, {B.r('m1')} AS mean_1
FROM tt JOIN mom ON tt.feature = mom.feature WHERE tt.feature IN ({", ".join(f"'{c}'" for c in TTEST_FEATURES)})
UNION ALL
SELECT rs.feature, 'mann_whitney_u', {B.r('u0')}, {B.r('m0')}, {B.r('m1')}
FROM rs JOIN mom ON rs.feature = mom.feature WHERE rs.feature NOT IN ({", ".join(f"'{c}'" for c in TTEST_FEATURES)})""")
def q_feature_significance(spark, sf_dir):
    s = TS.feature_significance(_lf_by_label(spark, sf_dir, _SIG_ALL), TTEST_FEATURES, p_values=False)
    return s.select("feature", "test", rnd(F.col("statistic")).alias("statistic"),
                    rnd(F.col("mean_0")).alias("mean_0"), rnd(F.col("mean_1")).alias("mean_1"))


def norm_p_sql(z: str) -> str:
    """Two-sided normal tail: one minus the density integrated by Simpson's rule."""
    x = f"least(abs({z}), 40.0)"
    return (f"(1.0 - 2.0 * {x} / 12000.0 * list_sum(list_transform(range(0, 4001), lambda i: "
            f"(CASE WHEN i = 0 OR i = 4000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) "
            f"* exp(-0.5 * ({x} * i / 4000.0) * ({x} * i / 4000.0)))) / sqrt(2.0 * pi()))")


def t_p_sql(t: str, df: str) -> str:
    """Two-sided Student tail, likewise."""
    return (f"(1.0 - 2.0 * abs({t}) / 12000.0 * exp(lgamma(({df} + 1) / 2.0) - lgamma({df} / 2.0)) / sqrt({df} * pi()) "
            f"* list_sum(list_transform(range(0, 4001), lambda i: (CASE WHEN i = 0 OR i = 4000 THEN 1 "
            f"WHEN i % 2 = 1 THEN 4 ELSE 2 END) * pow(1.0 + ({t} * i / 4000.0) * ({t} * i / 4000.0) / {df}, -({df} + 1) / 2.0))))")


def chi2_p_sql(x: str, k: str) -> str:
    """Upper chi-square tail: one minus the power series of the lower one."""
    return (f"CASE WHEN {k} <= 0 THEN NULL WHEN isinf({x}) THEN 0.0 WHEN {x} <= 0 THEN 1.0 ELSE "
            f"1.0 - list_sum(list_transform(range(0, 600), lambda n: exp((n + {k} / 2.0) * ln({x} / 2.0) - {x} / 2.0 "
            f"- lgamma({k} / 2.0 + 1 + n)))) END")


def ks_p_sql(d: str, n0: str, n1: str) -> str:
    """The Kolmogorov series with the small-sample factor."""
    en = f"sqrt(1.0 * {n0} * {n1} / ({n0} + {n1}))"
    lam = f"(({en} + 0.12 + 0.11 / {en}) * {d})"
    return (f"CASE WHEN {lam} < 0.001 THEN 1.0 ELSE least(1.0, greatest(0.0, list_sum(list_transform(range(1, 200), "
            f"lambda k: (CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END) * exp(-2.0 * k * k * {lam} * {lam}))))) END")


_Z_SQL = ("(greatest(u0, u1) - n0 * n1 / 2.0 - 0.5) / nullif(sqrt(n0 * n1 / 12.0 * "
          "((CAST(n0 + n1 AS DOUBLE) + 1) - tie / (CAST(n0 + n1 AS DOUBLE) * (n0 + n1 - 1)))), 0)")
_T_NAMES = ", ".join(f"'{c}'" for c in TTEST_FEATURES)
SIGNIFICANCE_SQL = with_base(lf_label_sql(_SIG_ALL), RANK_CTES.strip(), f"""
mom AS (SELECT feature, avg(value) FILTER (WHERE side = 0) AS m0, avg(value) FILTER (WHERE side = 1) AS m1,
               var_samp(value) FILTER (WHERE side = 0) AS v0, var_samp(value) FILTER (WHERE side = 1) AS v1,
               count(value) FILTER (WHERE side = 0) AS k0, count(value) FILTER (WHERE side = 1) AS k1
        FROM lf WHERE value IS NOT NULL GROUP BY feature),
st AS (SELECT feature, 't_test' AS test, m0, m1, CAST(k0 + k1 - 2 AS DOUBLE) AS df,
              (m0 - m1) / sqrt(((k0 - 1) * v0 + (k1 - 1) * v1) / (k0 + k1 - 2) * (1.0 / k0 + 1.0 / k1)) AS x
       FROM mom WHERE feature IN ({_T_NAMES})
       UNION ALL SELECT rs.feature, 'mann_whitney_u', m0, m1, u0, {_Z_SQL} FROM rs JOIN mom ON rs.feature = mom.feature
       WHERE rs.feature NOT IN ({_T_NAMES})),
pv AS (SELECT feature, test, m0, m1, CASE WHEN test = 't_test' THEN x ELSE df END AS statistic,
              CASE WHEN test = 't_test' THEN {t_p_sql('x', 'df')} ELSE {norm_p_sql('x')} END AS p FROM st)""") + f"""
SELECT feature, test, {B.r('statistic')} AS statistic, abs({B.r('greatest(p, 0.0)')}) AS p_value, {B.r('m0')} AS mean_0,
       {B.r('m1')} AS mean_1, coalesce(p < 0.05, FALSE) AS significant FROM pv"""


@register("feature_significance_pvalues", SIGNIFICANCE_SQL)
def q_feature_significance_pvalues(spark, sf_dir):
    """With p-values and the significance flag (p < 0.05)."""
    s = TS.feature_significance(_lf_by_label(spark, sf_dir, _SIG_ALL), TTEST_FEATURES, p_values=True)
    return s.select("feature", "test", *[rnd(F.col(c)).alias(c) for c in ("statistic", "p_value", "mean_0", "mean_1")],
                    "significant")


@register("ks_two_sample", with_base(lf_split_sql(KEY_DRIFT_FEATURES), RANK_CTES.strip()) + f"""
SELECT feature, n0, n1, {B.r('ks')} AS statistic FROM rs""")
def q_ks_two_sample(spark, sf_dir):
    k = TS.ks_two_sample(_lf_split(spark, sf_dir, KEY_DRIFT_FEATURES), p_values=False)
    return k.select("feature", "n0", "n1", rnd(F.col("statistic")).alias("statistic"))


_CHI_SQL = """
cc AS (SELECT feature, side, value AS category, count(*) AS n FROM lf WHERE value IS NOT NULL GROUP BY ALL),
al AS (SELECT coalesce(r.feature, c.feature) AS feature, coalesce(r.category, c.category) AS category,
              coalesce(r.n, 0) AS n_ref, coalesce(c.n, 0) AS n_cur
       FROM (SELECT * FROM cc WHERE side = 0) r
       FULL OUTER JOIN (SELECT * FROM cc WHERE side = 1) c ON r.feature = c.feature AND r.category = c.category),
tot AS (SELECT feature, sum(n_ref) AS t_ref, sum(n_cur) AS t_cur, count(*) AS k FROM al GROUP BY feature),
chi AS (SELECT al.feature, any_value(k) AS k, any_value(t_ref) AS t_ref, any_value(t_cur) AS t_cur,
               sum(CASE WHEN n_ref * t_cur / t_ref = 0 THEN NULL
                        ELSE (n_cur - n_ref * t_cur / t_ref) * (n_cur - n_ref * t_cur / t_ref) / (n_ref * t_cur / t_ref) END) AS s,
               count_if(n_ref * t_cur / t_ref = 0 AND n_cur > 0) AS ninf
        FROM al JOIN tot ON al.feature = tot.feature GROUP BY al.feature)"""


@register("chi_square_gof", with_base(lf_is_test_sql(CAT_FEATURES), _CHI_SQL.strip()) + f"""
SELECT feature, {B.r("CASE WHEN t_ref = 0 OR t_cur = 0 THEN NULL WHEN ninf > 0 THEN 'inf'::DOUBLE ELSE s END")} AS chi2_statistic,
       CAST(k - 1 AS BIGINT) AS dof FROM chi""")
def q_chi_square_gof(spark, sf_dir):
    c = TS.chi_square_gof(_lf_is_test(spark, sf_dir, CAT_FEATURES), p_values=False)
    return c.select("feature", rnd(F.col("chi2_statistic")).alias("chi2_statistic"), "dof")


@register("aligned_counts", with_base(lf_is_test_sql(["EDUCATION", "MARRIAGE"]), _CHI_SQL.strip()) + """
SELECT feature, category, CAST(n_ref AS BIGINT) AS n_ref, CAST(n_cur AS BIGINT) AS n_cur FROM al""")
def q_aligned_counts(spark, sf_dir):
    lf = _lf_is_test(spark, sf_dir, ["EDUCATION", "MARRIAGE"]).filter(F.col("value").isNotNull())
    cnt = lf.groupBy("feature", "side", F.col("value").alias("category")).agg(F.count(F.lit(1)).alias("n"))
    return TS.aligned_counts(cnt.filter("side = 0").drop("side"), cnt.filter("side = 1").drop("side"), ["feature"])


_ANOVA_COLS = [c for c in FEAT_NUM]


@register("anova_f", with_base(f"lf AS {sql_long(_ANOVA_COLS, 'feat', 'is_default')}", """
per AS (SELECT feature, side, count(value) AS nk, avg(value) AS mk, var_pop(value) AS vk
        FROM lf WHERE value IS NOT NULL GROUP BY feature, side),
tot AS (SELECT feature, sum(nk) AS n, count(*) AS k, sum(nk * mk) / sum(nk) AS gm FROM per GROUP BY feature)""") + f"""
SELECT per.feature,
       {B.r('(sum(nk * (mk - gm) * (mk - gm)) / (any_value(k) - 1)) / nullif(sum(nk * vk) / (any_value(n) - any_value(k)), 0)')} AS f_statistic,
       CAST(any_value(k) - 1 AS DOUBLE) AS df_between, CAST(any_value(n) - any_value(k) AS DOUBLE) AS df_within
FROM per JOIN tot ON per.feature = tot.feature GROUP BY per.feature""")
def q_anova_f(spark, sf_dir):
    lf = long_format(B.features_m(spark, sf_dir), _ANOVA_COLS, ids=[LABEL])
    a = TS.anova_f(lf, LABEL, p_values=False)
    return a.select("feature", rnd(F.col("f_statistic")).alias("f_statistic"), "df_between", "df_within")


# --- §2.6 drift ------------------------------------------------------------------
_EDGE_SQL = with_base(lf_split_sql(KEY_DRIFT_FEATURES), psi_sql_ctes("floor").strip().rstrip(","))


@register("psi_edges", _EDGE_SQL.split("pf AS (")[0].rstrip().rstrip(",") + "\n" +
          "SELECT feature, list_transform(edges, lambda e: round(e, 6) + 0.0) AS edges FROM pe")
def q_psi_edges(spark, sf_dir):
    lf = D.clean_values(_lf_split(spark, sf_dir, KEY_DRIFT_FEATURES), finite=False)
    e = D.psi_edges(lf)
    return e.select("feature", F.transform("edges", lambda x: F.round(x, 6) + F.lit(0.0)).alias("edges"))


def _psi_query(name, method, lf_fn, lf_sql, cols, headline=False):
    def fn(spark, sf_dir):
        p = D.psi(lf_fn(spark, sf_dir, cols), method)
        return p.select("feature", rnd(F.col("psi")).alias("psi"))
    register(name, with_base(lf_sql(cols), psi_sql_ctes(method).strip().rstrip(",")) +
             f"SELECT feature, {B.r('psi')} AS psi FROM psi_res", headline)(fn)


_psi_query("psi_floor", "floor", _lf_split, lf_split_sql, KEY_DRIFT_FEATURES)
_psi_query("psi_smoothed", "smoothed", _lf_is_test, lf_is_test_sql, FEAT_NUM, headline=True)
_psi_query("psi_smoothed_strict", "smoothed_strict", _lf_age, lf_age_sql, FEAT_NUM)


_KL_SQL = """
kb AS (SELECT feature, side, value FROM lf WHERE value IS NOT NULL AND NOT isnan(value) AND abs(value) < 'inf'::DOUBLE),
km AS (SELECT feature, min(value) AS mn, max(value) AS mx FROM kb GROUP BY feature),
ke AS (SELECT feature, mx > mn AS ok, list_transform(range(0, 20), lambda i: CASE WHEN i = 19 THEN mx
              ELSE i * ((mx - mn) / 19.0) + mn END) AS edges FROM km),
kbin AS (SELECT kb.feature, kb.side,
                CASE WHEN len(list_filter(edges, lambda e: e <= value)) >= 1 AND value <= edges[20]
                     THEN least(len(list_filter(edges, lambda e: e <= value)), 19) - 1 ELSE -1 END AS bin
         FROM kb JOIN ke ON kb.feature = ke.feature),
kc AS (SELECT feature, bin, count_if(side = 0) AS c_ref, count_if(side = 1) AS c_cur FROM kbin GROUP BY feature, bin),
ks_ AS (SELECT feature, sum(c_ref) AS n_ref, sum(c_cur) AS n_cur FROM kc GROUP BY feature),
ka AS (SELECT ke.feature, ke.ok, b.bin, edges[b.bin + 2] - edges[b.bin + 1] AS width,
              coalesce(kc.c_ref, 0) AS c_ref, coalesce(kc.c_cur, 0) AS c_cur, ks_.n_ref, ks_.n_cur
       FROM ke JOIN (SELECT unnest(range(0, 19)) AS bin) b ON TRUE
       JOIN ks_ ON ke.feature = ks_.feature
       LEFT JOIN kc ON kc.feature = ke.feature AND kc.bin = b.bin),
kd AS (SELECT feature, ok, c_ref / nullif(n_ref * width, 0) + 1e-10 AS p0, c_cur / nullif(n_cur * width, 0) + 1e-10 AS q0 FROM ka),
kn AS (SELECT feature, ok, p0 / sum(p0) OVER (PARTITION BY feature) AS p, q0 / sum(q0) OVER (PARTITION BY feature) AS q FROM kd)"""


@register("kl_divergence", with_base(lf_age_sql(FEAT_NUM), _KL_SQL.strip()) + f"""
SELECT names.feature, kl FROM (SELECT DISTINCT feature FROM lf) AS names LEFT JOIN
(SELECT feature, {B.r('CASE WHEN bool_and(ok) THEN sum(p * ln(p / q)) END')} AS kl FROM kn GROUP BY feature) AS k
ON names.feature = k.feature""")
def q_kl_divergence(spark, sf_dir):
    k = D.kl_divergence(_lf_age(spark, sf_dir, FEAT_NUM))
    return k.select("feature", rnd(F.col("kl")).alias("kl"))


@register("target_drift", with_base(SPLIT_CTE.strip()) + f"""
SELECT {B.r('abs(avg(is_default) FILTER (WHERE side = 0) - avg(is_default) FILTER (WHERE side = 1))')} AS target_drift
FROM splitf""")
def q_target_drift(spark, sf_dir):
    f = stratified_split(B.features(spark, sf_dir))
    t = D.target_drift(f.filter("split = 'train'"), f.filter("split = 'test'"), LABEL)
    return t.select(rnd(F.col("target_drift")).alias("target_drift"))


_STATUS_SELECT = """
SELECT CAST(count_if(psi > 0.2) AS BIGINT) AS high_drift_features_count,
       CAST(count_if(psi > 0.1 AND psi <= 0.2) AS BIGINT) AS medium_drift_features_count,
       CASE WHEN count_if(psi > 0.2) > 0 THEN 'high' WHEN count_if(psi > 0.1 AND psi <= 0.2) > 0 THEN 'medium'
            ELSE 'low' END AS drift_status FROM psi_res"""


@register("drift_status", with_base(lf_age_sql(FEAT_NUM), psi_sql_ctes("floor").strip().rstrip(",")) + _STATUS_SELECT)
def q_drift_status(spark, sf_dir):
    return D.drift_status(D.psi(_lf_age(spark, sf_dir, FEAT_NUM), "floor"))


@register("drift_recommendations", with_base(lf_age_sql(FEAT_NUM), psi_sql_ctes("floor").strip().rstrip(","),
                                             f"st AS ({_STATUS_SELECT})") + f"""
SELECT drift_status, CASE WHEN drift_status = 'high' THEN '{D.DRIFT_ADVICE_HIGH}'
                          WHEN drift_status = 'medium' THEN '{D.DRIFT_ADVICE_MEDIUM}' END AS recommendation FROM st""")
def q_drift_recommendations(spark, sf_dir):
    return D.drift_recommendations(D.drift_status(D.psi(_lf_age(spark, sf_dir, FEAT_NUM), "floor")))


@register("key_feature_drift", with_base(lf_split_sql(KEY_DRIFT_FEATURES), psi_sql_ctes("floor").strip().rstrip(","),
                                         RANK_CTES.strip()) + f"""
SELECT psi_res.feature, {B.r('psi')} AS psi, {B.r('ks')} AS ks FROM psi_res LEFT JOIN rs ON psi_res.feature = rs.feature""")
def q_key_feature_drift(spark, sf_dir):
    lf = _lf_split(spark, sf_dir, KEY_DRIFT_FEATURES)
    prof = D.drift_profile(D.sample_counts(lf), "floor")
    return prof.select("feature", rnd(F.col("psi")).alias("psi"), rnd(F.col("ks")).alias("ks"))


@register("key_feature_drift_status", with_base(lf_split_sql(KEY_DRIFT_FEATURES), psi_sql_ctes("floor").strip().rstrip(","),
                                                RANK_CTES.strip(), f"st AS ({_STATUS_SELECT})") + f"""
SELECT psi_res.feature, {B.r('psi')} AS psi, {B.r('ks')} AS ks, {B.r(ks_p_sql('ks', 'n0', 'n1'))} AS ks_p_value,
       (SELECT {B.r('abs(avg(is_default) FILTER (WHERE side = 0) - avg(is_default) FILTER (WHERE side = 1))')} FROM splitf) AS target_drift,
       st.high_drift_features_count, st.medium_drift_features_count, st.drift_status
FROM psi_res LEFT JOIN rs ON psi_res.feature = rs.feature CROSS JOIN st""")
def q_key_feature_drift_status(spark, sf_dir):
    """PSI, KS distance and its p-value per key feature, with the label's drift
    and the status of the whole."""
    f = stratified_split(B.features_m(spark, sf_dir)).withColumn("side", F.when(F.col("split") == "test", 1).otherwise(0))
    target = D.target_drift(f.filter("side = 0"), f.filter("side = 1"), LABEL)
    r = D.key_feature_drift(long_format(f, KEY_DRIFT_FEATURES, ids=["side"]), target)
    return r.select("feature", *[rnd(F.col(c)).alias(c) for c in ("psi", "ks", "ks_p_value", "target_drift")],
                    "high_drift_features_count", "medium_drift_features_count", "drift_status")


_FDR_COLS = FEAT_NUM


_NUMERIC_REPORT_SQL = (with_base(lf_is_test_sql(_FDR_COLS), psi_sql_ctes("smoothed").strip().rstrip(","),
                                            """cat AS (SELECT feature FROM lf WHERE side = 0 AND value IS NOT NULL
        AND NOT isnan(value) GROUP BY feature HAVING count(DISTINCT value) < 20)""",
                                            _CHI_SQL.strip().replace("FROM lf WHERE value IS NOT NULL GROUP BY ALL",
                                                                     "FROM lf WHERE value IS NOT NULL AND NOT isnan(value) "
                                                                     "AND feature IN (SELECT feature FROM cat) GROUP BY ALL"), """
mom AS (SELECT feature, avg(value) FILTER (WHERE side = 0) AS rm, avg(value) FILTER (WHERE side = 1) AS cm,
               stddev_samp(value) FILTER (WHERE side = 0) AS rs, stddev_samp(value) FILTER (WHERE side = 1) AS cs
        FROM lf WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY feature)""") + f"""
SELECT psi_res.feature, {B.r('psi')} AS psi, psi > 0.1 AS drift_detected,
       {B.r("CASE WHEN t_ref = 0 OR t_cur = 0 THEN NULL WHEN ninf > 0 THEN 'inf'::DOUBLE ELSE s END")} AS chi2_statistic,
       {B.r('rm')} AS reference_mean, {B.r('cm')} AS current_mean, {B.r('rs')} AS reference_std, {B.r('cs')} AS current_std
FROM psi_res LEFT JOIN mom ON psi_res.feature = mom.feature LEFT JOIN chi ON psi_res.feature = chi.feature""")


# the reports over all features: the numeric ones as above, and the string ones
_LEVELS_SQL = with_base("lv AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST(is_test AS INTEGER) AS side, {c} AS value FROM feat" for c in CREATED_CATEGORICAL) + ")", """
lc AS (SELECT feature, value, count_if(side = 0) AS n0, count_if(side = 1) AS n1 FROM lv
       WHERE value IS NOT NULL GROUP BY feature, value),
ls AS (SELECT feature, n0, n1, sum(n0) OVER f AS t0, sum(n1) OVER f AS t1,
              (n0 + 0.0001) / sum(n0 + 0.0001) OVER f AS e, (n1 + 0.0001) / sum(n1 + 0.0001) OVER f AS a
       FROM lc WINDOW f AS (PARTITION BY feature)),
lp AS (SELECT feature, CASE WHEN any_value(t0) = 0 OR any_value(t1) = 0 THEN 'inf'::DOUBLE
                            ELSE greatest(sum((a - e) * ln(a / e)), 0.0) END AS psi,
              CASE WHEN any_value(t0) = 0 OR any_value(t1) = 0 THEN NULL
                   WHEN count_if(n0 = 0 AND n1 > 0) > 0 THEN 'inf'::DOUBLE
                   ELSE sum((n1 - n0 * t1 / t0) * (n1 - n0 * t1 / t0) / (n0 * t1 / t0)) END AS chi2 FROM ls GROUP BY feature)""") + f"""
SELECT names.feature, {B.r("coalesce(psi, 'inf'::DOUBLE)")} AS psi, coalesce(psi, 'inf'::DOUBLE) > 0.1 AS drift_detected,
       {B.r('chi2')} AS chi2_statistic, CAST(NULL AS DOUBLE) AS reference_mean, CAST(NULL AS DOUBLE) AS current_mean,
       CAST(NULL AS DOUBLE) AS reference_std, CAST(NULL AS DOUBLE) AS current_std
FROM (SELECT DISTINCT feature FROM lv) AS names LEFT JOIN lp ON names.feature = lp.feature"""
_ALL_SQL = f"(SELECT * FROM ({_NUMERIC_REPORT_SQL}) UNION ALL SELECT * FROM ({_LEVELS_SQL}))"
_REPORT_SQL = f"SELECT * FROM {_ALL_SQL}"
_SUMMARY_SQL = f"""
SELECT CAST(count(*) AS BIGINT) AS total_features, CAST(count_if(drift_detected) AS BIGINT) AS drifted_features,
       coalesce(max(psi) FILTER (WHERE drift_detected), 0.0) AS max_psi, max(psi) AS max_psi_all,
       count_if(drift_detected) > 0 AS drift_detected FROM {_ALL_SQL}"""


def _all_features_report(spark, sf_dir):
    f = B.features_m(spark, sf_dir).withColumn("side", F.col("is_test").cast("int"))
    return D.feature_drift_report(long_format(f, _FDR_COLS, ids=["side"]),
                                  levels=long_levels(f, CREATED_CATEGORICAL, ids=["side"]))


@register("feature_drift_report", _REPORT_SQL, headline=True)
def q_feature_drift_report(spark, sf_dir):
    """Every feature, the string one among them."""
    r = _all_features_report(spark, sf_dir)
    return r.select("feature", rnd(F.col("psi")).alias("psi"), "drift_detected",
                    rnd(F.col("chi2_statistic")).alias("chi2_statistic"),
                    *[rnd(F.col(c)).alias(c) for c in ["reference_mean", "current_mean", "reference_std", "current_std"]])


@register("feature_drift_summary", _SUMMARY_SQL)
def q_feature_drift_summary(spark, sf_dir):
    s = D.drift_summary(_all_features_report(spark, sf_dir))
    return s.select("total_features", "drifted_features", rnd(F.col("max_psi")).alias("max_psi"),
                    rnd(F.col("max_psi_all")).alias("max_psi_all"), "drift_detected")


# the earlier names of the two reports
register("feature_drift_report_all", _REPORT_SQL)(q_feature_drift_report)
register("feature_drift_summary_all", _SUMMARY_SQL)(q_feature_drift_summary)

_CAT_RULE = """cat AS (SELECT feature FROM lf WHERE side = 0 AND value IS NOT NULL
        AND NOT isnan(value) GROUP BY feature HAVING count(DISTINCT value) < 20)"""


@register("feature_drift_pvalues", with_base(
    lf_is_test_sql(_FDR_COLS), _CAT_RULE, _CHI_SQL.strip().replace(
        "FROM lf WHERE value IS NOT NULL GROUP BY ALL",
        "FROM lf WHERE value IS NOT NULL AND NOT isnan(value) AND feature IN (SELECT feature FROM cat) GROUP BY ALL"),
    "cs AS (SELECT feature, CAST(k - 1 AS DOUBLE) AS dof, CASE WHEN t_ref = 0 OR t_cur = 0 THEN NULL "
    "WHEN ninf > 0 THEN 'inf'::DOUBLE ELSE s END AS x FROM chi)") + f"""
SELECT feature, {B.r('x')} AS chi2_statistic, {B.r(chi2_p_sql('x', 'dof'))} AS p_value FROM cs""")
def q_feature_drift_pvalues(spark, sf_dir):
    """Chi-square and its p-value of every numeric feature with fewer than 20
    distinct reference values (the rule, not a list)."""
    r = D.drift_profile(D.sample_counts(_lf_is_test(spark, sf_dir, _FDR_COLS)), "smoothed").filter("dof is not null")
    p = D.nan_to_null(D.p_chi2(F.col("chi2_statistic"), F.col("dof").cast("double")))
    return r.select("feature", rnd(F.col("chi2_statistic")).alias("chi2_statistic"), rnd(p).alias("p_value"))


@register("numeric_drift_report", with_base(lf_age_sql(FEAT_NUM), psi_sql_ctes("smoothed_strict").strip().rstrip(","), """
mom AS (SELECT feature, avg(value) FILTER (WHERE side = 0) AS rm, avg(value) FILTER (WHERE side = 1) AS cm
        FROM lf WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY feature)""") + f"""
SELECT psi_res.feature, {B.r('psi')} AS psi, CAST(psi > 0.1 AS INTEGER) AS drift_detected,
       {B.r('rm')} AS reference_mean, {B.r('cm')} AS current_mean
FROM psi_res LEFT JOIN mom ON psi_res.feature = mom.feature""")
def q_numeric_drift_report(spark, sf_dir):
    p = D.drift_profile(D.sample_counts(_lf_age(spark, sf_dir, FEAT_NUM)), "smoothed_strict")
    return p.select(
        "feature", rnd(F.col("psi")).alias("psi"), (F.col("psi") > 0.1).cast("int").alias("drift_detected"),
        rnd(F.col("reference_mean")).alias("reference_mean"), rnd(F.col("current_mean")).alias("current_mean"))


# --- insights, plan-time column logic ------------------------------------------------
def _insights(spark, sf_dir):
    from ..operators import profile as P
    from ..operators.insights import insight_rows
    from ..operators.validate import data_issues
    from ..operators.clean import numeric_columns
    raw = B.credit_m(spark, sf_dir)
    xs = [c for c in numeric_columns(raw) if c != LABEL]
    ir = P.imbalance_ratio(raw, LABEL)
    bands = P.corr_bands(P.corr_with_target(raw, xs, LABEL), 10)
    issues = data_issues(raw, numeric_columns(raw))
    sig = TS.feature_significance(long_format(raw, xs, ids=[LABEL]).withColumnRenamed(LABEL, "side"),
                                  TTEST_FEATURES, p_values=True)
    return insight_rows(ir, bands, issues, sig)


def _insight_sql() -> str:
    one = lambda sql, cols: f"(SELECT {cols} FROM ({sql}))"
    n = lambda text, x: f"replace('{text}', '{{n}}', CAST({x} AS VARCHAR))"
    q = lambda text: "'" + text.replace("'", "''") + "'"
    return f"""
WITH s AS (SELECT * FROM {one(CATALOG['imbalance_ratio'].sql, 'imbalance_ratio AS r')},
           {one(CATALOG['corr_bands'].sql, "count_if(band = 'high') AS hi, count_if(band = 'medium') AS me")},
           {one(CATALOG['data_issues'].sql, 'count(*) AS issues')}, {one(SIGNIFICANCE_SQL, 'count_if(significant) AS sig')})
SELECT CAST(idx AS INTEGER) AS idx, insight FROM (
  SELECT 0 AS idx, CASE WHEN r < 0.3 THEN {q(I.TEXT_IMBALANCE_HIGH)} WHEN r < 0.5 THEN {q(I.TEXT_IMBALANCE_MEDIUM)}
                        ELSE {q(I.TEXT_IMBALANCE_LOW)} END AS insight FROM s
  UNION ALL SELECT 1, CASE WHEN hi > 0 THEN {n(I.TEXT_HIGH_CORR, 'hi')} END FROM s
  UNION ALL SELECT 2, CASE WHEN me > 0 THEN {n(I.TEXT_MEDIUM_CORR, 'me')} END FROM s
  UNION ALL SELECT 3, CASE WHEN hi = 0 AND me = 0 THEN {q(I.TEXT_NO_CORR)} END FROM s
  UNION ALL SELECT 4, CASE WHEN issues > 0 THEN {q(I.TEXT_ISSUES)} ELSE {q(I.TEXT_NO_ISSUES)} END FROM s
  UNION ALL SELECT 5, {n(I.TEXT_SIGNIFICANT, 'sig')} FROM s) WHERE insight IS NOT NULL"""


@register("insight_rows", _insight_sql())
def q_insight_rows(spark, sf_dir):
    return _insights(spark, sf_dir)


@register("write_insights_text", f"SELECT insight AS value FROM ({_insight_sql()})")
def q_write_insights_text(spark, sf_dir):
    from ..session import scratch_path
    from ..sources.files import write_insights_text
    path = write_insights_text(_insights(spark, sf_dir).orderBy("idx"), scratch_path(spark, "insights"))
    return spark.read.text(path)


@register("resolve_target", with_base() + f"""
SELECT 'default' AS target_column, {B.r('avg(is_default)')} AS label_rate FROM credit""")
def q_resolve_target(spark, sf_dir):
    from ..operators.clean import resolve_target
    df = B.credit(spark, sf_dir).withColumnRenamed(LABEL, "default")
    t = resolve_target(df)
    return df.agg(F.lit(t).alias("target_column"), rnd(F.avg(F.col(f"`{t}`"))).alias("label_rate"))
