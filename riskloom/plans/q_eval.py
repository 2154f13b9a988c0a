"""Registered queries: evaluation metrics (§2.8) on deterministic scores of
the test split — RISK_SCORE_1 as a continuous score, the rule score for
labels — so the oracle can check them; the model path uses the same
functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.bands import rule_score
from ..functions.rowwise import rnd
from ..operators import evaluate as E
from ..operators.split import stratified_split
from ..schema import LABEL
from . import base as B
from .catalog import register
from .oracle_base import with_base
from .q_profile import _hist_sql

EVAL_CTE = """
ev AS (SELECT ID, is_default, CAST(RISK_SCORE_1 AS DOUBLE) AS score,
              CAST(CASE WHEN PAY_0 <= 0 AND LIMIT_BAL > 100000 THEN 0.05
                        WHEN PAY_0 <= 1 AND LIMIT_BAL > 50000 THEN 0.15
                        WHEN PAY_0 >= 2 OR LIMIT_BAL < 20000 THEN 0.75 ELSE 0.3 END AS DOUBLE) AS p
       FROM feat WHERE substr(md5(CAST(ID AS VARCHAR) || ':42'), 1, 8) < '33333333'),
evp AS (SELECT *, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS pred FROM ev)"""


def eval_set(spark, sf_dir, materialized=True):
    f = B.features_m(spark, sf_dir) if materialized else B.features(spark, sf_dir)
    t = stratified_split(f).filter(F.col("split") == "test")
    p = rule_score(F.col("PAY_0"), F.col("LIMIT_BAL"))
    return t.select("ID", LABEL, F.col("RISK_SCORE_1").cast("double").alias("score"), p.alias("p"),
                    F.when(p > 0.5, 1).otherwise(0).alias("pred"))


@register("roc_auc", with_base(EVAL_CTE.strip(), """
vc AS (SELECT score AS value, count_if(is_default = 0) AS c0, count_if(is_default = 1) AS c1
       FROM ev WHERE score IS NOT NULL GROUP BY score),
cum AS (SELECT *, sum(c0) OVER (ORDER BY value) AS k0, sum(c0) OVER () AS t0, sum(c1) OVER () AS t1 FROM vc)""") + f"""
SELECT CAST(any_value(t0) AS BIGINT) AS n0, CAST(any_value(t1) AS BIGINT) AS n1,
       {B.r('sum(c1 * (k0 - c0 / 2.0)) / (any_value(t0) * any_value(t1))')} AS roc_auc FROM cum""", headline=True)
def q_roc_auc(spark, sf_dir):
    a = E.roc_auc(eval_set(spark, sf_dir), LABEL, "score")
    return a.select("n0", "n1", rnd(F.col("roc_auc")).alias("roc_auc"))


@register("roc_curve", with_base(EVAL_CTE.strip(), """
vc AS (SELECT score AS value, count_if(is_default = 0) AS c0, count_if(is_default = 1) AS c1
       FROM ev WHERE score IS NOT NULL GROUP BY score),
cum AS (SELECT *, sum(c0) OVER (ORDER BY value DESC) AS k0, sum(c1) OVER (ORDER BY value DESC) AS k1,
               sum(c0) OVER () AS t0, sum(c1) OVER () AS t1 FROM vc)""") + f"""
SELECT 'inf'::DOUBLE AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
UNION ALL
SELECT {B.r('value')}, {B.r('CASE WHEN t0 = 0 THEN 0.0 ELSE k0 / t0 END')},
       {B.r('CASE WHEN t1 = 0 THEN 0.0 ELSE k1 / t1 END')} FROM cum""")
def q_roc_curve(spark, sf_dir):
    c = E.roc_curve(eval_set(spark, sf_dir), LABEL, "score")
    return c.select(F.when(F.col("threshold") == float("inf"), F.col("threshold"))
                    .otherwise(rnd(F.col("threshold"))).alias("threshold"),
                    rnd(F.col("fpr")).alias("fpr"), rnd(F.col("tpr")).alias("tpr"))


_CM = """
cm AS (SELECT count_if(is_default = 1 AND pred = 1) AS tp, count_if(is_default = 0 AND pred = 1) AS fp,
              count_if(is_default = 1 AND pred = 0) AS fn, count_if(is_default = 0 AND pred = 0) AS tn FROM evp)"""


def _sd(n, d):
    return f"(CASE WHEN ({d}) = 0 THEN 0.0 ELSE ({n}) * 1.0 / ({d}) END)"


@register("class_metrics", with_base(EVAL_CTE.strip(), _CM.strip()) + f"""
SELECT {B.r(_sd('tp', 'tp + fp'))} AS precision, {B.r(_sd('tp', 'tp + fn'))} AS recall,
       {B.r(_sd('2 * tp', '2 * tp + fp + fn'))} AS f1, {B.r(_sd('tp + tn', 'tp + tn + fp + fn'))} AS accuracy FROM cm""")
def q_class_metrics(spark, sf_dir):
    m = E.class_metrics(eval_set(spark, sf_dir), LABEL, "pred")
    return m.select(*[rnd(F.col(c)).alias(c) for c in m.columns])


_P1, _R1, _F1 = _sd('tp', 'tp + fp'), _sd('tp', 'tp + fn'), _sd('2 * tp', '2 * tp + fp + fn')
_P0, _R0, _F0 = _sd('tn', 'tn + fn'), _sd('tn', 'tn + fp'), _sd('2 * tn', '2 * tn + fn + fp')
_ACC = _sd('tp + tn', 'tp + tn + fp + fn')


@register("classification_report", with_base(EVAL_CTE.strip(), _CM.strip()) + f"""
SELECT '0' AS class, {B.r(_P0)} AS precision, {B.r(_R0)} AS recall, {B.r(_F0)} AS f1_score, CAST(tn + fp AS BIGINT) AS support FROM cm
UNION ALL SELECT '1', {B.r(_P1)}, {B.r(_R1)}, {B.r(_F1)}, CAST(tp + fn AS BIGINT) FROM cm
UNION ALL SELECT 'accuracy', {B.r(_ACC)}, {B.r(_ACC)}, {B.r(_ACC)}, CAST(tp + tn + fp + fn AS BIGINT) FROM cm
UNION ALL SELECT 'macro avg', {B.r(f'({_P0} + {_P1}) / 2')}, {B.r(f'({_R0} + {_R1}) / 2')}, {B.r(f'({_F0} + {_F1}) / 2')},
                 CAST(tp + tn + fp + fn AS BIGINT) FROM cm
UNION ALL SELECT 'weighted avg', {B.r(_sd(f'{_P0} * (tn + fp) + {_P1} * (tp + fn)', 'tp + tn + fp + fn'))},
                 {B.r(_sd(f'{_R0} * (tn + fp) + {_R1} * (tp + fn)', 'tp + tn + fp + fn'))},
                 {B.r(_sd(f'{_F0} * (tn + fp) + {_F1} * (tp + fn)', 'tp + tn + fp + fn'))},
                 CAST(tp + tn + fp + fn AS BIGINT) FROM cm""")
def q_classification_report(spark, sf_dir):
    r = E.classification_report(eval_set(spark, sf_dir), LABEL, "pred")
    return r.select("class", *[rnd(F.col(c)).alias(c) for c in ("precision", "recall", "f1_score")], "support")


@register("score_distribution", with_base(EVAL_CTE.strip(), _hist_sql("ev", "score", 50, group="is_default").strip()) + f"""
SELECT ha.is_default AS class, ha.bin, {B.r('lower')} AS lower, {B.r('upper')} AS upper,
       CAST(coalesce(c, 0) AS BIGINT) AS count
FROM ha LEFT JOIN hc ON ha.is_default = hc.is_default AND ha.bin = hc.bin""")
def q_score_distribution(spark, sf_dir):
    h = E.score_distribution(eval_set(spark, sf_dir), LABEL, "score")
    return h.select("class", "bin", rnd(F.col("lower")).alias("lower"), rnd(F.col("upper")).alias("upper"), "count")
