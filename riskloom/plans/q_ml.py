"""Registered queries: preparation, training, model runs and scoring
(§2.8, §2.9). Fitted models cannot be matched row by row against another
engine, so model outputs get the rows-only check (plus unit tests on
properties); the preparation statistics and rule scoring have oracles."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.bands import risk_level, rule_score
from ..functions.rowwise import rnd
from ..operators import prep as PR
from ..operators.clean import clean_codes
from ..operators.features import build_features
from ..operators import levels as LV
from ..operators import train as TR
from ..operators.reports import ReportTable
from ..operators.split import kfold_column, stratified_split
from ..schema import LABEL, MODEL_CATEGORICAL, MODEL_NUMERIC
from ..session import ensure_checkpoint_dir, scratch_path
from . import base as B
from .catalog import register
from .oracle_base import with_base
from .q_stats import SPLIT_CTE

LEVELS = {"SEX": [1, 2], "EDUCATION": [1, 2, 3, 4], "MARRIAGE": [1, 2, 3]}


def splits(spark, sf_dir):
    """Training and test part of one written feature table."""
    f = stratified_split(B.features_m(spark, sf_dir))
    return f.filter(F.col("split") == "train"), f.filter(F.col("split") == "test")


def _train_and_all(spark, sf_dir):
    f = stratified_split(B.features_m(spark, sf_dir))
    return f.filter(F.col("split") == "train"), f.drop("split")


def _train_sql():
    return SPLIT_CTE.strip() + ",\ntr AS (SELECT * FROM splitf WHERE side = 0)"


# --- preparation -----------------------------------------------------------------
@register("impute_median", with_base(_train_sql(), "med AS (SELECT " + ", ".join(
    f"quantile_cont({c}, 0.5) AS m_{c}" for c in MODEL_NUMERIC) + " FROM tr)") + "SELECT ID, " + ", ".join(
    f"{B.r(f'coalesce(CAST({c} AS DOUBLE), m_{c})')} AS {c}" for c in MODEL_NUMERIC) + " FROM feat, med")
def q_impute_median(spark, sf_dir):
    train, full = _train_and_all(spark, sf_dir)
    med = PR.fit_medians(train, MODEL_NUMERIC)
    out = PR.impute_median(full.select("ID", *MODEL_NUMERIC), MODEL_NUMERIC, med)
    return out.select("ID", *[rnd(F.col(c)).alias(c) for c in MODEL_NUMERIC])


@register("impute_constant", with_base() + "SELECT ID, " + ", ".join(
    f"coalesce({c}, 0) AS {c}" for c in MODEL_CATEGORICAL) + " FROM feat")
def q_impute_constant(spark, sf_dir):
    return PR.impute_constant(B.features(spark, sf_dir).select("ID", *MODEL_CATEGORICAL), MODEL_CATEGORICAL, 0)


def _std_sql():
    imp = {c: f"coalesce(CAST({c} AS DOUBLE), m_{c})" for c in MODEL_NUMERIC}
    return with_base(_train_sql(), "med AS (SELECT " + ", ".join(
        f"quantile_cont({c}, 0.5) AS m_{c}" for c in MODEL_NUMERIC) + " FROM tr)",
        "st AS (SELECT " + ", ".join(f"avg({imp[c]}) AS a_{c}, stddev_pop({imp[c]}) AS s_{c}" for c in MODEL_NUMERIC)
        + " FROM tr, med)") + "SELECT ID, " + ", ".join(
        f"{B.r(f'({imp[c]} - a_{c}) / (CASE WHEN s_{c} = 0 THEN 1.0 ELSE s_{c} END)')} AS {c}" for c in MODEL_NUMERIC) \
        + " FROM feat, med, st"


@register("standardize", _std_sql())
def q_standardize(spark, sf_dir):
    train, full = _train_and_all(spark, sf_dir)
    st = PR.fit_prep(train, numeric=MODEL_NUMERIC, categorical=[], k=len(MODEL_NUMERIC))
    out = PR.prepare(full, st, keep=("ID",))
    return out.select("ID", *[rnd(F.col(c)).alias(c) for c in MODEL_NUMERIC])


_OH = [(c, v) for c in MODEL_CATEGORICAL for v in LEVELS[c]]


@register("one_hot", with_base() + "SELECT ID, " + ", ".join(
    f"CASE WHEN coalesce({c}, 0) = {v} THEN 1.0 ELSE 0.0 END AS {c}_{v}" for c, v in _OH) + " FROM feat")
def q_one_hot(spark, sf_dir):
    train, full = _train_and_all(spark, sf_dir)
    st = PR.fit_prep(train, numeric=[], categorical=MODEL_CATEGORICAL, k=0)
    return PR.prepare(full, st, keep=("ID",))


def _kbest_sql():
    imp = {c: f"coalesce(CAST({c} AS DOUBLE), m_{c})" for c in MODEL_NUMERIC}
    cols = [(c, imp[c]) for c in MODEL_NUMERIC] + \
           [(f"{c}_{v}", f"CASE WHEN coalesce({c}, 0) = {v} THEN 1.0 ELSE 0.0 END") for c, v in _OH]
    pos = {n: i for i, (n, _) in enumerate(cols)}
    lf = " UNION ALL ".join(f"SELECT '{n}' AS feature, {pos[n]} AS pos, is_default AS side, {e} AS value FROM tr, med"
                            for n, e in cols)
    return with_base(
        _train_sql(),
        "med AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in MODEL_NUMERIC) + " FROM tr)",
        f"lf AS ({lf})",
        """per AS (SELECT feature, pos, side, count(value) AS nk, avg(value) AS mk, var_pop(value) AS vk
        FROM lf GROUP BY feature, pos, side),
tot AS (SELECT feature, sum(nk) AS n, count(*) AS k, sum(nk * mk) / sum(nk) AS gm FROM per GROUP BY feature),
fs AS (SELECT per.feature, any_value(pos) AS pos,
              (sum(nk * (mk - gm) * (mk - gm)) / (any_value(k) - 1)) / nullif(sum(nk * vk) / (any_value(n) - any_value(k)), 0) AS f
       FROM per JOIN tot ON per.feature = tot.feature GROUP BY per.feature),
rk AS (SELECT feature, pos, f, row_number() OVER (ORDER BY coalesce(f, -1.0) DESC, pos) AS rank FROM fs)""")


@register("select_k_best", _kbest_sql() + f"""
SELECT feature, {B.r('f', 4)} AS f_statistic, CAST(rank AS INTEGER) AS rank FROM rk WHERE rank <= 20""")
def q_select_k_best(spark, sf_dir):
    train, _ = splits(spark, sf_dir)
    st = PR.fit_prep(train)
    rows = PR.select_k_best(st)
    df = spark.createDataFrame(rows, "feature string, f_statistic double, rank int")
    return df.select("feature", rnd(F.col("f_statistic"), 4).alias("f_statistic"), "rank")


@register("feature_names", _kbest_sql() + """
SELECT CAST(row_number() OVER (ORDER BY pos) - 1 AS INTEGER) AS position, feature FROM rk WHERE rank <= 20""")
def q_feature_names(spark, sf_dir):
    train, _ = splits(spark, sf_dir)
    st = PR.fit_prep(train)
    return spark.createDataFrame(list(enumerate(st.selected)), "position int, feature string")


@register("class_weight_balanced", with_base(_train_sql()) + f"""
SELECT is_default AS class, CAST(count(*) AS BIGINT) AS n,
       {B.r('(SELECT count(*) FROM tr) / (2.0 * count(*))')} AS weight FROM tr GROUP BY is_default""")
def q_class_weight_balanced(spark, sf_dir):
    train, _ = splits(spark, sf_dir)
    w = TR.class_weights(train)
    return w.select("class", "n", rnd(F.col("weight")).alias("weight"))


@register("stratified_kfold", with_base(_train_sql()) + """
SELECT ID, CAST(CAST(('0x' || substr(md5(CAST(ID AS VARCHAR) || ':42'), 1, 8)) AS BIGINT) % 3 AS INTEGER) AS fold
FROM tr""")
def q_stratified_kfold(spark, sf_dir):
    train, _ = splits(spark, sf_dir)
    return kfold_column(train, 3, 42).select("ID", "fold")


@register("stratified_kfold_exact", with_base(_train_sql()) + """
SELECT ID, CAST((row_number() OVER (PARTITION BY is_default ORDER BY h) - 1) % 3 AS INTEGER) AS fold
FROM (SELECT ID, is_default, CAST(('0x' || substr(md5(CAST(ID AS VARCHAR) || ':42'), 1, 13)) AS BIGINT) AS h FROM tr)""")
def q_stratified_kfold_exact(spark, sf_dir):
    """Folds whose sizes differ by one row at most in every class."""
    train, _ = splits(spark, sf_dir)
    return kfold_column(train, 3, 42, label=LABEL).select("ID", "fold")


# --- models ------------------------------------------------------------------------
def _assembled_sql():
    imp = {c: f"coalesce(CAST({c} AS DOUBLE), m_{c})" for c in MODEL_NUMERIC}
    pos = {n: i for i, n in enumerate([*MODEL_NUMERIC, *[f"{c}_{v}" for c, v in _OH]])}
    cells = [(c, f"({imp[c]} - a_{c}) / (CASE WHEN s_{c} = 0 THEN 1.0 ELSE s_{c} END)") for c in MODEL_NUMERIC] + \
            [(f"{c}_{v}", f"CASE WHEN coalesce({c}, 0) = {v} THEN 1.0 ELSE 0.0 END") for c, v in _OH]
    x = " UNION ALL ".join(f"SELECT ID, {pos[n]} AS pos, {e} AS v FROM te, med, st" for n, e in cells)
    stats = ", ".join(f"avg({imp[c]}) AS a_{c}, stddev_pop({imp[c]}) AS s_{c}" for c in MODEL_NUMERIC)
    return _kbest_sql().rstrip() + f""",
st AS (SELECT {stats} FROM tr, med), te AS (SELECT * FROM splitf WHERE side = 1), x AS ({x})
SELECT ID, list(round(v, 6) + 0.0 ORDER BY x.pos) AS features FROM x JOIN rk ON x.pos = rk.pos WHERE rank <= 20 GROUP BY ID"""


@register("assemble_features", _assembled_sql())
def q_assemble_features(spark, sf_dir):
    """The prepared, selected features of the test rows, as an array."""
    train, test = splits(spark, sf_dir)
    out = PR.prep_model(PR.fit_prep(train)).transform(test)
    return out.select("ID", F.transform(vector_to_array("features"), lambda x: F.round(x, 6) + F.lit(0.0)).alias("features"))


_LEVEL_COLS = ["AGE_GROUP", "ID"]


@register("level_positions", with_base(_train_sql()) + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, level, CAST(row_number() OVER (ORDER BY level) - 1 AS BIGINT) AS position "
    f"FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS level FROM tr WHERE {c} IS NOT NULL)" for c in _LEVEL_COLS))
def q_level_positions(spark, sf_dir):
    """The level table of a string column and of one with a level a row."""
    train, _ = splits(spark, sf_dir)
    return LV.fit_levels(train, _LEVEL_COLS).levels


_AGE_LEVELS = "(SELECT list(DISTINCT AGE_GROUP ORDER BY AGE_GROUP) FROM tr WHERE AGE_GROUP IS NOT NULL)"


@register("one_hot_strings", with_base(_train_sql()) + f"""
SELECT ID, list_transform({_AGE_LEVELS}, lambda g: CASE WHEN g = AGE_GROUP THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS age_levels
FROM splitf WHERE side = 1""")
def q_one_hot_strings(spark, sf_dir):
    """A string column one-hot encoded by its level table; levels from the training rows."""
    train, test = splits(spark, sf_dir)
    out = LV.fit_levels(train, ["AGE_GROUP"]).transform(test)
    return out.select("ID", vector_to_array("AGE_GROUP_levels").alias("age_levels"))


def _fit_predict(spark, sf_dir, model_type, params):
    train, test = splits(spark, sf_dir)
    model, _ = TR.fit_model(train, model_type, params)
    return TR.predict(model, test)


_TEST_SQL = "SELECT ID, is_default, TRUE AS in_range, TRUE AS by_threshold FROM splitf WHERE side = 1"


def _properties(pred):
    """What holds for every prediction, row by row: a probability, and the class
    that it stands for (a tie at one half may go either way)."""
    p = F.col("probability")
    return pred.select("ID", LABEL, ((p >= 0) & (p <= 1)).alias("in_range"),
                       (((p > 0.5) == (F.col("prediction") == 1)) | (F.abs(p - 0.5) < 1e-9)).alias("by_threshold"))


_FITS = {"logistic": {"C": 0.1, "class_weight": "balanced", "max_iter": 1000},
         "random_forest": {"n_estimators": 100, "max_depth": 10, "class_weight": "balanced", "random_state": 42},
         "gradient_boosting": {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 3, "random_state": 42}}


@register("train_properties", with_base(_train_sql()) + "SELECT m AS model_type, t.* FROM (" + _TEST_SQL + """) t,
(SELECT unnest(['logistic', 'random_forest', 'gradient_boosting']) AS m)""")
def q_train_properties(spark, sf_dir):
    """One prediction per test row from each family, in range and on the right side of one half."""
    train, test = splits(spark, sf_dir)
    data = TR.prepare_parts(train, test)
    try:
        models = TR.in_parallel([lambda m=m, p=p: TR.fit_classifier(data, m, p) for m, p in _FITS.items()], len(_FITS))
    finally:
        TR.release(data)
    out = [_properties(TR.classified(model, data.valid)).select(F.lit(m).alias("model_type"), "*")
           for m, model in zip(_FITS, models)]
    return out[0].unionByName(out[1]).unionByName(out[2])


@register("train_logistic")
def q_train_logistic(spark, sf_dir):
    return _fit_predict(spark, sf_dir, "logistic", {"C": 0.1, "class_weight": "balanced", "max_iter": 1000})


@register("train_random_forest")
def q_train_random_forest(spark, sf_dir):
    return _fit_predict(spark, sf_dir, "random_forest", {"n_estimators": 100, "max_depth": 10,
                                                         "class_weight": "balanced", "random_state": 42})


@register("train_gradient_boosting")
def q_train_gradient_boosting(spark, sf_dir):
    return _fit_predict(spark, sf_dir, "gradient_boosting", {"n_estimators": 100, "learning_rate": 0.1,
                                                             "max_depth": 3, "random_state": 42})


def _run_store(spark):
    """The session's run store: queries of one session on the same input share
    what is fitted (rows are keyed by a fingerprint of the input)."""
    return TR.RunStore(spark, f"{ensure_checkpoint_dir(spark)}/riskloom-runs")


def _folded(spark, sf_dir):
    train, test = splits(spark, sf_dir)
    return kfold_column(train, 3, 42), test


@register("grid_search")
def q_grid_search(spark, sf_dir):
    """Every setting of the searched experiments; ``best`` is the best of its family."""
    train, _ = _folded(spark, sf_dir)
    found = TR.best_parameters(train, TR.DEFAULT_EXPERIMENTS, 3, store=_run_store(spark))
    rows = [(ex.model_type, str(sorted(p.items())), float(a), p == max(got, key=lambda t: t[1])[0])
            for ex, got in zip(TR.DEFAULT_EXPERIMENTS, found) for p, a in got]
    return spark.createDataFrame(rows, "model_type string, params string, mean_roc_auc double, best boolean")


LOG_SCHEMA = T.StructType(TR.RunStore.MODELS.fields[:-1])


def _run(spark, sf_dir):
    """The experiment log for ``sf_dir``, one row per experiment."""
    train, test = _folded(spark, sf_dir)
    log, model, name = TR.run_experiments(train, test, TR.DEFAULT_EXPERIMENTS, folds=3, store=_run_store(spark))
    rows = [tuple(r[f.name] for f in LOG_SCHEMA.fields) for r in log]
    return spark.createDataFrame(rows, LOG_SCHEMA), model, name


@register("run_experiments")
def q_run_experiments(spark, sf_dir):
    return _run(spark, sf_dir)[0]


def _experiment_table(spark, sf_dir):
    """The run appended to the report table, as the run of its day."""
    table = ReportTable(spark, f"{ensure_checkpoint_dir(spark)}/riskloom-log", T.StructType(
        [*LOG_SCHEMA.fields, T.StructField("started_at", T.TimestampType())]))
    log = _run(spark, sf_dir)[0].withColumn("started_at", F.current_timestamp())
    run = TR.RunStore.key(sf_dir, [ex.name for ex in TR.DEFAULT_EXPERIMENTS])
    table.commit(log, datetime.now(timezone.utc).date(), run)
    return table, run


@register("experiment_log")
def q_experiment_log(spark, sf_dir):
    """The run's rows of the append-only log, read from the newest day."""
    table, run = _experiment_table(spark, sf_dir)
    return table.newest_day().filter(F.col("run") == run).drop("day", "run")


@register("best_run")
def q_best_run(spark, sf_dir):
    table, run = _experiment_table(spark, sf_dir)
    log = table.newest_day().filter(F.col("run") == run)
    return log.orderBy(F.col("roc_auc").desc_nulls_last(), "started_at", "name").limit(1).select(*LOG_SCHEMA.names)


@register("experiment_properties", """
SELECT name, model_type, searched AS use_grid_search, TRUE AS metrics_in_range, TRUE AS f1_agrees, CAST(fits AS BIGINT) AS fold_fits
FROM (VALUES ('Logistic Regression - GridSearch', 'logistic', TRUE, 9), ('Random Forest - GridSearch', 'random_forest', TRUE, 12),
             ('Gradient Boosting - GridSearch', 'gradient_boosting', TRUE, 24), ('Logistic Regression - Balanced', 'logistic', FALSE, 0),
             ('Random Forest - Default', 'random_forest', FALSE, 0)) AS t(name, model_type, searched, fits),
     (SELECT count(*) > 0 AS has_rows FROM orders) WHERE has_rows""")
def q_experiment_properties(spark, sf_dir):
    """The run's rows: all experiments, metrics in range, F1 the harmonic mean of
    precision and recall, and the fold fits that the run store holds for each search."""
    train, test = _folded(spark, sf_dir)
    store = _run_store(spark)
    log, _, _ = TR.run_experiments(train, test, TR.DEFAULT_EXPERIMENTS, folds=3, store=store)
    mark = TR.fingerprint(train)
    keys = [(ex.name, store.key("fit", mark, ex.model_type, {k: str(v) for k, v in {**ex.base_params, **g}.items()}, 3, f,
                                "fold", LABEL, 20))
            for ex in TR.DEFAULT_EXPERIMENTS if ex.use_grid_search for g in TR.grid(TR.PARAM_GRIDS[ex.model_type]) for f in range(3)]
    held = spark.createDataFrame(keys, "name string, run string").join(store.fits.read().select("run"), "run") \
        .groupBy("name").agg(F.count(F.lit(1)).alias("fold_fits"))
    rows = spark.createDataFrame([tuple(r[f.name] for f in LOG_SCHEMA.fields) for r in log], LOG_SCHEMA)
    unit = [F.col(c).between(0, 1) for c in ("roc_auc", "precision", "recall", "f1", "accuracy")]
    both = F.col("precision") + F.col("recall")
    mean = F.when(both == 0, F.lit(0.0)).otherwise(F.try_divide(2 * F.col("precision") * F.col("recall"), both))
    return rows.join(held, "name", "left").select(
        "name", "model_type", "use_grid_search", (unit[0] & unit[1] & unit[2] & unit[3] & unit[4]).alias("metrics_in_range"),
        (F.abs(F.col("f1") - mean) < 1e-9).alias("f1_agrees"), F.coalesce("fold_fits", F.lit(0)).alias("fold_fits"))


@register("feature_importance_topk")
def q_feature_importance_topk(spark, sf_dir):
    train, _ = splits(spark, sf_dir)
    model, _ = TR.fit_model(train, "random_forest", {"n_estimators": 100, "max_depth": 10, "random_state": 42})
    imp = spark.createDataFrame(TR.feature_importances(model), "feature string, importance double")
    tot = imp.agg(F.sum("importance").alias("total"), F.max("importance").alias("max_importance"),
                  F.min("importance").alias("min_importance"))
    top = imp.orderBy(F.col("importance").desc(), "feature").limit(15)
    from pyspark.sql import Window
    return (top.withColumn("rank", F.row_number().over(Window.orderBy(F.col("importance").desc(), "feature")))
            .crossJoin(tot))


def _saved_model(spark, sf_dir):
    train, test = splits(spark, sf_dir)
    model, _ = TR.fit_model(train, "logistic", {"C": 0.1, "class_weight": "balanced", "max_iter": 1000})
    path = scratch_path(spark, "model")
    model.write().overwrite().save(path)
    return path, test


@register("save_model")
def q_save_model(spark, sf_dir):
    path, test = _saved_model(spark, sf_dir)
    return spark.createDataFrame([(path,)], "path string")


@register("model_round_trip", with_base(_train_sql()) + """
SELECT ID, is_default, TRUE AS same FROM splitf WHERE side = 1""")
def q_model_round_trip(spark, sf_dir):
    """Per test row: the loaded model's probability and class are the unsaved model's."""
    train, test = splits(spark, sf_dir)
    model, _ = TR.fit_model(train, "logistic", _FITS["logistic"])
    path = scratch_path(spark, "model")
    model.write().overwrite().save(path)
    cols = lambda df, n: df.select("ID", LABEL, F.struct("prediction", "probability").alias(n))
    a, b = cols(TR.predict(model, test), "a"), cols(TR.predict(PipelineModel.load(path), test), "b")
    return a.join(b, ["ID", LABEL]).select("ID", LABEL, (F.col("a") == F.col("b")).alias("same"))


@register("load_model")
def q_load_model(spark, sf_dir):
    path, test = _saved_model(spark, sf_dir)
    return TR.predict(PipelineModel.load(path), test)


def score_batch(model: PipelineModel, records, label=None):
    """ID, prediction, probability, risk_level, model_status — one row per
    request row: features (same formulas as training) → model, one narrow
    transform, no shuffle."""
    p = TR.predict(model, build_features(clean_codes(records)), label)
    return p.select("ID", "prediction", "probability", risk_level(F.col("probability")).alias("risk_level"),
                    F.lit("trained").alias("model_status"))


def score_rules(records):
    p = rule_score(F.col("PAY_0"), F.col("LIMIT_BAL"))
    return records.select("ID", F.when(p > 0.5, 1).otherwise(0).alias("prediction"), p.alias("probability"),
                          risk_level(p).alias("risk_level"), F.lit("rules").alias("model_status"))


def _scored(spark, sf_dir):
    train, _ = splits(spark, sf_dir)
    model, _ = TR.fit_model(train, "logistic", _FITS["logistic"])
    return score_batch(model, B.cleaned(spark, sf_dir).drop(LABEL, "is_test"))


@register("score_batch")
def q_score_batch(spark, sf_dir):
    return _scored(spark, sf_dir)


@register("score_batch_properties", with_base() + """
SELECT ID, TRUE AS by_threshold, TRUE AS by_band, 'trained' AS model_status FROM clean""")
def q_score_batch_properties(spark, sf_dir):
    """One row per request; class and risk band are those of its probability."""
    p = F.col("probability")
    edge = F.least(*[F.abs(p - x) for x in (0.1, 0.2, 0.4, 0.5, 0.6)]) < 1e-9
    return _scored(spark, sf_dir).select(
        "ID", (((p > 0.5) == (F.col("prediction") == 1)) | edge).alias("by_threshold"),
        ((F.col("risk_level") == risk_level(p)) | edge).alias("by_band"), "model_status")


@register("score_rules", with_base() + """
SELECT ID, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS prediction, p AS probability,
       CASE WHEN p < 0.1 THEN 'very low' WHEN p < 0.2 THEN 'low' WHEN p < 0.4 THEN 'medium'
            WHEN p < 0.6 THEN 'high' ELSE 'very high' END AS risk_level, 'rules' AS model_status
FROM (SELECT ID, CAST(CASE WHEN PAY_0 <= 0 AND LIMIT_BAL > 100000 THEN 0.05
                           WHEN PAY_0 <= 1 AND LIMIT_BAL > 50000 THEN 0.15
                           WHEN PAY_0 >= 2 OR LIMIT_BAL < 20000 THEN 0.75 ELSE 0.3 END AS DOUBLE) AS p FROM clean)""")
def q_score_rules(spark, sf_dir):
    return score_rules(B.cleaned(spark, sf_dir))
