"""Training and comparison of default classifiers (§2.8) with pyspark.ml.

Each fit is one distributed Spark ML job. A comparison prepares every fold once
(preparation is fitted inside the fold), writes its features, and submits the
fits of all settings from a few driver threads; each result is committed to a
run store, so an ended comparison goes on where it stopped.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import threading
import time
from collections.abc import Callable
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from contextlib import nullcontext
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark import SparkContext, StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (GBTClassificationModel, GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import LABEL
from ..session import delete_on_exit, scratch_path
from .evaluate import class_metrics, roc_auc
from .prep import PrepState, fit_prep, prep_stages
from .reports import ReportTable
from .trees import TASK_ROWS, fit_in_one_task, wrapped

MAX_DEPTH = 30   # Spark's limit; stands for "unlimited"
CACHED_DEPTH = 15   # deeper forests keep each row's nodes instead of walking every tree again at each level
CACHED_ROWS = 100_000   # so do forests on more rows, whatever their depth
ROWS_PER_TASK = 50_000
SMALL_ROWS = 200_000   # a forest's bags and nodes take about 1.2 KB a row and 200 trees
MAX_WORKERS = 48


def class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Balanced weights n / (K · n_c) per class."""
    c = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    tot = c.agg(F.sum("n").alias("_t"), F.count(F.lit(1)).alias("_k"))
    return (c.crossJoin(F.broadcast(tot))
            .select(F.col(label).alias("class"), "n", (F.col("_t") / (F.col("_k") * F.col("n"))).alias("weight")))


def with_weights(df: DataFrame, label: str = LABEL, balanced: bool = True, col: str = "weight") -> DataFrame:
    if not balanced:
        return df.withColumn(col, F.lit(1.0))
    w = class_weights(df, label).select(F.col("class").alias(label), F.col("weight").alias(col))
    return df.join(F.broadcast(w), label)     # ≤ #classes rows


def make_classifier(model_type: str, params: dict, n_weighted: float | None = None, label: str = LABEL,
                    rows: int = 0):
    """Spark estimator for a source-style parameter set, for a table of ``rows`` rows."""
    p = dict(params)
    if model_type == "logistic":
        c = float(p.get("C", 1.0))
        balanced = p.get("class_weight") == "balanced"
        # ½‖w‖² + C·Σ wᵢ·lossᵢ  ≡  regParam/2·‖w‖² + (1/Σw)·Σ wᵢ·lossᵢ with regParam = 1/(C·Σw)
        reg = 1.0 / (c * n_weighted) if n_weighted else 0.0
        est = LogisticRegression(featuresCol="features", labelCol=label, regParam=reg, elasticNetParam=0.0,
                                 standardization=False, maxIter=int(p.get("max_iter", 100)),
                                 tol=float(p.get("tol", 1e-4)))   # the source solver's stopping tolerance
        return est.setWeightCol("weight") if balanced else est
    if model_type == "random_forest":
        depth = p.get("max_depth")
        est = RandomForestClassifier(featuresCol="features", labelCol=label,
                                     numTrees=int(p.get("n_estimators", 100)),
                                     maxDepth=int(depth) if depth else MAX_DEPTH, seed=int(p.get("random_state", 42)))
        deep = est.getMaxDepth() > CACHED_DEPTH
        est.setCacheNodeIds(deep or rows > CACHED_ROWS)   # the same trees
        if not deep:
            est.setCheckpointInterval(-1)   # a few levels of lineage are not worth a written copy of the nodes
        if p.get("class_weight") == "balanced":
            est.setWeightCol("weight")
        return est
    if model_type == "gradient_boosting":
        return GBTClassifier(featuresCol="features", labelCol=label, maxIter=int(p.get("n_estimators", 100)),
                             stepSize=float(p.get("learning_rate", 0.1)), maxDepth=int(p.get("max_depth", 3)),
                             seed=int(p.get("random_state", 42)))
    raise ValueError(f"unknown model type {model_type}")


def fit_model(train: DataFrame, model_type: str, params: dict, label: str = LABEL, k: int = 20,
              state: PrepState | None = None) -> tuple[PipelineModel, PrepState]:
    """Fit preparation (unless given) and classifier; returns the whole
    fitted pipeline (preparation + model) and the preparation state."""
    state = state or fit_prep(train, label=label, k=k)
    balanced = params.get("class_weight") == "balanced"
    stages = prep_stages(state, keep=(label, "weight", "ID"))
    # the prepared features are kept, not the raw columns: every pass of the fit reads them ready
    data = (PipelineModel(stages=stages).transform(with_weights(train, label, balanced))
            .select(label, "weight", "features").persist(StorageLevel.MEMORY_AND_DISK))
    try:
        n_w, rows = None, 0
        if model_type == "logistic":
            n_w = data.agg(F.sum("weight")).collect()[0][0]
        elif model_type == "random_forest":
            rows = data.count()
        return PipelineModel(stages=stages + [make_classifier(model_type, params, n_w, label, rows).fit(data)]), state
    finally:
        data.unpersist()


def predict(model: PipelineModel, df: DataFrame, label: str | None = LABEL) -> DataFrame:
    """(ID, [label], prediction, probability of class 1)."""
    d = df.withColumn("weight", F.lit(1.0)) if "weight" not in df.columns else df
    if LABEL not in d.columns:       # the fitted statement carries the label through
        d = d.withColumn(LABEL, F.lit(None).cast("int"))
    out = model.transform(d)
    cols = ["ID"] + ([label] if label else [])
    return out.select(*cols, F.col("prediction").cast("int").alias("prediction"),
                      vector_to_array("probability")[1].alias("probability"))


def evaluate_model(model: PipelineModel, test: DataFrame, label: str = LABEL) -> dict:
    pred = predict(model, test, label)
    auc = roc_auc(pred, label, "probability").collect()[0]["roc_auc"]
    m = class_metrics(pred, label, "prediction").collect()[0].asDict()
    return {"roc_auc": auc, **m}


@dataclass
class Prepared:
    """A training and a validation part with prepared features, written once:
    every setting is fitted and scored on the same files."""

    train: DataFrame
    valid: DataFrame
    n: int
    state: PrepState | None = None


def _fit_parts(rows: int) -> int:
    """Tasks of one fit: each has up to ``ROWS_PER_TASK`` rows. Boosting and
    forests run several jobs per level, so a small table spread over every core
    spends its time on scheduling."""
    return max(1, -(-rows // ROWS_PER_TASK))


def prepare_parts(train: DataFrame, valid: DataFrame, label: str = LABEL, k: int = 20,
                  state: PrepState | None = None) -> Prepared:
    """Preparation fitted on ``train`` (unless given); both parts transformed
    and written to the shared folder with balanced weights."""
    spark = train.sparkSession
    state = state or fit_prep(train, label=label, k=k)
    stage = PipelineModel(stages=prep_stages(state, keep=(label, "weight", "ID")))
    weighted = with_weights(train, label)
    path = scratch_path(spark, "prepared")
    for name, part in (("train", weighted), ("valid", valid.withColumn("weight", F.lit(1.0)))):
        stage.transform(part).select("ID", label, "weight", "features").write.parquet(f"{path}/{name}")
    tr, va = (spark.read.parquet(f"{path}/{name}") for name in ("train", "valid"))
    n = tr.count()
    parts = _fit_parts(n)
    if tr.rdd.getNumPartitions() > parts:
        tr, va = tr.coalesce(parts), va.coalesce(parts)
    delete_on_exit(spark, path)
    if parts > 1:   # one task's rows are read from the files: persisted, they lie on one executor, where all fits queue
        tr, va = tr.persist(StorageLevel.MEMORY_AND_DISK), va.persist(StorageLevel.MEMORY_AND_DISK)
    return Prepared(tr, va, n, state)


def release(parts: Prepared) -> None:
    parts.train.unpersist()
    parts.valid.unpersist()


def first_trees(model: GBTClassificationModel, n: int) -> GBTClassificationModel:
    """The boosted model after its first ``n`` trees. Boosting adds one tree at a
    time and never changes an earlier one, so this is the model that a fit with
    ``n`` rounds gives."""
    if n >= model.getNumTrees:
        return model
    java, gateway = model._java_obj, SparkContext._active_spark_context._gateway
    ml = gateway.jvm.org.apache.spark.ml
    trees, weights = java.trees(), java.treeWeights()
    few = gateway.new_array(ml.regression.DecisionTreeRegressionModel, n)
    some = gateway.new_array(gateway.jvm.double, n)
    for i in range(n):
        few[i], some[i] = trees[i], weights[i]
    made = ml.classification.GBTClassificationModel(f"{java.uid()}_{n}", few, some, java.numFeatures(), java.numClasses())
    return wrapped(GBTClassificationModel, java.copyValues(made, java.extractParamMap()))


def fit_classifier(parts: Prepared, model_type: str, params: dict, label: str = LABEL):
    """The classifier alone, on prepared features. Balanced weights add up to
    the number of rows, so the logistic penalty needs no job of its own. Trees of
    a table that fits one task are grown by one task."""
    est = make_classifier(model_type, params, float(parts.n), label, parts.n)
    model = None
    if model_type != "logistic" and parts.n <= TASK_ROWS:
        model = fit_in_one_task(est, model_type, parts.train, label)
    return model if model is not None else est.fit(parts.train)


def classified(model, prepared: DataFrame, label: str = LABEL) -> DataFrame:
    """(ID, label, prediction, probability of class 1) of prepared rows."""
    return model.transform(prepared).select("ID", label, F.col("prediction").cast("int").alias("prediction"),
                                            vector_to_array("probability")[1].alias("probability"))


def valid_auc(model, parts: Prepared, label: str = LABEL) -> float:
    """Exact area under the ROC curve on the validation part (no bins, ties half)."""
    scored = model.transform(parts.valid).select(F.col(label).cast("double").alias(label), "rawPrediction")
    return BinaryClassificationEvaluator(rawPredictionCol="rawPrediction", labelCol=label, numBins=0).evaluate(scored)


def in_parallel(jobs: list[Callable[[], object]], workers: int, pool: str = "fits") -> list:
    """Results of ``jobs``, each run by a driver thread that submits its Spark
    jobs to one fair scheduling pool. After a failure no further job starts."""
    sc = SparkContext._active_spark_context

    def run(job):
        sc.setLocalProperty("spark.scheduler.pool", pool)
        return job()
    with ThreadPoolExecutor(max(1, workers)) as threads:
        futures = [threads.submit(run, j) for j in jobs]
        _, rest = wait(futures, return_when=FIRST_EXCEPTION)
        for f in rest:
            f.cancel()
        return [f.result() for f in futures if not f.cancelled()]


def fit_workers(spark, rows: int = 0) -> int:
    """Fits that run side by side: ``spark.riskloom.fits.parallel``, else 8, and
    more for a small table, whose fits are one short task after another: they
    wait for the scheduler, not for cores."""
    few = 3 * spark.sparkContext.defaultParallelism // _fit_parts(rows)
    return int(spark.conf.get("spark.riskloom.fits.parallel", str(max(8, min(few, MAX_WORKERS)))))


def forest_slots(spark, workers: int, rows: int = 0) -> threading.Semaphore:
    """Forests that grow at once: their tasks are long, and on half of the cores
    they leave the other half to the short tasks of boosting. A forest of few rows
    is one task of little memory, and boosting one task too: those have all cores."""
    cores = spark.sparkContext.defaultParallelism
    return threading.Semaphore(max(1, min(workers - 1, cores if 0 < rows <= SMALL_ROWS else cores // 2)))


def fingerprint(df: DataFrame) -> str:
    """Count and order-free hash of the rows and the column names of ``df``."""
    cols = sorted(df.columns)
    r = df.agg(F.count(F.lit(1)).alias("n"),
               F.sum(F.xxhash64(*[F.col(c) for c in cols]).cast("decimal(38,0)")).alias("h")).collect()[0]
    return f"{r['n']}:{r['h']}:{','.join(cols)}"


class RunStore:
    """What a comparison of models has finished: a row per fitted fold and
    setting, a row per compared model, and the models. Each is committed when
    it is ready under a key of its settings and inputs, so a run that was ended
    goes on where it stopped."""

    FITS = T.StructType([T.StructField("model_type", T.StringType()),
                         T.StructField("params", T.MapType(T.StringType(), T.StringType())),
                         T.StructField("fold", T.IntegerType()), T.StructField("roc_auc", T.DoubleType()),
                         T.StructField("seconds", T.DoubleType()), T.StructField("finished_at", T.TimestampType())])
    MODELS = T.StructType([T.StructField("name", T.StringType()), T.StructField("model_type", T.StringType()),
                           T.StructField("use_grid_search", T.BooleanType()),
                           T.StructField("params", T.MapType(T.StringType(), T.StringType())),
                           T.StructField("roc_auc", T.DoubleType()), T.StructField("precision", T.DoubleType()),
                           T.StructField("recall", T.DoubleType()), T.StructField("f1", T.DoubleType()),
                           T.StructField("accuracy", T.DoubleType()), T.StructField("seconds", T.DoubleType()),
                           T.StructField("finished_at", T.TimestampType())])

    def __init__(self, spark, path: str):
        self.spark, self.path = spark, path
        self.fits = ReportTable(spark, f"{path}/fits", self.FITS)
        self.models = ReportTable(spark, f"{path}/models", self.MODELS)

    @staticmethod
    def key(*parts) -> str:
        return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()[:32]

    def model_path(self, key: str) -> str:
        return f"{self.path}/saved/{key}"

    def done(self, table: ReportTable) -> dict[str, dict]:
        """The committed rows by key: one per fit or model, so bounded by the plan."""
        return {r["run"]: r.asDict() for r in table.read().collect()}

    def commit(self, table: ReportTable, key: str, row: dict) -> None:
        def value(v):
            if isinstance(v, dict):
                return F.create_map(*[F.lit(x) for kv in v.items() for x in kv])
            return F.lit(v)
        cols = [value(row.get(f.name)).cast(f.dataType).alias(f.name) for f in table.schema.fields[:-1]]
        table.commit(self.spark.range(1).select(*cols, F.current_timestamp().alias("finished_at")),
                     datetime.now(timezone.utc).date(), key)


def _text(params: dict) -> dict[str, str]:
    return {k: str(v) for k, v in params.items()}


def search_settings(train: DataFrame, settings: list[tuple[str, dict]], folds: int = 3, fold_col: str = "fold",
                    label: str = LABEL, k: int = 20, store: RunStore | None = None,
                    workers: int | None = None, forests: threading.Semaphore | None = None) -> list[float]:
    """Mean ROC-AUC over the folds of each (model type, parameters).

    Preparation is fitted on each fold's training part and its features are
    written once. Fits run side by side; boosted settings that differ only in
    their number of trees come from one fit with the most (``first_trees``).
    Each fold's result is committed to ``store``; what it holds is not refitted.
    """
    spark = train.sparkSession
    store = store or RunStore(spark, scratch_path(spark, "fits"))
    mark = fingerprint(train)
    workers = workers or fit_workers(spark, int(mark.split(":")[0]))
    forests = forests or forest_slots(spark, workers, int(mark.split(":")[0]))
    keys = {(i, f): store.key("fit", mark, m, _text(p), folds, f, fold_col, label, k)
            for i, (m, p) in enumerate(settings) for f in range(folds)}
    done = {key: row["roc_auc"] for key, row in store.done(store.fits).items()}
    missing = [at for at, key in keys.items() if key not in done]
    parts: dict[int, Prepared] = {}
    try:
        needed = sorted({f for _, f in missing})
        made = in_parallel([lambda f=f: prepare_parts(train.filter(F.col(fold_col) != f),
                                                      train.filter(F.col(fold_col) == f), label, k)
                            for f in needed], workers)
        parts = dict(zip(needed, made))
        groups: dict[str, list[tuple[int, int]]] = {}
        for i, f in missing:
            m, p = settings[i]
            staged = {n: v for n, v in p.items() if n != "n_estimators"} if m == "gradient_boosting" else p
            groups.setdefault(store.key(m, _text(staged), f), []).append((i, f))

        def fit(group: list[tuple[int, int]]) -> dict[str, float]:
            model_type, data = settings[group[0][0]][0], parts[group[0][1]]
            t0 = time.time()
            biggest = max((settings[i][1] for i, _ in group), key=lambda p: p.get("n_estimators", 0))
            with forests if model_type == "random_forest" else nullcontext():
                model, out = fit_classifier(data, model_type, biggest, label), {}
            for i, f in group:
                params = settings[i][1]
                staged = first_trees(model, params["n_estimators"]) if model_type == "gradient_boosting" else model
                out[keys[i, f]] = auc = valid_auc(staged, data, label)
                store.commit(store.fits, keys[i, f], {"model_type": model_type, "params": _text(params), "fold": f,
                                                      "roc_auc": auc, "seconds": time.time() - t0})
            return out
        cost = {"gradient_boosting": 0, "random_forest": 1}   # the longest fits start first
        ordered = sorted(groups.values(), key=lambda g: cost.get(settings[g[0][0]][0], 2))
        for got in in_parallel([lambda g=g: fit(g) for g in ordered], workers):
            done.update(got)
    finally:
        for data in parts.values():
            release(data)
    return [sum(done[keys[i, f]] for f in range(folds)) / folds for i in range(len(settings))]


# The source's grids and experiments.
PARAM_GRIDS = {
    "logistic": {"C": [0.1, 1.0, 10.0], "class_weight": ["balanced"]},
    "random_forest": {"n_estimators": [100, 200], "max_depth": [10, 15], "class_weight": ["balanced"]},
    "gradient_boosting": {"n_estimators": [100, 200], "learning_rate": [0.1, 0.2], "max_depth": [3, 5]},
}


def grid(params_grid: dict) -> list[dict]:
    keys = list(params_grid)
    return [dict(zip(keys, vals)) for vals in itertools.product(*[params_grid[k] for k in keys])]


def grid_search(train: DataFrame, model_type: str, base: dict, params_grid: dict | None = None,
                folds: int = 3, label: str = LABEL, k: int = 20, store: RunStore | None = None,
                workers: int | None = None) -> tuple[dict, list[tuple[dict, float]]]:
    """Best parameters by mean fold ROC-AUC (first best wins), and all results."""
    tried = [{**base, **g} for g in grid(params_grid if params_grid is not None else PARAM_GRIDS[model_type])]
    aucs = search_settings(train, [(model_type, p) for p in tried], folds, "fold", label, k, store, workers)
    results = list(zip(tried, aucs))
    return max(results, key=lambda t: t[1])[0], results


@dataclass
class Experiment:
    name: str
    model_type: str
    use_grid_search: bool
    base_params: dict = field(default_factory=dict)
    grid: dict | None = None


DEFAULT_EXPERIMENTS = [
    Experiment("Logistic Regression - GridSearch", "logistic", True, {"random_state": 42, "max_iter": 1000}),
    Experiment("Random Forest - GridSearch", "random_forest", True, {"random_state": 42}),
    Experiment("Gradient Boosting - GridSearch", "gradient_boosting", True, {"random_state": 42}),
    Experiment("Logistic Regression - Balanced", "logistic", False,
               {"C": 0.1, "class_weight": "balanced", "random_state": 42, "max_iter": 1000}),
    Experiment("Random Forest - Default", "random_forest", False, {"n_estimators": 100, "random_state": 42}),
]


def best_parameters(train: DataFrame, experiments: list[Experiment], folds: int = 3, label: str = LABEL, k: int = 20,
                    store: RunStore | None = None, workers: int | None = None,
                    forests: threading.Semaphore | None = None) -> list[list[tuple[dict, float]]]:
    """The results of every searched experiment, all settings in one search."""
    tried = [[{**ex.base_params, **g} for g in grid(ex.grid if ex.grid is not None else PARAM_GRIDS[ex.model_type])]
             if ex.use_grid_search else [] for ex in experiments]
    flat = [(ex.model_type, p) for ex, ps in zip(experiments, tried) for p in ps]
    aucs = iter(search_settings(train, flat, folds, "fold", label, k, store, workers, forests) if flat else [])
    return [[(p, next(aucs)) for p in ps] for ps in tried]


def run_experiments(train: DataFrame, test: DataFrame, experiments=DEFAULT_EXPERIMENTS, folds: int = 3,
                    label: str = LABEL, k: int = 20, store: RunStore | None = None, workers: int | None = None):
    """Run each experiment; returns (log rows, best model, best name). The
    best is the first with the strictly highest test ROC-AUC. With the ``store``
    of an ended run, only what that run had not committed is done."""
    spark = train.sparkSession
    store = store or RunStore(spark, scratch_path(spark, "fits"))
    marks = fingerprint(train), fingerprint(test)
    workers = workers or fit_workers(spark, int(marks[0].split(":")[0]))
    forests = forest_slots(spark, workers, int(marks[0].split(":")[0]))
    done, data, lock = store.done(store.models), [], threading.Lock()
    params: dict[int, dict] = {i: dict(ex.base_params) for i, ex in enumerate(experiments) if not ex.use_grid_search}

    def key_of(i: int) -> str:
        ex = experiments[i]
        return store.key("model", marks, ex.name, ex.model_type, _text(params[i]), folds, label, k)

    def fit(i: int) -> None:
        ex, key = experiments[i], key_of(i)
        if key in done:
            return
        with lock:      # the whole training part is prepared once, by the first fit that needs it
            if not data:
                data.append(prepare_parts(train, test, label, k))
        t0, parts = time.time(), data[0]
        with forests if ex.model_type == "random_forest" else nullcontext():
            model = fit_classifier(parts, ex.model_type, params[i], label)
        scored = model.transform(parts.valid).select(label, F.col("prediction").cast("int").alias("prediction"))
        row = {"name": ex.name, "model_type": ex.model_type, "use_grid_search": ex.use_grid_search,
               "params": _text(params[i]), "roc_auc": valid_auc(model, parts, label),
               **class_metrics(scored, label, "prediction").collect()[0].asDict(), "seconds": time.time() - t0}
        whole = PipelineModel(stages=prep_stages(parts.state, keep=(label, "weight", "ID")) + [model])
        whole.write().overwrite().save(store.model_path(key))
        store.commit(store.models, key, row)
        done[key] = row

    def search() -> None:
        found = best_parameters(train, experiments, folds, label, k, store, workers, forests)
        for i, (ex, got) in enumerate(zip(experiments, found)):
            if ex.use_grid_search:
                params[i] = max(got, key=lambda t: t[1])[0] if got else dict(ex.base_params)
    # experiments without a search need not wait for it
    plain = [lambda i=i: fit(i) for i in sorted(params, key=lambda i: experiments[i].model_type != "random_forest")]
    try:
        in_parallel([search, *plain], workers)
        in_parallel([lambda i=i: fit(i) for i, ex in enumerate(experiments) if ex.use_grid_search], workers)
    finally:
        for parts in data:
            release(parts)
    keys = [key_of(i) for i in range(len(experiments))]
    log = [{n: done[key][n] for n in RunStore.MODELS.names if n in done[key]} for key in keys]
    best, auc = None, -1.0
    for key, row in zip(keys, log):
        if row["roc_auc"] is not None and row["roc_auc"] > auc:
            best, auc = key, row["roc_auc"]
    model = PipelineModel.load(store.model_path(best)) if best else None
    return log, model, log[keys.index(best)]["name"] if best else None


def feature_importances(model: PipelineModel) -> list[tuple[str, float]]:
    """(name, importance) of a tree model, names from the assembler."""
    asm = [s for s in model.stages if s.__class__.__name__ == "VectorAssembler"][0]
    clf = model.stages[-1]
    imp = clf.featureImportances.toArray().tolist()
    return list(zip(asm.getInputCols(), imp))
