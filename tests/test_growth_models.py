"""Fits that queue for one executor, forests walked from their roots at every
level, and searches that hold up what does not need them."""
import threading

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from riskloom.operators import train as TR
from riskloom.operators.twosample import anova_f
from riskloom.session import scratch_path


@pytest.fixture(scope="module")
def table(spark):
    rows = spark.range(600).select(F.col("id").alias("ID"), (F.col("id") % 7).cast("double").alias("AGE"),
                                   (F.col("id") % 5).cast("double").alias("LIMIT_BAL"),
                                   ((F.col("id") * 13) % 11).cast("double").alias("PAY_0"),
                                   ((F.col("id") % 7 + F.col("id") * 13 % 11) > 8).cast("int").alias("is_default"),
                                   (F.col("id") % 2).cast("int").alias("fold"))
    path = scratch_path(spark, "growth")
    rows.write.parquet(path)
    return spark.read.parquet(path)


def test_small_fits_do_not_queue(spark, table):
    """More fits than before side by side on a small table, as many on a large
    one; their rows are not held by one executor; the deepest trees keep nodes."""
    spark.conf.unset("spark.riskloom.fits.parallel")
    cores = spark.sparkContext.defaultParallelism
    assert TR.fit_workers(spark, 10_000) == max(8, min(3 * cores, TR.MAX_WORKERS))
    assert TR.fit_workers(spark, 100_000_000) == 8
    parts = TR.prepare_parts(table.filter("fold = 0"), table.filter("fold = 1"))
    assert not parts.train.is_cached and not parts.valid.is_cached
    assert TR.make_classifier("random_forest", {}).getCacheNodeIds()
    assert not TR.make_classifier("random_forest", {"max_depth": 10}).getCacheNodeIds()
    TR.release(parts)


def test_an_experiment_without_search_does_not_wait(spark, table, monkeypatch):
    """The model without a search is fitted while the search is still held up."""
    plain, whole = threading.Event(), TR.fit_classifier

    def fit(data, model_type, params, label="is_default"):
        if model_type == "random_forest":
            plain.set()
        else:
            assert plain.wait(120)
        return whole(data, model_type, params, label)
    monkeypatch.setattr(TR, "fit_classifier", fit)
    todo = [TR.Experiment("lr", "logistic", True, {"max_iter": 5}, {"C": [1.0]}),
            TR.Experiment("rf", "random_forest", False, {"n_estimators": 2, "max_depth": 2, "random_state": 42})]
    log, model, name = TR.run_experiments(table.filter("ID % 5 > 0"), table.filter("ID % 5 = 0"), todo, 2, workers=4)
    assert [r["name"] for r in log] == ["lr", "rf"] and name in ("lr", "rf") and isinstance(model, PipelineModel)


def test_forests_on_many_rows_keep_nodes(spark, table, monkeypatch):
    """A forest on a large table keeps each row's nodes whatever its depth, both
    ways of fitting say how many rows there are, and the trees stay the same."""
    params = {"n_estimators": 6, "max_depth": 4, "random_state": 42, "class_weight": "balanced"}
    large = TR.make_classifier("random_forest", params, rows=TR.CACHED_ROWS + 1)
    assert large.getCacheNodeIds() and large.getCheckpointInterval() == -1
    assert not TR.make_classifier("random_forest", params, rows=TR.CACHED_ROWS).getCacheNodeIds()
    parts = TR.prepare_parts(table.filter("fold = 0"), table.filter("fold = 1"))
    walked, whole = TR.fit_classifier(parts, "random_forest", params), TR.fit_model(table, "random_forest", params)[0]
    made, make = [], TR.make_classifier

    def spy(*args, **kwargs):
        made.append(make(*args, **kwargs))
        return made[-1]
    monkeypatch.setattr(TR, "CACHED_ROWS", 10)
    monkeypatch.setattr(TR, "make_classifier", spy)
    kept, again = TR.fit_classifier(parts, "random_forest", params), TR.fit_model(table, "random_forest", params)[0]
    assert [m.getCacheNodeIds() for m in made] == [True, True]
    for a, b in ((walked, kept), (whole.stages[-1], again.stages[-1])):
        assert a.toDebugString.splitlines()[1:] == b.toDebugString.splitlines()[1:]
    TR.release(parts)


def test_a_fit_keeps_prepared_features_only(spark, table, monkeypatch):
    """What a fit reads again and again are its features, not the raw columns."""
    kept, persist = [], type(table).persist

    def spy(df, *args):
        kept.append(df.columns)
        return persist(df, *args)
    monkeypatch.setattr(type(table), "persist", spy)
    model, _ = TR.fit_model(table, "random_forest", {"n_estimators": 2, "max_depth": 2, "random_state": 42})
    assert kept == [["is_default", "weight", "features"]]
    assert isinstance(model, PipelineModel) and TR.predict(model, table).count() == 600


def test_anova_reads_its_input_once(spark, table):
    """The totals of a feature come from its classes, not from a second pass."""
    table.createOrReplaceTempView("anova_rows")
    lf = spark.sql("SELECT 'AGE' AS feature, AGE AS value, is_default AS label FROM anova_rows"
                   " UNION ALL SELECT 'one', CAST(NULL AS DOUBLE), 0 UNION ALL SELECT CAST(NULL AS STRING), 1.0D, 0")
    out = anova_f(lf, p_values=False)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    groups = {}
    for r in table.collect():
        groups.setdefault(r.is_default, []).append(r.AGE)
    n, mean = 600, sum(map(sum, groups.values())) / 600
    m = {c: sum(x) / len(x) for c, x in groups.items()}
    between = sum(len(x) * (m[c] - mean) ** 2 for c, x in groups.items()) / (len(groups) - 1)
    within = sum((a - m[c]) ** 2 for c, x in groups.items() for a in x) / (n - len(groups))
    got = out.collect()
    assert [r.feature for r in got] == ["AGE"] and got[0].f_statistic == pytest.approx(between / within)
