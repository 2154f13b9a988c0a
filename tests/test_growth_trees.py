"""Trees of a table that fits one task are grown by one task, not by a job a
level, and are the trees of the distributed fit."""
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from riskloom.operators import train as TR
from riskloom.operators import trees
from riskloom.session import scratch_path


def _parts(spark, n, files):
    values = [(F.col("id") * 13 % 11).cast("double"), (F.col("id") * 7 % 5 - 2).cast("double"),
              F.rand(1) - 0.5, F.round(F.randn(2), 2), F.lit(3.0), F.rand(3) * (F.col("id") % 3)]
    score = values[0] / 11 + values[1] / 5 + values[2] + F.randn(4) / 3
    df = (spark.range(0, n, 1, files).select(F.col("id").alias("ID"), (score > 0.4).cast("int").alias("is_default"),
                                             array_to_vector(F.array(*values)).alias("features"))
          .withColumn("weight", F.when(F.col("is_default") == 1, 1.3).otherwise(0.8)))
    path = scratch_path(spark, "trees-test")
    df.write.parquet(path)
    rows = spark.read.option("maxPartitionBytes", "128m").parquet(path).repartitionByRange(files, "ID").sortWithinPartitions("ID")
    return TR.Prepared(rows.persist(), rows, n)


def _lines(model):
    """The trees with their numbers to 9 places."""
    return [" ".join(f"{float(w):.9f}" if w.replace(".", "").replace("-", "").replace("E", "").isdigit() else w
                     for w in line.replace(")", " )").split()) for line in model.toDebugString.splitlines()[1:]]


@pytest.mark.parametrize("n,files", [(700, 1), (12_000, 2), (26_000, 2)])
def test_trees_are_those_of_the_distributed_fit(spark, n, files):
    """Also with sampled split candidates, bags per partition, and nodes that
    do not fit one group."""
    parts = _parts(spark, n, files)
    assert parts.train.rdd.getNumPartitions() == files
    todo = [("random_forest", {"n_estimators": 7, "max_depth": 6, "class_weight": "balanced", "random_state": 42}, 256),
            ("random_forest", {"n_estimators": 8, "max_depth": 7, "random_state": 7}, 1 if n < 1000 else 256),
            ("gradient_boosting", {"n_estimators": 6, "max_depth": 4, "learning_rate": 0.2, "random_state": 42}, 256)]
    for kind, params, memory in todo:
        est = TR.make_classifier(kind, params, float(n), "is_default", n).setMaxMemoryInMB(memory)
        one, spread = trees.fit_in_one_task(est, kind, parts.train, "is_default"), est.fit(parts.train)
        assert _lines(one) == _lines(spread)
        assert one.uid == est.uid and one.numFeatures == spread.numFeatures == 6
        a, b = ({r.ID: r.probability for r in TR.classified(m, parts.valid).collect()} for m in (one, spread))
        assert a.keys() == b.keys() and all(abs(a[i] - b[i]) < 1e-12 for i in a)
        assert one.extractParamMap()[one.maxDepth] == params["max_depth"]
    TR.release(parts)


def test_nodes_that_do_not_fit_one_group(spark, monkeypatch):
    """Many groups a level: the features of a node are drawn in the engine's order."""
    parts = _parts(spark, 3_000, 1)
    est = TR.make_classifier("random_forest", {"n_estimators": 40, "max_depth": 9, "random_state": 42}, 1.0, "is_default", 3_000)
    est.setMaxMemoryInMB(1)
    assert _lines(trees.fit_in_one_task(est, "random_forest", parts.train, "is_default")) == _lines(est.fit(parts.train))
    TR.release(parts)


def test_small_tables_are_fitted_in_one_job(spark, monkeypatch):
    """A fit of a small table does not go through the engine's levels; one that
    is too large for a task does."""
    from pyspark.ml.classification import GBTClassifier
    parts, fits, whole = _parts(spark, 400, 1), [], GBTClassifier._fit

    def spy(est, data):
        fits.append(est.uid)
        return whole(est, data)
    monkeypatch.setattr(GBTClassifier, "_fit", spy)
    params = {"n_estimators": 3, "max_depth": 2, "random_state": 42}
    small = TR.fit_classifier(parts, "gradient_boosting", params)
    assert fits == [] and small.getNumTrees == 3
    monkeypatch.setattr(TR, "TASK_ROWS", 100)
    assert _lines(TR.fit_classifier(parts, "gradient_boosting", params)) == _lines(small) and len(fits) == 1
    TR.release(parts)


def test_rows_not_fit_for_it_are_left_to_the_distributed_fit(spark):
    """One class, or a value that is not a number: the distributed fit decides."""
    parts = _parts(spark, 300, 1)
    est = TR.make_classifier("gradient_boosting", {"n_estimators": 2, "max_depth": 2, "random_state": 42})
    odd = parts.train.withColumn("features", array_to_vector(F.array(F.lit(float("nan")), F.rand(1))))
    for rows in (odd, parts.train.filter("is_default = 0"), parts.train.filter("ID < 0")):
        assert trees.fit_in_one_task(est, "gradient_boosting", rows, "is_default") is None
    model = TR.fit_classifier(TR.Prepared(parts.train.filter("is_default = 0"), parts.valid, 150), "gradient_boosting",
                              {"n_estimators": 2, "max_depth": 2, "random_state": 42})
    assert model.getNumTrees == 2
    TR.release(parts)
