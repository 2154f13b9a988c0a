"""Models by property: fixed seed, better than chance, save/load equality,
balanced weights, scoring bands."""
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from riskloom.functions.bands import risk_level, rule_score
from riskloom.operators import prep as PR
from riskloom.operators import train as TR
from riskloom.operators.evaluate import roc_auc
from riskloom.plans import base as B
from riskloom.operators.split import stratified_split
from riskloom.session import scratch_path

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def split(spark):
    f = stratified_split(B.features_m(spark, SF))
    return f.filter("split = 'train'"), f.filter("split = 'test'")


def test_prep_selects_k(split):
    train, _ = split
    st = PR.fit_prep(train, k=20)
    assert len(st.selected) == 20
    assert set(st.levels["EDUCATION"]) <= {1.0, 2.0, 3.0, 4.0}


def test_logistic_beats_chance_and_roundtrips(spark, split):
    train, test = split
    model, _ = TR.fit_model(train, "logistic", {"C": 0.1, "class_weight": "balanced", "max_iter": 50})
    p = TR.predict(model, test)
    auc = roc_auc(p, "is_default", "probability").collect()[0].roc_auc
    assert auc > 0.6
    path = scratch_path(spark, "model-test")
    model.write().overwrite().save(path)
    q = TR.predict(PipelineModel.load(path), test)
    a = {r.ID: r.probability for r in p.collect()}
    b = {r.ID: r.probability for r in q.collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-12 for k in a)


def test_balanced_weights(split):
    train, _ = split
    w = {r["class"]: r.weight * r.n for r in TR.class_weights(train).collect()}
    assert w[0] == pytest.approx(w[1])          # each class carries n/K total weight


def test_rule_scores_on_scenarios(spark):
    # the three documented sample borrowers: good, risky, default
    df = spark.createDataFrame([(200000.0, -1), (50000.0, 2), (10000.0, 4)], "LIMIT_BAL double, PAY_0 int")
    p = rule_score(F.col("PAY_0"), F.col("LIMIT_BAL"))
    rows = df.select(p.alias("p"), risk_level(p).alias("band")).collect()
    assert [r.p for r in rows] == [0.05, 0.75, 0.75]
    assert [r.band for r in rows] == ["very low", "very high", "very high"]


SMALL_GRID = [
    TR.Experiment("lr", "logistic", True, {"max_iter": 20}, {"C": [0.1, 1.0]}),
    TR.Experiment("gbt", "gradient_boosting", True, {"random_state": 42},
                  {"n_estimators": [2, 4], "learning_rate": [0.1], "max_depth": [2]}),
    TR.Experiment("rf", "random_forest", False, {"n_estimators": 3, "max_depth": 3, "random_state": 42})]


@pytest.fixture(scope="module")
def small(spark):
    from riskloom.operators.split import kfold_column
    f = stratified_split(B.features_m(spark, SF))
    return kfold_column(f.filter("split = 'train'"), 2, 42), f.filter("split = 'test'")


def test_the_plan_is_the_sources(spark):
    """15 settings in three families; all of them with every fold."""
    n = {ex.model_type: len(TR.grid(TR.PARAM_GRIDS[ex.model_type])) for ex in TR.DEFAULT_EXPERIMENTS if ex.use_grid_search}
    assert n == {"logistic": 3, "random_forest": 4, "gradient_boosting": 8} and len(TR.DEFAULT_EXPERIMENTS) == 5


def test_an_ended_run_goes_on_where_it_stopped(spark, small, monkeypatch):
    train, test = small
    fits, whole = [], TR.fit_classifier

    def counted(data, model_type, params, label="is_default"):
        fits.append((model_type, params.get("n_estimators")))
        return whole(data, model_type, params, label)
    monkeypatch.setattr(TR, "fit_classifier", counted)
    path = scratch_path(spark, "run-test")
    want, model, name = TR.run_experiments(train, test, SMALL_GRID, 2, store=TR.RunStore(spark, path + "-whole"))
    # 2 settings and one boosted fit for both of its settings, in 2 folds; then 3 models
    assert len(fits) == 2 * (2 + 1) + 3 and fits.count(("gradient_boosting", 4)) >= 2
    assert [r["name"] for r in want] == ["lr", "gbt", "rf"] and model is not None
    assert name == max(want, key=lambda r: r["roc_auc"])["name"]

    left = [4]

    def ending(data, model_type, params, label="is_default"):
        left[0] -= 1
        if left[0] < 0:
            raise RuntimeError("ended")
        return counted(data, model_type, params, label)
    fits.clear()
    monkeypatch.setattr(TR, "fit_classifier", ending)
    store = TR.RunStore(spark, path)
    with pytest.raises(RuntimeError):
        TR.run_experiments(train, test, SMALL_GRID, 2, store=store, workers=1)
    assert len(fits) == 4
    monkeypatch.setattr(TR, "fit_classifier", counted)
    got, _, again = TR.run_experiments(train, test, SMALL_GRID, 2, store=TR.RunStore(spark, path))
    assert len(fits) == 9 and again == name
    strip = lambda rows: [{k: v for k, v in r.items() if k not in ("seconds", "finished_at")} for r in rows]
    assert strip(got) == strip(want)
    TR.run_experiments(train, test, SMALL_GRID, 2, store=TR.RunStore(spark, path))
    assert len(fits) == 9                                   # nothing was missing
    TR.grid_search(train.filter("ID % 7 <> 0"), "logistic", {"max_iter": 20}, {"C": [0.1]}, 2, store=store)
    assert len(fits) == 11                                  # other rows are another run


def test_staged_boosting_equals_separate_fits(spark, small):
    train, test = small
    data = TR.prepare_parts(train, test)
    p = {"learning_rate": 0.2, "max_depth": 3, "random_state": 42}
    big = TR.fit_classifier(data, "gradient_boosting", {**p, "n_estimators": 12})
    alone = TR.fit_classifier(data, "gradient_boosting", {**p, "n_estimators": 5})
    staged = TR.first_trees(big, 5)
    rows = lambda m: sorted((r.ID, r.prediction, r.probability) for r in TR.classified(m, data.valid).collect())
    assert staged.getNumTrees == 5 and rows(staged) == rows(alone) != rows(big)
    assert TR.first_trees(big, 12) is big
    path = scratch_path(spark, "staged")
    staged.write().overwrite().save(path)
    assert rows(type(staged).load(path)) == rows(staged)
    scored = TR.classified(big, data.valid)
    assert TR.valid_auc(big, data) == pytest.approx(roc_auc(scored, "is_default", "probability").first().roc_auc)
    TR.release(data)


def test_a_column_of_100000_levels_fits_and_scores(spark):
    from pyspark.ml.classification import LogisticRegression
    from riskloom.operators import levels as LV
    df = spark.range(200_000).select("id", F.concat(F.lit("city "), F.col("id") % 100_000).alias("city"),
                                     F.when(F.col("id") % 3 > 0, F.lit("a")).alias("few"),
                                     (F.col("id") % 100_000 % 2).cast("double").alias("y"))
    enc = LV.fit_levels(df, ["city", "few"])
    assert enc.sizes == {"city": 100_000, "few": 1}
    got = enc.levels.filter("feature = 'city'").agg(F.countDistinct("position"), F.min("position"), F.max("position"))
    assert tuple(got.first()) == (100_000, 0, 99_999)
    model = LogisticRegression(featuresCol="city_levels", labelCol="y", maxIter=3).fit(enc.transform(df))
    new = spark.createDataFrame([("city 7", "a"), ("nowhere", None), (None, "b")], "city string, few string")
    out = {r.city: r for r in model.transform(enc.transform(new)).collect()}
    assert out["city 7"].city_levels.numNonzeros() == 1 and out["city 7"].city_levels.size == 100_000
    assert out["city 7"].few_levels.toArray().tolist() == [1.0]
    assert out["nowhere"].city_levels.numNonzeros() == out[None].city_levels.numNonzeros() == 0
    assert out[None].few_levels.toArray().tolist() == [0.0]
    assert out["city 7"].probability[1] > out["nowhere"].probability[1]


def test_level_positions_do_not_depend_on_buckets(spark, monkeypatch):
    from riskloom.operators import levels as LV
    df = spark.createDataFrame([(f"v{i % 57}",) for i in range(200)] + [(None,)], "c string")
    monkeypatch.setattr(LV, "BUCKET_LEVELS", 10)
    enc = LV.fit_levels(df, ["c"])
    assert enc.sizes == {"c": 57}
    assert sorted(r.position for r in enc.levels.collect()) == list(range(57))
