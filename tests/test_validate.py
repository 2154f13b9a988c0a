"""Validation semantics: NULL passes in-set/between, not-null counts NULLs,
one row per rule, the summary agrees with the rows."""
from riskloom.operators import validate as V


def test_rules(spark):
    df = spark.createDataFrame([(1, 30, 1.0, 0), (3, 15, None, 1), (None, 40, 5.0, 2)],
                               "SEX int, AGE int, LIMIT_BAL double, is_default int")
    rules = [V.Rule(V.NOT_NULL, "LIMIT_BAL"), V.Rule(V.IN_SET, "SEX", [1, 2]),
             V.Rule(V.BETWEEN, "AGE", lo=18, hi=100), V.Rule(V.IN_SET, "is_default", [0, 1]),
             V.Rule(V.ORDERED, None, ["SEX", "AGE", "LIMIT_BAL", "is_default"])]
    res = {r.rule_id: r for r in V.validate_table(df, rules).collect()}
    assert res[0].unexpected_count == 1 and not res[0].success
    assert res[1].unexpected_count == 1 and res[1].unexpected_percent == 50.0   # NULL not counted
    assert res[2].unexpected_count == 1
    assert res[3].unexpected_count == 1
    assert res[4].success
    s = V.validation_summary(V.validate_table(df, rules)).collect()[0]
    assert s.evaluated == 5 and s.successful == 1 and not s.success
    assert len(s.failed) == 4


def test_quality_gate(spark):
    raw = spark.createDataFrame([(1, 0)], "ID long, is_default int")
    feats = spark.createDataFrame([(1.0, 30, 0, 0, None, None)],
                                  "LIMIT_BAL double, AGE int, PAY_0 int, is_default int, "
                                  "PAYMENT_MEAN double, BILL_AMT_MEAN double")
    g = {(r.stage, r.expectation_type, r.column): r.success for r in V.quality_gate(raw, feats).collect()}
    assert g[("raw", V.ROWS_POSITIVE, "N/A")] and g[("raw", V.EXISTS, "is_default")]
    assert not g[("features", V.NOT_ALL_NULL, "PAYMENT_MEAN")]


def test_exact_stratified_split(spark):
    from riskloom.operators.split import stratified_split
    rows = [(i, 1 if i % 4 == 0 else 0) for i in range(1, 1001)]
    df = spark.createDataFrame(rows, "ID long, is_default int")
    out = stratified_split(df, 0.2, 42, exact=True).groupBy("is_default", "split").count().collect()
    c = {(r.is_default, r.split): r["count"] for r in out}
    assert c[(1, "test")] == 50 and c[(0, "test")] == 150          # round(0.2 · n) per class
    assert c[(1, "train")] + c[(1, "test")] == 250


def test_split_valid_invalid(spark):
    import pytest
    df = spark.createDataFrame([(1, 30, 1.0), (1, 30, 1.0), (3, 15, None), (None, None, 5.0)],
                               "SEX int, AGE int, LIMIT_BAL double")
    rules = [V.Rule(V.NOT_NULL, "LIMIT_BAL"), V.Rule(V.IN_SET, "SEX", [1, 2]), V.Rule(V.BETWEEN, "AGE", lo=18, hi=100),
             V.Rule(V.ORDERED, None, ["AGE"])]
    valid, invalid = V.split_valid_invalid(df, rules)
    assert valid.columns == df.columns
    assert [tuple(r) for r in valid.orderBy("LIMIT_BAL").collect()] == [(1, 30, 1.0), (1, 30, 1.0), (None, None, 5.0)]
    assert [r.failed_rules for r in invalid.collect()] == [
        [f"{V.NOT_NULL}:LIMIT_BAL", f"{V.IN_SET}:SEX", f"{V.BETWEEN}:AGE"]]
    ok, bad = V.split_valid_invalid(df, [V.Rule(V.NOT_NULL, "absent")])     # a missing column breaks every row
    assert ok.count() == 0 and bad.count() == 4
    ok, bad = V.split_valid_invalid(df.limit(0), rules)
    assert ok.count() == 0 and bad.count() == 0
    ok, bad = V.split_valid_invalid(df, [])
    assert ok.count() == 4 and bad.count() == 0
    with pytest.raises(ValueError):
        V.split_valid_invalid(df, rules, column="AGE")


def test_exact_stratified_folds(spark):
    from riskloom.operators.split import kfold_column
    rows = [(i, None if i > 1000 else 1 if i % 4 == 0 else 0) for i in range(1, 1011)]
    df = spark.createDataFrame(rows, "ID long, is_default int")
    out = kfold_column(df, 3, label="is_default").collect()
    assert sorted(r.ID for r in out) == list(range(1, 1011)) and {r.fold for r in out} <= {0, 1, 2}
    for cls in (0, 1):
        sizes = [sum(r.is_default == cls and r.fold == f for r in out) for f in range(3)]
        assert max(sizes) - min(sizes) <= 1
