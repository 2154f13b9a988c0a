"""Vectors, archives and the pipeline."""

import hashlib

import numpy as np
from pyspark.sql import functions as F

import pytest

import corpus_pipeline
from riskloom.llm import queries, warc
from riskloom.llm.bayes_dedup import near_duplicates
from riskloom.llm.common import scratch_dir, written
from riskloom.llm.crosspoly import nearest

SF = "/root/testdata/sf0.001"


def test_nearest_recall_and_scores(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)
    size = np.linalg.norm(x, axis=1)
    got = {}
    for r in queries.op1_cross_polytope(spark, SF).collect():
        got.setdefault(r.query_id, []).append(r)
    assert set(got) == {i for i in ids.tolist() if i % 50 == 0}
    hit = total = 0
    for q, found in got.items():
        at = int(np.flatnonzero(ids == q)[0])
        cos = x @ x[at] / size / size[at]
        cos[at] = -2
        best = set(ids[np.lexsort((ids, -cos))[:5]].tolist())
        hit += len(best & {r.vec_id for r in found})
        total += len(best)
        assert all(abs(r.score - cos[int(np.flatnonzero(ids == r.vec_id)[0])]) < 1e-12 for r in found)
        assert [r["rank"] for r in sorted(found, key=lambda r: (-r.score, r.vec_id))] == list(range(1, len(found) + 1))
    assert hit >= 0.9 * total


def test_nearest_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [None, 1.0]),
            (6, [float("nan"), 1.0]), (None, [1.0, 1.0]), (7, [1.0, 2.0, 3.0]), (8, [1.0, 1.0]), (8, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1))
    got = [tuple(r) for r in nearest(df, F.col("vec_id") % 50 == 0, k=3).orderBy("rank").collect()]
    assert [g[:3] for g in got] == [(0, 1, 1), (0, 2, 2), (0, 3, 8)]
    assert nearest(df.filter("false"), F.col("vec_id") % 50 == 0).count() == 0


def test_nearest_of_few_sees_all(spark):
    """With fewer vectors than buckets a query still gets every other vector, up to k."""
    for n in (1, 2, 4, 6, 8):
        x = np.random.default_rng(n).normal(size=(n, 64))
        rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        cos = unit @ unit.T
        got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in nearest(rows, F.col("vec_id") >= 0).collect()}
        want = {(i, at + 1): j for i in range(n)
                for at, j in enumerate([j for j in np.argsort(-cos[i]).tolist() if j != i][:5])}
        assert got.keys() == want.keys()
        if n <= 6:  # all of the others; of more than 5, those found may be others than the nearest
            assert {q: v for q, (v, _) in got.items()} == want
        assert all(abs(s - cos[q[0], v]) < 1e-12 for q, (v, s) in got.items())


def test_archives_round_trip(spark):
    big = "é" * 700
    rows = [(1, "http://a/x y", big), (2, None, big), (3, "u", "small"), (4, "u", "small"), (5, "u\r\nEvil: 1", None),
            (2, None, big), (6, "u", "z" * 1_500_000), (None, "u", big), (7, "u", "a\r\n\r\nWARC/1.1")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("refers_to", F.lit("x"))
    folder = scratch_dir(spark) + "-t"
    index = written(warc.write_bundles(warc.typed(pages), folder, frame=2000))
    got = warc.read_bundles(index, folder).collect()
    want = sorted(((p, len((h or "").encode()), hashlib.sha1((h or "").encode()).hexdigest(),
                    "revisit" if (p, h) == (1, big) else "response", 2 if (p, h) == (1, big) else None)
                   for p, _, h in rows), key=str)
    assert sorted((tuple(r) for r in got), key=str) == want
    for p, h in ((3, "small"), (6, "z" * 1_500_000), (7, "a\r\n\r\nWARC/1.1")):
        assert warc.fetch(spark, index, folder, p)[1] == h.encode()
    assert warc.archived(pages.filter("false")).count() == 0


def test_query_covers_pages(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = queries.op6_seekable_warc(spark, SF).collect()
    assert {r.page_id: (r.payload_bytes, r.payload_digest) for r in got} == {
        p: (len(h.encode()), hashlib.sha1(h.encode()).hexdigest()) for p, h in pages.items()}


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = written(stage(spark, docs, SF))
        assert out.columns == docs.columns, name
        if name == "quality classifier":
            left = {r.doc_id for r in out.collect()}
            assert all((d in left) == (q == 1) for d, q in truth.items()) or sum(
                (d in left) == (q == 1) for d, q in truth.items()) >= 0.95 * len(truth)
        docs = out
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert last.count() == docs.count() and last.filter("n_tokens is null").count() == 0


def test_pipeline_odd_rows(spark, odd, labels, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    odd = odd.select("doc_id", "text", "lang", "source", "n_chars", "size")
    for name, stage in corpus_pipeline.STAGES[1:]:
        out = written(stage(spark, odd, str(tmp_path)))
        odd = out if name != "tokens" else odd
    assert out.filter("doc_id = 8").count() <= 3


def test_near_copies_share_five_words(spark):
    """The stage holds texts against each other by five words, the query by four."""
    words = [f"w{i}" for i in range(80)]
    changed = lambda *at: " ".join(f"x{i}" if i in at else w for i, w in enumerate(words))
    # similarity to the first: 0.81 by four words and 0.77 by five; 0.88 by five
    docs = spark.createDataFrame([(1, changed()), (2, changed(26, 53)), (3, changed(40))], "doc_id long, text string")
    first_two = docs.filter("doc_id < 3")
    assert sorted(r.doc_id for r in corpus_pipeline.no_near_copies(spark, first_two, SF).collect()) == [1, 2]
    assert sorted(r.doc_id for r in corpus_pipeline.no_near_copies(spark, docs, SF).collect()) == [1, 2]
    assert [r.doc_id for r in near_duplicates(first_two).filter("kept").collect()] == [1]


def _texts():
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    return a, b, b + " tail"


def test_rows_of_one_id_with_different_texts_are_judged_each(spark):
    a, b, near_b = _texts()
    rows = [(5, a), (5, b), (9, near_b), (9, near_b), (None, a), (7, None), (7, ""), (7, "short text")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(df).collect())
    assert got == [(-1, 57, None, True), (5, 57, 5, True), (5, 57, 5, True), (7, 0, 7, True), (7, 0, 7, True),
                   (7, 1, 7, True), (9, 58, 5, False), (9, 58, 5, False)]
    big = spark.createDataFrame([(2 ** 63 - 1, a), (2 ** 63 - 1, b), (3, near_b)], "doc_id long, text string")
    assert sorted((r.doc_id, r.component_id) for r in near_duplicates(big).collect()) == [
        (3, 3), (2 ** 63 - 1, 3), (2 ** 63 - 1, 2 ** 63 - 1)]


def test_near_copy_stage_keeps_every_text_once(spark):
    a, b, near_b = _texts()
    stage = lambda rows: sorted(map(tuple, corpus_pipeline.no_near_copies(
        spark, spark.createDataFrame(rows, "doc_id long, text string"), SF).collect()))
    assert stage([(5, a), (5, b)]) == [(5, a), (5, b)]
    assert stage([(1, a), (5, b), (5, a), (7, b)]) == [(1, a), (5, b)]
    assert len(stage([(5, b), (5, near_b), (5, b), (6, near_b)])) == 1
    assert stage([(5, a), (5, a), (6, a)]) == [(5, a)]


def test_stages_take_empty_tables(spark, none, labels, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, str(tmp_path)).count() == 0, name


def test_quality_stage_odd_rows(spark, odd, labels, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.good_quality(spark, odd, str(tmp_path))
    assert out.columns == odd.columns and out.count() <= odd.count()


def test_nearest_at_the_ends_of_the_range(spark):
    """Squares that leave the range of doubles cost no vector its place."""
    rows = [(0, [1e-200, 0.0]), (1, [1e200, 1e200]), (2, [3e-250, 1e-251]), (3, [1e300, -1e300]), (4, [5e-324, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r["rank"], r.score) for r in nearest(df, F.col("vec_id") == 0).collect()}
    assert [v for v, _ in sorted(got.items(), key=lambda x: x[1][0])] == [4, 2, 1, 3]
    assert got[4][1] == 1.0 and got[1][1] == pytest.approx(2 ** -0.5) and got[3][1] == pytest.approx(2 ** -0.5)
