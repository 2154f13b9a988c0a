"""Approximate nearest neighbours by cross-polytope hashing.

Each table turns unit vectors by three rounds of random signs and a fast
Hadamard transform and assigns them to the nearest signed axis. A query is
sent to its nearest axis and the next best ones (multiprobe); all vectors of
those buckets are its candidates and are reranked by the exact cosine in
double precision. Buckets are dealt to tasks as cells of at most about
``CELL`` vectors times ``CELL`` queries, so a bucket that holds a third of all
vectors is many cells; a cell returns only the ``k`` best of each of its
queries, and no table of candidate pairs is ever made. Queries whose buckets
held fewer than ``k`` vectors, where the table has more, are sent to all axes of
one table, so that they see every vector.

Vectors that are null, zero, of another length than most, or hold a null or
non-finite component take no part, as candidates or queries. Ties go to the
smaller id. Rows that repeat an id count once, with the best score; a query leaves
out every row of its own id. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, ByteType, DoubleType, IntegerType, LongType, ShortType, StructField,
                               StructType)
from pyspark.sql.window import Window

from .common import arrow_groups, arrow_map, written

TABLES, PROBES, ROUNDS, CELL = 6, 14, 3, 512


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row (length a power of two)."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2)
        h *= 2
    return x.reshape(n, d)


def rotations(dim: int, seed: int) -> list[np.ndarray]:
    """The random signs of one table's rounds."""
    size = 1 << max(1, (dim - 1).bit_length())
    rng = np.random.default_rng(seed)
    return [rng.choice([-1.0, 1.0], size) for _ in range(ROUNDS)]


def probes(x: np.ndarray, seed: int, count: int) -> np.ndarray:
    """The ``count`` nearest signed axes of each row, best first; axis a with
    sign + is 2a, with sign - 2a + 1."""
    signs = rotations(x.shape[1], seed)
    y = np.zeros((len(x), len(signs[0])))
    y[:, :x.shape[1]] = x
    for s in signs:
        y = hadamard(y * s)
    both = np.empty((len(y), 2 * y.shape[1]))
    both[:, 0::2], both[:, 1::2] = y, -y
    count = min(count, both.shape[1])
    if count == 1:
        return both.argmax(axis=1)[:, None]
    best = np.argpartition(-both, count - 1, axis=1)[:, :count]
    return np.take_along_axis(best, np.argsort(-np.take_along_axis(both, best, 1), axis=1, kind="stable"), 1)


def cosines(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Cosine of matching rows in double precision, the same for equal rows
    wherever they stand."""
    dot = (q * c).sum(axis=1)
    return dot / (np.sqrt((q * q).sum(axis=1)) * np.sqrt((c * c).sum(axis=1)))


def best_of(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int) -> dict[str, np.ndarray]:
    """The ``k`` nearest of the candidates for each query, other ids only."""
    out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
    approx = (q / np.linalg.norm(q, axis=1, keepdims=True)) @ (c / np.linalg.norm(c, axis=1, keepdims=True)).T
    for row, (own, near) in enumerate(zip(qid, approx)):
        near[cid == own] = -np.inf
        at = np.flatnonzero(near >= (np.partition(near, -k)[-k] if len(near) > k else -np.inf) - 1e-9)
        at = at[near[at] > -np.inf]
        exact = cosines(np.broadcast_to(q[row], (len(at), q.shape[1])), c[at])
        first = np.lexsort((cid[at], -exact))[:k]
        out["query_id"].append(np.full(len(first), own))
        out["vec_id"].append(cid[at][first])
        out["score"].append(exact[first])
    return {n: np.concatenate(v) if v else np.empty(0) for n, v in out.items()}


def _usable(vectors: DataFrame, id_: str, vec: str) -> DataFrame:
    """vec_id and the components as bytes of 64-bit floats, with their number."""
    rows = vectors.select(F.col(id_).cast("long").alias("vec_id"), F.col(vec).cast("array<double>").alias("v"))
    fine = (F.col("vec_id").isNotNull() & F.col("v").isNotNull()
            & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists("v", lambda x: x != 0))
    return rows.filter(fine)


def _reranked(placed: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each query among the vectors of its buckets."""
    # one row for each table and axis: how many cells the bucket's two sides fill
    cells = placed.groupBy("t", "b").agg(*[
        F.ceil(F.count(F.when(F.col("side") == s, 1)) / F.lit(CELL)).cast("int").alias(n)
        for s, n in ((0, "cs"), (1, "qs"))]).filter("cs > 0 and qs > 0")
    dealt = placed.join(F.broadcast(cells), ["t", "b"])  # at most tables * 2 * dim rows
    own = F.pmod(F.xxhash64("vec_id"), F.when(F.col("side") == 0, F.col("cs")).otherwise(F.col("qs"))).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.when(F.col("side") == 0, F.col("qs")).otherwise(F.col("cs")) - 1))
    dealt = dealt.withColumn("own", own).withColumn("other", other)
    c_cell = F.when(F.col("side") == 0, F.col("own")).otherwise(F.col("other"))
    q_cell = F.when(F.col("side") == 0, F.col("other")).otherwise(F.col("own"))
    dealt = dealt.select("t", "b", c_cell.alias("c"),
                         q_cell.alias("qc"), "side", "vec_id", "x")
    found = StructType([StructField("query_id", LongType()), StructField("vec_id", LongType()),
                        StructField("score", DoubleType())])

    def rerank(group: pa.Table) -> dict:
        side, ids = group["side"].to_numpy(), group["vec_id"].to_numpy()
        x = np.frombuffer(b"".join(group["x"].to_pylist()), np.float64).reshape(len(ids), -1)
        q, c = np.flatnonzero(side == 1), np.flatnonzero(side == 0)
        if not len(q) or not len(c):
            return {"query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64), "score": np.empty(0)}
        return best_of(ids[q], x[q], ids[c], x[c], k)
    best = arrow_groups(dealt, ["t", "b", "c", "qc"], rerank, found)
    best = best.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, id_: str = "vec_id", vec: str = "embedding",
            tables: int = TABLES, count: int = PROBES) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest found for each
    query row (``is_query`` over ``vec_id``)."""
    rows = _usable(vectors, id_, vec).withColumn("q", is_query)
    dims = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    dim = dims[0]["d"] if dims else 1
    count = min(count, 2 << max(1, (dim - 1).bit_length()))
    schema = StructType([StructField("t", ShortType()), StructField("b", IntegerType()),
                         StructField("side", ByteType()), StructField("vec_id", LongType()),
                         StructField("x", BinaryType())])

    def place(batch: pa.RecordBatch):
        ids, query = batch.column(0).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
        if not len(ids):
            return
        x = batch.column(1).flatten().to_numpy().reshape(len(ids), dim)
        # a power of two changes no cosine, and keeps squares of tiny and huge vectors in range
        x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        raw = pa.array([r.tobytes() for r in x], pa.binary())
        asked = np.flatnonzero(query)
        for t in range(tables):
            yield {"t": np.full(len(ids), t, np.int16), "b": probes(unit, t, 1)[:, 0].astype(np.int32),
                   "side": np.zeros(len(ids), np.int8), "vec_id": ids, "x": raw}
            if len(asked):
                b = probes(unit[asked], t, count)
                each = np.repeat(asked, b.shape[1])
                yield {"t": np.full(b.size, t, np.int16), "b": b.ravel().astype(np.int32),
                       "side": np.ones(b.size, np.int8), "vec_id": ids[each], "x": raw.take(pa.array(each))}
    placed = written(arrow_map(rows.filter(F.size("v") == dim), place, schema))
    best = written(_reranked(placed, k))
    # queries that found fewer than there are see all vectors, through every axis of the first table
    all_ = placed.filter("t = 0 and side = 0")
    least = min(k, all_.select("vec_id").distinct().count() - 1)
    short = (placed.filter("t = 0 and side = 1").select("vec_id", "x").distinct()
             .join(best.groupBy(F.col("query_id").alias("vec_id")).agg(F.count("*").alias("n")), "vec_id", "left")
             .filter(F.coalesce("n", F.lit(0)) < least).select("vec_id", "x"))
    short = written(short)
    if short.isEmpty():
        return best
    axes = F.broadcast(all_.select("t", "b").distinct())  # at most 2 * dim rows
    wide = short.crossJoin(axes).select("t", "b", F.lit(1).cast("byte").alias("side"), "vec_id", "x")
    rest = best.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti")
    return rest.select(*best.columns).unionByName(_reranked(all_.unionByName(wide), k))
