"""Near duplicates by MinHash bands with sequential Bayesian verification.

A document is the set of its distinct shingles of ``width`` words (4 unless given). Documents with equal
sets form one class; classes that agree in a band of MinHash values are
candidates. A candidate pair's signatures are compared batch by batch: with m
of n values equal, a uniform prior on the similarity gives the posterior
chance that it reaches the threshold, and the pair is dropped once that chance
is below the chosen miss probability. Whatever survives is verified on the
full sets.

Pairs inside a bucket are not all emitted: first every member of a bucket is
held against one centre; then, only where a bucket still holds several
components, its members' signatures are compared in blocks and the surviving
pairs across components are verified. So no link between components is lost,
and a group of copies costs about one comparison a member.

Inputs: ``doc_id`` and ``text``; other columns are ignored. Null or empty
texts have an empty set: linked with nothing. Each row is placed by its own
text: rows of one doc_id with different texts are nodes of their own, told
apart by a row key, and a component is named by the smallest doc_id in it. A
null doc_id is never linked (component null, kept). Texts of any length are
taken whole. An empty table gives an empty result.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, LongType, StructField, StructType

from .common import arrow_groups, arrow_map, text_bytes, written
from .graph import components
from .shingles import mix, shingle_set

ROWS, BANDS = 6, 44      # a pair of similarity 0.8 shares no band with chance 1.5e-6
WIDTH = 4
COMPARED, BATCH = ROWS * BANDS, 33  # signature values for verification, and how many a step takes
MISS = 1e-5              # a pair is pruned when its chance to reach the threshold is below
BLOCK = 512              # members of a bucket compared at a time
SHINGLES_AT_ONCE = 1 << 19


def least_matches(percent: int, miss: float = MISS, n: int = COMPARED, step: int = BATCH) -> dict[int, int]:
    """After k compared values: the fewest matches that still keep a pair.

    With a uniform prior the posterior of the similarity is Beta(m+1, k-m+1),
    whose mass above t equals P(Binomial(k+1, t) <= m)."""
    t, out = percent / 100, {}
    for k in range(step, n + 1, step):
        mass, m = 0.0, 0
        while True:
            mass += comb(k + 1, m) * t ** m * (1 - t) ** (k + 1 - m)
            if mass >= miss:
                break
            m += 1
        out[k] = m
    return out


def survives(a: np.ndarray, b: np.ndarray, bounds: dict[int, int]) -> np.ndarray:
    """Which rows of two signature arrays stay after all batches."""
    alive = np.arange(len(a))
    matches = np.zeros(len(a), np.int32)
    done = 0
    for k, least in bounds.items():
        matches[alive] += (a[alive, done:k] == b[alive, done:k]).sum(axis=1, dtype=np.int32)
        alive = alive[matches[alive] >= least]
        done = k
    keep = np.zeros(len(a), bool)
    keep[alive] = True
    return keep


def _multipliers() -> np.ndarray:
    return mix(np.arange(1, ROWS * BANDS + 1, dtype=np.uint64)) | np.uint64(1)


def signatures(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, the hash of the text, n_shingles, set_id (128 bits; null for an empty
    set), the band keys and the compared signature values (16 bits each)."""
    schema = StructType([StructField("doc_id", LongType()), StructField("text_a", LongType()),
                         StructField("text_b", LongType()), StructField("n_shingles", LongType()),
                         StructField("set_id", BinaryType()), StructField("bands", ArrayType(LongType())),
                         StructField("sig", BinaryType())])

    def some(ids: list, marks: list, sets: list[np.ndarray]) -> dict:
        import xxhash
        full = [i for i, s in enumerate(sets) if len(s)]
        bands: list = [None] * len(sets)
        sig: list = [None] * len(sets)
        if full:
            flat = np.concatenate([sets[i] for i in full])
            starts = np.cumsum([0] + [len(sets[i]) for i in full[:-1]])
            least = np.empty((ROWS * BANDS, len(full)), np.uint32)
            for k, m in enumerate(_multipliers()):
                np.minimum.reduceat(((flat * m) >> np.uint64(32)).astype(np.uint32), starts, out=least[k])
            keys = np.empty((len(full), BANDS), np.int64)
            for band in range(BANDS):
                acc = np.full(len(full), band + 1, np.uint64)
                for row in range(ROWS):
                    acc = mix(acc + least[band * ROWS + row])
                keys[:, band] = acc.view(np.int64)
            short = np.ascontiguousarray((least[:COMPARED] & np.uint32(0xFFFF)).astype(np.uint16).T)
            for at, i in enumerate(full):
                bands[i], sig[i] = keys[at], short[at].tobytes()
        return {"doc_id": ids, "text_a": [m[0] for m in marks], "text_b": [m[1] for m in marks],
                "n_shingles": [len(s) for s in sets],
                "set_id": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                "bands": bands, "sig": sig}

    def run(batch):
        ids, marks, sets, held = [], [], [], 0
        for doc, text, *mark in zip(batch.column(0).to_pylist(), text_bytes(batch), batch.column(2).to_pylist(),
                                    batch.column(3).to_pylist()):
            ids.append(doc)
            marks.append(mark)
            sets.append(shingle_set(text, width))
            held += len(sets[-1])
            if held >= SHINGLES_AT_ONCE:
                yield some(ids, marks, sets)
                ids, marks, sets, held = [], [], [], 0
        if ids:
            yield some(ids, marks, sets)
    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text", *text_marks()), run, schema)


def text_marks() -> list[Column]:
    """The text's hash, as two columns text_a and text_b (null text: that of '')."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return [F.xxhash64(text, F.lit(n)).alias(f"text_{c}") for n, c in enumerate("ab")]


def _pruned(pairs: DataFrame, sigs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that outlive the batches of signature comparisons."""
    bounds = least_matches(percent)
    both = (pairs.join(sigs.select(F.col("rep").alias("b"), F.col("sig").alias("sig_b")), "b")
            .join(sigs.select(F.col("rep").alias("a"), F.col("sig").alias("sig_a")), "a"))

    def run(batch):
        cols = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        if batch.num_rows:
            a, b = (np.frombuffer(b"".join(cols[c].to_pylist()), np.uint16).reshape(-1, COMPARED)
                    for c in ("sig_a", "sig_b"))
            keep = np.flatnonzero(survives(a, b, bounds))
            yield {"a": cols["a"].take(keep), "b": cols["b"].take(keep)}
    return arrow_map(both, run, StructType([StructField("a", LongType()), StructField("b", LongType())]))


def _verified(pairs: DataFrame, docs: DataFrame, percent: int, width: int) -> DataFrame:
    """Pairs whose full shingle sets reach the similarity."""
    texts = _texts(pairs.select(F.col("a").alias("doc_id")).unionAll(pairs.select("b")), docs)
    both = (pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
            .join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a"))

    def run(batch):
        last, near = None, []
        a = batch.column(batch.schema.get_field_index("a"))
        b = batch.column(batch.schema.get_field_index("b"))
        for key, x, y in zip(a.to_pylist(), text_bytes(batch, "text_a"), text_bytes(batch, "text_b")):
            if key != last:
                one, last = shingle_set(x, width), key
            near.append(similar(one, shingle_set(y, width), percent))
        yield {"a": a, "b": b, "near": near}
    schema = StructType([StructField("a", LongType()), StructField("b", LongType()),
                         StructField("near", BooleanType())])
    return written(arrow_map(both, run, schema))


CELL = StructType([StructField("key", LongType()), StructField("band", LongType()), StructField("i", LongType()),
                   StructField("j", LongType()), StructField("block", LongType()), StructField("rep", LongType()),
                   StructField("component", LongType()), StructField("sig", BinaryType())])


def _cell_pairs(rows, bounds: dict[int, int]):
    """For each member of the cell's first block (by row number), the members
    of the second block in other components whose signatures survive. A pair
    that shares several buckets is taken in its first band, or its second, as
    the values compared are shortened."""
    sig = np.frombuffer(b"".join(rows["sig"].to_pylist()), np.uint16).reshape(-1, COMPARED)
    rep, part, block = (rows[c].to_numpy() for c in ("rep", "component", "block"))
    i, j, band = (rows[c][0].as_py() for c in ("i", "j", "band"))
    right = np.flatnonzero(block == j)
    for x in np.flatnonzero(block == i):
        y = right[(part[right] != part[x]) & ((rep[right] > rep[x]) if i == j else True)]
        if len(y):
            y = y[survives(np.broadcast_to(sig[x], (len(y), COMPARED)), sig[y], bounds)]
        if len(y):
            same = (sig[y] == sig[x]).reshape(len(y), BANDS, ROWS).all(axis=2)
            y = y[same[:, :band].sum(axis=1) < 2]
        if len(y):
            yield x, y


def _links_across(members: DataFrame, sigs: DataFrame, labels: DataFrame, docs: DataFrame, percent: int,
                  width: int) -> DataFrame:
    """Verified links (a, b) between members of one bucket that lie in
    different components. Blocks of signatures are compared; a large bucket is
    split into cells of two blocks. Members with a surviving pair then meet in
    the same cell with their texts, so pairs are never rows of a table."""
    known = members.join(labels, members.rep == labels.node, "left").select(
        "key", "band", "rep", F.coalesce("component", "rep").alias("component"))
    mixed = known.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                     F.count("*").alias("n")).filter("lo <> hi")
    blocks = F.ceil(F.col("n") / F.lit(BLOCK)).cast("long")
    placed = (known.join(mixed.select("key", blocks.alias("blocks")), "key")
              .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
              .join(sigs, "rep")
              .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
              .select("key", F.col("band").cast("long").alias("band"), F.least("block", "other").alias("i"),
                      F.greatest("block", "other").alias("j"), "block", "rep", "component", "sig"))
    bounds = least_matches(percent)

    def busy(rows):
        at = sorted({k for x, y in _cell_pairs(rows, bounds) for k in (int(x), *y.tolist())})
        return {f.name: rows[f.name].combine_chunks().take(pa.array(at, pa.int64())) for f in CELL.fields}
    left = written(arrow_groups(placed, ["key", "i", "j"], busy, CELL))
    texts = _texts(left.select(F.col("rep").alias("doc_id")), docs)
    schema = StructType([StructField("a", LongType()), StructField("b", LongType())])

    def link(rows):
        sets = [shingle_set(t or b"", width) for t in rows["text"].cast("binary").to_pylist()]
        rep, out_a, out_b = rows["rep"].to_numpy(), [], []
        for x, ys in _cell_pairs(rows, bounds):
            for y in ys:
                if similar(sets[x], sets[y], percent):
                    out_a.append(min(rep[x], rep[y]))
                    out_b.append(max(rep[x], rep[y]))
        return {"a": np.array(out_a, np.int64), "b": np.array(out_b, np.int64)}
    full = left.join(texts.withColumnRenamed("doc_id", "rep"), "rep")
    return written(arrow_groups(full, ["key", "i", "j"], link, schema))


def similar(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection reaches percent * union of two sorted sets."""
    if min(len(one), len(two)) * 100 < percent * max(len(one), len(two)):
        return False
    joint = np.concatenate([one, two])
    joint.sort(kind="stable")  # two sorted runs are merged
    shared = int((joint[1:] == joint[:-1]).sum())
    return 100 * shared >= percent * (len(one) + len(two) - shared)


def _texts(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """doc_id and text of the ids, one row each. The ids are never broadcast:
    they grow with the input, and the plan shall be the same at every size."""
    return written(docs.select(F.col("doc_id").cast("long"), "text").join(written(ids.distinct()).hint("shuffle_hash"), "doc_id", "left_semi")
                   .groupBy("doc_id").agg(F.min("text").alias("text")))


def _shared_ids(docs: DataFrame) -> DataFrame:
    """The doc_ids whose rows have different texts."""
    marked = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long"), F.struct(*text_marks()).alias("t"))
    return written(marked.groupBy("doc_id").agg(F.min("t").alias("lo"), F.max("t").alias("hi"))
                   .filter("lo <> hi").select("doc_id"))


def _own_keys(docs: DataFrame, shared: DataFrame) -> DataFrame:
    """(doc_id, text, owner): rows of ``shared`` ids under keys that no doc_id has."""
    docs = docs.select(F.col("doc_id").cast("long").alias("owner"), "text")
    ends = docs.agg(F.min("owner").alias("lo"), F.max("owner").alias("hi")).first()
    top = 1 << 62
    if ends["hi"] >= top and ends["lo"] <= -top:
        raise ValueError("doc_ids take the whole range of 64 bits, so rows of one id can't be told apart")
    step = F.monotonically_increasing_id()
    key = F.lit(ends["hi"] + 1) + step if ends["hi"] < top else F.lit(ends["lo"] - 1) - step
    ids = shared.withColumnRenamed("doc_id", "owner")
    apart = written(docs.join(ids, "owner", "left_semi").select(key.alias("doc_id"), "text", "owner"))
    rest = docs.join(ids, "owner", "left_anti").select(F.col("owner").alias("doc_id"), "text", "owner")
    return rest.unionByName(apart)


def grouped(docs: DataFrame, percent: int = 80, width: int = WIDTH) -> DataFrame:
    """doc_id, text_a, text_b, n_shingles, component_id, kept, and the key of the
    group (two groups may share their smallest doc_id, where its rows differ)."""
    shared = _shared_ids(docs)
    if shared.isEmpty():
        return _grouped(docs, percent, width).withColumn("group", F.coalesce("component_id", "doc_id"))
    own = written(_own_keys(docs, shared))
    owners = own.select("doc_id", "owner").distinct()
    found = written(_grouped(own, percent, width).join(owners, "doc_id", "left")
                    .withColumnRenamed("component_id", "group"))
    least = found.groupBy("group").agg(F.min("owner").alias("component_id"))
    return (found.join(least, "group", "left")
            .select(F.col("owner").alias("doc_id"), "text_a", "text_b", "n_shingles", "component_id",
                    F.col("owner").eqNullSafe(F.col("component_id")).alias("kept"), "group"))


def near_duplicates(docs: DataFrame, percent: int = 80, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, one row per input row."""
    return grouped(docs, percent, width).select("doc_id", "n_shingles", "component_id", "kept")


def _grouped(docs: DataFrame, percent: int, width: int) -> DataFrame:
    """As ``grouped``, for rows whose doc_id decides the text."""
    marked = written(signatures(docs, width))
    classes = written(marked.filter("set_id is not null and doc_id is not null").groupBy("set_id").agg(
        F.min("doc_id").alias("rep"), F.first("sig").alias("sig"), F.first("bands").alias("bands")))
    sigs = classes.select("rep", "sig")
    banded = classes.select("rep", F.posexplode("bands").alias("band", "key"))
    shared = banded.groupBy("key").agg(F.min("rep").alias("centre"), F.count("*").alias("n")).filter("n > 1")
    members = written(banded.join(shared.select("key", "centre"), "key"))
    spokes = members.filter("rep <> centre").select(F.col("centre").alias("a"), F.col("rep").alias("b")).distinct()
    tried = _verified(written(_pruned(spokes, sigs, percent)), docs, percent, width)
    first = written(components(tried.filter("near").select("a", "b")))
    late = _links_across(members.select("key", "band", "rep"), sigs, first, docs, percent, width)
    label = lambda side: F.coalesce(F.col(side), F.col(side[-1]))
    bridges = (late.join(first.select(F.col("node").alias("a"), F.col("component").alias("_a")), "a", "left")
               .join(first.select(F.col("node").alias("b"), F.col("component").alias("_b")), "b", "left")
               .select(label("_a").alias("a"), label("_b").alias("b")))
    second = written(components(bridges))
    owner = (classes.select("set_id", "rep")
             .join(first.withColumnRenamed("node", "rep"), "rep", "left")
             .withColumn("mid", F.coalesce("component", "rep")).drop("component")
             .join(second.withColumnRenamed("node", "mid"), "mid", "left")
             .select("set_id", F.coalesce("component", "mid").alias("component_id")))
    return (marked.drop("bands", "sig").join(owner, "set_id", "left")
            .select("doc_id", "text_a", "text_b", "n_shingles",
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))
