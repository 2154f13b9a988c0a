"""The trie of conversation prefixes, from composable fingerprints.

A conversation c is rebuilt as the first h turns of its base conversation
(c - c % 5; h = crc32(c) % 9) followed by its own turns after the first h. No
rebuilt text is made. A turn is an element (digest, B) of a monoid of affine
maps over a prime field, so the fingerprint of a sequence is a product that any
cut of it can share: each block of the sorted turns multiplies its own, blocks
are joined by their products, and the fingerprint of a rebuilt prefix is

    P_c(p) + (P_b(H) - P_c(h)) B^(p - h)

from products P of stored turns, H being the turns that the base has of the h.
So every node is found at stored turns only: a turn of a base stands for all
conversations that take it over. Turns with one depth and fingerprint form a
node; where several stored turns do, their texts are read back by reference and
compared, and if any differ the whole is done again in another field, so equal
fingerprints never decide alone. (A node's parents are equal then, since the
parent's fingerprint follows from the node's and the turn's.)

Subtree sums use runs of nodes with the same members (least member and number
of members name a run): sums within a run are differences of path sums, and
runs are added to their ancestors by pointer doubling, in a number of rounds
that grows with the logarithm of the depth.

Rows without conv_id belong to no conversation and take no part; null role or
text is the empty string. Turns are ordered by turn (null first), ties by role
and text; repeated rows are turns each. Texts may be of any length. An empty
table has no node. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, IntegerType, LongType, StringType, StructField,
                               StructType)

from .common import arrow_groups, forget, written

FAMILY, LONGEST_HEAD = 5, 8
#: Fields tried in turn: (prime, multiplier). The later ones are for texts that the earlier ones confuse.
FIELDS = tuple((2 ** 127 - 1, int.from_bytes(hashlib.blake2b(b"prefix %d" % i, digest_size=15).digest(), "big"))
               for i in range(4))
#: Ids in one piece of the list of a node's last conversations are those alike but for these low bits.
PIECE_BITS = 10
#: A key with more than this share of the rows, and this many, is joined by broadcast (so at most 256 keys are).
HOT_SHARE, HOT_ROWS = 256, 4096
ROWS_OUT = 5_000


def _bin(x: int) -> bytes:
    return x.to_bytes(16, "big")


def _int(b: bytes) -> int:
    return int.from_bytes(b, "big")


def head_length(conv: int) -> int:
    return zlib.crc32(str(conv).encode()) % (LONGEST_HEAD + 1)


class Monoid:
    """Products of turn digests in one field."""

    def __init__(self, prime: int, base: int):
        self.prime, self.base = prime, base % prime
        self.inverse = pow(self.base, -1, prime)
        self.powers = [1]

    def power(self, n: int) -> int:
        if n >= 1 << 16:
            return pow(self.base, n, self.prime)
        while len(self.powers) <= n:
            self.powers.append(self.powers[-1] * self.base % self.prime)
        return self.powers[n]

    def digest(self, role: bytes, text: bytes) -> int:
        h = hashlib.blake2b(b"%d:" % len(role), digest_size=16, key=_bin(self.base))
        h.update(role)
        h.update(text)
        return _int(h.digest()) % self.prime

    def joined(self, left: int, right: int, right_length: int) -> int:
        """The product of two sequences from theirs."""
        return (left * self.power(right_length) + right) % self.prime

    def parent(self, value: int, digest: int) -> int:
        return (value - digest) * self.inverse % self.prime


def _schema(**columns) -> StructType:
    return StructType([StructField(n, t) for n, t in columns.items()])


_LONGS = ArrayType(LongType())
TURNS = _schema(block=IntegerType(), conv_id=LongType(), k=LongType(), role=StringType(), text=StringType(),
                size=LongType(), digest=BinaryType(), run=BinaryType(), run_size=LongType(), edge=BooleanType())
PLAN = _schema(conv_id=LongType(), block=IntegerType(), before=LongType(), value=BinaryType(), size_before=LongType(),
               skip=LongType(), shift=LongType(), change=BinaryType(), size_change=LongType(), length=LongType(),
               rebuilt=LongType(), counts=_LONGS, least=_LONGS, last=ArrayType(_LONGS))
PLACED = _schema(conv_id=LongType(), block=IntegerType(), k=LongType(), depth=LongType(), node=BinaryType(),
                 parent=BinaryType(), path=LongType(), size=LongType(), members=LongType(), member=LongType(),
                 ends=_LONGS)


def _turns(conversations: DataFrame, field: tuple[int, int]) -> DataFrame:
    """The turns in order, dealt by ranges, each with its place in its block of
    its conversation and the product of that block up to it."""
    cols = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text", "_tie"]
    rows = (conversations.filter("conv_id is not null")
            .select(F.col("conv_id").cast("long").alias("conv_id"), "turn",
                    *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")))
            .withColumn("_tie", F.rand(7))
            .repartitionByRange(*cols).sortWithinPartitions(*cols).select("conv_id", "role", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        monoid, block, out = Monoid(*field), TaskContext.get().partitionId(), []
        conv, k, value, total = None, 0, 0, 0

        def flush(n: int) -> pa.RecordBatch:
            rows, out[:] = out[:n], out[n:]
            cols = list(zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], TURNS.names)
        types = [pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.binary(),
                 pa.int64(), pa.bool_()]
        for batch in batches:
            ids, roles, texts = (batch.column(i).to_pylist() for i in range(3))
            for c, role, text in zip(ids, roles, texts):
                if c != conv:
                    if out:
                        out[-1] = (*out[-1][:-1], True)
                    conv, k, value, total = c, 0, 0, 0
                raw = text.encode()
                digest = monoid.digest(role.encode(), raw)
                k, total = k + 1, total + len(raw)
                value = monoid.joined(value, digest, 1)
                out.append((block, c, k, role, text, len(raw), _bin(digest), _bin(value), total, False))
            if len(out) > 1:
                yield flush(len(out) - 1)
        if out:
            out[-1] = (*out[-1][:-1], True)
            yield flush(len(out))
    return rows.mapInArrow(run, TURNS)


def _plan(turns: DataFrame, field: tuple[int, int]) -> DataFrame:
    """One row per conversation and block: how its products there continue to
    fingerprints of the rebuilt conversation, and for a base the conversations
    that take its first turns over. A group is a family (bases differ by 5), and
    holds at most 9 rows per conversation and block."""
    rows = (turns.filter((F.col("k") <= LONGEST_HEAD) | F.col("edge"))
            .select((F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"), "conv_id", "block", "k", "run",
                    "run_size", "edge"))

    def run(t: pa.Table) -> dict:
        monoid = Monoid(*field)
        base = t["base"][0].as_py()
        convs: dict[int, dict[int, list]] = {}
        for c, block, k, value, size, edge in zip(*(t[n].to_pylist() for n in
                                                    ("conv_id", "block", "k", "run", "run_size", "edge"))):
            convs.setdefault(c, {}).setdefault(block, []).append((k, _int(value), size, edge))
        heads, blocks, length = {}, {}, {}
        for c, held in convs.items():
            before, value, size, head = 0, 0, 0, [(0, 0)]
            blocks[c] = []
            for block in sorted(held):
                blocks[c].append((block, before, value, size))
                rows = sorted(held[block])
                head += [(monoid.joined(value, v, k), size + s) for k, v, s, _ in rows if before + k <= LONGEST_HEAD]
                k, v, s, _ = rows[-1]
                before, value, size = before + k, monoid.joined(value, v, k), size + s
            heads[c], length[c] = head, before
        taken = {}
        for c in convs:
            if c != base:
                h = head_length(c)
                taken[c] = (h, min(h, length.get(base, 0)), max(0, length[c] - h))
        out: dict[str, list] = {n: [] for n in PLAN.names}
        for c in convs:
            h, used, own = taken.get(c, (0, 0, length[c]))
            change = size_change = 0
            if c != base and own:
                change = (heads[base][used][0] if used else 0) - heads[c][h][0]
                size_change = (heads[base][used][1] if used else 0) - heads[c][h][1]
            spots = range(1, LONGEST_HEAD + 1) if c == base else ()
            over = [sorted(x for x, (_, u, _) in taken.items() if u >= p) for p in spots]
            last = [sorted(x for x, (_, u, own_x) in taken.items() if u == p and not own_x) for p in spots]
            for block, before, value, size in blocks[c]:
                for n, v in zip(PLAN.names, (c, block, before, _bin(value), size, h, used - h,
                                             _bin(change % monoid.prime), size_change, length[c], used + own,
                                             [1 + len(x) for x in over], [min([base, *x]) for x in over], last)):
                    out[n].append(v)
        return out
    return arrow_groups(rows, ["base"], run, PLAN)


def _placed(turns: DataFrame, plan: DataFrame, field: tuple[int, int]) -> DataFrame:
    """Each turn that some rebuilt conversation has, with its node."""
    rows = turns.select("conv_id", "block", "k", "size", "digest", "run", "run_size").join(plan, ["conv_id", "block"])
    names = PLACED.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        monoid = Monoid(*field)
        for batch in batches:
            out: list[tuple] = []
            for r in batch.to_pylist():
                p, skip = r["before"] + r["k"], r["skip"]
                if p <= skip:
                    continue
                value = monoid.joined(_int(r["value"]), _int(r["run"]), r["k"])
                change = _int(r["change"])
                if change:
                    value = (value + change * monoid.power(p - skip)) % monoid.prime
                members, member, ends = 1, r["conv_id"], [r["conv_id"]] if p == r["length"] else []
                if p <= len(r["counts"]):
                    members, member, ends = r["counts"][p - 1], r["least"][p - 1], ends + r["last"][p - 1]
                out.append((r["conv_id"], r["block"], r["k"], p + r["shift"], _bin(value),
                            _bin(monoid.parent(value, _int(r["digest"]))), r["size_before"] + r["run_size"]
                            + r["size_change"], r["size"], members, member, ends))
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), *[pa.int64()] * 4,
                     pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(types)], names)
    return rows.mapInArrow(run, PLACED)


def hot_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """``left`` joined to ``right``, which has one row per key. Keys with a large
    share of the left rows (256 at most) are joined by broadcast."""
    n = left.groupBy(*keys).agg(F.count("*").alias("_n"))
    limit = max(HOT_ROWS, (left.count() // HOT_SHARE))
    hot = written(n.filter(F.col("_n") > limit).select(*keys))
    if hot.isEmpty():
        return left.join(right, keys, how)
    hot_right = written(right.join(F.broadcast(hot), keys, "left_semi"))
    cold = left.join(F.broadcast(hot), keys, "left_anti").join(right, keys, how)
    return cold.unionByName(left.join(F.broadcast(hot), keys, "left_semi").join(F.broadcast(hot_right), keys, how))


def _confused(turns: DataFrame, placed: DataFrame, nodes: DataFrame) -> bool:
    """Whether some node holds different turns."""
    several = nodes.filter("refs > 1").select("depth", "node")
    refs = hot_join(placed.select("conv_id", "block", "k", "depth", "node"), several, ["depth", "node"], "left_semi")
    texts = refs.join(turns.select("conv_id", "block", "k", "role", "text"), ["conv_id", "block", "k"])
    return not (texts.groupBy("depth", "node")
                .agg(F.min(F.struct("role", "text")).alias("a"), F.max(F.struct("role", "text")).alias("b"))
                .filter("a <> b").isEmpty())


def _last_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending ids at each (depth, node). Ids are joined to
    pieces first; the pieces of a node pass through the digest one by one."""
    piece = (ends.groupBy("depth", "node", F.shiftright("conv", PIECE_BITS).alias("piece"))
             .agg(F.array_join(F.sort_array(F.collect_list("conv")).cast("array<string>"), ",").alias("ids")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, digest, out = None, None, []

        def flush() -> pa.RecordBatch:
            cols = list(zip(*out)) or [(), (), ()]
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.binary(), pa.string()))],
                ["depth", "node", "ends_sha256"])
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                for depth, node, ids in zip(*(part.column(i).to_pylist() for i in range(3))):
                    if (depth, node) != at:
                        if at:
                            out.append((*at, digest.hexdigest()))
                        at, digest = (depth, node), hashlib.sha256(ids.encode())
                    else:
                        digest.update(b"," + ids.encode())
            if len(out) > ROWS_OUT:
                yield flush()
        if at:
            out.append((*at, digest.hexdigest()))
        yield flush()
    return (piece.repartition("depth", "node").sortWithinPartitions("depth", "node", "piece")
            .select("depth", "node", "ids").mapInArrow(run, "depth long, node binary, ends_sha256 string"))


def _totals(runs: DataFrame) -> DataFrame:
    """(conv_id, n_convs, hi, path_hi, children, leaves, below) of each run of
    two or more members, from runs (conv_id, n_convs, up_conv, up_n, hi, path_hi,
    value); ``below`` leaves the run's own ``value`` out."""
    key, up = ["conv_id", "n_convs"], [F.col("up_conv").alias("conv_id"), F.col("up_n").alias("n_convs")]
    kids = (runs.filter("up_conv is not null").groupBy(*up)
            .agg(F.count("*").alias("children"), F.count_if(F.col("n_convs") == 1).alias("single")))
    state = written(runs.filter("n_convs > 1").join(kids, key, "left").na.fill(0, ["children", "single"])
                    .withColumn("leaves", F.col("single") + (F.col("children") == 0).cast("long"))
                    .withColumn("saved", F.col("value")).drop("single"))
    while not state.filter("up_conv is not null").isEmpty():
        sent = (state.filter("up_conv is not null").groupBy(*up)
                .agg(F.sum("leaves").alias("_leaves"), F.sum("saved").alias("_saved")))
        rest = state.join(sent, key, "left").na.fill(0, ["_leaves", "_saved"])
        rest = (rest.withColumn("leaves", F.col("leaves") + F.col("_leaves"))
                .withColumn("saved", F.col("saved") + F.col("_saved")).drop("_leaves", "_saved"))
        next_up = (state.filter("up_conv is not null")
                   .select(F.col("conv_id").alias("up_conv"), F.col("n_convs").alias("up_n"),
                           F.col("up_conv").alias("_c"), F.col("up_n").alias("_n")))
        inner = hot_join(rest.filter("up_conv is not null"), next_up, ["up_conv", "up_n"])
        done = state
        state = written(inner.withColumn("up_conv", F.col("_c")).withColumn("up_n", F.col("_n")).drop("_c", "_n")
                        .unionByName(rest.filter("up_conv is null")))
        forget(done)
    return state.select(*key, "hi", "path_hi", "children", "leaves", (F.col("saved") - F.col("value")).alias("below"))


def prefix_trie(conversations: DataFrame, fields: tuple[tuple[int, int], ...] = FIELDS) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256 of every node, the root (depth 0) among them."""
    for field in fields:
        turns = written(_turns(conversations, field))
        plan = written(_plan(turns, field))
        placed = written(_placed(turns, plan, field))
        nodes = written(placed.groupBy("depth", "node").agg(
            F.sum("members").alias("n_convs"), F.min("member").alias("conv_id"), F.max("parent").alias("parent"),
            F.max("path").alias("path"), F.max("size").alias("size"), F.count("*").alias("refs"),
            F.sum(F.size("ends")).alias("n_ends")))
        if not _confused(turns, placed, nodes):
            return _trie(plan, placed, nodes)
        forget(turns, plan, placed, nodes)
    raise ValueError("the fields given confuse different turns")


def _trie(plan: DataFrame, placed: DataFrame, nodes: DataFrame) -> DataFrame:
    first = plan.filter("before = 0")
    root = (first.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"),
                      F.count_if(F.col("rebuilt") == 0).alias("n_ends")).filter("n_convs > 0")
            .select(F.lit(0).cast("long").alias("depth"), F.lit(_bin(0)).alias("node"), "n_convs", "conv_id",
                    F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("path"),
                    F.lit(0).cast("long").alias("size"), F.lit(1).cast("long").alias("refs"), "n_ends"))
    nodes = nodes.unionByName(root)
    top = F.min(F.struct("depth", "node", "parent", (F.col("path") - F.col("size")).alias("path"))).alias("top")
    runs = (nodes.groupBy("conv_id", "n_convs").agg(top, F.max("depth").alias("hi"), F.max("path").alias("path_hi"))
            .select("conv_id", "n_convs", "hi", "path_hi", F.col("top.depth").alias("lo"),
                    F.col("top.node").alias("top_node"), (F.col("top.depth") - 1).alias("depth"),
                    F.col("top.parent").alias("node"),
                    ((F.col("n_convs") - 1) * (F.col("path_hi") - F.col("top.path"))).alias("value")))
    above = nodes.select("depth", "node", F.col("conv_id").alias("up_conv"), F.col("n_convs").alias("up_n"))
    runs = written(hot_join(written(runs), above, ["depth", "node"]).drop("depth", "node"))
    totals = written(_totals(runs.drop("lo", "top_node")))
    ends = (placed.select("depth", "node", F.explode("ends").alias("conv"))
            .unionByName(first.filter("rebuilt = 0").select(F.lit(0).cast("long").alias("depth"),
                                                            F.lit(_bin(0)).alias("node"),
                                                            F.col("conv_id").alias("conv"))))
    tops = runs.select(F.col("lo").alias("depth"), F.col("top_node").alias("node"), "up_conv", F.lit(True).alias("is_top"))
    out = nodes.join(tops, ["depth", "node"], "left").join(_last_digests(ends), ["depth", "node"], "left")
    out = written(out)
    alone = out.filter("n_convs = 1").select(
        "*", (F.col("n_ends") == 0).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"))
    shared = hot_join(out.filter("n_convs > 1"), totals, ["conv_id", "n_convs"]).select(
        *out.columns, F.when(F.col("depth") < F.col("hi"), 1).otherwise(F.col("children")).cast("long").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        ((F.col("n_convs") - 1) * (F.col("path_hi") - F.col("path") + F.col("size")) + F.col("below")).alias("saved_tokens"))
    return alone.unionByName(shared).select(
        "conv_id", "depth",
        F.when(F.col("is_top"), F.col("up_conv")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


#: DuckDB statement: rebuilt conversations as lists, nodes as their distinct prefixes.
SQL = r"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos, role, text
           FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
                 FROM conversations WHERE conv_id IS NOT NULL)),
convs AS (SELECT conv_id, conv_id - conv_id % 5 AS base,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
        lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
            lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)), 4294967295::BIGINT) % 9 AS h
    FROM (SELECT DISTINCT conv_id FROM t)),
rebuilt AS (SELECT c.conv_id, 0 AS part, t.pos, role, text FROM convs c JOIN t ON t.conv_id = c.base AND t.pos <= c.h
            UNION ALL SELECT c.conv_id, 1, t.pos, role, text FROM convs c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h),
listed AS (SELECT convs.conv_id, coalesce(list([role, text] ORDER BY part, pos) FILTER (WHERE pos IS NOT NULL), []) AS turns
           FROM convs LEFT JOIN rebuilt USING (conv_id) GROUP BY convs.conv_id),
paths AS (SELECT conv_id, d.depth, turns[1:d.depth] AS prefix, len(turns) AS length,
                 CASE WHEN d.depth = 0 THEN 0 ELSE octet_length(encode(turns[d.depth][2])) END AS size
          FROM listed, unnest(range(len(turns) + 1)) AS d(depth)),
nodes AS (SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
                 sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE length = depth), '')) AS ends
          FROM paths GROUP BY depth, prefix),
ids AS (SELECT p.conv_id, p.depth, n.conv_id AS node FROM paths p JOIN nodes n ON p.depth = n.depth AND p.prefix = n.prefix),
linked AS (SELECT n.*, i.node AS parent FROM nodes n LEFT JOIN ids i ON i.conv_id = n.conv_id AND i.depth = n.depth - 1),
kids AS (SELECT parent AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM linked WHERE depth > 0 GROUP BY 1, 2),
full_nodes AS (SELECT l.*, coalesce(n_children, 0) AS n_children FROM linked l LEFT JOIN kids USING (conv_id, depth)),
below AS (SELECT i.node AS conv_id, i.depth, count(*) FILTER (WHERE f.n_children = 0) AS n_leaves,
                 sum((f.n_convs - 1) * f.size) AS saved
          FROM full_nodes f JOIN ids i ON i.conv_id = f.conv_id AND i.depth <= f.depth GROUP BY 1, 2)
SELECT f.conv_id, f.depth::BIGINT AS depth, f.parent AS parent_conv_id, f.n_convs, f.n_children, b.n_leaves,
       b.saved::BIGINT AS saved_tokens, f.ends AS ends_sha256
FROM full_nodes f JOIN below b USING (conv_id, depth)
"""
