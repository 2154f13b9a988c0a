"""Language-model scores from an Elias-Fano n-gram trie.

Words are A-Z lower-cased runs without white space; an end token closes every
text. A word's count over all training texts gives the base score, and the
lowest order of the model. Higher orders interpolate: an n-gram seen ``least``
times or more adds (count - DISCOUNT) / context count, and what its context
leaves over scales the next lower order, so each context's probabilities sum
to one (up to the rounding of the codes).

Levels of the trie are files in the shared folder (see ``eliasfano``): level 1
holds word hashes with their counts, level k the words that follow each n-gram
of level k-1, found by successor search inside their context's run. An n-gram
is named by two numbers, its context's place and its word's, so no key
overflows. Weights and back-offs are one byte each, codes into 256 quantiles of
a part.

All counting runs on Spark. Texts are turned into blocks of numbered words, a
row a block. For each level, tasks sum the n-grams of their blocks and send
them packed (sorted, byte planes, compressed) to the level's parts in one
shuffle; the task of a part sums, weighs and writes its file. The parts of a
level are planned from the counts of the level below, so that one holds about
``PART`` training tokens, whatever the size of the corpus; a context with more
is shared by several parts. No task or driver ever holds the vocabulary or a
level; the driver holds a few numbers a part.

Words are told apart by 63-bit hashes. A null text is empty: one token, the
end. A text of any length is one block at most, read whole. Rows without doc_id
train as any other. Repeated rows count and are scored one by one. Other
columns, whatever their names, are not read. An empty table gives an empty
result. Without training text every probability is uniform over the unknown
word. ``order`` 1 is the base model.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType)

from .common import arrow_groups, arrow_map, forget, scratch_dir, text_bytes, written
from .eliasfano import Counts, Grams, Level, cut, pack, pack_grams, part_of
from .warc import _open

ORDER, LEAST, DISCOUNT = 3, 1, 0.75
BLOCK_TOKENS, TOKENS_AT_ONCE, PART = 1 << 20, 1 << 19, 1 << 21
END = int.from_bytes(b"end", "little")  # the end token's key; no word's hash is this small by any likely chance
POSITIVE = (1 << 63) - 1


def _squeezed(a: np.ndarray) -> bytes:
    """Numbers of 0 or more as compressed byte planes, after their count."""
    width = max(1, (int(a.max(initial=0)).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _restored(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw[1:]), np.uint8).reshape(raw[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :raw[0]] = planes.T
    return out.view("<i8")[:, 0]


def _fields(**types) -> StructType:
    return StructType([StructField(n, t) for n, t in types.items()])


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self) + 1  # 0 is the end token
        return n


def _blocks(docs: DataFrame) -> DataFrame:
    """Rows of blocks: the hashes of the block's words, their counts in its
    training texts, and its texts as numbers of these words."""
    def block(ids: list, train: list, codes: list[np.ndarray], numbers: _Numbers) -> dict:
        size = len(numbers) + 1
        words = np.fromiter((xxhash.xxh3_64_intdigest(w) & POSITIVE for w in numbers), np.int64, size - 1)
        tokens, sizes = np.concatenate(codes), np.array([len(c) for c in codes])
        n = np.bincount(tokens[np.repeat(np.array(train, bool), sizes)], minlength=size)
        return {"words": [np.concatenate([[END], words]).tobytes()], "n": [_squeezed(n)], "n_words": [size],
                "doc_id": [ids], "train": [train], "n_tokens": [sizes.tolist()], "codes": [_squeezed(tokens)]}

    def run(batch: pa.RecordBatch):
        numbers, ids, train, codes, held = _Numbers(), [], [], [], 0
        for doc, t, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), text_bytes(batch)):
            words = text.lower().split()
            code = np.zeros(len(words) + 1, np.uint32)
            code[:-1] = np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words))
            codes.append(code)
            ids.append(doc)
            train.append(bool(t))
            held += len(code)
            if held >= BLOCK_TOKENS:
                yield block(ids, train, codes, numbers)
                numbers, ids, train, codes, held = _Numbers(), [], [], [], 0
        if ids:
            yield block(ids, train, codes, numbers)
    return arrow_map(docs, run, _fields(
        words=BinaryType(), n=BinaryType(), n_words=LongType(), doc_id=ArrayType(LongType()),
        train=ArrayType(BooleanType()), n_tokens=ArrayType(LongType()), codes=BinaryType()))


def _saved(folder: str, ending: str, raw: bytes) -> str:
    path = f"{folder}/{uuid.uuid4().hex}.{ending}"
    files, name = _open(path)
    with files.open_output_stream(name, compression=None) as out:
        out.write(raw)
    return path


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of ``n``."""
    if not len(keys):
        return keys, n
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(n, first)


_PLAN = {"next_lo": ArrayType(LongType()), "next_subs": ArrayType(LongType()), "next_of": ArrayType(LongType())}


def _planned(n: np.ndarray, most: int) -> dict:
    lo, subs = cut(n, most)
    return {"next_lo": [lo.tolist()], "next_subs": [subs.tolist()], "next_of": [n[lo].tolist()]}


class _Plan:
    """The parts of the next level: first context, contexts, parts that share
    it and, for a shared context, its count."""

    def __init__(self, rows: list, start: list[int], size: int, words: int):
        lo, subs, of = [], [], []
        for r, s in zip(rows, start):
            for x, k, c in zip(r["next_lo"], r["next_subs"], r["next_of"]):
                lo += [s + x] * k
                subs += [k] * k
                of += [c] * k
        self.end(lo, subs, of, size, words)

    def end(self, lo: list, subs: list, of: list, size: int, words: int) -> None:
        self.lo, self.subs, self.of = (np.array(x, np.int64) for x in (lo, subs, of))
        after = np.searchsorted(self.lo, self.lo, side="right")
        self.m = np.append(self.lo, size)[after] - self.lo
        self.size, self.words = size, words

    def with_start(self, texts: int, most: int) -> _Plan:
        """One context more, behind the last: the start of a text."""
        k = max(1, -(-texts // most))
        self.end([*self.lo, *[self.size] * k], [*self.subs, *[k] * k], [*self.of, *[texts] * k], self.size + 1, self.words)
        return self


def _vocabulary(raw: DataFrame, folder: str, most: int) -> tuple[Level, int, _Plan]:
    """Level 1 with the counts of its words, the training tokens, and the plan
    of level 2."""
    parts = max(1, -(-(raw.agg(F.sum("n_words")).first()[0] or 0) // most))

    def send(batch: pa.RecordBatch):
        for words, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words, n = np.frombuffer(words, np.int64), _restored(n)
            words, n = words[n > 0], n[n > 0]
            order = np.argsort(words)
            words, n = words[order], n[order]
            part = (words >> 32) * parts >> 31
            found, lo = np.unique(part, return_index=True)
            ends = [*lo[1:].tolist(), len(words)]
            yield {"part": found, "words": [words[a:z].tobytes() for a, z in zip(lo, ends)],
                   "n": [_squeezed(n[a:z]) for a, z in zip(lo, ends)]}

    def save(group: pa.Table) -> dict:
        words, n = _summed(np.frombuffer(b"".join(group["words"].to_pylist()), np.int64),
                           np.concatenate([_restored(x) for x in group["n"].to_pylist()]))
        return {"part": [group["part"][0].as_py()], "first": [words[0]], "size": [len(words)], "total": [n.sum()],
                "file": [_saved(folder, "ef", pack(words))], "counts": [_saved(folder, "n", Counts.pack(n))],
                **_planned(n, most)}
    sent = arrow_map(raw.select("words", "n"), send, _fields(part=LongType(), words=BinaryType(), n=BinaryType()))
    rows = arrow_groups(sent, ["part"], save, _fields(
        part=LongType(), first=LongType(), size=LongType(), total=LongType(), file=StringType(), counts=StringType(),
        **_PLAN)).collect()
    rows = sorted(rows, key=lambda r: r["part"])
    start = np.cumsum([0] + [r["size"] for r in rows]).tolist()
    level = Level([r["first"] for r in rows], start[:-1], [r["file"] for r in rows], start[-1], [r["counts"] for r in rows])
    return level, sum(r["total"] for r in rows), _Plan(rows, start, level.size, level.size)


def _pairs(context: np.ndarray, word: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (context, word) in order, and each pair's index among them;
    contexts are numbered first where the two do not fit one number."""
    names, key = _keys(context, word, words)
    key, back = np.unique(key, return_inverse=True)
    return *_split(names, key, words), back


def _keys(context: np.ndarray, word: np.ndarray, words: int) -> tuple[np.ndarray | None, np.ndarray]:
    names = None
    if len(context) and (int(context.max()) + 1) * (words + 1) > POSITIVE:
        names, context = np.unique(context, return_inverse=True)
    return names, context * (words + 1) + word


def _split(names: np.ndarray | None, key: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    context, word = np.divmod(key, words + 1)
    return context if names is None else names[context], word


class Model:
    """The trie's levels with the base counts; scores encoded texts."""

    def __init__(self, level: Level, total: int):
        self.words, self.total, self.grams = level, total, []

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.5) / (self.total + 0.5 * (self.words.size + 1)))

    def walk(self, codes: np.ndarray, first: np.ndarray) -> Iterator[tuple]:
        """For each order above 1 in the trie: each token's context (a place in
        the order below, negative if none), weight and context's back-off; last
        the contexts of the next order. ``codes`` are places of words, negative
        for unknown ones; ``first`` marks the first token of each text, whose
        context is the start, behind the last word."""
        size = self.words.size
        place = codes.astype(np.int64)
        for k in range(len(self.grams) + 1):
            context = np.full(len(codes), -1, np.int64)
            context[1:] = place[:-1]
            context[first] = size if k == 0 else -1
            if k == len(self.grams):
                yield context, None, None
                return
            weight, left = np.full(len(codes), -np.inf), np.zeros(len(codes))
            place = np.full(len(codes), -1, np.int64)
            known = context >= 0
            if known.any():
                # an unknown word is asked for as one behind the last, which no run holds
                c, w, back = _pairs(context[known], np.where(codes >= 0, codes, size)[known], size)
                at, logs, rest = self.grams[k].find(c, w)
                place[known], weight[known], left[known] = at[back], logs[back], rest[back]
            yield context, weight, left

    def score(self, codes: np.ndarray, first: np.ndarray) -> np.ndarray:
        """log10 probability of every token."""
        count = np.zeros(len(codes), np.int64)
        if (codes >= 0).any():
            distinct, back = np.unique(codes[codes >= 0], return_inverse=True)
            count[codes >= 0] = self.words.counts(distinct)[back]
        p = 10 ** self.base(count)
        for _, weight, left in self.walk(codes, first):
            if weight is not None:
                p = 10 ** weight + 10 ** left * p
        return np.log10(p)


def _next_level(rows: DataFrame, model: Model, plan: _Plan, folder: str, least: int, most: int) -> tuple[Grams, _Plan]:
    """The level above those of ``model``, and the plan of the next one."""
    size = model.words.size

    def send(batch: pa.RecordBatch):
        held: list[tuple] = []

        def flush():
            names, key = _keys(*(np.concatenate(x) for x in zip(*held)), size)
            held.clear()
            key, n = np.unique(key, return_counts=True)
            c, w = _split(names, key, size)
            part = part_of(plan.lo, plan.subs, size, c, w)
            found, lo = np.unique(part, return_index=True)
            ends = [*lo[1:].tolist(), len(c)]
            return {"part": found,
                    "context": [_squeezed(np.diff(c[a:z] - plan.lo[p], prepend=0)) for p, a, z in zip(found, lo, ends)],
                    "word": [_squeezed(w[a:z]) for a, z in zip(lo, ends)],
                    "n": [_squeezed(n[a:z]) for a, z in zip(lo, ends)]}
        for i in range(batch.num_rows):
            for codes, first, _ in _texts(batch, i, train=True):
                *_, (context, _, _) = model.walk(codes, first)
                live = (context >= 0) & (codes >= 0)
                if live.any():
                    held.append((context[live], codes[live]))
                if sum(len(h[0]) for h in held) >= most:
                    yield flush()
        if held:
            yield flush()

    def save(group: pa.Table) -> dict:
        p = group["part"][0].as_py()
        context = np.concatenate([np.cumsum(_restored(x)) for x in group["context"].to_pylist()])
        word, n = (np.concatenate([_restored(x) for x in group[k].to_pylist()]) for k in ("word", "n"))
        m, shared = int(plan.m[p]), plan.subs[p] > 1
        key, n = _summed(context * (size + 1) + word, n)
        context, word = key // (size + 1), key % (size + 1)
        of = np.array([plan.of[p]], float) if shared else np.bincount(context, weights=n, minlength=m)
        context, word, n = (x[n >= least] for x in (context, word, n))
        kept = np.bincount(context, weights=n - DISCOUNT, minlength=m)
        left = np.log10(np.maximum(1e-9, 1 - kept / np.maximum(of, 1)))
        path = _saved(folder, "grams", pack_grams(
            int(plan.lo[p]), np.searchsorted(context, np.arange(m + 1)), word, np.log10((n - DISCOUNT) / of[context]), left))
        return {"part": [p], "size": [len(n)], "file": [path], "kept": [float(kept.sum())], **_planned(n, most)}
    sent = arrow_map(rows.select("train", "n_tokens", "codes"), send,
                     _fields(part=LongType(), context=BinaryType(), word=BinaryType(), n=BinaryType()))
    got = arrow_groups(sent, ["part"], save, _fields(
        part=LongType(), size=LongType(), file=StringType(), kept=DoubleType(), **_PLAN)).collect()
    got = sorted(got, key=lambda r: r["part"])
    sizes, files, kept = np.zeros(len(plan.lo) + 1, np.int64), [None] * len(plan.lo), np.zeros(len(plan.lo))
    for r in got:
        sizes[r["part"] + 1], files[r["part"]], kept[r["part"]] = r["size"], r["file"], r["kept"]
    start = np.cumsum(sizes)
    hot = {}
    for c in np.unique(plan.lo[plan.subs > 1]):
        own = plan.lo == c
        hot[int(c)] = float(np.log10(max(1e-9, 1 - kept[own].sum() / plan.of[own][0])))
    level = Grams(plan.lo, plan.subs, start[:-1], files, int(start[-1]), size, hot)
    return level, _Plan(got, [int(start[r["part"]]) for r in got], level.size, size)


def _texts(batch: pa.RecordBatch, row: int, train: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """A block's texts (all, or those to train on) in slices: codes end to end,
    the places of first tokens, sizes."""
    cell = lambda name: batch.column(batch.schema.get_field_index(name))[row].as_py()
    sizes, codes = np.array(cell("n_tokens"), np.int64), _restored(cell("codes")) - 1
    if train:
        use = np.array(cell("train"), bool)
        codes, sizes = codes[np.repeat(use, sizes)], sizes[use]
    ends = np.cumsum(sizes)
    lo = done = 0
    while lo < len(sizes):
        hi = max(lo + 1, int(np.searchsorted(ends, done + TOKENS_AT_ONCE, side="right")))
        yield codes[done:ends[hi - 1]], ends[lo:hi] - sizes[lo:hi] - done, sizes[lo:hi]
        lo, done = hi, int(ends[hi - 1])


def scored(docs: DataFrame, train: Column, order: int = ORDER, least: int = LEAST, part: int | None = None) -> DataFrame:
    """doc_id, train, n_tokens, n_known, train_tokens, base_score and score of
    every text; ``train`` says which texts are learnt from, ``part`` (unset:
    ``PART``) how many training tokens a part of a level holds."""
    most = part or PART
    folder = scratch_dir(docs.sparkSession) + "-trie"
    files, name = _open(folder)
    files.create_dir(name, recursive=True)
    raw = written(_blocks(docs.select(F.col("doc_id").cast("long"), "text",
                                      F.coalesce(train, F.lit(False)).alias("train"))))
    level, total, plan = _vocabulary(raw, folder, most)
    model = Model(level, total)

    # the blocks get their words' places (plus 1; 0: not seen in training) and base scores
    coded = _fields(doc_id=ArrayType(LongType()), train=ArrayType(BooleanType()), n_tokens=ArrayType(LongType()),
                    n_known=ArrayType(LongType()), base_score=ArrayType(DoubleType()), codes=BinaryType())

    def code(batch: pa.RecordBatch):
        for r in range(batch.num_rows):
            row = {n: batch.column(i)[r].as_py() for i, n in enumerate(batch.schema.names)}
            words, back = np.unique(np.frombuffer(row["words"], np.int64), return_inverse=True)
            place = level.find(words)
            count = np.zeros(len(words), np.int64)
            count[place >= 0] = level.counts(place[place >= 0])
            place, count = place[back], count[back]
            ids, sizes = _restored(row["codes"]), np.array(row["n_tokens"], np.int64)
            first = np.cumsum(sizes) - sizes
            yield {"doc_id": [row["doc_id"]], "train": [row["train"]], "n_tokens": [row["n_tokens"]],
                   "n_known": [np.add.reduceat((count > 0).astype(np.int64)[ids], first).tolist()],
                   "base_score": [np.add.reduceat(model.base(count)[ids], first).tolist()],
                   "codes": [_squeezed(place[ids] + 1)]}
    rows = written(arrow_map(raw.drop("n", "n_words"), code, coded))
    forget(raw)

    texts = rows.select(F.coalesce(F.sum(F.size(F.filter("train", lambda t: t))), F.lit(0))).first()[0]
    plan.with_start(texts, most)
    for _ in range(2, order + 1):
        grams, plan = _next_level(rows, model, plan, folder, least, most)
        model.grams.append(grams)

    def run(batch: pa.RecordBatch):
        for i in range(batch.num_rows):
            score = np.concatenate([np.add.reduceat(model.score(codes, first), first)
                                    for codes, first, _ in _texts(batch, i, train=False)])
            yield {n: batch.column(batch.schema.get_field_index(n))[i].as_py()
                   for n in ("doc_id", "train", "n_tokens", "n_known", "base_score")} | {"score": score}
    return arrow_map(rows, run, _fields(
        doc_id=LongType(), train=BooleanType(), n_tokens=LongType(), n_known=LongType(), base_score=DoubleType(),
        score=DoubleType())).withColumn("train_tokens", F.lit(total).cast("long"))
