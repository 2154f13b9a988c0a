"""Language of texts, word by word, by a linear-chain conditional random field.

A word scores for each language by the learned weights of its affixes, its
character n-grams and, if it is in the learned lexicon, itself; learned
transitions tie neighbouring words. Forward-backward gives each word's
posterior; a document's language is the one with the largest mean posterior
over its words with letters, and that mean is the score.

The field is fitted by gradient steps on the likelihood of code-switched
sequences: passages of sample texts of different languages put one after the
other. The sample holds about ``per_lang`` whole texts of each language (a
repeatable hash sample of the ids).

A null text, or one without a letter, is ``und`` with score 0; so is every
text if nothing could be learnt. Equal sums go to the first language by name.
Repeated rows are labelled one by one; texts of any length are labelled whole.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from .common import arrow_map, hash_below

PER_LANG, LEXICON_LEAST, NGRAM, BITS, LENGTH, STEPS = 60, 3, 4, 16, 256, 30
BUCKETS = 1 << BITS
LETTER = re.compile(r"[^\W\d_]").search
TOKENS_AT_ONCE, CACHED = 2 << 20, 300_000


def features(words: list[str], lexicon: frozenset[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed features of lower-case words: feature numbers, the word each
    belongs to, and which words have letters (the others have no features).

    The word is taken as bytes between ^ and $, so its runs of 2 to 4 bytes
    hold the prefixes and suffixes of 1 to 3 bytes as well."""
    real = np.fromiter((LETTER(w) is not None for w in words), bool, len(words))
    raw = [b"^%b$" % w.encode("utf-8", "surrogatepass") for w in words]
    sizes = np.array([len(r) for r in raw], np.int64)
    buf = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint32)
    owner = np.repeat(np.arange(len(words)), sizes)
    ends = np.repeat(np.cumsum(sizes), sizes)
    real_at = real[owner]
    h = buf.copy()
    found, owners = [], []
    for n in range(2, NGRAM + 1):
        h = h[:-1] * np.uint32(16777619) ^ buf[n - 1:]
        at = np.flatnonzero((np.arange(len(h)) + n <= ends[:len(h)]) & real_at[:len(h)])
        found.append(((h[at] * np.uint32(2654435761)) >> np.uint32(32 - BITS)).astype(np.int64))
        owners.append(owner[at])
    known = [i for i, w in enumerate(words) if w in lexicon and real[i]]
    found.append(np.array([crc32(words[i].encode()) >> (32 - BITS) for i in known], np.int64))
    owners.append(np.array(known, np.int64))
    return np.concatenate(found), np.concatenate(owners), real


@dataclass
class Crf:
    langs: list[str]
    weights: np.ndarray      # BUCKETS x languages
    moves: np.ndarray        # languages x languages, logarithms
    lexicon: frozenset[str]

    def emissions(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scores of distinct words, and which have letters."""
        found, owner, real = features(words, self.lexicon)
        out = np.empty((len(words), len(self.langs)), np.float32)
        for c in range(len(self.langs)):
            out[:, c] = np.bincount(owner, self.weights[found, c], len(words))
        return out, real


def posteriors(score: np.ndarray, sizes: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Forward-backward over sequences laid end to end, all of them a step at
    a time; scaled at each step. Returns each row's label posteriors."""
    order = np.argsort(-sizes, kind="stable")
    ends = np.cumsum(sizes)
    starts, length = (ends - sizes)[order], sizes[order]
    e = np.exp(score - score.max(axis=1, keepdims=True))
    step = np.exp(moves).astype(e.dtype)
    forward = np.empty_like(e)
    top = int(length[0]) if len(length) else 0
    active = np.searchsorted(-length, -np.arange(top), side="left")  # sequences longer than t
    prev = None
    for t in range(top):
        at = starts[:active[t]] + t
        a = e[at] if prev is None else (prev[:active[t]] @ step) * e[at]
        a /= a.sum(axis=1, keepdims=True)
        forward[at] = prev = a
    out = np.empty_like(e)
    back = np.ones((active[0] if top else 0, e.shape[1]), e.dtype)
    for t in range(top - 1, -1, -1):
        m = active[t]
        at = starts[:m] + t
        if t + 1 < top and active[t + 1]:
            k = active[t + 1]
            b = (e[starts[:k] + t + 1] * back[:k]) @ step.T
            back[:k] = b / b.sum(axis=1, keepdims=True)
        p = forward[at] * back[:m]
        out[at] = p / p.sum(axis=1, keepdims=True)
    return out


def _sequences(texts: list[str], tags: list[int], rng: np.random.Generator) -> tuple[list[str], np.ndarray]:
    """Code-switched training words: passages of 10 to 60 words in random order."""
    parts = []
    for text, tag in zip(texts, tags):
        words, at = text.lower().split(), 0
        while at < len(words):
            n = int(rng.integers(10, 61))
            parts.append((words[at:at + n], tag))
            at += n
    rng.shuffle(parts)
    return [w for p, _ in parts for w in p], np.repeat([t for _, t in parts], [len(p) for p, _ in parts])


def fit(texts: list[str], tags: list[str], steps: int = STEPS) -> Crf:
    """Maximum likelihood with Adam steps and a small quadratic penalty."""
    langs = sorted(set(tags))
    k = len(langs)
    if not k:
        return Crf([], np.zeros((BUCKETS, 0), np.float32), np.zeros((0, 0)), frozenset())
    order = sorted(range(len(texts)), key=lambda i: (tags[i], texts[i]))
    words, gold = _sequences([texts[i] for i in order], [langs.index(tags[i]) for i in order],
                             np.random.default_rng(5))
    if not words:
        return Crf(langs, np.zeros((BUCKETS, k), np.float32), np.zeros((k, k)), frozenset())
    distinct, at, count = np.unique(np.array(words, dtype=object).astype(str), return_inverse=True, return_counts=True)
    lexicon = frozenset(distinct[count >= LEXICON_LEAST].tolist())
    flat, owner, _ = features(distinct.tolist(), lexicon)
    n = len(words)
    sizes = np.full(-(-n // LENGTH), LENGTH)
    sizes[-1] = n - LENGTH * (len(sizes) - 1)
    first = np.cumsum(sizes) - sizes
    hot = np.zeros((n, k), np.float32)
    hot[np.arange(n), gold] = 1
    w, m = np.zeros((BUCKETS, k)), np.zeros((k, k))
    inner = np.ones(n, bool)
    inner[first] = False
    pairs = np.flatnonzero(inner)
    seen_moves = np.zeros((k, k))
    np.add.at(seen_moves, (gold[pairs - 1], gold[pairs]), 1)
    state = [[np.zeros_like(x), np.zeros_like(x)] for x in (w, m)]

    def adam(x: np.ndarray, grad: np.ndarray, s: list[np.ndarray], t: int, rate: float) -> None:
        s[0][:] = 0.9 * s[0] + 0.1 * grad
        s[1][:] = 0.99 * s[1] + 0.01 * grad ** 2
        x += rate * (s[0] / (1 - 0.9 ** t)) / (np.sqrt(s[1] / (1 - 0.99 ** t)) + 1e-8)

    for t in range(1, steps + 1):
        by_word = np.stack([np.bincount(owner, w[flat, c], len(distinct)) for c in range(k)], axis=1)
        score = by_word[at].astype(np.float64)
        p, joint = _expected(score, sizes, first, m)
        slack = np.stack([np.bincount(at, (hot - p)[:, c], len(distinct)) for c in range(k)], axis=1)
        g = np.stack([np.bincount(flat, slack[owner, c], BUCKETS) for c in range(k)], axis=1) / n
        adam(w, g - 1e-6 * w, state[0], t, 0.05)
        adam(m, (seen_moves - joint) / n, state[1], t, 0.1)
    return Crf(langs, w.astype(np.float32), m, lexicon)


def _expected(score, sizes, first, moves) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors and expected transition counts of sequences of nearly equal length."""
    k, top = score.shape[1], int(sizes.max())
    e, step = np.exp(score - score.max(axis=1, keepdims=True)), np.exp(moves)
    pad = np.ones((len(sizes), top, k))
    live = np.arange(top)[None, :] < sizes[:, None]
    pad[live] = e
    a = np.empty_like(pad)
    a[:, 0] = pad[:, 0] / pad[:, 0].sum(axis=1, keepdims=True)
    for t in range(1, top):
        x = (a[:, t - 1] @ step) * pad[:, t]
        a[:, t] = x / x.sum(axis=1, keepdims=True)
    b, post, joint = np.ones((len(sizes), k)), np.empty_like(pad), np.zeros((k, k))
    for t in range(top - 1, -1, -1):
        if t + 1 < top:
            on = live[:, t + 1]
            right = pad[:, t + 1] * b
            both = a[:, t, :, None] * step[None] * right[:, None, :]
            joint += (both[on] / both[on].sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            new = right @ step.T
            b = np.where(on[:, None], new / new.sum(axis=1, keepdims=True), 1.0)
        p = a[:, t] * b
        post[:, t] = p / p.sum(axis=1, keepdims=True)
    return post[live], joint


class _Words(dict):
    """word -> row; new words wait in ``new``."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = row = len(self)
        self.new.append(word)
        return row


class Labeller:
    """Labels texts with a model; remembers the scores of words."""

    def __init__(self, model: Crf):
        self.model = model
        self.reset()

    def reset(self) -> None:
        self.words = _Words()
        self.score = np.empty((0, len(self.model.langs)), np.float32)
        self.real = np.empty(0, bool)

    def numbers(self, words: list[str]) -> np.ndarray:
        """The words of a text as rows of the remembered scores."""
        return np.fromiter(map(self.words.__getitem__, words), np.int32, len(words))

    def posteriors(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For numbered words of texts laid end to end: posteriors, whether
        they have letters, and the number of words of each text."""
        sizes = np.array([len(t) for t in texts], np.int64)
        at = np.concatenate(texts)
        if self.words.new:
            score, real = self.model.emissions(self.words.new)
            self.score, self.real = np.concatenate([self.score, score]), np.concatenate([self.real, real])
            self.words.new = []
        return posteriors(self.score[at], sizes, self.model.moves), self.real[at], sizes

    def documents(self, texts: list[np.ndarray]) -> tuple[list[str], list[float]]:
        """Language and score of each text."""
        full = [t for t in texts if len(t)]
        langs, scores = ["und"] * len(texts), [0.0] * len(texts)
        if not full or not self.model.langs:
            return langs, scores
        p, real, sizes = self.posteriors(full)
        starts = np.cumsum(sizes) - sizes
        total = np.add.reduceat(p * real[:, None], starts, axis=0, dtype=np.float64)
        count = np.add.reduceat(real.astype(np.int64), starts)
        rows = [i for i, t in enumerate(texts) if len(t)]
        best = total.argmax(axis=1)
        for i, s, c, b in zip(rows, total, count, best):
            if c:
                langs[i], scores[i] = self.model.langs[b], float(min(1.0, s[b] / c))
        return langs, scores


def tag(model: Crf, text: str) -> list[tuple[str, str, float]]:
    """Each word of a text with its language and posterior."""
    words = text.lower().split()
    if not words or not model.langs:
        return [(w, "und", 0.0) for w in text.split()]
    labeller = Labeller(model)
    p = labeller.posteriors([labeller.numbers(words)])[0]
    return [(w, model.langs[int(r.argmax())], float(r.max())) for w, r in zip(text.split(), p)]


def learn(docs: DataFrame, per_lang: int = PER_LANG) -> Crf:
    """The field from ``docs`` (doc_id, text, lang) that may be learnt from."""
    rows = docs.filter("lang is not null and text is not null and doc_id is not null")
    per = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    pick = F.lit(False)
    for lang, n in per.items():
        pick = pick | ((F.col("lang") == lang) & hash_below("doc_id", min(1.0, per_lang / n)))
    got = rows.filter(pick).select("text", "lang").collect()
    return fit([r["text"] for r in got], [r["lang"] for r in got])


def identified(docs: DataFrame, model: Crf) -> DataFrame:
    """doc_id, lang_pred and score of every text."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    schema = StructType([StructField("doc_id", LongType()), StructField("lang_pred", StringType()),
                         StructField("score", DoubleType())])

    kept: dict[str, Labeller] = {}  # of the task

    def run(batch: pa.RecordBatch):
        labeller = kept.get("own") or kept.setdefault("own", Labeller(held.value))
        ids, texts = batch.column(0), batch.column(1).to_pylist()
        words: list[np.ndarray] = []
        first = tokens = 0
        for i, t in enumerate(texts):
            words.append(labeller.numbers((t or "").lower().split()))
            tokens += len(words[-1])
            if tokens >= TOKENS_AT_ONCE or i == len(texts) - 1:
                langs, scores = labeller.documents(words)
                yield {"doc_id": ids.slice(first, len(words)), "lang_pred": langs, "score": scores}
                first, tokens, words = i + 1, 0, []
                if len(labeller.words) > CACHED:
                    labeller.reset()
    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), run, schema)
