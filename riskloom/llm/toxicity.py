"""Toxicity by a weighted lexicon, matched by an Aho-Corasick automaton.

Texts are folded first: compatibility forms and case, look-alike letters of
other scripts, invisible characters, and digits or signs that stand for letters
inside a word. A lexicon entry is a word, or a stem that longer words begin with; its weight
is the log of how much likelier toxic documents hold it than clean ones.
Entries are learnt from labelled documents by covering: each has a likelihood
ratio statistic beyond chance among the toxic documents that the others leave
unexplained. Phrases around an entry that are at home in clean documents become
exceptions; matches inside one don't count, nor do those in phrases handed to
``learn``. The sum of weights is divided by a learnt power of the text's length
and mapped to 0..1 by a logistic curve, fitted so that 0.3 is the cut.

The lexicon is fitted on at most about ``sample`` labelled rows (a repeatable
hash sample of the labelled ids), its size bounded by ``ENTRIES``. Whole texts
are scored, however long, in one pass each. Null and empty texts, and texts
without a match, get the curve's value at 0. Labels other than 0 and 1 are
ignored; a doc_id with both counts as 1. Without a toxic labelled row the
lexicon is empty and every score 0. An empty table gives an empty table; extra
columns pass through, and an input column named like an output column is
replaced. Repeated rows are scored each.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from .common import hash_below, written

SAMPLE, ENTRIES, CUT = 20_000, 5_000, 0.3
#: Likelihood-ratio statistic (chi-square, one degree) and share of toxic documents an entry needs.
EVIDENCE, PRECISION = 24.0, 0.4
#: What a document counts for an entry beside each chosen entry in it.
COMPANY = 0.6
STEMS = range(3, 9)
POWERS = (0.05, 0.1, 0.2, 0.35, 0.5, 0.75, 1.0)
#: Words at which the divisor of the length begins to grow.
LENGTH_UNIT = 100.0

# Letters of other scripts that look like Latin ones.
LOOKALIKES = {"а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t",
              "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "ԁ": "d", "ɡ": "g", "һ": "h", "ӏ": "l", "ո": "n",
              "ս": "u", "օ": "o", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
              "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ʟ": "l", "ɪ": "i", "ѵ": "v", "ԛ": "q", "ԝ": "w"}
# Digits and signs written for letters.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}
# Characters that show nothing.
INVISIBLE = "­​‌‍⁠﻿"

_LETTERS = str.maketrans(LOOKALIKES | {c: "" for c in INVISIBLE})
_SIGNS = str.maketrans(SUBSTITUTES)
_SIGNS_L = str.maketrans(SUBSTITUTES | {"1": "l"})
_WORD = re.compile(r"[^\W_]+(?:[@$]+[^\W_]+)*|[@$]+[^\W\d_][^\W_]*")
_SIGN = re.compile(r"[\d@$]")
_LETTER = re.compile(r"[^\W\d_]")
_RUN = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """The folded words of a text. A word written with a 1 that may be an i or
    an l is followed by its second reading."""
    if not text:
        return []
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    text = text.lower()
    if not text.isascii():
        text = text.translate(_LETTERS)
    if not _SIGN.search(text):
        return _RUN.findall(text)
    out: list[str] = []
    for w in _WORD.findall(text):
        if w.isalpha():
            out.append(w)
        elif _LETTER.search(w):
            out += _RUN.findall(w.translate(_SIGNS))
            if "1" in w:
                out += _RUN.findall(w.translate(_SIGNS_L))
    return out


@dataclass
class Lexicon:
    """Entries (" word ", or " stem" of longer words) with their weights, exception phrases, and
    the curve: logit = at_zero + slope * weights / (1 + words / unit) ** power."""

    entries: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    at_zero: float = -35.0
    slope: float = 0.0
    power: float = POWERS[0]

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_automaton"}

    def _machine(self):
        if not hasattr(self, "_automaton"):
            import ahocorasick
            self._automaton = ahocorasick.Automaton()
            for e in {*self.entries, *self.exceptions}:
                self._automaton.add_word(e, (len(e), self.entries.get(e), e in self.exceptions))
            if len(self._automaton):
                self._automaton.make_automaton()
        return self._automaton

    def hits(self, words: list[str]) -> list[tuple[int, float]]:
        """(position in the joined words, weight) of each word that an entry
        matches outside exceptions, with the largest weight of its entries."""
        machine = self._machine()
        if not len(machine) or not words:
            return []
        best: dict[int, float] = {}
        free: list[tuple[int, int]] = []
        line = f" {' '.join(words)} "
        for end, (size, weight, exempt) in machine.iter(line):
            start = end - size + 1
            if weight is not None and (line[end] == " " or line[end + 1] != " "):  # a stem goes on
                best[start] = max(weight, best.get(start, 0.0))
            if exempt:
                free.append((start, end))
        if free:
            free.sort()
            reach, at, kept = -1, 0, {}
            for start in sorted(best):
                while at < len(free) and free[at][0] <= start:
                    reach, at = max(reach, free[at][1]), at + 1
                if start >= reach:
                    kept[start] = best[start]
            best = kept
        return sorted(best.items())

    def density(self, weight: np.ndarray, words: np.ndarray) -> np.ndarray:
        return weight / (1 + words / LENGTH_UNIT) ** self.power

    def score(self, weight: np.ndarray, words: np.ndarray) -> np.ndarray:
        z = self.at_zero + self.slope * self.density(weight, words)
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def _patterns(words: set[str]) -> set[str]:
    """Every entry that a document could support."""
    out = {f" {w} " for w in words if len(w) >= STEMS[0]}
    for w in words:
        out.update(f" {w[:n]}" for n in STEMS if n < len(w))
    return out


def _texts(batch: pa.RecordBatch, name: str = "text") -> list[str | None]:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def _counted(rows: DataFrame, keys) -> DataFrame:
    """(key, toxic, clean): documents of each label that hold a key, where
    ``keys`` gives the set of keys of a text. Counts are summed over a batch
    before they are shuffled."""
    schema = StructType([StructField("key", StringType()), StructField("toxic", LongType()),
                         StructField("clean", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = batch.column(1).to_pylist()
            seen = (Counter(), Counter())
            for text, y in zip(_texts(batch), marks):
                seen[y].update(keys(text))
            names = list(seen[0] | seen[1])
            for lo in range(0, len(names), 100_000):
                part = names[lo:lo + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part), pa.array([seen[1][k] for k in part], pa.int64()),
                     pa.array([seen[0][k] for k in part], pa.int64())], ["key", "toxic", "clean"])
    return rows.mapInArrow(run, schema).groupBy("key").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _evidence(rate: float) -> Column:
    """Likelihood-ratio statistic of a key's toxic share against the share ``rate``."""
    n = F.col("toxic") + F.col("clean")
    term = lambda k, p: F.when(k > 0, k * F.log(k / n / F.lit(p))).otherwise(0.0)
    return 2 * (term(F.col("toxic"), rate) + term(F.col("clean"), 1 - rate))


def _chosen(found: list[tuple[str, int, int]], held: list[list[int]], toxic: int, clean: int) -> dict[str, float]:
    """Entries with weights, by sequential covering: the entry with the most
    evidence in the toxic documents, again and again, where a document counts
    less (``COMPANY``) for each chosen entry in it. So words that only come along
    with others stay out. A word or stem that begins like a chosen one must
    stand on the documents without it. ``held`` has, for each toxic document,
    the places of its entries in ``found``."""
    rate = toxic / (toxic + clean)
    spare = np.array([c for _, _, c in found], np.float64)
    docs_of: list[set[int]] = [set() for _ in found]
    inside = [set(places) for places in held]
    for d, places in enumerate(held):
        for i in places:
            docs_of[i].add(d)
    kin: dict[str, list[int]] = {}
    for i, (key, _, _) in enumerate(found):
        kin.setdefault(key[:STEMS[0] + 1], []).append(i)
    share = np.ones(len(held))
    left = np.array([len(x) for x in docs_of], np.float64)
    out: dict[str, float] = {}
    while len(found):
        n = np.maximum(left + spare, 1e-9)
        gain = 2 * (left * np.log(np.maximum(left, 1e-9) / n / rate)
                    + np.where(spare > 0, spare * np.log(np.maximum(spare, 1e-9) / n / (1 - rate)), 0.0))
        gain[left < PRECISION * n] = 0.0
        best = int(gain.argmax())  # the first of equals: ``found`` is ordered
        if gain[best] < EVIDENCE:
            break
        key, t, c = found[best]
        out[key] = log((t + 0.5) / (toxic + 1)) - log((c + 0.5) / (clean + 1))
        covered = set(docs_of[best])
        for i in kin[key[:STEMS[0] + 1]]:
            for d in docs_of[i] & covered:
                inside[d].discard(i)
                left[i] -= share[d]
            docs_of[i] -= covered
        for d in covered:
            share[d] *= COMPANY
            left[list(inside[d])] -= share[d] / COMPANY - share[d]
    return out


def _curve(weight: np.ndarray, words: np.ndarray, y: np.ndarray, lexicon: Lexicon) -> None:
    """The power of the length and the logistic curve with the least loss; the
    rows are weighted so that the cut of 0.3 balances both labels' errors."""
    side = np.where(y == 1, CUT / (1 - CUT) * (y == 0).sum() / max(1, (y == 1).sum()), 1.0)
    best = None
    for power in POWERS:
        lexicon.power = power
        d = lexicon.density(weight, words)
        x = np.column_stack([np.ones(len(d)), d])
        beta, ridge = np.zeros(2), np.diag([1e-6, 1e-2])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -35, 35)))
            grad = x.T @ (side * (y - p)) - ridge @ beta
            step = np.linalg.solve((x.T * (side * np.maximum(p * (1 - p), 1e-9))) @ x + ridge, grad)
            beta = beta + np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-8:
                break
        p = np.clip(1 / (1 + np.exp(-np.clip(x @ beta, -35, 35))), 1e-12, 1 - 1e-12)
        loss = -(side * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum()
        if best is None or loss < best[0] - 1e-9:
            best = (loss, power, beta)
    lexicon.power, (lexicon.at_zero, lexicon.slope) = best[1], map(float, best[2])


def learn(docs: DataFrame, labels: DataFrame, exceptions: tuple[str, ...] = (), sample: int = SAMPLE) -> Lexicon:
    """The lexicon from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic);
    both may be filtered beforehand to the rows that may be learnt from."""
    marks = (labels.filter("toxic in (0, 1) and doc_id is not null")
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("_label")))
    share = min(1.0, sample / max(1, marks.count()))
    rows = written(docs.select("doc_id", "text").filter(hash_below("doc_id", share))
                   .join(marks.filter(hash_below("doc_id", share)), "doc_id").select("text", "_label"))
    size = {r["_label"]: r["n"] for r in rows.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = size.get(1, 0), size.get(0, 0)
    fixed = tuple(f" {' '.join(words_of(e))} " for e in exceptions if words_of(e))
    if not toxic:
        return Lexicon(exceptions=fixed)
    rate = min(max(toxic / (toxic + clean), 1e-6), 1 - 1e-6)
    stats = (_counted(rows, lambda text: _patterns(set(words_of(text))))
             .withColumn("_g", _evidence(rate)).filter("toxic > 0").filter(F.col("_g") >= EVIDENCE)
             .filter(F.col("toxic") >= PRECISION * (F.col("toxic") + F.col("clean"))))
    found = [tuple(r) for r in stats.orderBy(F.desc("_g"), F.length("key"), "key").limit(ENTRIES)
             .select("key", "toxic", "clean").collect()]
    place = {key: i for i, (key, _, _) in enumerate(found)}

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [sorted(place[k] for k in _patterns(set(words_of(t))) if k in place) for t in _texts(batch)]
            yield pa.RecordBatch.from_arrays([pa.array(got, pa.list_(pa.int32()))], ["held"])

    held = [r["held"] for r in rows.filter("_label = 1").mapInArrow(places, "held array<int>").collect()]
    lexicon = Lexicon(_chosen(found, held, toxic, clean), fixed)

    def phrases(text: str | None) -> set[str]:
        words = words_of(text)
        at, pos = {}, 0
        for i, w in enumerate(words):
            at[pos], pos = i, pos + len(w) + 1
        out = set()
        for start, _ in lexicon.hits(words):
            i = at[start]
            out.update(f" {' '.join(words[j:j + 2])} " for j in (i - 1, i) if 0 <= j < len(words) - 1)
        return out

    home = (_counted(rows, phrases).withColumn("_g", _evidence(rate)).filter("clean >= 3 and clean >= 9 * toxic")
            .orderBy(F.desc("clean"), "key").limit(ENTRIES).select("key").collect())
    lexicon = Lexicon(lexicon.entries, tuple(sorted({*fixed, *(r["key"] for r in home)})))
    got = measured(rows, lexicon).select("_weight", "_words", "_label").toPandas()
    order = np.lexsort((got["_label"], got["_words"], got["_weight"]))  # the fit doesn't depend on the rows' order
    _curve(*(got[c].to_numpy(np.float64)[order] for c in ("_weight", "_words", "_label")), lexicon)
    return lexicon


def _weighed(texts: list[str | None], lexicon: Lexicon) -> list[pa.Array]:
    """Sum of weights, number of words and number of matched words of each text."""
    rows = []
    for text in texts:
        words = words_of(text)
        hits = lexicon.hits(words)
        rows.append((sum(w for _, w in hits), len(words), len(hits)))
    return [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.float64(), pa.int64(), pa.int64()))]


def measured(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(_weight, _words, _hits, _label) of ``rows`` (text, _label)."""
    schema = StructType([StructField("_weight", DoubleType()), StructField("_words", LongType()),
                         StructField("_hits", LongType()), StructField("_label", IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*_weighed(_texts(batch), lexicon), batch.column(1)], schema.names)
    return rows.mapInArrow(run, schema)


def scored(docs: DataFrame, lexicon: Lexicon, score: str = "score", predicted: str = "predicted",
           n_hits: str = "n_hits") -> DataFrame:
    """``docs`` with the score, the predicted label and the number of matched words of each text."""
    docs = docs.drop(score, predicted, n_hits)
    schema = StructType([*docs.schema.fields, StructField(score, DoubleType()),
                         StructField(predicted, IntegerType()), StructField(n_hits, LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weight, size, count = _weighed(_texts(batch), lexicon)
            s = lexicon.score(weight.to_numpy(), size.to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s), pa.array((s >= CUT).astype(np.int32)), count],
                                             schema.names)
    return docs.mapInArrow(run, schema)
