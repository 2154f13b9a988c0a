"""Quality by a generalised additive model with pairwise interactions.

Each statistic of a text is binned; boosting goes round the features in turn,
each time fitting a shallow tree on one feature's bins to the residuals and
adding it to that feature's lookup table. Then the pairs of features that
explain most of what is left get two-way tables the same way. A score is the
logistic of the intercept plus one table entry per feature and pair, computed
for whole batches by array indexing.

The model is fitted on at most about ``sample`` labelled rows (a repeatable
hash sample of the labelled ids). Null and empty texts have a score like any
other. Labels other than 0 and 1 are ignored; a doc_id with both counts as 0.
Without a labelled row every score is 0.5. Extra columns pass through; an
input column named like an output column is replaced.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from .common import arrow_map, hash_below, text_bytes
from .textstats import SHARES, measure

SAMPLE, BINS, PAIR_BINS, ROUNDS, PAIRS, RATE = 20_000, 32, 8, 150, 6, 0.15


@dataclass
class Gam:
    """Cut points per feature, a table per feature, and tables for pairs."""

    cuts: list[np.ndarray]
    intercept: float
    mains: list[np.ndarray]
    pair_cuts: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.intercept)
        for k, (cut, tab) in enumerate(zip(self.cuts, self.mains)):
            out += tab[np.searchsorted(cut, x[:, k], side="right")]
        for (i, j), tab in self.pairs.items():
            out += tab[np.searchsorted(self.pair_cuts[i], x[:, i], side="right"),
                       np.searchsorted(self.pair_cuts[j], x[:, j], side="right")]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -35, 35)))


def _cuts(col: np.ndarray, bins: int) -> np.ndarray:
    """Bin limits at quantiles of the distinct-valued column."""
    return np.unique(np.quantile(col, np.linspace(0, 1, bins + 1)[1:-1]))


def _leaf(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g / (h + 1.0)


def _tree(g: np.ndarray, h: np.ndarray, leaves: int = 4) -> np.ndarray:
    """A piecewise-constant fit over ordered bins: the best cut, again and again."""
    parts = [(0, len(g))]
    value = lambda lo, hi: (g[lo:hi].sum() ** 2) / (h[lo:hi].sum() + 1.0)
    while len(parts) < leaves:
        best = None
        for at, (lo, hi) in enumerate(parts):
            if hi - lo < 2:
                continue
            gl, hl = np.cumsum(g[lo:hi])[:-1], np.cumsum(h[lo:hi])[:-1]
            gr, hr = g[lo:hi].sum() - gl, h[lo:hi].sum() - hl
            gain = gl ** 2 / (hl + 1.0) + gr ** 2 / (hr + 1.0) - value(lo, hi)
            k = int(gain.argmax())
            if best is None or gain[k] > best[0]:
                best = (gain[k], at, lo + k + 1)
        if best is None or best[0] <= 1e-9:
            break
        lo, hi = parts.pop(best[1])
        parts += [(lo, best[2]), (best[2], hi)]
    out = np.empty(len(g))
    for lo, hi in parts:
        out[lo:hi] = _leaf(g[lo:hi].sum(), h[lo:hi].sum())
    return out


def _quarters(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best one cut on each side of a two-way table: gain and fitted table."""
    gs, hs = (np.pad(a.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for a in (g, h))
    best, out = 0.0, np.zeros_like(g)
    whole = gs[-1, -1] ** 2 / (hs[-1, -1] + 1.0)
    n, m = g.shape
    for i in range(1, n):
        for j in range(1, m):
            q = []
            for s in (gs, hs):
                a, b, c, d = s[i, j], s[i, m], s[n, j], s[n, m]
                q.append(np.array([[a, b - a], [c - a, d - b - c + a]]))
            gain = (q[0] ** 2 / (q[1] + 1.0)).sum() - whole
            if gain > best:
                v = _leaf(q[0], q[1])
                best, out = gain, np.empty_like(g)
                out[:i, :j], out[:i, j:], out[i:, :j], out[i:, j:] = v[0, 0], v[0, 1], v[1, 0], v[1, 1]
    return best, out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, pairs: int = PAIRS) -> Gam:
    """Cyclic boosting of the main tables, then of the tables of the chosen pairs."""
    d = x.shape[1] if x.size else len(SHARES)
    if not len(y):
        return Gam([np.empty(0)] * d, 0.0, [np.zeros(1)] * d)
    rate = min(max(y.mean(), 1e-3), 1 - 1e-3)
    cuts = [_cuts(x[:, k], BINS) for k in range(d)]
    coarse = [_cuts(x[:, k], PAIR_BINS) for k in range(d)]
    model = Gam(cuts, float(np.log(rate / (1 - rate))), [np.zeros(len(c) + 1) for c in cuts], coarse)
    at = [np.searchsorted(c, x[:, k], side="right") for k, c in enumerate(cuts)]
    margin = np.full(len(y), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(margin, -35, 35)))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for k in range(d):
            g, h = slopes()
            size = len(cuts[k]) + 1
            step = RATE * _tree(np.bincount(at[k], g, size), np.bincount(at[k], h, size))
            model.mains[k] += step
            margin += step[at[k]]
    low = [np.searchsorted(c, x[:, k], side="right") for k, c in enumerate(coarse)]

    def grid(i: int, j: int, w: np.ndarray) -> np.ndarray:
        n, m = len(coarse[i]) + 1, len(coarse[j]) + 1
        return np.bincount(low[i] * m + low[j], w, n * m).reshape(n, m)

    g, h = slopes()
    gains = sorted(((_quarters(grid(i, j, g), grid(i, j, h))[0], i, j) for i in range(d) for j in range(i)),
                   reverse=True)[:pairs]
    for _ in range(rounds // 5):
        for gain, i, j in gains:
            if gain <= 0:
                continue
            g, h = slopes()
            step = RATE * _quarters(grid(i, j, g), grid(i, j, h))[1]
            model.pairs[i, j] = model.pairs.get((i, j), 0) + step
            margin += step[low[i], low[j]]
    return model


def _features(texts: list[bytes]) -> np.ndarray:
    return np.array([measure(t)[1] for t in texts], dtype=np.float64).reshape(-1, len(SHARES))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Gam:
    """The model from ``docs`` (doc_id, text) and ``labels`` (doc_id, quality);
    both may be filtered beforehand to the rows that may be learnt from."""
    marks = (labels.filter("quality in (0, 1) and doc_id is not null")
             .groupBy("doc_id").agg(F.min("quality").alias("_label")))
    share = min(1.0, sample / max(1, marks.count()))
    schema = StructType([StructField("x", ArrayType(DoubleType())), StructField("y", IntegerType())])
    rows = (docs.select("doc_id", "text").filter(hash_below("doc_id", share))
            .join(marks.filter(hash_below("doc_id", share)), "doc_id").select("text", "_label"))
    got = arrow_map(rows, lambda b: [{"x": list(_features(text_bytes(b))), "y": b.column(1)}], schema).toPandas()
    x = np.array(got["x"].tolist(), dtype=np.float64).reshape(len(got), len(SHARES))
    y = got["y"].to_numpy(np.float64)
    order = np.lexsort((*x.T, y)) if len(y) else np.arange(0)  # the fit doesn't depend on the rows' order
    return fit(x[order], y[order])


def scored(docs: DataFrame, model: Gam, score: str = "score", predicted: str = "predicted") -> DataFrame:
    """``docs`` with the score and the predicted label of each text."""
    docs = docs.drop(score, predicted)
    schema = StructType([*docs.schema.fields, StructField(score, DoubleType()),
                         StructField(predicted, IntegerType())])

    def run(batch: pa.RecordBatch):
        s = model.score(_features(text_bytes(batch)))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                                         [f.name for f in schema.fields])
    return arrow_map(docs, run, schema)
