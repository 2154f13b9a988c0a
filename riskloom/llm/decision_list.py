"""Quality rules learnt as a decision list and run as a Spark expression.

Sequential covering on labelled statistics: each rule is a conjunction of
threshold tests grown by information gain on two thirds of the rows, pruned
on the other third, and kept while it is precise enough; the rows it covers
are removed and the next rule is grown. The list becomes one ordered
``CASE WHEN`` over the statistics columns.

Learnt from at most about ``sample`` labelled rows (a repeatable hash sample).
Null and empty texts have zero counts. Without labels of both kinds the list
is empty and keeps everything. Repeated rows are measured one by one.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from .common import arrow_map, hash_below, text_bytes, written
from .textstats import COUNTS, SHARES, measure

SAMPLE, BINS, MOST_TESTS, MOST_RULES, PRECISION = 20_000, 48, 4, 24, 0.9


@dataclass(frozen=True)
class Test:
    name: str
    above: bool
    limit: float

    def holds(self, col: np.ndarray) -> np.ndarray:
        return col > self.limit if self.above else col <= self.limit

    def column(self) -> Column:
        return F.col(self.name) > F.lit(self.limit) if self.above else F.col(self.name) <= F.lit(self.limit)


Rule = tuple[Test, ...]


def covered(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for t in rule:
        out &= t.holds(x[t.name])
    return out


def grow(x: dict[str, np.ndarray], bad: np.ndarray, tests: list[Test]) -> Rule:
    """Adds the test of the largest FOIL gain until nothing good is covered."""
    rule: Rule = ()
    inside = np.ones(len(bad), bool)
    while len(rule) < MOST_TESTS:
        p0, n0 = int(bad[inside].sum()), int((~bad[inside]).sum())
        if not p0 or not n0:
            break
        base, best, pick = log2(p0 / (p0 + n0)), 1e-9, None
        for t in tests:
            got = inside & t.holds(x[t.name])
            p, n = int(bad[got].sum()), int((~bad[got]).sum())
            if p:
                gain = p * (log2(p / (p + n)) - base)
                if gain > best:
                    best, pick = gain, t
        if pick is None:
            break
        rule += (pick,)
        inside &= pick.holds(x[pick.name])
    return rule


def prune(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """The prefix of the rule with the best (p - n) / (p + n) on held-back rows."""
    best, keep = -2.0, rule
    for k in range(1, len(rule) + 1):
        got = covered(rule[:k], x, len(bad))
        p, n = int(bad[got].sum()), int((~bad[got]).sum())
        worth = (p - n) / (p + n) if p + n else -1.0
        if worth > best + 1e-12:
            best, keep = worth, rule[:k]
    return keep


def learn_rules(x: dict[str, np.ndarray], bad: np.ndarray) -> list[Rule]:
    """Rules for rejecting, in the order they are tried."""
    n = len(bad)
    if not n or bad.all() or not bad.any():
        return []
    back = np.arange(n) % 3 == 2
    tests = [Test(name, above, float(limit)) for name, col in x.items()
             for limit in np.unique(np.quantile(col, np.linspace(0, 1, BINS + 1), method="nearest"))
             for above in (True, False)]
    left, rules = np.ones(n, bool), []
    while len(rules) < MOST_RULES and bad[left].any():
        part = lambda mask: ({k: v[left & mask] for k, v in x.items()}, bad[left & mask])
        rule = grow(*part(~back), tests)
        rule = prune(rule, *part(back)) if rule else rule
        if not rule:
            break
        got = left & covered(rule, x, n)
        hits = int(bad[got].sum())
        if hits < max(3, n // 5000) or hits < PRECISION * int(got.sum()):
            break
        rules.append(rule)
        left &= ~got
    return rules


def rejects(rules: list[Rule]) -> Column:
    """The list as one conditional expression: true where a rule fires."""
    out = None
    for rule in rules:
        test = rule[0].column()
        for t in rule[1:]:
            test = test & t.column()
        out = F.when(test, F.lit(True)) if out is None else out.when(test, F.lit(True))
    return F.lit(False) if out is None else out.otherwise(F.lit(False))


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id with the COUNTS and SHARES of every text."""
    schema = StructType([StructField("doc_id", LongType()), *(StructField(c, LongType()) for c in COUNTS),
                         *(StructField(c, DoubleType()) for c in SHARES)])

    def run(batch):
        rows = [measure(t) for t in text_bytes(batch)]
        out = {"doc_id": batch.column(0)}
        out |= {c: [r[0][k] for r in rows] for k, c in enumerate(COUNTS)}
        out |= {c: [r[1][k] for r in rows] for k, c in enumerate(SHARES)}
        yield out
    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), run, schema)


def judged(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[DataFrame, list[Rule]]:
    """Statistics with base_failed and kept for every document, and the rules."""
    stats = written(statistics(docs))
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    marks = (labels.filter("quality in (0, 1) and doc_id is not null")
             .groupBy("doc_id").agg(F.min("quality").alias("_label")))
    share = min(1.0, sample / max(1, marks.count()))
    got = (stats.filter(hash_below("doc_id", share)).filter(~base)
           .join(marks.filter(hash_below("doc_id", share)), "doc_id")
           .select("doc_id", "_label", *SHARES).toPandas().sort_values("doc_id", kind="stable"))
    rules = learn_rules({c: got[c].to_numpy(np.float64) for c in SHARES}, got["_label"].to_numpy() == 0)
    return stats.withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & ~rejects(rules)), rules
