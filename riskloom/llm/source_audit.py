"""How far the sources of a language differ in their words.

Identical texts of a language are collapsed first: one row per text with the
number of its rows in each source. Each text is tokenised once; its document
frequencies and term counts are added with these multiplicities. Terms are
maximal runs of ASCII letters (lower-cased) and non-ASCII characters. A
language keeps the terms in at least ``LEAST`` of its documents. With N the
occurrences of kept terms in a group and V the kept terms of its language, a
term of a group has p = 1 + floor(10^9 (count + 2) / (N + 2 V)), and two groups
differ in it by f = floor((p - q)^2 / (p + q)). All of it is whole numbers.

Pairs are evaluated sparsely. With p0 the p of an absent term,

    sum f(p_s, p_r) = sum over s of f(p_s, p0_r) + sum over r of f(p_r, p0_s)
                      - V f(p0_s, p0_r)
                      + sum over shared terms of
                        f(p_s, p_r) - f(p_s, p0_r) - f(p_r, p0_s) + f(p0_s, p0_r),

where the first two sums run over the few distinct counts of a source and the
last over terms present in both, in parts of terms dealt by hash.

Null text, lang and source are read as ''. Empty texts have no terms, but
their groups are reported. Repeated rows count as often as they occur. Ties are
ordered by the item's UTF-8. Very long texts are tokenised whole. An empty
table gives an empty report; a language without kept terms gives pairs of value
0 and no terms. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import arrow_groups, forget, written

LEAST, SCALE, TERM_RANKS = 10, 1_000_000_000, 10
#: Sums held by a task before it hands them on, and entries of one part of the shared terms.
HELD, PART = 400_000, 250_000
SALTS = 32

_FOLD = bytes((b + 32 if 65 <= b <= 90 else b) if 97 <= b <= 122 or 65 <= b <= 90 or b >= 128 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def collapsed(docs: DataFrame) -> DataFrame:
    """(lang, text, sources): every distinct text of a language once, with the
    number of its rows in each source.

    Copies are added up before the texts are dealt, within each batch, so a text
    with a third of all rows reaches its task as a row per batch and source."""
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "text", "source")))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = Counter(zip(*(c.cast(pa.binary()).to_pylist() for c in batch.columns)))
            cols = [pa.array(list(c), pa.binary()).cast(pa.string()) for c in (zip(*n) if n else ((), (), ()))]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(list(n.values()), pa.int64())],
                                             ["lang", "text", "source", "n"])
    part = rows.mapInArrow(merge, "lang string, text string, source string, n long")
    return (part.repartition("lang", "text").groupBy("lang", "text", "source").agg(F.sum("n").alias("n"))
            .groupBy("lang", "text").agg(F.collect_list(F.struct("source", "n")).alias("sources")))


def _tallies(texts: DataFrame) -> DataFrame:
    """(lang, source, term, n, df): occurrences and documents; term '' marks the group itself."""
    def flush(groups: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, df) in groups.items():
            terms, m = list(df), len(df) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang]).take(pa.array([0] * m)), pa.array([source]).take(pa.array([0] * m)),
                 pa.array([b"", *terms], pa.binary()).cast(pa.string()),
                 pa.array([0, *map(n.__getitem__, terms)], pa.int64()), pa.array([0, *df.values()], pa.int64())],
                ["lang", "source", "term", "n", "df"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        held = 0
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for lang, text, sources in zip(batch.column(0).to_pylist(), texts, batch.column(2).to_pylist()):
                terms = terms_of(text)
                once = set(terms)
                for entry in sources:
                    n, df = groups.setdefault((lang, entry["source"]), (Counter(), Counter()))
                    held, times = held - len(df), entry["n"]
                    if times == 1:
                        n.update(terms)
                        df.update(once)
                    else:
                        for term, count in Counter(terms).items():
                            n[term] += count * times
                            df[term] += times
                    held += len(df)
                if held > HELD:
                    yield from flush(groups)
                    groups, held = {}, 0
        yield from flush(groups)
    return (texts.mapInArrow(run, "lang string, source string, term string, n long, df long")
            .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df")))


def _p(count: str, total: str, terms: str) -> Column:
    """1 + floor(10^9 (count + 2) / (total + 2 terms)) in decimals; null without terms."""
    return F.expr(f"1 + (CAST({SCALE} AS DECIMAL(10, 0)) * (CAST({count} AS DECIMAL(20, 0)) + 2)) "
                  f"DIV nullif(CAST({total} AS DECIMAL(20, 0)) + 2 * CAST({terms} AS DECIMAL(20, 0)), 0)")


def _f(p: str, q: str) -> Column:
    return F.expr(f"({p} - {q}) * ({p} - {q}) DIV ({p} + {q})")


def _differ(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _shared(rows: DataFrame) -> DataFrame:
    """(lang, a, b, value): what terms present in both a < b add, per part."""
    def run(t: pa.Table) -> dict:
        term = np.unique(np.asarray(t["term"].to_pylist(), object), return_inverse=True)[1]
        names, source = np.unique(np.asarray(t["source"].to_pylist(), object), return_inverse=True)
        order = np.lexsort((source, term))
        term, source = term[order], source[order]
        p, p0 = (t[c].to_numpy()[order] for c in ("p", "p0"))
        sums: dict[int, int] = {}
        alive, step = np.arange(len(term)), 1
        while True:  # each entry with the entry ``step`` places on, while the term is the same
            alive = alive[alive + step < len(term)]
            alive = alive[term[alive] == term[alive + step]]
            if not len(alive):
                break
            i, j = alive, alive + step
            value = _differ(p[i], p[j]) - _differ(p[i], p0[j]) - _differ(p0[i], p[j]) + _differ(p0[i], p0[j])
            pair, at = np.unique(source[i] * len(names) + source[j], return_inverse=True)
            total = np.zeros(len(pair), np.int64)
            np.add.at(total, at, value)
            for k, v in zip(pair.tolist(), total.tolist()):
                sums[k] = sums.get(k, 0) + v
            step += 1
        return {"lang": [t["lang"][0].as_py()] * len(sums), "a": [names[k // len(names)] for k in sums],
                "b": [names[k % len(names)] for k in sums], "value": list(sums.values())}
    schema = StructType([StructField(c, StringType()) for c in ("lang", "a", "b")] + [StructField("value", LongType())])
    return arrow_groups(rows, ["lang", "part"], run, schema)


def divergence(docs: DataFrame, least: int = LEAST, ranks: int = TERM_RANKS) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank, as the module's text defines."""
    tallies = written(_tallies(collapsed(docs)))
    terms = tallies.filter("term <> ''")
    kept = written(terms.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("df").alias("df"))
                   .filter(F.col("df") >= least).drop("df"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    counts = written(terms.drop("df").join(kept, ["lang", "term"]))
    groups = (tallies.filter("term = ''").select("lang", "source")
              .join(counts.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("present")),
                    ["lang", "source"], "left")
              .join(langs, "lang", "left").na.fill(0, ["total", "present", "v", "lang_total"])
              .withColumn("p0", _p("0", "total", "v")))
    groups = written(groups)
    forget(tallies, kept)

    # (lang, source, term, p, p0, q): every occurring kept term of every group
    known = counts.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", _p("n", "total", "v").alias("p"), "p0",
        _p("lang_n", "lang_total", "v").alias("q"))
    known = written(known)
    forget(counts)

    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    term_part = (known.filter("p > q").select("lang", "source", F.lit("term").alias("part"),
                                              F.col("term").alias("item"), _f("p", "q").alias("value"))
                 .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= ranks))

    # the sums against absent terms, from the distinct counts of each source; the absent
    # terms of both count once, so the smaller name of a pair leaves V of them to the other
    spread = (known.groupBy("lang", "source", "p").agg(F.count("*").alias("k")).withColumn("less", F.lit(0).cast("long"))
              .unionByName(groups.select("lang", "source", F.col("p0").alias("p"),
                                         (F.col("v") - F.col("present")).alias("k"), F.col("v").alias("less")))
              .withColumn("salt", F.pmod(F.xxhash64("source", "p"), F.lit(SALTS))))
    others = groups.select("lang", F.col("source").alias("other"), F.col("p0").alias("q0"),
                           F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")).alias("salt"))
    times = F.col("k") - F.when(F.col("source") < F.col("other"), F.col("less")).otherwise(0)
    absent = (spread.join(others, ["lang", "salt"]).filter("source <> other")
              .select("lang", F.col("source").alias("a"), F.col("other").alias("b"),
                      (times * _f("p", "q0")).alias("value")))
    both = lambda df: df.unionByName(df.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    parts = max(1, -(-known.count() // PART))
    shared = _shared(known.select("lang", F.pmod(F.xxhash64("term"), F.lit(parts)).alias("part"),
                                  "source", "term", "p", "p0"))
    pair_part = (both(absent.unionByName(shared))
                 .groupBy("lang", F.col("a").alias("source"), F.col("b").alias("item"))
                 .agg(F.coalesce(F.sum("value"), F.lit(0)).alias("value"))
                 .select("lang", "source", F.lit("pair").alias("part"), "item", "value")
                 .withColumn("rank", F.row_number().over(best)))
    return pair_part.unionByName(term_part)


#: DuckDB statement of the whole report, dense and without collapsing.
SQL = r"""
WITH docs AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text,
                     row_number() OVER () AS id FROM documents),
words AS (SELECT id, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= 10),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term)
           GROUP BY lang, source, term),
totals AS (SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total FROM groups LEFT JOIN counts USING (lang, source)
           GROUP BY lang, source),
p AS (SELECT lang, source, term, coalesce(c.n, 0) AS n,
             1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (t.total + 2 * l.v) AS p,
             1 + (1000000000::HUGEINT * (k.n + 2)) // (l.total + 2 * l.v) AS q
      FROM totals t JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
          FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
          GROUP BY a.lang, a.source, b.source),
every AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
          FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
          UNION ALL
          SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM every QUALIFY part = 'pair' OR rank <= 10
"""
