"""Prefix trie, source divergence and toxicity: brute force, SQL, odd inputs, held-out accuracy."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from riskloom.llm import prefix_trie as trie
from riskloom.llm import queries, source_audit, toxicity
from riskloom.llm.common import fold, table

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
CONV = "conv_id long, turn long, role string, text string"


def brute_trie(rows):
    """The nodes by explicit rebuilt sequences."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(v)] for c, v in convs.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        rebuilt[c] = tuple(turns.get(base, [])[:h] + own[h:])
    nodes = defaultdict(list)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            nodes[seq[:d]].append(c)
    kids = Counter(p[:-1] for p in nodes if p)
    leaves, saved = Counter(), Counter()
    for p, members in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(members) - 1) * (len(p[-1][1].encode()) if p else 0)
    out = set()
    for p, m in nodes.items():
        ends = ",".join(str(c) for c in sorted(m) if len(rebuilt[c]) == len(p))
        out.add((min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
                 hashlib.sha256(ends.encode()).hexdigest()))
    return out


def rows_of(df):
    return [tuple(r) for r in df.collect()]


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def nodes_of(df):
    assert df.columns == COLUMNS
    got = rows_of(df)
    assert len(got) == len(set(got))
    return set(got)


def odd_conversations():
    rows = [(0, t, "user", f"turn {t}") for t in range(12)]                       # a base longer than any head
    rows += [(c, t, "user", f"turn {t}") for c in (1, 2, 3) for t in range(12)]   # copies of it
    rows += [(4, 0, "user", "turn 0"), (4, None, "assistant", "first"), (4, 1, None, None), (4, 1, None, None)]
    rows += [(c, 0, "user", "hello") for c in range(6, 40, 3)]                    # one turn, most without a base
    rows += [(-3, 5, "user", "é" * 40), (-5, 5, "user", "é" * 40), (-5, 6, "a", ""), (-5, 6, "", "a")]
    rows += [(50, t, "user", "x" * (t % 3)) for t in range(200)]
    rows += [(c, t, "user", "x" * (t % 3)) for c in (55, 56) for t in range(200 - c % 2 * 20)]
    rows += [(2 ** 62, 0, "user", "w " * 50_000), (None, 0, "user", "nobody"), (60, None, "u", "b"), (60, None, "u", "a")]
    return rows


def test_trie_equals_brute_force_and_sql(spark):
    convs = table(spark, SF, "conversations")
    got = nodes_of(queries.op11_prefix_trie(spark, SF))
    assert got == brute_trie(rows_of(convs.select("conv_id", "turn", "role", "text")))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    assert got == set(con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({queries.SQL['op11_prefix_trie']})").fetchall())


def test_trie_odd_rows(spark):
    rows = odd_conversations()
    clash = {c: F.lit("x") for c in ("block", "k", "node", "depth", "_tie", "members", "piece", "hi")}
    df = spark.createDataFrame(rows, CONV).repartition(5).withColumns(clash)
    assert nodes_of(trie.prefix_trie(df)) == brute_trie(rows)
    assert nodes_of(trie.prefix_trie(spark.createDataFrame([(7, 1, "u", "t")], CONV))) == brute_trie([(7, 1, "u", "t")])
    assert trie.prefix_trie(spark.createDataFrame([], CONV)).count() == 0
    assert trie.prefix_trie(spark.createDataFrame([(None, 1, "u", "t")], CONV)).count() == 0


def test_trie_never_trusts_equal_fingerprints(spark):
    rows = odd_conversations()
    df = spark.createDataFrame(rows, CONV)
    weak = ((31, 7), *trie.FIELDS[:1])
    assert nodes_of(trie.prefix_trie(df, weak)) == brute_trie(rows)
    with pytest.raises(ValueError):
        trie.prefix_trie(df, weak[:1])


def test_trie_hot_keys_take_the_broadcast_way(spark, monkeypatch):
    monkeypatch.setattr(trie, "HOT_ROWS", 3)
    monkeypatch.setattr(trie, "HOT_SHARE", 20)
    rows = odd_conversations()
    assert nodes_of(trie.prefix_trie(spark.createDataFrame(rows, CONV))) == brute_trie(rows)


def brute_divergence(rows, least=10):
    groups, df, n = set(), Counter(), Counter()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in TERM.findall(text or "")]
        df.update((lang, w) for w in set(words))
        n.update((lang, source, w) for w in words)
    out = set()
    for lang in {g[0] for g in groups}:
        kept = [w for (g, w), d in df.items() if g == lang and d >= least]
        sources = [s for g, s in groups if g == lang]
        v = len(kept)
        count = lambda s, w: n[lang, s, w]
        size = {s: sum(count(s, w) for w in kept) for s in sources}
        whole = sum(size.values())
        p = {(s, w): 1 + 10 ** 9 * (count(s, w) + 2) // (size[s] + 2 * v) for s in sources for w in kept}
        q = {w: 1 + 10 ** 9 * (sum(count(s, w) for s in sources) + 2) // (whole + 2 * v) for w in kept}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(-sum(f(p[s, w], p[r, w]) for w in kept), r.encode()) for r in sources if r != s]
            terms = [(-f(p[s, w], q[w]), w.encode()) for w in kept if count(s, w) and p[s, w] > q[w]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:10])):
                out |= {(lang, s, part, item.decode(), -value, i + 1) for i, (value, item) in enumerate(items)}
    return out


def test_divergence_equals_brute_force_and_sql(spark):
    rows = rows_of(table(spark, SF, "documents").select("text", "lang", "source"))
    got = rows_of(queries.op12_source_divergence(spark, SF))
    assert len(got) == len(set(got)) and set(got) == brute_divergence(rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert set(got) == set(con.execute(queries.SQL["op12_source_divergence"]).fetchall())


def test_divergence_odd_rows(spark, odd, none, monkeypatch):
    rows = rows_of(odd.select("text", "lang", "source"))
    extra = [("Same words HERE été", "en", s) for s in ("a", "a", "b", "c") for _ in range(300)]
    extra += [(None, "en", "quiet"), ("", None, None), ("only here", "xx", "solo"), ("@1 _ 2", "yy", "z")]
    df = odd.select("text", "lang", "source").unionByName(spark.createDataFrame(extra, "text string, lang string, source string"))
    clash = {c: F.lit("x") for c in ("n", "term", "part", "salt", "p0", "item")}
    for least, part in ((10, 250_000), (1, 50)):
        monkeypatch.setattr(source_audit, "PART", part)
        got = rows_of(source_audit.divergence(df.withColumns(clash), least))
        assert len(got) == len(set(got)) and set(got) == brute_divergence(rows + extra, least)
    assert source_audit.divergence(none).count() == 0


def test_collapse_counts_every_copy_once(spark):
    df = spark.createDataFrame([("t", "en", "a")] * 5 + [("t", "en", "b"), ("t", "fr", "a"), (None, None, None)],
                               "text string, lang string, source string")
    got = {(r.lang, r.text): {x["source"]: x["n"] for x in r.sources} for r in source_audit.collapsed(df).collect()}
    assert got == {("en", "t"): {"a": 5, "b": 1}, ("fr", "t"): {"a": 1}, ("", ""): {"": 1}}


def lexicon(exceptions=()):
    out = toxicity.Lexicon({" idiot ": 6.0, " scu": 5.0, " trash ": 4.0}, exceptions)
    out.at_zero, out.slope, out.power = -4.0, 2.0, 0.1
    return out


def test_folding_and_matching():
    words = toxicity.words_of
    assert words("You 1D10T, Ѕtupid $cum ｔｒａｓｈ") == ["you", "idiot", "ldlot", "stupid", "scum", "trash"]
    assert words("id​iot t1me 555-123 10.0.0.1") == ["idiot", "time", "tlme"]
    assert words(None) == words("") == words(" \n 12 @") == []
    at = lambda text, lex=lexicon(): [w for _, w in lex.hits(words(text))]
    assert at("an IDIOT idiots scumbag escum scu trash") == [6.0, 5.0, 4.0]
    assert at("idiot idiot") == [6.0, 6.0] and at("") == []
    assert at("a trash can of trash", lexicon((" trash can ",))) == [4.0]
    assert at("idiot trash can idiot", lexicon((" trash can ",))) == [6.0, 6.0]


def test_toxicity_odd_rows(spark, odd, none, labels):
    learnt = toxicity.learn(odd, labels)
    for lex in (learnt, lexicon()):
        out = toxicity.scored(odd, lex)
        assert out.columns[:3] == ["doc_id", "text", "lang"] and out.count() == odd.count()
        assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out.collect())
        assert toxicity.scored(none, lex).count() == 0
    empty = toxicity.learn(none, labels)
    assert not empty.entries and max(r.score for r in toxicity.scored(odd, empty).collect()) < 0.01


def test_lexicon_learns_words_stems_and_exceptions(spark):
    rows = []
    for i in range(400):
        filler = " ".join(f"w{(i * 7 + j * 13) % 97:02d}abc"[1:].replace("0", "q") for j in range(20))
        toxic = i % 8 == 0
        text = filler + ((" vexx%s" % "abcdefgh"[i // 8 % 8]) if toxic else "")
        if i % 4 == 1:
            text += " big moron bird"
        if i % 16 == 0:
            text += " moron"
        rows.append((i, text, int(toxic)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    lex = toxicity.learn(df.drop("toxic"), df)
    assert any(e.startswith(" vex") and not e.endswith(" ") for e in lex.entries)
    got = toxicity.scored(df, lex).collect()
    assert all(r.predicted == r.toxic for r in got)


def test_toxicity_on_unseen_documents(spark):
    sf = "/root/testdata/sf0.1"
    out = queries.op13_toxic_lexicon(spark, sf)
    got = out.join(table(spark, sf, "labels").select("doc_id", "toxic"), "doc_id").filter("held_out").collect()
    right = sum(r.predicted == r.toxic for r in got) / len(got)
    caught = sum(r.predicted for r in got if r.toxic) / sum(r.toxic for r in got)
    assert right > 0.96 and caught > 0.85
    assert out.count() == table(spark, sf, "documents").count()
    assert out.filter(F.col("held_out") != (fold("doc_id", 4) == 2)).count() == 0
