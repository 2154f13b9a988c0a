"""Secrets in texts, with multipart credentials linked by place.

Three strong kinds are reported wherever they stand: ``assign``, ``access``
and ``hex``. Weak candidates are reported only in company: a ``weak`` token
(mixed letters and digits, standing alone), an ``endpoint`` (host or IPv4
address) and a ``login`` (``user=...``) count when a part that complements
them stands within ``SCOPE`` code points in the same text (from the end of the
one to the start of the other), without overlap: a
weak token needs an access key or a login, an endpoint or login needs a strong
part. The parts are joined as intervals, once for each order of the two: an end
is placed in its block of ``SCOPE`` code points and the next one, where it meets
the starts, so the join holds as many pairs as fit a scope, whatever the
lengths of the text and of the parts.

Only DataFrame operations. A null text is empty; each row, repeated or not, is
scanned on its own. Spans are code points, end exclusive. Texts of any length
are scanned whole. Input columns whose names start with ``_s_`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: The base kinds (fixed values), in the order they are listed.
ASSIGN = ("((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
          "|[aA][pP][iI]_?[kK][eE][yY])[\"']?\\x20*[:=]\\x20*[\"']?)([A-Za-z0-9+/_.=-]+)")
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]{16,}"
#: The weak kinds: a run of 20 or more key letters that holds a digit and letters of both cases; the scheme and host
#: of an address, or an IPv4 address; a named user.
WEAK = "[A-Za-z0-9+/_-]{20,}"
ENDPOINT = "[A-Za-z]{2,12}://[A-Za-z0-9._-]+|[0-9]{1,3}(?:\\.[0-9]{1,3}){3}"
LOGIN = "(?:username|user|login|account)\\x20?[:=]\\x20?[A-Za-z0-9_.@-]{2,64}"
SCOPE = 200
KINDS = ("assign", "access", "hex", "weak", "endpoint", "login")
SPAN = "array<struct<start:int,kind:int,end:int>>"


def _spans(text: Column, pattern: str, kind: int, good=None) -> Column:
    """The spans of a pattern's matches. The pieces between the matches give
    their places: a running sum over pieces and matches, as one fold that
    appends to nothing but its own result."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    sizes = F.zip_with(F.slice(gaps, 1, F.size(found)), found,
                       lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("len")))
    step = lambda acc, x: F.struct(
        (acc["at"] + x["gap"] + x["len"]).alias("at"),
        F.concat(acc["out"], F.array(F.struct((acc["at"] + x["gap"]).alias("start"), F.lit(kind).alias("kind"),
                                              (acc["at"] + x["gap"] + x["len"]).alias("end")))).alias("out"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))
    all_ = F.aggregate(sizes, start, step, lambda acc: acc["out"])
    if good is not None:
        kept = good(text, found)
        all_ = F.transform(F.filter(F.arrays_zip(all_.alias("s"), kept.alias("k")), lambda x: x["k"]), lambda x: x["s"])
    return F.when(text.rlike(pattern), all_).otherwise(F.array().cast(SPAN))


def _mixed(text: Column, found: Column) -> Column:
    return F.transform(found, lambda v: v.rlike("[0-9]") & v.rlike("[a-z]") & v.rlike("[A-Z]"))


def scanned(docs: DataFrame) -> DataFrame:
    """``docs`` with the spans of every kind: ``_s_base`` and ``_s_parts``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    strong = [_spans(text, ASSIGN, 0, lambda t, f: F.transform(
                  F.regexp_extract_all(t, F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v) >= 12)),
              _spans(text, ACCESS, 1, lambda t, f: F.transform(f, lambda v: F.length(v) >= 18)),
              _spans(text, HEX, 2)]
    some = lambda spans: F.size(spans) > 0
    base = docs.withColumn("_s_base", F.array_sort(F.concat(*strong)))
    # no weak part counts without a strong part or a login in the same text
    company = some(F.col("_s_base")) | text.rlike(LOGIN)
    weak = F.when(company, F.concat(_spans(text, WEAK, 3, _mixed), _spans(text, ENDPOINT, 4), _spans(text, LOGIN, 5))
                  ).otherwise(F.array().cast(SPAN))
    return base.withColumn("_s_parts", weak)


def linked(found: DataFrame, key: str) -> DataFrame:
    """key, added: the weak spans that stand in company, for rows that have any."""
    row = found.filter(F.size("_s_parts") > 0)
    weak = row.select(key, F.explode("_s_parts").alias("w"))
    near = row.select(key, F.explode(F.concat("_s_base", "_s_parts")).alias("p")).filter("p.kind <> 4")
    fits = ((F.col("w.kind") == 3) & F.col("p.kind").isin(1, 5)) | (F.col("w.kind").isin(4, 5) & F.col("p.kind").isin(0, 1, 2))

    def behind(first: DataFrame, a: str, then: DataFrame, b: str) -> DataFrame:
        """The weak spans of pairs in which ``a`` ends at most ``SCOPE`` before ``b`` starts."""
        ends = first.withColumn("_block", F.explode(F.array(*[F.floor(F.col(f"{a}.end") / SCOPE) + d for d in (0, 1)])))
        starts = then.withColumn("_block", F.floor(F.col(f"{b}.start") / SCOPE))
        gap = F.col(f"{b}.start") - F.col(f"{a}.end")
        return ends.join(starts, [key, "_block"]).filter(fits & gap.between(0, SCOPE)).select(key, "w")
    pairs = behind(weak, "w", near, "p").unionByName(behind(near, "p", weak, "w"))
    return pairs.groupBy(key).agg(F.array_sort(F.collect_set("w")).alias("added"))


def _named(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def reported(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` with ``_s_base`` (strong spans) and
    ``_s_all`` (all spans)."""
    found = written(scanned(docs).select(*keep, "_s_base", "_s_parts")
                    .withColumn("_s_row", F.monotonically_increasing_id()))
    alone = F.size("_s_parts") == 0
    bare = found.filter(alone).withColumn("_s_all", F.col("_s_base"))
    rest = found.filter(~alone).join(linked(found, "_s_row"), "_s_row", "left").withColumn(
        "_s_all", F.array_sort(F.concat("_s_base", F.coalesce("added", F.array().cast(SPAN))))).drop("added")
    return bare.unionByName(rest).drop("_s_row", "_s_parts")


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256, spans; a row per input row."""
    rows = reported(docs.select("doc_id", "text"), keep=["doc_id"])
    count = lambda kind: F.size(F.filter("_s_base", lambda s: s["kind"] == kind)).cast("long")
    return rows.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                       F.sha2(_named(F.col("_s_base")).cast("binary"), 256).alias("base_sha256"),
                       _named(F.col("_s_all")).alias("spans"))


def masked(docs: DataFrame, mask: str = "<secret>") -> DataFrame:
    """``docs`` with every reported span of the text replaced by ``mask``, and
    n_chars, where there is one, counted anew; spans that overlap are replaced
    as one. Rows without a span, and null texts, are unchanged."""
    cols = docs.columns
    rows = reported(docs, keep=cols)
    piece = lambda acc, s: F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"])
    step = lambda acc, s: F.when(s["start"] >= acc["at"], F.struct(
        s["end"].alias("at"), F.concat(acc["out"], piece(acc, s), F.lit(mask)).alias("out"))).otherwise(
        F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out")))
    done = F.aggregate("_s_all", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                       lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.length("text"))))
    hit = F.size("_s_all") > 0
    out = rows.withColumn("text", F.when(hit, done).otherwise(F.col("text")))
    if "n_chars" in cols:
        out = out.withColumn("n_chars", F.when(hit, F.length("text").cast(docs.schema["n_chars"].dataType))
                             .otherwise(F.col("n_chars")))
    return out.select(*cols)
