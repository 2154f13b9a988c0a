"""From raw documents to training tokens, in five stages.

Each stage gets all rows that its predecessor wrote and returns the columns of
documents; the last one returns the encoded rows. Empty and null texts pass
the stages as the operators define; repeated rows are reduced to one by the
near-duplicate stage; extra columns pass through to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import bpe, gam, mixing, secrets
from riskloom.llm.bayes_dedup import grouped, text_marks
from riskloom.llm.common import fold, table, written


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the additive model, learnt on two thirds of the labels, rejects."""
    seen = lambda df: df.filter(fold("doc_id", 3) != 1)
    model = gam.learn(seen(docs), seen(table(spark, sf_dir, "labels")))
    out = gam.scored(docs, model, "_quality_score", "_quality")
    return out.filter("_quality = 1").select(*docs.columns)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near copies (0.8 or more of their
    five-word shingles): of the rows with its smallest doc_id, the one whose
    text hashes least. Rows without doc_id are kept. A row is found again by its
    doc_id and the hash of its text, so rows of one id with different texts are
    judged each for itself."""
    found = grouped(docs, width=5).filter("kept and doc_id is not null")
    best = found.groupBy("group").agg(F.min(F.struct("text_a", "text_b", "doc_id")).alias("best"))
    kept = written(best.select("best.*").join(
        found.groupBy("doc_id", "text_a", "text_b").agg(F.count("*").alias("_rows")), ["doc_id", "text_a", "text_b"]))
    keys = ["doc_id", "_text_a", "_text_b"]
    kept = kept.select("doc_id", F.col("text_a").alias("_text_a"), F.col("text_b").alias("_text_b"), "_rows")
    marked = docs.select(*docs.columns, *[c.alias(f"_text_{n}") for c, n in zip(text_marks(), "ab")])
    rows = lambda n: marked.join(kept.filter(n).drop("_rows").hint("shuffle_hash"), keys, "left_semi")
    return (rows("_rows = 1").unionByName(rows("_rows > 1").dropDuplicates(keys)).select(*docs.columns)
            .unionByName(docs.filter("doc_id is null")))


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks every secret in the texts."""
    return secrets.masked(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of its source takes it."""
    sized = mixing.sized(docs)
    rows = written(sized.select("doc_id", "source", "size"))
    out = mixing.copies(sized, rows).filter("copies > 0")
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text, with digests of the ids and of their decoding."""
    import public_tokenizers
    return bpe.encoded(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality classifier", good_quality), ("near-duplicates", no_near_copies), ("secret scan", no_secrets),
          ("source mix", mixed_sources), ("tokens", tokens)]
#: A fitted model and vocabulary merges can't be stated in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
