"""The registered queries of the subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bayes_dedup import near_duplicates
from .bpe import encoded
from .common import fold, table, written
from .crf_langid import identified
from .crf_langid import learn as learn_languages
from .crosspoly import nearest
from .decision_list import judged
from .gam import learn, scored
from .mixing import copies, sized
from .ngram_lm import scored as lm_scored
from .prefix_trie import SQL as TRIE_SQL
from .prefix_trie import prefix_trie
from .secrets import find_secrets
from .source_audit import SQL as AUDIT_SQL
from .source_audit import divergence
from .toxicity import learn as learn_lexicon
from .toxicity import scored as toxic_scored
from .warc import archived


def op7_ngram_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = lm_scored(docs, fold("doc_id", 5) != 1)
    return out.select("doc_id", (fold("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                      "base_score", "score")


def op8_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _ = judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept")


def op9_additive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    seen = lambda df: df.filter(fold("doc_id", 3) != 1)
    model = learn(seen(docs), seen(table(spark, sf_dir, "labels")))
    return scored(docs, model).select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


def op10_bayes_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op1_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op2_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = written(sized(table(spark, sf_dir, "documents")).select("doc_id", "source", "size"))
    return copies(rows, rows).select("doc_id", "size", "source_size", "target",
                                     (F.col("copies") * F.col("size")).alias("taken"))


def op3_linked_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))


def op4_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = learn_languages(docs.filter(fold("doc_id", 4) != 2))
    return identified(docs, model).select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op5_rank_array_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    out = encoded(table(spark, sf_dir, "documents").select("doc_id", "text"),
                  public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op6_seekable_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(table(spark, sf_dir, "pages"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))


def op13_toxic_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    seen = lambda df: df.filter(fold("doc_id", 4) != 2)
    lexicon = learn_lexicon(seen(docs), seen(table(spark, sf_dir, "labels")))
    return toxic_scored(docs, lexicon).select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


QUERIES = {f.__name__: f for f in (
    op1_cross_polytope, op2_pareto_mix, op3_linked_secrets, op4_crf_language, op5_rank_array_bpe, op6_seekable_warc,
    op7_ngram_trie, op8_decision_list, op9_additive_quality, op10_bayes_dedup, op11_prefix_trie, op12_source_divergence,
    op13_toxic_lexicon)}
#: The others are learnt, sampled or hashed, or need a vocabulary.
SQL: dict[str, str] = {"op11_prefix_trie": TRIE_SQL, "op12_source_divergence": AUDIT_SQL}
