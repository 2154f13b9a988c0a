"""Deterministic sampling and train/test splitting by hashing the key.

A row's side depends only on its own key, so splitting needs no shuffle and is
stable under recomputation (an executor loss cannot move rows between sides).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rowwise import rnd
from ..schema import LABEL
from ..session import materialize


def key_hash(key: str = "ID", seed: int = 42):
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))


def frac_to_hex(frac: float) -> str:
    return format(min(int(frac * 16 ** 8), 16 ** 8 - 1), "08x")


def sample_n(df: DataFrame, n: int, seed: int = 42, key: str = "ID") -> DataFrame:
    """n rows chosen by the smallest key hashes: a top-k (each task keeps its n
    best, the driver merges), reproducible in any engine."""
    return df.orderBy(key_hash(key, seed)).limit(n)


def stratified_split(df: DataFrame, test_frac: float = 0.2, seed: int = 42, key: str = "ID",
                     label: str = LABEL, exact: bool = False) -> DataFrame:
    """Adds ``split`` = 'test' | 'train'. The hash is independent of the
    class, so each class is cut at the same share (stratified in expectation).
    ``exact=True``: per class exactly round(test_frac · n_class) rows go to
    test — those with the smallest key hashes, ranked by the cumulative-count
    kernel (no per-class sort in one task)."""
    if exact:
        return _exact_split(df, test_frac, seed, key, label)
    cut = frac_to_hex(test_frac)
    h = F.substring(key_hash(key, seed), 1, 8)
    return df.withColumn("split", F.when(h < F.lit(cut), F.lit("test")).otherwise(F.lit("train")))


def split_info(split_df: DataFrame, label: str = LABEL) -> DataFrame:
    """Rows and label rate of train, test and the full table in one pass
    (rollup: the total comes from the same partial aggregates)."""
    return (split_df.rollup("split")
            .agg(F.count(F.lit(1)).alias("n_rows"), rnd(F.avg(label)).alias("default_rate"))
            .select(F.coalesce(F.col("split"), F.lit("full")).alias("split"), "n_rows", "default_rate"))


def kfold_column(df: DataFrame, k: int = 3, seed: int = 42, key: str = "ID", name: str = "fold",
                 label: str | None = None) -> DataFrame:
    """Fold id 0..k-1 from the key hash (stratified in expectation). With
    ``label``: within each class the rows are dealt to the folds in turn by
    their hash ranks, so fold sizes of a class differ by one at most; rows of
    one key get one fold. Rows without a class keep the fold of the hash."""
    h = F.conv(F.substring(key_hash(key, seed), 1, 8), 16, 10).cast("long")
    by_hash = (h % F.lit(k)).cast("int")
    if label is None:
        return df.withColumn(name, by_hash)
    hk, cum = _hash_ranks(df, seed, key, label)
    dealt = cum.select("_cls", F.col("value").alias("_h"), F.pmod(F.col("cum_n") - 1, F.lit(k)).cast("int").alias("_f"))
    return (hk.join(dealt, ["_cls", "_h"], "left")
            .withColumn(name, F.coalesce("_f", by_hash)).drop("_cls", "_h", "_f"))


def _hash_ranks(df: DataFrame, seed: int, key: str, label: str) -> tuple[DataFrame, DataFrame]:
    """``df`` with its class and key hash, and the running counts of the
    hashes in each class."""
    from .ranks import cumulative_counts, value_counts
    # 52-bit hash prefix: exact as a double; equal prefixes (ties) share a rank
    h = F.conv(F.substring(key_hash(key, seed), 1, 13), 16, 10).cast("long").cast("double")
    hk = df.withColumn("_cls", F.col(label)).withColumn("_h", h)
    counts = materialize(value_counts(hk.select("_cls", F.col("_h").alias("value")), ["_cls"], "value"), spread=False)
    return hk, cumulative_counts(counts, ["_cls"], ["n"], n_keys_bound=1000)


def _exact_split(df: DataFrame, test_frac: float, seed: int, key: str, label: str) -> DataFrame:
    hk, cum = _hash_ranks(df, seed, key, label)
    test = (cum.filter(F.col("cum_n") <= F.floor(F.col("tot_n") * F.lit(test_frac) + F.lit(0.5)))
            .select("_cls", F.col("value").alias("_h"), F.lit(True).alias("_in")))
    return (hk.join(test, ["_cls", "_h"], "left")
            .withColumn("split", F.when(F.col("_in"), F.lit("test")).otherwise(F.lit("train")))
            .drop("_cls", "_h", "_in"))
