"""Shared inputs of the registered queries and small helpers that keep the
Spark result and its oracle statement in the same shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rowwise import rnd
from ..operators.clean import clean_codes
from ..operators.features import build_features
from ..schema import INT_FEATURES, LABEL
from ..session import materialize
from ..sources.credit_view import credit_view

RAW_INT = {"ID", "SEX", "EDUCATION", "MARRIAGE", "AGE", "PAY_0", "PAY_2", "PAY_3", "PAY_4",
           "PAY_5", "PAY_6", LABEL}
NON_DOUBLE = RAW_INT | INT_FEATURES | {"AGE_GROUP", "is_test"}


def credit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credit_view(spark, sf_dir)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Credit view with cleaned codes; ID, label and is_test kept."""
    return clean_codes(credit(spark, sf_dir))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_features(cleaned(spark, sf_dir))


def credit_m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The credit view written once (lineage cut) for multi-pass reports."""
    return materialize(credit(spark, sf_dir))


def features_m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table written once (lineage cut) for multi-pass reports."""
    return materialize(features(spark, sf_dir))


def spark_round(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    """Project ``cols``, rounding the double ones."""
    return df.select(*[rnd(F.col(c), digits).alias(c) if c not in NON_DOUBLE else F.col(c)
                       for c in cols])


def sql_round(cols: list[str], digits: int = 6, src: str = "") -> str:
    p = f"{src}." if src else ""
    return ", ".join(f"round(CAST({p}{c} AS DOUBLE), {digits}) + 0.0 AS {c}" if c not in NON_DOUBLE
                     else f"{p}{c} AS {c}" for c in cols)


def r(expr: str, digits: int = 6) -> str:
    """SQL: rounded double."""
    return f"(round(CAST({expr} AS DOUBLE), {digits}) + 0.0)"
