"""File sources and sinks (§2.1): CSV with header, JSON records, text lines,
parquet tables and JSON reports — always with a declared schema on read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import nan_to_null


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header row; malformed fields become NULL (PERMISSIVE);
    NaN is turned into NULL, the engine's single notion of missing."""
    df = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
          .option("nanValue", "NaN").csv(path))
    return nan_to_null(df)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by=None) -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)
    return path


def read_json_records(spark: SparkSession, path: str, schema: T.StructType,
                      corrupt_col: str = "_corrupt_record") -> DataFrame:
    """JSON lines with a fixed schema; a record whose fields do not fit the
    types keeps its text in ``_corrupt_record`` (the invalid-request case)."""
    s = T.StructType(list(schema.fields) + [T.StructField(corrupt_col, T.StringType())])
    return (spark.read.schema(s).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", corrupt_col).json(path))


def invalid_records(records: DataFrame, corrupt_col: str = "_corrupt_record") -> DataFrame:
    return records.filter(F.col(corrupt_col).isNotNull())


def write_report_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).json(path)
    return path


def read_report_json(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def write_insights_text(lines: DataFrame, path: str, col: str = "insight") -> str:
    """Lines in their order, which a range-sorted input keeps: its files are
    numbered in it, and readers take them by name."""
    lines.select(F.col(col).cast("string").alias("value")).write.mode("overwrite").text(path)
    return path
