"""The derived credit view: one borrower row per customer, built from
``customer``, ``orders`` and ``lineitem`` (mapping in FIXTURES.md §7).

Plan shape, chosen for scale:

* ``lineitem`` is reduced to one row per order by a partial (map-side)
  aggregation before its shuffle, so a hot order key costs nothing extra.
  Money is summed exactly, as integers (two-place price × two-place discount),
  so the rounded cents do not depend on summation order.
* the six latest orders per customer come from ``row_number() <= 6`` directly
  over the window; Spark plans this as a ``WindowGroupLimit`` on both sides of
  the shuffle, so a customer holding a third of all orders sends at most six
  rows per map task.
* the pivot is a ``groupBy(o_custkey)`` of at most six rows per key, and the
  final customer join reuses that hash partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schema import BILL, LABEL, PAMT, PAY
from .tables import read_table

N_MONTHS = 6


def _hundredths(col: str) -> F.Column:
    """A two-place amount held as a double, in whole hundredths."""
    return F.floor(F.col(col) * 100 + 0.5).cast("long")


def _paid_per_order(lineitem: DataFrame) -> DataFrame:
    """(l_orderkey, paid): whole ten-thousandths of money, summed as integers."""
    return (lineitem.groupBy("l_orderkey")
            .agg(F.sum(_hundredths("l_extendedprice") * _hundredths("l_discount")).alias("paid")))


def _money(paid: F.Column) -> F.Column:
    """Ten-thousandths to a two-place amount, halves away from zero."""
    return F.signum(paid) * F.floor((F.abs(paid) + 50) / 100) / 100


def _latest_orders(orders: DataFrame, k: int = N_MONTHS) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy(F.col("o_orderdate").desc(), F.col("o_orderkey").desc())
    return (orders
            .select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                    "o_orderdate", "o_orderpriority")
            .withColumn("k", F.row_number().over(w))
            .filter(F.col("k") <= k))


def _pay_status() -> F.Column:
    return (F.when(F.col("o_orderstatus") == "F", F.lit(-1))
            .when(F.col("o_orderstatus") == "O", F.lit(0))
            .otherwise(F.substring("o_orderpriority", 1, 1).cast("int")))


def credit_view_from(customer: DataFrame, orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Raw borrower table (26 columns: ID, 23 fields, is_default, is_test)."""
    latest = (_latest_orders(orders)
              .join(_paid_per_order(lineitem), F.col("o_orderkey") == F.col("l_orderkey"), "left")
              .select("o_custkey", "k",
                      _pay_status().alias("pay"),
                      F.col("o_totalprice").alias("bill"),
                      _money(F.coalesce(F.col("paid"), F.lit(0)).cast("double")).alias("amt")))
    months = []
    for i in range(N_MONTHS):
        months.append(F.max(F.when(F.col("k") == i + 1, F.col("pay"))).alias(PAY[i]))
        months.append(F.max(F.when(F.col("k") == i + 1, F.col("bill"))).alias(BILL[i]))
        months.append(F.max(F.when(F.col("k") == i + 1, F.col("amt"))).alias(PAMT[i]))
    pivot = latest.groupBy("o_custkey").agg(*months)

    key = F.col("c_custkey")
    base = customer.select(
        key.alias("ID"),
        (F.lit(10000) + F.floor(F.greatest(F.col("c_acctbal"), F.lit(0.0)) * 50)).cast("double").alias("LIMIT_BAL"),
        (F.lit(1) + key % 2).cast("int").alias("SEX"),
        (key % 7).cast("int").alias("EDUCATION"),
        (F.floor(key / 7) % 4).cast("int").alias("MARRIAGE"),
        (F.lit(21) + (key * 7) % 55).cast("int").alias("AGE"),
        (F.substring(F.md5(key.cast("string")), 1, 8) < F.lit("33333333")).alias("is_test"),
    )
    joined = base.join(pivot, F.col("ID") == F.col("o_custkey"), "left")
    label = (F.when(((F.col("PAY_0") >= 2) & (F.col("ID") % 3 != 0)) | (F.col("ID") % 11 == 0), F.lit(1))
             .otherwise(F.lit(0)))
    return joined.select(
        "ID", "LIMIT_BAL", "SEX", "EDUCATION", "MARRIAGE", "AGE",
        *PAY, *BILL, *PAMT,
        label.alias(LABEL), "is_test")


def credit_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credit_view_from(read_table(spark, sf_dir, "customer"),
                            read_table(spark, sf_dir, "orders"),
                            read_table(spark, sf_dir, "lineitem"))
