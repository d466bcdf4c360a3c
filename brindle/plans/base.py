"""Inputs several query modules share, with the same tables as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from brindle.sources.files import table

SALES = """sales AS (SELECT l_orderkey, l_linenumber, l_orderkey * 8 + l_linenumber AS row_id, l_quantity, l_discount, l_tax,
  l_extendedprice, p_size, p_retailprice, p_brand, p_type FROM lineitem JOIN part ON l_partkey = p_partkey)"""

DAILY = """daily AS (SELECT l_returnflag AS series, CAST(l_shipdate AS DATE) AS day, sum(round(l_extendedprice * 100)::BIGINT)::DOUBLE AS y
  FROM lineitem GROUP BY 1, 2)"""

GAPPY = """gappy AS (SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS day, sum(round(o_totalprice * 100)::BIGINT)::DOUBLE AS y
  FROM orders GROUP BY 1, 2)"""


def cents(column: str) -> Column:
    """Money as whole cents: sums of integers do not depend on the order of addition."""
    return F.round(F.col(column) * 100).cast("bigint")


def sales(spark: SparkSession, sf: str) -> DataFrame:
    """Line items with their part: the regression table."""
    item, part = table(spark, sf, "lineitem"), table(spark, sf, "part")
    return item.join(part, item.l_partkey == part.p_partkey).select(
        "l_orderkey", "l_linenumber", (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_id"), "l_quantity",
        "l_discount", "l_tax", "l_extendedprice", "p_size", "p_retailprice", "p_brand", "p_type",
    )


def daily(spark: SparkSession, sf: str) -> DataFrame:
    """Gap-free daily revenue (cents) per return flag."""
    return table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("series"), F.to_date("l_shipdate").alias("day")).agg(
        F.sum(cents("l_extendedprice")).cast("double").alias("y"))


def gappy(spark: SparkSession, sf: str) -> DataFrame:
    """Daily order value (cents) per priority; days without an order are missing."""
    return table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("series"), F.to_date("o_orderdate").alias("day")).agg(
        F.sum(cents("o_totalprice")).cast("double").alias("y"))
