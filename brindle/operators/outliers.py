"""Outlier rules on one column.  Limits are learned as one row and compared in one scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from brindle.functions.expr import with_params
from brindle.functions.ordered import quantile_row


def beyond_limit(df: DataFrame, column: str, limit: float) -> DataFrame:
    """Rows before, dropped and kept under a fixed limit."""
    over = F.col(column) > limit
    return df.agg(F.count("*").alias("rows_before"), F.count_if(over).alias("dropped"), F.count_if(~over).alias("rows_after"))


def zscores(df: DataFrame, column: str) -> DataFrame:
    p = df.agg(F.avg(column).alias("m"), F.stddev_pop(column).alias("s"))
    return with_params(df, p).withColumn("z", F.coalesce(F.try_divide(F.col(column) - F.col("_p.m"), F.col("_p.s")), F.lit(0.0))).drop("_p")


def iqr_fences(df: DataFrame, column: str, k: float = 1.5) -> DataFrame:
    q = quantile_row(df, {"q1": (column, 0.25), "q3": (column, 0.75)})
    width = F.col("q3") - F.col("q1")
    return q.select((F.col("q1") - k * width).alias("low"), (F.col("q3") + k * width).alias("high"))


def outside_fences(df: DataFrame, column: str, k: float = 1.5) -> DataFrame:
    x = F.col(column)
    return with_params(df, iqr_fences(df, column, k)).where((x < F.col("_p.low")) | (x > F.col("_p.high"))).drop("_p")


def _mad_params(df: DataFrame, column: str) -> DataFrame:
    """One row: the median and the median distance from it."""
    med = quantile_row(df, {"med": (column, 0.5)})
    dev = with_params(df.select(column), med).select(F.abs(F.col(column) - F.col("_p.med")).alias("dev"))
    return med.select("med", quantile_row(dev, {"mad": ("dev", 0.5)}).scalar().alias("mad"))


def modified_zscores(df: DataFrame, column: str) -> DataFrame:
    """0.6745 (x − median) / MAD; 0 where the MAD is 0."""
    z = F.coalesce(F.try_divide(F.lit(0.6745) * (F.col(column) - F.col("_p.med")), F.col("_p.mad")), F.lit(0.0))
    return with_params(df, _mad_params(df, column)).withColumn("mz", z).drop("_p")


def rule_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows flagged by each rule, all rules in one scan."""
    x = F.col(column)
    both = modified_zscores(zscores(df.select(column), column), column)
    fenced = with_params(both, iqr_fences(df, column))
    flags = {"zscore": F.abs("z") > 3, "iqr": (x < F.col("_p.low")) | (x > F.col("_p.high")), "mad": F.abs("mz") > 3.5}
    return fenced.agg(*[F.count_if(f).alias(n) for n, f in flags.items()]).unpivot([], list(flags), "rule", "flagged")


def winsorize(df: DataFrame, column: str, low: float = 0.01, high: float = 0.99, out: str = "clipped") -> DataFrame:
    lim = quantile_row(df, {"lo": (column, low), "hi": (column, high)})
    x = F.col(column)
    return with_params(df, lim).withColumn(out, F.when(x.isNotNull(), F.least(F.greatest(x, F.col("_p.lo")), F.col("_p.hi")))).drop("_p")


def contamination(flag: Column) -> Column:
    """Share of known outliers, never below 0.001."""
    return F.greatest(F.avg(flag.cast("double")), F.lit(1e-3))
