"""Scalers.  `fit_*` gives one row of parameters, `apply_*` attaches it and rewrites the columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from brindle.functions.expr import ratio, with_params
from brindle.functions.ordered import quantile_row


def fit_zscore(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[e for c in columns for e in (F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_sd"))])


def fit_minmax(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[e for c in columns for e in (F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"))])


def fit_robust(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    wanted = {f"{c}_{n}": (c, p) for c in columns for n, p in (("q1", 0.25), ("med", 0.5), ("q3", 0.75))}
    return quantile_row(df, wanted)


def _rewrite(df: DataFrame, params: DataFrame, columns: Sequence[str], rule) -> DataFrame:
    joined = with_params(df, params)
    return joined.withColumns({c: rule(F.col(c), lambda n, c=c: F.col(f"_p.{c}_{n}")) for c in columns}).drop("_p")


def _or_zero(num: Column, den: Column) -> Column:
    """A constant column has no spread: it becomes 0, missing values stay missing."""
    return F.when(den == 0, F.when(num.isNotNull(), 0.0)).otherwise(ratio(num, den))


def apply_zscore(df: DataFrame, params: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _rewrite(df, params, columns, lambda x, p: _or_zero(x - p("mean"), p("sd")))


def invert_zscore(df: DataFrame, params: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _rewrite(df, params, columns, lambda z, p: z * p("sd") + p("mean"))


def apply_minmax(df: DataFrame, params: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _rewrite(df, params, columns, lambda x, p: _or_zero(x - p("min"), p("max") - p("min")))


def apply_robust(df: DataFrame, params: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _rewrite(df, params, columns, lambda x, p: _or_zero(x - p("med"), p("q3") - p("q1")))


def normalize_rows(df: DataFrame, columns: Sequence[str], norm: str = "l2") -> DataFrame:
    """Each row divided by its own l1, l2 or max norm; an all-zero row stays zero."""
    parts = [F.abs(F.col(c)) for c in columns]
    size = {
        "l2": lambda: F.sqrt(sum((F.col(c) * F.col(c) for c in columns), F.lit(0.0))),
        "l1": lambda: sum(parts, F.lit(0.0)),
        "max": lambda: F.greatest(*parts),
    }[norm]()
    sized = df.withColumn("_norm", size)
    return sized.withColumns({c: _or_zero(F.col(c), F.col("_norm")) for c in columns}).drop("_norm")


def spread_under_scalers(df: DataFrame, column: str, bulk: float) -> DataFrame:
    """Range and standard deviation of the bulk (original value below a limit) raw and under each scaler."""
    x = F.col(column)
    base = df.select(x.alias("raw"), x.alias("zscore"), x.alias("minmax"), x.alias("robust"))
    base = apply_zscore(base, fit_zscore(base, ["zscore"]), ["zscore"])
    base = apply_minmax(base, fit_minmax(base, ["minmax"]), ["minmax"])
    base = apply_robust(base, fit_robust(base, ["robust"]), ["robust"])
    names = ["raw", "zscore", "minmax", "robust"]
    aggs = [
        F.struct(
            F.lit(n).alias("scaler"), (F.max(n) - F.min(n)).alias("range"),
            F.stddev_pop(F.when(F.col("raw") < bulk, F.col(n))).alias("bulk_sd"),
        ).alias(n)
        for n in names
    ]
    return base.agg(*aggs).select(F.explode(F.array(*names)).alias("r")).select("r.*")
