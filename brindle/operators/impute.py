"""Imputation: replacements are learned on training rows and applied as one projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from brindle.functions.expr import with_params
from brindle.functions.ordered import quantile_row
from brindle.operators.knn import knn_join
from brindle.operators.scale import apply_zscore, fit_zscore


def impute_constant(df: DataFrame, fill: dict[str, object]) -> DataFrame:
    return df.fillna(fill)


def fit_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return quantile_row(df, {c: (c, 0.5) for c in columns})


def fit_mode(df: DataFrame, column: str) -> DataFrame:
    """Most frequent value; the smallest one on ties."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
    return counts.agg(F.min_by(column, F.struct(-F.col("_n"), F.col(column))).alias(column))


def apply_fill(df: DataFrame, params: DataFrame, columns: Sequence[str], indicator: bool = False) -> DataFrame:
    """Null → learned value, optionally with a 0/1 column that says where it was missing."""
    joined = with_params(df, params)
    marks = {f"{c}_missing": F.col(c).isNull().cast("int") for c in columns} if indicator else {}
    filled = {c: F.coalesce(F.col(c), F.col(f"_p.{c}")) for c in columns}
    return joined.withColumns({**marks, **filled}).drop("_p")


def impute_knn(df: DataFrame, key: str, target: str, columns: Sequence[str], k: int = 5, is_train: Column | None = None) -> DataFrame:
    """Missing `target` → mean of the k nearest rows that have it, in standardized space.

    Distances ignore coordinates missing on either side and are scaled up for them; equal distances
    are settled by key.  `columns` includes the target.
    """
    learn = df if is_train is None else df.where(is_train)
    params = fit_zscore(learn, columns)
    scaled = apply_zscore(df.select(key, *columns), params, columns)
    others = [c for c in columns if c != target]
    vector = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in others])
    gaps = scaled.where(F.col(target).isNull()).select(F.col(key).alias("qid"), vector.alias("vec"))
    donors = scaled.where(F.col(target).isNotNull()).select(F.col(key).alias("id"), vector.alias("vec"), F.col(target).alias("payload"))
    near = knn_join(gaps, donors, k, metric="nan_euclidean")
    means = near.groupBy("qid").agg(F.avg("payload").alias("_z"))
    back = with_params(means, params).select(
        F.col("qid").alias(key), (F.col("_z") * F.col(f"_p.{target}_sd") + F.col(f"_p.{target}_mean")).alias("_fill"))
    return df.join(back, key, "left").withColumn(target, F.coalesce(F.col(target).cast("double"), "_fill")).drop("_fill")
