"""Combining forecasts given as (series, h, model, yhat)."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F


def mean_median(forecasts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean and median over models; the median orders the few models of one point."""
    return forecasts.groupBy(*keys).agg(F.avg("yhat").alias("mean_fc"), F.median("yhat").alias("median_fc"))


def inverse_rmse_weights(validation: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by…, model, weight): weights ∝ 1 / RMSE on validation rows (y, yhat), summing to 1.

    Models without any error share all the weight; the others then get 0.
    """
    e = F.col("y") - F.col("yhat")
    rmse = validation.groupBy(*by, "model").agg(F.sqrt(F.avg(e * e)).alias("_e"))
    group = Window.partitionBy(*by)
    perfect = F.count_if(F.col("_e") == 0).over(group)
    inverse = F.try_divide(F.lit(1.0), F.col("_e"))
    weight = F.when(perfect > 0, (F.col("_e") == 0).cast("double") / perfect).otherwise(inverse / F.sum(inverse).over(group))
    return rmse.select(*by, "model", weight.alias("weight"))


def weighted(forecasts: DataFrame, weights: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    return forecasts.join(weights, [*by, "model"]).groupBy(*keys).agg(F.sum(F.col("yhat") * F.col("weight")).alias("combined"))


def _nonnegative(gram: np.ndarray, moment: np.ndarray, rounds: int = 5000) -> np.ndarray:
    """Non-negative least squares on the normal equations by cyclic coordinate steps."""
    w = np.zeros(len(moment))
    for _ in range(rounds):
        before = w.copy()
        for j in range(len(w)):
            if gram[j, j] > 0:
                w[j] = max(0.0, w[j] + (moment[j] - gram[j] @ w) / gram[j, j])
        if np.max(np.abs(w - before)) < 1e-12:
            break
    return w


def stacking_weights(validation: DataFrame, keys: Sequence[str], models: Sequence[str]) -> dict[str, float]:
    """Non-negative weights without intercept; the driver sees the k×k moment matrix only."""
    wide = validation.groupBy(*keys).pivot("model", list(models)).agg(F.first("yhat")).join(validation.select(*keys, "y").distinct(), list(keys))
    k = range(len(models))
    sums = [F.sum(F.col(models[i]) * F.col(models[j])).alias(f"g{i}_{j}") for i in k for j in k] + [F.sum(F.col(models[i]) * F.col("y")).alias(f"b{i}") for i in k]
    row = wide.agg(*sums).first()
    gram = np.array([[row[f"g{i}_{j}"] for j in k] for i in k], dtype=float)
    moment = np.array([row[f"b{i}"] for i in k], dtype=float)
    return dict(zip(models, (float(x) for x in _nonnegative(gram, moment))))
