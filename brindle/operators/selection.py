"""Feature scores from single-pass aggregates."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

from brindle.functions.expr import with_params
from brindle.functions.ordered import quantile_row


def variance_threshold(df: DataFrame, columns: Sequence[str], threshold: float = 0.0) -> DataFrame:
    rows = df.agg(*[F.var_pop(c).alias(c) for c in columns]).unpivot([], list(columns), "feature", "variance")
    return rows.withColumn("kept", F.col("variance") > threshold)


def abs_correlation(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    return df.agg(*[F.abs(F.corr(c, target)).alias(c) for c in columns]).unpivot([], list(columns), "feature", "score")


@F.pandas_udf(T.DoubleType())
def f_survival(f: pd.Series, dof: pd.Series) -> pd.Series:
    """P(F(1, dof) > f) through Student's t, by numerical integration of its density on the tail."""
    out = []
    nodes, weights = np.polynomial.legendre.leggauss(200)
    for value, nu in zip(f, dof):
        if value is None or np.isnan(value) or nu <= 0:
            out.append(None)
            continue
        # t = √ν·tan θ turns the tail into a finite integral of cos(θ)^(ν−1)
        a, b = np.arctan(np.sqrt(value / nu)), np.pi / 2
        scale = 1.0 / np.sqrt(max(nu, 1.0))
        top = min(b, a + 40 * scale)
        theta = 0.5 * (top - a) * nodes + 0.5 * (top + a)
        tail = 0.5 * (top - a) * np.sum(weights * np.cos(theta) ** (nu - 1))
        full_top = min(b, 40 * scale)
        theta0 = 0.5 * full_top * nodes + 0.5 * full_top
        whole = 0.5 * full_top * np.sum(weights * np.cos(theta0) ** (nu - 1))
        out.append(float(tail / whole))
    return pd.Series(out, dtype="float64")


def f_regression(df: DataFrame, columns: Sequence[str], target: str, p_values: bool = True) -> DataFrame:
    """(feature, f, p_value) of the single-feature linear relation."""
    facts = df.agg(F.count(target).alias("_n"), *[F.corr(c, target).alias(c) for c in columns])
    rows = facts.unpivot(["_n"], list(columns), "feature", "r")
    r2, dof = F.col("r") * F.col("r"), (F.col("_n") - 2).cast("double")
    out = rows.select("feature", F.try_divide(r2 * dof, 1 - r2).alias("f"), dof.alias("_dof"))
    return out.select("feature", "f", f_survival("f", "_dof").alias("p_value")) if p_values else out.drop("_dof")


def mutual_information(df: DataFrame, columns: Sequence[str], target: str, bins: int = 10) -> DataFrame:
    """Plug-in mutual information (nats) between quantile bins of each feature and of the target."""
    every = [*columns, target]
    edges = quantile_row(df, {f"{c}_{i}": (c, i / bins) for c in every for i in range(1, bins)})
    binned = with_params(df.select(*[F.col(c).cast("double").alias(c) for c in every]), edges).select(
        *[sum((F.col(c) >= F.col(f"_p.{c}_{i}")).cast("int") for i in range(1, bins)).alias(c) for c in every]
    )
    joint = binned.unpivot([target], list(columns), "feature", "x").groupBy("feature", "x", F.col(target).alias("y")).agg(F.count("*").alias("nxy"))
    # the joint table has features × bins² rows at most
    cells = joint.select(
        "*", F.sum("nxy").over(Window.partitionBy("feature", "x")).alias("nx"), F.sum("nxy").over(Window.partitionBy("feature", "y")).alias("ny"),
        F.sum("nxy").over(Window.partitionBy("feature")).alias("n"))
    term = F.col("nxy") / F.col("n") * F.ln(F.col("nxy") * F.col("n") / (F.col("nx") * F.col("ny")))
    return cells.groupBy("feature").agg(F.sum(term).alias("score"))


def select_k_best(scores: DataFrame, k: int, score: str = "score") -> DataFrame:
    return scores.orderBy(F.desc(score), "feature").limit(k)
