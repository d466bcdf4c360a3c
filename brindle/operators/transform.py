"""Power transforms, binning and derived columns."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from brindle.functions.expr import with_params
from brindle.functions.ordered import quantile_row


def box_cox(x: Column, lam: float) -> Column:
    """Defined for positive values; others give null."""
    y = F.ln(x) if abs(lam) < 1e-12 else (F.pow(x, F.lit(lam)) - 1) / lam
    return F.when(x > 0, y)


def yeo_johnson(x: Column, lam: float) -> Column:
    up = F.log1p(x) if abs(lam) < 1e-12 else (F.pow(x + 1, F.lit(lam)) - 1) / lam
    down = -F.log1p(-x) if abs(lam - 2) < 1e-12 else -(F.pow(1 - x, F.lit(2 - lam)) - 1) / (2 - lam)
    return F.when(x >= 0, up).otherwise(down)


def fit_power(df: DataFrame, column: str, method: str = "yeo-johnson", low: float = -2.0, high: float = 2.0, rounds: int = 2) -> float:
    """Maximum-likelihood exponent, to 10^-rounds.  Each round is one aggregate over a grid of exponents."""
    x = F.col(column).cast("double")
    shape: Callable[[Column, float], Column] = {"box-cox": box_cox, "yeo-johnson": yeo_johnson}[method]
    jacobian = F.ln(x) if method == "box-cox" else F.signum(x) * F.log1p(F.abs(x))
    valid = df.where(x > 0) if method == "box-cox" else df.where(x.isNotNull())
    best = 0.0
    for r in range(1, rounds + 1):
        step = 10.0**-r
        if r == 1:
            grid = [round(low + i * step, r) for i in range(int(round((high - low) / step)) + 1)]
        else:
            grid = [round(best + i * step, r) for i in range(-10, 11)]
        fit = [(F.lit(-0.5) * F.count(x) * F.ln(F.var_pop(shape(x, lam))) + (lam - 1) * F.sum(jacobian)).alias(str(i)) for i, lam in enumerate(grid)]
        row = valid.agg(*fit).first()
        best = max(range(len(grid)), key=lambda i: (row[i] if row[i] is not None else float("-inf"), -i))
        best = grid[best]
    return best


def apply_power(df: DataFrame, column: str, lam: float, method: str = "yeo-johnson", out: str = "transformed") -> DataFrame:
    """Transformed and standardized column."""
    shape = box_cox if method == "box-cox" else yeo_johnson
    shaped = df.withColumn("_y", shape(F.col(column).cast("double"), lam))
    params = shaped.agg(F.avg("_y").alias("m"), F.stddev_pop("_y").alias("s"))
    return with_params(shaped, params).withColumn(out, F.try_divide(F.col("_y") - F.col("_p.m"), F.col("_p.s"))).drop("_y", "_p")


def quantile_edges(df: DataFrame, column: str, bins: int) -> DataFrame:
    return quantile_row(df, {f"e{i}": (column, i / bins) for i in range(bins + 1)})


def bin_right_closed(df: DataFrame, edges: DataFrame, column: str, bins: int, out: str = "bin") -> DataFrame:
    """Index of (e_i, e_i+1]; the lowest edge belongs to the first bin."""
    over = sum((F.col(column) > F.col(f"_p.e{i}")).cast("int") for i in range(1, bins))
    return with_params(df, edges).withColumn(out, over).drop("_p")


def bin_left_closed(df: DataFrame, edges: DataFrame, column: str, bins: int, out: str = "bin") -> DataFrame:
    """Index of [e_i, e_i+1); the highest edge belongs to the last bin."""
    over = sum((F.col(column) >= F.col(f"_p.e{i}")).cast("int") for i in range(1, bins))
    return with_params(df, edges).withColumn(out, over).drop("_p")


def bin_uniform(df: DataFrame, column: str, bins: int, out: str = "bin") -> DataFrame:
    lim = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    x = F.col(column)
    index = F.floor(F.try_divide((x - F.col("_p.lo")) * bins, F.col("_p.hi") - F.col("_p.lo")))
    return with_params(df, lim).withColumn(out, F.least(F.coalesce(index, F.when(x.isNotNull(), 0)), F.lit(bins - 1)).cast("int")).drop("_p")


def bin_decade_age(year: Column, reference_year: int) -> Sequence[Column]:
    return [(F.floor(year / 10) * 10).cast("int").alias("decade"), (F.lit(reference_year) - year).cast("int").alias("age")]
