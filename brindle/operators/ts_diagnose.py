"""Autocorrelation, stationarity and residual tests per series (calendar-grain inputs)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

# fixed values: 5 % critical value of the unit-root test with a constant; 95 % points of chi-square
ADF_CRITICAL_5 = -2.86
CHI2_95 = {7: 14.067, 14: 23.685, 28: 41.337}


def acf(df: DataFrame, series: str, ts: str, y: str, nlags: int = 60) -> DataFrame:
    """(series, lag, rho, n): biased autocorrelation around one global mean.  Lags come from one sort."""
    per = Window.partitionBy(series)
    centred = df.select(series, ts, (F.col(y) - F.avg(y).over(per)).alias("_c"))
    order = Window.partitionBy(series).orderBy(ts)
    lagged = centred.select(series, "_c", *[F.lag("_c", k).over(order).alias(f"_l{k}") for k in range(1, nlags + 1)])
    sums = lagged.groupBy(series).agg(
        F.count("*").alias("n"), F.sum(F.col("_c") * F.col("_c")).alias("_v"),
        F.array(*[F.sum(F.col("_c") * F.col(f"_l{k}")) for k in range(1, nlags + 1)]).alias("_s"))
    long = sums.select(series, "n", "_v", F.posexplode("_s").alias("_i", "_x"))
    return long.select(series, (F.col("_i") + 1).alias("lag"), F.try_divide("_x", "_v").alias("rho"), "n")


def ljung_box(acf_rows: DataFrame, series: str, horizons: tuple[int, ...] = (7, 14, 28)) -> DataFrame:
    """(series, h, q, correlated): portmanteau statistic against its 95 % point."""
    n, r = F.col("n").cast("double"), F.col("rho")
    term = r * r / (n - F.col("lag"))
    wide = acf_rows.groupBy(series).agg(*[(F.first(n) * (F.first(n) + 2) * F.sum(F.when(F.col("lag") <= h, term))).alias(str(h)) for h in horizons])
    long = wide.unpivot([series], [str(h) for h in horizons], "h", "q")
    limit = F.create_map(*[F.lit(x) for h in horizons for x in (str(h), CHI2_95[h])])
    return long.select(series, F.col("h").cast("int").alias("h"), "q", (F.col("q") > limit[F.col("h")]).alias("correlated"))


def pacf(acf_rows: DataFrame, series: str, nlags: int = 60) -> DataFrame:
    """(series, lag, phi): partial autocorrelation by the Durbin–Levinson recursion over each series' ACF array."""
    rows = acf_rows.where(F.col("lag") <= nlags).groupBy(series).agg(F.sort_array(F.collect_list(F.struct("lag", "rho"))).alias("_a"))
    r = F.col("_a.rho")
    empty = F.array().cast("array<double>")

    def step(state: Column, k: Column) -> Column:
        phi = state["phi"]
        past = F.slice(r, 1, k - 1)
        inner = F.aggregate(F.zip_with(phi, F.reverse(past), lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
        scale = F.aggregate(F.zip_with(phi, past, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
        return F.struct(phi.alias("phi"), state["out"].alias("out"), F.try_divide(F.get(r, k - 1) - inner, 1 - scale).alias("last"))

    def close(state: Column) -> Column:
        last = state["last"]
        moved = F.zip_with(state["phi"], F.reverse(state["phi"]), lambda a, b: a - last * b)
        return F.struct(F.concat(moved, F.array(last)).alias("phi"), F.concat(state["out"], F.array(last)).alias("out"), last.alias("last"))

    start = F.struct(empty.alias("phi"), empty.alias("out"), F.lit(0.0).alias("last"))
    folded = F.aggregate(F.sequence(F.lit(1), F.size(r)), start, lambda s, k: close(step(s, k)))
    return rows.select(series, F.posexplode(folded["out"]).alias("_i", "phi")).select(series, (F.col("_i") + 1).alias("lag"), "phi")


def adf_test(df: DataFrame, series: str, ts: str, y: str, max_lag: int = 14) -> DataFrame:
    """(series, used_lag, statistic, stationary): unit-root t statistic, lag order by AIC on a common sample.

    Spark builds the regression columns and reduces them to one small moment matrix per series; only that
    matrix (max_lag + 3 wide) is solved, by numpy, one series per call.
    """
    w = Window.partitionBy(series).orderBy(ts)
    diffed = df.select(series, ts, F.lag(y, 1).over(w).alias("_level"), (F.col(y) - F.lag(y, 1).over(w)).alias("_d"))
    lagged = diffed.select(series, "_d", "_level", *[F.lag("_d", k).over(w).alias(f"_d{k}") for k in range(1, max_lag + 1)]).na.drop()
    cols = ["_one", "_level", *[f"_d{k}" for k in range(1, max_lag + 1)], "_d"]
    row = F.array(*[F.lit(1.0) if c == "_one" else F.col(c).cast("double") for c in cols])
    size = len(cols)
    cells = lagged.select(series, F.posexplode(row).alias("_i", "_a"), row.alias("_row"))
    moments = cells.groupBy(series, "_i").agg(F.array(*[F.sum(F.col("_a") * F.get("_row", F.lit(j))) for j in range(size)]).alias("_m"))
    matrices = moments.groupBy(series).agg(F.sort_array(F.collect_list(F.struct("_i", "_m"))).alias("_g"))

    @F.pandas_udf("struct<used_lag:int,statistic:double>")
    def solve(packed: pd.Series) -> pd.DataFrame:
        out = []
        for entry in packed:
            g = np.stack([np.asarray(e["_m"], dtype=float) for e in entry])
            n = g[0, 0]
            best = (np.inf, 0, float("nan"))
            for p in range(max_lag + 1):
                use = list(range(p + 2))
                scale = np.sqrt(np.diag(g)[use])
                a = g[np.ix_(use, use)] / np.outer(scale, scale)
                inverse = np.linalg.pinv(a)
                beta = inverse @ (g[use, -1] / scale)
                sse = g[-1, -1] - beta @ (g[use, -1] / scale)
                aic = n * np.log(sse / n) + 2 * len(use)
                t = beta[1] / np.sqrt(sse / (n - len(use)) * inverse[1, 1])
                if aic < best[0]:
                    best = (aic, p, t)
            out.append((best[1], best[2]))
        return pd.DataFrame(out, columns=["used_lag", "statistic"])

    tests = matrices.select(series, solve("_g").alias("_t"))
    return tests.select(series, "_t.*", (F.col("_t.statistic") < ADF_CRITICAL_5).alias("stationary"))
