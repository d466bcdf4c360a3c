"""Forecasts per series.  Inputs are (series, day, y) at calendar grain; outputs (series, h, yhat)."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from brindle.operators.state_space import fit_sarima, stepwise
from brindle.operators.ts_prep import FOURIER, LAGS, WINDOWS, fourier_columns
from brindle.sources.scratch import cut_lineage


def _horizon(df: DataFrame, h: int) -> DataFrame:
    return df.select("*", F.explode(F.sequence(F.lit(1), F.lit(h))).alias("h"))


def naive(df: DataFrame, series: str, ts: str, y: str, h: int) -> DataFrame:
    return _horizon(df.groupBy(series).agg(F.max_by(y, ts).alias("yhat")), h)


def _last(df: DataFrame, series: str, ts: str, y: str, m: int) -> DataFrame:
    w = Window.partitionBy(series).orderBy(F.desc(ts))
    return df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= m)


def seasonal_naive(df: DataFrame, series: str, ts: str, y: str, h: int, m: int = 7) -> DataFrame:
    cycle = _last(df, series, ts, y, m).select(series, (m - F.col("_r")).alias("_slot"), F.col(y).alias("yhat"))
    steps = cycle.select(series, "yhat", F.explode(F.sequence(F.col("_slot") + 1, F.lit(h + m), F.lit(m))).alias("h"))
    return steps.where(F.col("h") <= h)


def moving_average(df: DataFrame, series: str, ts: str, y: str, h: int, m: int = 7) -> DataFrame:
    return _horizon(_last(df, series, ts, y, m).groupBy(series).agg(F.avg(y).alias("yhat")), h)


def as_arrays(df: DataFrame, series: str, ts: str, y: str) -> DataFrame:
    """One row per series with its values in time order; an array is as long as the calendar."""
    return df.groupBy(series).agg(F.transform(F.sort_array(F.collect_list(F.struct(ts, y))), lambda s: s[y]).alias("ys"))


def _best(df: DataFrame, fit: Callable[[Column, dict[str, Column]], Column], grid: Sequence[dict[str, float]], series: str) -> DataFrame:
    """Adds the parameters with the smallest one-step SSE: every (series, parameters) pair is one row."""
    names = list(grid[0])
    packed = F.array(*[F.struct(*[F.lit(float(g[n])).alias(n) for n in names]) for g in grid])
    tried = df.select(series, "ys", F.explode(packed).alias("p")).repartition(series, "p")
    scored = tried.select(series, "p", fit(F.col("ys"), {n: F.col(f"p.{n}") for n in names})["sse"].alias("sse"))
    chosen = scored.groupBy(series).agg(F.min_by("p", F.struct("sse", "p")).alias("p"), F.min("sse").alias("sse"))
    return df.join(chosen, series)


def _ses(ys: Column, p: dict[str, Column]) -> Column:
    start = F.struct(F.get(ys, 0).alias("l"), F.lit(0.0).alias("sse"))
    return F.aggregate(F.slice(ys, 2, F.size(ys)), start, lambda s, v: F.struct(
        (s["l"] + p["alpha"] * (v - s["l"])).alias("l"), (s["sse"] + (v - s["l"]) * (v - s["l"])).alias("sse")))


def ses(df: DataFrame, series: str, ts: str, y: str, h: int, alpha: float | None = None, refine: int = 1) -> DataFrame:
    """Simple exponential smoothing; α by least one-step error on a grid refined around its best point."""
    arrays = as_arrays(df, series, ts, y)
    if alpha is not None:
        fitted = arrays.withColumn("p", F.struct(F.lit(float(alpha)).alias("alpha")))
    else:
        fitted = _best(arrays, _ses, [{"alpha": round(0.05 * i, 2)} for i in range(1, 20)], series).drop("sse")
        for r in range(1, refine + 1):
            offsets = F.array(*[F.lit(i * 0.05 / 5**r) for i in range(-5, 6)])
            tried = fitted.select(series, "ys", F.explode(offsets).alias("_o"), "p").select(
                series, "ys", F.struct(F.least(F.greatest(F.col("p.alpha") + F.col("_o"), F.lit(0.001)), F.lit(0.999)).alias("alpha")).alias("p"))
            scored = tried.withColumn("sse", _ses(F.col("ys"), {"alpha": F.col("p.alpha")})["sse"])
            fitted = scored.groupBy(series).agg(F.min_by(F.struct("ys", "p"), F.struct("sse", "p")).alias("_b")).select(series, "_b.*")
    level = fitted.select(series, F.col("p.alpha").alias("alpha"), _ses(F.col("ys"), {"alpha": F.col("p.alpha")})["l"].alias("yhat"))
    return _horizon(level, h)


def _holt(ys: Column, p: dict[str, Column]) -> Column:
    start = F.struct(F.get(ys, 0).alias("l"), (F.get(ys, 1) - F.get(ys, 0)).alias("b"), F.lit(0.0).alias("sse"))

    def step(s: Column, v: Column) -> Column:
        guess = s["l"] + p["phi"] * s["b"]
        level = p["alpha"] * v + (1 - p["alpha"]) * guess
        trend = p["beta"] * (level - s["l"]) + (1 - p["beta"]) * p["phi"] * s["b"]
        return F.struct(level.alias("l"), trend.alias("b"), (s["sse"] + (v - guess) * (v - guess)).alias("sse"))

    return F.aggregate(F.slice(ys, 2, F.size(ys)), start, step)


def _damped(phi: Column, h: Column) -> Column:
    """φ + φ² + … + φ^h"""
    return F.aggregate(F.sequence(F.lit(1), h), F.lit(0.0), lambda s, i: s + F.pow(phi, i.cast("double")))


def holt(df: DataFrame, series: str, ts: str, y: str, h: int) -> DataFrame:
    """Damped trend."""
    grid = [dict(alpha=a, beta=b, phi=f) for a, b, f in itertools.product((0.1, 0.3, 0.5, 0.8), (0.01, 0.1, 0.3), (0.8, 0.9, 0.98))]
    fitted = _best(as_arrays(df, series, ts, y), _holt, grid, series)
    state = fitted.select(series, "p", _holt(F.col("ys"), {n: F.col(f"p.{n}") for n in grid[0]}).alias("s"))
    return _horizon(state, h).select(series, "h", (F.col("s.l") + _damped(F.col("p.phi"), F.col("h")) * F.col("s.b")).alias("yhat"))


def _holt_winters(m: int, multiplicative: bool) -> Callable[[Column, dict[str, Column]], Column]:
    def fit(ys: Column, p: dict[str, Column]) -> Column:
        first = F.slice(ys, 1, m)
        mean = F.aggregate(first, F.lit(0.0), lambda s, v: s + v) / m
        season = F.transform(first, lambda v: v / mean if multiplicative else v - mean)
        start = F.struct(mean.alias("l"), F.lit(0.0).alias("b"), season.alias("s"), F.lit(0.0).alias("sse"))

        def step(s: Column, v: Column) -> Column:
            old = F.get(s["s"], F.lit(0))  # the oldest phase is the one due now
            base = s["l"] + p["phi"] * s["b"]
            guess = base * old if multiplicative else base + old
            level = p["alpha"] * (v / old if multiplicative else v - old) + (1 - p["alpha"]) * base
            trend = p["beta"] * (level - s["l"]) + (1 - p["beta"]) * p["phi"] * s["b"]
            # the season is updated against the previous level and trend
            phase = p["gamma"] * (v / base if multiplicative else v - base) + (1 - p["gamma"]) * old
            moved = F.concat(F.slice(s["s"], 2, m - 1), F.array(phase))
            return F.struct(level.alias("l"), trend.alias("b"), moved.alias("s"), (s["sse"] + (v - guess) * (v - guess)).alias("sse"))

        return F.aggregate(F.slice(ys, m + 1, F.size(ys)), start, step)

    return fit


def holt_winters(df: DataFrame, series: str, ts: str, y: str, h: int, m: int = 7, multiplicative: bool = False) -> DataFrame:
    """Damped trend with an additive (or multiplicative) season of length m."""
    fit = _holt_winters(m, multiplicative)
    grid = [dict(alpha=a, beta=b, gamma=g, phi=f) for a, b, g, f in itertools.product((0.05, 0.2, 0.5), (0.01, 0.1), (0.05, 0.2), (0.9, 0.98))]
    fitted = _best(as_arrays(df, series, ts, y), fit, grid, series)
    state = fitted.select(series, "p", fit(F.col("ys"), {n: F.col(f"p.{n}") for n in grid[0]}).alias("s"))
    base = F.col("s.l") + _damped(F.col("p.phi"), F.col("h")) * F.col("s.b")
    phase = F.get(F.col("s.s"), F.pmod(F.col("h") - 1, F.lit(m)))
    return _horizon(state, h).select(series, "h", (base * phase if multiplicative else base + phase).alias("yhat"))


def sarima(df: DataFrame, series: str, ts: str, y: str, h: int, order=(1, 0, 1), seasonal=(0, 1, 1), m: int = 7) -> DataFrame:
    """(series, h, yhat, low, high) with a 95 % band, by exact likelihood.  One task fits one calendar-long series."""

    def fit(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        out = fit_sarima(pdf.sort_values("ts")["y"].to_numpy(), order, seasonal, m, h)
        return pd.DataFrame({series: key[0], "h": np.arange(1, h + 1), "yhat": out["yhat"], "low": out["yhat"] - out["spread"], "high": out["yhat"] + out["spread"]})

    kind = dict(df.dtypes)[series]
    return df.select(series, F.col(ts).alias("ts"), F.col(y).alias("y")).groupBy(series).applyInPandas(
        fit, f"{series} {kind}, h int, yhat double, low double, high double")


def arima_order_search(df: DataFrame, series: str, ts: str, y: str, candidates: Sequence[tuple[tuple[int, int, int], tuple[int, int, int]]] | None = None,
                       m: int = 7, most: tuple[int, int, int, int] = (3, 3, 2, 2)) -> DataFrame:
    """(series, order, aic, chosen) of every model tried; a series' models are tried where it lies, no row is copied.

    Without candidates differences are chosen by test, and orders up to `most` (p, q, P, Q) by steps to better neighbours.
    """

    def fit(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        values = pdf.sort_values("ts")["y"].to_numpy()
        tried = stepwise(values, m, most) if candidates is None else sorted(((o, s, fit_sarima(values, o, s, m)["aic"]) for o, s in candidates), key=lambda r: (r[2], r[0], r[1]))
        return pd.DataFrame({series: key[0], "order": [str((o, s)) for o, s, _ in tried], "aic": [float(v) for _, _, v in tried], "chosen": [i == 0 for i in range(len(tried))]})

    kind = dict(df.dtypes)[series]
    return df.select(series, F.col(ts).alias("ts"), F.col(y).alias("y")).groupBy(series).applyInPandas(fit, f"{series} {kind}, order string, aic double, chosen boolean")


def _sample_sd(part: Column, mean: Column, n: int) -> Column:
    squares = F.transform(part, lambda x: (x - mean) * (x - mean))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x) / (n - 1))


def next_feature_columns() -> list[Column]:
    """Features of the step after a history array `hist` (newest last), named as in the training matrix."""
    n = F.size("hist")
    lag = lambda k: F.get("hist", n - k)
    cols = [F.col("t_next").alias("t_index"), *[lag(k).alias(f"lag_{k}") for k in LAGS]]
    for w in WINDOWS:
        part = F.slice("hist", n - w + 1, w)
        mean = F.aggregate(part, F.lit(0.0), lambda s, x: s + x) / w
        cols += [mean.alias(f"rollmean_{w}"), _sample_sd(part, mean, w).alias(f"rollstd_{w}"), F.array_min(part).alias(f"rollmin_{w}"), F.array_max(part).alias(f"rollmax_{w}")]
    cols += [F.weekday("day_next").alias("dayofweek"), F.month("day_next").alias("month"), (F.weekday("day_next") >= 5).cast("int").alias("is_weekend")]
    return [*cols, *fourier_columns(F.col("t_next"), FOURIER)]


def recursive_forecast(model, history: DataFrame, series: str, day: str, y: str, h: int, cut_every: int = 10) -> DataFrame:
    """Feed each prediction back as history, h times, for all series at once.

    The state is one row per series: its last 365 values.  A series shorter than that has no features to forecast from; it does
    not stop the others and comes back with null forecasts.  `model` turns the training matrix's columns
    into `prediction`; the plan is cut every few steps so it does not grow with h.
    """
    keep = max(LAGS)
    state = history.groupBy(series).agg(
        F.transform(F.sort_array(F.collect_list(F.struct(day, y))), lambda s: s[y]).alias("hist"), F.max(day).alias("_last"), F.count("*").cast("int").alias("t_next"),
    ).select(series, F.slice("hist", F.greatest(F.size("hist") - keep + 1, F.lit(1)), keep).alias("hist"), F.date_add("_last", 1).alias("day_next"), "t_next",
             F.array().cast("array<double>").alias("out"))
    short = state.where(F.size("hist") < keep).select(series, F.explode(F.sequence(F.lit(1), F.lit(h))).alias("h"), F.lit(None).cast("double").alias("yhat"))
    state = state.where(F.size("hist") >= keep)
    features = next_feature_columns()
    for step in range(h):
        scored = model.transform(state.select("*", *features))
        state = scored.select(
            series, F.concat(F.slice("hist", 2, keep - 1), F.array("prediction")).alias("hist"), F.date_add("day_next", 1).alias("day_next"),
            (F.col("t_next") + 1).alias("t_next"), F.concat("out", F.array("prediction")).alias("out"))
        if (step + 1) % cut_every == 0 and step + 1 < h:
            state = cut_lineage(state)
    return state.select(series, F.posexplode("out").alias("_i", "yhat")).select(series, (F.col("_i") + 1).alias("h"), "yhat").union(short)


def direct_targets(matrix: DataFrame, series: str, day: str, y: str, h: int) -> DataFrame:
    """Adds `target`: the value h steps ahead, for a model per horizon."""
    return matrix.withColumn("target", F.lead(y, h).over(Window.partitionBy(series).orderBy(day)))
