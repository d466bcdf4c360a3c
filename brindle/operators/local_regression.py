"""Seasonal-trend decomposition by locally weighted regression, robust against outliers.

Each smoothing fits a line through the nearest points of a place, weighted by the cube of cubes of their distance and by the
robustness weight that the last round gave each point.  Rounds alternate between the season (each phase smoothed on its own and
extended by one period either way, less its own slow part) and the trend; outer rounds weigh points by how far they lie off.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F


def local_line(y: np.ndarray, span: int, weight: np.ndarray | None = None, ends: int = 0) -> np.ndarray:
    """Local lines at all places of y, and at `ends` places beyond either end.

    The window of a place is its `span` nearest points; with fewer points than the span the window's width grows by half of what is
    missing.  All windows are rows of one matrix, so their moments are sums along it.
    """
    n = len(y)
    weight = np.ones(n) if weight is None else weight
    width = min(span, n)
    at = np.arange(-ends, n + ends)
    first = np.clip(at - (width - 1) // 2, 0, n - width)
    cols = first[:, None] + np.arange(width)[None]
    away = np.abs(cols - at[:, None]).astype(float)
    reach = away.max(axis=1, keepdims=True) + max(span - n, 0) // 2
    reach = np.maximum(reach, 1e-12)
    w = np.where(away < 0.999 * reach, np.where(away > 0.001 * reach, (1 - (away / reach) ** 3) ** 3, 1.0), 0.0) * weight[cols]
    total = w.sum(axis=1, keepdims=True)
    alone = total[:, 0] <= 0  # nothing but points without weight: the nearest value
    w = w / np.where(total > 0, total, 1.0)
    x = cols.astype(float)
    mean = (w * x).sum(axis=1, keepdims=True)
    spread = (w * (x - mean) ** 2).sum(axis=1, keepdims=True)
    with np.errstate(invalid="ignore", divide="ignore"):
        tilt = np.where(np.sqrt(spread) > 0.001 * (n - 1), (at[:, None] - mean) / spread, 0.0)
    out = (w * (1 + tilt * (x - mean)) * y[cols]).sum(axis=1)
    return np.where(alone, y[np.clip(at, 0, n - 1)], out)


def _running_mean(y: np.ndarray, k: int) -> np.ndarray:
    sums = np.cumsum(np.concatenate([[0.0], y]))
    return (sums[k:] - sums[:-k]) / k


def _odd(x: float) -> int:
    return int(np.ceil(x)) | 1


def decompose(y: np.ndarray, period: int, season_span: int = 7, trend_span: int | None = None, inner: int = 2, outer: int = 15) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(trend, season, robustness weights).  A series shorter than two periods has no season: its trend is a local line."""
    y, n = np.asarray(y, dtype=float), len(y)
    trend_span = trend_span or _odd(1.5 * period / (1 - 1.5 / season_span))
    if n < 2 * period:
        return local_line(y, trend_span) if n else y, np.zeros(n), np.ones(n)
    low_span = period if period % 2 else period + 1
    trend, season, weight = np.zeros(n), np.zeros(n), np.ones(n)
    for turn in range(outer + 1):
        for _ in range(inner):
            rest, long = y - trend, np.empty(n + 2 * period)
            for phase in range(period):
                long[phase::period] = local_line(rest[phase::period], season_span, weight[phase::period], ends=1)
            slow = _running_mean(_running_mean(_running_mean(long, period), period), 3)
            season = long[period : period + n] - local_line(slow, low_span)
            trend = local_line(y - season, trend_span, weight)
        if turn == outer:
            break
        off = np.abs(y - trend - season)
        limit = 6 * np.median(off)
        if limit <= 1e-12 * max(np.abs(y).max(), 1e-300):
            break
        weight = np.where(off <= 0.001 * limit, 1.0, np.where(off <= 0.999 * limit, (1 - (off / limit) ** 2) ** 2, 0.0))
    return trend, season, weight


def decompose_local(df: DataFrame, series: str, ts: str, y: str, period: int = 7, season_span: int = 7) -> DataFrame:
    """(series, ts, trend, season, resid, weight) of each row; a task holds one calendar-long series.  Null values have no place."""
    kinds = dict(df.dtypes)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ts").reset_index(drop=True)
        values = pdf["y"].to_numpy(dtype=float)
        trend, season, weight = decompose(values, period, season_span)
        return pd.DataFrame({series: pdf[series], ts: pdf["ts"], "trend": trend, "season": season, "resid": values - trend - season, "weight": weight})

    rows = df.where(F.col(y).isNotNull()).select(series, F.col(ts).alias("ts"), F.col(y).cast("double").alias("y"))
    return rows.groupBy(series).applyInPandas(run, f"{series} {kinds[series]}, {ts} {kinds[ts]}, trend double, season double, resid double, weight double")
