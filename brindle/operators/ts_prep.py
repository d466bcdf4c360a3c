"""Series preparation.  Every input is (series, time, y); windows run per series on calendar-grain tables,
so a window group is never longer than the calendar."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def resample_mean(df: DataFrame, series: str, ts: str, value: str, unit: str) -> DataFrame:
    bucket = F.date_trunc(unit, ts).cast("timestamp_ntz")
    return df.groupBy(series, bucket.alias("ts")).agg(F.avg(value).alias("y"))


def week_ending_sunday(day: Column) -> Column:
    return F.next_day(F.date_sub(day, 1), "Sun")


def calendar_spine(df: DataFrame, series: str, day: str) -> DataFrame:
    """Every day between the first and last one of each series; missing days have null values."""
    span = df.groupBy(series).agg(F.min(day).alias("_a"), F.max(day).alias("_b"))
    grid = span.select(series, F.explode(F.sequence("_a", "_b")).alias(day))
    return grid.join(df, [series, day], "left")


def interpolate_time(df: DataFrame, series: str, day: str, y: str) -> DataFrame:
    """Linear in time between known neighbours; after the last known value it is repeated, before the first null."""
    w = Window.partitionBy(series).orderBy(day)
    back = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    known = F.when(F.col(y).isNotNull(), F.struct(F.col(day).alias("d"), F.col(y).alias("v")))
    near = df.select("*", F.last(known, True).over(back).alias("_p"), F.first(known, True).over(ahead).alias("_n"))
    step = F.datediff(day, "_p.d").cast("double") / F.datediff("_n.d", "_p.d")
    line = F.col("_p.v") + (F.col("_n.v") - F.col("_p.v")) * step
    value = F.when(F.col(y).isNotNull(), F.col(y)).when(F.col("_n").isNull(), F.col("_p.v")).when(F.col("_p").isNotNull(), line)
    return near.withColumn(y, value).drop("_p", "_n")


def trim_edges(df: DataFrame, series: str, ts: str) -> DataFrame:
    """Without the first and last period of each series, which are usually incomplete."""
    w = Window.partitionBy(series)
    return df.select("*", F.min(ts).over(w).alias("_a"), F.max(ts).over(w).alias("_b")).where((F.col(ts) > F.col("_a")) & (F.col(ts) < F.col("_b"))).drop("_a", "_b")


def difference(df: DataFrame, series: str, ts: str, y: str, lags: Sequence[int], out: str) -> DataFrame:
    """(1−L^a)(1−L^b)… applied in turn."""
    w = Window.partitionBy(series).orderBy(ts)
    current = df.withColumn(out, F.col(y))
    for k in lags:
        current = current.withColumn(out, F.col(out) - F.lag(out, k).over(w))
    return current


def _full(frame, size: int, y: str, expr: Column) -> Column:
    return F.when(F.count(y).over(frame) == size, expr)


def rolling_stats(df: DataFrame, series: str, ts: str, y: str, window: int) -> DataFrame:
    """Trailing mean and sample sd, null until the window is full."""
    frame = Window.partitionBy(series).orderBy(ts).rowsBetween(-(window - 1), 0)
    return df.select("*", _full(frame, window, y, F.avg(y).over(frame)).alias("roll_mean"), _full(frame, window, y, F.stddev_samp(y).over(frame)).alias("roll_sd"))


def lag_columns(series: str, ts: str, y: str, lags: Sequence[int]) -> list[Column]:
    w = Window.partitionBy(series).orderBy(ts)
    return [F.lag(y, k).over(w).alias(f"lag_{k}") for k in lags]


def lag_correlations(df: DataFrame, series: str, ts: str, y: str, lags: Sequence[int]) -> DataFrame:
    lagged = df.select(series, y, *lag_columns(series, ts, y, lags))
    wide = lagged.groupBy(series).agg(*[F.corr(y, f"lag_{k}").alias(f"lag_{k}") for k in lags])
    return wide.unpivot([series], [f"lag_{k}" for k in lags], "lag", "r")


def rolling_past_columns(series: str, ts: str, y: str, windows: Sequence[int]) -> list[Column]:
    """mean, sd, min and max of the w values before the current one."""
    out = []
    for n in windows:
        frame = Window.partitionBy(series).orderBy(ts).rowsBetween(-n, -1)
        for name, fn in (("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max)):
            out.append(_full(frame, n, y, fn(y).over(frame)).alias(f"roll{name}_{n}"))
    return out


def leaky_vs_safe(df: DataFrame, series: str, ts: str, y: str, window: int) -> DataFrame:
    """Correlation of y with a mean that contains y itself and with one that does not."""
    w = Window.partitionBy(series).orderBy(ts)
    leaky, safe = w.rowsBetween(-(window - 1), 0), w.rowsBetween(-window, -1)
    both = df.select(series, y, _full(leaky, window, y, F.avg(y).over(leaky)).alias("a"), _full(safe, window, y, F.avg(y).over(safe)).alias("b"))
    return both.groupBy(series).agg(F.corr(y, "a").alias("leaky_r"), F.corr(y, "b").alias("safe_r"))


def time_index(series: str, ts: str) -> Column:
    return F.row_number().over(Window.partitionBy(series).orderBy(ts)) - 1


def calendar_columns(day: str) -> list[Column]:
    return [F.weekday(day).alias("dayofweek"), F.month(day).alias("month"), (F.weekday(day) >= 5).cast("int").alias("is_weekend")]


# fixed values: period and number of harmonics of the weekly and yearly cycles
FOURIER = ((7, 2), (365.25, 3))


def fourier_columns(t: Column, spec: Sequence[tuple[float, int]] = FOURIER) -> list[Column]:
    out = []
    for period, harmonics in spec:
        for k in range(1, harmonics + 1):
            angle = F.lit(2 * 3.141592653589793 * k) * t / F.lit(float(period))
            out += [F.sin(angle).alias(f"sin_{int(period)}_{k}"), F.cos(angle).alias(f"cos_{int(period)}_{k}")]
    return out


# fixed values: lags and window lengths of the forecasting matrix
LAGS, WINDOWS = (1, 2, 3, 7, 14, 28, 365), (7, 28)


def feature_matrix(df: DataFrame, series: str, day: str, y: str, drop_incomplete: bool = True) -> DataFrame:
    """Lags, past windows, calendar and Fourier columns from one sort per series."""
    wide = df.select(series, day, y, time_index(series, day).alias("t_index"), *lag_columns(series, day, y, LAGS), *rolling_past_columns(series, day, y, WINDOWS), *calendar_columns(day))
    out = wide.select("*", *fourier_columns(F.col("t_index")))
    return out.na.drop() if drop_incomplete else out


def decompose_classical(df: DataFrame, series: str, ts: str, y: str, period: int, multiplicative: bool = False) -> DataFrame:
    """Centred moving average, mean per phase (centred on 0 or 1), remainder; edges without a full window are null."""
    half = period // 2
    w = Window.partitionBy(series).orderBy(ts)
    frame = w.rowsBetween(-half, half)
    total = F.sum(y).over(frame)
    if period % 2 == 0:
        total = total - (F.lag(y, half).over(w) + F.lead(y, half).over(w)) / 2
    trend = _full(frame, 2 * half + 1, y, total / period)
    base = df.select("*", F.pmod(time_index(series, ts), F.lit(period)).alias("phase"), trend.alias("trend"))
    rest = F.try_divide(F.col(y), F.col("trend")) if multiplicative else F.col(y) - F.col("trend")
    means = base.groupBy(series, "phase").agg(F.avg(rest).alias("_m"))
    centre = means.groupBy(series).agg(F.avg("_m").alias("_c"))
    seasonal = F.col("_m") / F.col("_c") if multiplicative else F.col("_m") - F.col("_c")
    phases = means.join(centre, series).select(series, "phase", seasonal.alias("seasonal"))
    joined = base.join(phases, [series, "phase"])
    remainder = F.try_divide(F.col(y), F.col("trend") * F.col("seasonal")) if multiplicative else F.col(y) - F.col("trend") - F.col("seasonal")
    return joined.withColumn("resid", remainder)


def _median(values: Column) -> Column:
    s, n = F.array_sort(values), F.size(values)
    mid = F.floor((n - 1) / 2).cast("int")
    return (F.get(s, mid) + F.get(s, F.floor(n / 2).cast("int"))) / 2


def decompose_robust(df: DataFrame, series: str, ts: str, y: str, period: int = 7, cycles: int = 2) -> DataFrame:
    """Moving-median trend and a seasonal part that is the median over neighbouring cycles of the same phase."""
    half = period // 2
    w = Window.partitionBy(series).orderBy(ts)
    base = df.select("*", F.pmod(time_index(series, ts), F.lit(period)).alias("phase"), _median(F.collect_list(y).over(w.rowsBetween(-half, half))).alias("trend"))
    base = base.withColumn("_d", F.col(y) - F.col("trend"))
    same = Window.partitionBy(series, "phase").orderBy(ts).rowsBetween(-cycles, cycles)
    out = base.withColumn("seasonal", _median(F.collect_list("_d").over(same))).drop("_d")
    return out.withColumn("resid", F.col(y) - F.col("trend") - F.col("seasonal"))
