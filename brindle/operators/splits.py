"""Reproducible splits: membership is a hash of the row key, so it survives repartitioning and reruns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from brindle.functions.expr import stable_hash
from brindle.functions.ordered import named, running_totals

_SCALE = 10_000


def in_test(key: Sequence[str], fraction: float, seed: int = 0) -> Column:
    return stable_hash(*key, seed=seed, mod=_SCALE) < int(round(fraction * _SCALE))


def random_split(df: DataFrame, key: Sequence[str], fraction: float, seed: int = 0) -> DataFrame:
    return df.withColumn("split", F.when(in_test(key, fraction, seed), "test").otherwise("train"))


def three_way_split(df: DataFrame, key: Sequence[str], val: float = 0.15, test: float = 0.15, seed: int = 0) -> DataFrame:
    band = stable_hash(*key, seed=seed, mod=_SCALE)
    t, v = int(round(test * _SCALE)), int(round((test + val) * _SCALE))
    return df.withColumn("split", F.when(band < t, "test").when(band < v, "val").otherwise("train"))


def stratified_split(df: DataFrame, key: Sequence[str], strata: str, fraction: float, seed: int = 0) -> DataFrame:
    """Exactly floor(fraction · class size) test rows in each class: those with the lowest key hash.

    A class may hold most of the table, so its rows are never ranked in one task: hash values are counted,
    placed by range, and the rows look up how many come before their hash value.  Rows that share a hash
    value (32 bits) are ordered by key inside that small tie group.  A null class is a class of its own.
    """
    hashed = df.withColumn("_h", stable_hash(*key, seed=seed)).withColumn("_class", named(strata))
    hist = hashed.groupBy("_class", "_h").agg(F.count("*").alias("_n"))
    placed = running_totals(hist, "_h", ["_n"], key="_class")
    size = hist.groupBy("_class").agg(F.sum("_n").alias("_size"))
    ties = Window.partitionBy("_class", "_h").orderBy(*key)
    ranked = (
        hashed.withColumn("_tie", F.row_number().over(ties))
        .join(placed.drop("_n"), ["_class", "_h"])
        .join(size, "_class")  # one row per class: broadcast if the optimizer finds it small
    )
    test = F.col("_n_before") + F.col("_tie") <= F.floor(F.col("_size") * fraction)
    return ranked.select(*df.columns, F.when(test, "test").otherwise("train").alias("split"))


def kfold(df: DataFrame, key: Sequence[str], k: int = 5, seed: int = 0) -> DataFrame:
    return df.withColumn("fold", stable_hash(*key, seed=seed, mod=k).cast("int"))


def series_position(df: DataFrame, series: str, ts: str) -> DataFrame:
    """Adds the 1-based position and the length of each series; expects a calendar-grain table."""
    w = Window.partitionBy(series)
    return df.select("*", F.row_number().over(w.orderBy(ts)).alias("pos"), F.count("*").over(w).alias("len"))


def timeseries_folds(df: DataFrame, series: str, ts: str, n_splits: int, test_size: int, train_size: int | None = None) -> DataFrame:
    """(fold, role, row…): validation windows of fixed length at the end, training always before them.

    `train_size` turns the expanding training window into a sliding one.  Each row is emitted once per
    fold it belongs to, at most n_splits times.
    """
    pos = series_position(df, series, ts)
    fold = F.explode(F.array(*[F.lit(i) for i in range(n_splits)])).alias("fold")
    rows = pos.select("*", fold).withColumn("_start", F.col("len") - (n_splits - F.col("fold")) * test_size)
    role = F.when((F.col("pos") > F.col("_start")) & (F.col("pos") <= F.col("_start") + test_size), "val")
    low = F.lit(0) if train_size is None else F.col("_start") - train_size
    role = role.when((F.col("pos") <= F.col("_start")) & (F.col("pos") > low), "train")
    return rows.withColumn("role", role).where(F.col("role").isNotNull()).drop("_start", "pos", "len")


def holdout_last(df: DataFrame, series: str, ts: str, h: int) -> DataFrame:
    pos = series_position(df, series, ts)
    return pos.withColumn("split", F.when(F.col("pos") > F.col("len") - h, "test").otherwise("train")).drop("pos", "len")


def leakage_compare(df: DataFrame, value: str, is_train: Column) -> DataFrame:
    """Mean learned on all rows and on training rows only."""
    both = df.agg(F.avg(value).alias("mean_all"), F.avg(F.when(is_train, F.col(value))).alias("mean_train"))
    return both.withColumn("difference", F.col("mean_all") - F.col("mean_train"))


