"""Day profiles, elastic distances and clustering by shape."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from brindle.functions.expr import stable_hash
from brindle.operators.metric_cells import matrix
from brindle.sources.scratch import cut_lineage


def daily_profiles(df: DataFrame, series: str, ts: str, value: str) -> DataFrame:
    """(series, day, profile): 24 hourly means; days with a missing hour are left out."""
    hourly = df.groupBy(series, F.to_date(ts).alias("day"), F.hour(ts).alias("hour")).agg(F.avg(value).alias("v"))
    days = hourly.groupBy(series, "day").agg(F.sort_array(F.collect_list(F.struct("hour", "v"))).alias("_p"))  # at most 24 entries
    return days.where(F.size("_p") == 24).select(series, "day", F.transform("_p", lambda s: s["v"]).alias("profile"))


def sample_rows(df: DataFrame, key: Column, n: int, seed: int = 0) -> DataFrame:
    """n rows by lowest key hash: the same sample on every run, found as a top-n."""
    return df.withColumn("_h", stable_hash(key, seed=seed)).orderBy("_h", key).limit(n).drop("_h")


def znorm(profile: Column) -> Column:
    """(x − mean) / population sd of an array; a flat array becomes zeros."""
    n = F.size(profile).cast("double")
    mean = F.aggregate(profile, F.lit(0.0), lambda s, x: s + x, lambda s: s / n)
    var = F.aggregate(profile, F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("b")), lambda s, x: F.struct((s["a"] + x).alias("a"), (s["b"] + x * x).alias("b")), lambda s: s["b"] / n - s["a"] / n * s["a"] / n)
    sd = F.sqrt(F.greatest(var, F.lit(0.0)))
    return F.transform(profile, lambda x: F.when(sd < 1e-12, F.lit(0.0)).otherwise((x - mean) / F.when(sd < 1e-12, F.lit(1.0)).otherwise(sd)))


def shift(profile: Column, steps: int) -> Column:
    """Circular shift to the right."""
    n = F.size(profile)
    return F.concat(F.slice(profile, n - steps + 1, F.lit(steps)), F.slice(profile, F.lit(1), n - steps))


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v))


def dtw(a: Column, b: Column, band: int | None = None) -> Column:
    """Warped distance with squared local cost: one array per row of the cost table, no user function."""
    inf = F.lit(float("inf"))
    first = F.concat(F.array(F.lit(0.0)), F.transform(b, lambda _: inf))

    def next_row(prev: Column, i: Column) -> Column:
        ai = F.get(a, i)

        def cell(row: Column, j: Column) -> Column:
            cost = (ai - F.get(b, j)) * (ai - F.get(b, j))
            best = F.least(F.get(prev, j), F.get(prev, j + 1), F.element_at(row, -1))
            value = cost + best
            return F.concat(row, F.array(value if band is None else F.when(F.abs(i - j) <= band, value).otherwise(inf)))

        return F.aggregate(F.sequence(F.lit(0), F.size(b) - 1), F.array(inf), cell)

    table = F.aggregate(F.sequence(F.lit(0), F.size(a) - 1), first, next_row)
    return F.sqrt(F.element_at(table, -1))


def dtw_pairs(sample: DataFrame, key: str, max_rows: int = 200) -> DataFrame:
    """(a, b, distance) of every two rows of a bounded sample; refuses more rows than `max_rows`."""
    numbered = sample.select(key, "profile", (F.row_number().over(Window.orderBy(key)) - 1).alias("i"))  # at most max_rows rows
    n = numbered.limit(max_rows + 1).count()
    if n > max_rows:
        raise ValueError(f"pairwise distances are for at most {max_rows} rows; sample first")
    left = numbered.where(F.col("i") < n - 1).select(F.col(key).alias("a"), F.col("profile").alias("pa"), F.explode(F.sequence(F.col("i") + 1, F.lit(n - 1))).alias("j"))
    right = numbered.select(F.col(key).alias("b"), F.col("profile").alias("pb"), F.col("i").alias("j"))
    return left.join(right, "j").select("a", "b", dtw(F.col("pa"), F.col("pb")).alias("distance"))


def warp(rows: np.ndarray, centre: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Squared warped distance of each row to a centre, and what the best paths align with its places: sums and counts.

    All rows take a cell of the cost table together; the paths are traced back together as well.  Of equal steps the diagonal is taken
    first, then the one along the row.
    """
    size, n, m = len(rows), rows.shape[1], len(centre)
    cost = np.full((n + 1, m + 1, size), np.inf)
    cost[0, 0] = 0.0
    for i in range(n):
        for j in range(m):
            cost[i + 1, j + 1] = (rows[:, i] - centre[j]) ** 2 + np.minimum(np.minimum(cost[i, j], cost[i, j + 1]), cost[i + 1, j])
    sums, counts, every = np.zeros((size, m)), np.zeros((size, m)), np.arange(size)
    i, j = np.full(size, n), np.full(size, m)
    while (live := i > 0).any():
        at, a, b = every[live], i[live], j[live]
        sums[at, b - 1] += rows[at, a - 1]
        counts[at, b - 1] += 1
        back = np.stack([cost[a - 1, b - 1, at], cost[a - 1, b, at], cost[a, b - 1, at]])
        step = back.argmin(axis=0)
        i[live], j[live] = a - (step < 2), b - (step != 1)
        done = (i == 0) | (j == 0)
        i[done] = 0
    return cost[n, m], sums, counts


def barycentres(df: DataFrame, key: str, k: int = 2, rounds: int = 100, seed: int = 0) -> tuple[DataFrame, list[float]]:
    """((key, cluster, distance), summed squared distance of each round): clusters around averages under the warped distance.

    Each round assigns every row to its nearest centre and moves a centre's places to the mean of the values that the best paths align
    with them.  Neither step raises the summed squared distance; it ends when the sum stands still, by then at the latest after
    `rounds`.  What a task sends is one row of sums for each cluster.  The first centres are a hash sample; a cluster without rows keeps
    its centre.  Profiles have one length; rows with a null profile are left out.
    """
    rows = cut_lineage(df.select(key, "profile").where("profile IS NOT NULL"))
    centres = [np.array(r["profile"], dtype=float) for r in sample_rows(rows, F.col(key), k, seed).orderBy(key).collect()]
    if not centres:
        return rows.select(key, F.lit(0).alias("cluster"), F.lit(0.0).alias("distance")), []

    def nearest(x: np.ndarray, at: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list]:
        found = [warp(x, c) for c in at]
        far = np.stack([f[0] for f in found])
        return far.argmin(axis=0), far.min(axis=0), found

    def moved(at: list[np.ndarray]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((len(at), 2 * len(at[0]) + 1))
            for b in batches:
                for start in range(0, b.num_rows, 2048):
                    x = matrix(b.column("profile").slice(start, 2048), len(at[0]))
                    which, far, found = nearest(x, at)
                    for c, (_, sums, counts) in enumerate(found):
                        mine = which == c
                        total[c] += np.concatenate([sums[mine].sum(axis=0), counts[mine].sum(axis=0), [far[mine].sum()]])
            yield pa.RecordBatch.from_arrays([pa.array(range(len(at)), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], names=["cluster", "v"])

        return run

    sums: list[float] = []
    m = len(centres[0])
    for _ in range(rounds):
        parts = rows.select("profile").mapInArrow(moved(centres), "cluster int, v array<double>").select("cluster", F.posexplode("v").alias("i", "v"))
        total = np.zeros((len(centres), 2 * m + 1))
        for r in parts.groupBy("cluster", "i").agg(F.sum("v").alias("v")).collect():  # k · (2 m + 1) numbers
            total[r["cluster"], r["i"]] = r["v"]
        sums.append(float(total[:, -1].sum()))
        if len(sums) > 1 and sums[-2] - sums[-1] <= 1e-9 * max(sums[0], 1e-300):
            break
        centres = [np.round(np.where(t[m : 2 * m] > 0, t[:m] / np.maximum(t[m : 2 * m], 1), c), 9) for t, c in zip(total, centres)]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            which, far, _ = nearest(matrix(b.column("profile"), m), centres)
            yield pa.RecordBatch.from_arrays([b.column(key), pa.array(which.astype("int32")), pa.array(np.sqrt(far))], names=[key, "cluster", "distance"])

    kind = dict(rows.dtypes)[key]
    return rows.mapInArrow(assign, f"{key} {kind}, cluster int, distance double"), sums
