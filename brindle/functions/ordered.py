"""Global order statistics without a single-task sort.

Rows are first collapsed to distinct values with their frequencies (a hot value becomes one row).  The
values are then cut into ranges by sampled edges; only the edges are approximate, and they decide no
more than the balance of the ranges.  Range totals are a table of bounded size, so their running sum may
sit in one window; the order inside a range is a window per range.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from brindle.functions.expr import with_params

def named(key: str | Column) -> Column:
    """A key as a string that is never null, so that null is a key like any other in maps and joins."""
    key = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit("null"))


ACCURACY = 10_000  # of the sketch: a bracket holds 4 / ACCURACY of the rows
RANGES = 256  # a power of two; raise it when a range still holds too many distinct values


def range_edges(df: DataFrame, order: str, key: str, ranges: int = RANGES) -> DataFrame:
    """One row: map key → ascending range edges.  `key` must be a column of few values (a name)."""
    probs = [i / ranges for i in range(1, ranges)]
    per_key = df.groupBy(named(key).alias("_name")).agg(F.percentile_approx(order, probs, 10 * ranges).alias("_all"))
    return per_key.agg(F.map_from_entries(F.collect_list(F.struct("_name", "_all"))).alias("edges"))


def _with_range(df: DataFrame, order: str, key: str, ranges: int, measures: Sequence[str]) -> DataFrame:
    """Adds `_range` by halving: one comparison per bit, one small column per step, all in generated code.

    The edges read every count column too: both uses of the counts then need the same shuffle, and it runs
    once.
    """
    whole = df.where(reduce(and_, [F.col(m) > -1 for m in measures]))
    edged = with_params(df, range_edges(whole, order, key, ranges), "_e")
    found = edged.select(*df.columns, F.col("_e.edges")[named(key)].alias("_edges"), F.lit(0).alias("_range"))
    step = ranges // 2
    while step:
        above = F.col(order) > F.get("_edges", F.col("_range") + (step - 1))
        found = found.withColumn("_range", F.col("_range") + F.when(above, step).otherwise(0))
        step //= 2
    return found.drop("_edges")


def running_totals(hist: DataFrame, order: str, measures: Sequence[str], key: str, ranges: int = RANGES) -> DataFrame:
    """Totals of `measures` over all rows of the same key that come strictly before, as `<m>_before`.

    `hist` holds one row per (key, order value) and counts; `key` is a column of few values.
    """
    ranged = _with_range(hist, order, key, ranges, [c for c in hist.columns if c not in (key, order)]).withColumn("_name", named(key))
    sums = ranged.groupBy("_name", "_range").agg(*[F.sum(m).alias(f"_{m}") for m in measures])
    over_ranges = Window.partitionBy("_name").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        "_name", "_range", *[F.coalesce(F.sum(f"_{m}").over(over_ranges), F.lit(0)).alias(f"_{m}_offset") for m in measures]
    )
    inside = Window.partitionBy("_name", "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.select(
        "*", *[F.coalesce(F.sum(m).over(inside), F.lit(0)).alias(f"_{m}_local") for m in measures]
    )
    joined = local.join(offsets, ["_name", "_range"])
    return joined.select(
        *hist.columns, *[(F.col(f"_{m}_offset") + F.col(f"_{m}_local")).alias(f"{m}_before") for m in measures]
    )


def brackets(df: DataFrame, columns: Sequence[str], probs: Sequence[float], accuracy: int = ACCURACY) -> DataFrame:
    """One row with a struct (n, lo, hi) for each column: values that surely enclose the wanted ranks.

    A mergeable sketch errs by n / accuracy ranks at most; the ends are asked for twice as far from the rank, and an end beyond the
    first or last value is that value.  Fewer than `accuracy` values are all inside, as ranks lie apart by more than the margin then.
    """
    ends = [min(max(float(p) + d * 2 / accuracy, 0.0), 1.0) for d in (-1, 1) for p in probs]
    made = []
    for i, c in enumerate(columns):
        v = F.col(c).cast("double")
        q = F.percentile_approx(v, ends, accuracy)
        few = F.count(v) < accuracy
        lows = [F.min(v) if e <= 0 else F.when(few, F.min(v)).otherwise(q[k]) for k, e in enumerate(ends[: len(probs)])]
        highs = [F.max(v) if e >= 1 else F.when(few, F.max(v)).otherwise(q[len(probs) + k]) for k, e in enumerate(ends[len(probs) :])]
        made.append(F.struct(F.count(v).alias("n"), F.array(*lows).alias("lo"), F.array(*highs).alias("hi")).alias(f"c{i}"))
    return df.agg(*made)


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], accuracy: int = ACCURACY) -> DataFrame:
    """Linear-interpolated quantiles as rows (column, prob, value); nulls are ignored, a column without values has no rows.

    A sketch brackets each rank; a second look counts what lies below the bracket, a third keeps the values inside it.  Those are few
    (a part of 4 / accuracy of the rows, and equal values are one row), so nothing else is exchanged or ordered.
    """
    columns, probs = list(columns), list(probs)
    held = brackets(df, columns, probs, accuracy).first()  # two numbers for each rank
    values = df.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)])
    every = [(i, k) for i in range(len(columns)) for k in range(len(probs)) if held[i]["n"]]
    v = lambda i: F.col(f"v{i}")
    low, high = (lambda i, k, end=end: F.lit(held[i][end][k]) for end in ("lo", "hi"))
    below = values.agg(*[F.count_if(v(i) < low(i, k)).alias(f"b{i}_{k}") for i, k in every] or [F.lit(0).alias("none")])
    cell = lambda i, k: F.when((v(i) >= low(i, k)) & (v(i) <= high(i, k)), F.struct(F.lit(i).alias("i"), F.lit(k).alias("k"), v(i).alias("value")))
    none = F.lit(None).cast("struct<i:int,k:int,value:double>")
    inside = values.select(F.explode(F.array_compact(F.array(none, *[cell(i, k) for i, k in every]))).alias("c"))
    counts = inside.groupBy("c.i", "c.k", "c.value").agg(F.count("*").alias("n"))
    zero = F.lit(0).cast("bigint")
    before = F.array(*[F.array(*[F.col(f"_w.b{i}_{k}") if (i, k) in every else zero for k in range(len(probs))]) for i in range(len(columns))])
    sizes = F.array(*[F.lit(r["n"]) for r in held])
    placed = with_params(counts, below, "_w")
    rising = Window.partitionBy("i", "k").orderBy("value")
    placed = placed.select("i", "k", "value", "n", (before[F.col("i")][F.col("k")] + F.sum("n").over(rising) - F.col("n")).alias("start"), sizes[F.col("i")].alias("total"))
    prob = F.array(*[F.lit(float(p)) for p in probs])[F.col("k")]
    pos = prob * (F.col("total") - 1)
    holds = lambda rank: (rank >= F.col("start")) & (rank < F.col("start") + F.col("n"))
    low, high = (F.max(F.when(holds(rank), F.col("value"))) for rank in (F.floor("pos"), F.ceil("pos")))
    found = placed.withColumn("pos", pos).groupBy("i", "k").agg(low.alias("low"), high.alias("high"), F.max(F.col("pos") - F.floor("pos")).alias("frac"))
    name = F.array(*[F.lit(c) for c in columns])[F.col("i")]
    return found.select(name.alias("column"), prob.alias("prob"), (F.col("low") + (F.col("high") - F.col("low")) * F.col("frac")).alias("value"))


def quantile_row(df: DataFrame, wanted: dict[str, tuple[str, float]]) -> DataFrame:
    """One row of named quantiles: {"q1": ("price", .25)} → column q1."""
    columns = sorted({c for c, _ in wanted.values()})
    probs = sorted({p for _, p in wanted.values()})
    rows = exact_quantiles(df, columns, probs)
    return rows.agg(
        *[
            F.max(F.when((F.col("column") == c) & (F.col("prob") == float(p)), F.col("value"))).alias(name)
            for name, (c, p) in wanted.items()
        ]
    )
