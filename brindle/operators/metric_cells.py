"""Cells of a metric space: rows dealt by nearest pivot, with bounds that tell which cells a query can skip.

Pivots are a hash sample of the items, so they follow the data's density.  A cell is the items of one pivot that lack the same
coordinates; for each the count, the box and the range of distances to the pivot are kept.  What a query is surely away from a cell
is the largest of three bounds: its distance to the box, the triangle inequality by the pivot, and the plane half way to the query's
own pivot.  Pivots and boxes are parameters of a bounded number (`MAX_CELLS`); rows are cut into blocks of bounded bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from brindle.sources.scratch import cut_lineage

MAX_CELLS = 1024  # pivots at most; with gaps in the data also as many patterns of missing coordinates as there are frequent ones
PATTERNS = 64
CELL_ROWS = 2048  # items a cell is meant to hold
BLOCK_BYTES = 16 << 20  # vectors of one side of a task
TASKS_A_CORE = 3  # a pass is dealt into as many tasks a core at least, where it has the pairs
CHUNK = 1 << 21  # distances that a task holds at once


def matrix(column: pa.ChunkedArray | pa.Array, d: int) -> np.ndarray:
    """Rows of a list column; a null coordinate is nan."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, dtype="float64").reshape(-1, d)


def euclidean(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Coordinate by coordinate: no cancellation, so equal points are at distance 0.  Missing coordinates scale the others up."""
    total, d = np.zeros((len(q), len(x))), q.shape[1]
    if not (np.isnan(q).any() or np.isnan(x).any()):
        for j in range(d):
            total += (q[:, j, None] - x[None, :, j]) ** 2
        return np.sqrt(total * d / d)
    seen = np.zeros((len(q), len(x)))
    for j in range(d):
        diff = q[:, j, None] - x[None, :, j]
        ok = ~np.isnan(diff)
        total += np.where(ok, diff, 0.0) ** 2
        seen += ok
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.sqrt(np.where(seen > 0, total * d / seen, np.nan))


def pair_distances(q: np.ndarray, x: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """`euclidean` of the pairs (q[i], x[j]) without missing coordinates, to the last bit."""
    total, d = np.zeros(len(i)), q.shape[1]
    for c in range(d):
        total += (q[i, c] - x[j, c]) ** 2
    return np.sqrt(total * d / d)


def rough_squares(q: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """(squared distances by one matrix product, what each row's are off at most); none where a coordinate is missing or too large."""
    qq, xx = np.einsum("ij,ij->i", q, q), np.einsum("ij,ij->i", x, x)
    if not len(xx) or not np.isfinite(qq).all() or not np.isfinite(xx).all():
        return None
    rough = q @ x.T
    rough *= -2.0
    rough += qq[:, None]
    rough += xx[None]
    return rough, (q.shape[1] + 64) * 1e-14 * (qq + xx.max()) + 1e-300


def reach_of(square: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Rough squares up to this can belong to a distance that, rounded to 12 places, is not above that of `square`."""
    top = np.maximum(square, 0.0)
    return top + 4 * off + 1e-11 * np.sqrt(top + off) + 1e-13 * top + 1e-22


def closest(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest pivot of each row, the first of equal ones, and the distance to it)."""
    found = rough_squares(x, pivots)
    if found is None:
        to = np.nan_to_num(euclidean(x, pivots), nan=0.0)
        return to.argmin(axis=1), to.min(axis=1)
    rough, off = found
    i, j = np.nonzero(rough <= reach_of(rough.min(axis=1), off)[:, None])
    to = pair_distances(x, pivots, i, j)
    order = np.lexsort((j, to, i))
    first = order[np.unique(i[order], return_index=True)[1]]
    return j[first], to[first]


@dataclass
class Cells:
    """Parameters of all cells, by cell number."""

    pivots: np.ndarray
    pivot_of: np.ndarray
    count: np.ndarray
    low: np.ndarray
    high: np.ndarray
    near: np.ndarray  # least distance to the pivot; nan where coordinates are missing
    far: np.ndarray
    known: np.ndarray  # cell × coordinate; a cell of mixed patterns knows none
    mixed: np.ndarray
    extra: np.ndarray  # least value of the column given as `least`

    @property
    def d(self) -> int:
        return self.pivots.shape[1]

    def bounds(self, q: np.ndarray) -> np.ndarray:
        """For each query and cell a distance that no item of the cell is below."""
        d, out = self.d, np.zeros((len(q), len(self.count)))
        seen = np.zeros_like(out)
        for j in range(d):
            gap = np.maximum(np.maximum(self.low[None, :, j] - q[:, j, None], q[:, j, None] - self.high[None, :, j]), 0.0)
            ok = self.known[None, :, j] & ~np.isnan(q[:, j, None])
            out += np.where(ok, gap, 0.0) ** 2
            seen += ok
        out = np.sqrt(out * d / np.maximum(seen, 1))
        whole = ~np.isnan(q).any(axis=1)
        if whole.any() and self.known.all(axis=1).any():
            to = euclidean(q[whole], self.pivots)
            own, mine = to.argmin(axis=1), to.min(axis=1)
            apart = euclidean(self.pivots, self.pivots)[own]
            with np.errstate(invalid="ignore", divide="ignore"):
                plane = np.where(apart > 0, (to**2 - mine[:, None] ** 2) / (2 * apart), 0.0)[:, self.pivot_of]
            ring = np.maximum(to[:, self.pivot_of] - self.far[None], self.near[None] - to[:, self.pivot_of])
            fit = self.known.all(axis=1)[None]
            out[whole] = np.where(fit, np.fmax(out[whole], np.fmax(plane, ring)), out[whole])
        return np.where(self.mixed[None], 0.0, out * (1 - 1e-9) - 1e-9)

    def nearest(self, q: np.ndarray) -> np.ndarray:
        """Cells in the order in which they should be tried, by distance to their pivot."""
        found = rough_squares(q, self.pivots)
        to = (euclidean(q, self.pivots) if found is None else found[0])[:, self.pivot_of]
        return np.argsort(np.where(np.isnan(to), np.inf, to), axis=1, kind="stable")


def _pattern():
    return F.array_join(F.transform("vec", lambda v: F.when(v.isNull() | F.isnan(v), F.lit("0")).otherwise(F.lit("1"))), "")


def place(items: DataFrame, least: str | None = None, max_cells: int = MAX_CELLS, cell_rows: int = CELL_ROWS, block_bytes: int = BLOCK_BYTES) -> tuple[Cells | None, DataFrame]:
    """(cells, items with `cell` and `block`) of items (id, vec, …); no cells where there are no items.

    A cell's items are dealt into blocks by a hash of their id, so that a block's vectors stay below `block_bytes`.
    """
    items = cut_lineage(items.where("vec IS NOT NULL"))
    n, d = items.agg(F.count("*"), F.max(F.size("vec"))).first()
    if not n:
        return None, items.select("*", F.lit(0).alias("cell"), F.lit(0).alias("block"))
    m = int(min(max_cells, max(1, n // cell_rows)))
    if m == 1:  # one cell that everything visits
        none = np.zeros(1)
        cells = Cells(np.zeros((1, d)), np.zeros(1, dtype=int), np.array([n]), np.zeros((1, d)), np.zeros((1, d)), none, none, np.zeros((1, d), dtype=bool), np.ones(1, dtype=bool), np.array([-np.inf]))
        return cells, items.withColumns({"cell": F.lit(0), "block": F.pmod(F.xxhash64("id"), F.lit(int(np.ceil(n * (8 * d + 24) / block_bytes)))).cast("int")})
    rows = items.select("vec").orderBy(F.xxhash64("id"), "id").limit(m).collect()
    pivots = np.unique(np.nan_to_num(np.array([[np.nan if v is None else v for v in r[0]] for r in rows], dtype="float64")), axis=0)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column("vec"), d)
            of, away = closest(x, pivots)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(of.astype("int32")), pa.array(away)], names=[*b.schema.names, "pivot", "away"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema)
    dealt = cut_lineage(items.mapInArrow(assign, f"{kinds}, pivot int, away double").withColumn("pattern", _pattern()))
    frequent = [r[0] for r in dealt.groupBy("pattern").count().orderBy(F.desc("count"), "pattern").limit(PATTERNS).collect()]
    kind = F.when(F.col("pattern").isin(frequent), F.col("pattern")).otherwise(F.lit(""))
    dealt = dealt.withColumn("pattern", kind)
    lows, highs = ([f(F.when(~F.isnan(F.col("vec")[j]), F.col("vec")[j])) for j in range(d)] for f in (F.min, F.max))
    extra = F.min(F.lit(0.0) if least is None else F.col(least))
    stats = dealt.groupBy("pivot", "pattern").agg(F.count("*").alias("n"), F.min("away").alias("near"), F.max("away").alias("far"), F.array(*lows).alias("low"), F.array(*highs).alias("high"), extra.alias("extra")).orderBy("pivot", "pattern").collect()
    number = lambda v, fill: np.array([[fill if x is None else x for x in r] for r in v], dtype="float64")
    known = np.array([[c == "1" for c in r["pattern"]] if r["pattern"] else [False] * d for r in stats])
    cells = Cells(pivots, np.array([r["pivot"] for r in stats]), np.array([r["n"] for r in stats]), number([r["low"] for r in stats], 0.0), number([r["high"] for r in stats], 0.0),
                  np.array([r["near"] for r in stats]), np.array([r["far"] for r in stats]), known, np.array([r["pattern"] == "" for r in stats]), np.array([r["extra"] for r in stats], dtype="float64"))
    blocks = np.ceil(cells.count * (8 * d + 24) / block_bytes).astype(int)
    names = F.create_map(*[F.lit(v) for i, r in enumerate(stats) for v in (f"{r['pivot']}|{r['pattern']}", i)])
    cell = names[F.concat(F.col("pivot").cast("string"), F.lit("|"), "pattern")]
    count = F.array(*[F.lit(int(b)) for b in blocks])
    placed = dealt.withColumn("cell", cell).withColumn("block", F.pmod(F.xxhash64("id"), F.element_at(count, F.col("cell") + 1)).cast("int"))
    return cells, cut_lineage(placed.drop("pivot", "away", "pattern"))


def _groups(cells: Cells, block_bytes: int) -> tuple[list[int], list[int]]:
    """(first group of each cell, its blocks): a large cell's blocks are groups of their own, small cells share one up to `block_bytes`."""
    size = cells.count * (8 * cells.d + 24)
    blocks = np.ceil(size / block_bytes).astype(int)
    start, at, held = [], -1, block_bytes
    for b, bytes_ in zip(blocks, size):
        if b > 1 or held + bytes_ > block_bytes:
            at, held = at + 1, 0
        start.append(at)
        held += bytes_
        if b > 1:
            at, held = at + int(b) - 1, block_bytes
    return start, [int(b) for b in blocks]


def block_join(visits: DataFrame, placed: DataFrame, cells: Cells, meet, schema: str, bytes_each: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """`meet(queries, items)` on the queries and items of every cell, in tasks of bounded bytes.

    `visits` has one row a query with `qid` and the array `cells`.  Cells that lie next to each other share a group of `block_bytes`,
    so a query is sent once for each group, not for each cell; how many queries a group has is counted first, and they are dealt into
    blocks of bounded bytes as the items are.  Every (group, query block) is a task of about equal work, not put together with others.
    """
    start, blocks = _groups(cells, block_bytes)
    n = max(s + b for s, b in zip(start, blocks))
    items = np.zeros(n)
    for s, b, c in zip(start, blocks, cells.count):
        items[s : s + b] += c / b

    def at(values: list[int], index):
        return F.element_at(F.array(*[F.lit(int(v)) for v in values]), index + 1)

    whole = [b == 1 for b in blocks]
    near = visits.withColumn("_own", F.transform("cells", lambda c: at(start, c)))
    if all(whole):
        near = near.withColumn("group", F.explode(F.array_distinct("_own")))
    else:
        near = near.withColumn("group", F.explode(F.array_distinct(F.flatten(F.transform("cells", lambda c: F.sequence(at(start, c), at(start, c) + at(blocks, c) - 1))))))
    first = [s for s, g in sorted({(s, s + i) for s, b in zip(start, blocks) for i in range(b)}, key=lambda p: p[1])]
    mine = F.filter("cells", lambda c: at(start, c) == at(first, F.col("group")))
    asked = np.zeros(n)
    for group, rows in near.groupBy("group").count().collect():
        asked[group] = rows
    # also as many blocks as give every core its share of the pairs, so that a large group is not one task; few pairs need no more tasks
    work = asked * items
    share = np.ceil(np.minimum(TASKS_A_CORE * visits.sparkSession.sparkContext.defaultParallelism * work / max(work.sum(), 1.0), work / (2 * CHUNK)))
    parts = np.maximum(np.ceil(asked * bytes_each / block_bytes), np.minimum(share, np.ceil(asked / 64)).clip(1)).astype(int)
    offset, tasks = [int(x) for x in np.cumsum(parts) - parts], int(parts.sum())
    parts = [int(x) for x in parts]

    def by_cell(_key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out = [meet(left.slice(0, 0), right.slice(0, 0))]
        if left.num_rows and right.num_rows:
            kinds, of = np.unique(right["cell"].to_numpy(), return_inverse=True)
            lists = left["cells"].combine_chunks()
            lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
            row, flat = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy()), lists.flatten().to_numpy()
            slot = np.searchsorted(kinds, flat).clip(max=len(kinds) - 1)
            ok = kinds[slot] == flat
            opened = np.zeros((len(lists), len(kinds)), dtype=bool)
            opened[row[ok], slot[ok]] = True
            sets, kind = np.unique(opened, axis=0, return_inverse=True)
            if len(sets) <= len(kinds):  # queries that visit the same cells meet them together
                pairs = [(np.flatnonzero(kind.ravel() == i), np.flatnonzero(s[of])) for i, s in enumerate(sets)]
            else:
                pairs = [(np.flatnonzero(opened[:, i]), np.flatnonzero(of == i)) for i in range(len(kinds))]
            out += [meet(left.take(a), right.take(b)) for a, b in pairs if len(a) and len(b)]
        return pa.concat_tables(out)

    q = near.withColumn("cells", mine).drop("_own")
    q = q.withColumn("task", at(offset, F.col("group")) + F.pmod(F.xxhash64("qid"), at(parts, F.col("group"))).cast("int")).drop("group")
    x = placed.withColumn("_group", at(start, F.col("cell")) + F.col("block"))
    x = x.withColumn("task", F.explode(F.sequence(at(offset, F.col("_group")), at(offset, F.col("_group")) + at(parts, F.col("_group")) - 1))).drop("_group")
    # the tasks are dealt by number and with room: tasks of few bytes and much work must not be put together
    spread = max(tasks, min(4 * tasks, 4096))
    return q.repartition(spread, "task").groupBy("task").cogroup(x.repartition(spread, "task").groupBy("task")).applyInArrow(by_cell, schema)


def best_rows(rows: DataFrame, k: int) -> DataFrame:
    """The k nearest of each query with `rank` from 1; equal scores by item id."""
    best = Window.partitionBy("qid").orderBy("score", "id")
    return rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
