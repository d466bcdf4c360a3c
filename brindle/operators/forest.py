"""A regression forest grown on cells: rows whose features fall into the same bins move through all trees together.

A tree sees its rows only by the bins of their features and by sums of weights and labels.  Rows are dealt once in order of their bins, so
that a task holds each cell as a run.  A level of all trees is one pass: every row draws its bootstrap weight for every tree from the
hash of the row, a run of equal bins is summed, and only its sums are led through the tree and counted for the node.  Rows cost a draw
and two sums a tree; what is dearer, they cost once a cell.  The sums of a tree meet by tree, where the best splits are chosen.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame, functions as F

from brindle.sources.scratch import cut_lineage

BINS = 32
CHUNK = 65_536  # rows of a task held at a time
ROWS = 500_000  # rows of a partition

_GOLD = 0x9E3779B97F4A7C15


def _draws() -> np.ndarray:
    """Poisson(1) counts at steps of 1/65,536 of their distribution."""
    from brindle.operators.models import poisson_steps

    return np.searchsorted(np.array(poisson_steps()), (np.arange(65_536) + 0.5) / 65_536, side="right").astype(np.uint8)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bin_edges(rows: DataFrame, dims: int, bins: int = BINS) -> list[list[float]]:
    """For each element of `v` at most bins - 1 thresholds: between all values if these are few, else at quantiles."""
    found = rows.agg(*[F.approx_count_distinct(F.col("v")[i], 0.02) for i in range(dims)]).first()
    edges: list[list[float]] = []
    for i in range(dims):
        values = None
        if found[i] <= 2 * bins:
            values = sorted(r[0] for r in rows.select(F.col("v")[i]).distinct().collect())
        if values is None or len(values) > bins:
            values = sorted(set(rows.select(F.col("v")[i].alias("x")).approxQuantile("x", [k / bins for k in range(1, bins)], 0.001)))
            edges.append([float(x) for x in values])
        else:
            edges.append([(a + b) / 2 for a, b in zip(values, values[1:])])
    return edges


def _bins(v: pa.Array, edges: list[list[float]]) -> np.ndarray:
    x = v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), len(edges))
    return np.stack([np.searchsorted(e, x[:, i], side="left") for i, e in enumerate(edges)], axis=1).astype(np.uint8)


def _binned(edges: list[list[float]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in _bins(b.column("v"), edges)], pa.binary()), b.column("key"), b.column("y")], ["bins", "key", "y"])

    return run


def _chunks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bins, key, label) of CHUNK rows at a time; a row that is equal to the one before has a key of its own."""
    last, nth = None, 0
    held: list[pa.RecordBatch] = []

    def out():
        nonlocal last, nth
        bins = np.frombuffer(b"".join(x for b in held for x in b.column("bins").to_pylist()), np.uint8).reshape(-1, dims)
        key = np.concatenate([b.column("key").to_numpy(zero_copy_only=False) for b in held])
        y = np.concatenate([b.column("y").to_numpy(zero_copy_only=False) for b in held])
        at = np.arange(len(key))
        new = np.r_[True, key[1:] != key[:-1]]
        again = at - np.maximum.accumulate(np.where(new, at, 0))
        if key[0] == last:
            again += np.where(np.cumsum(new) == 1, nth + 1, 0)
        last, nth = key[-1], int(again[-1])
        held.clear()
        return bins, _mix(key.view(np.uint64) + again.astype(np.uint64) * np.uint64(0xD1342543DE82EF95)), y

    size = 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            size += b.num_rows
        if size >= CHUNK:
            yield out()
            size = 0
    if held:
        yield out()


def _walk(flat: np.ndarray, start: np.ndarray, trees: dict[str, np.ndarray], t: int, steps: int) -> np.ndarray:
    """The node of each cell after so many steps; 0 where it had come to a leaf before."""
    node = np.ones(len(start), np.int64)
    for _ in range(steps):
        right = flat.take(start + trees["feature"][t].take(node)) > trees["bin"][t].take(node)
        node = trees["child"][t].take(node)
        node += right
    return node


def _sums(state, level: int, dims: int, draws: np.ndarray):
    """For each tree: sums of weights and weighted labels by open node, candidate feature and bin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = state.value
        slot, picks = trees["slot"], trees["picks"]
        n, k = len(slot), trees["k"]
        total: dict[int, np.ndarray] = {}
        for bins, key, y in _chunks(batches, dims):
            # runs of equal bins are cells
            first = np.flatnonzero(np.r_[True, (bins[1:] != bins[:-1]).any(axis=1)])
            flat = np.ascontiguousarray(bins[first]).ravel()
            start = np.arange(len(first)) * dims
            drawn = None
            for t in range(n):
                if t % 4 == 0:
                    drawn = _mix(key + np.uint64(_GOLD * (t // 4 + 1) % 2**64)).view(np.uint16).reshape(-1, 4)
                open_nodes = len(picks[t])
                if not open_nodes:
                    continue
                w = draws.take(drawn[:, t % 4]).astype(np.float64)
                s = w * y
                if len(first) < len(y):
                    w, s = np.add.reduceat(w, first), np.add.reduceat(s, first)
                at = slot[t].take(_walk(flat, start, trees, t, level))
                use = np.flatnonzero(at >= 0)
                if len(use) < len(at):
                    at, w, s, begin = at[use], w[use], s[use], start[use]
                else:
                    begin = start
                if t not in total:
                    total[t] = np.zeros((2, open_nodes * k * BINS))
                for c in range(k):
                    place = (at * k + c) * BINS + flat.take(begin + picks[t][:, c].take(at))
                    total[t][0] += np.bincount(place, w, total[t].shape[1])
                    total[t][1] += np.bincount(place, s, total[t].shape[1])
        for t, v in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([v.tobytes()], pa.binary())], ["tree", "sums"])

    return run


def best_splits(sums: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(candidate, bin, gain, left mean, right mean, mean) of each node; a gain of 0 where no split helps.

    The gain is what the split takes from the sum of squared errors.
    """
    w, s = sums.reshape(2, -1, k, BINS)
    left_w, left_s = w.cumsum(axis=2), s.cumsum(axis=2)
    all_w, all_s = left_w[:, :, -1:], left_s[:, :, -1:]
    right_w, right_s = all_w - left_w, all_s - left_s
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left_s**2 / left_w + right_s**2 / right_w - all_s**2 / all_w
        mean = np.where(all_w > 0, all_s / all_w, 0.0)[:, 0, 0]
        gain = np.where((left_w >= 1) & (right_w >= 1), gain, 0.0)
        # rounding is no gain
        gain = np.where(gain > 1e-12 * np.abs(all_s**2 / np.maximum(all_w, 1)), gain, 0.0).reshape(len(w), -1)
        best = gain.argmax(axis=1)
        at = np.arange(len(w))
        left, right = (np.nan_to_num((a.reshape(len(w), -1)[at, best] / b.reshape(len(w), -1)[at, best])) for a, b in ((left_s, left_w), (right_s, right_w)))
    return best // BINS, best % BINS, gain[at, best], left, right, mean


def _choose(k: int):
    """Rows in order of tree: the sums of a tree are added up, one tree at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, total = None, None

        def out() -> pa.RecordBatch:
            made = [x.astype(np.float64) for x in best_splits(total, k)]
            return pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in made)], ["tree", *PARTS])

        for b in batches:
            for t, v in zip(b.column(0).to_pylist(), b.column(1)):
                part = np.frombuffer(v.as_py(), np.float64).reshape(2, -1)
                if t != tree:
                    if tree is not None:
                        yield out()
                    tree, total = t, part.copy()
                else:
                    total += part
        if tree is not None:
            yield out()

    return run


PARTS = ["pick", "bin", "gain", "left", "right", "mean"]


class CellForest(Estimator):
    """Random forest for regression: bootstrap samples, a third of the features at each node, at most 32 bins a feature.

    `key` names the columns that tell rows apart; a row's draws are a function of its key, features and label, and do not depend on how
    rows are dealt.
    """

    def __init__(self, n_trees: int, depth: int, seed: int = 0, key: Sequence[str] = (), label: str = "label", features: str = "features") -> None:
        super().__init__()
        self.n_trees, self.depth, self.seed, self.key, self.label, self.features = n_trees, depth, seed, list(key), label, features

    def _rows(self, df: DataFrame) -> DataFrame:
        from brindle.operators.models import _given

        v = vector_to_array(self.features)
        return df.select(v.alias("v"), _given(self.label).alias("y"), F.xxhash64(F.lit(self.seed), *self.key, v, F.col(self.label)).alias("key"))

    def _fit(self, df: DataFrame) -> Model:
        spark, sc = df.sparkSession, df.sparkSession.sparkContext
        rows = self._rows(df)
        head = rows.select(F.count("*").alias("n"), F.max(F.size("v")).alias("d")).first()
        if not head["n"]:
            raise ValueError("no rows to fit to")
        dims = head["d"]
        edges = bin_edges(rows, dims)
        parts = max(sc.defaultParallelism, -(-head["n"] // ROWS))
        # a cell of many rows may lie in several partitions
        cells = rows.mapInArrow(_binned(edges), "bins binary, key long, y double")
        cells = cut_lineage(cells.repartitionByRange(parts, "bins", "key").sortWithinPartitions("bins", "key"))
        k, nodes = -(-dims // 3), 1 << (self.depth + 1)
        trees = {
            "feature": np.zeros((self.n_trees, nodes), np.int64), "bin": np.full((self.n_trees, nodes), 255, np.uint8),
            "child": np.zeros((self.n_trees, nodes), np.int64), "mean": np.zeros((self.n_trees, nodes)),
        }
        open_nodes = [np.array([1])] * self.n_trees
        taken = np.zeros((self.n_trees, dims))
        rng = np.random.default_rng(self.seed)
        draws = _draws()
        for level in range(self.depth):
            slot = np.full((self.n_trees, nodes), -1, np.int64)
            for t, o in enumerate(open_nodes):
                slot[t, o] = np.arange(len(o))
            picks = [rng.random((len(o), dims)).argsort(axis=1)[:, :k] for o in open_nodes]
            if not any(map(len, picks)):
                break
            state = sc.broadcast({**trees, "slot": slot, "picks": picks, "k": k})
            sums = cells.mapInArrow(_sums(state, level, dims, draws), "tree int, sums binary")
            chosen = sums.repartition("tree").sortWithinPartitions("tree").mapInArrow(_choose(k), "tree int, " + ", ".join(f"{p} binary" for p in PARTS))
            for r in chosen.toLocalIterator():
                t = r["tree"]
                pick, at, gain, left, right, mean = (np.frombuffer(r[p], np.float64) for p in PARTS)
                o = open_nodes[t]
                trees["mean"][t, o] = mean
                split = np.flatnonzero(gain > 0)
                parent, f = o[split], picks[t][split, pick[split].astype(int)]
                trees["feature"][t, parent], trees["bin"][t, parent], trees["child"][t, parent] = f, at[split], 2 * parent
                trees["mean"][t, 2 * parent], trees["mean"][t, 2 * parent + 1] = left[split], right[split]
                np.add.at(taken[t], f, gain[split])
                open_nodes[t] = np.r_[2 * parent, 2 * parent + 1]
            state.unpersist()
        share = taken.sum(axis=1, keepdims=True)
        each = np.divide(taken, share, out=np.zeros_like(taken), where=share > 0).sum(axis=0)
        return CellForestModel(trees, edges, each / each.sum() if each.sum() > 0 else each, self.depth, self.features)


class CellForestModel(Model):
    """Adds `prediction`, the mean over trees."""

    def __init__(self, trees: dict[str, np.ndarray], edges: list[list[float]], importances: np.ndarray, depth: int, features: str) -> None:
        super().__init__()
        self.trees, self.edges, self.depth, self.features = trees, edges, depth, features
        self.featureImportances = DenseVector(importances)

    def _predict(self, df: DataFrame) -> Column:
        from pyspark.sql.functions import pandas_udf

        state, edges, depth = df.sparkSession.sparkContext.broadcast(self.trees), self.edges, self.depth

        @pandas_udf("double")
        def predict(v):
            import pandas as pd

            trees = state.value
            if not len(v):
                return pd.Series([], dtype=float)
            cells, back = np.unique(_bins(pa.array(v), edges), axis=0, return_inverse=True)
            flat, start = np.ascontiguousarray(cells).ravel(), np.arange(len(cells)) * len(edges)
            out = np.zeros(len(cells))
            for t in range(len(trees["mean"])):
                node = np.ones(len(cells), np.int64)
                for _ in range(depth):
                    right = flat.take(start + trees["feature"][t].take(node)) > trees["bin"][t].take(node)
                    child = trees["child"][t].take(node)
                    node = np.where(child > 0, child + right, node)
                out += trees["mean"][t].take(node)
            return pd.Series((out / len(trees["mean"])).take(back.ravel()))

        return predict(vector_to_array(self.features))

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", self._predict(df))
