"""Forests for two classes whose trees are grown until every leaf is pure or its rows are alike.

Rows enter by the bins of their features, a byte each, in packed blocks.  A group of trees is a task: it is sent all blocks, draws each
row's bootstrap weights from the hash of the row's key, and grows its trees level by level.  Full trees have about as many nodes as rows, so they
are never brought together: they stay a table, and to apply them the blocks to be scored are sent to the groups, which return the sums
of their votes.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, functions as F, types as T

from brindle.operators.forest import _GOLD, _bins, _draws, _mix, bin_edges
from brindle.sources.scratch import cut_lineage

BINS = 256
GROUPS = 60  # tasks that share the trees
ROWS = 1_000_000  # rows that a task scores at most

_NODES = ["feature", "cut", "left", "mean"]
_KINDS = {"feature": np.uint8, "cut": np.uint8, "left": np.int32, "mean": np.float64}


def grow(codes: np.ndarray, w: np.ndarray, y: np.ndarray, k: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    """One tree on rows of weight `w` and label 0 or 1, by Gini impurity; `left` is a node's left child, the right one follows, a leaf has 0.

    `k` features are tried at each node, and more as long as those cannot part its rows.
    """
    use = np.flatnonzero(w > 0)
    d = codes.shape[1]
    flat, start = codes.ravel(), use * d
    w, y = w[use].astype(np.int64), y[use].astype(np.int64)
    node, low = np.zeros(len(use), np.int64), (w << 1) | y
    all_w, all_s, made = np.array([w.sum()]), np.array([(w * y).sum()]), 1
    found: dict[str, list[np.ndarray]] = {c: [] for c in _NODES}
    while True:
        n = len(all_w)
        feature, cut, best = np.full(n, -1), np.zeros(n, np.int64), np.full(n, -np.inf)
        left_w, left_s = np.zeros(n, np.int64), np.zeros(n, np.int64)
        impure = (all_s > 0) & (all_s < all_w)
        stay = impure[node]
        node, low, start = node[stay], low[stay], start[stay]
        tried = rng.random((n, d)).argsort(axis=1)
        for c in range(d):
            want = impure if c < k else impure & (feature < 0)
            if not want.any():
                break
            rows = slice(None) if c < k else np.flatnonzero(want[node])
            at = node[rows]
            # rows in order of node and bin, with weight and label in the last six bits
            packed = np.sort((((at << 8) | flat.take(start[rows] + tried[at, c])) << 6) | low[rows])
            end = np.flatnonzero(np.r_[(packed[1:] >> 6) != (packed[:-1] >> 6), True])
            weight = (packed >> 1) & 31
            of = packed[end] >> 14
            before_w, before_s = (np.where(want, np.cumsum(np.where(want, a, 0)) - a, 0) for a in (all_w, all_s))
            lw, ls = weight.cumsum()[end] - before_w[of], (weight * (packed & 1)).cumsum()[end] - before_s[of]
            rw, rs = all_w[of] - lw, all_s[of] - ls
            score = np.where(rw > 0, ls**2 / lw + rs**2 / np.maximum(rw, 1), -np.inf)
            first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            top = np.maximum.reduceat(score, first)
            hit = np.flatnonzero(score == np.repeat(top, np.diff(np.r_[first, len(of)])))
            hit = hit[np.r_[True, of[hit[1:]] != of[hit[:-1]]]]
            hit = hit[score[hit] > best[of[hit]]]
            name = of[hit]
            best[name], feature[name], cut[name] = score[hit], tried[name, c], (packed[end[hit]] >> 6) & 255
            left_w[name], left_s[name] = lw[hit], ls[hit]
        split = feature >= 0
        rank = np.cumsum(split) - 1
        for c, v in (("feature", np.maximum(feature, 0)), ("cut", cut), ("left", np.where(split, made + 2 * rank, 0)), ("mean", all_s / np.maximum(all_w, 1))):
            found[c].append(v.astype(_KINDS[c]))
        if not split.any():
            return {c: np.concatenate(v) for c, v in found.items()}
        stay = split[node]
        node, low, start = node[stay], low[stay], start[stay]
        node = 2 * rank[node] + (flat.take(start + feature[node]) > cut[node])
        all_w, all_s = (np.stack([a[split], b[split] - a[split]], axis=1).ravel() for a, b in ((left_w, all_w), (left_s, all_s)))
        made += len(all_w)


def vote(tree: dict[str, np.ndarray], codes: np.ndarray) -> np.ndarray:
    """The share of class 1 in the leaf of each row."""
    d, flat = codes.shape[1], codes.ravel()
    node, at = np.zeros(len(codes), np.int64), np.arange(len(codes))
    while len(at):
        here = node[at]
        left = tree["left"].take(here).astype(np.int64)
        inner = left > 0
        at, here, left = at[inner], here[inner], left[inner]
        node[at] = left + (flat.take(at * d + tree["feature"].take(here)) > tree["cut"].take(here))
    return tree["mean"].take(node)


def _weights(key: np.ndarray, tree: int, draws: np.ndarray) -> np.ndarray:
    return draws.take(_mix(key + np.uint64(_GOLD * (tree // 4 + 1) % 2**64)).view(np.uint16).reshape(-1, 4)[:, tree % 4])


def _pack(edges: list[list[float]], keep: Sequence[str] = ()):
    """Blocks of rows: bins, keys and labels as bytes, the kept columns as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            y = b.column("_y").to_numpy(zero_copy_only=False)
            if not np.isin(y, (0.0, 1.0)).all():
                raise ValueError("labels must be 0 or 1")
            sink = pa.BufferOutputStream()
            kept = b.select(list(keep))
            if keep:
                with pa.ipc.new_stream(sink, kept.schema) as out:
                    out.write_batch(kept)
            parts = [_bins(b.column("_v"), edges).tobytes(), b.column("_key").to_numpy(zero_copy_only=False).tobytes(), y.astype(np.uint8).tobytes(), sink.getvalue().to_pybytes()]
            yield pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().hex]), pa.array([b.num_rows], pa.int64()), *(pa.array([p], pa.binary()) for p in parts)], ["block", "n", "codes", "key", "y", "kept"])

    return run


_BLOCK = "block string, n bigint, codes binary, key binary, y binary, kept binary"


def _joined(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


class GrownForest(Estimator):
    """`n_trees` full trees on bootstrap samples, with a number of features tried at each node: "sqrt" or "all" of them.

    Splits lie between at most 256 bins a feature.  Rows of the same key are drawn together; the trees do not depend on how rows are dealt.
    """

    def __init__(self, n_trees: int, tried: str, seed: int = 0, key: Sequence[str] = (), label: str = "label", features: str = "features") -> None:
        super().__init__()
        self.n_trees, self.tried, self.seed, self.key, self.label, self.features = n_trees, tried, seed, list(key), label, features

    def _fit(self, df: DataFrame) -> Model:
        from brindle.operators.models import _given

        rows = df.select(vector_to_array(self.features).alias("v"), _given(self.label).alias("_y"), F.xxhash64(F.lit(self.seed), *self.key).alias("_key"))
        dims = rows.agg(F.max(F.size("v"))).first()[0]
        if not dims:
            raise ValueError("no rows to fit to")
        edges = bin_edges(rows, dims, BINS)
        blocks = cut_lineage(rows.withColumnRenamed("v", "_v").mapInArrow(_pack(edges), _BLOCK))
        n_trees, seed, groups, k = self.n_trees, self.seed, min(self.n_trees, GROUPS), dims if self.tried == "all" else math.ceil(math.sqrt(dims))

        def grown(key: tuple, part: pa.Table) -> pa.Table:
            codes, own, y = _joined(part["codes"], np.uint8).reshape(-1, dims), _mix(_joined(part["key"], np.uint64)), _joined(part["y"], np.uint8)
            # a tree must not depend on the order in which blocks arrive: sums are of whole numbers
            draws, names, out = _draws(), range(key[0].as_py(), n_trees, groups), []
            for t in names:
                out.append(grow(codes, _weights(own, t, draws), y, k, np.random.default_rng([seed, t])))
            return pa.table({"g": pa.array([key[0].as_py()] * len(out), pa.int32()), "tree": pa.array(list(names), pa.int32()), **{c: pa.array([o[c].tobytes() for o in out], pa.binary()) for c in _NODES}})

        dealt = blocks.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), "codes", "key", "y")
        trees = cut_lineage(dealt.repartition(4 * groups, "g").groupBy("g").applyInArrow(grown, "g int, tree int, " + ", ".join(f"{c} binary" for c in _NODES)))
        return GrownForestModel(trees, groups, edges, self.seed, self.key, self.features)


class GrownForestModel(Model):
    """Adds `probability` and `prediction`: the mean of the trees' shares."""

    def __init__(self, trees: DataFrame, groups: int, edges: list[list[float]], seed: int, key: list[str], features: str) -> None:
        super().__init__()
        self.trees, self.groups, self.edges, self.seed, self.key, self.features = trees, groups, edges, seed, key, features

    def votes(self, df: DataFrame, left_out: bool = False) -> DataFrame:
        """Adds `p`, the mean share of class 1, of rows that were trained on only by trees that they were left out of (`left_out`); null where there is none."""
        edges, dims, groups = self.edges, len(self.edges), self.groups
        vectors = [f.name for f in df.schema if isinstance(f.dataType, VectorUDT)]
        plain = df.select(*[vector_to_array(c).alias(c) if c in vectors else F.col(c) for c in df.columns])
        kinds = T.StructType([*plain.schema.fields, T.StructField("p", T.DoubleType())])
        named = plain.withColumns({"_v": F.col(self.features), "_key": F.xxhash64(F.lit(self.seed), *self.key), "_y": F.lit(0.0)})
        blocks = cut_lineage(named.mapInArrow(_pack(edges, df.columns), _BLOCK))
        chunks = -(-(blocks.agg(F.sum("n")).first()[0] or 1) // ROWS)

        def voted(key: tuple, asked: pa.Table, trees: pa.Table) -> pa.Table:
            if not asked.num_rows or not trees.num_rows:
                return pa.table({"block": pa.array([], pa.string()), "g": pa.array([], pa.int32()), "total": pa.array([], pa.binary()), "seen": pa.array([], pa.binary())})
            codes, own, draws = _joined(asked["codes"], np.uint8).reshape(-1, dims), _mix(_joined(asked["key"], np.uint64)), _draws()
            total, seen = np.zeros(len(own)), np.zeros(len(own), np.int32)
            for i in np.argsort(trees["tree"].to_numpy()):
                tree = {c: np.frombuffer(trees[c][int(i)].as_py(), kind) for c, kind in _KINDS.items()}
                use = np.flatnonzero(_weights(own, trees["tree"][int(i)].as_py(), draws) == 0) if left_out else np.arange(len(own))
                total[use] += vote(tree, codes[use])
                seen[use] += 1
            ends = np.cumsum(asked["n"].to_numpy())[:-1]
            return pa.table({"block": asked["block"], "g": pa.array([key[1].as_py()] * asked.num_rows, pa.int32()), "total": pa.array([x.tobytes() for x in np.split(total, ends)], pa.binary()),
                             "seen": pa.array([x.tobytes() for x in np.split(seen, ends)], pa.binary())})

        def told(_key: tuple, block: pa.Table, sums: pa.Table) -> pa.Table:
            order = np.argsort(sums["g"].to_numpy())
            total, seen = (sum(np.frombuffer(sums[c][int(i)].as_py(), kind) for i in order) for c, kind in (("total", np.float64), ("seen", np.int32)))
            kept = pa.ipc.open_stream(block["kept"][0].as_py()).read_all()
            return kept.append_column("p", pa.array(total / np.maximum(seen, 1), pa.float64(), mask=seen == 0))

        asked = blocks.select(F.pmod(F.xxhash64("block"), F.lit(chunks)).cast("int").alias("chunk"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), "block", "n", "codes", "key")
        trees = self.trees.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(int(chunks) - 1))))
        spread = min(4 * groups * int(chunks), 4096)
        pairs = asked.repartition(spread, "chunk", "g").groupBy("chunk", "g").cogroup(trees.repartition(spread, "chunk", "g").groupBy("chunk", "g"))
        sums = pairs.applyInArrow(voted, "block string, g int, total binary, seen binary")
        out = blocks.select("block", "kept").groupBy("block").cogroup(sums.groupBy("block")).applyInArrow(told, kinds)
        return out.select(*[array_to_vector(c).alias(c) if c in vectors else F.col(c) for c in df.columns], "p")

    def _transform(self, df: DataFrame) -> DataFrame:
        p = F.col("p")
        return self.votes(df).select(*df.columns, array_to_vector(F.array(1.0 - p, p)).alias("probability"), (p > 0.5).cast("double").alias("prediction"))
