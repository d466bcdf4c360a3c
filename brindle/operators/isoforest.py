"""Isolation forest: random cuts on small samples, path lengths for every row."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from brindle.functions.expr import stable_hash

_NODE = "tree int, node int, feature int, cut double, size int"


def path_norm(n):
    """Average path length of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    with np.errstate(divide="ignore", invalid="ignore"):
        c = 2.0 * (np.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n
    return np.where(n > 2, c, np.where(n == 2, 1.0, 0.0))


def _grow(x: np.ndarray, tree: int, depth: int, seed: int) -> list[tuple]:
    """Nodes in heap numbering (children of i are 2i+1 and 2i+2); feature −1 marks a leaf."""
    rng = np.random.default_rng([seed, tree])
    out, todo = [], [(0, np.arange(len(x)), 0)]
    while todo:
        node, rows, level = todo.pop()
        low, high = x[rows].min(axis=0), x[rows].max(axis=0)
        open_ = np.flatnonzero(high > low)
        if level == depth or len(rows) < 2 or len(open_) == 0:
            out.append((tree, node, -1, 0.0, len(rows)))
            continue
        f = int(rng.choice(open_))
        cut = float(rng.uniform(low[f], high[f]))
        out.append((tree, node, f, cut, len(rows)))
        below = x[rows, f] < cut
        todo += [(2 * node + 1, rows[below], level + 1), (2 * node + 2, rows[~below], level + 1)]
    return out


def fit_forest(df: DataFrame, key: str, columns: Sequence[str], trees: int = 200, sample: int = 256, seed: int = 0) -> DataFrame:
    """Node table of the forest, at most trees · 2^(depth+1) rows.

    Rows enter a tree by a hash of their key, about `sample` rows per tree; one task grows one tree.
    """
    n = df.count()
    space = 1 << 31
    keep = min(1.0, 2.0 * trees * sample / max(n, 1))  # candidates for all trees together
    pool = df.where(stable_hash(key, seed=f"pool{seed}") % space < int(keep * space))
    rate = min(1.0, sample / max(n * keep, 1.0))
    member = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.pmod(F.xxhash64(F.col(key), t, F.lit(seed)), F.lit(space)) < int(rate * space))
    drawn = pool.select(F.explode(member).alias("tree"), F.array(*[F.col(c).cast("double") for c in columns]).alias("x"))
    depth = int(np.ceil(np.log2(max(sample, 2))))

    def grow(tree: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(pdf["x"].to_numpy())
        x = x[np.lexsort(x.T[::-1])]  # arrival order must not matter
        return pd.DataFrame(_grow(x, int(tree[0]), depth, seed), columns=["tree", "node", "feature", "cut", "size"])

    return drawn.groupBy("tree").applyInPandas(grow, _NODE)


def score(df: DataFrame, forest: DataFrame, columns: Sequence[str], sample: int = 256, out: str = "score") -> DataFrame:
    """Adds 2^(−mean path / norm): near 1 for rows that are isolated early."""
    nodes = forest.toPandas()  # bounded by the number of trees and their depth
    width = int(nodes["node"].max()) + 1
    order = {t: i for i, t in enumerate(sorted(nodes["tree"].unique()))}
    feature = np.full((len(order), width), -1)
    cut, size = np.zeros((len(order), width)), np.zeros((len(order), width))
    at = (nodes["tree"].map(order).to_numpy(), nodes["node"].to_numpy())
    feature[at], cut[at], size[at] = nodes["feature"], nodes["cut"], nodes["size"]
    norm = path_norm(np.array([max(2.0, size[i, 0]) for i in range(len(order))]))

    @F.pandas_udf("double")
    def path_score(values: pd.Series) -> pd.Series:
        if len(values) == 0:
            return pd.Series(dtype="float64")
        x = np.stack(values.to_numpy())
        rows, total = np.arange(len(x)), np.zeros(len(x))
        for t in range(len(order)):
            node, depth = np.zeros(len(x), dtype=int), np.zeros(len(x))
            while True:
                f = feature[t, node]
                inner = f >= 0
                if not inner.any():
                    break
                right = x[rows, np.maximum(f, 0)] >= cut[t, node]
                node = np.where(inner, 2 * node + 1 + right, node)
                depth += inner
            total += (depth + path_norm(size[t, node])) / norm[t]
        return pd.Series(np.power(2.0, -total / len(order)))

    return df.withColumn(out, path_score(F.array(*[F.col(c).cast("double") for c in columns])))
