"""Truncated singular value decomposition of a symmetric sparse table, by block power iteration.

The matrix stays a table (a, b, n), the thin matrices are columns of a table of one row a token.  A step is one product, a join on b
and a sum by a.  The products of a step are kept beside those of the steps before and made orthogonal to them, by small Gram matrices
that are summed from the tasks' parts and are all that reaches the driver; the best vectors inside all that is kept converge much
faster than those of the last step alone.  When the columns are many they are replaced by the best ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from brindle.operators.metric_cells import matrix
from brindle.sources.scratch import cut_lineage

SPARE = 8  # columns of a step beyond those wanted
STEPS = 6  # steps whose columns are kept


def _start(entries: DataFrame, width: int) -> DataFrame:
    """(token, q): hash values in place of random ones, so runs agree under any partitioning."""
    values = [(F.xxhash64("token", F.lit(j)) % 1_000_003).cast("double") / 1_000_003 for j in range(width)]
    return entries.select(F.col("b").alias("token")).distinct().select("token", F.array(*values).alias("q"))


def _times(entries: DataFrame, thin: DataFrame, width: int) -> DataFrame:
    """(token, y): the product of the sparse table and a thin one; sums combine before the shuffle."""
    met = entries.join(thin.select(F.col("token").alias("b"), "q"), "b")
    sums = met.groupBy(F.col("a").alias("token")).agg(*[F.sum(F.col("n") * F.col("q")[j]).alias(f"y{j}") for j in range(width)])
    return sums.select("token", F.array(*[f"y{j}" for j in range(width)]).alias("y"))


def _gram(rows: DataFrame, left: str, right: str, widths: int | tuple[int, int]) -> np.ndarray:
    """Σ leftᵀ·right over all rows; each task sends one small matrix."""
    rows_, cols = (widths, widths) if isinstance(widths, int) else widths

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((rows_, cols))
        for b in batches:
            total += matrix(b.column(left), rows_).T @ matrix(b.column(right), cols)
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], names=["g"])

    sent = rows.select(*{left, right}).mapInArrow(part, "g array<double>")
    whole = sent.select(F.posexplode("g").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(rows_ * cols)
    for r in whole:
        out[r["i"]] = r["v"]
    return out.reshape(rows_, cols)


def _each(rows: DataFrame, columns: dict[str, int], made: dict[str, Callable[[dict[str, np.ndarray]], np.ndarray]]) -> DataFrame:
    """Array columns of each row worked out from those named (with their widths), a batch at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = {c: matrix(b.column(c), w) for c, w in columns.items()}
            yield pa.RecordBatch.from_arrays([b.column("token"), *(pa.array(list(f(x)), pa.list_(pa.float64())) for f in made.values())], names=["token", *made])

    return rows.select("token", *columns).mapInArrow(run, ", ".join(["token string", *(f"{c} array<double>" for c in made)]))


def _orthogonal(gram: np.ndarray) -> np.ndarray:
    """The matrix that makes columns of this Gram matrix orthonormal; directions without length are dropped."""
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    keep = values > values.max(initial=0.0) * 1e-13
    return vectors[:, keep] / np.sqrt(values[keep])


def _made_orthonormal(rows: DataFrame, column: str, width: int) -> tuple[DataFrame, int]:
    """(rows, width): twice, for the first time leaves columns of very different length a little askew."""
    for _ in range(2):
        fix = _orthogonal(_gram(rows, column, column, width))
        rows = cut_lineage(_each(rows, {column: width}, {column: lambda x, fix=fix: x[column] @ fix}))
        width = fix.shape[1]
    return rows, width


def truncated_svd(entries: DataFrame, k: int, tolerance: float = 1e-7) -> tuple[np.ndarray, DataFrame]:
    """(singular values, (token, vec)): the k largest, and each token's row of U·Σ.

    `entries` has (a string, b string, n) both ways round.  The sign of a component is such that its value of largest size is positive.
    There are fewer components where the table has a lower rank; an empty table has none.  It ends when what the table makes of each
    vector differs from its multiple by no more than `tolerance` of the largest value, or when a step brings no new direction.
    """
    entries = cut_lineage(entries.select(F.col("a").cast("string").alias("a"), F.col("b").cast("string").alias("b"), F.col("n").cast("double").alias("n")))
    block = k + SPARE
    begun = cut_lineage(_start(entries, block))
    if begun.isEmpty():
        return np.zeros(0), begun.select("token", F.col("q").alias("vec"))
    begun, w = _made_orthonormal(begun, "q", block)
    state, last = cut_lineage(begun.join(_times(entries, begun, w), "token")), w
    while True:
        small, square = _gram(state, "q", "y", w), _gram(state, "y", "y", w)
        values, turn = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(-np.abs(values), kind="stable")
        best, turned = order[:k], turn[:, order[:k]]
        off = np.sqrt(np.maximum(np.einsum("ij,ik,kj->j", turned, square, turned) - values[best] ** 2, 0.0))
        if np.all(off <= tolerance * np.abs(values).max(initial=0.0)):
            break
        if w + last > STEPS * block:
            keep = turn[:, order[:block]]
            state = cut_lineage(_each(state, {"q": w, "y": w}, {c: lambda x, c=c, keep=keep: x[c] @ keep for c in ("q", "y")}))
            w = last = keep.shape[1]
            small = keep.T @ small @ keep
        away = _each(state, {"q": w, "y": w}, {"p": lambda x, m=small[:, w - last :], n=last: x["y"][:, -n:] - x["q"] @ m})
        fresh, width = _made_orthonormal(cut_lineage(away), "p", last)
        both = cut_lineage(state.join(fresh, "token"))
        over = _gram(both, "q", "p", (w, width))
        both = cut_lineage(_each(both, {"q": w, "y": w, "p": width}, {"q": lambda x: x["q"], "y": lambda x: x["y"], "p": lambda x, over=over: x["p"] - x["q"] @ over}))
        fix = _orthogonal(_gram(both, "p", "p", width))
        if not fix.shape[1] or off.max(initial=0.0) == 0:
            break
        fresh = cut_lineage(_each(both, {"p": width}, {"q": lambda x, fix=fix: x["p"] @ fix}))
        width = fix.shape[1]
        more = fresh.join(_times(entries, fresh, width), "token").select("token", F.col("q").alias("q2"), F.col("y").alias("y2"))
        state = cut_lineage(both.join(more, "token").select("token", F.concat("q", "q2").alias("q"), F.concat("y", "y2").alias("y")))
        w, last = w + width, width
    now = np.abs(values[best])
    some = best[now > now.max(initial=0.0) * 1e-10]
    vectors = cut_lineage(_each(state, {"q": w}, {"vec": lambda x, by=turn[:, some] * np.abs(values[some]): x["q"] @ by}))
    n = len(some)
    if not n:
        return np.zeros(0), vectors
    ends = vectors.select(*[F.max_by(F.col("vec")[j], F.struct(F.abs(F.round(F.col("vec")[j], 9)), "token")).alias(f"m{j}") for j in range(n)]).first()
    signs = np.array([1.0 if e is None or e >= 0 else -1.0 for e in ends])
    return np.abs(values[some]), _each(vectors, {"vec": n}, {"vec": lambda x: x["vec"] * signs})
