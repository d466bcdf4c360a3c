"""Connected components of an edge table: union-find inside each partition, then star rounds between them."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from brindle.llm.common import staged


class UnionFind:
    """Parents by smallest label, with path halving."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        while (p := up.setdefault(x, x)) != x:
            up[x] = up[p]
            x = p
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    union = UnionFind()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            union.join(a, b)
    pairs = [(x, root) for x in list(union.up) if (root := union.find(x)) != x]
    if pairs:
        big, small = zip(*pairs)
        yield pa.RecordBatch.from_arrays([pa.array(big, pa.int64()), pa.array(small, pa.int64())], ["big", "small"])


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) of every node on an edge (a, b); comp is the smallest node of the component.

    Each partition first shrinks its edges to a spanning forest.  Then large-star and small-star rounds run until the edge
    table no longer changes; only its count and checksum reach the driver.  Null ends and loops are left out.
    """
    forest = edges.where("a <> b").select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).mapInArrow(_forest, "big long, small long")
    now = staged(forest.distinct(), "edges")
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("big", "small").cast("decimal(20,0)")), F.lit(0))).first()
        if mark == seen:
            return now.select(F.col("big").alias("node"), F.col("small").alias("comp")).union(now.select("small", "small")).distinct()
        seen = mark
        both = now.select(F.col("big").alias("u"), F.col("small").alias("v")).union(now.select("small", "big"))
        least = both.groupBy("u").agg(F.min("v").alias("low"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("big"), F.least("u", "low").alias("small")).distinct()
        low = large.groupBy("big").agg(F.min("small").alias("low"))
        small = large.join(low, "big").where("small <> low").select(F.col("small").alias("big"), F.col("low").alias("small")).union(low).distinct()
        now = staged(small, "edges")
