"""MinHash near-duplicates: SuperMinHash signatures, banding, exact verification, union-find grouping."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from brindle.llm.common import lookup, map_batches, staged, text_of, texts
from brindle.llm.components import UnionFind, components
from brindle.llm import shingles
from brindle.llm.shingles import bands, jaccard_counts, shingle_set, superminhash

SLOTS = 128  # slots of a signature
ROWS = 4  # slots of a band: a link at 0.85 is missed in all 32 bands with probability 6e-11, at 0.8 with 5e-8
BLOCK = 512  # rows of an intersection matrix computed at once
BLOCK_BYTES = 2 << 20  # bytes of sets in a block of a mixed bucket; a task holds two blocks


def _digest(s: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(s.tobytes()) - (1 << 63)


def signatures(docs: DataFrame, k: int, text: str = "text") -> DataFrame:
    """(doc_id, text_hash, n_shingles, class_key, band_keys): class_key is equal for equal sets and null for empty ones."""

    def run(batch: pa.RecordBatch) -> pa.Table:
        sets = [shingle_set(t, k) for t in texts(batch, "text")]
        keys, chunk, room = [], [], 0
        first: dict[int, int] = {}  # an equal set of this batch is signed once
        digests = [_digest(s) if len(s) else None for s in sets]
        todo = [i for i, d in enumerate(digests) if d is not None and first.setdefault(d, i) == i]
        made: dict[int, np.ndarray] = {}
        for i in [*todo, None]:
            if i is None or room > 100_000:
                if chunk:
                    made.update(zip(chunk, bands(superminhash([sets[c] for c in chunk], SLOTS), ROWS).view(np.int64)))
                chunk, room = [], 0
            if i is not None:
                chunk.append(i)
                room += len(sets[i])
        keys = [None if d is None else made[first[d]] for d in digests]
        return pa.table({"doc_id": batch.column("doc_id"), "text_hash": batch.column("text_hash"), "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                         "class_key": pa.array(digests, pa.int64()), "band_keys": pa.array(keys, pa.list_(pa.int64()))})

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of(text)).alias("text_hash"), F.col(text).cast("string").alias("text")), run,
                       "doc_id long, text_hash long, n_shingles long, class_key long, band_keys array<long>", lambda: shingles.forget())


def _sets(docs: DataFrame, wanted: DataFrame, k: int, text: str) -> DataFrame:
    """(node, words): the sorted shingle hashes of each wanted class, from the text of its first document."""

    def run(batch: pa.RecordBatch) -> pa.Table:
        nodes, out = [], []
        for node, t in zip(batch.column("node").to_pylist(), texts(batch)):
            s = shingle_set(t, k)
            if len(s) and _digest(s) == node:  # another row of the same id may hold another text
                nodes.append(node)
                out.append(s.tobytes())
        return pa.table({"node": pa.array(nodes, pa.int64()), "words": pa.array(out, pa.binary())})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of(text)).alias("text_hash"), F.col(text).cast("string").alias("text"))
    rows = rows.join(wanted, rows["doc_id"].eqNullSafe(wanted["first_id"]) & (rows["text_hash"] == wanted["first_hash"]))
    return map_batches(rows.select("node", "text"), run, "node long, words binary", lambda: shingles.forget()).dropDuplicates(["node"])


def _linked(num: int, den: int):
    def run(batch: pa.RecordBatch) -> pa.Table:
        a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
        hits = []
        for i, (x, y) in enumerate(zip(batch.column("wa"), batch.column("wb"))):
            both, either = jaccard_counts(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64))
            if den * both >= num * either:
                hits.append(i)
        return pa.table({"a": pa.array([a[i] for i in hits], pa.int64()), "b": pa.array([b[i] for i in hits], pa.int64())})

    return run


def link_bucket(nodes: np.ndarray, comps: np.ndarray, sets: list[np.ndarray], num: int, den: int, cut: int = 0) -> list[tuple[int, int]]:
    """Links that join different components of one bucket: every pair is decided on full sets, only joining links leave.
    With a cut only pairs of a member before it and one from there on.

    Words that one member alone has cannot be shared, so the intersection counts are products of a small 0/1 matrix, block by block.
    """
    sizes = np.array([len(s) for s in sets])
    _, where, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    column = np.cumsum(seen > 1) - 1
    owner = np.repeat(np.arange(len(sets)), sizes)
    shared = seen[where] > 1
    columns = int((seen > 1).sum())
    union, out = UnionFind(), []
    rows, cols = owner[shared], column[where[shared]]
    at = np.searchsorted(rows, np.arange(len(sets) + 1))

    def dense(lo: int, hi: int, first: int, last: int) -> np.ndarray:
        r, c = rows[at[lo] : at[hi]], cols[at[lo] : at[hi]]
        pick = (c >= first) & (c < last)
        m = np.zeros((hi - lo, last - first), np.float32)
        m[r[pick] - lo, c[pick] - first] = 1
        return m

    end = cut or len(sets)
    for lo in range(cut, len(sets), BLOCK):
        hi = min(lo + BLOCK, len(sets))
        for lo2 in range(0, cut or hi, BLOCK):
            hi2 = min(lo2 + BLOCK, end)
            both = np.zeros((hi - lo, hi2 - lo2), np.float32)
            for first in range(0, columns, 16_384):
                last = min(first + 16_384, columns)
                both += dense(lo, hi, first, last) @ dense(lo2, hi2, first, last).T
            either = sizes[lo:hi, None] + sizes[None, lo2:hi2] - both
            for i, j in np.argwhere((den * both >= num * either) & (comps[lo:hi, None] != comps[None, lo2:hi2])):
                if union.join(int(comps[lo + i]), int(comps[lo2 + j])):
                    out.append((int(nodes[lo + i]), int(nodes[lo2 + j])))
    return out


def block_pairs(left: DataFrame, sets: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(key, one, two, block, node, comp, words): the members of each bucket, once for each pair of blocks they take part in.

    A bucket is cut by hash into as many blocks as it holds block_bytes of sets, so blocks are about that large at any size of the
    bucket; pair (one, two) has the members of both, and each pair of members meets in one of them.
    """
    sizes = sets.select("node", F.octet_length("words").alias("size"))
    blocks = left.join(sizes, "node").groupBy("key").agg(F.ceil(F.sum("size") / block_bytes).cast("int").alias("blocks"))
    placed = left.join(blocks, "key").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    spread = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return spread.select("key", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block", "node", "comp").join(sets, "node")


def _pair_links(num: int, den: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates("node").sort_values(["block", "node"])
        cut, found = 0, []
        if frame["one"].iat[0] != frame["two"].iat[0]:
            cut = int((frame["block"] == frame["one"]).sum())
        if frame["one"].iat[0] == frame["two"].iat[0] or 0 < cut < len(frame):
            found = link_bucket(frame["node"].to_numpy(), frame["comp"].to_numpy(), [np.frombuffer(x, np.uint64) for x in frame["words"]], num, den, cut)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return run


def bucket_links(left: DataFrame, sets: DataFrame, num: int, den: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(a, b): links that join components, of all buckets; the pairs of blocks are groups of their own."""
    return block_pairs(left, sets, block_bytes).groupBy("key", "one", "two").applyInPandas(_pair_links(num, den), "a long, b long")


def near_duplicate_groups(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, text: str = "text", nulls: bool = True) -> DataFrame:
    """(doc_id, text_hash, n_shingles, group, first_id) of each row; `group` is null for rows without words, which are alone.

    `first_id` is the group's smallest doc_id, null where none of its rows has one.  Without `nulls` rows without a doc_id take no part.

    * Documents with equal sets form one class first, so thousands of copies cost one row.
    * Classes that share a band of their SuperMinHash signature are candidates.  Each bucket links its members to its smallest
      one, checked on full sets; components of these links are found.
    * Buckets that still hold several components are settled on full sets, pairs of blocks of bounded size in tasks of their own;
      only links that join components leave a task, never all pairs.
    """
    rows = staged(signatures(docs, k, text), "signatures")
    takes = F.col("class_key").isNotNull() if nulls else F.col("class_key").isNotNull() & F.col("doc_id").isNotNull()
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash"))
    classes = rows.where(takes).groupBy(F.col("class_key").alias("node")).agg(first.alias("f"), F.first("band_keys").alias("band_keys"), F.count("*").alias("n_rows"))
    classes = staged(classes.select("node", F.col("f.doc_id").alias("first_id"), F.col("f.text_hash").alias("first_hash"), "band_keys", "n_rows"), "classes")
    keys = classes.select("node", F.posexplode("band_keys").alias("band", "key"))
    # the band number is part of the key's hash; a class meets a bucket once
    buckets = keys.groupBy("key").agg(F.min("node").alias("pivot"), F.count("*").alias("n")).where("n > 1")
    members = staged(keys.join(buckets, "key").select("key", "node", "pivot"), "members")
    wanted = members.select("node").distinct().join(classes.select("node", "first_id", "first_hash"), "node")
    sets = staged(_sets(docs, wanted, k, text), "sets")
    star = members.where("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    pairs = star.join(sets.select(F.col("node").alias("b"), F.col("words").alias("wb")), "b").join(
        sets.select(F.col("node").alias("a"), F.col("words").alias("wa")), "a")
    links = staged(map_batches(pairs.select("a", "b", "wa", "wb"), _linked(num, den), "a long, b long"), "links")
    comp = components(links)
    labelled = members.select("key", "node").join(comp, "node", "left").select("key", "node", F.coalesce("comp", "node").alias("comp"))
    labelled = staged(labelled, "labelled")
    mixed = labelled.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
    # a bucket that holds the same classes as another one is settled once
    left = labelled.join(mixed, "key")
    alike = left.groupBy("key").agg(F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("content"), F.count("*").alias("n"))
    once = alike.groupBy("content", "n").agg(F.min("key").alias("key")).select("key")
    more = bucket_links(left.join(once, "key"), sets, num, den)
    comp = components(links.union(staged(more, "joins")))
    ids = comp.join(classes.select("node", "first_id"), "node")
    low = ids.groupBy("comp").agg(F.min("first_id").alias("group_id"))
    named = ids.join(low, "comp").select("node", "comp", "group_id")
    found = classes.select("node", "first_id", "n_rows").join(named, "node", "left").select(
        F.col("node").alias("class_key"), F.coalesce("comp", "node").alias("group"), F.coalesce("group_id", "first_id").alias("first_id"), "n_rows")
    # copies of one text share a class, so frequent classes are looked up without a shuffle; rows without a class meet none
    kinds = rows.select("doc_id", "text_hash", "n_shingles", F.when(takes, F.col("class_key")).alias("class_key"))
    placed = lookup(kinds.where("class_key IS NOT NULL"), staged(found, "groups"), ["class_key"], "n_rows")
    alone = kinds.where("class_key IS NULL").withColumns({"group": F.lit(None).cast("long"), "first_id": F.col("doc_id")})
    return placed.unionByName(alone).select("doc_id", "text_hash", "n_shingles", "group", "first_id")


def near_duplicates(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable over links), kept,
    text_hash (of the text, to tell rows that share an id apart).

    Two documents are linked when den * |A ∩ B| >= num * |A ∪ B| for their sets of distinct k-word shingles (A-Z in lower case).

    Null or empty text, or text without words: an empty set, alone.  Null doc_id: takes no part; component_id null and kept.
    Rows that share a doc_id are told apart by their sets; equal rows all carry the same answer.  Texts of any length pass whole.
    """
    found = near_duplicate_groups(docs, k, num, den, text, nulls=False)
    component = F.when(F.col("doc_id").isNotNull(), F.col("first_id")).alias("component_id")
    return found.select("doc_id", "n_shingles", component, "text_hash").withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row of each group of near-duplicates, with all its columns.

    It is the one with the smallest doc_id (rows without one come last), then the smallest hash of the text; of several rows that
    agree in both the least by all columns.  Rows without words stay.
    """
    groups = near_duplicate_groups(docs, k, num, den).where("group IS NOT NULL")
    keys = staged(groups.groupBy("doc_id", "text_hash", "group").agg(F.count("*").alias("copies")), "copies")
    best = keys.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("best"), F.count("*").alias("n"))
    judged = lookup(keys, best, ["group"], "n")
    stays = F.col("best.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("best.text_hash") == F.col("text_hash"))
    judged = staged(judged.select(F.col("doc_id").alias("j_id"), F.col("text_hash").alias("j_hash"), stays.alias("stays"), "copies"), "judged")
    same = docs["doc_id"].eqNullSafe(F.col("j_id")) & (F.xxhash64(text_of()) == F.col("j_hash"))
    rest = docs.join(judged.where("NOT stays OR copies > 1"), same, "left_anti")
    # equal keys are few kinds; each is one row after the partial aggregation
    many = docs.join(judged.where("stays AND copies > 1").select("j_id", "j_hash"), same, "left_semi")
    one = many.groupBy("doc_id", F.xxhash64(text_of()).alias("_h")).agg(F.min(F.struct(*docs.columns)).alias("_r")).select("_r.*")
    return rest.unionByName(one)
