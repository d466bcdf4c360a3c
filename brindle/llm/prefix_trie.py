"""Prefix trie of rebuilt conversations by fingerprints that compose.

A run of turns has a fingerprint in a monoid: the pair (power, value) of a polynomial over its turns' digests, and the product of two
runs' pairs is the pair of the runs put together.  A rebuilt conversation is a head of another one and a rest of its own; its prefixes'
fingerprints are products of the head's pair and of those of the rest, so no rebuilt text is ever made.  Conversations of one base
pass one after the other as narrow rows (digest, length), head first; what is held is one pair and at most five turns of the head.

Prefixes of equal depth and fingerprint are a node.  That they are equal is then verified from the stored references: all members of
a node must name the same digest (SHA-256) as their last turn and the same parent, which by induction makes all their turns the same.
Should any node fail, the fingerprints are made again with the next multiplier.

Sums over subtrees need no level-by-level walk: a node is counted at its smallest member, that member's later nodes are below it, and
so one running sum along each conversation and one aggregation by node give every subtree's total.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from brindle.llm.common import lookup, staged

PRIME = 2**127 - 1
MULTIPLIERS = (0x5851F42D4C957F2D14057B7EF767814F, 0x2360ED051FC65DA44385DF649FCCF645, 0x369DEA0F31A53F85255EE52F6D96C9D3)
HEADS = 6  # a head has fewer turns than this
Pair = tuple[int, int]
NOTHING: Pair = (1, 0)


def join(a: Pair, b: Pair) -> Pair:
    """The fingerprint of one run followed by another."""
    return a[0] * b[0] % PRIME, (a[1] * b[0] + b[1]) % PRIME


def one_turn(digest: bytes, multiplier: int) -> Pair:
    return multiplier, int.from_bytes(digest[:16], "big") % PRIME + 1


_PREFIXES = pa.schema([("conv_id", pa.int64()), ("depth", pa.int32()), ("node", pa.binary()), ("parent", pa.binary()), ("digest", pa.binary()), ("n", pa.int64()), ("ends", pa.bool_())])


def _prefixes(multiplier: int):
    """Turns of a base's conversations, the base's first, to the prefixes of the rebuilt conversations."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        base, conv, head = object(), object(), []
        whole, h, at, waiting = NOTHING, 0, 0, None

        def mark(pair: Pair) -> bytes:
            return pair[1].to_bytes(16, "big")

        def put(pair: Pair, depth: int, before: Pair, digest: bytes, n: int) -> None:
            """The prefix before is known not to be the last one."""
            nonlocal waiting
            if waiting is not None:
                out.append((*waiting, False))
            waiting = (conv, depth, mark(pair), mark(before), digest, n)

        def end() -> None:
            nonlocal waiting
            if waiting is not None:
                out.append((*waiting, True))
            waiting = None

        def begin(length: int, known: list) -> None:
            """The root and the prefixes inside the head."""
            nonlocal whole, depth, waiting
            waiting = (conv, 0, mark(NOTHING), None, None, 0)
            whole, depth = NOTHING, 0
            for digest, n in known[:length]:
                before, whole, depth = whole, join(whole, one_turn(digest, multiplier)), depth + 1
                put(whole, depth, before, digest, n)

        depth = 0
        for part in batches:
            for b, c, length, digest, n in zip(*(part.column(x).to_pylist() for x in ("base", "conv_id", "h", "digest", "n"))):
                if b != base:
                    base, head = b, []
                if c != conv:
                    end()
                    conv, h, at = c, length, 0
                    if c != b:
                        begin(h, head)
                    else:
                        begin(0, [])
                if c == b and len(head) < HEADS - 1:
                    head.append((digest, n))
                at += 1
                if at > h or c == b:
                    before, whole, depth = whole, join(whole, one_turn(digest, multiplier)), depth + 1
                    put(whole, depth, before, digest, n)
                if len(out) >= 16384:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), _PREFIXES)], schema=_PREFIXES)
                    out = []
        end()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), _PREFIXES)], schema=_PREFIXES)

    return run


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids in order, node by node, to the digest of their list; one id is held at a time."""
    schema = pa.schema([("depth", pa.int32()), ("node", pa.binary()), ("ends_sha256", pa.string())])
    key, digest, out = None, None, []
    for part in batches:
        for depth, node, conv in zip(*(part.column(x).to_pylist() for x in ("depth", "node", "conv_id"))):
            if key != (depth, node):
                if key is not None:
                    out.append((*key, digest.hexdigest()))
                key, digest = (depth, node), hashlib.sha256(str(conv).encode())
            else:
                digest.update(f",{conv}".encode())
            if len(out) >= 16384:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema)
                out = []
    if key is not None:
        out.append((*key, digest.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema)


def rebuilt_prefixes(conversations: DataFrame, multiplier: int = MULTIPLIERS[0]) -> DataFrame:
    """(conv_id, depth, node, parent, digest, n, ends): every prefix of every rebuilt conversation, the empty one included.

    `digest` and `n` are those of its last turn (none at depth 0), `ends` marks the whole conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    conv = F.col("conv_id").cast("bigint")
    turns = conversations.where("conv_id IS NOT NULL").select((conv - conv % 100).alias("base"), conv.alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
                                 (F.crc32(conv.cast("string")) % HEADS).cast("int").alias("h"), digest.alias("digest"), F.length(text).cast("bigint").alias("n"))
    ordered = turns.repartition("base").sortWithinPartitions("base", F.col("conv_id") != F.col("base"), "conv_id", F.asc_nulls_first("turn"), "digest")
    return ordered.select("base", "conv_id", "h", "digest", "n").mapInArrow(_prefixes(multiplier), "conv_id bigint, depth int, node binary, parent binary, digest binary, n bigint, ends boolean")


def prefix_nodes(prefixes: DataFrame) -> DataFrame:
    """(depth, node, parent, conv_id, n_convs, n, sound): prefixes of one depth and fingerprint, and whether all of them are equal."""
    last = F.struct("parent", "digest")
    return prefixes.groupBy("depth", "node").agg(
        F.min("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("n").alias("n"), (F.min(last) == F.max(last)).alias("sound"))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node.

    Turns go by number, null first; turns of one number by a digest of role and text.  A null role or text is empty.  Rows without a
    conv_id belong to no conversation and are left out.  An empty table has no node, not even a root.  Other columns are ignored.
    Texts of any length are digested where they lie.
    """
    for multiplier in MULTIPLIERS:
        prefixes = staged(rebuilt_prefixes(conversations, multiplier), "prefixes")
        nodes = staged(prefix_nodes(prefixes), "nodes")
        if nodes.where("NOT sound").isEmpty():
            break
    else:
        raise ValueError("fingerprints of different prefixes are equal for all multipliers")
    key = ["depth", "node"]
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = staged(nodes.join(children, key, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("bigint"))), "trie")
    # each node counts at its smallest member; keys are unique on both sides
    own = nodes.select("conv_id", "depth", ((F.col("n_convs") - 1) * F.col("n")).alias("w"), (F.col("n_children") == 0).cast("bigint").alias("leaf"))
    below = Window.partitionBy("conv_id").orderBy(F.desc("depth"))
    marked = prefixes.select("conv_id", *key).join(own, ["conv_id", "depth"], "left")
    marked = marked.select(*key, *[F.sum(F.coalesce(c, F.lit(0).cast("bigint"))).over(below).alias(c) for c in ("w", "leaf")])
    sums = marked.groupBy(*key).agg(F.sum("w").alias("saved_tokens"), F.sum("leaf").alias("n_leaves"))
    whole = prefixes.where("ends").select(*key, "conv_id").repartition(*key).sortWithinPartitions(*key, "conv_id").mapInArrow(_ends, "depth int, node binary, ends_sha256 string")
    rest = nodes.join(sums, key).join(whole, key, "left")
    parents = nodes.where("n_children > 0").select((F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("rows"))
    out = lookup(rest, parents, ["depth", "parent"], "rows")
    return out.select("conv_id", F.col("depth").cast("bigint").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
