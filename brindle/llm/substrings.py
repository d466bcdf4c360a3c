"""Removal of repeated byte strings across all documents, with suffix arrays.

A window is a string of `length` bytes.  A window is repeated when an equal one starts earlier: in a smaller document or
further left in the same one.  Each byte that a repeated window covers goes.  Three steps, none of them on pairs:

1. Anchors.  Each window names its anchor, the ANCHOR-byte string of smallest hash inside it.  Neighbouring windows mostly
   share theirs, so a document is a list of segments: an anchor and the range of windows that name it.  Equal windows have
   equal anchors.  Copies of a whole segment are found by its hash: the earliest stays, every later one is repeated
   throughout.  They are folded inside each batch first, so thousands of copies cost one row a batch.
2. Suffix arrays.  Only anchors with several different segments are left; the bytes of these segments, once each, are dealt
   out in blocks, sorted in two stages, and adjacent common prefixes show which windows are equal.
3. An anchor with more segments than fit a block has several; their distinct windows then meet by hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from brindle.llm.common import staged, text_of, texts
from brindle.llm.shingles import mix
from brindle.llm.suffixes import SEPARATOR, equal_prefixes, suffix_order
from brindle.llm.suffixes import _words as eight_bytes

ANCHOR = 32  # bytes of an anchor; a power of two
BLOCK_SEGMENTS = 4096  # segments of one anchor that are sorted together
BATCH_BYTES = 4_000_000  # text sorted at once
LAST = (1 << 63) - 1  # the place of rows without an id: after all others

_rng = np.random.default_rng(20240229)
_LETTERS = _rng.integers(0, 2**64, 256, dtype=np.uint64)
_ODD = _rng.integers(0, 2**64, 8, dtype=np.uint64) | np.uint64(1)

PLACE = "k_id long, k_text long, lo int, hi int"  # windows lo..hi of a row


def segments(data: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, last window, anchor hash) of each run of windows that name the same anchor."""
    n = len(data) - length + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 2 + (np.empty(0, np.uint64),)
    with np.errstate(over="ignore"):
        h = _LETTERS[np.frombuffer(data, np.uint8)]
        width, i = 1, 0
        while width < ANCHOR:
            h = h[:-width] * _ODD[i] + h[width:]
            width, i = width * 2, i + 1
        h = mix(h)
    # leftmost of the smallest hashes: the place is the low half of the number compared
    low = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    span, want = 1, length - ANCHOR + 1
    while span * 2 <= want:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < want:
        low = np.minimum(low[: len(low) - (want - span)], low[want - span :])
    at = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    return first, np.r_[first[1:] - 1, n - 1], h[at[first]]


def _rows(kind: int, **columns) -> pa.RecordBatch:
    n = len(columns["k_id"])
    zero = np.zeros(n, np.int64)
    names = [("anchor", np.int64), ("segment", np.int64), ("k_id", np.int64), ("k_text", np.int64), ("lo", np.int32), ("hi", np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(columns.get(c, zero)).astype(t, copy=False)) for c, t in names] + [pa.array(np.full(n, kind, np.int8))],
                                      [c for c, _ in names] + ["kind"])


def _anchors(length: int):
    """Segments of each batch: kind 0, the earliest of equal ones; kind 1, the others, already known to be repeated."""

    def one(ids: list, keys: list, datas: list[bytes]) -> Iterator[pa.RecordBatch]:
        parts = []
        for k_id, k_text, data in zip(ids, keys, datas):
            lo, hi, anchor = segments(data, length)
            if len(lo):
                digest = xxhash.xxh3_64_intdigest
                whole = np.fromiter((digest(data[a : b + length]) for a, b in zip(lo.tolist(), hi.tolist())), np.uint64, len(lo))
                parts.append((anchor.view(np.int64), whole.view(np.int64), np.full(len(lo), k_id, np.int64), np.full(len(lo), k_text, np.int64), lo, hi))
        if not parts:
            return
        anchor, whole, k_id, k_text, lo, hi = map(np.concatenate, zip(*parts))
        by = np.lexsort((lo, k_text, k_id, whole, anchor))
        anchor, whole, k_id, k_text, lo, hi = (x[by] for x in (anchor, whole, k_id, k_text, lo, hi))
        new = np.r_[True, (anchor[1:] != anchor[:-1]) | (whole[1:] != whole[:-1])]
        once = new | np.r_[True, (k_id[1:] != k_id[:-1]) | (k_text[1:] != k_text[:-1]) | (lo[1:] != lo[:-1])]  # a row given twice
        anchor, whole, k_id, k_text, lo, hi, new = (x[once] for x in (anchor, whole, k_id, k_text, lo, hi, new))
        yield _rows(0, anchor=anchor[new], segment=whole[new], k_id=k_id[new], k_text=k_text[new], lo=lo[new], hi=hi[new])
        old = ~new
        if old.any():
            # a salt in place of the anchor spreads them
            yield _rows(1, anchor=mix(whole[old].view(np.uint64) + k_id[old].view(np.uint64)).view(np.int64), k_id=k_id[old], k_text=k_text[old], lo=lo[old], hi=hi[old])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = batch.column("k_id").to_pylist(), batch.column("k_text").to_pylist()
            datas = [t.encode("utf-8", "surrogatepass") for t in texts(batch)]
            begin, room = 0, 0
            for i in range(len(datas) + 1):
                if i == len(datas) or room > 32_000_000:
                    yield from one(ids[begin:i], keys[begin:i], datas[begin:i])
                    begin, room = i, 0
                if i < len(datas):
                    room += len(datas[i])

    return run


def _sieve(block: int):
    """Rows sorted by anchor, segment and place.  Out: kind 1, repeated segments; kind 2, the first of each segment of an anchor
    that has several, with its block in `segment`.  One row is held back between batches, however large a group is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor_now = segment_now = place_now = None
        ordinal = 0  # of the segment within its anchor
        held = None  # the only segment of the anchor so far
        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(7)]
            anchor, segment, k_id, k_text, lo, hi, kind = cols
            known = kind == 1
            if known.any():
                yield _rows(1, k_id=k_id[known], k_text=k_text[known], lo=lo[known], hi=hi[known])
                anchor, segment, k_id, k_text, lo, hi = (x[~known] for x in cols[:6])
            n = len(anchor)
            if not n:
                continue
            new = np.ones(n, bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (segment[1:] != segment[:-1])
            new[0] = not (anchor[0] == anchor_now and segment[0] == segment_now)
            again = np.zeros(n, bool)  # a row given twice is one place
            again[1:] = ~new[1:] & (k_id[1:] == k_id[:-1]) & (k_text[1:] == k_text[:-1]) & (lo[1:] == lo[:-1])
            again[0] = not new[0] and (k_id[0], k_text[0], lo[0]) == place_now
            old = ~new & ~again
            if old.any():
                yield _rows(1, k_id=k_id[old], k_text=k_text[old], lo=lo[old], hi=hi[old])
            f = np.flatnonzero(new)
            if len(f):
                a = anchor[f]
                start = np.ones(len(f), bool)
                start[1:] = a[1:] != a[:-1]
                start[0] = not (a[0] == anchor_now)
                groups = np.flatnonzero(start)
                number = np.arange(len(f)) - np.maximum.accumulate(np.where(start, np.arange(len(f)), 0))
                head = groups[0] if len(groups) else len(f)
                number[:head] = np.arange(head) + ordinal + 1  # goes on with the anchor of the batch before
                more = np.r_[~start[1:], False]  # another segment of the same anchor follows
                emit = (number > 0) | more
                if number[0] > 0 and held is not None:
                    yield held
                    held = None
                last = f[-1]
                if emit.any():
                    g = f[emit]
                    yield _rows(2, anchor=anchor[g], segment=number[emit] // block, k_id=k_id[g], k_text=k_text[g], lo=lo[g], hi=hi[g])
                ordinal = int(number[-1])
                held = None if emit[-1] else _rows(2, anchor=anchor[last : last + 1], segment=[0], k_id=k_id[last : last + 1], k_text=k_text[last : last + 1], lo=lo[last : last + 1], hi=hi[last : last + 1])
            anchor_now, segment_now, place_now = anchor[-1], segment[-1], (k_id[-1], k_text[-1], lo[-1])

    return run


def _cut(length: int):
    """The bytes of the wanted segments of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            room = 0
            for k_id, k_text, t, wanted in zip(batch.column("k_id").to_pylist(), batch.column("k_text").to_pylist(), texts(batch), batch.column("wanted").to_pylist()):
                data = t.encode("utf-8", "surrogatepass")
                for w in wanted:
                    out.append((w["anchor"], w["block"], w["many"], k_id, k_text, w["lo"], w["hi"], data[w["lo"] : w["hi"] + length]))
                    room += length
                if room > 8_000_000:
                    yield _cut_batch(out)
                    out, room = [], 0
            if out:
                yield _cut_batch(out)

    return run


CUT = pa.schema([("anchor", pa.int64()), ("block", pa.int64()), ("many", pa.bool_()), ("k_id", pa.int64()), ("k_text", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()), ("data", pa.binary())])


def _cut_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), CUT.types)], CUT.names)


def repeated_windows(k_id: np.ndarray, k_text: np.ndarray, lo: np.ndarray, datas: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(piece, window, head piece, head window): each window of the pieces beside the earliest one equal to it."""
    sizes = np.array([len(d) for d in datas])
    text = np.frombuffer(bytes([SEPARATOR]).join(datas), np.uint8)
    begin = np.r_[0, np.cumsum(sizes + 1)[:-1]]
    words = eight_bytes(text, length)
    order = suffix_order(text, length, words)
    piece = np.searchsorted(begin, order, side="right") - 1
    offset = order - begin[piece]
    whole = offset + length <= sizes[piece]  # a window ends inside its piece
    order, piece, offset = order[whole], piece[whole], offset[whole]
    same = equal_prefixes(order, words, length)
    group = np.cumsum(np.r_[True, ~same]) - 1 if len(order) else np.empty(0, np.int64)
    window = lo[piece] + offset
    by = np.lexsort((window, k_text[piece], k_id[piece], group))
    piece, window, group = piece[by], window[by], group[by]
    head = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.empty(0, np.int64)
    return piece, window, piece[head][group], window[head][group]


def _sort_blocks(length: int):
    """Blocks of segments, in order of anchor and block.  Out: kind 1, runs of repeated windows; kind 3, the distinct windows of an
    anchor with several blocks, with their hash in `anchor` and `segment`."""

    def solve(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        many = np.array([r[2] for r in rows])
        k_id, k_text, lo = (np.array([r[i] for r in rows], np.int64) for i in (3, 4, 5))
        piece, window, first, first_window = repeated_windows(k_id, k_text, lo, [r[7] for r in rows], length)
        old = (k_id[piece] != k_id[first]) | (k_text[piece] != k_text[first]) | (window != first_window)
        p, w = piece[old], window[old]
        by = np.lexsort((w, p))
        p, w = p[by], w[by]
        if len(p):
            new = np.flatnonzero(np.r_[True, (p[1:] != p[:-1]) | (w[1:] != w[:-1] + 1)])
            end = np.r_[new[1:], len(p)] - 1
            yield _rows(1, k_id=k_id[p[new]], k_text=k_text[p[new]], lo=w[new], hi=w[end])
        own = np.flatnonzero(~old & many[piece])
        if len(own):
            hashes = [xxhash.xxh3_128_digest(rows[p][7][w - lo[p] : w - lo[p] + length]) for p, w in zip(piece[own].tolist(), window[own].tolist())]
            two = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
            yield _rows(3, anchor=two[:, 0], segment=two[:, 1], k_id=k_id[piece[own]], k_text=k_text[piece[own]], lo=window[own], hi=window[own])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        room = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if room > BATCH_BYTES and row[:2] != held[-1][:2]:
                    yield from solve(held)
                    held, room = [], 0
                held.append(row)
                room += len(row[7])
        if held:
            yield from solve(held)

    return run


def _strip(length: int):
    """Each text without the bytes that its repeated windows cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for t, gone in zip(texts(batch), batch.column("gone").to_pylist()):
                data = t.encode("utf-8", "surrogatepass")
                kept, end, spans = [], 0, 0
                for lo, hi in sorted((g["lo"], g["hi"] + length) for g in gone or ()):
                    if not spans or lo > end:
                        kept.append(data[end:lo])
                        spans += 1
                    end = max(end, hi)
                kept.append(data[end:])
                left = b"".join(kept)
                found.append((len(data), len(data) - len(left), spans, hashlib.sha256(left).hexdigest(), left))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(zip(*found), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())))],
                                             ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


STEP = f"anchor long, segment long, {PLACE}, kind byte"


def remove_repeats(docs: DataFrame, length: int = 100, text: str = "text", block: int = BLOCK_SEGMENTS) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256, kept (the bytes left).

    Windows are judged on the input.  Null text counts as empty; texts shorter than `length` bytes keep everything.  Rows
    without an id come after all others; rows that share an id follow the order of a hash of their text, and fully equal rows
    are one document, so they get the same answer.
    """
    if length < 2 * ANCHOR:
        raise ValueError(f"length must be at least {2 * ANCHOR}")
    spark = docs.sparkSession
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("k_id"),
                        F.xxhash64(text_of(text)).alias("k_text"), text_of(text).alias("text"))
    rows = keyed.select("k_id", "k_text", "text").mapInArrow(_anchors(length), STEP)
    found = staged(rows.repartition("anchor").sortWithinPartitions("anchor", "segment", "k_id", "k_text", "lo").mapInArrow(_sieve(block), STEP), "segments")
    firsts = found.where("kind = 2").select("anchor", F.col("segment").alias("block"), "k_id", "k_text", "lo", "hi")
    many = firsts.where("block > 0").select("anchor").distinct().withColumn("many", F.lit(True))
    wanted = firsts.join(many, "anchor", "left").groupBy("k_id", "k_text").agg(
        F.collect_list(F.struct("anchor", "block", F.coalesce("many", F.lit(False)).alias("many"), "lo", "hi")).alias("wanted"))
    pieces = keyed.join(wanted, ["k_id", "k_text"]).select("k_id", "k_text", "text", "wanted").mapInArrow(
        _cut(length), "anchor long, block long, many boolean, k_id long, k_text long, lo int, hi int, data binary")
    sorted_ = staged(pieces.repartition("anchor", "block").sortWithinPartitions("anchor", "block").mapInArrow(_sort_blocks(length), STEP), "sorted")
    apart = sorted_.where("kind = 3")
    place = F.struct("k_id", "k_text", "lo")
    least = apart.groupBy("anchor", "segment").agg(F.min(place).alias("least"))
    late = apart.join(least, ["anchor", "segment"]).where(place > F.col("least"))
    gone = found.where("kind = 1").select("k_id", "k_text", "lo", "hi").union(
        sorted_.where("kind = 1").select("k_id", "k_text", "lo", "hi")).union(late.select("k_id", "k_text", "lo", "hi"))
    lists = gone.groupBy("k_id", "k_text").agg(F.collect_list(F.struct("lo", "hi")).alias("gone"))
    return keyed.join(lists, ["k_id", "k_text"], "left").select("doc_id", "text", "gone").mapInArrow(
        _strip(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
