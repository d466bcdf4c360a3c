"""Byte-level BPE: encoding by backtracking over longest matches, and decoding.

An Aho-Corasick automaton over the vocabulary, with bytes written as Latin-1 letters, lists every token that starts at each
place of a piece.  The encoder takes the longest one, and a shorter one where it must: a token may follow another only if
merging both their bytes gives back exactly these two tokens.  That compatibility is remembered.  A place from which nothing
compatible goes on is marked and never tried again, so the work stays linear in the length of the piece.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from brindle.llm.common import map_batches, texts

PIECES_KEPT = 500_000  # pieces whose ids a worker remembers
PAIRS_KEPT = 1_000_000  # pairs whose compatibility a worker remembers
LONGEST_KEPT = 64  # characters of a remembered piece


class Codec:
    """Encoder and decoder of one rank file and one piece pattern."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, f))}
        self.bytes_of = {i: token for token, i in self.ranks.items()}
        self.find = regex.compile(pattern).findall
        self.words = ahocorasick.Automaton()
        for token, i in self.ranks.items():
            self.words.add_word(token.decode("latin-1"), (len(token), i))
        self.words.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.pieces = _Pieces(self)

    def merge(self, data: bytes) -> list[int]:
        """The definition: join the adjacent pair of lowest rank, leftmost first, until none can be joined.  Short inputs only."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while True:
            ranked = [(self.ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.ranks]
            if not ranked:
                return [self.ranks[p] for p in parts]
            i = min(ranked)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def compatible(self, a: int, b: int) -> bool:
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= PAIRS_KEPT:
                self.pairs.clear()
            known = self.pairs[a, b] = self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return known

    def encode_piece(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        n = len(data)
        starts: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for end, found in self.words.iter(data.decode("latin-1")):
            starts[end + 1 - found[0]].append(found)  # in ascending length
        dead = bytearray(n + 1)
        out: list[int] = []
        tried: list[int] = []  # for each token taken: its index among those that start there
        at, k = 0, len(starts[0]) - 1
        while at < n:
            choice = starts[at]
            while k >= 0:
                size, token = choice[k]
                if not dead[at + size] and (not out or self.compatible(out[-1], token)):
                    break
                k -= 1
            if k >= 0:
                out.append(token)
                tried.append(k)
                at += size
                k = len(starts[at]) - 1 if at < n else 0
            elif out:
                dead[at] = 1
                at -= len(self.bytes_of[out.pop()])
                k = tried.pop() - 1
            else:
                raise ValueError("the vocabulary lacks a byte of the text")
        return out

    def encode(self, text: str) -> bytes:
        """All ids of a text as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.pieces.__getitem__, self.find(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class _Pieces(dict):
    """Piece of text to the bytes of its ids."""

    def __init__(self, codec: Codec) -> None:
        super().__init__()
        self.codec = codec

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self.codec.encode_piece(piece.encode("utf-8", "surrogatepass")), "<u4").tobytes()
        if len(piece) <= LONGEST_KEPT:
            if len(self) >= PIECES_KEPT:
                self.clear()
            self[piece] = ids
        return ids


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    """One codec for each worker process and vocabulary."""
    return Codec(path, pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str, text: str = "text", keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 for each row, and the ids themselves (binary) if asked for.

    `path` must be readable on every worker.  Null text counts as empty: no tokens, the digests of nothing.  Special tokens
    have no meaning here; their strings are ordinary text.  Rows pass one batch at a time, nothing is shuffled.
    """

    def run(batch: pa.RecordBatch) -> pa.Table:
        code = codec(path, pattern)
        ids = [code.encode(t) for t in texts(batch)]
        columns = {"doc_id": batch.column("doc_id"), "n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()),
                   "ids_sha256": [hashlib.sha256(x).hexdigest() for x in ids],
                   "decoded_sha256": [hashlib.sha256(code.decode(x)).hexdigest() for x in ids]}
        if keep_ids:
            columns["ids"] = pa.array(ids, pa.binary())
        return pa.table(columns)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * keep_ids
    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")), run, schema, lambda: codec(path, pattern).pieces.clear())
