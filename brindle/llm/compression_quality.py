"""Quality classifier by compression: a zstandard dictionary from good labelled text, one from bad, and the calibrated difference.

Text like the good samples shrinks more with their dictionary.  A text is cut into pieces so that the dictionaries, not the
text's own past, decide; the sizes are added up over the whole text.  The calibration curve also sees how far the text shrinks
at all: where it repeats itself, both dictionaries are idle and their difference says little.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from brindle.llm.common import texts

SAMPLE_DOCS = 1_500  # of each class for the dictionaries, and as many others for the calibration
PIECES_PER_DOC = 8  # that a sampled document gives its dictionary, at most
PIECE = 1_024  # bytes compressed at once
DICTIONARY = 112_640  # bytes of a dictionary
LEVEL = 3


def remainder(doc_id: str, mod: int) -> Column:
    """crc32 of the id as text; null ids count as an empty one."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(mod))


def _pieces(data: bytes, size: int = PIECE) -> list[bytes]:
    return [data[i : i + size] for i in range(0, len(data), size)] or [b""]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A few pieces of each sampled text, evenly spread over it."""
    for batch in batches:
        h, quality, out = [], [], []
        for key, q, t in zip(batch.column("h").to_pylist(), batch.column("quality").to_pylist(), texts(batch)):
            p = _pieces(t.encode("utf-8", "surrogatepass"))
            for i in sorted({j * len(p) // PIECES_PER_DOC for j in range(PIECES_PER_DOC)}):
                h.append(key)
                quality.append(q)
                out.append(p[i])
        yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(quality, pa.int32()), pa.array(out, pa.binary())], ["h", "quality", "piece"])


def build_dictionary(samples: list[bytes], size: int = DICTIONARY) -> bytes:
    """A trained dictionary; of too few samples to train on, their plain bytes."""
    try:
        return zstandard.train_dictionary(min(size, max(256, sum(map(len, samples)) // 8)), samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size]


class Scorer:
    """Normalised difference (bad - good) / (bad + good) of the compressed sizes, and the log of the compressed share."""

    def __init__(self, good: bytes, bad: bytes) -> None:
        self.pack = []
        for raw in (good, bad):
            d = zstandard.ZstdCompressionDict(raw)
            d.precompute_compress(level=LEVEL)
            self.pack.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False).compress)

    def measure(self, text: str) -> tuple[float, float]:
        p = _pieces(text.encode("utf-8", "surrogatepass"))
        good, bad = (sum(len(pack(x)) for x in p) for pack in self.pack)
        return (bad - good) / (bad + good), math.log((good + bad + 8) / (2 * sum(map(len, p)) + 8))


def _measures(good: bytes, bad: bytes, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(good, bad)
        for batch in batches:
            found = [scorer.measure(t) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *(pa.array([f[i] for f in found], pa.float64()) for i in (0, 1))], [*keep, "difference", "share"])

    return run


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Slopes and offset of a logistic curve through (measures, label), by Newton steps with a weak prior on the slopes."""
    middle = np.average(x, axis=0, weights=weight)
    scale = np.sqrt(np.average((x - middle) ** 2, axis=0, weights=weight))
    scale[scale == 0] = 1.0
    a = np.column_stack([(x - middle) / scale, np.ones(len(x))])
    theta, ridge = np.zeros(a.shape[1]), np.diag([1e-2] * x.shape[1] + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ theta, -30, 30)))
        step = np.linalg.solve((a * (weight * p * (1 - p))[:, None]).T @ a + ridge, a.T @ (weight * (y - p)) - ridge @ theta)
        theta = theta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    slopes = theta[:-1] / scale
    return np.r_[slopes, theta[-1] - slopes @ middle]


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, mod: int = 5, text: str = "text") -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: label 1 likelier), predicted (1 if score >= threshold) for each document.

    Learns from labelled documents with crc32(id) mod `mod` not 0: SAMPLE_DOCS of each class by hash for the dictionaries, as
    many others for the calibration, which is weighted back to the classes' shares among all those labels.  Only the text is an
    input of a score.  Null and empty texts get the score of no difference.  Labels other than 0 and 1 and ids with both are left
    out; with one class only, its share is every score.  The sampled ids, and nothing larger, are broadcast.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    known = labels.where("quality in (0, 1) and doc_id is not null").where(remainder("doc_id", mod) != 0).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min("quality").cast("int").alias("quality"), F.max("quality").cast("int").alias("most")).where("quality = most").select("doc_id", "quality", F.xxhash64(F.lit("quality"), "doc_id").alias("h"))
    share = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    flag = (remainder("doc_id", mod) == 0).alias("held_out")
    if len(share) < 2:
        p = float(share.get(1, 0) / sum(share.values())) if share else 0.5
        return docs.select("doc_id", flag, F.lit(p).alias("score"), F.lit(int(p >= threshold)).alias("predicted"))

    def sample(half: int) -> DataFrame:
        own = known.where(F.pmod("h", F.lit(2)) == half)
        parts = [own.where(F.col("quality") == q).orderBy("h", "doc_id").limit(SAMPLE_DOCS) for q in (0, 1)]
        return docs.join(F.broadcast(parts[0].union(parts[1])), "doc_id")

    pieces: dict[int, list] = {0: [], 1: []}
    for r in sample(0).select("h", "quality", "text").mapInArrow(_cut, "h long, quality int, piece binary").collect():
        pieces[r["quality"]].append((r["h"], bytes(r["piece"])))
    bad, good = (build_dictionary([p for _, p in sorted(pieces[q])]) for q in (0, 1))
    rows = sample(1).select("quality", "text").mapInArrow(_measures(good, bad, ["quality"]), "quality int, difference double, share double").collect()
    y, x = np.array([r["quality"] for r in rows], float), np.array([[r["difference"], r["share"]] for r in rows], float)
    if len(set(y.tolist())) == 2:
        by = {q: share[int(q)] / (y == q).sum() for q in (0.0, 1.0)}
        weight = np.array([by[q] for q in y])
        curve = calibrate(x, y, weight * len(y) / weight.sum())
    else:  # too few labels to calibrate on
        curve = np.array([50.0, 0.0, math.log((share[1] + 1) / (share[0] + 1))])
    scored = docs.select("doc_id", flag, "text").mapInArrow(_measures(good, bad, ["doc_id", "held_out"]), "doc_id long, held_out boolean, difference double, share double")
    score = 1.0 / (1.0 + F.exp(-(F.col("difference") * float(curve[0]) + F.col("share") * float(curve[1]) + float(curve[2]))))
    return scored.select("doc_id", "held_out", score.alias("score")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
