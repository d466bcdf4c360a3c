"""Language-model scoring with a hashed maximum-entropy model.

The next token's class is a softmax over CLASSES, whose scores are sums of weight rows picked by hashed features of the tokens
before it: the words one to four places back (the skips) and the last two together (the n-gram).  The most frequent tokens are
classes of their own; all others share classes by their last letters, and inside a class a word has its smoothed relative
frequency.  So every token has a probability, known or not.

Word counts cover all training text.  The most frequent HEAD words travel with the tasks; all others are met in one join by
hash, and none of those is frequent, so no key is hot.  Training is distributed gradient descent: each task walks its texts in
small batches, each step moves the tables of all features, and rows of weights are averaged over tasks by how often each was
used; then the next round starts from there.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from brindle.llm.common import staged, texts
from brindle.llm.compression_quality import remainder
from brindle.llm.shingles import mix

END = b" "  # no word can be a blank
SINGLE = 64  # classes of one frequent token each
SHARED = 64  # classes by the last letters
CLASSES = SINGLE + SHARED
HEAD = 65_536  # words whose counts travel with the tasks: a few megabytes
NAMED = 4_096  # words that are features under their own name; others stand for their class
FEATURES = 5
BUCKETS = 4_096  # hashed rows of weights for each feature; a power of two
ROUNDS = 2  # each sees its own part of the training documents, all of them once
BATCH = 2_048  # tokens of a gradient step
BLOCK = 512  # tokens scored at once: their scores stay in a core's cache
SHORT = 32  # rows of weights that at most so many tokens of a batch share are summed together
SAFE = 60.0  # scores between minus and plus this need no shift before they are raised
RATE = 0.5
SMOOTH = 0.1

_SEEDS = [np.uint64(0x9E3779B97F4A7C15 * (i + 1) % 2**64) for i in range(FEATURES)]


def words(text: str) -> list[bytes]:
    """Words with A-Z in lower case, then the end."""
    found = text.encode("utf-8", "surrogatepass").lower().split()
    found.append(END)
    return found


def shared_class(word: bytes) -> int:
    return shared_classes([word])[0]


def shared_classes(found: list[bytes]) -> list[int]:
    ends = [w[-3:] if w.isascii() else w.decode("utf-8", "replace")[-3:].encode() for w in found]
    return [SINGLE + k % SHARED for k in map(zlib.crc32, ends)]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a partition's words, sent on whenever many have gathered."""
    seen: Counter = Counter()

    def out() -> pa.RecordBatch:
        keys = list(seen)
        made = pa.RecordBatch.from_arrays([
            pa.array([k.decode("utf-8", "replace") for k in keys], pa.string()), pa.array([xxhash.xxh64_intdigest(k) - (1 << 63) for k in keys], pa.int64()),
            pa.array(shared_classes(keys), pa.int32()), pa.array(list(seen.values()), pa.int64())], ["token", "hash", "class", "n"])
        seen.clear()
        return made

    for batch in batches:
        for t in texts(batch):
            seen.update(words(t))
            if len(seen) > 400_000:
                yield out()
    if seen:
        yield out()


class Lookup:
    """Word to one number: class in 8 bits, place in the head plus one in 17, feature name above."""

    def __init__(self, head: list[tuple[str, int]]) -> None:
        self.fixed: dict[bytes, int] = {}
        named = [token.encode() for token, _ in head]
        for i, (word, k) in enumerate(zip(named, shared_classes(named))):
            name = i + 1 + CLASSES if i < NAMED else k
            self.fixed[word] = (i if i < SINGLE else k) | (i + 1) << 8 | name << 25
        self.logs = np.r_[0.0, np.log10(np.array([c for _, c in head], float) + SMOOTH)] if head else np.zeros(1)

    def numbers(self, found: list[bytes]) -> np.ndarray:
        code = np.fromiter(map(self.fixed.get, found, repeat(-1)), np.int64, len(found))
        outside = np.flatnonzero(code < 0)  # these stand for their class
        k = np.array(shared_classes([found[i] for i in outside.tolist()]), np.int64)
        code[outside] = k | k << 25
        return code


def encode(lookup: Lookup, found: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of the words of several texts, one after another, and for each feature the row it picks."""
    sizes = [len(f) for f in found]
    total = sum(sizes)
    code = lookup.numbers(list(chain.from_iterable(found)))
    name = (code >> 25).astype(np.uint64)
    ends = np.cumsum(sizes)
    place = np.arange(total) - np.repeat(np.r_[0, ends[:-1]], sizes)
    back = []
    for lag in range(1, FEATURES):
        b = np.zeros(total, np.uint64)
        b[lag:] = name[:-lag] * (place[lag:] >= lag)
        back.append(b)
    with np.errstate(over="ignore"):
        keys = [*back, back[0] * np.uint64(1_000_003) + back[1]]
        rows = np.stack([(mix(k * _SEEDS[0] + s) & np.uint64(BUCKETS - 1)).astype(np.int64) + i * BUCKETS for i, (k, s) in enumerate(zip(keys, _SEEDS))])
    return code, rows


def logits(weights: np.ndarray, bias: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Scores of all classes, shifted by their largest where they could leave the range of exp."""
    out = weights.take(rows[0], axis=0)
    for r in rows[1:]:
        out += weights.take(r, axis=0)
    out += bias
    if not (out.max(initial=0.0) < SAFE and out.min(initial=0.0) > -SAFE):
        out -= out.max(axis=1, keepdims=True)
    return out


def class_log10(weights: np.ndarray, bias: np.ndarray, code: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """log10 probability of each token's class."""
    out = np.empty(len(code))
    for a in range(0, len(code), BLOCK):
        x = logits(weights, bias, rows[:, a : a + BLOCK])
        k = (code[a : a + BLOCK] & 255).astype(np.int64)
        own = x[np.arange(len(k)), k].astype(np.float64)
        np.exp(x, out=x)
        out[a : a + BLOCK] = (own - np.log(x.sum(axis=1).astype(np.float64))) / np.log(10)
    return out


def grouped_sums(x: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each distinct key, how many rows of x have it, and their sum; keys run over the rows of x once or several times.

    Keys go by falling count, so the second rows of all short groups are one slice, the third another; a long group is one sum.
    """
    order = np.argsort(keys.astype(np.uint16), kind="stable")  # short keys sort by their digits
    s = keys.take(order)
    order %= len(x)
    new = np.empty(len(s), bool)
    new[:1] = True
    np.not_equal(s[1:], s[:-1], out=new[1:])
    first = np.flatnonzero(new)
    size = np.diff(first, append=len(s))
    by_size = np.argsort(-size, kind="stable")
    first, size = first.take(by_size), size.take(by_size)
    out = x.take(order.take(first), axis=0)
    longer = np.searchsorted(-size, -np.arange(SHORT + 1), side="left")  # how many groups have more rows than 0, 1, …
    long = longer[SHORT]
    for i, (a, n) in enumerate(zip(first[:long].tolist(), size[:long].tolist())):
        np.add.reduce(x.take(order[a : a + n], axis=0), axis=0, out=out[i])
    for r in range(1, SHORT):
        if long < longer[r]:
            out[long : longer[r]] += x.take(order.take(first[long : longer[r]] + r), axis=0)
    return s.take(first), size, out


def gradient_step(weights: np.ndarray, bias: np.ndarray, scale: np.ndarray, used: np.ndarray, code: np.ndarray, rows: np.ndarray) -> None:
    """One step down the log loss of a batch, in place, in the tables of all features.  Each row of weights has its own step length
    from its past gradients."""
    x = np.empty((len(code), CLASSES), np.float32)
    for a in range(0, len(code), BLOCK):
        part = logits(weights, bias, rows[:, a : a + BLOCK])
        np.exp(part, out=part)
        np.multiply(part, 1.0 / part.sum(axis=1, keepdims=True), out=x[a : a + BLOCK])
    x[np.arange(len(code)), code & 255] -= 1
    at, n, g = grouped_sums(x, rows.ravel())  # the rows of different features differ
    scale[at] += np.einsum("ij,ij->i", g, g)
    used[at] += n
    g *= (-RATE / np.sqrt(scale[at] + 1.0)).astype(np.float32)[:, None]
    g += weights.take(at, axis=0)
    weights[at] = g


def _train(head, model, bias: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(head.value)
        weights = model.value.copy()
        scale, used = np.zeros(len(weights)), np.zeros(len(weights), np.int64)
        waiting: list[list[bytes]] = []
        room = 0

        def learn() -> None:
            code, rows = encode(lookup, waiting)
            for a in range(0, len(code), BATCH):
                gradient_step(weights, bias, scale, used, code[a : a + BATCH], rows[:, a : a + BATCH])

        for batch in batches:
            for t in texts(batch):
                waiting.append(words(t))
                room += len(waiting[-1])
                if room > 100_000:
                    learn()
                    waiting, room = [], 0
        if waiting:
            learn()
        at = np.flatnonzero(used)
        for a in range(0, len(at), 4_096):
            part = at[a : a + 4_096]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(used[part], pa.int64()), pa.array([weights[i].tobytes() for i in part], pa.binary())], ["row", "used", "weights"])

    return run


def _average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of weights, in order of row: the mean of each over tasks, weighted by use.  One sum is held at a time."""
    row, total, used = None, None, 0

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([row], pa.int32()), pa.array([(total / used).astype(np.float32).tobytes()], pa.binary())], ["row", "weights"])

    for batch in batches:
        for r, u, w in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            if r != row:
                if row is not None:
                    yield out()
                row, total, used = r, np.zeros(CLASSES), 0
            total += u * np.frombuffer(w, np.float32)
            used += u
    if row is not None:
        yield out()


def _score(head, model, bias: np.ndarray, inside: np.ndarray):
    """For each row: what the tasks can know, and the hashes of the words outside the head."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, weights = Lookup(head.value), model.value
        for batch in batches:
            waiting = texts(batch)
            columns: list[list] = [[], [], [], [], []]
            i = 0
            while i < len(waiting):
                found, room = [], 0  # only a part of the batch is held as words
                while i + len(found) < len(waiting) and room < 100_000:
                    found.append(words(waiting[i + len(found)]))
                    room += len(found[-1])
                i += len(found)
                code, rows = encode(lookup, found)
                logs = class_log10(weights, bias, code, rows)
                k = code & 255
                place = (code >> 8) & 0x1FFFF
                shared = k >= SINGLE
                base = lookup.logs[place]
                model_part = logs + np.where(shared, base - inside[k], 0.0)
                sizes = np.array([len(f) for f in found])
                starts = np.r_[0, np.cumsum(sizes)[:-1]]
                columns[0] += sizes.tolist()
                columns[1] += np.add.reduceat(place > 0, starts, dtype=np.int64).tolist()
                columns[2] += np.add.reduceat(base, starts).tolist()
                columns[3] += np.add.reduceat(model_part, starts).tolist()
                for f, a in zip(found, starts):
                    columns[4].append([xxhash.xxh64_intdigest(f[x]) - (1 << 63) for x in np.flatnonzero(place[a : a + len(f)] == 0)])
            yield pa.RecordBatch.from_arrays([batch.column("k"), batch.column("doc_id"), batch.column("held_out"), *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.int64()))))],
                                             ["k", "doc_id", "held_out", "n_tokens", "known", "base", "model", "rare"])

    return run


def _frequent(counts: DataFrame) -> list[tuple[str, int]]:
    """(word, count) of the most frequent words, HEAD at most, most frequent first.

    A histogram of counts in steps of an eighth of a power of two gives the lowest step down to which they are few enough; only
    those words are fetched.  A sort with a limit would send as many rows from each task.
    """
    step = F.floor(F.log2("n") * 8).cast("int")
    sizes = {r["step"]: r["count"] for r in counts.groupBy(step.alias("step")).count().collect()}
    low, room = None, HEAD
    for s in sorted(sizes, reverse=True):
        room -= sizes[s]
        if room < 0:
            break
        low = s
    if low is None:
        return []
    return sorted(((r["token"], r["n"]) for r in counts.where(step >= low).select("token", "n").collect()), key=lambda x: (-x[1], x[0]))


def score_texts(docs: DataFrame, mod: int = 10, text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each document.

    Learns from documents with crc32(id) mod `mod` not 0.  base_score is the smoothed unigram log10 probability, score the
    model's.  Null text counts as empty: one token, the end.  Without training text all weights are zero.  Rows are numbered as
    they are read, so equal rows and rows that share an id stay apart.
    """
    spark = docs.sparkSession
    sc = spark.sparkContext
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    train = rows.where(remainder("doc_id", mod) != 0)
    counted = train.select("text").mapInArrow(_count, "token string, hash long, class int, n long")
    counts = staged(counted.groupBy("token", "hash", "class").agg(F.sum("n").alias("n")), "counts")
    top = _frequent(counts)
    single = top[:SINGLE]
    by_class = {r["class"]: (r["n"], r["v"]) for r in counts.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()}
    total, distinct = (sum(v[i] for v in by_class.values()) for i in (0, 1))
    own = {k: list(by_class.get(k, (0, 0))) for k in range(SINGLE, CLASSES)}
    for token, n in single:  # a frequent token leaves its shared class
        k = shared_class(token.encode())
        own[k][0] -= n
        own[k][1] -= 1
    inside = np.zeros(CLASSES)
    inside[SINGLE:] = [np.log10(own[k][0] + SMOOTH * (own[k][1] + 1)) for k in range(SINGLE, CLASSES)]
    mass = np.array([n for _, n in single] + [0] * (SINGLE - len(single)) + [own[k][0] for k in range(SINGLE, CLASSES)], float)
    bias = np.log((mass + 1.0) / (mass.sum() + CLASSES)).astype(np.float32)
    head = sc.broadcast(top)
    weights = np.zeros((FEATURES * BUCKETS, CLASSES), np.float32)
    for part in range(ROUNDS):
        model = sc.broadcast(weights)
        own_docs = train.where(F.pmod(F.xxhash64("doc_id"), F.lit(ROUNDS)) == part).select("text")
        made = own_docs.mapInArrow(_train(head, model, bias), "row int, used long, weights binary")
        for r in made.repartition("row").sortWithinPartitions("row").mapInArrow(_average, "row int, weights binary").collect():
            weights[r["row"]] = np.frombuffer(r["weights"], np.float32)
        weights = weights.copy()
    model = sc.broadcast(weights)
    keyed = rows.select(F.monotonically_increasing_id().alias("k"), "doc_id", (remainder("doc_id", mod) == 0).alias("held_out"), "text")
    scored = staged(keyed.mapInArrow(_score(head, model, bias, inside), "k long, doc_id long, held_out boolean, n_tokens long, known long, base double, model double, rare array<long>"), "scores")
    rare = scored.select("k", F.explode("rare").alias("hash")).join(counts.groupBy("hash").agg(F.sum("n").alias("n")), "hash", "left")
    more = rare.groupBy("k").agg(F.count("n").alias("more_known"), F.sum(F.log10(F.coalesce("n", F.lit(0)) + SMOOTH)).alias("more_log"))
    norm = float(np.log10(total + SMOOTH * (distinct + 1)))
    extra = F.coalesce("more_log", F.lit(0.0))
    return scored.join(more, "k", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base") + extra - F.col("n_tokens") * F.lit(norm)).alias("base_score"), (F.col("model") + extra).alias("score"))
