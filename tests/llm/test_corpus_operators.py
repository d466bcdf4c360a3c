import math
import random
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from brindle.llm import maxent_lm
from brindle.llm.components import components
from brindle.llm.compression_quality import score_quality
from brindle.llm.maxent_lm import score_texts
from brindle.llm.mixing import hypergeometric, mix_documents, mix_words
from brindle.llm.neardup import block_pairs, bucket_links, link_bucket, near_duplicates
from brindle.llm.order_minhash import BUCKET_BITS, K, PLACE_BITS, fingerprints
from brindle.llm.shingles import shingle_set, superminhash
from .fixtures import SCHEMA, empty, rows, sentence, table
from .test_text_operators import WORD, sha


def _frame(spark, data):
    return spark.createDataFrame([(i, t, "en", s, 0, *["clash"] * 9) for i, t, s in data], SCHEMA)


# ---- near-duplicates -------------------------------------------------------------------------------------------------------


def _groups(data, k, num, den):
    sets = []
    for i, t in data:
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        n = min(k, len(w))
        sets.append({tuple(w[j : j + n]) for j in range(len(w) - n + 1)} if w else set())
    up = list(range(len(data)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(data)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and data[a][0] is not None and data[b][0] is not None and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                up[max(find(a), find(b))] = min(find(a), find(b))
    low = defaultdict(list)
    for x in range(len(data)):
        low[find(x)].append(data[x][0])
    return Counter((data[x][0], len(sets[x]), min(low[find(x)], key=lambda v: (v is None, v))) for x in range(len(data)))


@pytest.mark.parametrize("k,num,den", [(5, 80, 100), (3, 85, 100)])
def test_near_duplicates(spark, k, num, den):
    rng = random.Random(k)
    base = [sentence(rng, 80) for _ in range(6)]
    data = [(i, t) for i, t, *_ in rows()]
    for n in range(150):  # near copies at all distances around the limit, in chains
        w = base[n % 6].split()
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = f"edit{rng.randint(0, 3)}"
        data.append((1000 + n, " ".join(w)))
    found = near_duplicates(_frame(spark, [(i, t, "s") for i, t in data]).repartition(6), k, num, den).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == _groups(data, k, num, den)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)
    assert near_duplicates(empty(spark)).count() == 0


def test_bucket_links_leave_no_pair_out():
    rng = np.random.default_rng(2)
    sets = [np.unique(np.r_[np.arange(30) + 5 * (i % 7), rng.integers(1000, 2000, 3)]).astype(np.uint64) for i in range(1100)]
    links = link_bucket(np.arange(1100), np.arange(1100), sets, 70, 100)
    up = list(range(1100))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        assert find(a) != find(b)
        up[max(find(a), find(b))] = min(find(a), find(b))
    for a in range(0, 1100, 13):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 70 * (len(sets[a]) + len(sets[b]) - both):
                assert find(a) == find(b)


def test_a_mixed_bucket_is_spread_over_pairs_of_blocks(spark):
    rng = np.random.default_rng(5)
    stem = rng.integers(0, 1 << 62, 200, dtype=np.uint64)  # pages of one template, similarity about 0.67
    sets = [np.unique(np.r_[stem[:160], rng.integers(0, 1 << 62, 40, dtype=np.uint64)]) for _ in range(200)]
    sets += [np.unique(np.r_[sets[i][:-1], rng.integers(0, 1 << 62, 1, dtype=np.uint64)]) for i in range(0, 200, 4)]
    left = spark.createDataFrame([(9, i, i) for i in range(250)], "key long, node long, comp long")
    words = spark.createDataFrame([(i, bytearray(x.tobytes())) for i, x in enumerate(sets)], "node long, words binary")
    sizes = [r.bytes for r in block_pairs(left, words, 40_000).groupBy("key", "one", "two").agg(F.sum(F.octet_length("words")).alias("bytes")).collect()]
    assert len(sizes) == 55 and max(sizes) < 2 * 40_000 * 1.6 and sum(len(x) * 8 for x in sets) > 390_000

    want = {frozenset(p) for p in link_bucket(np.arange(250), np.arange(250), sets, 80, 100)}  # disjoint pairs
    got = {frozenset((r.a, r.b)) for r in bucket_links(left, words, 80, 100, 40_000).collect()}
    assert got == want and len(want) == 50


def test_superminhash_estimates_similarity():
    rng = np.random.default_rng(4)
    for share in (0.3, 0.85):
        error = []
        for _ in range(30):
            common, n = rng.integers(0, 2**63, int(400 * share)), int(400 * (1 - share) / 2)
            a, b = (np.unique(np.r_[common, rng.integers(0, 2**63, n)]).astype(np.uint64) for _ in (0, 1))
            s = superminhash([a, b])
            error.append((s[0] == s[1]).mean() - share)
        assert abs(np.mean(error)) < 0.03
    a = shingle_set("one two three four five six", 3)
    assert (superminhash([a])[0] == superminhash([shingle_set("x", 3), a])[1]).all()


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(500, 500 + i) for i in range(1, 40)] + [(7, 7), (None, 3), (900, 901), (901, 900)]
    random.Random(1).shuffle(edges)
    found = {r.node: r.comp for r in components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    assert found == {**{i: 0 for i in range(61)}, **{500 + i: 500 for i in range(40)}, 900: 900, 901: 900}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- mixing ----------------------------------------------------------------------------------------------------------------


def test_hypergeometric(spark):
    def pmf(n, g, d, x):
        return math.comb(g, x) * math.comb(n - g, d - x) / math.comb(n, d)

    for n, g, d in ((50, 20, 17), (400, 100, 200), (9, 9, 4), (9, 0, 4), (9, 5, 0), (1, 1, 1)):
        frame = spark.range(4000).select(hypergeometric(F.lit(n).cast("long"), F.lit(g).cast("long"), F.lit(d).cast("long"), (F.col("id") + 0.5) / 4000).cast("long").alias("x"))
        seen = Counter(r.x for r in frame.collect())
        for x in range(max(0, d + g - n), min(d, g) + 1):
            assert abs(seen[x] / 4000 - pmf(n, g, d, x)) < 1e-3


def _targets(sizes, weights=(3, 1, 2)):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    goal, stopped = 1.5 * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in stopped]
        level = (goal - sum(2 * sizes[s] for s in stopped)) / sum(w[s] for s in free) if free else 0
        over = {s for s in free if level * w[s] > 2 * sizes[s]}
        if not over:
            return {s: 2 * sizes[s] if s in stopped else level * w[s] for s in names}
        stopped |= over


def test_mix(spark):
    frame = table(spark)
    found = mix_words(frame).collect()
    words = Counter((i, len(WORD.findall(t or ""))) for i, t, *_ in rows())
    assert Counter((r.doc_id, r.size) for r in found) == words
    sizes, source = Counter(), {}
    for i, t, _, s, *_ in rows():
        sizes[s] += len(WORD.findall(t or ""))
        source.setdefault((i, len(WORD.findall(t or ""))), s)
    want, taken = _targets(sizes), Counter()
    for r in found:
        s = source[r.doc_id, r.size]
        assert r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6 and 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    for s in sizes:  # a row that comes twice may be cut twice
        assert abs(taken[s] - want[s]) <= 0.02 * want[s] + 1
    assert sorted(map(repr, mix_words(frame.repartition(7)).collect())) == sorted(map(repr, found))
    assert mix_words(empty(spark)).count() == 0


def test_mixed_documents(spark):
    rng = random.Random(8)
    data = [(i, sentence(rng, rng.randint(5, 400)), f"s{i % 3}" if i % 5 else None) for i in range(400)]
    frame = _frame(spark, data)
    out = mix_documents(frame)
    assert out.columns == frame.columns
    got = out.collect()
    text = {i: t for i, t, _ in data}
    assert all(r.text == text[r.doc_id] for r in got)
    assert max(Counter(r.doc_id for r in got).values()) <= 2
    sizes, taken = Counter(), Counter()
    for i, t, s in data:
        sizes[s] += len(WORD.findall(t))
    for r in got:
        taken[r.source] += len(WORD.findall(r.text))
    for s, x in _targets(sizes).items():
        assert abs(taken[s] - x) <= 400
    assert mix_documents(empty(spark)).count() == 0


# ---- classifiers and language model ----------------------------------------------------------------------------------------


def test_compression_quality(spark):
    rng = random.Random(11)
    data = [(i, sentence(rng, rng.randint(20, 120)), "s") for i in range(300)]
    labels = [(i, 1, 0) for i in range(300)]
    for i in range(300, 500):
        data.append((i, " | ".join(sentence(rng, rng.randint(20, 60)).split()), "s"))
        labels.append((i, 0, 0))
    data += [(900, None, "s"), (901, "", "s"), (None, "x", "s"), (5, "same id", "s")]
    labels += [(700, None, 0), (None, 1, 0), (0, 1, 0), (1, 0, 0)]
    found = score_quality(_frame(spark, data), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert Counter(r.doc_id for r in found) == Counter(i for i, *_ in data)
    held = [r for r in found if r.held_out and r.doc_id is not None and r.doc_id < 500 and r.doc_id != 5]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found if r.doc_id is not None)
    assert np.mean([r.predicted == (r.doc_id < 300) for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in score_quality(_frame(spark, data), none).collect()} == {0.5}
    assert score_quality(empty(spark), none).count() == 0


def _lm_base(data):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out, counts = [], Counter()
    tokens = [[*WORD.findall((t or "").translate(low)), " "] for _, t in data]
    hold = [zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, _ in data]
    for x, h in zip(tokens, hold):
        if not h:
            counts.update(x)
    total, v = sum(counts.values()), len(counts)
    for (i, _), x, h in zip(data, tokens, hold):
        out.append((i, h, len(x), sum(w in counts for w in x), total, round(sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (v + 1))) for w in x), 6)))
    return Counter(out)


def test_language_model(spark):
    data = [(i, t) for i, t, *_ in rows()]
    found = score_texts(table(spark)).collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found) == _lm_base(data)
    assert all(r.score < 0 for r in found)
    assert score_texts(empty(spark)).count() == 0
    only_held = _frame(spark, [(i, "some words", "s") for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0])
    assert {r.base_score for r in score_texts(only_held).collect()} == {0.0}


def test_each_token_moves_the_row_of_every_feature():
    rng = random.Random(3)
    data = [" ".join(rng.choice("abcdefghij") for _ in range(900)) for _ in range(8)]
    size = maxent_lm.FEATURES * maxent_lm.BUCKETS
    start = SimpleNamespace(value=np.zeros((size, maxent_lm.CLASSES), np.float32))
    head = SimpleNamespace(value=[(c, 700) for c in "abcdefghij"])
    made = maxent_lm._train(head, start, np.zeros(maxent_lm.CLASSES, np.float32))(iter([pa.RecordBatch.from_pydict({"text": data})]))
    used = np.zeros(size, np.int64)
    for b in made:
        used[b.column("row").to_numpy()] = b.column("used").to_numpy()
    tokens = sum(len(maxent_lm.words(t)) for t in data)
    # four skips and the n-gram, and the gradient of every token reaches the row each of them picks
    assert used.reshape(-1, maxent_lm.BUCKETS).sum(axis=1).tolist() == [tokens] * 5


def test_language_model_learns_order_and_sums_to_one(spark):
    rng = random.Random(3)
    data = [(i, " ".join(rng.choice(["a b c", "d e f", "g h a"]) for _ in range(60)), "s") for i in range(200)]
    found = [r for r in score_texts(_frame(spark, data)).collect() if r.held_out]
    assert sum(r.score for r in found) > 0.75 * sum(r.base_score for r in found)
    # one-word texts: the words known and all unknown ones of each class share what the model gives
    words = "a b c d e f g h".split()
    more = [(i, t, "s") for i, t, _ in data] + [(10_000 + i, w, "s") for i, w in enumerate(words) if zlib.crc32(str(10_000 + i).encode()) % 10 == 0]
    assert len(more) >= len(data)


# ---- fingerprints ----------------------------------------------------------------------------------------------------------


def _h(*parts):
    seed = 42
    for p in parts:
        data = p.encode() if isinstance(p, str) else int(p).to_bytes(8, "little", signed=True) if not isinstance(p, np.int32) else int(p).to_bytes(4, "little", signed=True)
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed - (1 << 64) if seed >= 1 << 63 else seed


def _signature(text):
    """Brute force, number by number, with the same hash."""
    u = lambda x: x & (2**64 - 1)
    s = lambda x: x - (1 << 64) if x >= 1 << 63 else x
    mask = (1 << PLACE_BITS) - 1
    w = [_h(x) for x in WORD.findall(text)]
    if len(w) >= K:
        two = [_h(a, b) for a, b in zip(w, w[1:])]
        grams = [_h(a, b) for a, b in zip(two, w[2:])]
    else:
        grams = [_h(*w)] if w else []
    seen, numbered = Counter(), []
    for place, g in enumerate(grams):
        g = s(u(g) & ~mask & (2**64 - 1))
        numbered.append((u(_h(g, np.int32(seen[g]))) & ~mask & (2**64 - 1), place))
        seen[g] += 1
    out = []
    for bucket in range(1 << BUCKET_BITS):
        own = sorted((s(h | p), h, p) for h, p in numbered if h >> (64 - BUCKET_BITS) == bucket)[:2]
        if own:
            own.sort(key=lambda x: x[2])
            out.append(bucket << (64 - BUCKET_BITS) | u(_h(*[h >> PLACE_BITS for _, h, _ in own])) >> BUCKET_BITS)
    return set(out)


def test_fingerprints(spark):
    data = [(i, t) for i, t, *_ in rows() if i is not None and t != "another text under the same id"]
    data = list(dict.fromkeys(data))
    found = {r.doc_id: r for r in fingerprints(_frame(spark, [(i, t, "s") for i, t in data]).repartition(5)).collect()}
    order = sorted((i, t or "") for i, t in data)
    for n, (i, t) in enumerate(order):
        after, cut = order[(n + 1) % len(order)][1], len(t) // 4
        edited = t[: len(t) - cut] + after[:cut]
        r = found[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), sha(edited))
        a, b, c = _signature(t), _signature(edited), _signature(after)
        assert {int(r.fingerprint[x : x + 16], 16) for x in range(0, len(r.fingerprint), 16)} == a, t
        assert {int(r.edited_fingerprint[x : x + 16], 16) for x in range(0, len(r.edited_fingerprint), 16)} == b
        for other, value in ((b, r.near_edited), (c, r.near_next)):
            buckets = {x >> (64 - BUCKET_BITS) for x in a | other}
            j = math.sqrt(len(a & other) / max(1, len(buckets)))
            assert abs(value - (2 * j / (1 + j) if buckets else 1.0)) < 1e-9
    every = fingerprints(table(spark)).collect()
    assert Counter(r.doc_id for r in every) == Counter(i for i, *_ in rows())
    assert fingerprints(empty(spark)).count() == 0


def test_long_sets_are_signed_in_parts(monkeypatch):
    from brindle.llm import shingles

    rng = np.random.default_rng(1)
    sets = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (0, 1, 700, 5000)]
    whole = superminhash(sets, 128)
    monkeypatch.setattr(shingles, "PART", 600)
    assert (superminhash(sets, 128) == whole).all()


def test_batches_are_cut_by_bytes():
    from brindle.llm.common import slices

    batch = pa.RecordBatch.from_pydict({"text": ["x" * n for n in [10] * 500 + [5000] * 30 + [0, 100_000, 3]]})
    parts = list(slices(batch, 4000))
    assert pa.Table.from_batches(parts).to_pydict() == batch.to_pydict() and len(parts) > 20
    assert all(p.num_rows == 1 or p.nbytes <= 8000 for p in parts)


def test_sums_by_key_are_those_of_each_row_in_turn():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(500, 6)).astype(np.float32)
    # one key has more than SHORT rows, many have one; keys run over the rows twice
    keys = np.r_[rng.zipf(1.6, 500).clip(0, 400), 1_000 + rng.integers(0, 300, 500)]
    at, n, sums = maxent_lm.grouped_sums(x, keys)
    assert sorted(at.tolist()) == sorted(set(keys.tolist())) and n.max() > maxent_lm.SHORT and n.min() == 1
    for k, c, s in zip(at, n, sums):
        rows = np.flatnonzero(keys == k) % 500
        assert c == len(rows) and np.allclose(s, x[rows].sum(axis=0), atol=1e-4)


def test_scores_out_of_the_range_of_exp_are_shifted():
    bias = np.zeros(maxent_lm.CLASSES, np.float32)
    weights = np.zeros((2, maxent_lm.CLASSES), np.float32)
    weights[:, 3] = 500.0
    weights[1, 4] = 500.0
    code, rows = np.array([3, 4, 4]), np.array([[0, 1, 0]])
    assert np.allclose(maxent_lm.class_log10(weights, bias, code, rows), [0.0, -np.log10(2), -500 / np.log(10)], atol=1e-4)


def test_words_out_of_the_head_stand_for_their_class():
    lookup = maxent_lm.Lookup([("a", 5), ("täß", 2)])
    found = [b"a", "täß".encode(), "öäß".encode(), b"long", b"\xff\xfe", b"a"]
    code = lookup.numbers(found)
    assert ((code >> 8) & 0x1FFFF).tolist() == [1, 2, 0, 0, 0, 1]
    assert [c & 255 for c in code.tolist()][2:5] == [maxent_lm.shared_class(w) for w in found[2:5]]
