import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from brindle.operators import lexical_index as lx


def texts(spark, rows):
    return spark.createDataFrame(rows, "id bigint, text string")


def bm25_plain(docs, query):
    toks = {i: t.lower().split() for i, t in docs}
    n, avg = len(docs), np.mean([len(t) for t in toks.values()])
    vocabulary = {w for t in toks.values() for w in t}
    df = {w: sum(w in set(t) for t in toks.values()) for w in vocabulary}
    idf = {w: math.log((n - c + 0.5) / (c + 0.5)) for w, c in df.items()}
    floor = 0.25 * np.mean(list(idf.values()))
    idf = {w: floor if v < 0 else v for w, v in idf.items()}
    out = {i: sum(idf.get(w, 0) * t.count(w) * 2.5 / (t.count(w) + 1.5 * (0.25 + 0.75 * len(t) / avg)) for w in query.lower().split()) for i, t in toks.items()}
    return [(i, s) for i, s in sorted(out.items(), key=lambda x: (-round(x[1], 8), x[0])) if s > 0]


def corpus(seed=1, n=300):
    """Words of very different frequency, documents of very different length, ties and copies."""
    rng = np.random.default_rng(seed)
    docs = []
    for i in range(n):
        words = [f"w{int(x)}" for x in rng.zipf(1.3, rng.integers(1, 60)) if x < 400]
        docs.append((i, " ".join(["the"] * int(rng.integers(0, 4)) + words)))
    docs += [(n + j, docs[7][1]) for j in range(6)] + [(n + 6, ""), (n + 7, " \n ")]
    return docs


@pytest.fixture(scope="module")
def small_blocks():
    saved = lx.BLOCK, lx.SHARD, lx.LEADING
    lx.BLOCK, lx.SHARD, lx.LEADING = 4, 50, 1
    yield
    lx.BLOCK, lx.SHARD, lx.LEADING = saved


def test_search_is_exact_and_reads_a_part(spark, small_blocks):
    docs = corpus()
    queries = [(i, t) for i, (_, t) in enumerate(docs[::29])] + [(50, "the"), (51, "the w1 w1 w2"), (52, "nothing here"), (53, ""), (54, "w350 the"), (55, docs[7][1])]
    asked = texts(spark, queries).withColumnRenamed("id", "q")
    index = lx.build_index(texts(spark, docs), "id", "text")
    got = lx.search(index, asked, "q", "text", 5).collect()
    for q, text in queries:
        want = [(i, round(s, 6)) for i, s in bm25_plain(docs, text)[:5]]
        assert [(r["doc"], round(r["score"], 6)) for r in sorted((r for r in got if r["q"] == q), key=lambda r: r["rank"])] == want, text
    read, there = lx.postings_read(index, asked, "q", "text", 5)
    assert 0 < read < there


def test_index_is_stored(spark, tmp_path):
    docs = corpus(n=40)
    lx.build_index(texts(spark, docs), "id", "text", str(tmp_path / "index"))
    again = lx.LexicalIndex(spark, str(tmp_path / "index"))
    asked = texts(spark, [(1, docs[3][1])]).withColumnRenamed("id", "q")
    assert [r["doc"] for r in lx.search(again, asked, "q", "text", 3).orderBy("rank").collect()] == [i for i, _ in bm25_plain(docs, docs[3][1])[:3]]
    blocks = again.table("blocks").select("term", "shard", "block", "top", F.transform("rows", lambda r: r["part"]).alias("p")).collect()
    assert all(r["top"] == max(r["p"]) and len(r["p"]) <= lx.BLOCK for r in blocks)
    assert again.table("blocks").agg(F.sum(F.size("rows"))).first()[0] == again.table("postings").count()


def test_nothing_to_find(spark):
    none = texts(spark, [(1, "x")]).where("id < 0")
    assert lx.search(lx.build_index(none, "id", "text"), texts(spark, [(1, "a b")]).withColumnRenamed("id", "q"), "q", "text", 3).count() == 0
    index = lx.build_index(texts(spark, [(1, "a b"), (2, "a")]).unionByName(texts(spark, [(3, "x")]).withColumn("text", F.lit(None).cast("string"))), "id", "text")
    assert lx.search(index, none.withColumnRenamed("id", "q"), "q", "text", 3).count() == 0
    assert [r["doc"] for r in lx.search(index, texts(spark, [(9, "b")]).withColumnRenamed("id", "q"), "q", "text", 3).collect()] == [1]


def test_words_are_the_tokens(spark):
    import pyarrow as pa

    texts = ["", None, " ", "a", "  Ab\tc\x0b\x0cd\r\n", "x\x1cy\x85z w v", "ÄÖ İ ẞ", "a a b ", "\n\n"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", F.lower("t").alias("low"), lx.tokens("t").alias("w")).orderBy("i").collect()
    at, words = lx.words_of(pa.array([r["low"] for r in rows], pa.string()))
    assert [(i, w) for i, w in zip(at.tolist(), words.to_pylist())] == [(r["i"], w) for r in rows for w in r["w"] or []]


def test_an_index_for_known_queries_orders_their_postings_only(spark):
    docs = spark.createDataFrame([(i, f"a b{i % 3} c{i % 7} d{i} x{i % 2}") for i in range(60)], "doc long, text string")
    asked = spark.createDataFrame([(1, "b1 C2 nowhere"), (2, "a d7"), (3, None)], "q long, text string")
    whole, some = lx.build_index(docs, "doc", "text"), lx.build_index(docs, "doc", "text", asked=asked)
    assert {r[0] for r in some.table("blocks").select("term").distinct().collect()} == {"b1", "c2", "a", "d7"}
    found = [sorted(map(tuple, lx.search(x, asked, "q", "text", 5).collect())) for x in (whole, some)]
    assert found[0] == found[1] and len(found[0]) == 10
    assert some.table("terms").count() == whole.table("terms").count()
