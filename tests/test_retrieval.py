import math
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from brindle.operators import chunking, conversations, retrieval, tracking
from brindle.operators.knn import knn_classify, knn_join, visits_and_rows


def texts(spark, rows, schema="id bigint, text string"):
    return spark.createDataFrame(rows, schema)


def test_fixed_chunks(spark):
    got = chunking.chunk_fixed(texts(spark, [(1, "a" * 1500), (2, ""), (3, "xy")]), "text", 700).orderBy("id", "chunk_no").collect()
    assert [(r["id"], r["chunk_no"], len(r["chunk"])) for r in got] == [(1, 0, 700), (1, 1, 700), (1, 2, 100), (3, 0, 2)]


def test_recursive_chunks_keep_limits_and_lose_nothing(spark):
    rng = np.random.default_rng(0)
    words = ["".join(rng.choice(list("abcdefgh"), size=rng.integers(2, 12))) for _ in range(2000)]
    prose = "".join(w + (". " if i % 11 == 0 else "\n\n" if i % 97 == 0 else " ") for i, w in enumerate(words))
    docs = [(1, prose), (2, ""), (3, "short"), (4, "z" * 5000), (5, "one. two\n\nthree")]
    got = chunking.chunk_recursive(texts(spark, docs), "text").orderBy("id", "chunk_no").collect()
    by = {i: [r["chunk"] for r in got if r["id"] == i] for i in range(1, 6)}
    assert all(len(c) <= 700 for cs in by.values() for c in cs)
    assert by[2] == [] and by[3] == ["short"] and by[5] == ["one. two\n\nthree"]
    known = {w for w in words} | {w + "." for w in words}
    assert all(set(c.split()) <= known | {"."} for c in by[1])  # cuts fall between words only
    assert set(words) <= set(" ".join(by[1]).replace(".", " ").split())
    assert all(a[-120:] == b[:120] for a, b in zip(by[4], by[4][1:]))  # neighbours overlap
    assert len(by[4]) == math.ceil((5000 - 120) / 580) and all(len(c) == 700 for c in by[4][:-1])


def test_point_ids_are_name_based_uuids(spark):
    got = texts(spark, [(1, "envío#1"), (2, "abc")]).select("text", chunking.point_id(F.col("text")).alias("p")).collect()
    assert all(r["p"] == str(uuid.uuid5(uuid.NAMESPACE_URL, r["text"])) for r in got)


def bm25_plain(docs, query):
    toks = {i: t.lower().split() for i, t in docs}
    n, avg = len(docs), np.mean([len(t) for t in toks.values()])
    df = {w: sum(w in t for t in toks.values()) for w in {w for t in toks.values() for w in t}}
    idf = {w: math.log(n - c + 0.5) - math.log(c + 0.5) for w, c in df.items()}
    floor = 0.25 * np.mean(list(idf.values()))
    idf = {w: floor if v < 0 else v for w, v in idf.items()}
    out = {i: sum(idf.get(w, 0) * t.count(w) * 2.5 / (t.count(w) + 1.5 * (0.25 + 0.75 * len(t) / avg)) for w in query.lower().split()) for i, t in toks.items()}
    return [(i, s) for i, s in sorted(out.items(), key=lambda x: (-round(x[1], 8), x[0])) if s > 0]


def test_bm25_matches_the_formula(spark):
    docs = [(1, "the cat sat the mat"), (2, "the dog sat"), (3, "the bird"), (4, "The CAT and the cat"), (5, "the mat"), (6, "the mat")]
    queries = {10: "cat the", 11: "absent", 12: "", 13: "mat mat"}
    got = retrieval.bm25_topk(texts(spark, docs).withColumnRenamed("id", "doc"), texts(spark, list(queries.items())).withColumnRenamed("id", "q"), "doc", "q", "text", k=10)
    for q, text in queries.items():
        rows = got.where(F.col("q") == q).orderBy("rank").collect()
        want = bm25_plain(docs, text)
        assert [r["doc"] for r in rows] == [i for i, _ in want]
        assert [r["score"] for r in rows] == pytest.approx([s for _, s in want], abs=1e-7)


def vectors(spark, n, name, seed=0, payload=False):
    rng = np.random.default_rng(seed)
    data = [(i, list(map(float, rng.normal(size=6))), float(i % 3)) for i in range(n)]
    df = spark.createDataFrame(data, f"{name} bigint, vec array<double>, payload double")
    return (df if payload else df.drop("payload")), np.array([d[1] for d in data])


@pytest.mark.parametrize("sizes", [{}, {"cell_rows": 6}, {"cell_rows": 6, "block_bytes": 300}, {"block_bytes": 400}])
@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
def test_block_join_is_exact(spark, metric, sizes):
    q, qm = vectors(spark, 23, "qid", 1)
    x, xm = vectors(spark, 57, "id", 2, payload=True)
    got = knn_join(q, x, 4, metric, **sizes).collect()
    if metric == "cosine":
        score = -(qm @ xm.T) / np.linalg.norm(qm, axis=1)[:, None] / np.linalg.norm(xm, axis=1)[None, :]
    else:
        score = np.linalg.norm(qm[:, None] - xm[None], axis=2)
    for i in range(23):
        rows = sorted((r for r in got if r["qid"] == i), key=lambda r: r["rank"])
        assert [r["id"] for r in rows] == list(np.argsort(score[i], kind="stable")[:4])


def _plain_nan(q, x, k, skip=False):
    out = {}
    for i, a in enumerate(q):
        scored = []
        for j, b in enumerate(x):
            both = [(u - v) ** 2 for u, v in zip(a, b) if u == u and v == v]
            if both and not (skip and i == j):
                scored.append((round((sum(both) * len(a) / len(both)) ** 0.5, 12), j))
        out[i] = [j for _, j in sorted(scored)[:k]]
    return out


def _frame(spark, rows, name):
    data = [(i, [None if v != v else float(v) for v in r], 1.0) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, f"{name} bigint, vec array<double>, payload double")


@pytest.mark.parametrize("skip", [False, True])
def test_join_with_gaps_ties_and_copies(spark, skip):
    """Grid points tie everywhere; missing coordinates make cells of their own; a row of nothing but gaps finds nothing."""
    rng = np.random.default_rng(4)
    x = rng.integers(0, 6, (400, 3)).astype(float)
    x[rng.random((400, 3)) < 0.15] = np.nan
    x[7] = x[8] = x[9] = [2, 2, 2]
    q = x if skip else np.vstack([rng.integers(-2, 9, (40, 3)).astype(float), [[np.nan] * 3, [1, np.nan, np.nan]]])
    got = knn_join(_frame(spark, q, "qid").drop("payload"), _frame(spark, x, "id"), 5, "nan_euclidean", skip, cell_rows=20).collect()
    found = {i: [r["id"] for r in sorted((r for r in got if r["qid"] == i), key=lambda r: r["rank"])] for i in range(len(q))}
    assert found == _plain_nan(q, x, 5, skip)


def test_cells_are_skipped(spark):
    """In two dimensions a query visits few of the cells; all rows of a third of the table at one point stay exact."""
    rng = np.random.default_rng(5)
    x = np.vstack([rng.normal(size=(4000, 2)), np.full((2000, 2), 0.25)])
    q, items = _frame(spark, x[:300], "qid").drop("payload"), _frame(spark, x, "id")
    cells, visits, found = visits_and_rows(q, items, 5, "euclidean", cell_rows=100, block_bytes=20_000)
    pairs = sum(int(cells.count[c]) for part in visits for r in part.select("cells").collect() for c in r["cells"])
    assert pairs < 0.45 * len(x) * 300 and cells.count.sum() == len(x)
    got = knn_join(q, items, 5, "euclidean", cell_rows=100, block_bytes=20_000).collect()
    for i in (0, 17, 255):
        d = np.round(np.sqrt(((x - x[i]) ** 2).sum(axis=1)), 12)
        assert [r["id"] for r in sorted((r for r in got if r["qid"] == i), key=lambda r: r["rank"])] == list(np.argsort(d, kind="stable")[:5])


def test_join_with_nothing(spark):
    q, _ = vectors(spark, 3, "qid", 1)
    x, _ = vectors(spark, 3, "id", 2, payload=True)
    assert knn_join(q, x.where("id < 0"), 2).count() == 0 and knn_join(q.where("qid < 0"), x, 2).count() == 0
    assert knn_join(q.withColumn("vec", F.lit(None).cast("array<double>")), x, 2).count() == 0


def test_dense_search_edges(spark):
    items = spark.createDataFrame([(1, [1.0, 0.0], "a"), (2, [0.0, 0.0], "a"), (3, [2.0, 0.0], "b")], "id bigint, vec array<double>, kind string")
    asked = spark.createDataFrame([(9, [1.0, 0.0])], "q bigint, vec array<double>")
    rows = retrieval.dense_topk(items, asked, "id", "q", "vec", 10).orderBy("rank").collect()
    assert [(r["id"], r["score"]) for r in rows] == [(1, 1.0), (3, 1.0)]  # the zero vector has no direction
    assert [r["id"] for r in retrieval.dense_topk(items, asked, "id", "q", "vec", 10, where=F.col("kind") == "b").collect()] == [3]


def test_knn_vote(spark):
    train = spark.createDataFrame([(1, [0.0], 0), (2, [0.1], 0), (3, [5.0], 1), (4, [5.1], 1)], "id bigint, vec array<double>, payload int")
    test = spark.createDataFrame([(7, [0.2]), (8, [5.2]), (9, [2.55])], "qid bigint, vec array<double>")
    assert {r["qid"]: r["predicted"] for r in knn_classify(train, test, 3).collect()}.items() >= {7: 0, 8: 1}.items()
    assert {r["qid"]: r["predicted"] for r in knn_classify(train, test, 4).collect()}[9] == 0  # tie → smallest


def test_fusion_ranks_from_zero(spark):
    a = spark.createDataFrame([(1, 10, 0), (1, 11, 1)], "q bigint, d bigint, rank int")
    b = spark.createDataFrame([(1, 11, 0), (1, 12, 1)], "q bigint, d bigint, rank int")
    rows = retrieval.rrf_fuse([a, b], "q", "d", 3).orderBy("rank").collect()
    assert [r["d"] for r in rows] == [11, 10, 12]
    assert rows[0]["score"] == pytest.approx(1 / 60 + 1 / 61) and rows[1]["score"] == pytest.approx(1 / 60)


def test_worked_retrieval_example(spark):
    """First relevant at rank 1, at rank 3, and none at all: hit rate .67 and mean reciprocal rank .44 at 3."""
    queries = spark.createDataFrame([(1,), (2,), (3,)], "q bigint")
    results = spark.createDataFrame([("m", q, r, rank) for q, refs in ((1, "abc"), (2, "xyb"), (3, "xyz")) for rank, r in enumerate(refs)], "mode string, q bigint, ref string, rank int")
    accepted = spark.createDataFrame([(1, "a"), (2, "b"), (2, "bb"), (3, "q")], "q bigint, prefix string")
    marked = retrieval.mark_relevant(results, accepted, "q")
    row = retrieval.hit_rate_mrr(marked, queries, "q", [3]).first()
    assert (round(row["hit_rate"], 2), round(row["mrr"], 2)) == (0.67, 0.44)
    detail = {r["q"]: (r["first_rank"], round(r["reciprocal"], 2)) for r in retrieval.query_detail(marked, queries, "q", 3).collect()}
    assert detail == {1: (1, 1.0), 2: (3, 0.33), 3: (None, 0.0)}


def test_context_block(spark):
    rows = spark.createDataFrame([(1, 1, "b.md", "two", None), (1, 0, "a.md", "one", None), (1, 2, "", "", "photo of a bike")], "q bigint, rank int, origin string, text string, caption string")
    assert retrieval.build_context(rows, "q").first()["context"] == "[1] (source: a.md)\none\n\n[2] (source: b.md)\ntwo\n\n[3] (photo of a bike)"


def test_verbatim_matches_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(6)]
    docs = [(i, " ".join(rng.choice(words, size=40))) for i in range(40)]
    passages = [(i, " ".join(docs[i][1].split()[5 : 5 + 9])) for i in range(10)] + [(99, "never said like this at all w1 w2")]
    got = retrieval.verbatim_matches(texts(spark, docs).withColumnRenamed("id", "d"), texts(spark, passages).withColumnRenamed("id", "p"), "d", "p", "text")
    assert {(r["p"], r["d"]) for r in got.collect()} == {(p, d) for p, pt in passages for d, t in docs if pt in t}


def test_threads_are_isolated_and_stretches_join_up(spark):
    rows = [(c, t, "user", "x" * (t % 5)) for c in (1, 2) for t in range(30)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(5)
    for width in (4, 4096):
        out = conversations.running_by_stretch(df, "conv_id", F.col("turn"), {"n": F.lit(1).cast("bigint"), "c": F.length("text").cast("bigint")}, width)
        assert all(r["n"] == r["turn"] + 1 and r["c"] == sum(i % 5 for i in range(r["turn"] + 1)) for r in out.collect())
        back = conversations.running_by_stretch(df, "conv_id", -F.col("turn"), {"c": F.length("text").cast("bigint")}, width)
        assert all(r["c"] == sum(i % 5 for i in range(r["turn"], 30)) for r in back.collect())
    assert conversations.context_budget(df, 8).groupBy("conv_id").count().first()["count"] == 2


def test_tracking_tables(spark):
    runs = tracking.run_rows(spark.createDataFrame([("a", 2.0), ("b", 1.0)], "model string, rmse double"), "e", ["model"], ["rmse"])
    assert tracking.best_run(runs, "rmse").first()["params"]["model"] == "b"
    assert tracking.best_run(runs, "rmse", "max").first()["params"]["model"] == "a"
    assert tracking.best_run(runs, "absent").count() == 0
    reg = spark.createDataFrame([("m", "r1", 1)], "name string, run_id string, version int")
    new = tracking.register_versions(reg, spark.createDataFrame([("m", "r2"), ("n", "r3")], "name string, run_id string"))
    assert {r["name"]: r["version"] for r in new.collect()} == {"m": 2, "n": 1}
