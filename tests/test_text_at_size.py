import io
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from brindle.functions.expr import stable_hash
from brindle.operators import lexical_index as lx, retrieval

DOCS = [(i, " ".join(f"w{(i * k) % 11} common" for k in range(1, 4 + i % 5))) for i in range(60)]


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_scores_of_many_pairs_need_no_lookup_of_each(spark, monkeypatch):
    docs = spark.createDataFrame(DOCS, "id int, text string")
    queries = spark.createDataFrame([(i, f"w{i} common w{i + 3} w{i}") for i in range(6)], "q int, text string")
    index = lx.build_index(docs, "id", "text")
    few = sorted(lx.search(index, queries, "q", "text", 5).collect())
    monkeypatch.setattr(lx, "FEW_PAIRS", 0)
    assert sorted(lx.search(index, queries, "q", "text", 5).collect()) == few and len(few) == 30


def test_terms_and_vectors_are_counted_in_place(spark):
    docs = spark.createDataFrame([*DOCS, (3, DOCS[3][1]), (None, "a b a"), (None, "a c d"), (99, None), (98, " ")], "id int, text string")
    words = docs.select(F.col("id").alias("doc"), lx.tokens("text").alias("t")).select("doc", F.size("t").cast("bigint").alias("dl"), F.explode("t").alias("term"))
    want = sorted(map(tuple, words.groupBy("doc", "dl", "term").agg(F.count("*")).collect()), key=str)
    assert sorted(map(tuple, lx.term_counts(docs, "id", "text").collect()), key=str) == want
    once = lx.term_counts(spark.createDataFrame(DOCS, "id int, text string"), "id", "text")
    assert "Exchange" not in plan(once)
    slots = words.select("doc", stable_hash("term", seed="slot", mod=64).alias("s"), (1 - 2 * stable_hash("term", seed="sign", mod=2)).alias("w"))
    sums = {(r.doc, r.s): r.w for r in slots.groupBy("doc", "s").agg(F.sum("w").alias("w")).collect()}
    got = {r.id: r.vec for r in retrieval.hashed_vectors(docs, "id", "text").collect()}
    assert set(got) == {k for k, _ in sums} and all(v == [float(sums.get((k, i), 0)) for i in range(64)] for k, v in got.items())


def test_texts_are_not_exchanged_for_matches(spark):
    docs = spark.createDataFrame(DOCS, "d int, text string")
    passages = spark.createDataFrame([(1, DOCS[7][1]), (2, "no such passage at all here")], "p int, text string")
    found = retrieval.verbatim_matches(docs, passages, "d", "p", "text")
    assert "SortMergeJoin [d#" not in plan(found)
    assert {tuple(r) for r in found.collect()} == {(1, i) for i, t in DOCS if DOCS[7][1] in t}
