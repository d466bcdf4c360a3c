import numpy as np
import pytest
from pyspark.sql import functions as F

from brindle.operators import embed
from brindle.operators.sparse_svd import truncated_svd


def dense(entries):
    names = sorted({a for a, _, _ in entries})
    at = {t: i for i, t in enumerate(names)}
    m = np.zeros((len(names), len(names)))
    for a, b, n in entries:
        m[at[a], at[b]] += n
    return names, m


def random_entries(n=60, seed=0, rank=None):
    rng = np.random.default_rng(seed)
    m = np.triu(rng.poisson(0.4, (n, n)) * rng.integers(1, 9, (n, n)), 1).astype(float)
    m[0] *= 40  # one token goes with everything
    if rank:
        x = rng.normal(size=(n, rank))
        m = np.triu(x @ x.T)
        return [(f"t{i}", f"t{j}", float((m + m.T)[i, j])) for i in range(n) for j in range(n)]
    m = m + m.T
    return [(f"t{i}", f"t{j}", float(m[i, j])) for i in range(n) for j in range(n) if m[i, j]]


@pytest.mark.parametrize("rank", [None, 3])
def test_svd_equals_numpy(spark, rank):
    entries = random_entries(rank=rank) if rank is None else [e for e in random_entries(20, 1, rank)]
    names, m = dense(entries)
    values, vectors = truncated_svd(spark.createDataFrame(entries, "a string, b string, n double"), 5)
    u, s, _ = np.linalg.svd(m)
    assert values == pytest.approx(s[: len(values)], rel=1e-6) and len(values) == 5
    got = {r["token"]: np.array(r["vec"]) for r in vectors.collect()}
    e = np.array([got[t] for t in names])
    assert np.sqrt((e**2).sum(axis=0)) == pytest.approx(values, rel=1e-6)
    # vectors of well separated values, whatever their sign; the value of largest size is positive
    for j in range(5):
        if s[j] - s[j + 1] > 0.02 * s[0] and (j == 0 or s[j - 1] - s[j] > 0.02 * s[0]):
            assert abs(e[:, j] @ u[:, j]) / s[j] == pytest.approx(1, abs=1e-4)
        assert e[np.abs(e[:, j]).argmax(), j] > 0


def test_svd_of_little(spark):
    none = spark.createDataFrame([], "a string, b string, n double")
    values, vectors = truncated_svd(none, 4)
    assert len(values) == 0 and vectors.count() == 0
    values, vectors = truncated_svd(spark.createDataFrame([("x", "y", 2.0), ("y", "x", 2.0)], "a string, b string, n double"), 4)
    assert values == pytest.approx([2, 2]) and vectors.count() == 2


def test_similar_tokens_and_row_means(spark):
    rows = spark.createDataFrame([(i, ["a=1", f"b={i % 3}", f"c={i % 2}"]) for i in range(30)] + [(99, [])], "id int, tokens array<string>")
    values, vectors = embed.token_vectors(rows, size=3)
    vec = {r["token"]: np.array(r["vec"]) for r in vectors.collect()}
    near = embed.most_similar(vectors, "b=0", 2).collect()
    cos = {t: v @ vec["b=0"] / np.linalg.norm(v) / np.linalg.norm(vec["b=0"]) for t, v in vec.items() if t != "b=0"}
    assert [round(r["similarity"], 6) for r in near] == sorted((round(c, 6) for c in cos.values()), reverse=True)[:2]
    means = {r["id"]: [r[f"w2v_{i}"] for i in range(3)] for r in embed.row_embeddings(rows, vectors, "id", size=3).collect()}
    assert means[4] == pytest.approx(np.mean([vec["a=1"], vec["b=1"], vec["c=0"]], axis=0)) and means[99] == [None] * 3
    assert embed.cooccurrence(rows).where(F.col("a") == "a=1").agg(F.sum("n")).first()[0] == 60
