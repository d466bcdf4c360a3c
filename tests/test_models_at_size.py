"""Models read their inputs once, and narrow."""

import math
import re

import pytest
from pyspark.sql import functions as F

from brindle.operators import models
from brindle.plans import q12_models as q12


def plan(df):
    return df._jdf.queryExecution().analyzed().toString()


@pytest.fixture
def corpus(spark, tmp_path):
    texts = ["Ab cd\n12 cd", "  Ä ß\x0b\x1cx x", "", None, "\n\n", "ONE two 3"] * 20
    langs = ["de", "en", None] * 40
    spark.createDataFrame([(i, t, g) for i, (t, g) in enumerate(zip(texts, langs))], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2) for i in range(0, 120)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_texts_leave_the_rows_before_anything_is_fitted(spark, corpus):
    for part in q12.document_data(spark, corpus):
        assert "text#" not in plan(part)


def test_document_features_by_hand(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    for r in docs.join(q12.document_features(docs).drop("lang"), "doc_id").collect():
        t = r["text"]
        if t is None:
            assert (r["n_words"], r["mean_word"]) == (1.0, 1.0) and r["n_chars"] is None and r["lines"] is None
            continue
        found = [w for w in re.split(r"[ \t\n\x0b\f\r]+", t) if w]
        chars, n = max(len(t), 1), max(len(found), 1)
        assert [r[c] for c in q12.DOC_NUM] == [len(t), n, len(set(found)) / n, chars / n, sum(c.isupper() for c in t) / chars, sum(c in "0123456789" for c in t) / chars, t.count("\n") + 1]


def test_a_report_applies_its_models_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def score(i):
        seen.add(1)
        return i / 10

    scored = spark.range(10).select(F.pmod("id", F.lit(2)).alias("label"), score("id").alias("p"))
    row = models.evaluate_classifier(scored, "label", "m").first()
    assert row["n"] == 10 and seen.value == 10


def test_bootstrap_weight_hashes_a_row_once(spark):
    rows = spark.range(2_000).select(F.col("id").alias("doc_id"))
    weighted = rows.select(models.bootstrap_weight("doc_id", 3).alias("w"), (models.stable_hash("doc_id", seed="tree3") / float(1 << 32)).alias("u"))
    steps = models.poisson_steps()
    assert all(r["w"] == sum(r["u"] >= p for p in steps) for r in weighted.collect())
    assert math.isclose(weighted.agg(F.avg("w")).first()[0], 1.0, abs_tol=0.1)
    # the hash stands outside the function that is called for each step
    inner = plan(rows.select(models.bootstrap_weight("doc_id", 3)))
    assert "md5" not in inner[inner.rindex("lambdafunction(("):]


def test_cells_give_the_least_squares_of_all_indicator_columns(spark):
    import numpy as np
    from pyspark.ml import Pipeline

    rng = np.random.default_rng(1)
    rows = [(float(rng.normal()) if i % 7 else None, "abc"[rng.integers(3)], "xyzuv"[rng.integers(5)], float(rng.normal())) for i in range(300)]
    df = spark.createDataFrame(rows, "a double, g string, h string, label double")
    made = Pipeline(stages=[models.preprocess(["a"], ["g", "h"], scale=False), models.CellRegression(["a_f"], ["g_i", "h_i"])]).fit(df)
    found = np.array([r["prediction"] for r in made.transform(df).select("prediction").collect()])
    fill = next(r["a_f"] for r in made.transform(df.where("a IS NULL")).collect())
    x = np.array([[1.0, fill if a is None else a, *[g == c for c in "abc"], *[h == c for c in "xyzuv"]] for a, g, h, _ in rows], float)
    y = np.array([r[3] for r in rows])
    assert np.allclose(found, x @ np.linalg.lstsq(x, y, rcond=None)[0])
    # a category that is new has no part in the prediction
    assert all(r["prediction"] is not None for r in made.transform(spark.createDataFrame([(0.0, "new", None, 0.0)], df.schema)).collect())


def test_points_have_the_moments_of_the_rows(spark):
    import numpy as np
    from pyspark.ml.functions import array_to_vector

    rng = np.random.default_rng(2)
    v = rng.normal(size=(200, 3)) @ rng.normal(size=(3, 3)) + 5
    df = spark.createDataFrame([(r[:2].tolist(), float(r[2])) for r in v], "f array<double>, label double").select(array_to_vector("f").alias("features"), "label")
    points = models.moment_points(df, "label")
    got = np.array([[*r["features"], r["label"]] for r in points.collect()])
    assert points.agg(F.sum("weight")).first()[0] == pytest.approx(200)
    assert np.allclose(got.mean(axis=0), v.mean(axis=0)) and np.allclose(np.cov(got.T, bias=True), np.cov(v.T, bias=True))
    for kind in ("ridge", "lasso"):
        a = models.penalized(df, "label", kind, 0.3).fit(df).coefficients
        b = models.penalized(points, "label", kind, 0.3, weight="weight").fit(points).coefficients
        assert np.allclose(a.toArray(), b.toArray(), atol=1e-7)
