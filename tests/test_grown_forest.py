"""Forests whose trees are grown to the end."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from brindle.operators import grown_forest as gf, models
from brindle.plans import q12_models as q12


def gini_gain(y, w, left):
    def impurity(m):
        p = np.average(y[m], weights=w[m])
        return w[m].sum() * p * (1 - p)

    return impurity(w > 0) - impurity((w > 0) & left) - impurity((w > 0) & ~left)


def test_root_is_the_best_split_and_leaves_are_pure():
    rng = np.random.default_rng(1)
    codes = np.stack([rng.permutation(200), rng.integers(0, 6, 200), np.zeros(200, int)], axis=1).astype(np.uint8)
    y, w = rng.integers(0, 2, 200), rng.poisson(1.0, 200)
    tree = gf.grow(codes, w, y, 3, np.random.default_rng(0))
    tried = [gini_gain(y, w, codes[:, f] <= b) for f in (0, 1) for b in range(256) if 0 < w[codes[:, f] <= b].sum() < w.sum()]
    assert gini_gain(y, w, codes[:, tree["feature"][0]] <= tree["cut"][0]) == pytest.approx(max(tried))
    assert (gf.vote(tree, codes)[w > 0] == y[w > 0]).all()
    # a feature that cannot part the rows does not end a branch
    assert (gf.vote(gf.grow(codes, w, y, 1, np.random.default_rng(0)), codes)[w > 0] == y[w > 0]).all()


def test_rows_that_are_alike_share_a_leaf():
    tree = gf.grow(np.zeros((4, 2), np.uint8), np.array([1, 2, 1, 0]), np.array([1, 0, 0, 1]), 1, np.random.default_rng(0))
    assert tree["left"].tolist() == [0] and tree["mean"].tolist() == [0.25]
    pure = gf.grow(np.arange(4, dtype=np.uint8).reshape(-1, 1), np.ones(4, int), np.ones(4, int), 1, np.random.default_rng(0))
    assert pure["mean"].tolist() == [1.0]


def rows(spark, n=400):
    rng = np.random.default_rng(2)
    made = [(i, rng.normal(size=3).tolist(), float(i % 7 < 3)) for i in range(n)]
    return spark.createDataFrame(made, "id long, f array<double>, label double").select("id", array_to_vector("f").alias("features"), "label")


def test_out_of_bag_votes_are_those_of_trees_without_the_row(spark):
    df = rows(spark)
    model, oob = models.bagged_trees(df.repartition(3), "id", "label", 12)
    got = {r["id"]: r["p"] for r in oob.collect()}
    again = models.bagged_trees(df.repartition(5, "label"), "id", "label", 12)[1]
    assert got == {r["id"]: r["p"] for r in again.collect()} and len(got) == 400
    held = df.select("id", "features", F.xxhash64(F.lit(0), "id").alias("key")).collect()
    codes = np.array([[np.searchsorted(e, r["features"][i], side="left") for i, e in enumerate(model.edges)] for r in held], np.uint8)
    key = gf._mix(np.array([r["key"] for r in held], np.int64).view(np.uint64))
    total, seen = np.zeros(400), np.zeros(400)
    for r in model.trees.collect():
        out = gf._weights(key, r["tree"], gf._draws()) == 0
        tree = {c: np.frombuffer(r[c], k) for c, k in gf._KINDS.items()}
        total[out] += gf.vote(tree, codes[out])
        seen[out] += 1
    assert model.trees.count() == 12 and 3 < seen.mean() < 6
    for r, t, s in zip(held, total, seen):
        assert got[r["id"]] == (pytest.approx(t / s) if s else None)


def test_votes_do_not_depend_on_how_rows_are_scored_together(spark, monkeypatch):
    df = rows(spark, 100)
    model = gf.GrownForest(8, "sqrt", key=["id"]).fit(df)
    once = {r["id"]: r["probability"] for r in model.transform(df).collect()}
    monkeypatch.setattr(gf, "ROWS", 30)
    assert once == {r["id"]: r["probability"] for r in model.transform(df.repartition(7)).collect()}
    assert model.transform(df.where("id < 0")).count() == 0


def test_other_labels_are_errors(spark):
    for bad, match in (("CAST(NULL AS DOUBLE)", "Labels MUST NOT"), ("2.0", "labels must be 0 or 1")):
        with pytest.raises(Exception, match=match):
            gf.GrownForest(2, "all", key=["id"]).fit(rows(spark, 20).withColumn("label", F.expr(bad)))


def test_forest_learns_what_trees_of_five_levels_cannot_and_has_a_regressor(spark, tmp_path):
    """Labels change 40 times along the length of a text; the forest used to end at depth five and the regressor was missing."""
    n = 1_200
    spark.createDataFrame([(i, "ab " * (1 + i % 200), "en") for i in range(n)], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, (i % 200) // 5 % 2) for i in range(n)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    item = "l_orderkey long, l_linenumber long, l_partkey long, l_quantity double, l_extendedprice double, l_discount double, l_tax double"
    spark.createDataFrame([(i, 1, i % 20, float(1 + i % 50), (1 + i % 50) * (100.0 + i % 20), 0.01 * (i % 7), 0.02) for i in range(600)], item).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(i, i % 10, 100.0 + i, "B", "T") for i in range(20)], "p_partkey long, p_size int, p_retailprice double, p_brand string, p_type string").write.parquet(f"{tmp_path}/part.parquet")
    found = {r["model"]: r for r in q12.random_forest(spark, str(tmp_path)).collect()}
    assert found["forest"]["accuracy"] > 0.95 and found["forest"]["auc"] > 0.97
    assert found["forest regressor"]["r2"] > 0.9 and found["forest"]["rmse"] is None and found["forest regressor"]["auc"] is None
