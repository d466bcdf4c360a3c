import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from brindle.operators import density, isoforest, models


def points(spark, xy):
    return spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(xy)], "id bigint, a double, b double")


def dbscan_plain(xy, eps, min_points):
    d = np.sqrt(((xy[:, None] - xy[None]) ** 2).sum(axis=2)) <= eps
    core = d.sum(axis=1) >= min_points
    label = np.where(core, np.arange(len(xy)), -1)
    while True:
        new = label.copy()
        for i in np.flatnonzero(core):
            new[i] = min(label[j] for j in np.flatnonzero(d[i] & core))
        if (new == label).all():
            break
        label = new
    for i in np.flatnonzero(~core):
        near = np.flatnonzero(d[i] & core)
        label[i] = label[near].min() if len(near) else -1
    return core, label


def moons(n, seed):
    rng = np.random.default_rng(seed)
    t = rng.uniform(0, np.pi, n)
    up = np.column_stack([np.cos(t), np.sin(t)])
    return np.vstack([up, np.column_stack([1 - np.cos(t), 0.5 - np.sin(t)])]) + rng.normal(scale=0.05, size=(2 * n, 2))


@pytest.mark.parametrize("max_pairs", [20_000_000, 5])
def test_dbscan_equals_brute_force(spark, max_pairs):
    """With a tiny pair budget the fine-part comparison has to settle every crowded pair of cells."""
    xy = np.vstack([moons(80, 0), [[3.0, 3.0]], np.repeat([[2.5, 0.0]], 7, axis=0)])
    core, label = dbscan_plain(xy, 0.25, 5)
    got = {r["id"]: (r["core"], r["label"]) for r in density.dbscan(points(spark, xy), "id", ["a", "b"], 0.25, 5, max_pairs).collect()}
    assert got == {i: (bool(core[i]), int(label[i])) for i in range(len(xy))}


def test_dbscan_border_point_between_two_clusters(spark):
    xy = np.array([[0, 0], [0.1, 0], [0.0, 0.1], [1.0, 0], [1.1, 0], [1.0, 0.1], [0.55, 0.0], [9, 9]])
    core, label = dbscan_plain(xy, 0.46, 3)
    got = {r["id"]: (r["core"], r["label"]) for r in density.dbscan(points(spark, xy), "id", ["a", "b"], 0.46, 3).collect()}
    assert got == {i: (bool(core[i]), int(label[i])) for i in range(len(xy))}
    assert got[7] == (False, -1)


def test_components_of_a_long_chain(spark):
    nodes = spark.range(200).select(F.col("id").alias("node"))
    edges = spark.range(199).where("id <> 120").select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = density.connected_components(nodes, edges).groupBy("label").count().orderBy("label").collect()
    assert [(r["label"], r["count"]) for r in got] == [(0, 121), (121, 79)]


def test_isolation_forest_ranks_planted_outliers_first(spark):
    rng = np.random.default_rng(0)
    df = points(spark, np.vstack([rng.normal(size=(400, 2)), [[9, 9], [-8, 9], [10, -9]]]))
    forest = isoforest.fit_forest(df, "id", ["a", "b"], trees=60)
    top = isoforest.score(df, forest, ["a", "b"]).orderBy(F.desc("score")).limit(3).collect()
    assert {r["id"] for r in top} == {400, 401, 402} and all(0.5 < r["score"] < 1 for r in top)
    again = isoforest.fit_forest(df.repartition(7), "id", ["a", "b"], trees=60)
    assert forest.exceptAll(again).count() == 0


def regression(spark, n=300):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(n, 3))
    y = x @ [1.5, 0.0, -2.0] + 3 + rng.normal(scale=0.5, size=n)
    df = spark.createDataFrame([(i, list(map(float, x[i])), float(y[i])) for i in range(n)], "id bigint, v array<double>, label double")
    return df.select("id", "label", array_to_vector("v").alias("features")).cache(), x, y


def test_ridge_has_the_closed_form_solution(spark):
    df, x, y = regression(spark)
    xc, yc = x - x.mean(axis=0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + 25.0 * np.eye(3), xc.T @ yc)
    assert models.penalized(df, "label", "ridge", 25.0).fit(df).coefficients.toArray() == pytest.approx(want, rel=1e-5)


def test_lasso_and_elastic_net_match_coordinate_descent(spark):
    df, x, y = regression(spark)
    xc, yc, n = x - x.mean(axis=0), y - y.mean(), len(y)
    for kind, alpha, ratio in (("lasso", 0.3, 1.0), ("elastic_net", 0.3, 0.5)):
        w = np.zeros(3)
        for _ in range(2000):
            for j in range(3):
                r = xc[:, j] @ (yc - xc @ w + xc[:, j] * w[j]) / n
                w[j] = np.sign(r) * max(abs(r) - alpha * ratio, 0) / (xc[:, j] @ xc[:, j] / n + alpha * (1 - ratio))
        got = models.penalized(df, "label", kind, alpha, ratio).fit(df).coefficients.toArray()
        assert got == pytest.approx(w, rel=5e-3, abs=1e-3)


def test_out_of_fold_rows_never_meet_their_own_model(spark):
    df = spark.createDataFrame([(i, float(i % 2), [float(i % 2), 1.0], i % 3) for i in range(60)], "id bigint, label double, v array<double>, fold int")
    df = df.select("id", "label", array_to_vector("v").alias("features"), "fold")
    seen = []

    def fit(train):
        seen.append({r["fold"] for r in train.select("fold").distinct().collect()})
        return LogisticRegression(maxIter=5).fit(train)

    out = models.out_of_fold(df, {"lr": fit}, "fold", 3, ["id", "label"])
    assert seen == [{1, 2}, {0, 2}, {0, 1}] and out.count() == 60 and out.select("id").distinct().count() == 60


def test_votes_and_bootstrap(spark):
    p = spark.createDataFrame([(0.9, 0.6, 0.1), (0.2, 0.6, 0.1)], "p_a double, p_b double, p_c double")
    names = ["a", "b", "c"]
    assert [r[0] for r in p.select(models.vote_hard(p, names)).collect()] == [1.0, 0.0]
    assert [r[0] for r in p.select(models.vote_soft(names, [1, 2, 2])).collect()] == pytest.approx([2.3 / 5, 1.6 / 5])
    w = spark.range(5000).select(models.bootstrap_weight("id", 3).alias("w"))
    row = w.agg(F.avg("w"), F.avg((F.col("w") == 0).cast("double"))).first()
    assert row[0] == pytest.approx(1.0, abs=0.05) and row[1] == pytest.approx(0.368, abs=0.03)
