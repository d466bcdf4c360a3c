"""The forest on cells, and how rows are dealt to fits."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from brindle.operators import forest, models
from brindle.sources.scratch import bounded


def data(spark, rows=3_000):
    rng = np.random.default_rng(1)
    x = np.c_[rng.integers(0, 40, rows), rng.integers(0, 5, rows), rng.normal(size=rows)].astype(float)
    y = (x[:, 0] > 20) * 3.0 + x[:, 2] + rng.normal(size=rows) * 0.2
    made = spark.createDataFrame([(i, a.tolist(), float(b)) for i, (a, b) in enumerate(zip(x, y))], "id long, f array<double>, label double")
    return made.select("id", array_to_vector("f").alias("features"), "label")


def test_best_split_is_that_of_all_splits_tried():
    rng = np.random.default_rng(2)
    bins, w, y = rng.integers(0, 32, (400, 2)), rng.poisson(1.0, 400), rng.normal(size=400)
    sums = np.array([[np.bincount(bins[:, c], v, 32) for c in range(2)] for v in (w, w * y)])
    pick, at, gain, left, right, mean = (a[0] for a in forest.best_splits(sums.reshape(2, -1), 2))

    def error(m):
        return float((w[m] * (y[m] - np.average(y[m], weights=w[m])) ** 2).sum()) if w[m].sum() else 0.0

    every = np.ones(400, bool)
    tried = {(c, b): error(every) - error(bins[:, c] <= b) - error(bins[:, c] > b) for c in range(2) for b in range(31)}
    assert gain == pytest.approx(max(tried.values())) == pytest.approx(tried[pick, at])
    low = bins[:, pick] <= at
    assert (left, right, mean) == pytest.approx([np.average(y[m], weights=w[m]) for m in (low, ~low, every)])


def test_forest_is_as_good_as_the_row_wise_one_and_does_not_depend_on_partitions(spark):
    df = data(spark)
    mine = forest.CellForest(60, 5, key=["id"]).fit(df.repartition(3))
    again = forest.CellForest(60, 5, key=["id"]).fit(df.repartition(5, "label"))
    assert np.allclose(mine.featureImportances.toArray(), again.featureImportances.toArray(), atol=0.01)
    theirs = RandomForestRegressor(numTrees=60, maxDepth=5, seed=0).fit(df)
    assert np.allclose(mine.featureImportances.toArray(), theirs.featureImportances.toArray(), atol=0.08)
    error = [m.transform(df).agg(F.avg((F.col("prediction") - F.col("label")) ** 2)).first()[0] for m in (mine, theirs)]
    assert error[0] < 1.1 * error[1]


def test_equal_rows_are_drawn_apart():
    n = 200
    batch = pa.RecordBatch.from_arrays([pa.array([b"\x01"] * n, pa.binary()), pa.array([7] * n, pa.int64()), pa.array([1.0] * n)], ["bins", "key", "y"])
    (_, key, _), = forest._chunks(iter([batch.slice(0, 50), batch.slice(50)]), 1)
    assert len(set(key.tolist())) == n
    big = pa.concat_batches([batch] * (forest.CHUNK // n + 2))
    found = [k for _, key, _ in forest._chunks(iter([big, batch]), 1) for k in key.tolist()]
    assert len(set(found)) == len(found) == big.num_rows + n
    draws = forest._draws().take(np.array(found, np.uint64).view(np.uint16))
    assert draws.mean() == pytest.approx(1.0, abs=0.02) and draws.var() == pytest.approx(1.0, abs=0.03)


def test_missing_label_is_an_error(spark):
    with pytest.raises(Exception, match="Labels MUST NOT"):
        forest.CellForest(2, 2).fit(data(spark, 20).withColumn("label", F.when(F.col("id") > 3, F.col("label"))))


def test_partitions_are_bounded_by_rows(spark):
    df = spark.range(1_000, numPartitions=1)
    parts = bounded(df, 100).groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == 10 and max(r["count"] for r in parts) <= 110
    assert bounded(df, 1_000).rdd.getNumPartitions() == 1


def test_folds_are_those_of_the_validator_in_few_partitions(spark):
    from pyspark.ml.tuning import CrossValidator

    df = spark.range(500, numPartitions=16)
    drawn = CrossValidator(numFolds=5, seed=0)._kFold(df)
    own = models.few_parts(models.random_folds(df, 5, 0))
    assert own.rdd.getNumPartitions() == 4
    for i, (_, held) in enumerate(drawn):
        assert {r["id"] for r in held.collect()} == {r["id"] for r in own.where(F.col("cv_fold") == i).collect()}
