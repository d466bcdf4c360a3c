import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from brindle.functions.ordered import brackets, exact_quantiles, quantile_row, running_totals
from brindle.operators import encode, impute, metrics, outliers, quality, scale, selection, splits, transform


def column(spark, values, name="x"):
    return spark.createDataFrame([(i, None if v is None else float(v)) for i, v in enumerate(values)], f"id bigint, {name} double")


@pytest.mark.parametrize("values", [[5.0], [1, 1, 1, 1], [3, 1, 2], list(range(1000)), [0] * 600 + list(range(400)), [-5, None, 2.5, 2.5, 1e9]])
@pytest.mark.parametrize("accuracy", [16, 10_000])
def test_exact_quantiles_match_linear_interpolation(spark, values, accuracy):
    df = column(spark, values).repartition(3)
    got = {r["prob"]: r["value"] for r in exact_quantiles(df, ["x"], [0.0, 0.1, 0.25, 0.5, 0.9, 1.0], accuracy).collect()}
    known = [v for v in values if v is not None]
    for p, v in got.items():
        assert v == pytest.approx(np.quantile(known, p), rel=1e-12)
    assert len(got) == 6


def test_few_values_leave_the_brackets(spark):
    """Only values near the wanted ranks are kept, whatever their order, and infinite ones and ties change nothing."""
    rng = np.random.default_rng(0)
    values = np.concatenate([rng.normal(size=20_000), np.full(7_000, 0.25), [np.inf, -np.inf] * 3])
    df = column(spark, values).repartition(5)
    held = brackets(df, ["x"], [0.1, 0.5], 1000).first()["c0"]
    for p, lo, hi in zip((0.1, 0.5), held["lo"], held["hi"]):
        kept = values[(values >= lo) & (values <= hi)]
        assert lo <= np.quantile(values, p) <= hi and len(np.unique(kept)) < 0.01 * len(values)
    got = {r["prob"]: r["value"] for r in exact_quantiles(df, ["x"], [0.1, 0.5, 0.93], 1000).collect()}
    assert got == pytest.approx({p: np.quantile(values, p) for p in (0.1, 0.5, 0.93)})


def test_quantiles_of_nothing_are_null(spark):
    assert quantile_row(column(spark, [None, None]), {"m": ("x", 0.5)}).first()["m"] is None


def test_running_totals_over_ranges(spark):
    rng = random.Random(1)
    data = sorted({rng.random(): None for _ in range(500)})
    df = spark.createDataFrame([("a", v, i % 7) for i, v in enumerate(data)] + [("b", 1.0, 3)], "k string, v double, n bigint")
    got = {(r["k"], r["v"]): r["n_before"] for r in running_totals(df, "v", ["n"], "k").collect()}
    total = 0
    for i, v in enumerate(data):
        assert got[("a", v)] == total
        total += i % 7
    assert got[("b", 1.0)] == 0


def test_scalers_on_constant_single_and_missing(spark):
    df = column(spark, [4, 4, None])
    for fit, apply in ((scale.fit_zscore, scale.apply_zscore), (scale.fit_minmax, scale.apply_minmax), (scale.fit_robust, scale.apply_robust)):
        assert [r["x"] for r in apply(df, fit(df, ["x"]), ["x"]).orderBy("id").collect()] == [0.0, 0.0, None]


def test_hand_zscore_and_inverse(spark):
    df = column(spark, [1, 2, 3, 4])
    p = scale.fit_zscore(df, ["x"])
    z = scale.apply_zscore(df, p, ["x"])
    assert [r["x"] for r in z.orderBy("id").collect()] == pytest.approx([(v - 2.5) / math.sqrt(1.25) for v in (1, 2, 3, 4)])
    assert [r["x"] for r in scale.invert_zscore(z, p, ["x"]).orderBy("id").collect()] == pytest.approx([1, 2, 3, 4])


def test_row_norms(spark):
    df = spark.createDataFrame([(3.0, 4.0), (0.0, 0.0)], "a double, b double")
    assert [tuple(r) for r in scale.normalize_rows(df, ["a", "b"]).collect()] == [(0.6, 0.8), (0.0, 0.0)]


def test_bins_on_edges(spark):
    df = column(spark, [0, 1, 2, 3, 4])
    edges = transform.quantile_edges(df, "x", 4)
    left = [r["bin"] for r in transform.bin_left_closed(df, edges, "x", 4).orderBy("id").collect()]
    right = [r["bin"] for r in transform.bin_right_closed(df, edges, "x", 4).orderBy("id").collect()]
    assert left == [0, 1, 2, 3, 3] and right == [0, 0, 1, 2, 3]
    assert [r["bin"] for r in transform.bin_uniform(df, "x", 4).orderBy("id").collect()] == [0, 1, 2, 3, 3]
    assert [r["bin"] for r in transform.bin_uniform(column(spark, [7, 7]), "x", 4).collect()] == [0, 0]


def test_power_transforms_at_special_exponents(spark):
    df = column(spark, [0.5, 2.0])
    row = df.select(F.max(transform.box_cox(F.col("x"), 0.0)), F.max(transform.yeo_johnson(-F.col("x"), 2.0)), F.max(transform.yeo_johnson(F.col("x"), 1.0))).first()
    assert row[0] == pytest.approx(math.log(2)) and row[1] == pytest.approx(-math.log(1.5)) and row[2] == pytest.approx(2.0)
    logn = column(spark, np.exp(np.random.default_rng(0).normal(size=2000)))
    assert abs(transform.fit_power(logn, "x", "box-cox")) < 0.1


def test_outlier_rules(spark):
    df = column(spark, [1] * 10 + [50])
    assert {r["mz"] for r in outliers.modified_zscores(df, "x").collect()} == {0.0}
    assert [r["x"] for r in outliers.outside_fences(df, "x").collect()] == [50.0]
    assert {r["z"] for r in outliers.zscores(column(spark, [2, 2]), "x").collect()} == {0.0}
    clipped = outliers.winsorize(column(spark, range(101)), "x", 0.1, 0.9)
    assert clipped.agg(F.min("clipped"), F.max("clipped")).first()[:] == (10.0, 90.0)


def test_imputation(spark):
    cats = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    assert impute.fit_mode(cats, "c").first()[0] == "a"
    nothing = column(spark, [None, None])
    assert [r["x"] for r in impute.apply_fill(nothing, impute.fit_median(nothing, ["x"]), ["x"]).collect()] == [None, None]
    df = spark.createDataFrame([(i, float(i), None if i == 3 else float(10 * i)) for i in range(8)], "id bigint, a double, b double")
    out = {r["id"]: r["b"] for r in impute.impute_knn(df, "id", "b", ["a", "b"], k=2).collect()}
    assert out[3] == pytest.approx(30.0) and out[5] == 50.0


def test_knn_imputation_skips_donors_it_cannot_compare(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, 5.0), (3, 1.0, None)], "id bigint, a double, b double")
    assert {r["id"]: r["b"] for r in impute.impute_knn(df, "id", "b", ["a", "b"]).collect()} == {1: None, 2: 5.0, 3: None}


def test_encodings(spark):
    df = spark.createDataFrame([("lo",), ("hi",), ("??",), (None,)], "c string")
    assert [r[0] for r in df.select(encode.ordinal("c", ["lo", "hi"])).collect()] == [0, 1, -1, 0]
    hot = encode.onehot(df, "c", ["hi", "lo"]).collect()
    assert [(r["c=hi"], r["c=lo"]) for r in hot] == [(0, 1), (1, 0), (0, 0), (0, 0)]
    words = spark.createDataFrame([(w,) for w in ["ab", "abc", "b", "zz", "aa", "ab"]], "w string")
    codes = {r["value"]: r["code"] for r in encode.fit_label(words, "w").collect()}
    assert codes == {w: i for i, w in enumerate(sorted({"ab", "abc", "b", "zz", "aa"}))}
    many = spark.createDataFrame([(f"v{i}",) for i in range(40)], "c string")
    row = encode.hash_collisions(many, "c", [8]).first()
    assert row["categories"] == 40 and row["buckets"] <= 8 and row["collisions"] == 40 - row["buckets"]
    wide = spark.createDataFrame([(f"v{i:05d}",) for i in range(3000)] + [(None,), ("new",)], "c string")
    codes = encode.fit_label(wide.where("c <> 'new'"), "c")
    sparse = encode.onehot_sparse(wide, codes, "c").collect()
    assert {(r["c"], r["width"], r["slot"]) for r in sparse} == {(f"v{i:05d}", 3000, i) for i in range(3000)} | {(None, 3000, None), ("new", 3000, None)}


def test_null_keys_are_keys_like_any_other(spark):
    rows = [(i, None if i % 3 == 0 else "ab"[i % 2], float(i), i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "id bigint, c string, y double, fold int")
    split = splits.stratified_split(df, ["id"], "c", 0.25).collect()
    assert len(split) == 60
    tests = [r["c"] for r in split if r["split"] == "test"]
    assert {c: tests.count(c) for c in (None, "a", "b")} == {None: 5, "a": 5, "b": 5}
    found = {r["id"]: r["encoded"] for r in encode.target_oof(df, "c", "y", "fold").collect()}
    for i, c, _, fold in rows:
        other = [y for _, d, y, f in rows if d == c and f != fold]
        rest = other or [y for *_, y, f in rows if f != fold]
        assert found[i] == pytest.approx(sum(rest) / len(rest))


def test_null_counts_names_every_column(spark):
    df = spark.range(3).select(*[F.lit(None).cast("int").alias(f"c{i}") for i in range(20)])
    assert quality.null_counts(df).count() == 20 and quality.null_counts(df, 5).count() == 5


def test_target_encoding_never_uses_its_own_fold(spark):
    df = spark.createDataFrame([("a", 0, 1.0), ("a", 1, 3.0), ("a", 1, 5.0), ("b", 0, 9.0)], "c string, fold int, y double")
    got = {(r["c"], r["fold"]): r["encoded"] for r in encode.target_oof(df, "c", "y", "fold").collect()}
    assert got == {("a", 0): 4.0, ("a", 1): 1.0, ("b", 0): 4.0}


def test_metrics_edges(spark):
    tied = spark.createDataFrame([("m", 1, 0.5), ("m", 0, 0.5), ("m", 0, 0.5), ("one", 1, 0.2)], "model string, y int, s double")
    assert {r["model"]: r["auc"] for r in metrics.roc_auc(tied, "y", "s", "model").collect()} == {"m": 0.5, "one": None}
    same = spark.createDataFrame([(i % 3, (i % 3) * 10) for i in range(30)], "a int, b int")
    assert metrics.adjusted_rand(same, "a", "b").first()[0] == pytest.approx(1.0)
    free = spark.createDataFrame([(i % 2, i // 2 % 2) for i in range(400)], "a int, b int")
    assert abs(metrics.adjusted_rand(free, "a", "b").first()[0]) < 0.02
    zero = spark.createDataFrame([("m", 0.0, 1.0), ("m", 2.0, 1.0)], "model string, y double, f double")
    assert metrics.forecast_metrics(zero, "y", "f", ["model"]).first()["mape"] == pytest.approx(50.0)


def test_auc_matches_pair_counting(spark):
    rng = np.random.default_rng(3)
    y, s = rng.integers(0, 2, 400), rng.integers(0, 50, 400) / 7
    df = spark.createDataFrame([("m", int(a), float(b)) for a, b in zip(y, s)], "model string, y int, s double")
    diff = s[y == 1][:, None] - s[y == 0][None, :]
    assert metrics.roc_auc(df, "y", "s", "model").first()["auc"] == pytest.approx(((diff > 0) + 0.5 * (diff == 0)).mean())


def test_f_test_p_value(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=200)
    df = spark.createDataFrame([(float(a), float(b), float(0.2 * a + b)) for a, b in zip(x, rng.normal(size=200))], "x double, e double, y double")
    rows = {r["feature"]: r for r in selection.f_regression(df, ["x", "e"], "y").collect()}
    assert rows["e"]["p_value"] < 1e-10 and 0 < rows["x"]["p_value"] < 1
    one = spark.createDataFrame([(3.8415, 1e6), (4.9646, 10.0), (0.0, 50.0)], "f double, d double").select(selection.f_survival("f", "d")).collect()
    assert [r[0] for r in one] == pytest.approx([0.05, 0.05, 1.0], abs=1e-4)


def test_stratified_split_takes_the_exact_share(spark):
    df = spark.createDataFrame([(i, "hot" if i % 10 else "rare") for i in range(1000)], "id bigint, c string")
    got = splits.stratified_split(df, ["id"], "c", 0.3)
    assert {(r["c"], r["split"]): r["count"] for r in got.groupBy("c", "split").count().collect()} == {("hot", "test"): 270, ("hot", "train"): 630, ("rare", "test"): 30, ("rare", "train"): 70}
    again = splits.stratified_split(df.repartition(7), ["id"], "c", 0.3)
    assert got.exceptAll(again).count() == 0


def test_time_folds_never_look_ahead(spark):
    df = spark.createDataFrame([("s", i) for i in range(100)], "series string, t bigint")
    f = splits.timeseries_folds(df, "series", "t", 3, 10).groupBy("fold").agg(
        F.max(F.when(F.col("role") == "train", F.col("t"))).alias("last"), F.min(F.when(F.col("role") == "val", F.col("t"))).alias("first"), F.count_if(F.col("role") == "val").alias("n"))
    assert [(r["last"], r["first"], r["n"]) for r in f.orderBy("fold").collect()] == [(69, 70, 10), (79, 80, 10), (89, 90, 10)]


def test_quality_gate_reports_each_broken_rule(spark):
    bad = spark.createDataFrame([(1, None), (1, 2), (None, 3)], "k bigint, t bigint")
    got = {r["rule"]: r["violations"] for r in quality.validate_table(bad, ["k", "t", "z"], "k", ["t"]).collect()}
    assert got == {"columns_present": 1, "not_empty": 0, "key_unique": 1, "no_null_k": 1, "no_null_t": 1}
    empty = {r["rule"]: r["passed"] for r in quality.validate_table(bad.where("false"), ["k"], "k", []).collect()}
    assert empty["not_empty"] is False and empty["key_unique"] is True
    falls = spark.createDataFrame([(1, 1, 5), (1, 2, 4), (1, 3, 6)], "u bigint, t bigint, v bigint")
    assert quality.order_violations(falls, "u", "t", ["v"]).first()["violations"] == 1


def test_training_rows_keep_every_request(spark):
    from brindle.plans.q12_models import training_rows

    rows = [(i, float(i), None if i % 3 else float(i), float(i), None) for i in range(10)] + [(99, None, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "event_id int, label double, clicks double, purchases double, conversion_rate double")
    got = {r["event_id"]: r for r in training_rows(df, F.col("event_id") >= 7).collect()}
    assert len(got) == 10 and got[4]["clicks"] == 3.0 and got[4]["clicks_missing"] == 1  # median of 0, 3, 6; 9 is in the test part
    assert got[9]["clicks"] == 9.0 and got[9]["clicks_missing"] == 0 and got[5]["conversion_rate"] == 0.0 and got[5]["conversion_rate_missing"] == 1
