import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from brindle.operators import ts_cluster as tc, ts_combine, ts_diagnose, ts_forecast as fc, ts_prep as ts

D0 = dt.date(2024, 1, 1)


def series(spark, values, name="s"):
    return spark.createDataFrame([(name, D0 + dt.timedelta(days=i), None if v is None else float(v)) for i, v in enumerate(values)], "series string, day date, y double")


def ys(df, column="y"):
    return [r[column] for r in df.orderBy("day").collect()]


def test_interpolation_edges(spark):
    assert ys(ts.interpolate_time(series(spark, [None, 1, None, None, 4, None]), "series", "day", "y")) == [None, 1.0, 2.0, 3.0, 4.0, 4.0]


def test_spine_fills_gaps(spark):
    gaps = series(spark, range(10)).where("y NOT IN (3, 4)")
    assert ys(ts.calendar_spine(gaps, "series", "day")) == [0, 1, 2, None, None, 5, 6, 7, 8, 9]


def test_windows_stay_null_until_full(spark):
    out = ts.rolling_stats(series(spark, [1, 2, 3, 4]), "series", "day", "y", 3)
    assert ys(out, "roll_mean") == [None, None, 2.0, 3.0]
    assert ys(ts.rolling_stats(series(spark, [1, 2]), "series", "day", "y", 3), "roll_mean") == [None, None]
    past = series(spark, [1, 2, 3, 4]).select("day", *ts.rolling_past_columns("series", "day", "y", [2]))
    assert ys(past, "rollmean_2") == [None, None, 1.5, 2.5]


@pytest.mark.parametrize("period", [4, 7])
def test_decomposition_recovers_trend_and_season(spark, period):
    season = np.arange(period) - (period - 1) / 2
    data = [3.0 * t + season[t % period] for t in range(10 * period)]
    rows = ts.decompose_classical(series(spark, data), "series", "day", "y", period).orderBy("day").collect()
    half = period // 2
    assert all(rows[i]["trend"] is None for i in range(half)) and rows[half]["trend"] == pytest.approx(3.0 * half)
    assert [r["seasonal"] for r in rows[:period]] == pytest.approx(list(season))
    assert max(abs(r["resid"]) for r in rows if r["resid"] is not None) < 1e-9


def test_acf_and_pacf_match_numpy(spark):
    rng = np.random.default_rng(0)
    x = np.zeros(400)
    for t in range(1, 400):
        x[t] = 0.7 * x[t - 1] + rng.normal()
    a = ts_diagnose.acf(series(spark, x), "series", "day", "y", 10)
    c = x - x.mean()
    want = [float((c[k:] * c[:-k]).sum() / (c * c).sum()) for k in range(1, 11)]
    assert [r["rho"] for r in a.orderBy("lag").collect()] == pytest.approx(want)
    p = [r["phi"] for r in ts_diagnose.pacf(a, "series", 10).orderBy("lag").collect()]
    r = np.array([1.0, *want])
    direct = [np.linalg.solve([[r[abs(i - j)] for j in range(k)] for i in range(k)], r[1 : k + 1])[-1] for k in range(1, 11)]
    assert p == pytest.approx(direct)


def test_unit_root_verdicts(spark):
    rng = np.random.default_rng(1)
    steps = rng.normal(size=600)
    both = series(spark, steps, "noise").unionByName(series(spark, np.cumsum(steps), "walk"))
    assert {r["series"]: r["stationary"] for r in ts_diagnose.adf_test(both, "series", "day", "y", 4).collect()} == {"noise": True, "walk": False}


def test_unit_root_statistic_matches_least_squares(spark):
    x = np.cumsum(np.random.default_rng(2).normal(size=200))
    got = ts_diagnose.adf_test(series(spark, x), "series", "day", "y", 0).first()["statistic"]
    d, lag = np.diff(x), x[:-1]
    design = np.column_stack([np.ones(len(d)), lag])
    beta, sse, *_ = np.linalg.lstsq(design, d, rcond=None)
    se = np.sqrt(sse[0] / (len(d) - 2) * np.linalg.inv(design.T @ design)[1, 1])
    assert got == pytest.approx(beta[1] / se)


def fvals(df):
    return [r["yhat"] for r in df.orderBy("h").collect()]


def test_simple_forecasts(spark):
    df = series(spark, range(1, 15))
    assert fvals(fc.naive(df, "series", "day", "y", 3)) == [14.0] * 3
    assert fvals(fc.seasonal_naive(df, "series", "day", "y", 9)) == [8, 9, 10, 11, 12, 13, 14, 8, 9]
    assert fvals(fc.moving_average(df, "series", "day", "y", 2)) == [11.0] * 2


def test_smoothing_recursions(spark):
    data = [3.0, 5.0, 4.0, 6.0]
    level = data[0]
    for v in data[1:]:
        level += 0.3 * (v - level)
    assert fvals(fc.ses(series(spark, data), "series", "day", "y", 2, alpha=0.3)) == pytest.approx([level] * 2)
    fitted = fc.ses(series(spark, np.random.default_rng(0).normal(size=60).cumsum()), "series", "day", "y", 1).first()["alpha"]
    assert fitted > 0.7
    line = fvals(fc.holt(series(spark, [2.0 * t for t in range(80)]), "series", "day", "y", 3))
    assert line[0] < line[1] < line[2] and line[0] == pytest.approx(160, abs=3)


@pytest.mark.parametrize("multiplicative", [False, True])
def test_holt_winters_follows_a_fixed_season(spark, multiplicative):
    week = np.array([10, 12, 15, 11, 9, 20, 25.0])
    got = fvals(fc.holt_winters(series(spark, list(week) * 12), "series", "day", "y", 14, multiplicative=multiplicative))
    assert got == pytest.approx(list(week) * 2, rel=1e-6)


def test_sarima_on_a_seasonal_process(spark):
    rng = np.random.default_rng(4)
    y = np.array([10.0 * np.sin(2 * np.pi * t / 7) + 0.1 * t for t in range(300)]) + rng.normal(scale=0.1, size=300)
    rows = fc.sarima(series(spark, y[:-14]), "series", "day", "y", 14).orderBy("h").collect()
    assert np.abs(np.array([r["yhat"] for r in rows]) - y[-14:]).mean() < 0.5
    widths = [r["high"] - r["low"] for r in rows]
    assert all(w > 0 for w in widths) and widths[-1] >= widths[0]
    search = fc.arima_order_search(series(spark, y), "series", "day", "y", [((1, 0, 1), (0, 1, 1)), ((0, 0, 0), (0, 0, 0))])
    assert [r["order"] for r in search.where("chosen").collect()] == [str(((1, 0, 1), (0, 1, 1)))]


def test_recursive_features_equal_the_matrix(spark):
    """The features of the next step are those the training matrix has for that day."""
    values = list(np.random.default_rng(0).normal(size=400).round(3))
    matrix = ts.feature_matrix(series(spark, values), "series", "day", "y").where(F.col("t_index") == 399).first()
    state = series(spark, values[:399]).groupBy("series").agg(F.transform(F.sort_array(F.collect_list(F.struct("day", "y"))), lambda s: s["y"]).alias("hist"))
    state = state.select("series", F.slice("hist", -365, 365).alias("hist"), F.lit(D0 + dt.timedelta(days=399)).alias("day_next"), F.lit(399).alias("t_next"))
    row = state.select(*fc.next_feature_columns()).first()
    for name in row.asDict():
        assert row[name] == pytest.approx(matrix[name]), name


def test_recursive_forecast_feeds_back(spark):
    class Previous:
        def transform(self, df):
            return df.withColumn("prediction", F.col("lag_1") + 1)

    got = fc.recursive_forecast(Previous(), series(spark, range(400)), "series", "day", "y", 5, cut_every=2)
    assert fvals(got) == [400, 401, 402, 403, 404]


def test_combinations(spark):
    val = spark.createDataFrame([("s", h, m, 10.0, 10.0 + e) for h in (1, 2) for m, e in (("a", 1.0), ("b", 3.0))], "series string, h int, model string, y double, yhat double")
    w = {r["model"]: r["weight"] for r in ts_combine.inverse_rmse_weights(val, ["series"]).collect()}
    assert w == pytest.approx({"a": 0.75, "b": 0.25})
    mix = ts_combine.weighted(val.select("series", "h", "model", "yhat"), ts_combine.inverse_rmse_weights(val, ["series"]), ["series", "h"], ["series"])
    assert [r["combined"] for r in mix.collect()] == pytest.approx([11.5, 11.5])
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=50), rng.normal(size=50)
    rows = [("s", i, m, float(2 * a[i] - b[i]), float(v[i])) for i in range(50) for m, v in (("a", a), ("b", b))]
    got = ts_combine.stacking_weights(spark.createDataFrame(rows, val.schema), ["series", "h"], ["a", "b"])
    assert got["b"] == 0.0 and got["a"] > 0


def dtw_plain(a, b, band=None):
    d = np.full((len(a) + 1, len(b) + 1), np.inf)
    d[0, 0] = 0
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            if band is None or abs(i - j) <= band:
                d[i, j] = (a[i - 1] - b[j - 1]) ** 2 + min(d[i - 1, j], d[i, j - 1], d[i - 1, j - 1])
    return d[-1, -1] ** 0.5


@pytest.mark.parametrize("band", [None, 2])
def test_dtw_matches_a_plain_dynamic_programme(spark, band):
    rng = np.random.default_rng(0)
    rows = [(list(map(float, rng.normal(size=8))), list(map(float, rng.normal(size=8)))) for _ in range(5)]
    got = spark.createDataFrame(rows, "a array<double>, b array<double>").select(tc.dtw(F.col("a"), F.col("b"), band)).collect()
    assert [g[0] for g in got] == pytest.approx([dtw_plain(a, b, band) for a, b in rows])


def align_plain(a, c):
    """Sums and counts of the values of a along its best path to c; diagonal first, then along the row."""
    d = np.full((len(a) + 1, len(c) + 1), np.inf)
    d[0, 0] = 0
    for i in range(1, len(a) + 1):
        for j in range(1, len(c) + 1):
            d[i, j] = (a[i - 1] - c[j - 1]) ** 2 + min(d[i - 1, j], d[i, j - 1], d[i - 1, j - 1])
    i, j, sums, counts = len(a), len(c), np.zeros(len(c)), np.zeros(len(c))
    while i and j:
        sums[j - 1] += a[i - 1]
        counts[j - 1] += 1
        step = int(np.argmin([d[i - 1, j - 1], d[i - 1, j], d[i, j - 1]]))
        i, j = i - (step < 2), j - (step != 1)
    return d[-1, -1], sums, counts


def test_barycentres_equal_brute_force_on_thirty_days(spark):
    rng = np.random.default_rng(2)
    base = [np.sin(np.arange(24) / 3), np.exp(-((np.arange(24) - 12) ** 2) / 8)]
    x = [np.roll(base[i % 2], int(rng.integers(-2, 3))) + rng.normal(scale=0.05, size=24) for i in range(30)]
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(99, None)], "id bigint, profile array<double>")
    out, sums = tc.barycentres(df, "id", 2)
    got = {r["id"]: (r["cluster"], r["distance"]) for r in out.collect()}
    start = sorted(r["id"] for r in tc.sample_rows(df.where("profile IS NOT NULL"), F.col("id"), 2, 0).collect())
    centres, seen = [x[i] for i in start], []
    while True:
        found = [[align_plain(r, c) for c in centres] for r in x]
        which = [int(np.argmin([f[0] for f in row])) for row in found]
        seen.append(sum(row[w][0] for row, w in zip(found, which)))
        if len(seen) > 1 and seen[-2] - seen[-1] <= 1e-9 * seen[0]:
            break
        for c in range(2):
            total = sum((row[c][1] for row, w in zip(found, which) if w == c), np.zeros(24))
            count = sum((row[c][2] for row, w in zip(found, which) if w == c), np.zeros(24))
            centres[c] = np.round(np.where(count > 0, total / np.maximum(count, 1), centres[c]), 9)
    assert sums == pytest.approx(seen) and all(a >= b - 1e-9 for a, b in zip(sums, sums[1:]))
    assert {i: c for i, (c, _) in got.items()} == dict(enumerate(which)) and len(set(which)) == 2
    assert [got[i][1] for i in range(30)] == pytest.approx([dtw_plain(x[i], centres[which[i]]) for i in range(30)])
    none, sums = tc.barycentres(df.where("id = 99"), "id", 2)
    assert none.count() == 0 and sums == []


def test_znorm_and_shift(spark):
    df = spark.createDataFrame([(1, [5.0, 5.0, 5.0]), (2, [1.0, 2.0, 3.0])], "id bigint, p array<double>")
    got = {r[0]: r[1] for r in df.select("id", tc.znorm(F.col("p"))).collect()}
    assert got[1] == [0.0] * 3 and got[2] == pytest.approx([-1.224745, 0, 1.224745], abs=1e-6)
    assert df.where("id = 2").select(tc.shift(F.col("p"), 1)).first()[0] == [3.0, 1.0, 2.0]
    rows = [(i, [0.0, 0.0, 9.0, 0.0] if i % 2 else [9.0, 9.0, 0.0, 9.0]) for i in range(12)]
    with pytest.raises(ValueError):
        tc.dtw_pairs(spark.createDataFrame(rows, "id bigint, profile array<double>"), "id", 5)
