"""Diagnostics, forecasts and their combination on the daily series."""

from __future__ import annotations

from pyspark.sql import functions as F

from brindle.operators import metrics, ts_combine, ts_diagnose, ts_forecast as fc
from brindle.operators.splits import holdout_last, timeseries_folds
from brindle.operators.ts_prep import difference, feature_matrix, fourier_columns, time_index
from brindle.plans.base import DAILY, daily
from brindle.plans.registry import query

H = 60


def _split(spark, sf, h=H):
    df = holdout_last(daily(spark, sf), "series", "day", h)
    return df.where("split = 'train'").drop("split"), df.where("split = 'test'").drop("split")


_ACF = f"""{DAILY}, c AS (SELECT series, day, y - avg(y) OVER (PARTITION BY series) AS c, row_number() OVER (PARTITION BY series ORDER BY day) AS t FROM daily),
v AS (SELECT series, sum(c * c) AS v, count(*) AS n FROM c GROUP BY 1),
acf AS (SELECT a.series, (a.t - b.t)::INTEGER AS lag, sum(a.c * b.c) / any_value(v) AS rho, any_value(n) AS n FROM c a JOIN c b ON a.series = b.series AND a.t - b.t BETWEEN 1 AND 60 JOIN v ON v.series = a.series GROUP BY 1, 2)"""


@query("acf", f"WITH {_ACF} SELECT series, lag, round(rho, 8) AS rho FROM acf")
def acf(spark, sf):
    return ts_diagnose.acf(daily(spark, sf), "series", "day", "y").select("series", "lag", F.round("rho", 8).alias("rho"))


@query("ljung_box", f"""WITH {_ACF} SELECT series, h::INTEGER AS h, round(any_value(n) * (any_value(n) + 2) * sum(rho * rho / (n - lag)), 5) AS q, any_value(n) * (any_value(n) + 2) * sum(rho * rho / (n - lag)) > any_value(c) AS correlated
FROM acf JOIN (SELECT unnest([7, 14, 28]) AS h, unnest([14.067, 23.685, 41.337]) AS c) ON lag <= h GROUP BY 1, 2""")
def ljung_box(spark, sf):
    rows = ts_diagnose.acf(daily(spark, sf), "series", "day", "y", 28)
    return ts_diagnose.ljung_box(rows, "series").withColumn("q", F.round("q", 5))


def _dot_sql(a: str, b: str) -> str:
    return f"coalesce(list_sum(list_transform(list_zip({a}, {b}), lambda z: z[1] * z[2])), 0)"


@query("pacf", f"""WITH RECURSIVE {_ACF}, rr AS (SELECT series, list(rho ORDER BY lag) AS r FROM acf GROUP BY 1),
st AS (SELECT series, r, 0 AS k, []::DOUBLE[] AS phi, NULL::DOUBLE AS last FROM rr UNION ALL
  SELECT series, r, k + 1, list_append(list_transform(list_zip(phi, list_reverse(phi)), lambda z: z[1] - l * z[2]), l), l
  FROM (SELECT *, (r[k + 1] - {_dot_sql('phi', 'list_reverse(r[1:k])')}) / (1 - {_dot_sql('phi', 'r[1:k]')}) AS l FROM st WHERE k < len(r)))
SELECT series, k::INTEGER AS lag, round(last, 6) AS phi FROM st WHERE k > 0""")
def pacf(spark, sf):
    rows = ts_diagnose.pacf(ts_diagnose.acf(daily(spark, sf), "series", "day", "y"), "series")
    return rows.withColumn("phi", F.round("phi", 6))


@query("adf_test")
def adf_test(spark, sf):
    """Levels and their weekly differences."""
    df = daily(spark, sf)
    diffed = difference(df, "series", "day", "y", [7], "d").select(F.concat("series", F.lit(":d7")).alias("series"), "day", F.col("d").alias("y")).where("y IS NOT NULL")
    return ts_diagnose.adf_test(df.unionByName(diffed), "series", "day", "y")


_TR = f"{DAILY}, r AS (SELECT series, day, y, row_number() OVER (PARTITION BY series ORDER BY day DESC) AS rd FROM daily)"


@query("forecast_naive", f"WITH {_TR} SELECT series, y AS yhat, h::INTEGER AS h FROM r, (SELECT unnest(range(1, 61)) AS h) WHERE rd = 61")
def forecast_naive(spark, sf):
    return fc.naive(_split(spark, sf)[0], "series", "day", "y", H)


_SN = "sn AS (SELECT series, y AS yhat, h::INTEGER AS h FROM r JOIN (SELECT unnest(range(1, 61)) AS h) ON rd - 60 = 7 - (h - 1) % 7)"
_MA = "ma AS (SELECT series, avg(y) AS yhat, h::INTEGER AS h FROM r, (SELECT unnest(range(1, 61)) AS h) WHERE rd BETWEEN 61 AND 67 GROUP BY 1, 3)"


@query("forecast_seasonal_naive", f"WITH {_TR}, {_SN} SELECT * FROM sn")
def forecast_seasonal_naive(spark, sf):
    return fc.seasonal_naive(_split(spark, sf)[0], "series", "day", "y", H)


@query("forecast_moving_average", f"WITH {_TR}, {_MA} SELECT * FROM ma")
def forecast_moving_average(spark, sf):
    return fc.moving_average(_split(spark, sf)[0], "series", "day", "y", H)


@query("forecast_ses", f"""WITH RECURSIVE {_TR}, t AS (SELECT series, y, row_number() OVER (PARTITION BY series ORDER BY day) AS t FROM r WHERE rd > 60),
s AS (SELECT series, t, y AS l FROM t WHERE t = 1 UNION ALL SELECT t.series, t.t, s.l + 0.2 * (t.y - s.l) FROM s JOIN t ON t.series = s.series AND t.t = s.t + 1),
z AS (SELECT series, max_by(l, t) AS l FROM s GROUP BY 1) SELECT series, 0.2::DOUBLE AS alpha, round(l, 3) AS yhat, h::INTEGER AS h FROM z, (SELECT unnest(range(1, 61)) AS h)""")
def forecast_ses(spark, sf):
    out = fc.ses(_split(spark, sf)[0], "series", "day", "y", H, alpha=0.2)
    return out.withColumn("yhat", F.round("yhat", 3))


def _tenths(forecasts):
    return forecasts.withColumn("yhat", F.round("yhat", 1))


_SES_STEP = "SELECT s.series, alpha, k + 1, l + alpha * (y - l), sse + (y - l) * (y - l) FROM {0} AS s JOIN tr ON tr.series = s.series AND tr.n = s.k"
_SES_BEST = "SELECT {0}.* FROM {0} JOIN (SELECT series, max(k) AS k FROM {0} GROUP BY 1) USING (series, k) QUALIFY row_number() OVER (PARTITION BY series ORDER BY sse, alpha) = 1"


@query("forecast_ses_fitted", f"""WITH RECURSIVE {_TR}, tr AS (SELECT series, y, row_number() OVER (PARTITION BY series ORDER BY day) AS n FROM r WHERE rd > {H}),
s1 AS (SELECT series, unnest({[round(0.05 * i, 2) for i in range(1, 20)]}::DOUBLE[]) AS alpha, 2 AS k, y AS l, 0.0::DOUBLE AS sse FROM tr WHERE n = 1 UNION ALL {_SES_STEP.format('s1')}),
b1 AS ({_SES_BEST.format('s1')}),
s2 AS (SELECT b1.series, least(greatest(alpha + o, 0.001::DOUBLE), 0.999::DOUBLE) AS alpha, 2 AS k, y AS l, 0.0::DOUBLE AS sse FROM b1 JOIN tr ON tr.series = b1.series AND n = 1,
  (SELECT unnest({[i * 0.05 / 5 for i in range(-5, 6)]}::DOUBLE[]) AS o) UNION ALL {_SES_STEP.format('s2')}),
b2 AS ({_SES_BEST.format('s2')})
SELECT series, round(alpha, 6) AS alpha, h::INTEGER AS h, round(l, 1) AS yhat FROM b2, (SELECT unnest(range(1, {H + 1})) AS h)""")
def forecast_ses_fitted(spark, sf):
    return _tenths(fc.ses(_split(spark, sf)[0], "series", "day", "y", H)).withColumn("alpha", F.round("alpha", 6))


def _smoothing_sql(lists: dict[str, tuple], start: str, first: int, season: str | None = None) -> str:
    """Every series under every point of the grid, a day at a time; the point of least one-step error forecasts.

    `start` gives (l, b, s) from the list ys, `first` is the first day that is forecast, `season` how a season enters: + or *.
    """
    grid = ", ".join(f"(SELECT unnest({list(v)}::DOUBLE[]) AS {n}) AS g_{n}" for n, v in lists.items())
    names = ", ".join(lists)
    back = {"+": "-", "*": "/"}.get(season)
    guess, plain, phase = ("base", "y", "s") if season is None else (f"(base {season} s[1])", f"(y {back} s[1])", f"list_append(s[2:], gamma * (y {back} base) + (1 - gamma) * s[1])")
    yhat = "l + damp * b" if season is None else f"(l + damp * b) {season} s[(h - 1) % 7 + 1]"
    return f"""WITH RECURSIVE {_TR}, tr AS (SELECT series, y, row_number() OVER (PARTITION BY series ORDER BY day) AS k FROM r WHERE rd > {H}),
ya AS (SELECT series, list(y ORDER BY k) AS ys FROM tr GROUP BY 1), grid AS (SELECT * FROM {grid}),
st AS (SELECT series, {names}, {first} AS k, {start}, 0.0::DOUBLE AS sse FROM ya, grid UNION ALL
  SELECT series, {names}, k + 1, level AS l, beta * (level - l) + (1 - beta) * phi * b AS b, {phase} AS s, sse + (y - {guess}) * (y - {guess}) AS sse
  FROM (SELECT *, alpha * {plain} + (1 - alpha) * base AS level FROM (SELECT st.*, tr.y, l + phi * b AS base FROM st JOIN tr ON tr.series = st.series AND tr.k = st.k))),
best AS (SELECT * FROM st JOIN (SELECT series, max(k) AS k FROM st GROUP BY 1) USING (series, k) QUALIFY row_number() OVER (PARTITION BY series ORDER BY sse, {names}) = 1),
hs AS (SELECT unnest(range(1, {H + 1})) AS h)
SELECT series, h::INTEGER AS h, round({yhat}, 1) AS yhat FROM (SELECT *, list_sum(list_transform(range(1, h + 1), lambda i: phi ** i)) AS damp FROM best, hs)"""


_HOLT_SQL = _smoothing_sql({"alpha": (0.1, 0.3, 0.5, 0.8), "beta": (0.01, 0.1, 0.3), "phi": (0.8, 0.9, 0.98)}, "ys[1] AS l, ys[2] - ys[1] AS b, NULL::DOUBLE[] AS s", 2)


def _winters_sql(season: str) -> str:
    grid = {"alpha": (0.05, 0.2, 0.5), "beta": (0.01, 0.1), "gamma": (0.05, 0.2), "phi": (0.9, 0.98)}
    mean = "(list_sum(ys[1:7]) / 7)"
    part = f"list_transform(ys[1:7], lambda v: v {'-' if season == '+' else '/'} {mean})"
    return _smoothing_sql(grid, f"{mean} AS l, 0.0::DOUBLE AS b, {part} AS s", 8, season)


@query("forecast_holt", _HOLT_SQL)
def forecast_holt(spark, sf):
    return _tenths(fc.holt(_split(spark, sf)[0], "series", "day", "y", H))


@query("forecast_holt_winters", _winters_sql("+"))
def forecast_holt_winters(spark, sf):
    return _tenths(fc.holt_winters(_split(spark, sf)[0], "series", "day", "y", H))


@query("forecast_holt_winters_multiplicative", _winters_sql("*"))
def forecast_holt_winters_multiplicative(spark, sf):
    return _tenths(fc.holt_winters(_split(spark, sf)[0], "series", "day", "y", H, multiplicative=True))


@query("forecast_sarima")
def forecast_sarima(spark, sf):
    return fc.sarima(_split(spark, sf)[0], "series", "day", "y", H).select("series", "h", "yhat")


@query("forecast_interval")
def forecast_interval(spark, sf):
    return fc.sarima(_split(spark, sf)[0], "series", "day", "y", H)


@query("arima_order_search")
def arima_order_search(spark, sf):
    return fc.arima_order_search(_split(spark, sf)[0], "series", "day", "y")


def _base_forecasts(train):
    """Three base models as (model, series, h, yhat)."""
    parts = [("naive", fc.naive), ("seasonal_naive", fc.seasonal_naive), ("moving_average", fc.moving_average)]
    frames = [fn(train, "series", "day", "y", H).select(F.lit(n).alias("model"), "series", "h", "yhat") for n, fn in parts]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def _with_truth(forecasts, test):
    truth = test.select("series", (time_index("series", "day") + 1).alias("h"), "y")
    return forecasts.join(truth, ["series", "h"])


_BASE = f"{_TR}, {_SN}, {_MA}, na AS (SELECT series, y AS yhat, h::INTEGER AS h FROM r, (SELECT unnest(range(1, 61)) AS h) WHERE rd = 61), bf AS (SELECT 'naive' AS model, * FROM na UNION ALL SELECT 'seasonal_naive', * FROM sn UNION ALL SELECT 'moving_average', * FROM ma)"


@query("combine_mean_median", f"WITH {_BASE} SELECT series, h, round(avg(yhat), 3) AS mean_fc, median(yhat) AS median_fc FROM bf GROUP BY 1, 2")
def combine_mean_median(spark, sf):
    return ts_combine.mean_median(_base_forecasts(_split(spark, sf)[0]), ["series", "h"]).withColumn("mean_fc", F.round("mean_fc", 3))


def _validation(spark, sf):
    """Forecasts of the last 60 training days from what came before, and of the test days from all training days."""
    train, _ = _split(spark, sf)
    inner = holdout_last(train, "series", "day", H)
    val = _with_truth(_base_forecasts(inner.where("split = 'train'").drop("split")), inner.where("split = 'test'"))
    return val, _base_forecasts(train)


_VAL = f"""v AS (SELECT series, y, rd FROM r WHERE rd BETWEEN 61 AND 120), vb AS (
SELECT 'naive' AS model, v.series, v.y, b.y AS yhat FROM v JOIN r b ON b.series = v.series AND b.rd = 121
UNION ALL SELECT 'seasonal_naive', v.series, v.y, b.y FROM v JOIN r b ON b.series = v.series AND b.rd - 120 = 7 - (120 - v.rd) % 7
UNION ALL SELECT 'moving_average', v.series, v.y, b.y FROM v JOIN (SELECT series, avg(y) AS y FROM r WHERE rd BETWEEN 121 AND 127 GROUP BY 1) b ON b.series = v.series),
iw AS (SELECT series, model, 1 / sqrt(avg((y - yhat) ** 2)) AS i FROM vb GROUP BY 1, 2), wt AS (SELECT series, model, i / sum(i) OVER (PARTITION BY series) AS weight FROM iw)"""


@query("combine_inverse_rmse", f"WITH {_BASE}, {_VAL} SELECT series, h, round(sum(yhat * weight), 2) AS combined FROM bf JOIN wt USING (series, model) GROUP BY 1, 2")
def combine_inverse_rmse(spark, sf):
    val, fore = _validation(spark, sf)
    out = ts_combine.weighted(fore, ts_combine.inverse_rmse_weights(val, ["series"]), ["series", "h"], ["series"])
    return out.withColumn("combined", F.round("combined", 2))


@query("combine_stacking_nonneg")
def combine_stacking_nonneg(spark, sf):
    val, fore = _validation(spark, sf)
    weights = ts_combine.stacking_weights(val, ["series", "h"], ["naive", "seasonal_naive", "moving_average"])
    table = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
    return fore.groupBy("series", "h").agg(F.sum(F.col("yhat") * table[F.col("model")]).alias("combined"))


def _regressor(matrix, label="y", exclude=()):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    names = [c for c in matrix.columns if c not in ("series", "day", "y", label, *exclude)]
    stages = [VectorAssembler(inputCols=names, outputCol="features"), GBTRegressor(labelCol=label, maxIter=10, maxDepth=4, stepSize=0.1, subsamplingRate=0.8, seed=42)]
    return Pipeline(stages=stages).fit(matrix)


def _one_step(spark, sf):
    matrix = feature_matrix(daily(spark, sf), "series", "day", "y")
    parts = holdout_last(matrix, "series", "day", H)
    train = parts.where("split = 'train'").drop("split").cache()
    return _regressor(train), parts.where("split = 'test'").drop("split")


@query("one_step_forecast")
def one_step_forecast(spark, sf):
    model, test = _one_step(spark, sf)
    return metrics.forecast_metrics(model.transform(test), "y", "prediction", ["series"])


@query("recursive_forecast")
def recursive_forecast(spark, sf):
    train, test = _split(spark, sf)
    model = _regressor(feature_matrix(train, "series", "day", "y").cache())
    return _with_truth(fc.recursive_forecast(model, train, "series", "day", "y", H), test)


@query("future_forecast")
def future_forecast(spark, sf):
    full = daily(spark, sf)
    model = _regressor(feature_matrix(full, "series", "day", "y").cache())
    return fc.recursive_forecast(model, full, "series", "day", "y", 30)


@query("direct_forecast")
def direct_forecast(spark, sf):
    """One model per horizon: 1, 7 and 28 days ahead."""
    matrix = feature_matrix(daily(spark, sf), "series", "day", "y").cache()
    out = None
    for h in (1, 7, 28):
        rows = fc.direct_targets(matrix, "series", "day", "y", h)
        scored = _regressor(rows.where("target IS NOT NULL"), "target").transform(rows.where("target IS NULL"))
        part = scored.groupBy("series").agg(F.max_by("prediction", "day").alias("yhat")).withColumn("h", F.lit(h))
        out = part if out is None else out.unionByName(part)
    return out


@query("cv_forecast_scores")
def cv_forecast_scores(spark, sf):
    folds = timeseries_folds(feature_matrix(daily(spark, sf), "series", "day", "y"), "series", "day", 3, H).cache()
    out = None
    for i in range(3):
        part = folds.where(F.col("fold") == i)
        model = _regressor(part.where("role = 'train'"), exclude=("fold", "role"))
        scored = model.transform(part.where("role = 'val'")).select("fold", "y", "prediction")
        out = scored if out is None else out.unionByName(scored)
    per_fold = metrics.forecast_metrics(out, "y", "prediction", ["fold"])
    mean = per_fold.agg(F.lit(-1).alias("fold"), *[F.avg(c).alias(c) for c in per_fold.columns if c != "fold"])
    return per_fold.unionByName(mean)


@query("fourier_fit")
def fourier_fit(spark, sf):
    """Smooth yearly cycle: least squares on three harmonics, one fit over all series."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    t = daily(spark, sf).select("series", "day", "y", time_index("series", "day").alias("t"))
    cols = t.select("*", *fourier_columns(F.col("t"), ((365.25, 3),)))
    rows = VectorAssembler(inputCols=cols.columns[4:], outputCol="features").transform(cols).cache()
    model = LinearRegression(labelCol="y", solver="normal").fit(rows)
    return model.transform(rows).select("series", "day", "y", "prediction")
