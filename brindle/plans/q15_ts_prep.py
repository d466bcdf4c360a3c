"""Time-series preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from brindle.operators import ts_prep as ts
from brindle.operators.local_regression import decompose_local
from brindle.plans import base
from brindle.plans.base import DAILY, GAPPY, cents, daily, gappy
from brindle.plans.registry import query
from brindle.sources.files import table

W = "WINDOW w AS (PARTITION BY series ORDER BY day)"
SPINE = f"""{GAPPY}, span AS (SELECT series, min(day) AS a, max(day) AS b FROM gappy GROUP BY 1),
grid AS (SELECT series, unnest(generate_series(a::TIMESTAMP, b::TIMESTAMP, INTERVAL 1 DAY))::DATE AS day FROM span),
spine AS (SELECT grid.series, grid.day, y FROM grid LEFT JOIN gappy ON grid.series = gappy.series AND grid.day = gappy.day)"""


def _events(spark, sf):
    return table(spark, sf, "events").select("event_type", "ts", cents("value").alias("v"))


for _unit in ("hour", "day"):
    @query(f"resample_mean_{_unit}" if _unit == "day" else "resample_mean",
           f"SELECT event_type, date_trunc('{_unit}', ts)::TIMESTAMP AS ts, avg(round(value * 100)::BIGINT) AS y FROM events GROUP BY ALL")
    def resample_mean(spark, sf, unit=_unit):
        return ts.resample_mean(_events(spark, sf), "event_type", "ts", "v", unit)


@query("resample_week", f"WITH {DAILY} SELECT series, (day + (7 - isodow(day))::INTEGER)::DATE AS week, avg(y) AS y FROM daily GROUP BY ALL")
def resample_week(spark, sf):
    return daily(spark, sf).groupBy("series", ts.week_ending_sunday(F.col("day")).alias("week")).agg(F.avg("y").alias("y"))


@query("calendar_spine", f"WITH {SPINE} SELECT series, day, y FROM spine")
def calendar_spine(spark, sf):
    return ts.calendar_spine(gappy(spark, sf), "series", "day")


@query("interpolate_time", f"""WITH {SPINE}, n AS (SELECT series, day, y, last_value(CASE WHEN y IS NOT NULL THEN day END IGNORE NULLS) OVER p AS pd, last_value(y IGNORE NULLS) OVER p AS pv,
first_value(CASE WHEN y IS NOT NULL THEN day END IGNORE NULLS) OVER f AS nd, first_value(y IGNORE NULLS) OVER f AS nv FROM spine
WINDOW p AS (PARTITION BY series ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), f AS (PARTITION BY series ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT series, day, round(CASE WHEN y IS NOT NULL THEN y WHEN nv IS NULL THEN pv ELSE pv + (nv - pv) * ((day - pd)::DOUBLE / (nd - pd)) END, 3) AS y FROM n""")
def interpolate_time(spark, sf):
    out = ts.interpolate_time(ts.calendar_spine(gappy(spark, sf), "series", "day"), "series", "day", "y")
    return out.withColumn("y", F.round("y", 3))


@query("trim_partial_edges", f"WITH {DAILY} SELECT series, day, y FROM daily QUALIFY day > min(day) OVER (PARTITION BY series) AND day < max(day) OVER (PARTITION BY series)")
def trim_partial_edges(spark, sf):
    return ts.trim_edges(daily(spark, sf), "series", "day")


@query("seasonal_profile", """WITH h AS (SELECT event_type, month(ts)::INTEGER AS m, (isodow(ts) - 1)::INTEGER AS d, hour(ts)::INTEGER AS h, round(value * 100)::BIGINT AS v FROM events)
SELECT event_type, 'month' AS unit, m AS phase, avg(v) AS y FROM h GROUP BY ALL UNION ALL SELECT event_type, 'weekday', d, avg(v) FROM h GROUP BY ALL
UNION ALL SELECT event_type, 'hour', h, avg(v) FROM h GROUP BY ALL""")
def seasonal_profile(spark, sf):
    e = _events(spark, sf).select("event_type", "v", F.month("ts").alias("month"), F.weekday("ts").alias("weekday"), F.hour("ts").alias("hour"))
    cells = e.groupBy("event_type", "month", "weekday", "hour").agg(F.sum("v").alias("s"), F.count("*").alias("n"))
    long = cells.unpivot(["event_type", "s", "n"], ["month", "weekday", "hour"], "unit", "phase")
    return long.groupBy("event_type", "unit", "phase").agg((F.sum("s").cast("double") / F.sum("n")).alias("y"))


DECOMP = f"""pos AS (SELECT series, day, y, (row_number() OVER w - 1) % 7 AS phase, CASE WHEN count(y) OVER f = 7 THEN sum(y) OVER f / 7 END AS trend FROM daily
  WINDOW w AS (PARTITION BY series ORDER BY day), f AS (PARTITION BY series ORDER BY day ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
ph AS (SELECT series, phase, avg(y - trend) AS m FROM pos GROUP BY 1, 2), ctr AS (SELECT series, avg(m) AS c FROM ph GROUP BY 1),
dec AS (SELECT pos.series, day, pos.phase::INTEGER AS phase, y, trend, m - c AS seasonal, y - trend - (m - c) AS resid FROM pos JOIN ph USING (series, phase) JOIN ctr USING (series))"""


@query("decompose_classical", f"WITH {DAILY}, {DECOMP} SELECT series, day, phase, y, trend, round(seasonal, 1) AS seasonal, round(resid, 1) AS resid FROM dec")
def decompose_classical(spark, sf):
    out = ts.decompose_classical(daily(spark, sf), "series", "day", "y", 7)
    return out.withColumns({c: F.round(c, 1) for c in ("seasonal", "resid")})


@query("decompose_classical_even", f"""WITH {DAILY}, pos AS (SELECT series, day, y, ((row_number() OVER w - 1) % 52)::INTEGER AS phase,
  CASE WHEN count(y) OVER f = 53 THEN (sum(y) OVER f - (lag(y, 26) OVER w + lead(y, 26) OVER w) / 2) / 52 END AS trend FROM daily
  WINDOW w AS (PARTITION BY series ORDER BY day), f AS (PARTITION BY series ORDER BY day ROWS BETWEEN 26 PRECEDING AND 26 FOLLOWING)),
ph AS (SELECT series, phase, avg(y / trend) AS m FROM pos GROUP BY 1, 2), ctr AS (SELECT series, avg(m) AS c FROM ph GROUP BY 1)
SELECT series, day, phase, trend, round(m / c, 8) AS seasonal, round(y / (trend * (m / c)), 8) AS resid FROM pos JOIN ph USING (series, phase) JOIN ctr USING (series)""")
def decompose_classical_even(spark, sf):
    """Even period, multiplicative."""
    out = ts.decompose_classical(daily(spark, sf), "series", "day", "y", 52, multiplicative=True).drop("y")
    return out.withColumns({c: F.round(c, 8) for c in ("seasonal", "resid")})


@query("decompose_robust", f"""WITH {DAILY}, p AS (SELECT series, day, y, ((row_number() OVER w - 1) % 7)::INTEGER AS phase, median(y) OVER f AS trend FROM daily
  WINDOW w AS (PARTITION BY series ORDER BY day), f AS (PARTITION BY series ORDER BY day ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
s AS (SELECT *, median(y - trend) OVER (PARTITION BY series, phase ORDER BY day ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS seasonal FROM p)
SELECT series, day, y, phase, trend, seasonal, y - trend - seasonal AS resid FROM s""")
def decompose_robust(spark, sf):
    return ts.decompose_robust(daily(spark, sf), "series", "day", "y", 7)


@query("decompose_local")
def decompose_local_query(spark, sf):
    """Season and trend by locally weighted regression, with robustness weights."""
    return decompose_local(daily(spark, sf), "series", "day", "y", 7)


@query("seasonal_profile_by_year", f"WITH {DAILY}, {DECOMP} SELECT series, year(day)::INTEGER AS year, (isodow(day) - 1)::INTEGER AS weekday, round(avg(seasonal), 1) AS seasonal FROM dec GROUP BY ALL")
def seasonal_profile_by_year(spark, sf):
    dec = ts.decompose_classical(daily(spark, sf), "series", "day", "y", 7)
    return dec.groupBy("series", F.year("day").alias("year"), F.weekday("day").alias("weekday")).agg(F.round(F.avg("seasonal"), 1).alias("seasonal"))


@query("difference", f"""WITH {DAILY}, a AS (SELECT *, y - lag(y, 1) OVER w AS d1, y - lag(y, 7) OVER w AS d7 FROM daily {W})
SELECT series, day, d1, d7, d1 - lag(d1, 7) OVER w AS d1_7 FROM a {W}""")
def difference(spark, sf):
    out = ts.difference(daily(spark, sf), "series", "day", "y", [1], "d1")
    out = ts.difference(out, "series", "day", "y", [7], "d7")
    return ts.difference(out, "series", "day", "y", [1, 7], "d1_7").drop("y")


@query("rolling_stats", f"""WITH {DAILY} SELECT series, day, CASE WHEN count(y) OVER f = 30 THEN avg(y) OVER f END AS roll_mean, round(CASE WHEN count(y) OVER f = 30 THEN stddev_samp(y) OVER f END, 2) AS roll_sd
FROM daily WINDOW f AS (PARTITION BY series ORDER BY day ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""")
def rolling_stats(spark, sf):
    return ts.rolling_stats(daily(spark, sf), "series", "day", "y", 30).select("series", "day", "roll_mean", F.round("roll_sd", 2).alias("roll_sd"))


@query("lag_features", f"WITH {DAILY}, l AS (SELECT series, y, " + ", ".join(f"lag(y, {k}) OVER w AS lag_{k}" for k in ts.LAGS) + f" FROM daily {W}) "
       + " UNION ALL ".join(f"SELECT series, 'lag_{k}' AS lag, round(corr(y, lag_{k}), 8) AS r FROM l GROUP BY 1" for k in ts.LAGS))
def lag_features(spark, sf):
    return ts.lag_correlations(daily(spark, sf), "series", "day", "y", ts.LAGS).withColumn("r", F.round("r", 8))


def _past_sql(windows=ts.WINDOWS) -> str:
    parts = []
    for n in windows:
        over = f"OVER (PARTITION BY series ORDER BY day ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
        for name, fn in (("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max")):
            value = f"CASE WHEN count(y) {over} = {n} THEN {fn}(y) {over} END"
            parts.append(f"round({value}, 2) AS roll{name}_{n}" if name == "std" else f"{value} AS roll{name}_{n}")
    return ", ".join(parts)


@query("rolling_past_features", f"WITH {DAILY} SELECT series, day, {_past_sql()} FROM daily")
def rolling_past_features(spark, sf):
    out = daily(spark, sf).select("series", "day", *ts.rolling_past_columns("series", "day", "y", ts.WINDOWS))
    return out.withColumns({c: F.round(c, 2) for c in ("rollstd_7", "rollstd_28")})


@query("leaky_vs_safe", f"""WITH {DAILY}, b AS (SELECT series, y, CASE WHEN count(y) OVER a = 7 THEN avg(y) OVER a END AS la, CASE WHEN count(y) OVER s = 7 THEN avg(y) OVER s END AS sa FROM daily
WINDOW a AS (PARTITION BY series ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), s AS (PARTITION BY series ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
SELECT series, round(corr(y, la), 8) AS leaky_r, round(corr(y, sa), 8) AS safe_r FROM b GROUP BY 1""")
def leaky_vs_safe(spark, sf):
    out = ts.leaky_vs_safe(daily(spark, sf), "series", "day", "y", 7)
    return out.select("series", F.round("leaky_r", 8).alias("leaky_r"), F.round("safe_r", 8).alias("safe_r"))


_CAL = "(isodow(day) - 1)::INTEGER AS dayofweek, month(day)::INTEGER AS month, (isodow(day) >= 6)::INTEGER AS is_weekend"
_T = "(row_number() OVER (PARTITION BY series ORDER BY day) - 1)::INTEGER AS t_index"


@query("calendar_features", f"WITH {DAILY} SELECT series, day, {_T}, {_CAL} FROM daily")
def calendar_features(spark, sf):
    return daily(spark, sf).select("series", "day", ts.time_index("series", "day").alias("t_index"), *ts.calendar_columns("day"))


_FOUR = ", ".join(f"round({fn}({2 * 3.141592653589793 * k!r}::DOUBLE * t_index / {float(p)!r}), 8) AS {fn}_{int(p)}_{k}" for p, n in ts.FOURIER for k in range(1, n + 1) for fn in ("sin", "cos"))


@query("fourier_features", f"WITH {DAILY}, t AS (SELECT series, day, {_T} FROM daily) SELECT series, day, {_FOUR} FROM t")
def fourier_features(spark, sf):
    t = daily(spark, sf).select("series", "day", ts.time_index("series", "day").alias("t"))
    out = t.select("series", "day", *ts.fourier_columns(F.col("t")))
    return out.withColumns({c: F.round(c, 8) for c in out.columns[2:]})


@query("feature_matrix", f"WITH {DAILY}, m AS (SELECT series, day, y, {_T}, " + ", ".join(f"lag(y, {k}) OVER w AS lag_{k}" for k in ts.LAGS)
       + f", {_past_sql()}, {_CAL} FROM daily {W}) SELECT *, {_FOUR} FROM m WHERE lag_365 IS NOT NULL")
def feature_matrix(spark, sf):
    out = ts.feature_matrix(daily(spark, sf), "series", "day", "y")
    return out.withColumns({c: F.round(c, 8) for c in out.columns if c[:3] in ("sin", "cos")} | {c: F.round(c, 2) for c in ("rollstd_7", "rollstd_28")})
