"""Transformations and bins."""

from __future__ import annotations

from pyspark.sql import functions as F

from brindle.functions.expr import ratio
from brindle.operators import quality, transform
from brindle.plans import q11_featurestore as q11
from brindle.plans.registry import query
from brindle.sources.files import table

_EDGES = "e AS (SELECT " + ", ".join(f"quantile_cont(value, {i / 4}) AS e{i}" for i in range(5)) + " FROM events)"


def _events(spark, sf):
    return table(spark, sf, "events").select("event_id", "value")


@query("log_transform", "SELECT event_id, round(ln(1 + value), 8) AS logged, round(exp(ln(1 + value)) - 1, 6) AS restored FROM events")
def log_transform(spark, sf):
    return _events(spark, sf).select("event_id", F.round(F.log1p("value"), 8).alias("logged"), F.round(F.expm1(F.log1p("value")), 6).alias("restored"))


@query("log_transform_skew", """WITH l AS (SELECT value, ln(1 + value) AS lv FROM events),
p AS (SELECT avg(value) AS m, stddev_pop(value) AS s, avg(lv) AS lm, stddev_pop(lv) AS ls FROM l)
SELECT round(avg(((value - m) / s) ** 3), 6) AS skew_before, round(avg(((lv - lm) / ls) ** 3), 6) AS skew_after FROM l, p""")
def log_transform_skew(spark, sf):
    v = F.col("value")
    return _events(spark, sf).agg(F.round(quality.population_skew(v), 6).alias("skew_before"), F.round(quality.population_skew(F.log1p(v)), 6).alias("skew_after"))


def _power_sql(shape: str, jac: str) -> str:
    return f"""WITH g AS (SELECT range / 100.0::DOUBLE AS lam FROM range(-200, 201)),
v AS (SELECT event_id, value - 30 AS x, value AS p FROM events),
t AS (SELECT lam, {shape} AS y, {jac} AS j FROM v, g),
l AS (SELECT lam, -0.5 * count(*) * ln(var_pop(y)) + (lam - 1) * sum(j) AS ll FROM t GROUP BY lam),
b AS (SELECT lam FROM l ORDER BY ll DESC LIMIT 1),
w AS (SELECT event_id, lam, {shape} AS y FROM v, b), s AS (SELECT avg(y) AS m, stddev_pop(y) AS sd FROM w)
SELECT event_id, lam AS lambda, round((y - m) / sd, 6) AS transformed FROM w, s"""


@query("box_cox", _power_sql("CASE WHEN lam = 0 THEN ln(p) ELSE (p ** lam - 1) / lam END", "ln(p)"))
def box_cox(spark, sf):
    df = _events(spark, sf)
    lam = transform.fit_power(df, "value", "box-cox")
    out = transform.apply_power(df, "value", lam, "box-cox")
    return out.select("event_id", F.lit(lam).alias("lambda"), F.round("transformed", 6).alias("transformed"))


@query("yeo_johnson", _power_sql("""CASE WHEN x >= 0 AND lam = 0 THEN ln(1 + x) WHEN x >= 0 THEN ((x + 1) ** lam - 1) / lam
  WHEN lam = 2 THEN -ln(1 - x) ELSE -((1 - x) ** (2 - lam) - 1) / (2 - lam) END""", "sign(x) * ln(1 + abs(x))"))
def yeo_johnson(spark, sf):
    """Values shifted below zero, which the first power family cannot take."""
    df = _events(spark, sf).select("event_id", (F.col("value") - 30).alias("value"))
    lam = transform.fit_power(df, "value", "yeo-johnson")
    out = transform.apply_power(df, "value", lam, "yeo-johnson")
    return out.select("event_id", F.lit(lam).alias("lambda"), F.round("transformed", 6).alias("transformed"))


@query("bin_decade_age", "SELECT o_orderkey, (year(o_orderdate) // 10 * 10)::INTEGER AS decade, (2010 - year(o_orderdate))::INTEGER AS age FROM orders")
def bin_decade_age(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", *transform.bin_decade_age(F.year("o_orderdate"), 2010))


@query("bin_quantile", f"WITH {_EDGES} SELECT ((value > e1)::INT + (value > e2)::INT + (value > e3)::INT) AS bin, count(*) AS n, min(value) AS low, max(value) AS high FROM events, e GROUP BY 1")
def bin_quantile(spark, sf):
    df = _events(spark, sf)
    binned = transform.bin_right_closed(df, transform.quantile_edges(df, "value", 4), "value", 4)
    return binned.groupBy("bin").agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))


@query("bin_uniform", "WITH l AS (SELECT min(value) AS lo, max(value) AS hi FROM events) SELECT event_id, least(floor((value - lo) * 5 / (hi - lo)), 4)::INTEGER AS bin FROM events, l")
def bin_uniform(spark, sf):
    return transform.bin_uniform(_events(spark, sf), "value", 5).select("event_id", "bin")


@query("bin_quantile_index", f"WITH {_EDGES} SELECT event_id, ((value >= e1)::INT + (value >= e2)::INT + (value >= e3)::INT) AS bin FROM events, e")
def bin_quantile_index(spark, sf):
    df = _events(spark, sf)
    return transform.bin_left_closed(df, transform.quantile_edges(df, "value", 4), "value", 4).select("event_id", "bin")


@query("derived_ratio", f"WITH {q11.HISTORY} SELECT user_id, event_timestamp, CASE WHEN clicks <> 0 THEN purchases::DOUBLE / clicks::DOUBLE END AS rate FROM history")
def derived_ratio(spark, sf):
    return q11.history(spark, sf).select("user_id", "event_timestamp", ratio(F.col("purchases"), F.col("clicks")).alias("rate"))
