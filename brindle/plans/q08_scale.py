"""Scaling: parameters from the training rows, applied to all."""

from __future__ import annotations

from pyspark.sql import functions as F

from brindle.operators import scale, splits
from brindle.plans.q03_splits import h_sql
from brindle.plans.registry import query
from brindle.sources.files import table

TRAIN = f"{h_sql('event_id')} >= 2500"
_P = f"""p AS (SELECT avg(value) AS m, stddev_pop(value) AS s, quantile_cont(value, .25) AS q1, median(value) AS med, quantile_cont(value, .75) AS q3,
  min(value) AS lo, max(value) AS hi FROM events WHERE {TRAIN})"""


def _inputs(spark, sf):
    df = table(spark, sf, "events").select("event_id", "value")
    return df, df.where(~splits.in_test(["event_id"], 0.25))


def _rounded(df, places=8):
    return df.withColumn("value", F.round("value", places))


@query("scale_zscore", f"WITH {_P} SELECT event_id, round((value - m) / s, 8) AS value, round(m, 6) AS mean, round(s, 6) AS sd FROM events, p")
def scale_zscore(spark, sf):
    df, train = _inputs(spark, sf)
    params = scale.fit_zscore(train, ["value"])
    out = _rounded(scale.apply_zscore(df, params, ["value"]))
    learned = params.select(F.struct(F.round("value_mean", 6).alias("mean"), F.round("value_sd", 6).alias("sd"))).scalar()
    return out.select("*", learned.alias("_l")).select("event_id", "value", "_l.mean", "_l.sd")


@query("scale_inverse", "SELECT event_id, round(value, 6) AS value FROM events")
def scale_inverse(spark, sf):
    df, train = _inputs(spark, sf)
    params = scale.fit_zscore(train, ["value"])
    return _rounded(scale.invert_zscore(scale.apply_zscore(df, params, ["value"]), params, ["value"]), 6)


@query("scale_robust", f"WITH {_P} SELECT event_id, round((value - med) / (q3 - q1), 8) AS value FROM events, p")
def scale_robust(spark, sf):
    df, train = _inputs(spark, sf)
    return _rounded(scale.apply_robust(df, scale.fit_robust(train, ["value"]), ["value"]))


@query("scale_minmax", f"WITH {_P} SELECT event_id, round((value - lo) / (hi - lo), 8) AS value FROM events, p")
def scale_minmax(spark, sf):
    df, train = _inputs(spark, sf)
    return _rounded(scale.apply_minmax(df, scale.fit_minmax(train, ["value"]), ["value"]))


_ROW = "l_quantity, l_discount, l_tax"


@query("normalize_rows", " UNION ALL ".join(f"""SELECT '{n}' AS norm, l_orderkey, l_linenumber, round(l_quantity / d, 8) AS l_quantity, round(l_discount / d, 8) AS l_discount,
round(l_tax / d, 8) AS l_tax FROM (SELECT *, {d} AS d FROM lineitem)""" for n, d in (
    ("l2", "sqrt(l_quantity ** 2 + l_discount ** 2 + l_tax ** 2)"), ("l1", "abs(l_quantity) + abs(l_discount) + abs(l_tax)"), ("max", "greatest(abs(l_quantity), abs(l_discount), abs(l_tax))"))))
def normalize_rows(spark, sf):
    cols = ["l_quantity", "l_discount", "l_tax"]
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *cols)
    parts = [scale.normalize_rows(df, cols, n).withColumns({c: F.round(c, 8) for c in cols}).withColumn("norm", F.lit(n)) for n in ("l2", "l1", "max")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("outlier_effect", """WITH p AS (SELECT avg(value) AS m, stddev_pop(value) AS s, quantile_cont(value, .25) AS q1, median(value) AS med, quantile_cont(value, .75) AS q3,
  min(value) AS lo, max(value) AS hi, stddev_pop(value) FILTER (value < 100) AS b FROM events)
SELECT 'raw' AS scaler, round(hi - lo, 6) AS "range", round(b, 6) AS bulk_sd FROM p UNION ALL SELECT 'zscore', round((hi - lo) / s, 6), round(b / s, 6) FROM p
UNION ALL SELECT 'minmax', 1.0, round(b / (hi - lo), 6) FROM p UNION ALL SELECT 'robust', round((hi - lo) / (q3 - q1), 6), round(b / (q3 - q1), 6) FROM p""")
def outlier_effect(spark, sf):
    out = scale.spread_under_scalers(table(spark, sf, "events"), "value", 100.0)
    return out.select("scaler", F.round("range", 6).alias("range"), F.round("bulk_sd", 6).alias("bulk_sd"))
