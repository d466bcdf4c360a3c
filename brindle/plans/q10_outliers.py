"""Outlier rules on event values."""

from __future__ import annotations

from pyspark.sql import functions as F

from brindle.operators import outliers
from brindle.plans.registry import query
from brindle.sources.files import table

_Z = "z AS (SELECT event_id, value, (value - avg(value) OVER ()) / stddev_pop(value) OVER () AS z FROM events)"
_MAD = """md AS (SELECT median(value) AS med FROM events), mad AS (SELECT med, median(abs(value - med)) AS mad FROM events, md GROUP BY med),
mz AS (SELECT event_id, value, 0.6745 * (value - med) / mad AS mz FROM events, mad)"""


def _fence(column: str = "value", k: float = 1.5, name: str = "f", src: str = "events") -> str:
    return f"{name} AS (SELECT quantile_cont({column}, .25) AS q1, quantile_cont({column}, .75) AS q3 FROM {src})", f"({column} < q1 - {k} * (q3 - q1) OR {column} > q3 + {k} * (q3 - q1))"


_F, _OUT = _fence()


def _events(spark, sf):
    return table(spark, sf, "events").select("event_id", "value")


@query("outlier_threshold", "SELECT count(*) AS rows_before, count(*) FILTER (value > 150) AS dropped, count(*) FILTER (value <= 150) AS rows_after FROM events")
def outlier_threshold(spark, sf):
    return outliers.beyond_limit(_events(spark, sf), "value", 150.0)


@query("outlier_zscore", f"WITH {_Z} SELECT event_id, value, round(z, 6) AS z FROM z WHERE abs(z) > 3")
def outlier_zscore(spark, sf):
    return outliers.zscores(_events(spark, sf), "value").where(F.abs("z") > 3).withColumn("z", F.round("z", 6))


@query("outlier_iqr", f"WITH {_F} SELECT event_id, value FROM events, f WHERE {_OUT}")
def outlier_iqr(spark, sf):
    return outliers.outside_fences(_events(spark, sf), "value", 1.5)


@query("outlier_iqr_far", f"WITH {_F} SELECT event_id, value FROM events, f WHERE {_fence(k=3.0)[1]}")
def outlier_iqr_far(spark, sf):
    return outliers.outside_fences(_events(spark, sf), "value", 3.0)


@query("outlier_mad", f"WITH {_MAD} SELECT event_id, value, round(mz, 6) AS mz FROM mz WHERE abs(mz) > 3.5")
def outlier_mad(spark, sf):
    return outliers.modified_zscores(_events(spark, sf), "value").where(F.abs("mz") > 3.5).withColumn("mz", F.round("mz", 6))


@query("outlier_rule_counts", f"""WITH {_Z}, {_MAD}, {_F} SELECT 'zscore' AS rule, count(*) FILTER (abs(z) > 3) AS flagged FROM z
UNION ALL SELECT 'iqr', count(*) FILTER ({_OUT}) FROM events, f UNION ALL SELECT 'mad', count(*) FILTER (abs(mz) > 3.5) FROM mz""")
def outlier_rule_counts(spark, sf):
    return outliers.rule_counts(_events(spark, sf), "value")


@query("winsorize", """WITH l AS (SELECT quantile_cont(value, .01) AS lo, quantile_cont(value, .99) AS hi, max(value) AS top FROM events)
SELECT event_id, round(least(greatest(value, lo), hi), 6) AS clipped FROM events, l""")
def winsorize(spark, sf):
    return outliers.winsorize(_events(spark, sf), "value").select("event_id", F.round("clipped", 6).alias("clipped"))


_LF, _LOUT = _fence("lv", name="lf", src="l")


@query("outlier_after_log", f"""WITH l AS (SELECT ln(1 + value) AS lv FROM events), {_F}, {_LF}
SELECT (SELECT count(*) FROM events, f WHERE {_OUT}) AS before_log, (SELECT count(*) FROM l, lf WHERE {_LOUT}) AS after_log""")
def outlier_after_log(spark, sf):
    df = _events(spark, sf)
    before = outliers.outside_fences(df, "value").agg(F.count("*").alias("before_log"))
    after = outliers.outside_fences(df.select(F.log1p("value").alias("lv")), "lv").agg(F.count("*"))
    return before.withColumn("after_log", after.scalar())


@query("known_outlier_rate", "SELECT greatest(avg((value > 150)::INT), 0.001::DOUBLE) AS contamination FROM events")
def known_outlier_rate(spark, sf):
    return _events(spark, sf).agg(outliers.contamination(F.col("value") > 150).alias("contamination"))
