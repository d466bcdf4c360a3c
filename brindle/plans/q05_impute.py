"""Imputation.  Gaps come from documents without a label, or from values blanked by a fixed rule."""

from __future__ import annotations

from pyspark.sql import functions as F

from brindle.operators import impute, splits
from brindle.plans.q02_quality import LABELLED, labelled
from brindle.plans.q03_splits import h_sql
from brindle.plans.registry import query
from brindle.sources.files import table

TRAIN = f"{h_sql('event_id')} >= 2000"
GAPS = "gaps AS (SELECT event_id, user_id, CASE WHEN event_type <> 'error' THEN value END AS value FROM events)"


def gaps(spark, sf):
    """Readings of failed events count as missing."""
    return table(spark, sf, "events").select("event_id", "user_id", F.when(F.col("event_type") != "error", F.col("value")).alias("value"))


def _train(df):
    return df.where(~splits.in_test(["event_id"], 0.2))


@query("impute_constant", f"WITH {LABELLED} SELECT doc_id, coalesce(quality, 0) AS quality, coalesce(toxic, -1) AS toxic FROM labelled")
def impute_constant(spark, sf):
    return impute.impute_constant(labelled(spark, sf).select("doc_id", "quality", "toxic"), {"quality": 0, "toxic": -1})


@query("impute_median", f"WITH {GAPS}, m AS (SELECT median(value) AS med FROM gaps WHERE {TRAIN}) SELECT event_id, round(coalesce(value, med), 6) AS value FROM gaps, m")
def impute_median(spark, sf):
    df = gaps(spark, sf)
    out = impute.apply_fill(df.select("event_id", "value"), impute.fit_median(_train(df), ["value"]), ["value"])
    return out.withColumn("value", F.round("value", 6))


@query("impute_mode", f"""WITH {LABELLED}, m AS (SELECT quality AS q FROM labelled WHERE quality IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, quality LIMIT 1)
SELECT doc_id, coalesce(quality, q) AS quality FROM labelled, m""")
def impute_mode(spark, sf):
    df = labelled(spark, sf).select("doc_id", "quality")
    return impute.apply_fill(df, impute.fit_mode(df, "quality"), ["quality"])


@query("impute_with_indicator", f"""WITH {GAPS}, m AS (SELECT median(value) AS med FROM gaps WHERE {TRAIN})
SELECT event_id, round(coalesce(value, med), 6) AS value, (value IS NULL)::INTEGER AS value_missing FROM gaps, m""")
def impute_with_indicator(spark, sf):
    df = gaps(spark, sf)
    out = impute.apply_fill(df.select("event_id", "value"), impute.fit_median(_train(df), ["value"]), ["value"], indicator=True)
    return out.withColumn("value", F.round("value", 6))


PARTS = """parts AS (SELECT p_partkey, CASE WHEN p_brand <> 'Brand#3' THEN p_size END AS size, p_retailprice AS price,
  CASE WHEN p_type <> 'PROMO' THEN length(p_name) END AS name_length FROM part)"""


@query("impute_knn", f"""WITH {PARTS},
s AS (SELECT avg(size) AS m1, stddev_pop(size) AS s1, avg(price) AS m2, stddev_pop(price) AS s2, avg(name_length) AS m3, stddev_pop(name_length) AS s3 FROM parts),
z AS (SELECT p_partkey, (size - m1) / s1 AS a, (price - m2) / s2 AS b, (name_length - m3) / s3 AS c FROM parts, s),
d AS (SELECT q.p_partkey AS qid, x.p_partkey AS id, x.a, round(sqrt(CASE WHEN q.c IS NULL OR x.c IS NULL THEN (q.b - x.b) ** 2 * 2
  ELSE (q.b - x.b) ** 2 + (q.c - x.c) ** 2 END), 12) AS dist FROM z q, z x WHERE q.a IS NULL AND x.a IS NOT NULL),
k AS (SELECT qid, avg(a) AS a FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, id) AS rn FROM d) WHERE rn <= 5 GROUP BY 1)
SELECT p_partkey, round(coalesce(size::DOUBLE, k.a * s1 + m1), 6) AS size FROM parts LEFT JOIN k ON p_partkey = qid, s""")
def impute_knn(spark, sf):
    parts = table(spark, sf, "part").select(
        "p_partkey", F.when(F.col("p_brand") != "Brand#3", F.col("p_size")).alias("size"), F.col("p_retailprice").alias("price"),
        F.when(F.col("p_type") != "PROMO", F.length("p_name")).alias("name_length"))
    out = impute.impute_knn(parts, "p_partkey", "size", ["size", "price", "name_length"])
    return out.select("p_partkey", F.round("size", 6).alias("size"))
