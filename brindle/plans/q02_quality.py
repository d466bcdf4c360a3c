"""Profiling and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from brindle.operators import quality
from brindle.plans import q11_featurestore as q11
from brindle.plans.registry import query
from brindle.sources.files import table


def labelled(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    return docs.select("doc_id", "lang", "source", "n_chars").join(labels, "doc_id", "left")


LABELLED = "labelled AS (SELECT d.doc_id, lang, source, n_chars, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"


@query("null_counts", f"""WITH {LABELLED} SELECT * FROM (
SELECT 'quality' AS "column", count(*) FILTER (quality IS NULL) AS nulls FROM labelled
UNION ALL SELECT 'toxic', count(*) FILTER (toxic IS NULL) FROM labelled
UNION ALL SELECT 'lang', count(*) FILTER (lang IS NULL) FROM labelled
UNION ALL SELECT 'n_chars', count(*) FILTER (n_chars IS NULL) FROM labelled) WHERE nulls > 0""")
def null_counts(spark, sf):
    return quality.null_counts(labelled(spark, sf))


_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("describe_columns", " UNION ALL ".join(f"""SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS "std",
round(min({c}), 4) AS "min", round(quantile_cont({c}, .25), 4) AS q25, round(quantile_cont({c}, .5), 4) AS q50, round(quantile_cont({c}, .75), 4) AS q75,
round(max({c}), 4) AS "max" FROM lineitem""" for c in _NUM))
def describe_columns(spark, sf):
    out = quality.describe_columns(table(spark, sf, "lineitem"), _NUM)
    return out.select("column", "count", *[F.round(c, 4).alias(c) for c in out.columns if c not in ("column", "count")])


@query("variance_by_column", " UNION ALL ".join(f"""SELECT '{c}' AS "column", round(var_samp({c}), 4) AS variance FROM lineitem""" for c in _NUM))
def variance_by_column(spark, sf):
    return quality.variance_by_column(table(spark, sf, "lineitem"), _NUM).withColumn("variance", F.round("variance", 4))


SKEW_SQL = "round(avg(power(({x} - m), 3)) / power(any_value(s), 3), 6)"


@query("population_skew", """WITH p AS (SELECT event_type, avg(value) AS m, stddev_pop(value) AS s FROM events GROUP BY 1)
SELECT event_type, round(avg(power(value - m, 3)) / power(any_value(s), 3), 6) AS skew FROM events JOIN p USING (event_type) GROUP BY 1""")
def population_skew(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(F.round(quality.population_skew(F.col("value")), 6).alias("skew"))


@query("value_frequencies", "SELECT source, count(*) AS n FROM documents GROUP BY 1")
def value_frequencies(spark, sf):
    return quality.value_frequencies(table(spark, sf, "documents"), "source").orderBy(F.desc("n"), "source")


@query("matrix_density", """SELECT sum((l_discount <> 0)::INT + (l_tax <> 0)::INT + (l_returnflag = 'A')::INT + (l_returnflag = 'N')::INT)::BIGINT AS nonzero,
count(*) AS n_rows, round(sum((l_discount <> 0)::INT + (l_tax <> 0)::INT + (l_returnflag = 'A')::INT + (l_returnflag = 'N')::INT) / (count(*) * 4.0), 9)::DOUBLE AS density FROM lineitem""")
def matrix_density(spark, sf):
    wide = table(spark, sf, "lineitem").select("l_discount", "l_tax", (F.col("l_returnflag") == "A").cast("int").alias("a"), (F.col("l_returnflag") == "N").cast("int").alias("n"))
    return quality.matrix_density(wide, wide.columns).withColumn("density", F.round("density", 9))


@query("validate_table", """WITH f AS (SELECT count(*) AS n, count(o_custkey) - count(DISTINCT o_custkey) AS rep, count(*) FILTER (o_custkey IS NULL) AS nk,
  count(*) FILTER (o_orderdate IS NULL) AS nt FROM orders)
SELECT r AS rule, v AS violations, n AS n_rows, 6::INTEGER AS n_columns, v = 0 AS passed FROM (
SELECT n, unnest(['columns_present', 'not_empty', 'key_unique', 'no_null_o_custkey', 'no_null_o_orderdate']) AS r,
  unnest([1::BIGINT, (n = 0)::BIGINT, rep, nk, nt]) AS v FROM f)""")
def validate_table(spark, sf):
    """A gate that must fail twice: a column that is not there and a key that repeats."""
    return quality.validate_table(table(spark, sf, "orders"), ["o_orderkey", "o_custkey", "o_shipmode"], "o_custkey", ["o_orderdate"])


@query("order_asserts", f"""WITH {q11.HISTORY}, s AS (SELECT clicks < lag(clicks) OVER w AS a, conversion_rate < lag(conversion_rate) OVER w AS b FROM history
  WINDOW w AS (PARTITION BY user_id ORDER BY event_timestamp))
SELECT 'clicks' AS "column", count(*) FILTER (a) AS violations FROM s UNION ALL SELECT 'conversion_rate', count(*) FILTER (b) FROM s""")
def order_asserts(spark, sf):
    return quality.order_violations(q11.history(spark, sf), "user_id", "event_timestamp", ["clicks", "conversion_rate"])
