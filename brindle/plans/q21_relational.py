"""Plain table operations: dropping, casting, looking up, sorting, pivoting."""

from __future__ import annotations

from pyspark.sql import functions as F

from brindle.operators import quality, relational
from brindle.plans.base import cents
from brindle.plans.q02_quality import LABELLED, labelled
from brindle.plans.registry import query
from brindle.sources.files import table


@query("drop_null_rows", f"WITH {LABELLED} SELECT doc_id, quality, toxic FROM labelled WHERE quality IS NOT NULL AND toxic IS NOT NULL")
def drop_null_rows(spark, sf):
    return labelled(spark, sf).select("doc_id", "quality", "toxic").na.drop(subset=["quality", "toxic"])


@query("project_cast_rename", "SELECT p_partkey AS part_id, p_size::BIGINT AS size, p_retailprice::FLOAT AS retail_price, p_brand AS brand FROM part")
def project_cast_rename(spark, sf):
    return relational.project(table(spark, sf, "part"), {"part_id": ("p_partkey", "bigint"), "size": ("p_size", "bigint"),
                              "retail_price": ("p_retailprice", "float"), "brand": ("p_brand", "string")})


@query("group_mean_lookup", """WITH g AS (SELECT o_custkey, avg(round(o_totalprice * 100)::BIGINT) AS m FROM orders GROUP BY 1)
SELECT c_custkey, m AS mean_cents FROM customer LEFT JOIN g ON c_custkey = o_custkey""")
def group_mean_lookup(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), cents("o_totalprice").alias("price"))
    out = relational.group_mean_lookup(orders, "c_custkey", "price", table(spark, sf, "customer").select("c_custkey"))
    return out.withColumnRenamed("mean", "mean_cents")


@query("sort_top_n", "SELECT event_id, value FROM events ORDER BY value DESC, event_id LIMIT 6")
def sort_top_n(spark, sf):
    return table(spark, sf, "events").select("event_id", "value").orderBy(F.desc("value"), "event_id").limit(6)


@query("union_rows", "SELECT c_custkey AS key, c_acctbal AS balance, 'customer' AS kind FROM customer UNION ALL SELECT s_suppkey, s_acctbal, 'supplier' FROM supplier")
def union_rows(spark, sf):
    a = table(spark, sf, "customer").selectExpr("c_custkey AS key", "c_acctbal AS balance", "'customer' AS kind")
    b = table(spark, sf, "supplier").selectExpr("'supplier' AS kind", "s_suppkey AS key", "s_acctbal AS balance")
    return a.unionByName(b)


@query("pivot_metrics", """SELECT lang, avg(n_chars) FILTER (quality = 0) AS quality_0, avg(n_chars) FILTER (quality = 1) AS quality_1
FROM documents JOIN labels USING (doc_id) GROUP BY 1""")
def pivot_metrics(spark, sf):
    joined = table(spark, sf, "documents").select("doc_id", "lang", "n_chars").join(table(spark, sf, "labels"), "doc_id")
    long = joined.groupBy("lang", "quality").agg(F.avg("n_chars").alias("v"))
    return relational.pivot_metrics(long, "lang", "quality", [0, 1], "v", "quality_")


@query("column_set_difference", "SELECT 'o_shipmode' AS \"column\", count(*) AS checked_rows FROM orders")
def column_set_difference(spark, sf):
    orders = table(spark, sf, "orders")
    missing = quality.column_set_difference(orders, ["o_orderkey", "o_custkey", "o_shipmode"])
    return missing.withColumn("checked_rows", orders.agg(F.count("*")).scalar())


@query("string_normalize_route", """SELECT conv_id, turn, CASE WHEN ends_with(s, '?') THEN upper(s) WHEN ends_with(s, '.') THEN replace(s, '.', '!') ELSE s END AS normalized,
CASE WHEN ends_with(s, '?') THEN 'question' WHEN ends_with(s, '.') THEN 'statement' ELSE 'other' END AS route FROM (SELECT conv_id, turn, lower(trim(text, ' ')) AS s FROM conversations)""")
def string_normalize_route(spark, sf):
    return relational.normalize_and_route(table(spark, sf, "conversations"), "text").select("conv_id", "turn", "normalized", "route")


@query("json_encode_row", """SELECT p_partkey, '{"name":"' || p_name || '","brand":"' || p_brand || '","size":' || p_size || '}' AS payload, p_brand AS brand_back FROM part""")
def json_encode_row(spark, sf):
    out = table(spark, sf, "part").select("p_partkey", F.to_json(F.struct(F.col("p_name").alias("name"), F.col("p_brand").alias("brand"), F.col("p_size").alias("size"))).alias("payload"))
    return out.withColumn("brand_back", F.get_json_object("payload", "$.brand"))


@query("json_read_field", "SELECT event_id, (props->>'$.k')::INTEGER AS k FROM events")
def json_read_field(spark, sf):
    return table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))
