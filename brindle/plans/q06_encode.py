"""Category encodings."""

from __future__ import annotations

from pyspark.sql import functions as F

from brindle.operators import encode, splits
from brindle.plans.base import cents
from brindle.plans.q03_splits import h_sql
from brindle.plans.registry import query
from brindle.sources.files import table

# fixed values: lowest to highest order priority
PRIORITIES = ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_CASE = "CASE o_orderpriority " + " ".join(f"WHEN '{p}' THEN {i}" for i, p in enumerate(PRIORITIES)) + " ELSE -1 END"


def _bucket(column: str, m: int, seed: str = "bucket") -> str:
    return h_sql(f"'{column}=' || {column}", seed, m)


@query("encode_ordinal", f"SELECT o_orderkey, {_CASE} AS code FROM orders")
def encode_ordinal(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", encode.ordinal("o_orderpriority", PRIORITIES).alias("code"))


@query("encode_label", "SELECT p_partkey, p_brand, (dense_rank() OVER (ORDER BY p_brand) - 1)::INTEGER AS code FROM part")
def encode_label(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_brand")
    return encode.apply_label(part, encode.fit_label(part, "p_brand"), "p_brand")


@query("ordinal_signal", f"SELECT round(corr({_CASE}, o_totalprice), 8) AS r FROM orders")
def ordinal_signal(spark, sf):
    return table(spark, sf, "orders").agg(F.round(F.corr(encode.ordinal("o_orderpriority", PRIORITIES), "o_totalprice"), 8).alias("r"))


@query("encode_onehot", "SELECT c_custkey, " + ", ".join(f"""(c_mktsegment = '{s}')::INTEGER AS "c_mktsegment={s}" """ for s in SEGMENTS) + " FROM customer")
def encode_onehot(spark, sf):
    cust = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return encode.onehot(cust, "c_mktsegment", SEGMENTS).drop("c_mktsegment")


@query("encode_onehot_sparse", """SELECT p_partkey, (SELECT count(DISTINCT p_name) FROM part) AS width, (dense_rank() OVER (ORDER BY p_name) - 1)::INTEGER AS slot FROM part""")
def encode_onehot_sparse(spark, sf):
    """One-hot rows of a column with very many categories."""
    part = table(spark, sf, "part").select("p_partkey", "p_name")
    return encode.onehot_sparse(part, encode.fit_label(part, "p_name"), "p_name").drop("p_name")


@query("encode_hashing", "SELECT p_partkey, " + ", ".join(
    f"CASE WHEN {_bucket('p_brand', 8)} = {i} THEN CASE WHEN {_bucket('p_brand', 2, 'sign')} = 0 THEN 1 ELSE -1 END ELSE 0 END AS h{i}" for i in range(8)) + " FROM part")
def encode_hashing(spark, sf):
    return encode.hashing(table(spark, sf, "part").select("p_partkey", "p_brand"), "p_brand", 8).drop("p_brand")


@query("hash_collisions", " UNION ALL ".join(f"""SELECT {m} AS m, count(DISTINCT p_brand) AS categories, count(DISTINCT {_bucket('p_brand', m)}) AS buckets,
count(DISTINCT p_brand) - count(DISTINCT {_bucket('p_brand', m)}) AS collisions FROM part""" for m in (64, 8)))
def hash_collisions(spark, sf):
    return encode.hash_collisions(table(spark, sf, "part"), "p_brand", [64, 8])


@query("encode_target_oof", f"""WITH o AS (SELECT o_orderkey, o_orderpriority, {h_sql('o_orderkey', 0, 5)}::INTEGER AS fold, round(o_totalprice * 100)::BIGINT AS y FROM orders),
c AS (SELECT o_orderpriority, fold, sum(y) AS s, count(*) AS n FROM o GROUP BY 1, 2),
t AS (SELECT o_orderpriority, sum(s) AS s, sum(n) AS n FROM c GROUP BY 1)
SELECT o_orderkey, o_orderpriority, o.fold, y, (t.s - c.s)::DOUBLE / (t.n - c.n)::DOUBLE AS encoded FROM o JOIN c USING (o_orderpriority, fold) JOIN t USING (o_orderpriority)""")
def encode_target_oof(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", cents("o_totalprice").alias("y"))
    return encode.target_oof(splits.kfold(orders, ["o_orderkey"], 5), "o_orderpriority", "y", "fold")


@query("cardinality_cost", """SELECT 'p_brand' AS "column", count(DISTINCT p_brand) AS onehot_width, count(DISTINCT p_brand) * 16 AS embedding_params FROM part
UNION ALL SELECT 'p_name', count(DISTINCT p_name), count(DISTINCT p_name) * 16 FROM part""")
def cardinality_cost(spark, sf):
    return encode.cardinality_cost(table(spark, sf, "part"), ["p_brand", "p_name"])
