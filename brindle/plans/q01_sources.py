"""Sources and sinks: each query writes the given tables out, reads them back and returns what it read."""

from __future__ import annotations

from pyspark.sql import functions as F

from brindle.plans import base
from brindle.plans.registry import query
from brindle.sources import files
from brindle.sources.files import table
from brindle.sources.scratch import scratch_path

FILES_A_TASK = 500
_CSV_SCHEMA = "order_id bigint, day_text string, time_text string, price double, status string"


def _csv(spark, sf):
    """Orders as a semicolon file with '?' for the missing prices of low-priority orders."""
    path = scratch_path(spark, "orders-csv")
    table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.date_format("o_orderdate", "dd/MM/yyyy").alias("day_text"),
        F.date_format("o_orderdate", "HH:mm:ss").alias("time_text"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")).alias("price"), F.col("o_orderstatus").alias("status"),
    ).write.option("sep", ";").option("nullValue", "?").option("header", True).csv(path)
    return path


@query("read_csv_nulls", "SELECT o_orderkey AS order_id, CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS price FROM orders")
def read_csv_nulls(spark, sf):
    return files.read_csv_nulls(spark, _csv(spark, sf), _CSV_SCHEMA, ["order_id", "price"])


@query("parse_datetime_cols", "SELECT o_orderkey AS order_id, o_orderdate AS ts FROM orders")
def parse_datetime_cols(spark, sf):
    raw = files.read_csv_nulls(spark, _csv(spark, sf), _CSV_SCHEMA, ["order_id", "day_text", "time_text"])
    return raw.select("order_id", files.parse_datetime("day_text", "time_text").alias("ts"))


@query("read_write_parquet", "SELECT event_id, user_id, CAST(ts AS DATE) AS day, value FROM events WHERE ts >= '2024-01-10' AND ts < '2024-01-20'")
def read_write_parquet(spark, sf):
    """Partitioned by day on write, pruned by day on read."""
    path = scratch_path(spark, "events")
    src = table(spark, sf, "events").select("event_id", "user_id", F.to_date("ts").alias("day"), "value")
    files.write_parquet(src, path, ["day"])
    back = spark.read.schema(src.schema).parquet(path)
    return back.where("day >= date'2024-01-10' AND day < date'2024-01-20'")


@query("read_json_catalog", "SELECT p_partkey AS sku, p_name AS name, p_type AS category, p_retailprice AS price FROM part")
def read_json_catalog(spark, sf):
    path = scratch_path(spark, "catalog")
    table(spark, sf, "part").selectExpr("p_partkey AS sku", "p_name AS name", "p_type AS category", "p_retailprice AS price").write.json(path)
    return files.read_json_catalog(spark, path, "sku bigint, name string, category string, price double")


@query("read_text_docs", "SELECT page_id, length(html)::BIGINT AS n_chars, md5(html) AS digest FROM pages")
def read_text_docs(spark, sf):
    """Every page written as a file of its own and read back whole."""
    path = scratch_path(spark, "pages")
    pages = table(spark, sf, "pages").select("page_id", "html")
    # a file costs the same however small: tasks are dealt by their number of files, and small ones must not be put together
    tasks = max(4 * spark.sparkContext.defaultParallelism, -(-pages.count() // FILES_A_TASK))
    folders = files.write_text_docs(pages, "page_id", "html", path, tasks)
    if not folders:
        return pages.select("page_id", F.length("html").cast("bigint").alias("n_chars"), F.md5("html").alias("digest"))
    # each page is a line of its file
    docs = files.read_text_docs(spark, folders, plain=True).withColumn("text", F.regexp_replace("text", r"\n\z", ""))
    docs = docs.coalesce(tasks)  # a scan deals few small files to a task, and each task's result is a file again
    return docs.select(
        F.nullif(F.regexp_extract("name", r"key=(-?\d*)\.txt", 1), F.lit("")).cast("bigint").alias("page_id"),
        F.length("text").cast("bigint").alias("n_chars"), F.md5("text").alias("digest"))


@query("write_csv_cache", f"WITH {base.GAPPY} SELECT series, day, y FROM gappy")
def write_csv_cache(spark, sf):
    """The second call finds the files of the first and does not derive the table again."""
    path, schema = scratch_path(spark, "daily-cache"), "series string, day date, y double"
    files.csv_cache(spark, path, lambda: base.gappy(spark, sf), schema)
    return files.csv_cache(spark, path, lambda: base.gappy(spark, sf).where("false"), schema)


@query("saved_dataset", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def saved_dataset(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return spark.read.schema(df.schema).parquet(files.save_dataset(df, scratch_path(spark, "datasets"), "orders"))
