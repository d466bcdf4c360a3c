"""Shared scratch space, in the folder a cluster names in spark.checkpoint.dir; all executors must reach it."""

from __future__ import annotations

import atexit
import shutil
import uuid
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession, functions as F

_LOCAL: set[str] = set()


def scratch_root(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or where that is unset the warehouse folder, which a session's executors share as well."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    root = (named or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")
    return f"{root}/brindle/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the application's own root."""
    root = scratch_root(spark)
    if spark.sparkContext.master.startswith("local[") and urlparse(root).scheme in ("", "file"):
        if not _LOCAL:
            atexit.register(lambda: [shutil.rmtree(p, ignore_errors=True) for p in _LOCAL])
        _LOCAL.add(urlparse(root).path)
    return f"{root}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete all stages of this application.  A job calls it when its results are written."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and continue from the files, so a lost executor costs a re-read only."""
    path = scratch_path(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


PART_ROWS = 1_000_000  # rows of a partition that a model is trained on


def bounded(df: DataFrame, rows: int = PART_ROWS) -> DataFrame:
    """The rows in partitions of about `rows` at most: a file's bytes say little about the objects that its rows become."""
    sizes = df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count").alias("most"), F.sum("count").alias("all")).first()
    return df.repartition(-(-sizes["all"] // rows)) if (sizes["most"] or 0) > rows else df


def cut_small(df: DataFrame, rows: int = 200_000) -> DataFrame:
    """`cut_lineage`, and where the rows turn out to be few, joins bring them to the other side instead of shuffling that."""
    out = cut_lineage(df)
    return out.hint("broadcast") if out.count() <= rows else out
