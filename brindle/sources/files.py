"""File sources and sinks: delimited text, parquet, JSON, whole documents, reusable caches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_csv_nulls(
    spark: SparkSession, path: str, schema: T.StructType | str, columns: Sequence[str] | None = None,
    sep: str = ";", null_marker: str = "?", header: bool = True,
) -> DataFrame:
    """Delimited file with an explicit schema, a null marker and an optional column subset."""
    df = spark.read.schema(schema).option("sep", sep).option("nullValue", null_marker).option("header", header).csv(path)
    return df.select(*columns) if columns else df


def parse_datetime(date_col: str, time_col: str, pattern: str = "dd/MM/yyyy HH:mm:ss") -> Column:
    """Timestamp from separate date and time texts; unparseable text gives null."""
    return F.try_to_timestamp(F.concat_ws(" ", F.col(date_col), F.col(time_col)), F.lit(pattern)).cast("timestamp_ntz")


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the whole output, optionally split into partition folders."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def read_json_catalog(spark: SparkSession, path: str, schema: T.StructType | str, array_file: bool = False) -> DataFrame:
    """Product objects: one per line (splittable), or files that each hold one JSON array."""
    return spark.read.schema(schema).option("multiLine", array_file).json(path)


def _page_writer(root: str):
    """Rows (task, key, text) in order of key: a file for each key in a folder of this attempt's own, which is named at the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, at = fs.FileSystem.from_uri(root if "://" in root else f"file://{root.removeprefix('file:')}")
        folder, out, last = "", None, None
        for b in batches:
            for task, key, text in zip(b.column("task").to_pylist(), b.column("key").to_pylist(), b.column("text").to_pylist()):
                if not folder:
                    folder = f"part-{task:05d}-{uuid.uuid4().hex}"
                    store.create_dir(f"{at}/{folder}", recursive=True)
                if out is None or key != last:
                    if out is not None:
                        out.close()
                    out, last = store.open_output_stream(f"{at}/{folder}/part-{task:05d}-key={'' if key is None else key}.txt", compression=None), key
                out.write(text + b"\n")
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([folder])], ["folder"])

    return run


def write_text_docs(df: DataFrame, key: str, text: str, path: str, tasks: int) -> list[str]:
    """Every text as a line of the file of its key, a whole number; the folders of the finished tasks, a file of each key in one of them.

    Files are written where the rows lie and stay there: Hadoop's local file system starts a process for the rights of each file it makes, and
    a committer that renames them one by one works on the driver.  A null text is an empty line; texts of the same key share a file.
    """
    rows = df.select(F.col(key).cast("bigint").alias("key"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    dealt = rows.repartition(tasks, "key").sortWithinPartitions("key").select(F.spark_partition_id().alias("task"), "key", "text")
    return [f"{path}/{r[0]}" for r in dealt.mapInArrow(_page_writer(path), "folder string").collect()]


def read_text_docs(spark: SparkSession, path: str | Sequence[str], plain: bool = False) -> DataFrame:
    """(name, path, text): every file of a folder, or of several, whole, named by its file name.

    Where all are `plain`, none compressed, files are read as bytes: the text reader sets up a job's settings anew for each of them.
    """
    paths = path if isinstance(path, str) else list(path)
    if plain:
        found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths).withColumn("value", F.col("content").cast("string"))
    else:
        found = spark.read.text(paths, wholetext=True, recursiveFileLookup=True)
    return found.select(
        F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("name"),
        F.col("_metadata.file_path").alias("path"),
        F.col("value").alias("text"),
    )


def exists(spark: SparkSession, path: str) -> bool:
    """True when the folder holds a finished write: the marker that the committer leaves last, on whatever store it lies."""
    jvm = spark.sparkContext._jvm
    marker = jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)


def csv_cache(spark: SparkSession, path: str, build: Callable[[], DataFrame], schema: T.StructType | str) -> DataFrame:
    """Derived table kept as CSV: built on the first call, read back afterwards."""
    if not exists(spark, path):
        build().write.mode("overwrite").option("header", True).csv(path)
    return spark.read.schema(schema).option("header", True).csv(path)


def save_dataset(df: DataFrame, root: str, name: str) -> str:
    """Persist a training set under a content-derived name and return its path.

    The name combines the row count with two order-free sums of row hashes, so the same rows always
    land in the same place.
    """
    row_hash = F.xxhash64(*[F.col(c) for c in df.columns])
    sig = df.agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum(row_hash.cast("decimal(38,0)")), F.lit(0)).alias("s"),
        F.coalesce(F.bit_xor(row_hash), F.lit(0)).alias("x"),
    ).select(F.md5(F.concat_ws("|", "n", "s", "x"))).first()[0]
    path = f"{root}/{name}-{sig}"
    if not exists(df.sparkSession, path):
        df.write.mode("overwrite").parquet(path)
    return path
