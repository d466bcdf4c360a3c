"""Helpers of the training-data operators: row identity, inputs, Arrow batches, stage tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from brindle.sources.scratch import scratch_path

#: A word: a run of characters other than the six ASCII blanks.  Fixed value.
WORD = r"[^\x20\x09-\x0D]+"
#: The blanks between words.  Fixed value.
BLANKS = " \t\n\x0b\f\r"


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write the rows to the folder all executors share and go on from the files."""
    path = scratch_path(df.sparkSession, f"llm-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD.replace("\\x20", " ")), F.lit(0))


def row_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """Identity of a row: its id and a hash of its text, so rows that share an id but not a text stay apart."""
    return [F.col(doc_id).alias("k_id"), F.xxhash64(text_of(text)).alias("k_text")]


SLICE_BYTES = 2 << 20  # Arrow bytes that are Python objects at a time


def slices(batch: pa.RecordBatch, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about so many bytes; a row is never cut."""
    rows = max(1, batch.num_rows * limit // max(batch.nbytes, 1))
    for start in range(0, batch.num_rows, rows):
        part = batch.slice(start, rows)
        # a run of long texts among short ones is cut again
        if part.num_rows > 1 and part.nbytes > 2 * limit:
            half = part.num_rows // 2
            yield from slices(part.slice(0, half), limit)
            yield from slices(part.slice(half), limit)
        else:
            yield part


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table | None], schema: str, forget: Callable[[], None] | None = None) -> DataFrame:
    """Apply a function to each Arrow batch, a bounded number of bytes at a time.

    Workers outlive their tasks; `forget` is called at the end of a partition, so that an idle one holds no caches.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                made = fn(part)
                if made is not None and made.num_rows:
                    yield from made.to_batches() if isinstance(made, pa.Table) else [made]
        if forget is not None:
            forget()

    return df.mapInArrow(run, schema)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return ["" if x is None else x for x in batch.column(column).to_pylist()]


HOT = 1000  # a key with more than this part of all rows is looked up by broadcast; there are fewer than HOT such keys


def lookup(rows: DataFrame, table: DataFrame, keys: list[str], n: str) -> DataFrame:
    """Left join with a table of one row a key, whose column `n` (dropped) says how many of the rows have it.

    Rows of a frequent key would meet in one task.  At most HOT keys can hold a HOT-th of all rows each, so these are broadcast, and
    only the others are shuffled.
    """
    total = table.agg(F.coalesce(F.sum(n), F.lit(0)).alias("total")).scalar()
    hot = table.where(F.col(n) * HOT > total).drop(n)
    rest = table.where(F.col(n) * HOT <= total).drop(n)
    values = [c for c in hot.columns if c not in keys]
    found = rows.join(F.broadcast(hot.withColumn("_hot", F.lit(True)).withColumnsRenamed({v: f"_hot_{v}" for v in values})), keys, "left")
    # a row that was found goes to a place of its own in the shuffle
    cold = found.where("_hot IS NULL").drop("_hot", *[f"_hot_{v}" for v in values]).join(rest, keys, "left")
    done = found.where("_hot").drop("_hot").withColumnsRenamed({f"_hot_{v}": v for v in values})
    return cold.unionByName(done)
