"""Streaming forms of snapshot materialization and resampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from brindle.operators.featurestore import FeatureView, merge_snapshot, newest_per_entity
from brindle.sources.scratch import cut_lineage, scratch_path


class SnapshotSink:
    """Newest row per entity, in buckets by a hash of the entity; a micro-batch rewrites only the buckets that it touches.

    A batch writes those buckets below a folder of its own number and is published by one manifest, which says for each bucket the
    batch that holds it.  A manifest is written under another name and renamed, so a batch that dies leaves the one before as it was;
    when it runs again it starts from there and writes its folder anew, and nothing is applied twice.  State is found on disk, so a
    new process goes on where the last one stopped.  What neither of the last two manifests names is deleted.
    """

    def __init__(self, spark: SparkSession, view: FeatureView, root: str, schema, buckets: int = 64):
        self.spark, self.view, self.root, self.schema, self.buckets = spark, view, root, schema, buckets

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), at

    def _numbers(self, folder: str, prefix: str) -> list[int]:
        fs, at = self._fs(f"{self.root}/{folder}")
        names = [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []
        return sorted(int(n.removeprefix(prefix)) for n in names if n.removeprefix(prefix).isdigit())

    def batches(self) -> list[int]:
        """Numbers of the published batches that are kept."""
        return self._numbers("manifest", "batch=")

    def manifest(self, batch: int | None = None) -> dict[int, int]:
        """Bucket → batch that holds it, as of the last published batch (before the one given)."""
        done = [n for n in self.batches() if batch is None or n < batch]
        if not done:
            return {}
        text = self.spark.read.text(f"{self.root}/manifest/batch={done[-1]:08d}").collect()  # a line a bucket
        return dict(tuple(map(int, r[0].split())) for r in text)

    def _publish(self, batch: int, held: dict[int, int]) -> None:
        fs, hidden = self._fs(f"{self.root}/manifest/_batch={batch:08d}")
        _, name = self._fs(f"{self.root}/manifest/batch={batch:08d}")
        out = fs.create(hidden, True)
        out.write(bytearray("".join(f"{k} {v}\n" for k, v in sorted(held.items())), "ascii"))
        out.close()
        fs.delete(name, False)  # of the same batch, where it runs once more
        if not fs.rename(hidden, name):
            raise OSError(f"batch {batch} could not be published")

    def rows(self, held: dict[int, int]) -> DataFrame:
        if not held:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.root}/data/batch={v:08d}/bucket={k}" for k, v in sorted(held.items())])

    def read(self) -> DataFrame:
        return self.rows(self.manifest())

    def __call__(self, delta: DataFrame, batch: int) -> None:
        bucket = F.pmod(F.xxhash64(self.view.entity), F.lit(self.buckets)).cast("int")
        newest = cut_lineage(newest_per_entity(delta, self.view).select(*[f.name for f in self.schema]))
        touched = sorted(r[0] for r in newest.select(bucket.alias("b")).distinct().collect())  # at most one row a bucket
        held = self.manifest(batch)
        if touched:
            merged = merge_snapshot(self.rows({k: v for k, v in held.items() if k in touched}), newest, self.view).withColumn("bucket", bucket)
            merged.repartition(len(touched), "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/data/batch={batch:08d}")
        self._publish(batch, held | dict.fromkeys(touched, batch))
        for old in self.batches()[:-2]:
            fs, at = self._fs(f"{self.root}/manifest/batch={old:08d}")
            fs.delete(at, False)
        used = {v for n in self.batches() for v in self.manifest(n + 1).values()}
        for old in self._numbers("data", "batch="):
            if old not in used and old < batch:
                fs, at = self._fs(f"{self.root}/data/batch={old:08d}")
                fs.delete(at, True)


def stream_materialize(spark: SparkSession, source: str, schema, view: FeatureView, files_per_batch: int = 2, snapshot: str | None = None, offsets: str | None = None) -> DataFrame:
    """Run over all history files there are, batch by batch, and return the newest snapshot.

    Give `snapshot` and `offsets`, folders that outlive the job, and the next call reads only files that came since; without them
    the run starts from nothing.
    """
    sink = SnapshotSink(spark, view, snapshot or scratch_path(spark, "snapshot"), schema)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    query = stream.writeStream.foreachBatch(sink).option("checkpointLocation", offsets or scratch_path(spark, "offsets")).trigger(availableNow=True).start()
    query.awaitTermination()
    return sink.read()


def stream_resample(spark: SparkSession, source: str, schema, ts: str, key: str, value: str, window: str = "1 hour", delay: str = "2 hours",
                    target: str | None = None, offsets: str | None = None) -> DataFrame:
    """Mean per event-time window; only windows the watermark has passed are written.  Lasting folders let it resume."""
    out = target or scratch_path(spark, "windows")
    # watermarks need a zoned timestamp; the session's zone is used both ways
    stream = spark.readStream.schema(schema).parquet(source).withColumn(ts, F.col(ts).cast("timestamp"))
    means = (
        stream.withWatermark(ts, delay).groupBy(F.window(ts, window).alias("w"), key).agg(F.avg(value).alias("y"), F.count("*").alias("n"))
        .select(key, F.col("w.start").cast("timestamp_ntz").alias("ts"), "y", "n")
    )
    query = means.writeStream.format("parquet").option("path", out).option("checkpointLocation", offsets or scratch_path(spark, "offsets")).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(means.schema).parquet(out)
