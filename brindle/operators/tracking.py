"""Experiment runs and model versions as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

RUN_SCHEMA = "run_id string, experiment string, params map<string,string>, metrics map<string,double>, tags map<string,string>"


def run_rows(df: DataFrame, experiment: str, params: Sequence[str], metrics: Sequence[str], tags: dict[str, str] | None = None) -> DataFrame:
    """One run per row; its id is a digest of experiment and parameters, so logging twice gives the same id."""
    as_map = lambda names, kind: F.create_map(*[x for n in names for x in (F.lit(n), F.col(n).cast(kind))])
    tag_map = F.create_map(*[F.lit(x) for pair in (tags or {}).items() for x in pair]).cast("map<string,string>")
    run_id = F.md5(F.concat_ws("|", F.lit(experiment), *[F.col(p).cast("string") for p in params]))
    return df.select(run_id.alias("run_id"), F.lit(experiment).alias("experiment"), as_map(params, "string").alias("params"), as_map(metrics, "double").alias("metrics"), tag_map.alias("tags"))


def log_runs(runs: DataFrame, path: str) -> None:
    runs.write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(path)


def epoch_metrics(df: DataFrame, run: Column, step: Column, values: Sequence[str]) -> DataFrame:
    """Long table (run, step, metric, value)."""
    return df.select(run.alias("run"), step.alias("step"), *[F.col(v).cast("double").alias(v) for v in values]).unpivot(["run", "step"], list(values), "metric", "value")


def best_run(runs: DataFrame, metric: str, mode: str = "min") -> DataFrame:
    """Best run by a metric, run id on ties; runs without the metric do not compete."""
    value = F.element_at("metrics", metric)
    scored = runs.where(value.isNotNull()).withColumn("value", value)
    return scored.orderBy(F.asc("value") if mode == "min" else F.desc("value"), "run_id").limit(1)


def register_versions(registry: DataFrame, new: DataFrame) -> DataFrame:
    """New (name, run_id) rows with the version numbers that follow each name's highest."""
    top = registry.groupBy("name").agg(F.max("version").alias("_top"))
    order = Window.partitionBy("name").orderBy("run_id")
    return new.join(top, "name", "left").select("name", "run_id", (F.coalesce("_top", F.lit(0)) + F.row_number().over(order)).alias("version"))


def latest_versions(registry: DataFrame) -> DataFrame:
    return registry.groupBy("name").agg(F.max("version").alias("version"), F.max_by("run_id", "version").alias("run_id"))
