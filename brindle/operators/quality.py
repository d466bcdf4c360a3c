"""Profiling and the data-quality gate; every profile is one aggregate over the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from brindle.functions.expr import ratio, unpivot
from brindle.functions.ordered import exact_quantiles


def null_counts(df: DataFrame, top: int | None = None) -> DataFrame:
    """Columns that have nulls, most first; all of them unless `top` is given."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    rows = counts.unpivot([], df.columns, "column", "nulls").where("nulls > 0")
    ordered = rows.orderBy(F.desc("nulls"), "column")
    return ordered if top is None else ordered.limit(top)


def describe_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, sample sd, min, quartiles and max, one row per column."""
    basic = unpivot(df, columns).groupBy("column").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    q = exact_quantiles(df, columns, [0.25, 0.5, 0.75]).groupBy("column").pivot("prob", [0.25, 0.5, 0.75]).agg(F.first("value"))
    return basic.join(F.broadcast(q.toDF("column", "q25", "q50", "q75")), "column", "left")


def variance_by_column(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.var_samp(c).alias(c) for c in columns]).unpivot([], list(columns), "column", "variance")


def population_skew(value: Column) -> Column:
    """Third standardized moment (population form); 0 for a constant column."""
    return F.when(F.stddev_pop(value) == 0, F.lit(0.0)).otherwise(F.skewness(value))


def value_frequencies(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def matrix_density(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    filled = sum((F.col(c) != 0).cast("bigint") for c in columns)
    return df.agg(F.sum(filled).alias("nonzero"), F.count("*").alias("n_rows")).select(
        "nonzero", "n_rows", ratio(F.col("nonzero"), F.col("n_rows") * len(columns)).alias("density")
    )


def column_set_difference(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Expected columns the table does not have, as rows."""
    spark = df.sparkSession
    want = spark.createDataFrame([(c,) for c in expected], "column string")
    have = spark.createDataFrame([(c,) for c in df.columns], "column string")
    return want.join(F.broadcast(have), "column", "left_anti")


def validate_table(df: DataFrame, expected: Sequence[str], key: str, required: Sequence[str]) -> DataFrame:
    """One row per rule: (rule, violations, passed).

    Key uniqueness is a count per key summed up, so a key with very many copies is reduced before the shuffle.
    """
    missing = [c for c in expected if c not in df.columns]
    present = [c for c in (key, *required) if c in df.columns]
    rules = [F.count("*").alias("_rows")] + [F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in present]
    facts = df.agg(*rules)
    if key in df.columns:
        repeats = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n")).agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("_repeats"))
        facts = facts.withColumn("_repeats", repeats.scalar())
    else:
        facts = facts.withColumn("_repeats", F.lit(0).cast("bigint"))
    results = [
        F.struct(F.lit("columns_present").alias("rule"), F.lit(len(missing)).cast("bigint").alias("violations")),
        F.struct(F.lit("not_empty").alias("rule"), (F.col("_rows") == 0).cast("bigint").alias("violations")),
        F.struct(F.lit("key_unique").alias("rule"), F.col("_repeats").alias("violations")),
    ] + [F.struct(F.lit(f"no_null_{c}").alias("rule"), F.col(f"_null_{c}").alias("violations")) for c in present]
    rows = facts.select(F.explode(F.array(*results)).alias("r"), F.col("_rows").alias("n_rows"))
    return rows.select("r.*", "n_rows", F.lit(len(df.columns)).alias("n_columns")).withColumn("passed", F.col("violations") == 0)


def order_violations(df: DataFrame, entity: str, ts: str, values: Sequence[str]) -> DataFrame:
    """How often a value falls from one row of an entity to the next (cumulative values never should).

    Expects a table at (entity, day) grain or coarser.
    """
    w = Window.partitionBy(entity).orderBy(ts)
    falls = df.select(*[(F.col(v) < F.lag(v).over(w)).alias(v) for v in values])
    return falls.agg(*[F.count_if(v).alias(v) for v in values]).unpivot([], list(values), "column", "violations")
