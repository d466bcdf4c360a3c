"""Small relational steps with a name of their own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def project(df: DataFrame, spec: dict[str, tuple[str, str]]) -> DataFrame:
    """{new name: (source column, type)} → one projection."""
    return df.select(*[F.col(src).cast(kind).alias(new) for new, (src, kind) in spec.items()])


def group_mean_lookup(df: DataFrame, key: str, value: str, wanted: DataFrame) -> DataFrame:
    """Mean per key for the wanted keys; keys never seen get null."""
    return wanted.join(df.groupBy(key).agg(F.avg(value).alias("mean")), key, "left")


def pivot_metrics(long: DataFrame, index: str, column: str, values: Sequence, metric: str, prefix: str = "") -> DataFrame:
    """Long metric rows → one row per index, one column per listed value."""
    wide = long.groupBy(index).pivot(column, list(values)).agg(F.first(metric))
    return wide.toDF(index, *[f"{prefix}{v}" for v in values])


def normalize_and_route(df: DataFrame, text: str) -> DataFrame:
    """Trim and lower a text, then treat it by how it ends."""
    s = F.lower(F.trim(text))
    question, statement = s.endswith("?"), s.endswith(".")
    return df.withColumn("normalized", F.when(question, F.upper(s)).when(statement, F.replace(s, F.lit("."), F.lit("!"))).otherwise(s)).withColumn(
        "route", F.when(question, "question").when(statement, "statement").otherwise("other")
    )
