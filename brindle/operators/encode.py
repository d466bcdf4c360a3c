"""Category encodings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from brindle.functions.expr import ratio, stable_hash, with_params
from brindle.functions.ordered import named
from brindle.sources.scratch import cut_lineage


def ordinal(column: str, order: Sequence[str], unknown: int = -1, null_as: int | None = None) -> Column:
    """Position in a declared order; unknown values get `unknown`, nulls `null_as` (default: the lowest code)."""
    codes = F.create_map(*[F.lit(v) for i, name in enumerate(order) for v in (name, i)])
    return F.when(F.col(column).isNull(), F.lit(0 if null_as is None else null_as)).otherwise(F.coalesce(codes[F.col(column)], F.lit(unknown)))


def fit_label(df: DataFrame, column: str) -> DataFrame:
    """(value, code): alphabetical codes from 0; a null value has none.

    Only distinct values are ordered.  They are dealt into ranges of about equal size by sampling, each range is ordered on its
    own, and the ranges' sizes, one row each, give the offsets.  The ranges are written once: a second sampling could cut
    elsewhere.
    """
    values = df.where(F.col(column).isNotNull()).select(F.col(column).alias("value")).distinct()
    dealt = cut_lineage(values.repartitionByRange("value").select("value", F.spark_partition_id().alias("_range")))
    sizes = dealt.groupBy("_range").agg(F.count("*").alias("_size"))
    before = sizes.select("_range", F.coalesce(F.sum("_size").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    ranked = dealt.select("_range", "value", F.row_number().over(Window.partitionBy("_range").orderBy("value")).alias("_i"))
    return ranked.join(before, "_range").select("value", (F.col("_before") + F.col("_i") - 1).cast("int").alias("code"))


def apply_label(df: DataFrame, codes: DataFrame, column: str, out: str = "code") -> DataFrame:
    return df.join(codes.select(F.col("value").alias(column), F.col("code").alias(out)), column, "left")


def onehot_sparse(df: DataFrame, codes: DataFrame, column: str) -> DataFrame:
    """Adds `width` and `slot`: the one-hot row in sparse form, for any number of categories.

    `codes` is what fit_label learned; an unknown or null value has no slot (all zeros).
    """
    width = codes.agg(F.count("*").alias("width"))
    return with_params(apply_label(df, codes, column, "slot"), width).select(*df.columns, F.col("_p.width").alias("width"), "slot")


def onehot(df: DataFrame, column: str, categories: Sequence[str], drop_first: bool = False) -> DataFrame:
    """One 0/1 column for each declared category; an unknown value is all zeros.  For learned categories see onehot_sparse."""
    kept = categories[1:] if drop_first else categories
    return df.withColumns({f"{column}={c}": F.coalesce((F.col(column) == c).cast("int"), F.lit(0)) for c in kept})


def hash_bucket(column: str, m: int) -> Column:
    token = F.concat(F.lit(f"{column}="), F.col(column).cast("string"))
    return stable_hash(token, seed="bucket", mod=m)


def hash_sign(column: str) -> Column:
    token = F.concat(F.lit(f"{column}="), F.col(column).cast("string"))
    return F.when(stable_hash(token, seed="sign", mod=2) == 0, F.lit(1)).otherwise(F.lit(-1))


def hashing(df: DataFrame, column: str, m: int = 8) -> DataFrame:
    """Signed hashing of `name=value` into m columns; needs no learned state."""
    placed = df.withColumns({"_b": hash_bucket(column, m), "_s": hash_sign(column)})
    return placed.withColumns({f"h{i}": F.when(F.col("_b") == i, F.col("_s")).otherwise(F.lit(0)) for i in range(m)}).drop("_b", "_s")


def hash_collisions(df: DataFrame, column: str, sizes: Sequence[int]) -> DataFrame:
    """(m, categories, buckets, collisions) per table size."""
    distinct = df.where(F.col(column).isNotNull()).select(column).distinct()
    placed = distinct.select(column, F.explode(F.array(*[F.struct(F.lit(m).alias("m"), hash_bucket(column, m).alias("b")) for m in sizes])).alias("_x"))
    per_bucket = placed.groupBy("_x.m", "_x.b").agg(F.count("*").alias("n"))
    out = per_bucket.groupBy("m").agg(F.sum("n").alias("categories"), F.count("*").alias("buckets"))
    return out.withColumn("collisions", F.col("categories") - F.col("buckets"))


def target_oof(df: DataFrame, column: str, target: str, fold: str) -> DataFrame:
    """Adds `encoded`: mean target of the category over the other folds, the other folds' mean if it is new there.

    Null is a category of its own.  A category that holds most rows is summed before the shuffle, one row a fold.
    """
    named_ = df.withColumn("_category", named(column))
    cells = named_.groupBy("_category", fold).agg(F.sum(target).alias("_s"), F.count(target).alias("_n"))
    by_cat = cells.groupBy("_category").agg(F.sum("_s").alias("_cs"), F.sum("_n").alias("_cn"))
    by_fold = cells.groupBy(fold).agg(F.sum("_s").alias("_fs"), F.sum("_n").alias("_fn"))
    grand = cells.agg(F.sum("_s").alias("s"), F.sum("_n").alias("n"))
    rest = with_params(cells.join(by_cat, "_category").join(F.broadcast(by_fold), fold), grand)  # one row per fold
    value = F.coalesce(ratio(F.col("_cs") - F.col("_s"), F.col("_cn") - F.col("_n")), ratio(F.col("_p.s") - F.col("_fs"), F.col("_p.n") - F.col("_fn")))
    return named_.join(rest.select("_category", fold, value.alias("encoded")), ["_category", fold], "left").select(*df.columns, "encoded")


def cardinality_cost(df: DataFrame, columns: Sequence[str], width: int = 16) -> DataFrame:
    """One-hot width against the size of a learned embedding."""
    counts = df.agg(*[F.countDistinct(c).alias(c) for c in columns]).unpivot([], list(columns), "column", "onehot_width")
    return counts.withColumn("embedding_params", F.col("onehot_width") * width)
