"""Column expressions and one-row parameter plumbing shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def stable_hash(*cols: Column | str, seed: int | str = 0, mod: int | None = None) -> Column:
    """Hash of a key that is the same in every engine and under every partitioning (32 bits of md5)."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols])
    value = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return value if mod is None else F.pmod(value, F.lit(mod))


def with_params(df: DataFrame, params: DataFrame, name: str = "_p") -> DataFrame:
    """Attach a one-row parameter table as a struct column.

    The row enters as an uncorrelated scalar subquery: it runs once, there is no join, and Spark
    raises if the parameter table ever has more than one row.
    """
    return df.select("*", params.select(F.struct(*params.columns)).scalar().alias(name))


def ratio(num: Column, den: Column) -> Column:
    """Division that yields null for a zero or null denominator."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def unpivot(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Long form (keys…, column, value) of numeric columns; nulls are kept."""
    return df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        list(keys), list(columns), "column", "value"
    )


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two numeric arrays; null when either has no length."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def array_mean(a: Column) -> Column:
    return F.try_divide(F.aggregate(a, F.lit(0.0), lambda s, x: s + x), F.size(a).cast("double"))
