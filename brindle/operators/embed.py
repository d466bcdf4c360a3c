"""Principal components and learned category embeddings."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from brindle.functions.expr import cosine
from brindle.operators.scale import apply_zscore, fit_zscore
from brindle.operators.sparse_svd import truncated_svd


def fit_pca(df: DataFrame, columns: Sequence[str], k: int):
    """(model, rows with `features`) on z-scores."""
    z = apply_zscore(df, fit_zscore(df, columns), columns)
    rows = VectorAssembler(inputCols=list(columns), outputCol="features").transform(z).persist()
    return PCA(k=k, inputCol="features", outputCol="pca").fit(rows), rows


def explained(spark, model) -> list[tuple[int, float, float]]:
    out, total = [], 0.0
    for i, v in enumerate(model.explainedVariance.toArray(), 1):
        total += float(v)
        out.append((i, float(v), total))
    return out


def project(model, rows: DataFrame, k: int) -> DataFrame:
    """Component columns pc1…pck; the largest loading of each component is made positive."""
    loadings = model.pc.toArray()
    signs = [1.0 if loadings[abs(loadings[:, j]).argmax(), j] >= 0 else -1.0 for j in range(k)]
    scored = model.transform(rows).withColumn("_a", vector_to_array("pca"))
    return scored.withColumns({f"pc{j + 1}": F.col("_a")[j] * signs[j] for j in range(k)}).drop("_a", "pca", "features")


def row_tokens(df: DataFrame, columns: Sequence[str], out: str = "tokens") -> DataFrame:
    """`column=value` tokens of a row; missing values give no token."""
    named = [F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{c}="), F.col(c).cast("string"))) for c in columns]
    return df.withColumn(out, F.filter(F.array(*named), lambda t: t.isNotNull()))


def cooccurrence(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """(a, b, n) both ways round; a row has as many tokens as columns, so its pairs are few and fixed."""
    left = df.select(F.explode(F.array_distinct(tokens)).alias("a"), F.array_distinct(tokens).alias("_all"))
    pairs = left.select("a", F.explode("_all").alias("b")).where(F.col("a") != F.col("b"))
    return pairs.groupBy("a", "b").agg(F.count("*").alias("n"))


def token_vectors(df: DataFrame, tokens: str = "tokens", size: int = 16) -> tuple[np.ndarray, DataFrame]:
    """(singular values, (token, vec)) of the co-occurrence counts."""
    return truncated_svd(cooccurrence(df, tokens), size)


def most_similar(vectors: DataFrame, token: str, n: int = 5) -> DataFrame:
    """(token, similarity): the n other tokens of largest cosine."""
    asked = vectors.where(F.col("token") == token).select(F.col("vec").alias("_v"))
    scored = vectors.where(F.col("token") != token).crossJoin(F.broadcast(asked)).select("token", cosine(F.col("vec"), F.col("_v")).alias("similarity"))
    return scored.where("similarity IS NOT NULL").orderBy(F.desc(F.round("similarity", 9)), "token").limit(n)


def row_embeddings(df: DataFrame, vectors: DataFrame, key: str, tokens: str = "tokens", size: int = 16) -> DataFrame:
    """(key, w2v_0, …): mean vector of each row's tokens; a row without known tokens has nulls."""
    parts = df.select(key, F.explode(tokens).alias("token")).join(vectors, "token")
    means = parts.groupBy(key).agg(*[F.avg(F.col("vec")[i]).alias(f"w2v_{i}") for i in range(size)])
    return df.select(key).join(means, key, "left")
