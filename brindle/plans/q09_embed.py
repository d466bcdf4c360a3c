"""Components and category embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from brindle.operators import embed
from brindle.plans import base
from brindle.plans.registry import query
from brindle.sources.files import table

COLS = ["l_quantity", "l_discount", "l_tax", "p_size", "p_retailprice"]
CATS = ["p_brand", "p_type", "p_size"]


@query("pca_variance")
def pca_variance(spark, sf):
    model, _ = embed.fit_pca(base.sales(spark, sf).select("row_id", "l_extendedprice", *COLS), COLS, len(COLS))
    rows = embed.explained(spark, model)
    needed = next(i for i, _, total in rows if total >= 0.9 or i == len(rows))
    return spark.createDataFrame([(i, v, t, needed) for i, v, t in rows], "component int, ratio double, cumulative double, needed_for_90 int")


@query("pca_project")
def pca_project(spark, sf):
    """Strength of the relation between each of the first two components and the target."""
    model, rows = embed.fit_pca(base.sales(spark, sf).select("row_id", "l_extendedprice", *COLS), COLS, 2)
    scored = embed.project(model, rows, 2)
    return scored.agg(F.count("*").alias("n"), F.abs(F.corr("pc1", "l_extendedprice")).alias("abs_r_pc1"), F.abs(F.corr("pc2", "l_extendedprice")).alias("abs_r_pc2"))


@query("project_2d")
def project_2d(spark, sf):
    """64-dimensional vectors seen in two."""
    vecs = table(spark, sf, "embeddings").select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(64)])
    model, rows = embed.fit_pca(vecs, [f"e{i}" for i in range(64)], 2)
    return embed.project(model, rows, 2).select("vec_id", "label", "pc1", "pc2")


_TOK = "t AS (SELECT p_partkey, list_filter(['p_brand=' || p_brand, 'p_type=' || nullif(p_type, 'PROMO'), 'p_size=' || p_size], lambda x: x IS NOT NULL) AS tokens FROM part)"


def _tokens(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_brand", F.when(F.col("p_type") != "PROMO", F.col("p_type")).alias("p_type"), "p_size", "p_retailprice")
    return embed.row_tokens(part, CATS)


@query("row_tokens", f"WITH {_TOK} SELECT p_partkey, array_to_string(tokens, ' ') AS tokens FROM t")
def row_tokens(spark, sf):
    return _tokens(spark, sf).select("p_partkey", F.array_join("tokens", " ").alias("tokens"))


@query("cooccurrence_counts", f"WITH {_TOK}, e AS (SELECT p_partkey, unnest(tokens) AS t FROM t) SELECT x.t AS a, y.t AS b, count(*) AS n FROM e x JOIN e y ON x.p_partkey = y.p_partkey AND x.t <> y.t GROUP BY 1, 2")
def cooccurrence_counts(spark, sf):
    return embed.cooccurrence(_tokens(spark, sf))


@query("embed_tokens_w2v")
def embed_tokens_w2v(spark, sf):
    """Vector of every token from the co-occurrence counts."""
    return embed.token_vectors(_tokens(spark, sf))[1].select("token", F.transform("vec", lambda v: F.round(v, 6)).alias("vec"))


@query("embedding_strengths")
def embedding_strengths(spark, sf):
    """Singular values of the co-occurrence counts, largest first."""
    values, _ = embed.token_vectors(_tokens(spark, sf))
    return spark.createDataFrame([(i, round(float(v), 6)) for i, v in enumerate(values, 1)], "component int, strength double")


@query("most_similar_tokens")
def most_similar_tokens(spark, sf):
    return embed.most_similar(embed.token_vectors(_tokens(spark, sf))[1], "p_type=ECONOMY", 5).select("token", F.round("similarity", 6).alias("similarity"))


@query("row_embedding_mean")
def row_embedding_mean(spark, sf):
    """How strongly each embedding dimension goes with the log price."""
    rows = _tokens(spark, sf)
    values, vectors = embed.token_vectors(rows)
    cols = [f"w2v_{i}" for i in range(len(values))]
    scored = embed.row_embeddings(rows, vectors, "p_partkey", size=len(cols)).join(rows.select("p_partkey", "p_retailprice"), "p_partkey")
    wide = scored.agg(*[F.abs(F.corr(c, F.log1p("p_retailprice"))).alias(c) for c in cols])
    return wide.unpivot([], cols, "dimension", "abs_r").orderBy(F.desc("abs_r"))
