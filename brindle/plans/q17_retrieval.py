"""Text and vector retrieval."""

from __future__ import annotations

from pyspark.sql import functions as F

from brindle.operators import chunking, retrieval
from brindle.operators.knn import knn_classify, knn_join
from brindle.operators.splits import in_test
from brindle.plans.q03_splits import h_sql
from brindle.plans.registry import query
from brindle.sources.files import table
from brindle.sources.scratch import cut_lineage

_CH = "ch AS (SELECT doc_id, source, i::INTEGER AS chunk_no, substr(text, i * 700 + 1, 700) AS chunk FROM (SELECT doc_id, source, text, unnest(range((length(text) + 699) // 700)) AS i FROM documents))"


@query("chunk_fixed", f"WITH {_CH} SELECT doc_id, chunk_no, chunk FROM ch")
def chunk_fixed(spark, sf):
    return chunking.chunk_fixed(table(spark, sf, "documents").select("doc_id", "text"), "text")


@query("chunk_recursive")
def chunk_recursive(spark, sf):
    return chunking.chunk_recursive(table(spark, sf, "documents").select("doc_id", "text"), "text")


@query("chunk_refs", f"WITH {_CH} SELECT doc_id || '#' || chunk_no AS ref, source, length(chunk)::INTEGER AS n_chars, replace(substr(chunk, 1, 60), chr(10), ' ') AS preview FROM ch")
def chunk_refs(spark, sf):
    parts = chunking.chunk_fixed(table(spark, sf, "documents").select("doc_id", "source", "text"), "text")
    return parts.select(chunking.chunk_ref(F.col("doc_id"), F.col("chunk_no")).alias("ref"), "source", F.length("chunk").alias("n_chars"),
                        F.replace(F.substring("chunk", 1, 60), F.lit("\n"), F.lit(" ")).alias("preview"))


_KEY = "sha1('doc|' || source || '|' || text)"


def _keyed(spark, sf):
    return table(spark, sf, "documents").select("doc_id", chunking.content_key(F.lit("doc"), F.col("source"), F.col("text")).alias("key"))


@query("content_key", f"SELECT doc_id, {_KEY} AS key FROM documents")
def content_key(spark, sf):
    return _keyed(spark, sf)


@query("delta_to_embed", f"WITH k AS (SELECT doc_id, {_KEY} AS key FROM documents) SELECT doc_id, key FROM k WHERE key NOT IN (SELECT key FROM k JOIN labels USING (doc_id))")
def delta_to_embed(spark, sf):
    """Labelled documents are already in the cache."""
    keyed = _keyed(spark, sf)
    return chunking.delta_to_embed(keyed, keyed.join(table(spark, sf, "labels"), "doc_id", "left_semi")).select("doc_id", "key")


@query("upsert_points", """WITH h AS (SELECT vec_id, label, sha1('\\x6b\\xa7\\xb8\\x11\\x9d\\xad\\x11\\xd1\\x80\\xb4\\x00\\xc0\\x4f\\xd4\\x30\\xc8'::BLOB || encode('vec#' || vec_id)) AS h FROM embeddings)
SELECT substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || lower(to_hex((('0x' || substr(h, 17, 2))::BIGINT & 63) | 128)) || substr(h, 19, 2) || '-' || substr(h, 21, 12) AS point_id,
CASE WHEN label = 3 THEN 30 ELSE label END AS label, CASE WHEN label = 3 THEN 2 ELSE 1 END AS version FROM h""")
def upsert_points(spark, sf):
    """Points of one class are written again with a new payload."""
    base = table(spark, sf, "embeddings").select(chunking.point_id(F.concat(F.lit("vec#"), F.col("vec_id").cast("string"))).alias("point_id"), "label")
    old = base.withColumn("version", F.lit(1))
    new = base.where("label = 3").select("point_id", F.lit(30).alias("label"), F.lit(2).alias("version"))
    return chunking.upsert(old, new, "point_id", "version")


@query("text_vectors")
def text_vectors(spark, sf):
    """Weighted term vectors of unit length, summarised by their support."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import IDF, HashingTF, Normalizer
    from pyspark.ml.functions import vector_to_array

    docs = table(spark, sf, "documents").select("doc_id", retrieval.tokens("text").alias("words"))
    stages = [HashingTF(inputCol="words", outputCol="tf", numFeatures=1 << 12), IDF(inputCol="tf", outputCol="w"), Normalizer(inputCol="w", outputCol="vec")]
    out = Pipeline(stages=stages).fit(docs).transform(docs)
    arr = vector_to_array("vec")
    return out.select("doc_id", F.size(F.filter(arr, lambda x: x != 0)).alias("nonzero"), F.round(F.sqrt(F.aggregate(arr, F.lit(0.0), lambda s, x: s + x * x)), 6).alias("length"))


def centroids(spark, sf):
    """Mean vector of every class."""
    parts = table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
    means = parts.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    return means.groupBy("label").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("embedding"))


_CENT = """v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
cm AS (SELECT label, i, avg(x) AS m FROM (SELECT label, generate_subscripts(e, 1) AS i, unnest(e) AS x FROM v) GROUP BY 1, 2), cent AS (SELECT label, list(m ORDER BY i) AS c FROM cm GROUP BY 1),
sims AS (SELECT cent.label AS query_label, v.vec_id, v.label, list_cosine_similarity(c, e) AS s FROM cent, v)"""


@query("cosine_matrix", f"WITH {_CENT} SELECT query_label, vec_id, round(s, 3) AS score FROM sims")
def cosine_matrix(spark, sf):
    """Every class centre (few, one array) against every vector."""
    from brindle.functions.expr import cosine, with_params

    centres = centroids(spark, sf).agg(F.collect_list(F.struct("label", "embedding")).alias("c"))
    pairs = with_params(table(spark, sf, "embeddings").select("vec_id", "embedding"), centres).select("vec_id", "embedding", F.explode("_p.c").alias("c"))
    return pairs.select(F.col("c.label").alias("query_label"), "vec_id", F.round(cosine(F.col("c.embedding"), F.col("embedding")), 3).alias("score"))


@query("dense_topk", f"WITH {_CENT} SELECT query_label, vec_id, round(s, 6) AS score, (rn - 1)::INTEGER AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_label ORDER BY round(s, 12) DESC, vec_id) AS rn FROM sims) WHERE rn <= 10")
def dense_topk(spark, sf):
    queries = centroids(spark, sf).withColumnRenamed("label", "query_label")
    out = retrieval.dense_topk(table(spark, sf, "embeddings"), queries, "vec_id", "query_label", "embedding", 10)
    return out.select(F.col("query_label").cast("int").alias("query_label"), "vec_id", F.round("score", 6).alias("score"), "rank")


@query("dense_topk_filtered", f"WITH {_CENT} SELECT query_label, vec_id, round(s, 6) AS score, (rn - 1)::INTEGER AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_label ORDER BY round(s, 12) DESC, vec_id) AS rn FROM sims WHERE label >= 5) WHERE rn <= 10")
def dense_topk_filtered(spark, sf):
    """Payload filter before scoring."""
    queries = centroids(spark, sf).withColumnRenamed("label", "query_label")
    out = retrieval.dense_topk(table(spark, sf, "embeddings"), queries, "vec_id", "query_label", "embedding", 10, where=F.col("label") >= 5)
    return out.select(F.col("query_label").cast("int").alias("query_label"), "vec_id", F.round("score", 6).alias("score"), "rank")


@query("similar_to_item", """WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings), s AS (SELECT a.vec_id, b.vec_id AS similar_id, list_cosine_similarity(a.e, b.e) AS s FROM v a, v b)
SELECT vec_id, similar_id, round(s, 5) AS score, rn::INTEGER AS rank FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(s, 12) DESC, similar_id) AS rn FROM s) WHERE rn <= 5""")
def similar_to_item(spark, sf):
    vecs = table(spark, sf, "embeddings")
    out = knn_join(vecs.select(F.col("vec_id").alias("qid"), F.col("embedding").alias("vec")), vecs.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), F.lit(0.0).alias("payload")), 5)
    return out.select(F.col("qid").alias("vec_id"), F.col("id").alias("similar_id"), F.round("score", 5).alias("score"), "rank")


@query("knn_classify", f"""WITH v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e, {h_sql('vec_id')} < 2500 AS test FROM embeddings),
d AS (SELECT a.vec_id, a.label AS actual, b.vec_id AS id, b.label, round(list_distance(a.e, b.e), 12) AS d FROM v a JOIN v b ON a.test AND NOT b.test),
k AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, id) AS rn FROM d), t AS (SELECT vec_id, actual, label, count(*) AS n FROM k WHERE rn <= 15 GROUP BY ALL)
SELECT vec_id, actual, label AS predicted FROM t QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY n DESC, label) = 1""")
def knn_classify_query(spark, sf):
    vecs = table(spark, sf, "embeddings").withColumn("test", in_test(["vec_id"], 0.25))
    test = vecs.where("test").select(F.col("vec_id").alias("qid"), F.col("embedding").alias("vec"))
    train = vecs.where("NOT test").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), F.col("label").alias("payload"))
    out = knn_classify(train, test, 15)
    return out.withColumnRenamed("qid", "vec_id").join(vecs.where("test").select("vec_id", F.col("label").alias("actual")), "vec_id").select("vec_id", "actual", "predicted")


_TOK = "list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda t: t <> '')"


@query("tokenize_ws", f"SELECT doc_id, len({_TOK})::INTEGER AS n_tokens, array_to_string({_TOK}, ' ') AS joined FROM documents")
def tokenize_ws(spark, sf):
    t = retrieval.tokens("text")
    return table(spark, sf, "documents").select("doc_id", F.size(t).alias("n_tokens"), F.array_join(t, " ").alias("joined"))


BM25 = f"""dt AS (SELECT doc_id, unnest({_TOK}) AS term FROM documents), post AS (SELECT doc_id, term, count(*) AS tf FROM dt GROUP BY 1, 2),
len AS (SELECT doc_id, len({_TOK}) AS dl FROM documents), corp AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM len),
idf AS (SELECT term, ln((any_value(n) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM post, corp GROUP BY term), low AS (SELECT avg(idf) * 0.25 AS low FROM idf),
qt AS (SELECT item_id, term, count(*) AS qtf FROM (SELECT item_id, unnest({_TOK}) AS term FROM benchmark) GROUP BY 1, 2),
w AS (SELECT item_id, term, qtf * CASE WHEN idf < 0 THEN low ELSE idf END AS w FROM qt JOIN idf USING (term), low),
sc AS (SELECT item_id, doc_id, round(sum(w * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))), 8) AS score FROM w JOIN post USING (term) JOIN len USING (doc_id), corp GROUP BY 1, 2),
bm AS (SELECT item_id, doc_id, score, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) - 1)::INTEGER AS rank FROM sc WHERE score > 0 QUALIFY rank < 15)"""


def _bm25(spark, sf):
    return retrieval.bm25_topk(table(spark, sf, "documents"), table(spark, sf, "benchmark"), "doc_id", "item_id", "text")


@query("bm25_topk", f"WITH {BM25} SELECT item_id, doc_id, round(score, 5) AS score, rank FROM bm")
def bm25_topk(spark, sf):
    return _bm25(spark, sf).withColumn("score", F.round("score", 5))


def _vec_sql(src: str, key: str, out: str) -> str:
    return f"""{out}t AS (SELECT {key}, term, count(*) AS tf FROM (SELECT {key}, unnest({_TOK}) AS term FROM {src}) GROUP BY 1, 2),
{out} AS (SELECT {key}, {h_sql('term', 'slot', 64)} AS slot, sum(tf * (1 - 2 * {h_sql('term', 'sign', 2)}))::DOUBLE AS w FROM {out}t GROUP BY 1, 2)"""


DENSE = f"""{_vec_sql('documents', 'doc_id', 'dv')}, {_vec_sql('benchmark', 'item_id', 'qv')},
dn AS (SELECT doc_id, sqrt(sum(w * w)) AS n FROM dv GROUP BY 1), qn AS (SELECT item_id, sqrt(sum(w * w)) AS n FROM qv GROUP BY 1),
dsim AS (SELECT item_id, doc_id, round(sum(qv.w * dv.w) / any_value(qn.n) / any_value(dn.n), 12) AS s FROM qv JOIN dv USING (slot) JOIN dn USING (doc_id) JOIN qn USING (item_id) WHERE dn.n > 0 AND qn.n > 0 GROUP BY 1, 2),
de AS (SELECT item_id, doc_id, s AS score, (row_number() OVER (PARTITION BY item_id ORDER BY s DESC, doc_id) - 1)::INTEGER AS rank FROM dsim QUALIFY rank < 15)"""


def _dense(spark, sf):
    docs = retrieval.hashed_vectors(table(spark, sf, "documents"), "doc_id", "text")
    asked = retrieval.hashed_vectors(table(spark, sf, "benchmark"), "item_id", "text")
    return retrieval.dense_topk(docs, asked, "doc_id", "item_id", "vec", 15)


@query("dense_text_topk", f"WITH {DENSE} SELECT item_id, doc_id, round(score, 5) AS score FROM de")
def dense_text_topk(spark, sf):
    return _dense(spark, sf).select("item_id", "doc_id", F.round("score", 5).alias("score"))


HYBRID = f"""{BM25}, {DENSE}, fu AS (SELECT item_id, doc_id, round(sum(1.0::DOUBLE / (60 + rank)), 9) AS score FROM (SELECT item_id, doc_id, rank FROM de UNION ALL SELECT item_id, doc_id, rank FROM bm) GROUP BY 1, 2),
hy AS (SELECT item_id, doc_id, score, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) - 1)::INTEGER AS rank FROM fu QUALIFY rank < 5)"""


def _hybrid(spark, sf, k=5):
    return retrieval.rrf_fuse([_dense(spark, sf), _bm25(spark, sf)], "item_id", "doc_id", k)


@query("rrf_fuse", """WITH a AS (SELECT user_id, event_type, (row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) - 1) AS rank FROM events GROUP BY 1, 2),
b AS (SELECT user_id, event_type, (row_number() OVER (PARTITION BY user_id ORDER BY max(value) DESC, event_type) - 1) AS rank FROM events GROUP BY 1, 2),
f AS (SELECT user_id, event_type, round(sum(1.0::DOUBLE / (60 + rank)), 9) AS score FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY 1, 2)
SELECT user_id, event_type, score, (row_number() OVER (PARTITION BY user_id ORDER BY score DESC, event_type) - 1)::INTEGER AS rank FROM f QUALIFY rank < 3""")
def rrf_fuse(spark, sf):
    """Event types of each user ranked by how often and by how large, fused."""
    from pyspark.sql import Window

    stats = table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"), F.max("value").alias("top"))
    ranked = [stats.select("user_id", "event_type", (F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc(c), "event_type")) - 1).alias("rank")) for c in ("n", "top")]
    return retrieval.rrf_fuse(ranked, "user_id", "event_type", 3)


@query("hybrid_search", f"WITH {HYBRID} SELECT item_id, doc_id, round(hy.score, 5) AS score, rank, lang, source FROM hy JOIN documents USING (doc_id)")
def hybrid_search(spark, sf):
    return _hybrid(spark, sf).join(table(spark, sf, "documents").select("doc_id", "lang", "source"), "doc_id").withColumn("score", F.round("score", 5))


@query("build_context", f"""WITH {HYBRID}, b AS (SELECT item_id, rank, CASE WHEN n_chars < 50 THEN '[' || (rank + 1) || '] (short note ' || doc_id || ')' ELSE '[' || (rank + 1) || '] (source: ' || source || ')' || chr(10) || text END AS b
FROM hy JOIN documents USING (doc_id)) SELECT item_id, md5(string_agg(b, chr(10) || chr(10) ORDER BY rank)) AS digest, length(string_agg(b, chr(10) || chr(10) ORDER BY rank))::INTEGER AS n_chars FROM b GROUP BY 1""")
def build_context(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.col("source").alias("origin"), "text", F.when(F.col("n_chars") < 50, F.concat(F.lit("short note "), F.col("doc_id").cast("string"))).alias("caption"))
    context = retrieval.build_context(_hybrid(spark, sf).join(docs, "doc_id"), "item_id")
    return context.select("item_id", F.md5("context").alias("digest"), F.length("context").alias("n_chars"))


def _modes(spark, sf):
    """Results of three modes with references, and the accepted prefixes of every query."""
    ref = F.concat(F.lit("doc"), F.col("doc_id").cast("string"), F.lit("#"))
    dense, lexical = cut_lineage(_dense(spark, sf)), cut_lineage(_bm25(spark, sf))  # each list is read twice
    runs = {"dense": dense, "bm25": lexical, "hybrid": retrieval.rrf_fuse([dense, lexical], "item_id", "doc_id", 5)}
    out = None
    for name, df in runs.items():
        part = df.where("rank < 5").select(F.lit(name).alias("mode"), "item_id", ref.alias("ref"), "rank")
        out = part if out is None else out.unionByName(part)
    matches = retrieval.verbatim_matches(table(spark, sf, "documents"), table(spark, sf, "benchmark"), "doc_id", "item_id", "text")
    return out, matches.select("item_id", ref.alias("prefix"))


_EV = f"""{HYBRID}, rel AS (SELECT item_id, doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text)),
runs AS (SELECT 'dense' AS mode, item_id, doc_id, rank FROM de WHERE rank < 5 UNION ALL SELECT 'bm25', item_id, doc_id, rank FROM bm WHERE rank < 5 UNION ALL SELECT 'hybrid', item_id, doc_id, rank FROM hy),
mk AS (SELECT runs.*, rel.doc_id IS NOT NULL AS relevant FROM runs LEFT JOIN rel USING (item_id, doc_id)), fr AS (SELECT mode, item_id, min(rank) + 1 AS first FROM mk WHERE relevant GROUP BY 1, 2)"""


@query("relevance_by_prefix", f"WITH {_EV} SELECT mode, item_id, 'doc' || doc_id || '#' AS ref, rank, relevant FROM mk")
def relevance_by_prefix(spark, sf):
    results, accepted = _modes(spark, sf)
    return retrieval.mark_relevant(results, accepted, "item_id")


@query("hit_rate_mrr", f"""WITH {_EV}, a AS (SELECT mode, k, count(*) FILTER (first <= k) AS h, coalesce(sum(1.0::DOUBLE / first) FILTER (first <= k), 0) AS r FROM (VALUES ('dense'), ('bm25'), ('hybrid')) AS modes(mode) LEFT JOIN fr USING (mode), (SELECT unnest([1, 3, 5]) AS k) GROUP BY 1, 2)
SELECT mode, """ + ", ".join(f"round(max(h) FILTER (k = {k}) / (SELECT count(*) FROM benchmark)::DOUBLE, 3) AS hit_{k}, round(max(r) FILTER (k = {k}) / (SELECT count(*) FROM benchmark)::DOUBLE, 3) AS mrr_{k}" for k in (1, 3, 5)) + " FROM a GROUP BY 1")
def hit_rate_mrr(spark, sf):
    results, accepted = _modes(spark, sf)
    scores = retrieval.hit_rate_mrr(retrieval.mark_relevant(results, accepted, "item_id"), table(spark, sf, "benchmark"), "item_id", [1, 3, 5], modes=["dense", "bm25", "hybrid"])
    wide = scores.groupBy("mode").pivot("k", [1, 3, 5]).agg(F.first("hit_rate").alias("hit"), F.first("mrr").alias("mrr"))
    return wide.select("mode", *[F.col(f"{k}_{m}").alias(f"{m}_{k}") for k in (1, 3, 5) for m in ("hit", "mrr")])


@query("query_detail", f"WITH {_EV} SELECT item_id, first::INTEGER AS first_rank, coalesce(1.0::DOUBLE / first, 0.0::DOUBLE) AS reciprocal FROM benchmark LEFT JOIN (SELECT * FROM fr WHERE mode = 'hybrid') USING (item_id)")
def query_detail(spark, sf):
    results, accepted = _modes(spark, sf)
    marked = retrieval.mark_relevant(results.where("mode = 'hybrid'"), accepted, "item_id")
    return retrieval.query_detail(marked, table(spark, sf, "benchmark"), "item_id", 5)


@query("filter_budget_top5", "SELECT p_partkey::VARCHAR AS item, p_retailprice AS price FROM part WHERE p_type = 'PROMO' AND p_retailprice <= 1000 ORDER BY price, item LIMIT 5")
def filter_budget_top5(spark, sf):
    return retrieval.budget_top(table(spark, sf, "part"), "p_type", "p_retailprice", "PROMO", 1000.0, "p_partkey")


@query("filter_budget_unknown", "SELECT DISTINCT p_type AS item, NULL::DOUBLE AS price FROM part")
def filter_budget_unknown(spark, sf):
    return retrieval.budget_top(table(spark, sf, "part"), "p_type", "p_retailprice", "NO SUCH TYPE", 1000.0, "p_partkey")


@query("lookup_by_key", "SELECT '  ' || lower(c_name) || ' ' AS asked, c_name, c_acctbal FROM customer")
def lookup_by_key(spark, sf):
    cust = table(spark, sf, "customer").select("c_name", "c_acctbal")
    asked = cust.select(F.concat(F.lit("  "), F.lower("c_name"), F.lit(" ")).alias("c_name"))
    return retrieval.lookup_by_key(asked, cust, "c_name")


@query("dedupe_keep_first", "SELECT source, min(doc_id) AS first_seen FROM documents GROUP BY 1 ORDER BY 2, 1 LIMIT 8")
def dedupe_keep_first(spark, sf):
    return retrieval.dedupe_keep_first(table(spark, sf, "documents"), "source", "doc_id", 8)
