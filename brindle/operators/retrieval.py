"""Lexical and dense retrieval over whole query sets, fusion and evaluation."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from brindle.functions.expr import with_params
from brindle.operators.knn import knn_join
from brindle.operators.lexical_index import build_index, search, tokens, words_of
from brindle.sources.scratch import cut_small

# fixed values: constant of rank fusion, results of each list that are fused
RRF_K, POOL = 60, 15


def bm25_topk(docs: DataFrame, queries: DataFrame, doc_id: str, query_id: str, text: str, k: int = POOL) -> DataFrame:
    """(query, doc, score, rank): best k documents with a positive score, ties by document id, rank from 0.

    The index is written first; where it is there already, `lexical_index.search` takes it.
    """
    return search(build_index(docs, doc_id, text, asked=queries), queries, query_id, text, k, doc_id)


def hashed_vectors(df: DataFrame, key: str, text: str, width: int = 64) -> DataFrame:
    """(key, vec): signed hash of every token of the text, summed into `width` slots.

    Tokens are hashed and summed where a text lies; what crosses the network, to sum rows of equal keys, is one vector a row.
    """

    def of(term: str, seed: str, mod: int) -> int:  # stable_hash
        return int(hashlib.md5(f"{seed}|{term}".encode()).hexdigest()[:8], 16) % mod

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, words = words_of(b.column("low"))
            known = words.dictionary.to_pylist()
            slot = np.array([of(w, "slot", width) for w in known], dtype="int64")
            sign = np.array([1.0 - 2 * of(w, "sign", 2) for w in known])
            code = words.indices.to_numpy()
            flat = np.bincount(row * width + slot[code], sign[code], minlength=b.num_rows * width)
            vec = pa.ListArray.from_arrays(pa.array(np.arange(b.num_rows + 1, dtype="int32") * width), pa.array(flat))
            yield pa.RecordBatch.from_arrays([b.column("key"), vec], names=["key", "v"]).filter(pa.array(np.bincount(row, minlength=b.num_rows) > 0))

    rows = df.select(F.col(key).alias("key"), F.lower(text).alias("low"))
    parts = rows.mapInArrow(sums, f"key {df.schema[key].dataType.simpleString()}, v array<double>")
    return parts.groupBy(F.col("key").alias(key)).agg(F.array(*[F.sum(F.col("v")[i]) for i in range(width)]).alias("vec"))


def dense_topk(items: DataFrame, queries: DataFrame, item_id: str, query_id: str, vec: str, k: int = POOL, where: Column | None = None) -> DataFrame:
    """(query, item, score, rank): best k items by cosine, ties by item id, rank from 0."""
    pool = items if where is None else items.where(where)
    pool = pool.select(F.col(item_id).alias("id"), F.col(vec).alias("vec"), F.lit(0.0).alias("payload"))
    out = knn_join(queries.select(F.col(query_id).alias("qid"), F.col(vec).alias("vec")), pool, k)
    return out.select(F.col("qid").alias(query_id), F.col("id").alias(item_id), "score", (F.col("rank") - 1).alias("rank"))


def rrf_fuse(lists: Sequence[DataFrame], query_id: str, doc_id: str, k: int, constant: int = RRF_K) -> DataFrame:
    """Σ 1/(constant + rank) over the lists an item appears in, rank from 0, ties by item id."""
    union = lists[0].select(query_id, doc_id, "rank")
    for other in lists[1:]:
        union = union.unionByName(other.select(query_id, doc_id, "rank"))
    fused = union.groupBy(query_id, doc_id).agg(F.round(F.sum(1.0 / (constant + F.col("rank"))), 9).alias("score"))
    best = Window.partitionBy(query_id).orderBy(F.desc("score"), doc_id)
    return fused.withColumn("rank", F.row_number().over(best) - 1).where(F.col("rank") < k)


def build_context(results: DataFrame, query_id: str) -> DataFrame:
    """(query, context): at most k numbered passages in rank order, joined by a blank line.

    `results` has rank (from 0), origin, text and caption; a row with a caption stands for a picture.
    """
    number = (F.col("rank") + 1).cast("string")
    block = F.when(F.col("caption").isNotNull(), F.concat(F.lit("["), number, F.lit("] ("), F.col("caption"), F.lit(")"))).otherwise(
        F.concat(F.lit("["), number, F.lit("] (source: "), F.col("origin"), F.lit(")\n"), F.col("text")))
    ordered = F.sort_array(F.collect_list(F.struct("rank", block.alias("b"))))
    return results.groupBy(query_id).agg(F.array_join(F.transform(ordered, lambda s: s["b"]), "\n\n").alias("context"))


def mark_relevant(results: DataFrame, accepted: DataFrame, query_id: str, ref: str = "ref") -> DataFrame:
    """Adds `relevant`: the reference starts with one of the query's accepted prefixes."""
    hits = results.join(accepted, query_id).where(F.startswith(ref, "prefix")).select(query_id, ref).distinct().withColumn("relevant", F.lit(True))
    return results.join(hits, [query_id, ref], "left").withColumn("relevant", F.coalesce("relevant", F.lit(False)))


def query_detail(marked: DataFrame, queries: DataFrame, query_id: str, k: int) -> DataFrame:
    """(query, first_rank, reciprocal): position from 1 of the first relevant result in the top k."""
    first = marked.where(F.col("relevant") & (F.col("rank") < k)).groupBy(query_id).agg((F.min("rank") + 1).alias("first_rank"))
    return queries.select(query_id).join(first, query_id, "left").withColumn("reciprocal", F.coalesce(1.0 / F.col("first_rank"), F.lit(0.0)))


def hit_rate_mrr(marked: DataFrame, queries: DataFrame, query_id: str, ks: Sequence[int], mode: str = "mode",
                 modes: Sequence[str] | None = None) -> DataFrame:
    """(mode, k, hit_rate, mrr); a query without a relevant result counts as 0.

    Name the modes to see one that found nothing at all: it comes with 0 and 0.
    """
    first = marked.where("relevant").groupBy(mode, query_id).agg((F.min("rank") + 1).alias("first"))
    n = queries.agg(F.countDistinct(query_id).cast("double").alias("n"))
    found = marked.select(mode).distinct()
    known = found if modes is None else queries.sparkSession.createDataFrame([(m,) for m in modes], f"{mode} string")
    per = known.join(first, mode, "left").select(mode, "first", F.explode(F.array(*[F.lit(k) for k in ks])).alias("k"))
    hit = F.coalesce(F.col("first") <= F.col("k"), F.lit(False))
    sums = per.groupBy(mode, "k").agg(F.count_if(hit).alias("h"), F.sum(F.when(hit, 1.0 / F.col("first")).otherwise(0.0)).alias("r"))
    return with_params(sums, n).select(mode, "k", F.round(F.col("h") / F.col("_p.n"), 3).alias("hit_rate"), F.round(F.col("r") / F.col("_p.n"), 3).alias("mrr"))


def verbatim_matches(docs: DataFrame, passages: DataFrame, doc_id: str, passage_id: str, text: str, run: int = 5) -> DataFrame:
    """(passage, doc) where the document contains the passage, letter by letter, blanks included.

    Candidates share an anchor, compared by a 64-bit hash; containment is then checked on the whole texts.  The anchor is the longest run of tokens, `run`
    at most, after the passage's first token and before its last, for those two may be parts of longer words.  A passage of one
    or two tokens has its first three letters (or as many as it has) as its anchor.  Documents are cut only into the lengths that
    some passage needs.  An empty passage is contained in nothing here; null texts match nothing.
    """
    t, low = tokens(text), F.lower(text)
    inner = F.least(F.size(t) - 2, F.lit(run))
    by_words = F.struct(inner.alias("words"), F.lit(0).alias("letters"), F.xxhash64(F.slice(t, 2, F.greatest(inner, F.lit(1)))).alias("anchor"))
    letters = F.least(F.length(text), F.lit(3))
    by_letters = F.struct(F.lit(0).alias("words"), letters.alias("letters"), F.xxhash64(F.substring(low, F.lit(1), letters)).alias("anchor"))
    wanted = passages.where(F.length(text) > 0).select(passage_id, F.col(text).alias("_passage"), F.when(inner > 0, by_words).otherwise(by_letters).alias("_a"))
    lengths = wanted.agg(F.collect_set("_a.words").alias("words"), F.collect_set("_a.letters").alias("letters"))
    shown = with_params(docs.where(F.col(text).isNotNull()).select(doc_id, F.col(text).alias("_text"), t.alias("_t"), low.alias("_low")), lengths, "_n")

    def cut(n: Column, size: Column, piece, words: Column, letters: Column) -> Column:
        whole = F.sequence(F.lit(1), F.greatest(size - n + 1, F.lit(1)))
        made = F.transform(whole, lambda i: F.struct(words.alias("words"), letters.alias("letters"), piece(i, n).alias("anchor")))
        return F.when((n > 0) & (size >= n), made).otherwise(F.array().cast("array<struct<words:int,letters:int,anchor:bigint>>"))

    zero = F.lit(0)
    word_runs = F.flatten(F.transform("_n.words", lambda n: cut(n, F.size("_t"), lambda i, m: F.xxhash64(F.slice("_t", i, m)), n, zero)))
    letter_runs = F.flatten(F.transform("_n.letters", lambda n: cut(n, F.length("_low"), lambda i, m: F.xxhash64(F.substring("_low", i, m)), zero, n)))
    pieces = shown.select(doc_id, F.explode(F.concat(word_runs, letter_runs)).alias("_p")).select(doc_id, "_p.*")
    # few runs are anchors and few documents candidates: those go to where the texts lie
    anchors = cut_small(wanted.select(passage_id, "_a.*"))
    candidates = cut_small(pieces.join(anchors, ["words", "letters", "anchor"]).select(doc_id, passage_id).distinct())
    full = docs.select(doc_id, F.col(text).alias("_text")).join(candidates, doc_id).join(wanted.select(passage_id, "_passage"), passage_id)
    return full.where(F.contains("_text", "_passage")).select(passage_id, doc_id)


def budget_top(df: DataFrame, category: str, price: str, wanted: str, limit: float, name: str, n: int = 5) -> DataFrame:
    """Cheapest n items of a category within a budget; for an unknown category, the categories there are."""
    found = df.where((F.col(category) == wanted) & (F.col(price) <= limit)).select(F.col(name).cast("string").alias("item"), F.col(price).alias("price")).orderBy("price", "item").limit(n)
    known = df.where(F.col(category) == wanted).limit(1).agg(F.count("*").alias("n"))
    others = with_params(df.select(category).distinct(), known).where("_p.n = 0").select(F.col(category).alias("item"), F.lit(None).cast("double").alias("price"))
    return found.unionByName(others)


def lookup_by_key(requests: DataFrame, df: DataFrame, key: str) -> DataFrame:
    """Rows by a key typed loosely: blanks around it and letter case do not matter."""
    asked = requests.select(F.upper(F.trim(key)).alias("_key"), F.col(key).alias("asked"))
    return asked.join(df.withColumn("_key", F.upper(F.trim(key))), "_key").drop("_key")


def dedupe_keep_first(df: DataFrame, key: str, position: str, n: int | None = None) -> DataFrame:
    """Distinct keys in the order they were first seen."""
    firsts = df.groupBy(key).agg(F.min(position).alias("first_seen")).orderBy("first_seen", key)
    return firsts.limit(n) if n is not None else firsts
