"""A stored lexical index in blocks of falling impact, and exact search that reads only blocks which can matter.

The index is three tables: postings by (document, term), statistics by term, and blocks: the postings of a term by falling impact,
`BLOCK` to a row with the greatest impact in it.  A term of very many documents is dealt into shards by a hash of the document, each
with blocks of its own, so no term is ordered in one task.

Search runs in two passes.  The first reads each term's leading blocks; the sums it gets are too small if anything, so the k-th
of them is a score the k-th result reaches.  With that mark, the terms that weigh least are set aside as long as all of them together
stay below it, and of each other term only blocks are read whose impact exceeds the rest of the mark in proportion: a document that
is in none of these cannot reach the mark.  What is found is bounded again, with what its unread terms can add at most, and the few
documents that are left are scored in full from the postings.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from brindle.functions.expr import with_params
from brindle.sources.scratch import cut_lineage, cut_small, scratch_path

# fixed values: term saturation, length normalization and floor of the lexical score
K1, B, EPSILON = 1.5, 0.75, 0.25
BLOCK = 128  # postings of a block
SHARD = 65_536  # postings of a term that are ordered together
LEADING = 4  # blocks of each term and shard that the first pass reads
FEW_PAIRS = 10_000  # (query, document) that are looked up one by one
SLACK = 1e-7  # scores are rounded to eight places


@dataclass
class LexicalIndex:
    """The folders of a stored index; any session that reaches them can search it."""

    spark: SparkSession
    path: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")


def tokens(text):
    """Lower-cased, split on white space."""
    return F.array_remove(F.split(F.lower(text), r"\s+"), "")


def words_of(texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """(row, word) of all `tokens` of lower-cased texts; a null has none.

    Texts are handed over whole: as lists of words they would be several times as dear to bring to Python.
    """
    lists = pc.ascii_split_whitespace(texts)
    flat, row = lists.flatten(), np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    empty = pc.equal(flat, "").to_numpy(zero_copy_only=False)  # before white space at the start of a text, or after that at its end
    if empty.any():
        flat, row = flat.filter(pa.array(~empty)), row[~empty]
    return row, flat.dictionary_encode()


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, dl, term, tf) of rows (doc, low)."""
    for b in batches:
        at, words = words_of(b.column("low"))
        size, n = np.bincount(at, minlength=b.num_rows), max(len(words.dictionary), 1)
        key, tf = np.unique(at * n + words.indices.to_numpy(), return_counts=True)
        row = key // n
        columns = [b.column("doc").take(pa.array(row)), pa.array(size[row].astype("int64")), words.dictionary.take(pa.array(key % n)), pa.array(tf.astype("int64"))]
        yield pa.RecordBatch.from_arrays(columns, names=["doc", "dl", "term", "tf"])


def term_counts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc, dl, term, tf): terms are counted where a text lies and nothing is exchanged.

    Rows of the same document and length count as one; only documents that have several rows, or no id, are put together by a shuffle.
    """
    ids = docs.select(F.col(doc_id).alias("doc")).groupBy("doc").agg(F.count("*").alias("n"))
    several = cut_lineage(ids.where("n > 1 OR doc IS NULL").select(F.col("doc").alias("_doc"), F.lit(True).alias("_several")))

    def counted(rows: DataFrame) -> DataFrame:
        kind = rows.schema["doc"].dataType.simpleString()
        return rows.select("doc", F.lower("text").alias("low")).mapInArrow(_count_terms, f"doc {kind}, dl bigint, term string, tf bigint")

    rows, few = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text")), several.count()
    if not few:
        return counted(rows)
    flagged = rows.join(F.broadcast(several) if few <= 200_000 else several, F.col("doc").eqNullSafe(F.col("_doc")), "left").drop("_doc")
    merged = counted(flagged.where("_several")).groupBy("doc", "dl", "term").agg(F.sum("tf").alias("tf"))
    return counted(flagged.where("_several IS NULL")).unionByName(merged)


def build_index(docs: DataFrame, doc_id: str, text: str, path: str | None = None, asked: DataFrame | None = None) -> LexicalIndex:
    """Write the index of a corpus.  Documents without a token count towards the number of documents only; null texts have none.

    Inverse document frequencies below zero are replaced by a quarter of the vocabulary's mean.  Where all queries that the index is for are
    known (`asked`, with the same column of texts), the postings of other terms, which no search can meet, are not put in order.
    """
    spark = docs.sparkSession
    index = LexicalIndex(spark, path or scratch_path(spark, "lexical"))
    counts, size = term_counts(docs, doc_id, text), F.size(tokens(text)).cast("bigint")
    sizes = docs.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.when(F.col(text).isNotNull(), size)), F.lit(0)).alias("total"))
    corpus = cut_lineage(sizes.select("n", (F.col("total") / F.greatest("n", F.lit(1))).alias("avgdl")))
    part = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / F.col("_c.avgdl")))
    with_params(counts, corpus, "_c").select("doc", "term", part.alias("part")).write.parquet(f"{index.path}/postings")
    postings = index.table("postings")
    df = with_params(cut_lineage(postings.groupBy("term").agg(F.count("*").alias("df"), F.max("part").alias("best"))), corpus, "_c")
    idf = df.select("term", "df", "best", F.ln((F.col("_c.n") - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"))
    floor = idf.agg((F.avg("idf") * EPSILON).alias("low"))
    with_params(idf, floor, "_f").select("term", "df", "best", F.when(F.col("idf") < 0, F.col("_f.low")).otherwise(F.col("idf")).alias("idf")).write.parquet(f"{index.path}/terms")
    # only terms of more than one shard, one in SHARD postings at most, need to be told; postings move once
    large = index.table("terms").where(F.col("df") > SHARD).select("term", F.ceil(F.col("df") / SHARD).alias("shards"))
    if asked is not None:
        postings = postings.join(cut_small(asked.select(F.explode(tokens(text)).alias("term")).distinct()), "term", "left_semi")
    placed = postings.join(F.broadcast(large), "term", "left").withColumn("shard", F.pmod(F.xxhash64("doc"), F.coalesce("shards", F.lit(1).cast("bigint"))).cast("int"))
    order = Window.partitionBy("term", "shard").orderBy(F.desc("part"), "doc")
    placed = placed.withColumn("block", ((F.row_number().over(order) - 1) / BLOCK).cast("int"))
    blocks = placed.groupBy("term", "shard", "block").agg(F.max("part").alias("top"), F.collect_list(F.struct("doc", "part")).alias("rows"))
    blocks.write.parquet(f"{index.path}/blocks")
    return index


def weights(index: LexicalIndex, queries: DataFrame, query_id: str, text: str) -> DataFrame:
    """(q, term, w, cap): weight of each term of a query, and what it can add to a score at most."""
    words = queries.select(F.col(query_id).alias("q"), F.explode(tokens(text)).alias("term")).groupBy("q", "term").agg(F.count("*").alias("qtf"))
    known = words.join(index.table("terms"), "term").withColumn("w", F.col("qtf") * F.col("idf"))
    return known.select("q", "term", "w", F.greatest(F.col("w") * F.col("best"), F.lit(0.0)).alias("cap"), F.least(F.col("w") * F.col("best"), F.lit(0.0)).alias("loss"))


def leading_blocks(index: LexicalIndex, asked: DataFrame) -> DataFrame:
    """(q, term, w, rows) that the first pass reads."""
    return asked.join(index.table("blocks").where(F.col("block") < LEADING), "term").select("q", "term", "w", "rows")


def marks(index: LexicalIndex, asked: DataFrame, k: int) -> DataFrame:
    """(q, mark): a score that the k-th result of the query reaches; 0 where fewer documents were seen."""
    seen = leading_blocks(index, asked).select("q", "w", F.explode("rows").alias("r"))
    # a term of negative weight takes something away from documents that were not seen with it
    loss = asked.groupBy("q").agg(F.sum("loss").alias("loss"))
    sums = seen.where("w > 0").groupBy("q", "r.doc").agg(F.sum(F.col("w") * F.col("r.part")).alias("s"))
    kth = sums.withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("s")))).where(F.col("n") == k)
    found = loss.join(kth, "q", "left")
    return found.select("q", F.greatest(F.coalesce(F.col("s") + F.col("loss"), F.lit(0.0)) - SLACK, F.lit(0.0)).alias("mark"))


def cut_terms(asked: DataFrame, mark: DataFrame) -> DataFrame:
    """(q, term, w, mark, most): a document with at most `most` from every term of the query is below the mark."""
    rising = Window.partitionBy("q").orderBy("cap", "term").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("q")
    held = asked.join(mark, "q").withColumn("sofar", F.sum("cap").over(rising))
    aside = F.col("sofar") < F.col("mark")
    held = held.withColumns({"aside": aside, "set": F.sum(F.when(aside, F.col("cap")).otherwise(0.0)).over(whole), "rest": F.sum(F.when(aside, 0.0).otherwise(F.col("cap"))).over(whole)})
    share = F.when(F.col("rest") > 0, F.least((F.col("mark") - F.col("set")) / F.col("rest"), F.lit(1.0))).otherwise(F.lit(1.0))
    return held.select("q", "term", "w", "mark", "aside", F.when(F.col("aside"), F.col("cap")).otherwise(share * F.col("cap") * (1 - 1e-12)).alias("most"))


def open_blocks(index: LexicalIndex, cut: DataFrame) -> DataFrame:
    """(q, term, w, most, rows) that the second pass reads."""
    blocks = index.table("blocks")
    return cut.where("NOT aside").join(blocks, (cut["term"] == blocks["term"]) & (cut["w"] * blocks["top"] > cut["most"])).select("q", cut["term"], "w", "most", "rows")


def _full_scores(index: LexicalIndex, asked: DataFrame, left: DataFrame) -> DataFrame:
    """(q, doc, score) of at least the pairs that are left.

    Few pairs go to where the postings lie.  Where the mark sets little aside, looking up every term of every pair would be many times
    the postings; then the postings of asked terms are dealt by document once, and meet all queries there.
    """
    left = _written(left, "left")
    postings, words = index.table("postings"), asked.select("q", "term", "w")
    if left.count() <= FEW_PAIRS:
        found = postings.join(F.broadcast(left.join(words, "q")), ["doc", "term"])
    else:
        used = postings.join(asked.select("term").distinct(), "term", "left_semi")
        found = used.repartition("doc").join(words, "term")
    return found.groupBy("q", "doc").agg(F.sum(F.col("w") * F.col("part")).alias("score"))


def search(index: LexicalIndex, queries: DataFrame, query_id: str, text: str, k: int, doc_id: str = "doc") -> DataFrame:
    """(query, doc, score, rank): best k documents with a positive score, ties by document id, rank from 0.  Exact."""
    asked = _written(weights(index, queries, query_id, text), "weights")
    cut = _written(cut_terms(asked, marks(index, asked, k)), "cuts")
    read = open_blocks(index, cut).select("q", "w", "most", F.explode("rows").alias("r"))
    gained = read.groupBy("q", F.col("r.doc").alias("doc")).agg(F.sum(F.col("w") * F.col("r.part") - F.col("most")).alias("more"))
    unread = cut.groupBy("q").agg(F.sum("most").alias("all"), F.max("mark").alias("mark"))
    left = gained.join(unread, "q").where(F.col("all") + F.col("more") >= F.col("mark") - SLACK).select("q", "doc")
    scored = _full_scores(index, asked, left).select("q", "doc", F.round("score", 8).alias("score")).where("score > 0")
    best = Window.partitionBy("q").orderBy(F.desc("score"), "doc")
    ranked = scored.withColumn("rank", F.row_number().over(best) - 1).where(F.col("rank") < k)
    return ranked.select(F.col("q").alias(query_id), F.col("doc").alias(doc_id), "score", "rank")


def postings_read(index: LexicalIndex, queries: DataFrame, query_id: str, text: str, k: int) -> tuple[int, int]:
    """(postings that both passes read, postings that all terms of all queries have)."""
    asked = weights(index, queries, query_id, text)
    cut = cut_terms(asked, marks(index, asked, k))
    size = F.coalesce(F.sum(F.size("rows")), F.lit(0))
    read = sum(part.agg(size).first()[0] for part in (leading_blocks(index, asked), open_blocks(index, cut)))
    return read, asked.join(index.table("terms"), "term").agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0]


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
