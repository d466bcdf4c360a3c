"""Corpus pipeline: quality rules, line dedup, near-duplicates, mixing, byte-level BPE.  Each stage is one operator of brindle.llm.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next one's docs.
All but the last return the columns of documents; n_chars is kept equal to the length of the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from brindle.llm.bpe import encode_documents
from brindle.llm.common import staged
from brindle.llm.lines import dedup_lines
from brindle.llm.mixing import mix_documents
from brindle.llm.neardup import keep_one
from brindle.llm.quality_rules import keep_good


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed rules judge good."""
    return keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of repeated three-line windows.  Null texts stay null."""
    kept = dedup_lines(docs)
    own = {"text": F.col("kept_text"), "n_chars": F.coalesce(F.length("kept_text").cast("long"), F.lit(0).cast("long"))}
    return kept.select(*[own[c].alias(c) if c in own else F.col("row")[c].alias(c) for c in docs.columns])


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five words, similarity 0.8.  Repeated rows and rows without an id count as others."""
    return keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources by weights 3, 1, 2 in turn, 150 % of all words, none above twice its source; a document may come twice."""
    return mix_documents(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document, checked by decoding them."""
    return encode_documents(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("quality rules", quality), ("line dedup", lines), ("near-duplicates", near), ("source mix", mix), ("byte-level BPE", bpe)]

#: Expectation-maximisation, the splitting tree and BPE have no SQL; tests/llm/test_pipeline.py compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        made = stage(spark, docs, sf_dir)
        docs = made if i == len(STAGES) - 1 else staged(made, "pipeline")
    return docs
