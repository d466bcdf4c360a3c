"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from brindle.llm.bpe import encode_documents
from brindle.llm.common import documents, staged
from brindle.llm.compression_quality import score_quality
from brindle.llm import conversation_queries  # noqa: F401  registers its queries
from brindle.llm.lines import dedup_lines
from brindle.llm.maxent_lm import score_texts
from brindle.llm.mixing import mix_words
from brindle.llm.neardup import near_duplicates
from brindle.llm.order_minhash import fingerprints
from brindle.llm.pii import private_spans
from brindle.llm.quality_rules import STATS, fit_rules, judge, text_stats, votes
from brindle.llm.registry import ORACLES, QUERIES, query
from brindle.llm.substrings import remove_repeats


def load():
    return dict(QUERIES), dict(ORACLES)


@query("op1_source_mix")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    """Words the mix takes of each document: weights 3, 1, 2 in turn, 150% of all words, none above twice its source."""
    return mix_words(documents(spark, sf))


@query("op2_quality_rules")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    """Rule statistics of all documents and the verdict of the weighed votes."""
    stats = text_stats(documents(spark, sf))
    voted = staged(votes(stats.select("row.doc_id", *[c for c in stats.columns if c != "row"])), "votes")
    return judge(voted, fit_rules(voted)).select("doc_id", *STATS, "base_failed", "kept", "p_good")


@query("op3_compression_quality")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    """Quality scores of all documents from two compression dictionaries."""
    return score_quality(documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet"))


OP4 = """
WITH lines AS (SELECT doc_id, line, pos FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
    LATERAL (SELECT unnest(l) AS line, unnest(range(0, len(l))) AS pos)),
solid AS (SELECT doc_id, line, pos, row_number() OVER (PARTITION BY doc_id ORDER BY pos) - 1 AS nth FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
windows AS (SELECT a.doc_id, a.nth, a.line || chr(10) || b.line || chr(10) || c.line AS w FROM solid a
  JOIN solid b ON b.doc_id = a.doc_id AND b.nth = a.nth + 1 JOIN solid c ON c.doc_id = a.doc_id AND c.nth = a.nth + 2),
late AS (SELECT doc_id, nth FROM windows QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id, nth) > 1),
gone AS (SELECT DISTINCT s.doc_id, s.pos, s.nth FROM solid s JOIN late l ON l.doc_id = s.doc_id AND s.nth BETWEEN l.nth AND l.nth + 2),
runs AS (SELECT doc_id, count(*) AS n_removed, sum(fresh) AS n_spans FROM (
  SELECT doc_id, CASE WHEN nth - lag(nth) OVER (PARTITION BY doc_id ORDER BY nth) = 1 THEN 0 ELSE 1 END AS fresh FROM gone) GROUP BY 1),
kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS k FROM lines WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = lines.doc_id AND g.pos = lines.pos) GROUP BY 1)
SELECT d.doc_id, (SELECT count(*) FROM solid s WHERE s.doc_id = d.doc_id) AS n_lines, coalesce(r.n_removed, 0)::BIGINT AS n_removed,
  coalesce(r.n_spans, 0)::BIGINT AS n_spans, sha256(coalesce(k.k, '')) AS kept_sha256
FROM documents d LEFT JOIN runs r USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""


@query("op4_line_dedup", OP4)
def op4(spark: SparkSession, sf: str) -> DataFrame:
    """All documents without the lines of repeated three-line windows."""
    return dedup_lines(documents(spark, sf)).select("row.doc_id", "n_lines", "n_removed", "n_spans", F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))


@query("op5_maxent_lm")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    """Log probabilities of all documents under the unigram base and the maximum-entropy model."""
    return score_texts(documents(spark, sf))


@query("op6_private_spans")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    """Spans of personal data in all documents."""
    return private_spans(documents(spark, sf))


@query("op7_byte_bpe")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    """Byte-level BPE ids of all documents, and their decoding."""
    import public_tokenizers

    return encode_documents(documents(spark, sf), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


OP8 = """
WITH hexed AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (SELECT doc_id, s, h[2 * s + 1 : 2 * s + 200] AS w FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 99)) AS s FROM hexed)),
late AS (SELECT doc_id, s FROM windows QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id, s) > 1),
starts AS (SELECT doc_id, s, CASE WHEN s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) <= 100 THEN 0 ELSE 1 END AS fresh FROM late),
runs AS (SELECT doc_id, r, min(s) AS a, max(s) + 100 AS b FROM (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s) AS r FROM starts) GROUP BY 1, 2),
kept AS (SELECT doc_id, string_agg(h[2 * lo + 1 : 2 * hi], '' ORDER BY lo) AS k FROM (
  SELECT hexed.doc_id, h, coalesce(lag(b) OVER (PARTITION BY hexed.doc_id ORDER BY a), 0) AS lo, a AS hi FROM hexed JOIN
    (SELECT doc_id, a, b FROM runs UNION ALL SELECT doc_id, length(h) // 2, length(h) // 2 FROM hexed) AS cuts ON cuts.doc_id = hexed.doc_id) GROUP BY 1)
SELECT hexed.doc_id, length(h) // 2 AS n_bytes, (length(h) - length(k)) // 2 AS n_removed,
  (SELECT count(*) FROM runs WHERE runs.doc_id = hexed.doc_id) AS n_spans, sha256(unhex(k)) AS kept_sha256
FROM hexed JOIN kept ON kept.doc_id = hexed.doc_id
"""


@query("op8_repeated_substrings", OP8)
def op8(spark: SparkSession, sf: str) -> DataFrame:
    """Bytes of all documents that no repeated 100-byte string covers."""
    return remove_repeats(documents(spark, sf), length=100).drop("kept")


@query("op9_order_minhash")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    """Order MinHash fingerprints of all documents and of their edited texts."""
    return fingerprints(documents(spark, sf))


OP10 = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM words
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * common >= 85 * (p.n + q.n - common)
), reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y),
low AS (SELECT x, min(y) AS component_id FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, low.component_id, d.doc_id = low.component_id AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN low ON low.x = d.doc_id
"""


@query("op10_near_duplicates", OP10)
def op10(spark: SparkSession, sf: str) -> DataFrame:
    """Near-duplicate components of all documents on 3-word shingles at 0.85."""
    return near_duplicates(documents(spark, sf), k=3, num=85, den=100).drop("text_hash")


@query("pipeline")
def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    """The stages of corpus_pipeline.py over all documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)
