"""Queries of the operators on conversations and pages, with their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from brindle.llm.conversation_repair import damaged, repair
from brindle.llm.prefix_trie import prefix_trie
from brindle.llm.registry import query
from brindle.llm.warc import archived_pages

#: One byte's eight steps of the reflected polynomial; DuckDB has no crc32.  Fixed value: 3988292384.
_STEP = "list_reduce([xor(x, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, (y & 1) * 3988292384))"


def crc32_sql(text: str) -> str:
    """crc32 of an ASCII string."""
    bytes_ = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::UBIGINT)"
    return f"xor(list_reduce(list_concat([4294967295::UBIGINT], {bytes_}), lambda x, b: {_STEP}), 4294967295::UBIGINT)"


def _op(state: str, cost: str, letter: str, line: str | None = None) -> str:
    more = f"{state}.r" if line is None else f"list_append({state}.r, {line})"
    return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'r': {more}}} END"


def _least(*options: str) -> str:
    """The least (cost, audit); nulls are no way."""
    return f"list_min(list_filter([{', '.join(options)}], lambda o: o IS NOT NULL))"


def _closed(values: list[str], source: str, keep: str) -> str:
    """Insertions at one place: at most two follow each other."""
    two = f"SELECT {keep}, {values[0]} AS f0, {values[1]} AS f1, {values[2]} AS f2, {values[3]} AS f3 FROM {source}"
    user = _least("f2", *[_op(f, "3", "I", "'user:'") for f in ("f0", "f1", "f3")])
    three = f"SELECT *, {user} AS u FROM ({two})"
    return f"SELECT conv_id, i, f0 AS s0, f1 AS s1, u AS s2, {_least('f3', _op('u', '3', 'I', quote('assistant:')))} AS s3 FROM ({three})"


def quote(text: str) -> str:
    return f"'{text}'"


def _op11() -> str:
    nothing = "NULL::STRUCT(c BIGINT, a VARCHAR, r VARCHAR[])"
    start = _closed(["{'c': 0::BIGINT, 'a': '', 'r': []::VARCHAR[]}", nothing, nothing, nothing], "convs", "conv_id, 0 AS i")
    more, line = "CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END", "role || ':' || text"
    stay = "fault NOT IN ('blank', 'duplicate')"

    def ways(q: int) -> str:
        found = [_op(f"s{q}", "4", "D")]
        sources = {1: [0], 2: [0, 1, 3], 3: [2]}.get(q, [])
        for p in sources:
            found.append(f"CASE WHEN {stay} AND left(role, 1) = '{' sua'[q]}' THEN {_op(f's{p}', more, 'K', line)} END")
            if q > 1:
                name = "user:" if q == 2 else "assistant:"
                found.append(f"CASE WHEN {stay} THEN {_op(f's{p}', f'3 + {more}', 'R', quote(name) + ' || text')} END")
        return _least(*found)

    step = _closed([ways(q) for q in range(4)], "steps JOIN faulty USING (conv_id) WHERE n = i + 1", "conv_id, i + 1 AS i")
    return f"""
WITH RECURSIVE convs AS (SELECT DISTINCT conv_id FROM conversations),
marked AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc32_sql("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS k FROM conversations),
after AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role, CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(range(CASE WHEN k = 3 THEN 2 ELSE 1 END)) AS copy FROM marked WHERE k <> 0),
faulty AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS n,
  CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 'truncated' ELSE '' END AS fault FROM after),
steps AS ({start} UNION ALL {step}),
sizes AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
  count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated FROM faulty GROUP BY 1),
pairs AS (SELECT conv_id, count(*) AS illegal FROM (SELECT conv_id, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY n) || left(role, 1) AS p FROM faulty) WHERE p NOT IN ('su', 'ua', 'au') GROUP BY 1),
best AS (SELECT conv_id, {_least('s0', 's3')} AS b FROM steps LEFT JOIN sizes USING (conv_id) WHERE i = coalesce(n, 0))
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, b.c AS cost, b.a AS audit, sha256(array_to_string(b.r, chr(10))) AS repaired_sha256
FROM best LEFT JOIN sizes USING (conv_id) LEFT JOIN pairs USING (conv_id)
"""


def conversations(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/conversations.parquet")


@query("op11_conversation_repair", _op11())
def op11(spark: SparkSession, sf: str) -> DataFrame:
    """Damaged conversations and their cheapest repairs."""
    told = conversations(spark, sf)
    return repair(damaged(told), told)


OP12 = f"""
WITH ids AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {crc32_sql('conv_id::VARCHAR')} % 6 AS h FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)),
turns AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM conversations WHERE conv_id IS NOT NULL),
heads AS (SELECT ids.conv_id, pos AS d, role, text FROM ids JOIN turns ON turns.conv_id = base AND pos <= h::BIGINT),
rebuilt AS (SELECT * FROM heads UNION ALL SELECT ids.conv_id, pos - h::BIGINT + (SELECT count(*) FROM heads WHERE heads.conv_id = ids.conv_id), role, text FROM ids JOIN turns ON turns.conv_id = ids.conv_id AND pos > h),
prefixes AS (SELECT conv_id, d AS depth, list({{'role': role, 'text': text}}) OVER (PARTITION BY conv_id ORDER BY d) AS k FROM rebuilt UNION ALL SELECT conv_id, 0, [] FROM ids),
nodes AS (SELECT depth, k, min(conv_id) AS conv_id, count(*) AS n_convs, CASE WHEN depth > 0 THEN length(k[-1].text) ELSE 0 END AS n FROM prefixes GROUP BY depth, k),
kids AS (SELECT depth - 1 AS depth, k[1:depth - 1] AS k, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1, 2),
trie AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (depth, k)),
chains AS (SELECT u AS depth, k[1:u] AS k, depth AS v, n_convs, n, n_children FROM (SELECT *, unnest(range(0, depth + 1)) AS u FROM trie)),
sums AS (SELECT depth, k, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * n)::BIGINT AS saved_tokens FROM chains GROUP BY 1, 2),
ends AS (SELECT depth, k, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS e FROM (SELECT * FROM prefixes QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY depth DESC) = 1) GROUP BY 1, 2)
SELECT trie.conv_id, trie.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, trie.n_convs, trie.n_children, n_leaves, saved_tokens, sha256(coalesce(e, '')) AS ends_sha256
FROM trie JOIN sums USING (depth, k) LEFT JOIN ends USING (depth, k) LEFT JOIN trie AS up ON up.depth = trie.depth - 1 AND up.k = trie.k[1:trie.depth - 1]
"""


@query("op12_prefix_trie", OP12)
def op12(spark: SparkSession, sf: str) -> DataFrame:
    """Nodes of the trie of all rebuilt conversations."""
    return prefix_trie(conversations(spark, sf))


OP13 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages), q AS (SELECT page_id, strlen(html) AS payload_bytes, sha256(html) AS payload_digest FROM p),
r AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN first_value(page_id) OVER (PARTITION BY payload_digest ORDER BY page_id) ELSE page_id END AS first FROM q)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to FROM r
"""


@query("op13_warc_archives", OP13)
def op13(spark: SparkSession, sf: str) -> DataFrame:
    """All pages, written as archives, normalised to members and read back."""
    return archived_pages(spark.read.parquet(f"{sf}/pages.parquet"))
