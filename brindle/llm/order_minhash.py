"""Document fingerprints by Order MinHash, in DataFrame functions only.

A text's k-mers are runs of K words, each numbered by its occurrence, so repeats count.  One hash deals the numbered k-mers to
BUCKETS buckets; each bucket keeps its two smallest, puts them back into text order and hashes the pair.  Moving or changing
words changes pairs, so the share of equal ones follows the edit distance and not only the common content.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from brindle.llm.common import BLANKS, staged, text_of

K = 3  # words of a k-mer
BUCKET_BITS = 6  # 64 buckets
PLACE_BITS = 28  # low bits of a number that hold the place in the text
SPAN = 4_096  # ids of a stretch when the next document is looked for
LAST = (1 << 63) - 1  # rows without an id come after all others

_PLACE = (1 << PLACE_BITS) - 1
_HASH = ~_PLACE


def _from(a: Column | str, start: int) -> Column:
    return F.slice(a, start, F.greatest(F.size(a) - (start - 1), F.lit(0)))


def _upto(a: Column | str, cut: int) -> Column:
    return F.slice(a, 1, F.greatest(F.size(a) - cut, F.lit(0)))


def _bucket(v: Column) -> Column:
    return F.shiftrightunsigned(v, 64 - BUCKET_BITS)


def _compact(a: Column) -> Column:
    return F.filter(a, lambda x: x.isNotNull())


def signatures(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Adds for each text column the array of its signature's elements: bucket in the high bits, hash of the pair below.

    A text of fewer than K words is one k-mer; a text without words has no element.  Each layer is a projection of its own, so
    no array is computed twice.
    """
    kept = df.columns
    each = list(columns.items())

    def layer(now: DataFrame, make) -> DataFrame:
        return now.select(*kept, *[F.col(out) for _, out in each if out in now.columns], *[c.alias(f"{out}__{name}") for _, out in each for name, c in make(out).items()])

    bare = lambda c: F.btrim(c, F.lit(BLANKS))
    words = df.select(*kept, *[F.when(bare(c) == "", F.array().cast("array<string>")).otherwise(F.split(bare(c), r"[\x20\x09-\x0D]+")).alias(f"{out}__w") for c, out in each])
    now = layer(words, lambda o: {"w": F.transform(f"{o}__w", lambda x: F.xxhash64(x))})
    now = layer(now, lambda o: {"w": F.col(f"{o}__w"), "two": F.zip_with(_upto(f"{o}__w", 1), _from(f"{o}__w", 2), lambda a, b: F.xxhash64(a, b))})
    now = layer(now, lambda o: {"k": F.when(F.size(f"{o}__w") >= K, F.zip_with(_upto(f"{o}__two", 1), _from(f"{o}__w", 3), lambda a, b: F.xxhash64(a, b).bitwiseAND(F.lit(_HASH))))
                                .when(F.size(f"{o}__w") > 0, F.array(F.xxhash64(f"{o}__w").bitwiseAND(F.lit(_HASH)))).otherwise(F.array().cast("array<bigint>"))})
    # sorted with their places only where a k-mer comes twice; else each is the first of its kind
    now = layer(now, lambda o: {"k": F.col(f"{o}__k"), "s": F.when(F.size(F.array_distinct(f"{o}__k")) < F.size(f"{o}__k"), F.sort_array(
        F.transform(f"{o}__k", lambda x, i: x.bitwiseOR(i.cast("long")))))})
    now = layer(now, lambda o: {"k": F.col(f"{o}__k"), "s": F.col(f"{o}__s"), "starts": F.when(F.col(f"{o}__s").isNotNull(), _compact(F.transform(
        F.zip_with(F.col(f"{o}__s"), F.concat(F.array(F.lit(None).cast("long")), _upto(f"{o}__s", 1)), lambda v, p: p.isNull() | (v.bitwiseAND(F.lit(_HASH)) != p.bitwiseAND(F.lit(_HASH)))),
        lambda new, i: F.when(new, i))))})
    numbered = lambda h, nth, place: F.xxhash64(h, nth.cast("int")).bitwiseAND(F.lit(_HASH)).bitwiseOR(place.cast("long"))
    counts = lambda o: F.flatten(F.transform(F.zip_with(F.col(f"{o}__starts"), F.concat(_from(f"{o}__starts", 2), F.array(F.size(f"{o}__s"))), lambda a, b: b - a),
                                             lambda n: F.sequence(F.lit(0), n - 1)))
    now = layer(now, lambda o: {"g": F.sort_array(F.when(F.col(f"{o}__s").isNull(), F.transform(f"{o}__k", lambda x, i: numbered(x, F.lit(0), i))).otherwise(
        F.zip_with(F.col(f"{o}__s"), counts(o), lambda v, n: numbered(v.bitwiseAND(F.lit(_HASH)), n, v.bitwiseAND(F.lit(_PLACE))))))})
    # the two smallest of each bucket: those whose last but one neighbour lies in another bucket
    now = layer(now, lambda o: {"c": _compact(F.zip_with(F.col(f"{o}__g"), F.concat(F.array(F.lit(None).cast("long"), F.lit(None).cast("long")), _upto(f"{o}__g", 2)),
                                                         lambda v, p: F.when(v.isNotNull() & (p.isNull() | (_bucket(p) != _bucket(v))), v)))})

    def pair(o: str) -> Column:
        triples = F.zip_with(F.zip_with(F.concat(F.array(F.lit(None).cast("long")), _upto(f"{o}__c", 1)), F.col(f"{o}__c"), lambda p, v: F.struct(p.alias("p"), v.alias("v"))),
                             _from(f"{o}__c", 2), lambda a, n: F.struct(a["p"].alias("p"), a["v"].alias("v"), n.alias("n")))
        h = lambda x: F.shiftrightunsigned(x, PLACE_BITS)
        place = lambda x: x.bitwiseAND(F.lit(_PLACE))

        def element(t: Column) -> Column:
            both = t["n"].isNotNull() & (_bucket(t["n"]) == _bucket(t["v"]))
            digest = F.when(both & (place(t["v"]) < place(t["n"])), F.xxhash64(h(t["v"]), h(t["n"]))).when(both, F.xxhash64(h(t["n"]), h(t["v"]))).otherwise(F.xxhash64(h(t["v"])))
            first = t["p"].isNull() | (_bucket(t["p"]) != _bucket(t["v"]))
            return F.when(first, F.shiftleft(_bucket(t["v"]), 64 - BUCKET_BITS).bitwiseOR(F.shiftrightunsigned(digest, BUCKET_BITS)))

        return _compact(F.transform(triples, element))

    return now.select(*kept, *[pair(out).alias(out) for _, out in each])


def fingerprint(elements: Column) -> Column:
    """The signature as a string: sixteen digits an element."""
    return F.array_join(F.transform(elements, lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """From the share of equal pairs among the buckets either text fills.

    A pair survives if both its k-mers do, so the root of that share estimates the common part of the union of k-mers; the
    value returned is the common part of the texts.  Two texts without words are alike.
    """
    buckets = F.size(F.array_union(F.transform(a, _bucket), F.transform(b, _bucket)))
    j = F.sqrt(F.size(F.array_intersect(a, b)) / F.greatest(buckets, F.lit(1)).cast("double"))
    return F.when(buckets == 0, F.lit(1.0)).otherwise(2.0 * j / (1.0 + j))


def next_rows(keys: DataFrame) -> DataFrame:
    """keys (k_id, k_text, ...) with next_id and next_text, the row that follows; the first follows the last.

    Rows are ordered inside stretches of SPAN ids, stretches inside stretches of stretches; only those, one row for SPAN * SPAN
    ids, are ordered together.
    """
    key = F.struct("k_id", "k_text")
    rows = keys.withColumn("b1", F.floor(F.col("k_id") / F.lit(SPAN)).cast("long"))
    rows = rows.withColumn("own", F.lead(key).over(W.partitionBy("b1").orderBy("k_id", "k_text")))
    one = rows.groupBy("b1").agg(F.min(key).alias("first")).withColumn("b2", F.floor(F.col("b1") / F.lit(SPAN)).cast("long"))
    one = one.withColumn("next1", F.lead("first").over(W.partitionBy("b2").orderBy("b1")))
    every = W.partitionBy(F.lit(0))
    two = one.groupBy("b2").agg(F.min("first").alias("first")).select("b2", F.coalesce(F.lead("first").over(every.orderBy("b2")), F.min("first").over(every)).alias("next2"))
    found = rows.join(one.join(two, "b2").select("b1", F.coalesce("next1", "next2").alias("far")), "b1")
    return found.select(*keys.columns, F.coalesce("own", "far").alias("n")).select(*keys.columns, F.col("n.k_id").alias("next_id"), F.col("n.k_text").alias("next_text"))


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for each document.

    The edited text has the last floor(n_chars / 4) code points replaced by as many of the next document in order of doc_id (all
    if it has fewer).  Null text counts as empty.  Null ids come last; rows that share an id follow a hash of their text; equal
    rows are one document in this order and come back as often as they came.
    """
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("k_id"), F.xxhash64(text_of(text)).alias("k_text"), text_of(text).alias("text"))
    small = keyed.groupBy("k_id", "k_text").agg(F.max(F.length("text")).cast("long").alias("n_chars"), F.first("doc_id").alias("doc_id"), F.count("*").alias("copies"))
    order = staged(next_rows(small).withColumn("cut", F.floor(F.col("n_chars") / 4).cast("int")), "order")
    # both uses read the same columns, so the texts are shuffled once
    rows = keyed.groupBy("k_id", "k_text").agg(F.first("text").alias("text"))
    wanted = order.select(F.col("next_id").alias("k_id"), F.col("next_text").alias("k_text"), F.col("k_id").alias("to_id"), F.col("k_text").alias("to_text"), "doc_id", "copies", "n_chars", "cut")
    # a document sends its head and its signature to the one before it, which then has all it needs in one row
    heads = signatures(rows.join(wanted, ["k_id", "k_text"]).drop("k_id", "k_text"), {"text": "next_a"})
    heads = heads.select(F.col("to_id").alias("k_id"), F.col("to_text").alias("k_text"), "doc_id", "copies", "n_chars", "next_a", F.expr("substring(text, 1, cut)").alias("tail"))
    both = rows.join(heads, ["k_id", "k_text"]).select("doc_id", "copies", "n_chars", "next_a", "text", F.expr(
        "concat(substring(text, 1, cast(n_chars - floor(n_chars / 4) as int)), tail)").alias("edited"))
    made = signatures(both, {"text": "a", "edited": "b"})
    return made.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprint(F.col("a")).alias("fingerprint"), fingerprint(F.col("b")).alias("edited_fingerprint"),
                       likeness(F.col("a"), F.col("b")).alias("near_edited"), likeness(F.col("a"), F.col("next_a")).alias("near_next"),
                       F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copy")).drop("copy")
