"""Cutting documents into passages.  A document is one row throughout; nothing is shuffled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# fixed values: passage length, overlap and the places to cut, best first
CHUNK_SIZE, OVERLAP = 700, 120
SEPARATORS = ("\n\n", "\n", ". ", " ")


def chunk_fixed(df: DataFrame, text: str, size: int = CHUNK_SIZE) -> DataFrame:
    """Adds (chunk_no, chunk): consecutive cuts of `size` characters; an empty text has none."""
    starts = F.when(F.length(text) > 0, F.sequence(F.lit(0), (F.length(text) - 1), F.lit(size))).otherwise(F.array().cast("array<int>"))
    parts = F.transform(starts, lambda s: F.substring(F.col(text), s + 1, F.lit(size)))
    return df.select("*", F.posexplode(parts).alias("chunk_no", "chunk")).drop(text)


def _pieces(text: Column, size: int, unit: int, separators: Sequence[str]) -> Column:
    """Pieces no longer than `size`; each separator stays at the front of the piece it opens."""

    def cut_at(pieces: Column, sep: str) -> Column:
        pattern = "(?=" + sep.replace(".", "\\.") + ")"
        return F.flatten(F.transform(pieces, lambda p: F.when(F.length(p) > size, F.split(p, pattern)).otherwise(F.array(p))))

    pieces = F.array(text)
    for sep in separators:
        pieces = cut_at(pieces, sep)
    hard = lambda p: F.transform(F.sequence(F.lit(0), F.length(p) - 1, F.lit(unit)), lambda s: F.substring(p, s + 1, F.lit(unit)))
    return F.filter(F.flatten(F.transform(pieces, lambda p: F.when(F.length(p) > size, hard(p)).otherwise(F.array(p)))), lambda p: F.length(p) > 0)


def chunk_recursive(df: DataFrame, text: str, size: int = CHUNK_SIZE, overlap: int = OVERLAP, separators: Sequence[str] = SEPARATORS) -> DataFrame:
    """Adds (chunk_no, chunk): cut at the best separator that fits, merged greedily up to `size`.

    A passage starts with the last pieces of the one before, as many as fit in `overlap`.
    """
    unit = max(1, overlap // 6)
    empty = F.array().cast("array<string>")

    def suffix(pieces: Column, room: Column) -> Column:
        start = F.struct(empty.alias("kept"), F.lit(0).alias("n"), F.lit(True).alias("open"))

        def take(s: Column, p: Column) -> Column:
            fits = s["open"] & (s["n"] + F.length(p) <= room)
            return F.struct(
                F.when(fits, F.concat(F.array(p), s["kept"])).otherwise(s["kept"]).alias("kept"),
                F.when(fits, s["n"] + F.length(p)).otherwise(s["n"]).alias("n"), fits.alias("open"))

        return F.aggregate(F.reverse(pieces), start, take)

    def add(s: Column, p: Column) -> Column:
        full = (s["n"] + F.length(p) > size) & (F.size(s["cur"]) > 0)
        tail = suffix(s["cur"], F.least(F.lit(overlap), F.lit(size) - F.length(p)))
        return F.struct(
            F.when(full, F.concat(s["done"], F.array(F.array_join(s["cur"], "")))).otherwise(s["done"]).alias("done"),
            F.when(full, F.concat(tail["kept"], F.array(p))).otherwise(F.concat(s["cur"], F.array(p))).alias("cur"),
            (F.when(full, tail["n"]).otherwise(s["n"]) + F.length(p)).alias("n"))

    start = F.struct(empty.alias("done"), empty.alias("cur"), F.lit(0).alias("n"))
    folded = F.aggregate(_pieces(F.col(text), size, unit, separators), start, add, lambda s: F.concat(s["done"], F.array(F.array_join(s["cur"], ""))))
    clean = F.filter(F.transform(folded, lambda c: F.regexp_replace(c, r"^\s+|\s+$", "")), lambda c: F.length(c) > 0)
    return df.select("*", F.posexplode(clean).alias("chunk_no", "chunk")).drop(text)


def chunk_ref(source: Column, number: Column) -> Column:
    return F.concat_ws("#", source.cast("string"), number.cast("string"))


def content_key(*parts: Column) -> Column:
    """SHA-1 of the parts joined by a vertical bar."""
    return F.sha1(F.concat_ws("|", *parts))


def delta_to_embed(rows: DataFrame, cached: DataFrame, key: str = "key") -> DataFrame:
    """Rows whose content has no vector yet."""
    return rows.join(cached.select(key).distinct(), key, "left_anti")


# fixed values: the URL namespace of name-based identifiers
_URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"


def point_id(ref: Column) -> Column:
    """Name-based (version 5) identifier of a reference."""
    h = F.sha1(F.concat(F.unhex(F.lit(_URL_NAMESPACE)), F.encode(ref, "UTF-8")))
    variant = F.lower(F.hex((F.conv(F.substring(h, 17, 2), 16, 10).cast("int").bitwiseAND(0x3F)).bitwiseOR(0x80)))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 19, 2)), F.substring(h, 21, 12))


def upsert(existing: DataFrame, incoming: DataFrame, key: str, version: str) -> DataFrame:
    """Incoming rows replace existing ones with the same key; the highest version wins."""
    rest = [c for c in existing.columns if c != key]
    return existing.unionByName(incoming).groupBy(key).agg(F.max_by(F.struct(*rest), version).alias("_r")).select(key, "_r.*")
