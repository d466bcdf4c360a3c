"""Line deduplication by overlapping three-line windows, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from brindle.llm.common import BLANKS, staged, text_of

LAST = (1 << 63) - 1  # rows without an id come after all others


def _identity(row: Column, doc_id: str, text: str) -> list[Column]:
    return [F.coalesce(row[doc_id].cast("long"), F.lit(LAST)).alias("k_id"), F.xxhash64(F.coalesce(row[text].cast("string"), F.lit(""))).alias("k_text")]


def line_windows(docs: DataFrame, width: int = 3) -> DataFrame:
    """(k_id, k_text, nth, at, h1, h2): each run of `width` consecutive lines with a word; `at` holds their line numbers.

    Expects k_id, k_text and text.  Lines without a word are passed over and never counted.  Two hashes, 96 bits together.
    """
    lines = docs.select("k_id", "k_text", F.split("text", "\n").alias("lines"))
    full = lines.select("k_id", "k_text", F.filter(F.transform("lines", lambda x, i: F.struct(i.alias("at"), x.alias("line"))),
                                                   lambda s: F.btrim(s["line"], F.lit(BLANKS)) != "").alias("full"))
    full = full.where(F.size("full") >= width)

    def window(i: Column) -> Column:
        own = [F.get(F.col("full"), i + j) for j in range(width)]
        texts = [o["line"] for o in own]
        return F.struct(i.cast("int").alias("nth"), F.array(*[o["at"] for o in own]).alias("at"), F.xxhash64(*texts).alias("h1"), F.hash(*texts).alias("h2"))

    each = full.select("k_id", "k_text", F.explode(F.transform(F.sequence(F.lit(0), F.size("full") - width), window)).alias("w"))
    return each.select("k_id", "k_text", "w.*")


def dedup_lines(docs: DataFrame, width: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, n_lines, n_removed, n_spans, kept_text) for each document; `row` is the document as it came.

    A window of `width` consecutive lines (lines without a word passed over, bytes compared as they are) is repeated when the
    same lines stand earlier: in a smaller document or further up in the same one.  All lines that repeated windows cover go;
    the others, blank ones too, are joined again.  n_lines counts lines with a word, n_spans runs of removed ones.

    * Windows are counted by hash with partial sums, so a window that a third of all documents hold is one row a task; only
      windows found twice go back to their places, in a join that adaptive execution can split.
    * Null text counts as empty and stays null; fewer than `width` lines with a word: nothing goes.  Null ids come last; rows
      that share an id follow a hash of their text, fully equal rows are one place and stay equal.
    """
    rows = docs.select(F.struct("*").alias("row"))
    keyed = rows.select("row", *_identity(F.col("row"), doc_id, text), F.coalesce(F.col("row")[text].cast("string"), F.lit("")).alias("text"))
    windows = staged(line_windows(keyed.select("k_id", "k_text", "text"), width), "windows")
    place = F.struct("k_id", "k_text", "nth")
    twice = windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last")).where(F.col("first") < F.col("last")).drop("last")
    late = windows.join(twice, ["h1", "h2"]).where(place > F.col("first")).select("k_id", "k_text", "nth", "at")
    lists = late.groupBy("k_id", "k_text").agg(F.sort_array(F.collect_set("nth")).alias("nths"), F.sort_array(F.array_distinct(F.flatten(F.collect_set("at")))).alias("gone"))
    joined = keyed.join(lists, ["k_id", "k_text"], "left").select("row", F.split("text", "\n").alias("lines"), "text", "nths", "gone")
    # what stands between two removed lines is one slice
    ends = F.concat(F.col("gone"), F.array(F.size("lines")))
    kept = F.when(F.col("gone").isNull(), F.col("row")[text].cast("string")).otherwise(F.array_join(F.flatten(F.zip_with(
        F.concat(F.array(F.lit(-1)), F.col("gone")), ends, lambda a, b: F.slice(F.col("lines"), a + 2, b - a - 1))), "\n"))
    gaps = F.zip_with(F.col("nths"), F.slice("nths", 2, F.greatest(F.size("nths") - 1, F.lit(0))), lambda a, b: F.coalesce((b - a > width).cast("int"), F.lit(1)))
    return joined.select(
        "row", F.size(F.filter("lines", lambda x: F.btrim(x, F.lit(BLANKS)) != "")).cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_removed"),
        F.when(F.col("nths").isNull(), 0).otherwise(F.aggregate(gaps, F.lit(0), lambda s, x: s + x)).cast("long").alias("n_spans"),
        kept.alias("kept_text"))
