"""Mixing sources to target weights, in DataFrame functions only.

Documents fall into blocks of about BLOCK_WORDS words inside their source.  A source's target becomes a quota of blocks, the last
one cut to the word.  A splitting tree deals the quotas out: each node halves its blocks, and how many of each source go left
is drawn from the multivariate hypergeometric distribution, so the shards hold exact counts that look like a random deal.  The
blocks themselves come from a random order of each source, and each shard takes the next ones: no block is drawn twice before
all others were drawn once.  Inside a shard documents stand in random order.  All chance is a hash of the seed.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from brindle.llm.common import BLANKS, WORD, staged, text_of

BLOCK_WORDS = 8_192
SHARD_BLOCKS = 64  # blocks of a shard, about

_LOG_FACTORIAL = [math.lgamma(i + 1) for i in range(32)]  # below, the series of Stirling is not exact enough


def _let(value: Column, body) -> Column:
    """Name an intermediate value inside an expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _unit(*parts: Column) -> Column:
    """A number in (0, 1) from a hash."""
    return (F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") + 0.5) / float(1 << 53)


def _log_factorial(n: Column) -> Column:
    x = n.cast("double")
    series = x * F.log(x) - x + 0.5 * F.log(x * (2 * math.pi)) + 1.0 / (12.0 * x) - 1.0 / (360.0 * x * x * x)
    return F.when(n < len(_LOG_FACTORIAL), F.element_at(F.lit(_LOG_FACTORIAL), n.cast("int") + 1)).otherwise(series)


def hypergeometric(total: Column, good: Column, drawn: Column, unit: Column) -> Column:
    """How many of `drawn` from `total` are among the `good`: the distribution inverted at `unit`.

    Values further than eight deviations from the mode, whose weight vanishes in a double, are left out.
    """
    low = F.greatest(F.lit(0), drawn + good - total)
    high = F.least(drawn, good)
    share = good.cast("double") / F.greatest(total, F.lit(1))
    deviation = F.sqrt(drawn * share * (1 - share) + 1.0)
    middle = F.least(high, F.greatest(low, F.floor((drawn + 1).cast("double") * (good + 1) / (total + 2))))

    def weight(x: Column, m: Column) -> Column:
        at = lambda v: _log_factorial(v) + _log_factorial(good - v) + _log_factorial(drawn - v) + _log_factorial(total - good - drawn + v)
        return F.exp(at(m) - at(x))

    def around(m: Column) -> Column:
        first = F.greatest(low, m - F.ceil(8 * deviation) - 8)
        last = F.least(high, m + F.ceil(8 * deviation) + 8)
        weights = F.transform(F.sequence(first, last), lambda x: weight(x, m))
        pick = lambda w: _let(F.aggregate(w, F.lit(0.0), lambda s, v: s + v) * unit, lambda goal: F.aggregate(
            w, F.struct(F.lit(0.0).alias("sum"), F.lit(0).cast("long").alias("k")),
            lambda s, v: F.struct((s["sum"] + v).alias("sum"), (s["k"] + (s["sum"] + v < goal).cast("long")).alias("k")))["k"])
        return F.least(last, first + _let(weights, pick))

    return _let(middle, around)


def source_key(source: str = "source") -> Column:
    """A source as a key without nulls."""
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("null"))


def source_targets(sizes: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(key, nth, source_size, target) for each source, from (key, source, size) rows.

    Sources in code point order, null last, take the weights in turn and share `share` times all words by them; none gets more
    than `cap` times its own words, and what is over goes to the others by weight until none is above.  With sources in order of
    cap / weight the stopped ones come first, so running sums settle it without rounds.  One row a source is all this handles.
    """
    one = sizes.groupBy("key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    nth = F.row_number().over(W.partitionBy(F.lit(0)).orderBy(F.col("source").isNull(), "source")) - 1
    s = one.withColumn("nth", nth).withColumn("weight", F.element_at(F.lit([float(x) for x in weights]), F.pmod("nth", F.lit(len(weights))).cast("int") + 1))
    s = s.withColumn("most", cap * F.col("source_size")).withColumn("level", F.col("most") / F.col("weight"))
    all_ = W.partitionBy(F.lit(0))
    upto = all_.orderBy("level", "nth").rowsBetween(W.unboundedPreceding, 0)
    s = s.withColumn("goal", share * F.sum("source_size").over(all_))
    filled = F.sum("most").over(upto) + F.col("level") * (F.sum("weight").over(all_) - F.sum("weight").over(upto))
    s = s.withColumn("stopped", filled <= F.col("goal"))
    free = F.sum(F.when(~F.col("stopped"), F.col("weight"))).over(all_)
    rest = F.col("goal") - F.coalesce(F.sum(F.when(F.col("stopped"), F.col("most"))).over(all_), F.lit(0.0))
    target = F.when(F.col("stopped"), F.col("most")).otherwise(F.least(F.col("most"), rest * F.col("weight") / free))
    return s.select("key", "nth", "source_size", target.cast("double").alias("target"))


def _splitting_tree(quotas: DataFrame, depth: int, seed: int) -> DataFrame:
    """(shard, nth, blocks): the quotas (nth, draws) of all sources dealt to 2 ** depth shards."""
    q = F.sort_array(F.collect_list(F.struct("nth", "draws")))
    tree = quotas.agg(F.transform(q, lambda x: x["draws"]).alias("q"), F.transform(q, lambda x: x["nth"]).alias("nths")).select(F.lit(0).cast("long").alias("shard"), "q", "nths")
    for level in range(depth):
        total = F.aggregate("q", F.lit(0).cast("long"), lambda s, x: s + x)

        def left(t: Column) -> Column:
            start = F.struct(t.alias("total"), F.floor(t / 2).cast("long").alias("drawn"), F.array().cast("array<bigint>").alias("out"))

            def step(s: Column, x: Column) -> Column:
                unit = _unit(F.lit(seed), F.lit(level), F.col("shard"), F.size(s["out"]))
                return _let(hypergeometric(s["total"], x, s["drawn"], unit).cast("long"), lambda k: F.struct(
                    (s["total"] - x).alias("total"), (s["drawn"] - k).alias("drawn"), F.concat(s["out"], F.array(k)).alias("out")))

            return F.aggregate("q", start, step)["out"]

        tree = tree.select("shard", "q", "nths", _let(total, left).alias("l"))
        tree = tree.select("nths", F.explode(F.array(
            F.struct((F.col("shard") * 2).alias("shard"), F.col("l").alias("q")),
            F.struct((F.col("shard") * 2 + 1).alias("shard"), F.zip_with("q", "l", lambda a, b: a - b).alias("q")))).alias("s")).select("s.shard", "s.q", "nths")
        if level % 6 == 5:
            tree = tree.repartition("shard")  # the nodes so far are dealt to all tasks
    return tree.select("shard", F.explode(F.arrays_zip("nths", F.col("q").alias("q"))).alias("z")).select("shard", F.col("z.nths").alias("nth"), F.col("z.q").alias("blocks"))


def sized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(row, id, key, source, size): `size` counts words of the whole text, null text has none."""
    rows = docs.select(F.struct("*").alias("row"))
    t = F.coalesce(F.col(f"row.{text}").cast("string"), F.lit(""))
    return rows.select("row", F.xxhash64(F.col(f"row.{doc_id}"), t).alias("id"),
                       F.coalesce(F.concat(F.lit("="), F.col(f"row.{source}").cast("string")), F.lit("null")).alias("key"),
                       F.col(f"row.{source}").cast("string").alias("source"), F.regexp_count(t, F.lit(WORD)).cast("long").alias("size"))


def _block(seed: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), F.col("id")), F.col("n_blocks"))


def plan_mix(sizes: DataFrame, weights: Sequence[float], share: float, cap: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """The sources and the drawn blocks, from (id, key, source, size) rows that were written before.

    Sources: key, source_size, target, n_blocks.  Draws: key, block, take (words), whole (all of the block), lap, shard.
    """
    sources = staged(source_targets(sizes, weights, share, cap).withColumn("n_blocks", F.greatest(F.lit(1), F.ceil(F.col("source_size") / BLOCK_WORDS)).cast("long")), "sources")
    blocks = sizes.join(sources.select("key", "n_blocks"), "key").groupBy("key", _block(seed).alias("block"), "n_blocks").agg(F.sum("size").alias("words")).where("words > 0")
    laps = blocks.withColumn("lap", F.explode(F.lit(list(range(math.ceil(cap))))))
    laps = laps.withColumn("at", _unit(F.lit(seed), F.lit("order"), F.col("lap"), F.col("key"), F.col("block")))
    # running sums inside stretches of the random order, then over the stretches: no source passes through one task
    laps = staged(laps.withColumn("stretch", F.floor(F.col("at") * F.ceil(F.col("n_blocks") / 256))), "blocks")
    own = W.partitionBy("key", "lap", "stretch").orderBy("at", "block").rowsBetween(W.unboundedPreceding, 0)
    before = W.partitionBy("key").orderBy("lap", "stretch").rowsBetween(W.unboundedPreceding, -1)
    stretches = laps.groupBy("key", "lap", "stretch").agg(F.sum("words").alias("w"), F.count("*").alias("c")).select(
        "key", "lap", "stretch", F.coalesce(F.sum("w").over(before), F.lit(0)).alias("w0"), F.coalesce(F.sum("c").over(before), F.lit(0)).alias("c0"))
    inside = laps.withColumn("w1", F.sum("words").over(own)).withColumn("c1", F.row_number().over(W.partitionBy("key", "lap", "stretch").orderBy("at", "block")))
    quota = F.round("target").cast("long")
    draws = inside.join(stretches, ["key", "lap", "stretch"]).join(sources.select("key", "nth", quota.alias("quota")), "key").select(
        "key", "nth", "block", "lap", "words", (F.col("c0") + F.col("c1") - 1).alias("p"),
        F.least(F.col("words"), F.col("quota") - (F.col("w0") + F.col("w1") - F.col("words"))).alias("take")).where("take > 0")
    draws = staged(draws, "draws")
    quotas = draws.groupBy("nth").agg(F.count("*").alias("draws"))
    total = draws.count()
    depth = max(0, math.ceil(math.log2(max(1, total / SHARD_BLOCKS))))
    shares = _splitting_tree(quotas, depth, seed)
    upto = W.partitionBy("nth").orderBy("shard").rowsBetween(W.unboundedPreceding, 0)
    places = shares.withColumn("end", F.sum("blocks").over(upto)).where("blocks > 0").select(
        "nth", "shard", F.explode(F.sequence(F.col("end") - F.col("blocks"), F.col("end") - 1)).alias("p"))
    return sources, draws.join(places, ["nth", "p"]).select("key", "block", "take", (F.col("take") == F.col("words")).alias("whole"), "lap", "shard")


def mix_words(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, seed: int = 7) -> DataFrame:
    """doc_id, size, source_size, target, taken, shards for each document.

    `taken` is how many words the mix takes, repeats counted: the sum over a source is its target, rounded.  `shards` lists
    where the drawn blocks of the document go.  Documents without words are never taken; a null source is a source of its own,
    after all others.  Equal rows share their block and so their fate.  Reruns agree.
    """
    sizes = staged(sized(docs).select(F.col("row.doc_id").alias("doc_id"), "id", "key", "source", "size"), "sizes")
    sources, draws = plan_mix(sizes, weights, share, cap, seed)
    drawn = draws.groupBy("key", "block").agg(F.collect_list("take").alias("takes"), F.sort_array(F.collect_list("shard")).alias("shards"))
    # a block holds about BLOCK_WORDS words: a window over one is small
    at = W.partitionBy("key", "block").orderBy("id").rowsBetween(W.unboundedPreceding, 0)
    placed = sizes.join(sources.select("key", "source_size", "target", "n_blocks"), "key").withColumn("block", _block(seed)).withColumn("end", F.sum("size").over(at))
    taken = F.aggregate("takes", F.lit(0).cast("long"), lambda s, t: s + F.greatest(F.lit(0), F.least(F.col("size"), t - F.col("end") + F.col("size"))))
    return placed.join(drawn, ["key", "block"], "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce(taken, F.lit(0)).cast("long").alias("taken"), F.coalesce("shards", F.array().cast("array<bigint>")).alias("shards"))


def mix_documents(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, seed: int = 7) -> DataFrame:
    """The mixed documents themselves, whole, with their own columns: a document drawn twice comes twice.

    Where a quota ends inside a document, it comes if at least half its words are due.  Documents of a shard lie together in
    random order.
    """
    rows = sized(docs)
    sizes = staged(rows.select("id", "key", "source", "size"), "sizes")
    sources, draws = plan_mix(sizes, weights, share, cap, seed)
    # the cut blocks are one a source; only they need places inside the block
    cut = draws.where("not whole").select("key", "block", "lap", "take")
    at = W.partitionBy("key", "block").orderBy("id").rowsBetween(W.unboundedPreceding, 0)
    placed = sizes.join(sources.select("key", "n_blocks"), "key").withColumn("block", _block(seed))
    late = placed.join(cut, ["key", "block"]).withColumn("end", F.sum("size").over(W.partitionBy("key", "block", "lap").orderBy("id").rowsBetween(W.unboundedPreceding, 0)))
    limit = late.where(2 * (F.col("take") - F.col("end") + F.col("size")) >= F.col("size")).groupBy("key", "block", "lap").agg(F.max("id").alias("last"))
    chosen = draws.join(limit, ["key", "block", "lap"], "left").where("whole or last is not null")
    out = rows.where("size > 0").join(sources.select("key", "n_blocks"), "key").withColumn("block", _block(seed)).join(
        chosen.select("key", "block", "lap", "shard", F.when(~F.col("whole"), F.col("last")).alias("last")), ["key", "block"]).where("last is null or id <= last")
    out = out.select("row", "shard", _unit(F.lit(seed), F.lit("inside"), F.col("lap"), F.col("id")).alias("at"))
    return out.repartition("shard").sortWithinPartitions("shard", "at").select("row.*")
