"""Conversation state.

A thread may hold any number of messages, so it is never gathered into one array or one window: messages
are cut into stretches of `width` turns, each stretch is ordered on its own, and what came before a
stretch is a running sum over the stretches' totals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from brindle.functions.ordered import named


def _position(turn: str) -> Column:
    """A message without a turn stands before all others."""
    return F.coalesce(F.col(turn), F.lit(-1))


def running_by_stretch(df: DataFrame, thread: str, order: Column, measures: dict[str, Column], width: int = 4096) -> DataFrame:
    """Adds inclusive running totals of `measures` per thread, in ascending `order` (an integer, not null).

    Messages without a thread form one thread.
    """
    rows = df.select("*", named(thread).alias("_thread"), order.alias("_o"), F.floor(order / width).alias("_stretch"), *[m.alias(f"_m_{n}") for n, m in measures.items()])
    sums = rows.groupBy("_thread", "_stretch").agg(*[F.sum(f"_m_{n}").alias(f"_t_{n}") for n in measures])
    before = Window.partitionBy("_thread").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_thread", "_stretch", *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_b_{n}") for n in measures])
    inside = Window.partitionBy("_thread", "_stretch").orderBy("_o").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.select(*df.columns, "_thread", "_stretch", *[F.sum(f"_m_{n}").over(inside).alias(f"_l_{n}") for n in measures])
    joined = local.join(offsets, ["_thread", "_stretch"])
    return joined.select(*df.columns, *[(F.col(f"_l_{n}") + F.col(f"_b_{n}")).alias(n) for n in measures])


def thread_history(df: DataFrame, thread: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Messages with their position (from 1) in their own thread."""
    return running_by_stretch(df, thread, _position(turn), {"position": F.lit(1).cast("bigint")})


def thread_checkpoints(df: DataFrame, thread: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """State after every message: how many messages and characters the thread holds by then."""
    out = running_by_stretch(df, thread, _position(turn), {"messages": F.lit(1).cast("bigint"), "chars": F.coalesce(F.length(text), F.lit(0)).cast("bigint")})
    return out.select(thread, turn, "messages", "chars")


def reduce_state(df: DataFrame, thread: str = "conv_id", turn: str = "turn") -> DataFrame:
    """A field that keeps the newest value only, beside fields that accumulate."""
    return df.groupBy(thread).agg(
        F.max_by("role", turn).alias("last_role"), F.max_by("text", turn).alias("last_text"),
        F.count("*").alias("n_messages"), F.sum(F.length("text")).alias("n_chars"))


def context_budget(df: DataFrame, budget: int, thread: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """The newest messages of each thread whose characters together fit the budget."""
    out = running_by_stretch(df, thread, -_position(turn), {"chars_from_end": F.coalesce(F.length(text), F.lit(0)).cast("bigint")})
    return out.where(F.col("chars_from_end") <= budget)
