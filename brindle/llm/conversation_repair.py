"""Conversation structure repair: the cheapest edits that give every conversation a legal order of roles, by auction.

A conversation is a lattice: a place between two rows and a state of the pattern (s?(ua)+)? make a node, edits are arcs of integer
cost.  The auction runs from the last row back.  Each node of a place bids from its own: while its price is below the best of its arcs
(cost and price behind it) the price rises to that and the path contracts; else the path extends along that arc, until it reaches a
node behind the row, whose price stands.  Prices start at the lowest price behind the row, which no arc undercuts, so a node rises
by a few units only.  When all four have bid, the prices are distances to the end, the tight arcs are those of cheapest repairs, and
taking the first letter among them at every node spells the least audit.  Prices behind a row matter only up to a constant, and few
such profiles exist, so a row's auction is held once per kind of row and profile and remembered.

Rows travel twice: as codes of a few bytes to be judged, then as texts behind their conversation's audit to be hashed.  Both pass as
sorted streams; a conversation of any length costs two bytes a row in a task, besides its audit.  The audit and the digest are values
of one row, so the rows of one conversation pass through one task.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from brindle.llm.common import BLANKS

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
FINE, CUT, BLANK, DUPLICATE = range(4)  # a row's first fault; a code is 4 * role + fault
OTHER, SYSTEM, USER, ASSISTANT = range(4)  # a row's role by its initial; a state is the role that was last, OTHER before any
END = -1
_TO = {SYSTEM: {OTHER: SYSTEM}, USER: {OTHER: USER, SYSTEM: USER, ASSISTANT: USER}, ASSISTANT: {USER: ASSISTANT}}  # role -> state -> state
_NEXT = {OTHER: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # the role that an inserted or renamed row takes
Profile = tuple[int, int, int, int]


def _arcs(code: int, state: int) -> list[tuple[str, int, int, bool]]:
    """(letter, cost, state after it, stays before the row), by letter."""
    found = [("I", INSERT, _NEXT[state], True)]
    if code == END:
        return found + ([("", 0, state, False)] if state in (OTHER, ASSISTANT) else [])
    role, fault = divmod(code, 4)
    found.append(("D", DELETE, state, False))
    if fault < BLANK:
        more = TRUNCATED if fault == CUT else 0
        found.append(("R", REROLE + more, _NEXT[state], False))
        if state in _TO.get(role, {}):
            found.append(("K", KEEP + more, _TO[role][state], False))
    return sorted(found)


@lru_cache(maxsize=None)  # at most 17 codes times the few profiles there are
def settle(code: int, behind: Profile) -> tuple[Profile, int]:
    """Prices before a row from those behind it, less their least, and that least."""
    arcs = [_arcs(code, q) for q in range(4)]
    price = [min(behind)] * 4
    for origin in range(4):
        path = [origin]
        while True:
            at = path[-1]
            bid, stays, to = min((cost + (price[q] if stays else behind[q]), stays, q) for _, cost, q, stays in arcs[at])
            if price[at] < bid:
                price[at] = bid
                if len(path) > 1:
                    path.pop()
            elif stays:
                path.append(to)
            else:
                break
    low = min(price)
    return tuple(p - low for p in price), low


@lru_cache(maxsize=None)
def _spell(code: int, before: Profile, rise: int, behind: Profile, state: int) -> tuple[str, int]:
    """Letters of the tight arcs across a row, the least first, and the state behind it."""
    letters = ""
    while True:
        here = before[state] + rise
        letter, _, to, stays = next(a for a in _arcs(code, state) if here == a[1] + (before[a[2]] + rise if a[3] else behind[a[2]]))
        letters, state = letters + letter, to
        if not stays:
            return letters, state


def cheapest_audit(codes: bytes) -> tuple[int, str]:
    """Least cost and its least audit for the codes of a conversation's rows."""
    number: dict[Profile, int] = {(0, 0, 0, 0): 0}
    known = [(0, 0, 0, 0)]
    kept, total, at = array("H", [0]), 0, (0, 0, 0, 0)
    for code in [END, *reversed(codes)]:
        at, rise = settle(code, at)
        total += rise
        if at not in number:
            number[at] = len(known)
            known.append(at)
        kept.append(number[at])
    cost, state, spelt = total + at[OTHER], OTHER, []
    for i, code in enumerate([*codes, END]):
        before, behind = known[kept[-1 - i]], known[kept[-2 - i]]
        letters, state = _spell(code, before, settle(code, behind)[1], behind, state)
        spelt.append(letters)
    return cost, "".join(spelt)


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with planted damage by crc32 of "conv_id:turn" modulo 20; nulls count as one space.

    0 drops the row, 1 empties its text, 2 takes its .!? away, 3 repeats it, 4 makes it the user's.
    """
    def one(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(one("conv_id"), F.lit(":"), one("turn"))) % 20
    text = F.when(F.col("_k") == 1, "").when(F.col("_k") == 2, F.translate("_text", ".!?", "")).otherwise(F.col("_text"))
    rows = conversations.select("conv_id", "turn", one("role").alias("_role"), one("text").alias("_text"), kind.alias("_k")).where("_k <> 0")
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("_k") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", F.when(F.col("_k") == 4, "user").otherwise(F.col("_role")).alias("role"), text.alias("text"), copies.alias("_")).drop("_")


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_SOLVED = "conv_id bigint, " + ", ".join(f"{c} bigint" for c in _COUNTS) + ", audit string"
_LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Codes of whole conversations, in order, to their counts and audits.  A row of code null only says that the conversation exists."""
    schema = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in _COUNTS], ("audit", pa.string())])
    out: list[tuple] = []
    size = 0
    current, open_, codes, low, high, distinct = None, False, bytearray(), None, None, 0

    def close() -> tuple:
        faults = [c & 3 for c in codes]
        roles = [c >> 2 for c in codes]
        gaps = min(high - low + 1 - distinct, 2**63 - 1) if distinct else 0
        cost, audit = cheapest_audit(bytes(codes))
        illegal = sum(p not in _LEGAL for p in zip(roles, roles[1:]))
        return (current, gaps, faults.count(BLANK), faults.count(DUPLICATE), faults.count(CUT), illegal, cost, audit)

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), schema)], schema=schema)

    for part in batches:
        for conv, turn, code in zip(*(part.column(c).to_pylist() for c in ("conv_id", "turn", "code"))):
            if not open_ or conv != current:
                if open_:
                    out.append(close())
                    size += len(codes) + 64
                    if size > 1 << 20:
                        yield batch()
                        out, size = [], 0
                current, open_, codes, low, high, distinct = conv, True, bytearray(), None, None, 0
            if code is None:
                continue
            codes.append(code)
            if turn is not None and (high is None or turn != high):
                low, high, distinct = turn if low is None else low, turn, distinct + 1
    if open_:
        out.append(close())
        yield batch()


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each conversation's audit, then its rows in order, to its counts and the digest of the repaired text."""
    names = ["conv_id", *_COUNTS, "audit", "repaired_sha256"]
    schema = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in _COUNTS], ("audit", pa.string()), ("repaired_sha256", pa.string())])
    head, done, size = None, [], 0

    class Feed:
        def __init__(self, audit: str) -> None:
            self.audit, self.at, self.state, self.digest, self.first = audit, 0, OTHER, hashlib.sha256(), True

        def line(self, role: str, text: str) -> None:
            self.digest.update((("" if self.first else "\n") + role + ":" + text).encode())
            self.first = False

        def inserts(self) -> None:
            while self.at < len(self.audit) and self.audit[self.at] == "I":
                self.at += 1
                self.state = _NEXT[self.state]
                self.line(_NAMES[self.state], "")

        def row(self, role: str, text: str) -> None:
            self.inserts()
            letter = self.audit[self.at]
            self.at += 1
            if letter == "D":
                return
            self.state = _NEXT[self.state] if letter == "R" else _TO[_INITIAL[role[0]]][self.state]
            self.line(_NAMES[self.state] if letter == "R" else role, text)

        def close(self) -> str:
            self.inserts()
            return self.digest.hexdigest()

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in done], schema.field(n).type) for n in names], schema=schema)

    feed = None
    for part in batches:
        for start in range(0, part.num_rows, 256):  # texts of 256 rows as Python strings at a time
            for r in part.slice(start, 256).to_pylist():
                if r["kind"] == 0:
                    if feed:
                        done.append(head | {"repaired_sha256": feed.close()})
                        size += len(head["audit"]) + 128
                        if size > 1 << 20:
                            yield batch()
                            done, size = [], 0
                    head, feed = {n: r[n] for n in names[:-2]} | {"audit": r["text"]}, Feed(r["text"])
                else:
                    feed.row(r["role"], r["text"])
    if feed:
        done.append(head | {"repaired_sha256": feed.close()})
        yield batch()


_NAMES = {USER: "user", ASSISTANT: "assistant"}
_INITIAL = {"s": SYSTEM, "u": USER, "a": ASSISTANT}


def _code(role: Column, text: Column) -> Column:
    initial = F.substring(role, 1, 1)
    kind = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(OTHER)
    bare = F.rtrim(text, F.lit(BLANKS))
    fault = F.when(bare == "", BLANK).when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), CUT).otherwise(FINE)
    return (4 * kind + fault).cast("int")


def repair(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256): the cheapest repair of each conversation.

    Rows are taken by turn, nulls first; rows of one turn by a hash of role and text, so copies are adjacent.  A null role or text
    counts as one space, rows without a conv_id form one conversation.  `conversations` names ids that must appear even where no row
    is left: zeros, an empty audit and the digest of the empty string.  A role without a first character starts nothing and cannot
    stay.  Duplicates are compared by 96 bits of hash.  Other columns are ignored; an empty table gives none.  Texts of any length
    pass one after the other.
    """
    told = rows.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
                       *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])
    told = told.withColumns({"h": F.xxhash64("role", "text"), "g": F.hash("role", "text")})
    again = F.row_number().over(Window.partitionBy("conv_id", "h", "g").orderBy(F.asc_nulls_first("turn"))) > 1
    code = _code(F.col("role"), F.col("text")).alias("code")  # worked out before the exchange: texts stay where they are
    codes = told.select("conv_id", "turn", "h", "g", code)
    if conversations is not None:
        here = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
        codes = codes.unionByName(here, allowMissingColumns=True)
    fault = F.col("code") % 4
    codes = codes.repartition("conv_id").withColumn("again", again).withColumn("code", F.when(F.col("again") & (fault != BLANK), F.col("code") - fault + DUPLICATE).otherwise(F.col("code")))
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "h", "g"]
    solved = codes.sortWithinPartitions(*order).select("conv_id", "turn", "code").mapInArrow(_judge, _SOLVED)
    lines = told.select("conv_id", F.lit(1).alias("kind"), "turn", "h", "g", "role", "text")
    heads = solved.select("conv_id", F.lit(0).alias("kind"), *_COUNTS, F.col("audit").alias("text"))
    both = lines.unionByName(heads, allowMissingColumns=True).repartition("conv_id")
    both = both.sortWithinPartitions(F.asc_nulls_first("conv_id"), "kind", F.asc_nulls_first("turn"), "h", "g")
    return both.select("conv_id", "kind", "role", "text", *_COUNTS).mapInArrow(_digest, f"{_SOLVED}, repaired_sha256 string")
