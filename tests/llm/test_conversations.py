import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import types as T

from brindle.llm import prefix_trie as trie
from brindle.llm.conversation_repair import cheapest_audit, damaged, repair

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
                       *[T.StructField(c, T.StringType()) for c in ("h", "g", "kind", "code", "audit", "base", "depth", "node", "digest", "n", "leaf", "w", "_k", "_text")]])


def told(seed: int = 3, n: int = 260) -> list[tuple]:
    rng = random.Random(seed)
    lines = ["Hello there.", "Why?", "yes", "It is so.", "", " \t", "é 😀!", "no end", "A\nB."]
    rows = []
    for c in [*range(40), 100, 101, 150, 199, 300, 305, -3, -100, -107]:
        for t in range(rng.choice([1, 2, 3, 4, 6, 9])):
            rows.append((c, t * rng.choice([1, 1, 2]), rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None]), rng.choice(lines + [None])))
    first = [(0, i, ("user", "assistant")[i % 2], f"shared {i}.") for i in range(7)]
    rows = [r for r in rows if r[0] != 0] + first
    rows += [(c, i, r, t) for c in (7, 8, 9, 55) for _, i, r, t in first[:5]]
    rows += [(12, None, "user", "no turn"), (12, None, None, None), (None, 1, "user", "no id."), (None, None, "assistant", "x."), (5, 3, "user", "long " * 60_000 + ".")]
    rows += [rows[-1], (6, 2**62, "user", "far."), (6, -(2**62), "user", "near.")]
    rows += [(777, i, ("user", "assistant")[i % 2], f"turn {i}.") for i in range(3_000)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, *["clash"] * 14) for r in rows], SCHEMA)


# ---- repair ----------------------------------------------------------------------------------------------------------------

_STEP = {(0, 1): 1, (0, 2): 2, (1, 2): 2, (3, 2): 2, (2, 3): 3}


def least(codes):
    """Forward over all states with (cost, letters)."""
    def inserted(best):
        for _ in range(4):
            for q, (c, a) in list(best.items()):
                to = 3 if q == 2 else 2
                best[to] = min(best.get(to, (10**9, "")), (c + 3, a + "I"))
        return best

    best = inserted({0: (0, "")})
    for code in codes:
        role, fault = divmod(code, 4)
        after: dict = {}

        def put(q, c, a):
            after[q] = min(after.get(q, (10**9, "")), (c, a))

        for q, (c, a) in best.items():
            put(q, c + 4, a + "D")
            if fault < 2:
                more = 3 if fault == 1 else 0
                if (q, role) in _STEP:
                    put(role, c + more, a + "K")
                put(3 if q == 2 else 2, c + 3 + more, a + "R")
        best = inserted(after)
    return min(best[q] for q in (0, 3) if q in best)


def test_auction_finds_the_least_audit():
    rng = random.Random(5)
    for _ in range(4000):
        codes = bytes(rng.randrange(16) for _ in range(rng.randrange(11)))
        assert cheapest_audit(codes) == least(codes), list(codes)
    long = bytes(rng.randrange(16) for _ in range(5000))
    assert cheapest_audit(long) == least(long)


def _spread(rows):
    """The rows after damage, by conversation."""
    made = defaultdict(list)
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        made[c] += [(t, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return made


def _expected(rows):
    """Fields that do not depend on the order of rows of one turn are exact everywhere; the others where turns differ."""
    made, out = _spread(rows), {}
    for c in {r[0] for r in rows}:
        said = sorted(made.get(c, []), key=lambda r: (r[0] is not None, r[0] or 0))
        turns = [r[0] for r in said if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, codes = set(), []
        for _, role, text in said:
            bare = text.rstrip(" \t\n\x0b\f\r")
            fault = 2 if not bare else 3 if (role, text) in seen else 1 if bare[-1] not in ".!?" else 0
            seen.add((role, text))
            codes.append(4 * {"s": 1, "u": 2, "a": 3}.get(role[:1], 0) + fault)
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(said, said[1:])]
        cost, audit = least(codes)
        state, at, lines = 0, 0, []
        for letter in audit:
            to = 3 if state == 2 else 2
            name = {2: "user", 3: "assistant"}[to]
            if letter == "I":
                state = to
                lines.append(name + ":")
                continue
            _, role, text = said[at]
            at += 1
            if letter == "K":
                state = {"s": 1, "u": 2, "a": 3}[role[0]]
                lines.append(f"{role}:{text}")
            elif letter == "R":
                state = to
                lines.append(f"{name}:{text}")
        faults = [x % 4 for x in codes]
        plain = all(a[0] != b[0] or a == b for a, b in zip(said, said[1:]))
        out[c] = (min(gaps, 2**63 - 1), faults.count(2), faults.count(3), faults.count(1), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
                  hashlib.sha256("\n".join(lines).encode()).hexdigest()), plain
    return out


def test_repair_of_damaged_conversations(spark):
    rows = told()
    got = {r.conv_id: tuple(r)[1:] for r in repair(damaged(frame(spark, rows)), frame(spark, rows)).collect()}
    want = _expected(rows)
    assert got.keys() == want.keys() and sum(plain for _, plain in want.values()) > 30
    for c, (fields, plain) in want.items():
        assert got[c][:3] == fields[:3] and (not plain or got[c] == fields), c
    assert any(not r for r in map(_spread(rows).get, want)) or repair(damaged(frame(spark, rows[:0])), frame(spark, rows[:3])).count() == len({r[0] for r in rows[:3]})


def test_repair_of_nothing(spark):
    assert repair(damaged(frame(spark, []))).count() == 0
    none = repair(frame(spark, []), frame(spark, [(4, 0, "user", "x")])).collect()
    assert [tuple(r) for r in none] == [(4, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


# ---- trie ------------------------------------------------------------------------------------------------------------------


def _trie(rows):
    digest = lambda role, text: hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
    by = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            by[c].append((t, role or "", text or ""))
    for c in by:
        by[c] = [r[1:] for r in sorted(by[c], key=lambda r: (r[0] is not None, r[0] or 0, digest(*r[1:])))]
    full = {}
    for c, turns in by.items():
        base, h = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100)), zlib.crc32(str(c).encode()) % 6
        full[c] = tuple(by.get(base, [])[:h] + turns[h:])
    members, kids = defaultdict(list), defaultdict(set)
    for c, turns in full.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
            if d:
                kids[turns[: d - 1]].add(turns[:d])
    leaves, saved = Counter(), Counter()
    for k in members:
        for d in range(len(k) + 1):
            leaves[k[:d]] += k not in kids
            saved[k[:d]] += (len(members[k]) - 1) * len(k[-1][1]) if k else 0
    ends = {k: hashlib.sha256(",".join(map(str, sorted(c for c in m if len(full[c]) == len(k)))).encode()).hexdigest() for k, m in members.items()}
    return Counter((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(kids[k]) if k in kids else 0, leaves[k], saved[k], ends[k]) for k, m in members.items())


@pytest.mark.parametrize("cut", [None, 777])
def test_trie(spark, cut):
    rows = [r for r in told() if cut is None or r[0] != cut]
    if cut is None:  # a chain of 3,000 turns would make brute force walk nine million prefixes
        rows = [r for r in rows if r[0] != 777 or r[1] < 200]
    assert Counter(map(tuple, trie.prefix_trie(frame(spark, rows)).collect())) == _trie(rows)


def test_trie_of_nothing(spark):
    assert trie.prefix_trie(frame(spark, [])).count() == 0
    assert trie.prefix_trie(frame(spark, [(None, 0, "user", "x")])).count() == 0


def test_fingerprints_compose_in_any_grouping():
    rng = random.Random(2)
    pairs = [trie.one_turn(rng.randbytes(32), trie.MULTIPLIERS[0]) for _ in range(9)]
    left = trie.NOTHING
    for p in pairs:
        left = trie.join(left, p)
    right = trie.NOTHING
    for p in reversed(pairs):
        right = trie.join(p, right)
    assert left == right == trie.join(trie.join(pairs[0], trie.NOTHING), trie.join(trie.join(*pairs[1:3]), __import__("functools").reduce(trie.join, pairs[3:])))


def test_equal_fingerprints_of_different_turns_are_found_out(spark, monkeypatch):
    """A multiplier of 0 forgets all but the last turn; the next one is taken."""
    one, two = [c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 == 0][:2]
    rows = [(c, i, "user", t) for c, turns in ((one, "abbc"), (two, "abdc")) for i, t in enumerate(turns)]
    assert not trie.prefix_nodes(trie.rebuilt_prefixes(frame(spark, rows), 0)).where("NOT sound").isEmpty()
    monkeypatch.setattr(trie, "MULTIPLIERS", (0, trie.MULTIPLIERS[0]))
    assert Counter(map(tuple, trie.prefix_trie(frame(spark, rows)).collect())) == _trie(rows)
    monkeypatch.setattr(trie, "MULTIPLIERS", (0,))
    with pytest.raises(ValueError):
        trie.prefix_trie(frame(spark, rows))
