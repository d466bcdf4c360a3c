"""Quality rules under weak supervision, in DataFrame functions only.

Each rule votes good (1), bad (-1) or abstains (0).  Documents come in classes: one that the majority of votes speaks for, and one
kind of bad text for each rule, since kinds of bad text exclude each other and a rule sees mostly its own.  Expectation-maximisation
over the counts of vote patterns estimates the share of each class and how often each rule votes each way in it; no labels are
read.  A kind counts as bad text only if other rules confirm it; else the rule that raised it was wrong there, however often.  A
document's verdict is its posterior probability, not a demand that every rule pass.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from brindle.llm.common import BLANKS, staged, text_of

#: Frequent function words of English, French, German and Spanish.  Fixed values.
FUNCTION_WORDS = ["the", "of", "and", "to", "in", "is", "that", "for", "with", "on", "de", "la", "le", "et", "les", "des", "en", "un", "une", "que", "pour",
                  "der", "die", "und", "das", "den", "von", "mit", "zu", "ist", "el", "los", "las", "y", "por", "con", "para", "se"]

CONFIRMED = 0.5  # bad votes of other rules, on average, that make a kind of text a bad one
SHARE_PRIOR, VOTE_PRIOR = 0.01, 1.0  # documents added to each class; votes added to each rule in each class, in the rule's overall proportions
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def repeated_words(hashes: Column, size: int = 5) -> Column:
    """Words inside windows that occur twice or more, from the array of the windows' hashes.

    Sorted with their places, equal windows stand side by side; the places found, sorted again, each cover the words up to the
    next place, `size` at most.  Sorting keeps this n log n for texts of any length.
    """
    def of(f):
        return lambda x: f(x)

    by_hash = F.sort_array(F.transform(hashes, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    # transform over a one-element array names an intermediate result
    twins = F.transform(F.array(by_hash), of(lambda s: F.zip_with(
        s, F.slice(s, 2, F.greatest(F.size(s) - 1, F.lit(0))), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))))
    places = F.sort_array(F.array_distinct(F.flatten(F.filter(F.get(twins, F.lit(0)), lambda x: x.isNotNull()))))
    steps = F.transform(F.array(places), of(lambda p: F.zip_with(p, F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))), lambda a, b: F.least(F.lit(size), F.coalesce(b - a, F.lit(size))))))
    return F.aggregate(F.get(steps, F.lit(0)), F.lit(0), lambda s, x: s + x).cast("long")


def _tail(a: str, start: int) -> Column:
    return F.slice(a, start, F.greatest(F.size(a) - (start - 1), F.lit(0)))


def _head(a: str, cut: int) -> Column:
    return F.slice(a, 1, F.greatest(F.size(a) - cut, F.lit(0)))


def text_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row, STATS and what the rules read); `row` is the document as it came.  Null text counts as empty: all zero."""
    t = docs.select(F.struct("*").alias("row"), text_of(text).alias("t"))
    bare = F.btrim("t", F.lit(BLANKS))
    w = t.select("row", "t", F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+")).alias("w"),
                 F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "").alias("lines"))
    h = w.select("row", "t", "w", "lines", F.size("w").cast("long").alias("n_words"), F.transform("w", lambda x: F.xxhash64(x)).alias("h1"))
    pair = lambda a, b: F.xxhash64(a, b)
    h = h.withColumn("h2", F.zip_with(_head("h1", 1), _tail("h1", 2), pair))
    h = h.withColumn("h4", F.zip_with(_head("h2", 2), _tail("h2", 3), pair))
    h = h.withColumn("h5", F.zip_with(_head("h4", 1), _tail("h1", 5), pair))
    long_enough = F.col("n_words") >= 5
    return h.select(
        "row", "n_words",
        F.length(F.regexp_replace("t", r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(long_enough & (F.size(F.array_distinct("h5")) < F.size("h5")), repeated_words(F.col("h5"))).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.length(F.regexp_replace("t", "[^A-Z]+", "")).cast("long").alias("n_upper"),
        F.length(F.regexp_replace("t", "[^0-9]+", "")).cast("long").alias("n_digits"),
        F.regexp_count("t", F.lit("[!?]{2}")).cast("long").alias("n_shouts"),
        F.regexp_count("t", F.lit(r"[.!?](?=[\x20\x09-\x0D]|$)")).cast("long").alias("n_ends"),
        F.regexp_count("t", F.lit(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D\p{L}]++(?![^\x20\x09-\x0D])")).cast("long").alias("n_letterless"),
        F.regexp_count("t", F.lit(r"[.,;:!?#*$%&|<>]{2,}+")).cast("long").alias("n_mark_runs"),
        F.size(F.array_distinct("h1")).cast("long").alias("n_distinct"),
        F.size(F.filter(F.zip_with(_head("h1", 1), _tail("h1", 2), lambda a, b: a == b), lambda x: x)).cast("long").alias("n_stutters"),
        F.size(F.array_intersect("w", F.array(*[F.lit(x) for x in FUNCTION_WORDS]))).cast("long").alias("n_function"),
    )


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, F.lit(-1)).when(good, F.lit(1)).otherwise(F.lit(0))


def rules() -> dict[str, Column]:
    """The rules by name, over the columns of text_stats."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    share = lambda c: F.col(c) / n
    chars = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    body = F.col("n_words") >= 20
    return {
        "length": _vote(F.col("n_words") >= 50, F.col("n_words") < 20),
        "word_length": _vote(body & F.col("word_chars").between(3 * n, 12 * n), body & ~F.col("word_chars").between(2 * n, 20 * n)),
        "symbols": _vote(body & (share("n_symbols") < 0.02), share("n_symbols") > 0.1),
        "letters": _vote(body & (share("n_letterless") < 0.05), share("n_letterless") > 0.15),
        "mark_runs": _vote(body & (share("n_mark_runs") < 0.02), share("n_mark_runs") > 0.1),
        "repeated_lines": _vote((F.col("n_lines") >= 3) & (F.col("n_dup_lines") == 0), F.col("n_dup_lines") > 0.1 * F.col("n_lines")),
        "repeated_words": _vote(body & (share("n_repeat_words") < 0.02), share("n_repeat_words") > 0.2),
        "stutter": _vote(body & (share("n_stutters") < 0.02), share("n_stutters") > 0.1),
        "capitals": _vote(body & (F.col("n_upper") < 0.1 * chars), F.col("n_upper") > 0.4 * chars),
        "shouting": _vote(body & (share("n_shouts") < 0.01), share("n_shouts") > 0.1),
        "sentences": _vote(body & (F.col("n_ends") * 40 >= n), body & (F.col("n_ends") * 50 < n)),
        "digits": _vote(body & (F.col("n_digits") < 0.1 * chars), F.col("n_digits") > 0.3 * chars),
        "function_words": _vote(F.col("n_function") >= 3, body & (F.col("n_function") == 0)),
        "variety": _vote(body & (share("n_distinct") > 0.3), body & (share("n_distinct") < 0.2)),
    }


@dataclass(frozen=True)
class RuleModel:
    """The classes: their shares of the documents and for each rule the rates of votes -1, 0 and 1.  Class 0 is the majority's;
    class i + 1 is the kind of text that rule i raised."""

    share: list[float]
    rates: list[list[list[float]]]

    def confirmed(self) -> list[float]:
        """Bad votes a document of each class collects on average, those of the rule that raised the class left out."""
        return [sum(r[0] for i, r in enumerate(rates) if i != k - 1) for k, rates in enumerate(self.rates)]

    def sound(self) -> list[bool]:
        """Is the class good text?"""
        return [k == 0 or c < CONFIRMED for k, c in enumerate(self.confirmed())]

    def accuracy(self, names: list[str] | None = None) -> dict[str, tuple[float, float]]:
        """Of each rule: how often its votes agree with the classes, and on what share of the documents it votes."""
        found = {}
        for i, name in enumerate(names or rules()):
            right = sum(s * r[i][2 if good else 0] for s, r, good in zip(self.share, self.rates, self.sound()))
            cast = sum(s * (r[i][0] + r[i][2]) for s, r in zip(self.share, self.rates))
            found[name] = (right / cast if cast else 0.0, cast)
        return found

    def classes(self) -> Column:
        """Probabilities of the classes, from `votes`.

        The weights come as one constant: they are not part of the generated code, so it is compiled once for all rounds.
        """
        logged = [{"s": math.log(s), "r": [[math.log(x) for x in r] for r in rates]} for s, rates in zip(self.share, self.rates)]
        weights = F.from_json(F.lit(json.dumps(logged)), "array<struct<s:double,r:array<array<double>>>>")
        logs = F.transform(weights, lambda c: F.aggregate(F.zip_with("votes", c["r"], lambda v, r: F.get(r, v + 1)), c["s"], lambda a, x: a + x))
        odds = _let(logs, lambda a: _let(F.array_max(a), lambda top: F.transform(a, lambda x: F.exp(x - top))))
        return _let(odds, lambda a: _let(F.aggregate(a, F.lit(0.0), lambda s, x: s + x), lambda t: F.transform(a, lambda x: x / t)))

    def posterior(self) -> Column:
        """Probability that a document with these votes is good."""
        return F.aggregate(F.zip_with(self.classes(), F.lit([float(g) for g in self.sound()]), lambda q, g: q * g), F.lit(0.0), lambda s, x: s + x)


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def majority() -> Column:
    """Where the estimates start: the share of good votes for class 0, the rest dealt to the kinds of the rules that voted bad."""
    bad, good = (F.size(F.filter("votes", lambda v: v == x)) for x in (-1, 1))
    return _let(bad / (good + bad + 1), lambda rest: F.concat(F.array(1 - rest), F.transform("votes", lambda v: F.when(v == -1, rest / bad).otherwise(0.0))))


def votes(stats: DataFrame) -> DataFrame:
    """Adds the array of votes, in the order of rules()."""
    return stats.select("*", F.array(*[v.cast("int") for v in rules().values()]).alias("votes"))


def fit_rules(voted: DataFrame, rounds: int = 60, tolerance: float = 1e-6, width: int | None = None) -> RuleModel:
    """Expectation-maximisation from the majority vote on, until the expected share of good documents stands still.

    Documents that the base conditions reject anyway do not take part.  The prior is the same for all classes: no estimate has a
    bound.  A table without rows gives the prior.  `width` is the number of rules.

    The rows are first counted by vote pattern: at most 3 to the number of rules, however many documents there are.  Each
    round is one aggregation over that table; (classes x rules x 3) sums reach the driver.  Rounding keeps reruns equal.
    """
    width = width or len(rules())
    counted = staged(voted.groupBy("votes", base_failed().alias("failed")).agg(F.count("*").alias("n")), "patterns")
    patterns = counted.where("not failed").drop("failed")
    pooled = [[1.0] * 3 for _ in range(width)]
    for r in patterns.select("n", F.posexplode("votes").alias("rule", "vote")).groupBy("rule", "vote").agg(F.sum("n").alias("n")).collect():
        pooled[r["rule"]][r["vote"] + 1] += r["n"]
    pooled = [[x / sum(p) for x in p] for p in pooled]
    model, good, start = None, None, majority()
    for _ in range(rounds):
        q = patterns.select("n", "votes", F.posexplode(model.classes() if model else start).alias("class", "q"))
        q = q.select("n", "class", F.round("q", 9).cast("decimal(12,9)").alias("q"), F.posexplode("votes").alias("rule", "vote"))
        sums = [[[0.0] * 3 for _ in range(width)] for _ in range(width + 1)]
        for r in q.groupBy("class", "rule", "vote").agg(F.sum(F.col("q") * F.col("n")).alias("n")).collect():
            sums[r["class"]][r["rule"]][r["vote"] + 1] = float(r["n"])
        mass = [sum(s[0]) + SHARE_PRIOR for s in sums]
        model = RuleModel([m / sum(mass) for m in mass], [[[(x + VOTE_PRIOR * p) / (sum(v) + VOTE_PRIOR) for x, p in zip(v, ps)] for v, ps in zip(s, pooled)] for s in sums])
        before, good = good, sum(s for s, sound in zip(model.share, model.sound()) if sound)
        if before is not None and abs(good - before) < tolerance:
            break
    return model


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def judge(voted: DataFrame, model: RuleModel, threshold: float = 0.5) -> DataFrame:
    """Adds base_failed, p_good and kept: false if base_failed, else p_good >= threshold."""
    return voted.withColumn("base_failed", base_failed()).withColumn("p_good", F.round(model.posterior(), 9)).withColumn(
        "kept", ~F.col("base_failed") & (F.col("p_good") >= threshold))


def keep_good(docs: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The documents judged good, with their own columns only.  Two passes over the texts, no shuffle of them.

    The verdict passes through a one-element array: a plain filter would be pushed below the projections, and all statistics
    would be worked out anew at each place that names them.
    """
    voted = votes(text_stats(docs, text))
    judged = judge(voted, fit_rules(voted), threshold).select(F.explode(F.array(F.struct("row", "kept"))).alias("j"))
    return judged.where("j.kept").select("j.row.*")
