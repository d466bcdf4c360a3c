"""Personal data by candidate boosting, in DataFrame and pyspark.ml functions only (no Python on the executors).

Exact patterns give the base spans.  Wide generators propose further, overlapping spans; boosted trees judge each by its shape and
its context, and a threshold for each generator, set on all held-out candidates, selects the redactions.  There are no labels.
Evidence takes their place where a candidate has some: a checksum, an address range, a country code, an `@` with a domain, a name
like password before it.  What is evidence is no feature, so the trees must tell by the rest, and they judge candidates without
evidence, too: a number without its country code, a card with a wrong digit, an address written in words.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from brindle.llm.common import staged

#: The base kinds in order, with the text a match needs at least and the pattern.  Quantifiers are possessive, and a run is only
#: entered at its start or after a match: the same matches in linear time, without recursion.  Fixed values.
BASE = {
    "email": ("@", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": ("[0-9]", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": ("[0-9]", r"[0-9](?:[\x20-]?[0-9])++"),
    "phone": ("\\+", r"\+[0-9][\x20().0-9-]+[0-9]"),
}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
#: Generators: wider than what they are meant to find.
WIDE = {
    "mail": ("@|(?i)at", r"(?i)[a-z0-9._%+-]++(?:\x20?\[at\]\x20?|\x20?\(at\)\x20?|@)[a-z0-9-]++(?:(?:\.|\x20?\[dot\]\x20?|\x20?\(dot\)\x20?)[a-z0-9-]++)++"),
    "number": ("[0-9]", r"[+(]?[0-9](?:[\x20().-]{0,2}[0-9])++"),
    "secret": ("[0-9]", r"(?:(?<![A-Za-z0-9_/+-])|\G)[A-Za-z0-9_/+-]{12,}+"),
}
KINDS = [*BASE, "secret"]  # order of kinds at one start
TREES, DEPTH = 20, 5
PRECISION = 0.95  # of accepted held-out candidates, for each generator
CUES = {"card": "card|visa|account|iban", "phone": "call|phone|tel|mobile|fax", "mail": "mail|contact|write", "order": "order|invoice|ref|serial|version"}

FEATURES = ["is_mail", "is_number", "is_secret", "digits", "letters", "capitals", "marks", "joints", "groups", "hex_only", "variety", "quoted", "left_open", "right_open",
            *[f"cue_{c}" for c in CUES]]
CHUNK = 100  # steps of the thresholds


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)


def spans(text: Column, need: str, pattern: str) -> Column:
    """array<struct(start, end, match)> of all matches, left to right; null if there are none.

    What lies between matches and the matches themselves give the places; running sums go by stretches of 64, so a text with very
    many matches stays cheap.
    """
    def places(found: Column) -> Column:
        steps = F.zip_with(F.transform(F.slice(F.split(text, pattern, -1), 1, F.size(found)), lambda g: F.length(g).cast("long")),
                           F.transform(found, lambda m: F.length(m).cast("long")), lambda g, m: g + m)

        def ends(step: Column) -> Column:
            parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(step) - 1) / 64).cast("int")), lambda c: _sum(F.slice(step, c * 64 + 1, F.lit(64))))
            return _let(parts, lambda p: F.transform(step, lambda _, i: _sum(F.slice(p, F.lit(1), F.floor(i / 64).cast("int"))) + _sum(F.slice(step, F.floor(i / 64).cast("int") * 64 + 1, i % 64 + 1))))

        return F.zip_with(_let(steps, ends), found, lambda e, m: F.struct((e - F.length(m)).alias("start"), e.alias("end"), m.alias("match")))

    found = F.when(text.rlike(need), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    return F.when(F.size(found) > 0, _let(found, places))


def luhn(digits: Column) -> Column:
    """Does the number pass the checksum that doubles every second digit from the right?"""
    def value(d: Column) -> Column:
        return _sum(F.transform(F.sequence(F.lit(1), F.length(d)), lambda i: F.expr("0").cast("long") + _let(
            F.substring(d, -i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1), lambda v: F.when(v > 9, v - 9).otherwise(v))))

    return _let(digits, value) % 10 == 0


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]+", "")


def _card(m: Column) -> Column:
    return _let(_digits(m), lambda d: F.when(F.length(d).between(14, 19), luhn(d)).otherwise(F.lit(False)))


def _address(m: Column) -> Column:
    return m.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")


CHECK = {"email": lambda m: F.lit(True), "ip": _address, "card": _card, "phone": lambda m: F.length(_digits(m)).between(10, 15)}
BEFORE, AFTER = 24, 1  # characters of context


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """(k, doc_id, base, wide): for each row the valid base spans and all candidates with their context.  `k` numbers the rows."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"), F.monotonically_increasing_id().alias("k"))
    t = F.col("t")
    none = lambda kind: F.array().cast(kind)

    def valid(i: int, kind: str) -> Column:
        good = F.filter(spans(t, *BASE[kind]), lambda s: CHECK[kind](s["match"]))
        return F.coalesce(F.transform(good, lambda s: F.struct(s["start"].alias("start"), F.lit(i).alias("kind"), s["end"].alias("end"))), none("array<struct<start:bigint,kind:int,end:bigint>>"))

    def wide(g: str) -> Column:
        return F.coalesce(F.transform(spans(t, *WIDE[g]), lambda s: F.struct(
            F.lit(g).alias("generator"), s["start"].alias("start"), s["end"].alias("end"), s["match"].alias("match"),
            F.substring(t, F.greatest(s["start"] - BEFORE, F.lit(0)).cast("int") + 1, F.least(s["start"], F.lit(BEFORE)).cast("int")).alias("before"),
            F.substring(t, (s["end"] + 1).cast("int"), F.lit(AFTER)).alias("after"))), none("array<struct<generator:string,start:bigint,end:bigint,match:string,before:string,after:string>>"))

    return rows.select("k", "doc_id", F.sort_array(F.concat(*[valid(i, kind) for i, kind in enumerate(BASE)])).alias("base"), F.concat(*map(wide, WIDE)).alias("wide"))


def candidates(found: DataFrame) -> DataFrame:
    """One row for each candidate: k, generator, start, end, label, kind and FEATURES.

    The label is 1 where there is evidence, 0 where a candidate of the same generator could have had it and has not, and null
    where the way of writing leaves none: such candidates are only scored.
    """
    c = found.select("k", F.explode("wide").alias("c")).select("k", "c.*").where("generator <> 'secret' or match rlike '[0-9]'").where("generator <> 'number' or length(match) >= 5")
    m, before = F.col("match"), F.col("before")
    count = lambda p: F.length(F.regexp_replace(m, f"[^{p}]+", "")).cast("double")
    joint = r"(?i)\.|[\[(]dot[\])]"
    c = c.select("*", *[(F.col("generator") == g).cast("double").alias(f"is_{g}") for g in WIDE],
                 F.least(count("0-9"), F.lit(40.0)).alias("digits"), F.least(count("A-Za-z"), F.lit(40.0)).alias("letters"),
                 F.least(count("A-Z"), F.lit(20.0)).alias("capitals"), F.least(count(r"\x20()-"), F.lit(8.0)).alias("marks"),
                 F.least(F.regexp_count(m, F.lit(joint)), F.lit(4)).cast("double").alias("joints"), F.least(F.regexp_count(m, F.lit("[0-9]++")), F.lit(8)).cast("double").alias("groups"),
                 m.rlike("^[0-9a-f]+$").cast("double").alias("hex_only"),
                 F.round(F.size(F.array_distinct(F.split(F.substring(m, 1, 64), ""))) / F.least(F.length(m), F.lit(64)), 1).alias("variety"),
                 before.rlike("[\"'=:]$").cast("double").alias("quoted"),
                 (~before.rlike(r"[\p{L}\p{N}]$")).cast("double").alias("left_open"), (~F.col("after").rlike(r"^[\p{L}\p{N}]")).cast("double").alias("right_open"),
                 *[before.rlike(rf"(?i)\b(?:{words})").cast("double").alias(f"cue_{cue}") for cue, words in CUES.items()])
    open_ = (F.col("left_open") == 1) & (F.col("right_open") == 1)
    card, address, digits = _card(m), _address(m), F.col("digits")
    coded = m.startswith("+") & digits.between(10, 15)
    named = before.rlike(r"(?i)(?:passw(?:or)?d|secret|token|api[_-]?key|access[_-]?key)\W{0,4}$") | m.rlike("^(?:AKIA|ASIA|ghp_|sk-|xox)")
    label = F.when(F.col("generator") == "mail", F.when(~m.contains("@"), None).otherwise((F.col("joints") >= 1) & open_)) \
        .when(F.col("generator") == "number", F.when(open_ & (card | address | coded), True).when(open_ & digits.between(10, 15) & (F.col("marks") >= 2) & ~m.startswith("+"), None).otherwise(False)) \
        .otherwise((F.col("letters") >= 4) & (digits >= 2) & named)
    kind = F.when(F.col("generator") == "mail", 0).when(F.col("generator") == "secret", KINDS.index("secret")).when(address | ((F.col("joints") == 3) & (F.col("groups") == 4)), 1).when(digits.between(14, 19), 2).otherwise(3)
    return c.select("k", "generator", "start", "end", label.cast("double").alias("label"), kind.alias("kind"), *FEATURES)


def learn(cands: DataFrame):
    """(model, thresholds by generator), or None if there is nothing to learn from.

    All candidates with a label take part: equal ones are one row with their count as weight.  Texts with a fifth of the hashes
    are held out; over all their candidates one aggregation by (generator, step of the score, label) gives each generator's
    threshold: the lowest step, one half at least, down to which PRECISION holds.  A generator that never reaches it adds nothing;
    one whose candidates all bear out has one half.
    """
    fold = F.pmod(F.xxhash64("k"), F.lit(5)) == 0
    counted = staged(cands.where("label is not null").groupBy(*FEATURES, "generator", "label", fold.alias("held")).agg(F.count("*").alias("n")), "candidates")
    train = counted.where("not held").groupBy(*FEATURES, "label").agg(F.sum("n").cast("double").alias("weight"))
    if {r["label"] for r in train.groupBy("label").count().collect()} != {0.0, 1.0}:
        return None
    train = VectorAssembler(inputCols=FEATURES, outputCol="vector").transform(train).select("vector", "label", "weight")
    model = GBTClassifier(featuresCol="vector", labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, maxBins=64, seed=7).fit(train)
    bins = score(counted.where("held"), model).groupBy("generator", F.floor(F.col("p") * CHUNK).cast("int").alias("bin")).agg(F.sum(F.col("label") * F.col("n")).alias("hit"), F.sum("n").alias("all")).collect()
    thresholds = {}
    for g in WIDE:
        thresholds[g], hit, all_ = 2.0, 0.0, 0.0
        for r in sorted((r for r in bins if r["generator"] == g and r["bin"] * 2 >= CHUNK), key=lambda r: -r["bin"]):
            hit, all_ = hit + r["hit"], all_ + r["all"]
            if hit >= PRECISION * all_:
                thresholds[g] = r["bin"] / CHUNK
        own = [(r["hit"], r["all"]) for r in bins if r["generator"] == g]
        if own and sum(h for h, _ in own) >= PRECISION * sum(a for _, a in own):
            thresholds[g] = 0.5
    return model, thresholds


def score(rows: DataFrame, model) -> DataFrame:
    """Adds p, the model's probability."""
    out = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="vector").transform(rows))
    return out.withColumn("p", vector_to_array("probability")[1]).drop("vector", "rawPrediction", "probability", "prediction")


def private_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 (all of the base spans), spans (base and added), for each document.

    Spans are kind:start:end in code points, end exclusive, by start, then kind.  Accepted candidates that overlap a base span
    add nothing; of overlapping ones the likeliest stays.  Null text counts as empty.  Rows are numbered as they are read, so
    equal rows and rows that share an id stay apart.
    """
    found = staged(scan(docs, text), "spans")
    cands = candidates(found)
    learned = learn(cands)
    listed = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", F.element_at(F.lit(KINDS), s["kind"] + 1), s["start"], s["end"])), ",")
    of = lambda i: lambda s: s["kind"] == i
    head = ["doc_id", *[F.size(F.filter("base", of(i))).cast("long").alias(f"n_{kind}") for i, kind in enumerate(BASE)], F.sha2(listed(F.col("base")), 256).alias("base_sha256")]
    if learned is None:
        return found.select(*head, listed(F.col("base")).alias("spans"))
    model, thresholds = learned
    limit = F.lit(1.0)
    for g, x in thresholds.items():
        limit = F.when(F.col("generator") == g, F.lit(x)).otherwise(limit)
    accepted = score(cands, model).where(F.col("p") >= limit)
    extra = accepted.select("k", "start", "end", "kind", F.round("p", 6).alias("p"), F.lit(False).alias("is_base"))
    base = found.select("k", F.explode("base").alias("s")).select("k", "s.start", "s.end", "s.kind", F.lit(1.0).alias("p"), F.lit(True).alias("is_base"))
    both = base.union(extra)
    ordered = W.partitionBy("k").orderBy("start", "end", "kind", "is_base")
    both = both.withColumn("reach", F.max("end").over(ordered.rowsBetween(W.unboundedPreceding, -1)))
    both = both.withColumn("island", F.sum(F.when(F.col("reach") > F.col("start"), 0).otherwise(1)).over(ordered))
    island = W.partitionBy("k", "island")
    both = both.withColumn("fixed", F.max("is_base").over(island)).withColumn("nth", F.row_number().over(island.orderBy(F.desc("p"), F.desc(F.col("end") - F.col("start")), "start", "kind")))
    added = both.where("not fixed and nth = 1").groupBy("k").agg(F.collect_list(F.struct("start", "kind", "end")).alias("more"))
    all_ = F.sort_array(F.concat("base", F.coalesce("more", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>"))))
    return found.join(added, "k", "left").select(*head, listed(all_).alias("spans"))
