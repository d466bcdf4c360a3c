from collections import Counter

import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline
from brindle.llm.bpe import codec
from brindle.llm.quality_rules import fit_rules, judge, text_stats, votes
from .fixtures import empty, rows, table
from .test_corpus_operators import _groups, _targets
from .test_text_operators import PATH, WORD, _lines, sha


def test_each_stage_against_brute_force(spark, tmp_path):
    assert [len(corpus_pipeline.STAGES), corpus_pipeline.ORACLE_SQL] == [5, None]
    (_, quality), (_, lines), (_, near), (_, mix), (_, bpe) = corpus_pipeline.STAGES
    sf, n = str(tmp_path), 0

    def again(df):
        nonlocal n
        n += 1
        df.write.parquet(f"{sf}/{n}.parquet")
        return spark.read.parquet(f"{sf}/{n}.parquet")

    docs = again(table(spark))
    columns = docs.columns
    voted = votes(text_stats(docs))
    want = Counter((r.doc_id, r.text) for r in judge(voted, fit_rules(voted)).where("kept").select("row.doc_id", "row.text").collect())
    one = again(quality(spark, docs, sf))
    assert one.columns == columns and Counter((r.doc_id, r.text) for r in one.collect()) == want and 30 < one.count() < len(rows())

    rest = [(r.doc_id, r.text) for r in one.collect()]
    two = again(lines(spark, one, sf))
    kept = _lines([(i, t or "") for i, t in rest])
    assert two.columns == columns
    got = Counter((r.doc_id, r.text or "") for r in two.collect())
    # the order among rows that share an id is by a hash of the text, so only others are compared
    ids = Counter(i for i, _ in set(rest))
    assert all(got[i, kept[i, t or ""][3]] for i, t in rest if ids[i] == 1 and i is not None)
    assert sum(got.values()) == len(rest) and all(r.n_chars == len(r.text or "") for r in two.collect())

    rest = [(r.doc_id, r.text) for r in two.collect()]
    three = again(near(spark, two, sf))
    assert three.columns == columns and Counter(r.doc_id for r in three.collect()) == _one_of_each(rest)

    rest = three.collect()
    four = again(mix(spark, three, sf))
    sizes, taken = Counter(), Counter()
    for r in rest:
        sizes[r.source] += len(WORD.findall(r.text or ""))
    for r in four.collect():
        taken[r.source] += len(WORD.findall(r.text or ""))
    longest = max(len(WORD.findall(r.text or "")) for r in rest)
    assert four.columns == columns and all(abs(taken[s] - x) <= longest for s, x in _targets(sizes).items())

    ranks = codec(PATH, public_tokenizers.PATTERN).ranks
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter((r.doc_id, sha(np.array(library.encode_ordinary(r.text or ""), "<u4").tobytes()), sha(r.text or "")) for r in four.collect())
    assert Counter((r.doc_id, r.ids_sha256, r.decoded_sha256) for r in bpe(spark, four, sf).collect()) == want


def _one_of_each(rest):
    """Ids of the rows that stay: of each group the smallest id, nulls last; rows without words all stay."""
    own = [(n, t) for n, (_, t) in enumerate(rest)]
    ids = dict(enumerate(i for i, _ in rest))
    lows = {n: low for (n, size, low), _ in _groups(own, 5, 80, 100).items() if size}
    groups = {}
    for n, low in lows.items():
        groups.setdefault(low, []).append(ids[n])
    stay = Counter(min(found, key=lambda i: (i is None, i or 0)) for found in groups.values())
    return stay + Counter(i for n, i in ids.items() if n not in lows)


def test_repeated_rows_and_rows_without_an_id_are_thinned(spark):
    text, other = "one two three four five six seven eight nine ten", "red green blue cyan pink grey black white gold teal"
    data = [(5, text), (5, text), (5, text), (None, other), (None, other), (None, other), (9, None), (9, None), (9, " "), (None, "")]
    docs = table(spark, [(i, t, "en", "s", 0, *["clash"] * 9) for i, t in data])
    (_, _), (_, _), (_, near), _, _ = corpus_pipeline.STAGES
    got = Counter((r.doc_id, r.text) for r in near(spark, docs, "").collect())
    assert got == Counter([(5, text), (None, other), (9, None), (9, None), (9, " "), (None, "")])
    mixed = [(7, text), (3, text + " eleven"), (None, text), (3, text + " eleven"), (8, other)]
    docs = table(spark, [(i, t, "en", f"s{n}", 0, *["clash"] * 9) for n, (i, t) in enumerate(mixed)])
    assert sorted((r.doc_id, r.source) for r in near(spark, docs, "").collect()) == [(3, "s1"), (8, "s4")]
    assert near(spark, empty(spark), "").count() == 0


def test_run_is_the_chain_and_takes_an_empty_table(spark, tmp_path):
    empty(spark).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    table(spark).write.parquet(f"{tmp_path}/full/documents.parquet")
    a, b = ([tuple(r) for r in corpus_pipeline.run(spark, f"{tmp_path}/full").collect()] for _ in range(2))
    assert a and sorted(map(repr, a)) == sorted(map(repr, b))
