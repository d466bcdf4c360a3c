"""Inputs that earlier versions lost or refused: nulls, short series, short passages, unfinished writes, perfect models."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from brindle.operators import conversations, retrieval, ts_combine, ts_forecast as fc
from brindle.operators.asof import asof_join
from brindle.operators.models import poisson_steps
from brindle.sources import files


def test_request_without_entity_finds_nothing(spark):
    t = dt.datetime(2024, 1, 2)
    feats = spark.createDataFrame([(None, t, 9), (1, t, 5)], "e bigint, ts timestamp_ntz, v int")
    asked = spark.createDataFrame([(None, t), (1, t)], "e bigint, at timestamp_ntz")
    assert {(r["e"], r["v"]) for r in asof_join(asked, feats, "e", "at", "ts", ["v"]).collect()} == {(None, None), (1, 5)}


def test_model_without_error_takes_all_the_weight(spark):
    rows = [("s", "good", 1.0, 1.0), ("s", "bad", 1.0, 3.0), ("t", "good", 1.0, 2.0), ("t", "bad", 1.0, 3.0)]
    got = {(r["series"], r["model"]): r["weight"] for r in ts_combine.inverse_rmse_weights(spark.createDataFrame(rows, "series string, model string, y double, yhat double"), ["series"]).collect()}
    assert got == {("s", "good"): 1.0, ("s", "bad"): 0.0, ("t", "good"): pytest.approx(2 / 3), ("t", "bad"): pytest.approx(1 / 3)}


def test_messages_without_thread_or_turn_stay(spark):
    df = spark.createDataFrame([(None, 1, "u", "aa"), (None, 2, "u", "b"), (1, None, "u", "ccc"), (1, 0, "u", None)], "conv_id bigint, turn int, role string, text string")
    assert {(r["conv_id"], r["turn"], r["position"]) for r in conversations.thread_history(df).collect()} == {(None, 1, 1), (None, 2, 2), (1, None, 1), (1, 0, 2)}
    assert {(r["conv_id"], r["turn"], r["chars"]) for r in conversations.thread_checkpoints(df).collect()} == {(None, 1, 2), (None, 2, 3), (1, None, 3), (1, 0, 3)}
    assert {(r["conv_id"], r["turn"]) for r in conversations.context_budget(df, 2).collect()} == {(None, 2), (1, 0)}


def test_short_series_do_not_stop_the_others(spark):
    day = dt.date(2020, 1, 1)
    rows = [("long", day + dt.timedelta(i), float(i)) for i in range(400)] + [("short", day + dt.timedelta(i), 1.0) for i in range(20)]

    class Last:
        def transform(self, df):
            return df.withColumn("prediction", F.col("lag_365"))

    got = fc.recursive_forecast(Last(), spark.createDataFrame(rows, "series string, day date, y double"), "series", "day", "y", 3).collect()
    assert {(r["series"], r["h"], r["yhat"]) for r in got} == {("long", h, 34.0 + h) for h in (1, 2, 3)} | {("short", h, None) for h in (1, 2, 3)}


def test_mode_that_finds_nothing_counts_as_zero(spark):
    marked = spark.createDataFrame([("a", 1, 0, True)], "mode string, q bigint, rank int, relevant boolean")
    queries = spark.createDataFrame([(1,), (2,)], "q bigint")
    got = retrieval.hit_rate_mrr(marked, queries, "q", [3], modes=["a", "b"]).collect()
    assert {(r["mode"], r["hit_rate"], r["mrr"]) for r in got} == {("a", 0.5, 0.5), ("b", 0.0, 0.0)}


def test_passages_of_any_length_are_found(spark):
    docs = [(1, "alpha beta gamma delta, epsilon zeta eta theta"), (2, "xbeta gamma"), (3, "Beta Gamma delta"), (4, None), (5, "")]
    passages = [(1, "beta gamma delta"), (2, "gam"), (3, "a"), (4, "ta"), (5, "beta gamma"), (6, "alpha beta gamma delta, epsilon zeta eta theta"), (7, ""), (8, None), (9, "delta, epsilon zeta eta"), (10, "a beta  gamma")]
    d = spark.createDataFrame(docs, "d bigint, text string")
    p = spark.createDataFrame(passages, "p bigint, text string")
    got = {(r["p"], r["d"]) for r in retrieval.verbatim_matches(d, p, "d", "p", "text").collect()}
    assert got == {(i, j) for i, x in passages for j, t in docs if x and t and x in t}


def test_unfinished_write_is_not_taken_for_finished(spark, tmp_path):
    path = str(tmp_path / "cache")
    spark.range(3).write.csv(path)
    assert files.exists(spark, path)
    (tmp_path / "cache" / "_SUCCESS").unlink()
    assert not files.exists(spark, path) and not files.exists(spark, str(tmp_path / "none"))


def test_bootstrap_steps_reach_the_end():
    steps = poisson_steps()
    assert steps[0] == pytest.approx(0.36787944117144233) and 1 - steps[-1] < 2**-32 and steps == sorted(steps)


def test_stream_stops_and_resumes(spark, tmp_path):
    from brindle.operators.featurestore import FeatureView
    from brindle.streaming.jobs import stream_materialize

    view = FeatureView("v", "user_id", {"clicks": "bigint"}, ttl_seconds=60)
    schema = "user_id bigint, event_timestamp timestamp_ntz, created timestamp_ntz, clicks bigint"
    t = dt.datetime(2024, 1, 1)

    def put(rows):
        spark.createDataFrame([(u, t + dt.timedelta(hours=h), t, c) for u, h, c in rows], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    folders = {"snapshot": str(tmp_path / "snap"), "offsets": str(tmp_path / "off")}
    empty = spark.createDataFrame([], schema).schema
    put([(1, 5, 50), (2, 1, 10)])
    first = stream_materialize(spark, str(tmp_path / "in"), empty, view, 1, **folders)
    assert {(r["user_id"], r["clicks"]) for r in first.collect()} == {(1, 50), (2, 10)}
    again = stream_materialize(spark, str(tmp_path / "in"), empty, view, 1, **folders)  # nothing new: the snapshot stands
    assert again.count() == 2
    put([(1, 4, 40), (3, 1, 7)])  # an older event never overwrites
    put([(2, 9, 90)])
    last = stream_materialize(spark, str(tmp_path / "in"), empty, view, 1, **folders)
    assert {(r["user_id"], r["clicks"]) for r in last.collect()} == {(1, 50), (2, 90), (3, 7)}
    assert len(list((tmp_path / "snap" / "manifest").glob("batch=*"))) <= 2


def test_snapshot_rewrites_touched_buckets_only(spark, tmp_path, monkeypatch):
    from brindle.operators.featurestore import FeatureView
    from brindle.streaming.jobs import SnapshotSink

    view = FeatureView("v", "user_id", {"clicks": "bigint"}, ttl_seconds=60)
    schema = "user_id bigint, event_timestamp timestamp_ntz, created timestamp_ntz, clicks bigint"
    t = dt.datetime(2024, 1, 1)
    rows = lambda data: spark.createDataFrame([(u, t + dt.timedelta(hours=h), t, c) for u, h, c in data], schema)
    sink = SnapshotSink(spark, view, str(tmp_path), rows([]).schema, buckets=8)
    state = lambda: {(r["user_id"], r["clicks"]) for r in sink.read().collect()}
    assert state() == set()
    sink(rows([(u, 1, u) for u in range(40)]), 0)
    first, files = sink.manifest(), sorted(p for p in tmp_path.glob("data/batch=00000000/**/*.parquet"))
    stamp = {p: p.stat().st_mtime_ns for p in files}
    sink(rows([(7, 5, 700), (7, 3, 300)]), 1)
    moved = {k for k, v in sink.manifest().items() if v == 1}
    assert len(first) == 8 and len(moved) == 1 and {v for k, v in sink.manifest().items() if k not in moved} == {0}
    assert {p: p.stat().st_mtime_ns for p in files} == stamp and state() == {(u, u) for u in range(40) if u != 7} | {(7, 700)}
    # a batch that dies before it is published leaves the manifest before it; run again it is applied once
    publish = SnapshotSink._publish
    monkeypatch.setattr(SnapshotSink, "_publish", lambda *a: (_ for _ in ()).throw(OSError("killed")))
    with pytest.raises(OSError):
        sink(rows([(u, 9, -u) for u in range(40)]), 2)
    assert state() == {(u, u) for u in range(40) if u != 7} | {(7, 700)}
    monkeypatch.setattr(SnapshotSink, "_publish", publish)
    sink(rows([(u, 9, -u) for u in range(40)]), 2)
    assert state() == {(u, -u) for u in range(40)}
    sink(rows([]), 3)  # an empty batch
    sink(rows([(1, 10, 5)]), 4)
    assert sink.batches() == [3, 4] and (1, 5) in state() and len(state()) == 40
    assert not (tmp_path / "data" / "batch=00000000").exists()
