import datetime as dt

import pytest
from pyspark.sql import functions as F

from brindle.operators import featurestore as fs
from brindle.operators.asof import asof_join

T0 = dt.datetime(2024, 1, 10, 12, 0, 0)
VIEW = fs.FeatureView("v", "u", {"x": "Int64"}, ttl_seconds=86400)
US = dt.timedelta(microseconds=1)
DAY = dt.timedelta(days=1)


def features(spark, rows):
    return spark.createDataFrame(rows, "u bigint, event_timestamp timestamp_ntz, created timestamp_ntz, x bigint")


def ask(spark, feats, *times, u=1, **kw):
    req = spark.createDataFrame([(i, u, t) for i, t in enumerate(times)], "i bigint, u bigint, event_timestamp timestamp_ntz")
    out = fs.historical_features(req, feats, VIEW, **kw).collect()
    return [r["x"] for r in sorted(out, key=lambda r: r["i"])]


def test_request_at_feature_time_is_included_and_just_before_is_not(spark):
    assert ask(spark, features(spark, [(1, T0, T0, 7)]), T0, T0 - US) == [7, None]


def test_ttl_limit_is_inclusive(spark):
    assert ask(spark, features(spark, [(1, T0, T0, 7)]), T0 + DAY, T0 + DAY + US) == [7, None]


def test_newest_created_wins_at_equal_time(spark):
    feats = features(spark, [(1, T0, T0 + US, 2), (1, T0, T0, 1)])
    assert ask(spark, feats, T0 + US, T0 + dt.timedelta(hours=20)) == [2, 2]


def test_no_history_and_future_only(spark):
    feats = features(spark, [(2, T0, T0, 1), (1, T0 + DAY, T0, 9)])
    assert ask(spark, feats, T0) == [None]


@pytest.mark.parametrize("period", ["hour", "day", "month"])
def test_period_length_does_not_change_the_result(spark, period):
    feats = features(spark, [(1, T0 + dt.timedelta(hours=5 * i), T0, i) for i in range(20)])
    times = [T0 + dt.timedelta(hours=3 * i) for i in range(30)]
    want = [max((j for j in range(20) if 5 * j <= 3 * i and 3 * i - 5 * j <= 24), default=None) for i in range(30)]
    assert ask(spark, feats, *times, period=period) == want


def test_duplicate_requests_are_kept(spark):
    assert ask(spark, features(spark, [(1, T0, T0, 7)]), T0, T0) == [7, 7]


def test_asof_plan_has_no_cartesian_product(spark, capsys):
    feats = features(spark, [(1, T0, T0, 7)])
    asof_join(feats.select("u", F.col("event_timestamp").alias("t")), feats, "u", "t", "event_timestamp", ["x"]).explain()
    plan = capsys.readouterr().out
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_late_row_does_not_overwrite_and_merge_is_idempotent(spark):
    snap = features(spark, [(1, T0, T0, 5)])
    late = features(spark, [(1, T0 - DAY, T0 + DAY, 4)])
    once = fs.merge_snapshot(snap, late, VIEW)
    assert [r["x"] for r in once.collect()] == [5]
    assert [r["x"] for r in fs.merge_snapshot(once, late, VIEW).collect()] == [5]
    assert [r["x"] for r in fs.merge_snapshot(snap, late.where("false"), VIEW).collect()] == [5]


def test_online_read_and_planted_skew(spark):
    snap = features(spark, [(1, T0, T0, 5), (2, T0, T0, 6)])
    asked = spark.createDataFrame([(1,), (3,)], "u bigint")
    assert {r["u"]: r["x"] for r in fs.online_features(asked, snap, VIEW, ["x"]).collect()} == {1: 5, 3: None}
    other = features(spark, [(1, T0, T0, 5), (2, T0, T0, 60)])
    assert [tuple(r) for r in fs.train_serve_skew(snap, other, "u", ["x"]).collect()] == [(2, "x", 6.0, 60.0)]
    assert fs.train_serve_skew(snap, snap, "u", ["x"]).count() == 0


def test_view_checks_and_references(spark):
    assert VIEW.problems(features(spark, [])) == []
    assert VIEW.problems(features(spark, []).drop("x")) == ["missing column x"]
    assert any("digit" in p for p in fs.FeatureView("v", "u", {"1st": "Int64"}, 1).problems(features(spark, [])))
    assert fs.resolve_refs(["v:x"], [VIEW]) == {"v": ["x"]}
    with pytest.raises(KeyError):
        fs.resolve_refs(["v:y"], [VIEW])
    twice = fs.register_views(fs.registry_rows(spark, [VIEW]), [fs.FeatureView("v", "u", {"z": "String"}, 1)])
    assert [r["feature"] for r in twice.collect()] == ["z"]
