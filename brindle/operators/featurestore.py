"""Feature views, offline history, newest-per-entity snapshots and their consistency checks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from brindle.functions.expr import ratio
from brindle.operators.asof import asof_join

# fixed values: declared field types and the Spark types they stand for
FIELD_TYPES = {"Int64": "bigint", "Float32": "float", "Float64": "double", "String": "string", "Bool": "boolean"}


@dataclass(frozen=True)
class FeatureView:
    name: str
    entity: str
    fields: dict[str, str]
    ttl_seconds: int
    event_ts: str = "event_timestamp"
    created: str = "created"
    tags: dict[str, str] = field(default_factory=dict)

    def problems(self, df: DataFrame) -> list[str]:
        """Reasons why a table cannot serve this view."""
        have = dict(df.dtypes)
        out = [f"missing column {c}" for c in (self.entity, self.event_ts, self.created, *self.fields) if c not in have]
        out += [
            f"{c}: {have[c]} instead of {t}" for c, t in self.fields.items() if c in have and have[c] != FIELD_TYPES[t]
        ]
        return out + [f"{c}: starts with a digit" for c in self.fields if c[:1].isdigit()]


def user_activity(events: DataFrame) -> DataFrame:
    """Cumulative clicks, purchases and conversion rate per user and active day.

    A day's row carries the time of the user's last event of that day, so it never knows the future.
    Events are reduced to days before any ordering; the running sums see one row per user and day.
    """
    daily = events.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        F.max("ts").alias("event_timestamp"),
        F.count_if(F.col("event_type") == "click").alias("clicks"),
        F.count_if(F.col("event_type") == "purchase").alias("purchases"),
    )
    so_far = Window.partitionBy("user_id").orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = daily.select(
        "user_id", "event_timestamp", F.sum("clicks").over(so_far).alias("clicks"),
        F.sum("purchases").over(so_far).alias("purchases"),
        F.date_add("day", 1).cast("timestamp_ntz").alias("created"),
    )
    return total.withColumn("conversion_rate", F.coalesce(ratio(F.col("purchases"), F.col("clicks")), F.lit(0.0)))


def registry_rows(spark: SparkSession, views: Sequence[FeatureView]) -> DataFrame:
    """One row per declared field."""
    rows = [(v.name, v.entity, f, t, v.ttl_seconds, v.tags) for v in views for f, t in v.fields.items()]
    return spark.createDataFrame(
        rows, "view string, entity string, feature string, dtype string, ttl_seconds bigint, tags map<string,string>"
    )


def register_views(existing: DataFrame, views: Sequence[FeatureView]) -> DataFrame:
    """Registry after an apply: a view that is declared again replaces all its former fields."""
    new = registry_rows(existing.sparkSession, views)
    return existing.join(F.broadcast(new.select("view").distinct()), "view", "left_anti").unionByName(new)


def resolve_refs(refs: Sequence[str], views: Sequence[FeatureView]) -> dict[str, list[str]]:
    """`view:feature` references → features per view; an unknown reference is an error."""
    known = {v.name: v for v in views}
    out: dict[str, list[str]] = {}
    for ref in refs:
        view, sep, feature = ref.partition(":")
        if not sep or view not in known or feature not in known[view].fields:
            raise KeyError(f"unknown feature reference {ref!r}")
        out.setdefault(view, []).append(feature)
    return out


def historical_features(
    requests: DataFrame, history: DataFrame, view: FeatureView, features: Sequence[str] | None = None,
    request_ts: str = "event_timestamp", period: str = "day", keep_feature_ts: str | None = None,
) -> DataFrame:
    return asof_join(
        requests, history, view.entity, request_ts, view.event_ts, list(features or view.fields),
        created=view.created, ttl_seconds=view.ttl_seconds, period=period, keep_feature_ts=keep_feature_ts,
    )


def dedupe_latest_created(history: DataFrame, view: FeatureView) -> DataFrame:
    keys = [view.entity, view.event_ts]
    rest = [c for c in history.columns if c not in keys]
    return history.groupBy(*keys).agg(F.max_by(F.struct(*rest), view.created).alias("_r")).select(*keys, "_r.*")


def newest_per_entity(history: DataFrame, view: FeatureView) -> DataFrame:
    rest = [c for c in history.columns if c != view.entity]
    order = F.struct(view.event_ts, view.created)
    return history.groupBy(view.entity).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(view.entity, "_r.*")


def materialize(history: DataFrame, view: FeatureView, start: str | None, end: str) -> DataFrame:
    """Newest row per entity with event time in [start, end]."""
    ts = F.col(view.event_ts)
    cond = ts <= F.lit(end).cast("timestamp_ntz")
    if start is not None:
        cond &= ts >= F.lit(start).cast("timestamp_ntz")
    return newest_per_entity(history.where(cond), view)


def materialize_incremental(snapshot: DataFrame, history: DataFrame, view: FeatureView, watermark: str, end: str) -> DataFrame:
    """Fold rows newer than the watermark into the snapshot; the newest event time wins on both sides."""
    ts = F.col(view.event_ts)
    delta = history.where((ts > F.lit(watermark).cast("timestamp_ntz")) & (ts <= F.lit(end).cast("timestamp_ntz")))
    return merge_snapshot(snapshot, delta, view)


def merge_snapshot(snapshot: DataFrame, delta: DataFrame, view: FeatureView) -> DataFrame:
    return newest_per_entity(snapshot.unionByName(newest_per_entity(delta, view)), view)


def online_features(requests: DataFrame, snapshot: DataFrame, view: FeatureView, features: Sequence[str]) -> DataFrame:
    """Newest values for the requested entities; unknown entities get nulls."""
    return requests.join(snapshot.select(view.entity, *features), view.entity, "left")


def ttl_expiry(joined: DataFrame, request_ts: str, feature_ts: str, ttl_seconds: int) -> DataFrame:
    """How many requests found a value, found only an expired one, or found none (join made without TTL)."""
    fresh = F.col(feature_ts) >= F.col(request_ts) - F.expr(f"INTERVAL '{int(ttl_seconds)}' SECOND")
    return joined.agg(
        F.count("*").alias("requests"),
        F.count_if(fresh).alias("fresh"),
        F.count_if(~fresh).alias("expired"),
        F.count_if(F.col(feature_ts).isNull()).alias("no_history"),
    )


def train_serve_skew(train: DataFrame, online: DataFrame, entity: str, features: Sequence[str], tolerance: float = 1e-6) -> DataFrame:
    """(entity, feature, train_value, online_value) for every value that differs between the two."""
    both = train.select(entity, *[F.col(f).cast("double").alias(f"t_{f}") for f in features]).join(
        online.select(entity, *[F.col(f).cast("double").alias(f"o_{f}") for f in features]), entity
    )
    pairs = F.explode(
        F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"t_{f}").alias("train_value"), F.col(f"o_{f}").alias("online_value")) for f in features])
    )
    rows = both.select(entity, pairs.alias("_s")).select(entity, "_s.*")
    same_null = F.col("train_value").isNull() & F.col("online_value").isNull()
    close = F.abs(F.col("train_value") - F.col("online_value")) <= tolerance
    return rows.where(~F.coalesce(same_null | close, F.lit(False)))
