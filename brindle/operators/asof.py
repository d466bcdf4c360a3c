"""Point-in-time join: for each request, the newest feature row at or before its time.

Both sides are cut into (entity, period) groups, so an entity that owns a large share of all rows is
spread over its periods.  What earlier periods leave behind travels as one carried row per (entity,
period): it is worked out on a table already reduced to that grain.  Rows shuffle once and never multiply.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def asof_join(
    requests: DataFrame, features: DataFrame, entity: str, request_ts: str, feature_ts: str,
    values: Sequence[str], created: str | None = None, ttl_seconds: int | None = None,
    period: str = "day", keep_feature_ts: str | None = None,
) -> DataFrame:
    """Request columns followed by `values`; null where no feature row is recent enough.

    A request without an entity finds nothing: null is not a key.  A feature at exactly the request time counts, and so does one exactly `ttl_seconds` old.  Of rows with
    equal entity and feature time the newest `created` wins.  `period` (day, hour, …) sets the group size.
    """
    made = F.col(created) if created else F.col(feature_ts)
    feats = features.where(F.col(feature_ts).isNotNull() & F.col(entity).isNotNull()).select(
        F.col(entity).alias("_entity"), F.date_trunc(period, feature_ts).alias("_period"), F.col(feature_ts).alias("_ts"),
        made.alias("_made"), F.struct(F.col(feature_ts).alias("_feature_ts"), *values).alias("_value"),
    )
    reqs = requests.select(
        F.col(entity).alias("_entity"), F.date_trunc(period, request_ts).alias("_period"), F.col(request_ts).alias("_ts"),
        F.struct(*requests.columns).alias("_request"),
    )
    newest = feats.groupBy("_entity", "_period").agg(F.max_by("_value", F.struct("_ts", "_made")).alias("_value"))
    asked = reqs.select("_entity", "_period").distinct().withColumn("_asked", F.lit(True))
    earlier = Window.partitionBy("_entity").orderBy("_period").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        newest.unionByName(asked, allowMissingColumns=True)
        .groupBy("_entity", "_period")
        .agg(F.first("_value", ignorenulls=True).alias("_value"), F.max("_asked").alias("_asked"))
        .select("_entity", "_period", "_asked", F.last("_value", ignorenulls=True).over(earlier).alias("_value"))
        .where(F.col("_asked") & F.col("_value").isNotNull())
        .select("_entity", "_period", "_value", F.lit(-1).alias("_side"))
    )
    rows = (
        feats.withColumn("_side", F.lit(0))
        .unionByName(reqs.withColumn("_side", F.lit(1)), allowMissingColumns=True)
        .unionByName(carried, allowMissingColumns=True)
    )
    upto = (
        Window.partitionBy("_entity", "_period")
        .orderBy(F.col("_ts").asc_nulls_first(), "_side", F.col("_made").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = rows.select("_request", "_side", F.last("_value", ignorenulls=True).over(upto).alias("_value")).where("_side = 1")
    if ttl_seconds is not None:
        limit = F.col(f"_request.{request_ts}") - F.expr(f"INTERVAL '{int(ttl_seconds)}' SECOND")
        found = found.withColumn("_value", F.when(F.col("_value._feature_ts") >= limit, F.col("_value")))
    extra = [F.col("_value._feature_ts").alias(keep_feature_ts)] if keep_feature_ts else []
    return found.select("_request.*", *[F.col(f"_value.{v}").alias(v) for v in values], *extra)
