"""Feature store queries on the events stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from brindle.operators import featurestore as fs
from brindle.operators.asof import asof_join
from brindle.plans.registry import query
from brindle.sources.files import table

USER_STATS = fs.FeatureView(
    "user_stats", "user_id", {"clicks": "Int64", "purchases": "Int64", "conversion_rate": "Float64"}, ttl_seconds=2 * 86400
)
END, MARK = "2024-01-25 00:00:00", "2024-01-15 00:00:00"

HISTORY = """
daily AS (SELECT user_id, CAST(ts AS DATE) AS day, max(ts) AS event_timestamp,
    count(*) FILTER (event_type = 'click') AS c, count(*) FILTER (event_type = 'purchase') AS p
  FROM events GROUP BY 1, 2),
history AS (SELECT user_id, event_timestamp, created, clicks, purchases,
    CASE WHEN clicks = 0 THEN 0.0 ELSE purchases::DOUBLE / clicks END AS conversion_rate
  FROM (SELECT user_id, event_timestamp, CAST(day + 1 AS TIMESTAMP) AS created,
      (sum(c) OVER w)::BIGINT AS clicks, (sum(p) OVER w)::BIGINT AS purchases
    FROM daily WINDOW w AS (PARTITION BY user_id ORDER BY day)))
"""


def history(spark, sf):
    return fs.user_activity(table(spark, sf, "events"))


def requests(spark, sf):
    """Every sign-up is a moment at which a prediction would have been asked for."""
    return table(spark, sf, "events").where("event_type = 'signup'").select("event_id", "user_id", F.col("ts").alias("event_timestamp"))


@query("daily_cumulative_features", f"WITH {HISTORY} SELECT user_id, event_timestamp, created, clicks, purchases, round(conversion_rate, 9) AS conversion_rate FROM history")
def daily_cumulative_features(spark, sf):
    return history(spark, sf).withColumn("conversion_rate", F.round("conversion_rate", 9))


@query("historical_features", f"""WITH {HISTORY},
hit AS (SELECT e.event_id, e.user_id, e.ts AS event_timestamp, h.clicks, h.purchases, h.conversion_rate,
    h.event_timestamp >= e.ts - INTERVAL 2 DAY AS ok
  FROM (SELECT * FROM events WHERE event_type = 'signup') e
  ASOF LEFT JOIN history h ON e.user_id = h.user_id AND e.ts >= h.event_timestamp)
SELECT event_id, user_id, event_timestamp, CASE WHEN ok THEN clicks END AS clicks,
  CASE WHEN ok THEN purchases END AS purchases, round(CASE WHEN ok THEN conversion_rate END, 9) AS conversion_rate FROM hit""")
def historical_features(spark, sf):
    out = fs.historical_features(requests(spark, sf), history(spark, sf), USER_STATS)
    return out.withColumn("conversion_rate", F.round("conversion_rate", 9))


@query("asof_raw_values", """SELECT e.event_id, e.user_id, c.value AS last_click_value,
  CASE WHEN c.ts >= e.ts - INTERVAL 1 DAY THEN true WHEN c.ts IS NULL THEN NULL ELSE false END AS within_day
FROM (SELECT * FROM events WHERE event_type = 'purchase') e
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') c ON e.user_id = c.user_id AND e.ts >= c.ts""")
def asof_raw_values(spark, sf):
    """As-of join straight on the stream: raw clicks at purchase time, no pre-aggregated history."""
    events = table(spark, sf, "events")
    asked = events.where("event_type = 'purchase'").select("event_id", "user_id", F.col("ts").alias("asked_at"))
    clicks = events.where("event_type = 'click'").select("user_id", "ts", "value")
    out = asof_join(asked, clicks, "user_id", "asked_at", "ts", ["value"], keep_feature_ts="click_ts", period="hour")
    return out.select("event_id", "user_id", F.col("value").alias("last_click_value"),
                      (F.col("click_ts") >= F.col("asked_at") - F.expr("INTERVAL 1 DAY")).alias("within_day"))


@query("build_entity_features", """SELECT o_orderkey AS order_id, coalesce(o_totalprice, 0.0)::FLOAT AS total_price,
  CASE o_orderpriority WHEN '1-URGENT' THEN 5 WHEN '2-HIGH' THEN 4 WHEN '3-MEDIUM' THEN 3
    WHEN '4-NOT SPECIFIED' THEN 2 WHEN '5-LOW' THEN 1 ELSE 0 END::BIGINT AS priority_ord,
  coalesce(o_orderstatus, 'None') AS status, o_orderdate AS event_timestamp, o_orderdate + INTERVAL 1 DAY AS created FROM orders""")
def build_entity_features(spark, sf):
    levels = F.create_map(*[F.lit(v) for pair in PRIORITY_LEVELS.items() for v in pair])
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.coalesce("o_totalprice", F.lit(0.0)).cast("float").alias("total_price"),
        F.coalesce(levels[F.col("o_orderpriority")], F.lit(0)).cast("bigint").alias("priority_ord"),
        F.coalesce("o_orderstatus", F.lit("None")).alias("status"),
        F.col("o_orderdate").alias("event_timestamp"),
        (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("created"),
    )


# fixed values: order of the priority levels
PRIORITY_LEVELS = {"5-LOW": 1, "4-NOT SPECIFIED": 2, "3-MEDIUM": 3, "2-HIGH": 4, "1-URGENT": 5}


@query("register_views", f"""WITH {HISTORY}
SELECT 'user_stats' AS "view", 'user_id' AS entity, f AS feature, t AS dtype, 172800::BIGINT AS ttl_seconds, n AS non_null_rows, true AS type_ok
FROM (SELECT 'clicks' AS f, 'Int64' AS t, count(clicks) AS n FROM history
  UNION ALL SELECT 'purchases', 'Int64', count(purchases) FROM history
  UNION ALL SELECT 'conversion_rate', 'Float64', count(conversion_rate) FROM history)""")
def register_views(spark, sf):
    """Declared fields checked against the table that backs them."""
    hist = history(spark, sf)
    bad = " ".join(USER_STATS.problems(hist))
    counts = hist.agg(*[F.count(f).alias(f) for f in USER_STATS.fields]).unpivot([], list(USER_STATS.fields), "feature", "non_null_rows")
    reg = fs.register_views(fs.registry_rows(spark, [USER_STATS]), [USER_STATS])
    return reg.drop("tags").join(counts, "feature").withColumn("type_ok", ~F.contains(F.lit(bad), F.col("feature")))


@query("resolve_refs", f"WITH {HISTORY} SELECT user_id, event_timestamp, clicks, round(conversion_rate, 9) AS conversion_rate FROM history")
def resolve_refs(spark, sf):
    chosen = fs.resolve_refs(["user_stats:clicks", "user_stats:conversion_rate"], [USER_STATS])["user_stats"]
    return history(spark, sf).select("user_id", "event_timestamp", *chosen).withColumn("conversion_rate", F.round("conversion_rate", 9))


@query("dedupe_latest_created", """SELECT user_id, hour AS event_timestamp, created, value FROM (
  SELECT user_id, date_trunc('hour', ts) AS hour, ts AS created, value,
    row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY ts DESC) AS rn FROM events) WHERE rn = 1""")
def dedupe_latest_created(spark, sf):
    """Several corrections of one hourly value: the one created last wins."""
    rows = table(spark, sf, "events").select(
        "user_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("event_timestamp"), F.col("ts").alias("created"), "value")
    return fs.dedupe_latest_created(rows, fs.FeatureView("hourly", "user_id", {"value": "Float64"}, 3600))


@query("attach_label", f"""WITH {HISTORY}
SELECT h.user_id, h.event_timestamp, h.clicks, c.c_acctbal AS label FROM history h JOIN customer c ON h.user_id = c.c_custkey""")
def attach_label(spark, sf):
    label = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_acctbal").alias("label"))
    return history(spark, sf).select("user_id", "event_timestamp", "clicks").join(label, "user_id")


def _snap_sql(cond):
    return f"""SELECT user_id, event_timestamp, clicks, purchases, round(conversion_rate, 9) AS conversion_rate FROM history
  WHERE {cond} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp DESC, created DESC) = 1"""


@query("materialize_window", f"WITH {HISTORY} " + _snap_sql(f"event_timestamp BETWEEN '{MARK}' AND '{END}'"))
def materialize_window(spark, sf):
    out = fs.materialize(history(spark, sf), USER_STATS, MARK, END)
    return out.drop("created").withColumn("conversion_rate", F.round("conversion_rate", 9))


@query("materialize_incremental", f"WITH {HISTORY} " + _snap_sql(f"event_timestamp <= '{END}'"))
def materialize_incremental(spark, sf):
    hist = history(spark, sf)
    first = fs.materialize(hist, USER_STATS, None, MARK)
    out = fs.materialize_incremental(first, hist, USER_STATS, MARK, END)
    return out.drop("created").withColumn("conversion_rate", F.round("conversion_rate", 9))


@query("online_features", f"""WITH {HISTORY}, snap AS ({_snap_sql("true")})
SELECT c_custkey AS user_id, clicks, conversion_rate FROM customer LEFT JOIN snap ON c_custkey = user_id""")
def online_features(spark, sf):
    snap = fs.newest_per_entity(history(spark, sf), USER_STATS).withColumn("conversion_rate", F.round("conversion_rate", 9))
    asked = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    return fs.online_features(asked, snap, USER_STATS, ["clicks", "conversion_rate"])


@query("ttl_expiry", f"""WITH {HISTORY}, hit AS (SELECT e.ts, h.event_timestamp AS fts
  FROM (SELECT * FROM events WHERE event_type = 'signup') e ASOF LEFT JOIN history h ON e.user_id = h.user_id AND e.ts >= h.event_timestamp)
SELECT count(*) AS requests, count(*) FILTER (fts >= ts - INTERVAL 2 DAY) AS fresh,
  count(*) FILTER (fts < ts - INTERVAL 2 DAY) AS expired, count(*) FILTER (fts IS NULL) AS no_history FROM hit""")
def ttl_expiry(spark, sf):
    joined = asof_join(requests(spark, sf), history(spark, sf), "user_id", "event_timestamp", "event_timestamp",
                       ["clicks"], created="created", keep_feature_ts="feature_ts")
    return fs.ttl_expiry(joined, "event_timestamp", "feature_ts", USER_STATS.ttl_seconds)


@query("train_serve_skew", f"""WITH {HISTORY}, a AS ({_snap_sql("true")}), b AS ({_snap_sql(f"event_timestamp <= '{END}'")})
SELECT * FROM (SELECT a.user_id, unnest(['clicks', 'purchases']) AS feature,
  unnest([a.clicks::DOUBLE, a.purchases::DOUBLE]) AS train_value, unnest([b.clicks::DOUBLE, b.purchases::DOUBLE]) AS online_value
  FROM a JOIN b USING (user_id)) WHERE abs(train_value - online_value) > 1e-6""")
def train_serve_skew(spark, sf):
    """Values trained on the full history against a snapshot that stopped being refreshed."""
    hist = history(spark, sf)
    return fs.train_serve_skew(fs.newest_per_entity(hist, USER_STATS), fs.materialize(hist, USER_STATS, None, END),
                               "user_id", ["clicks", "purchases"])
