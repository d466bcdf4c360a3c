"""Conversation state, experiment tracking and the streaming jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from brindle.operators import conversations, metrics, tracking
from brindle.plans import q11_featurestore as q11
from brindle.plans.base import cents
from brindle.plans.q13_metrics import ONE_STEP, one_step
from brindle.plans.registry import query
from brindle.sources.files import table
from brindle.sources.scratch import scratch_path
from brindle.streaming import jobs


@query("thread_history", "SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS position FROM conversations")
def thread_history(spark, sf):
    return conversations.thread_history(table(spark, sf, "conversations"))


@query("thread_checkpoints", """SELECT conv_id, turn, count(*) OVER w AS messages, (sum(length(text)) OVER w)::BIGINT AS chars FROM conversations
WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")
def thread_checkpoints(spark, sf):
    return conversations.thread_checkpoints(table(spark, sf, "conversations"))


@query("reducer_last_vs_append", "SELECT conv_id, max_by(role, turn) AS last_role, max_by(text, turn) AS last_text, count(*) AS n_messages, sum(length(text))::BIGINT AS n_chars FROM conversations GROUP BY 1")
def reducer_last_vs_append(spark, sf):
    return conversations.reduce_state(table(spark, sf, "conversations"))


@query("context_budget", """SELECT conv_id, turn, chars_from_end FROM (SELECT conv_id, turn, (sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS chars_from_end FROM conversations) WHERE chars_from_end <= 1500""")
def context_budget(spark, sf):
    return conversations.context_budget(table(spark, sf, "conversations"), 1500).select("conv_id", "turn", "chars_from_end")


def _runs(spark, sf):
    scores = metrics.forecast_metrics(one_step(spark, sf), "y", "yhat", ["model", "series"])
    scores = scores.select("model", "series", F.round("rmse", 3).alias("rmse"), F.round("mae", 3).alias("mae"))
    return tracking.run_rows(scores, "daily", ["model", "series"], ["rmse", "mae"], {"stage": "baseline"})


RUNS = f"""{ONE_STEP}, runs AS (SELECT md5('daily|' || model || '|' || series) AS run_id, model, series, round(sqrt(avg((y - yhat) ** 2)), 3) AS rmse, round(avg(abs(y - yhat)), 3) AS mae FROM onestep GROUP BY model, series)"""


@query("log_run", f"WITH {RUNS} SELECT run_id, 'daily' AS experiment, model, series, rmse, mae, 'baseline' AS stage FROM runs")
def log_run(spark, sf):
    """Runs appended to the run table and read back."""
    path = scratch_path(spark, "runs")
    tracking.log_runs(_runs(spark, sf), path)
    return tracking.read_runs(spark, path).select("run_id", "experiment", F.col("params.model").alias("model"), F.col("params.series").alias("series"),
                                                  F.col("metrics.rmse").alias("rmse"), F.col("metrics.mae").alias("mae"), F.col("tags.stage").alias("stage"))


@query("epoch_metrics", """WITH d AS (SELECT event_type AS run, datediff('day', DATE '2024-01-01', ts::DATE)::INTEGER AS step, round(value * 100)::BIGINT AS v FROM events)
SELECT run, step, 'mean' AS metric, avg(v) AS "value" FROM d GROUP BY ALL UNION ALL SELECT run, step, 'top', max(v)::DOUBLE FROM d GROUP BY ALL""")
def epoch_metrics(spark, sf):
    """Each event type is a run, each day a step."""
    e = table(spark, sf, "events").select("event_type", F.datediff(F.to_date("ts"), F.lit("2024-01-01")).alias("step"), cents("value").alias("v"))
    steps = e.groupBy("event_type", "step").agg(F.avg("v").alias("mean"), F.max("v").alias("top"))
    return tracking.epoch_metrics(steps, F.col("event_type"), F.col("step"), ["mean", "top"])


@query("best_run", f"WITH {RUNS} SELECT run_id, rmse AS \"value\" FROM runs ORDER BY rmse, run_id LIMIT 1")
def best_run(spark, sf):
    return tracking.best_run(_runs(spark, sf), "rmse").select("run_id", "value")


@query("register_version", f"""WITH {RUNS}, o AS (SELECT model AS name, run_id, row_number() OVER (PARTITION BY model ORDER BY run_id) AS v FROM runs WHERE series <> 'R'),
n AS (SELECT model AS name, run_id, (SELECT max(v) FROM o WHERE o.name = runs.model) + 1 AS v FROM runs WHERE series = 'R')
SELECT name, max(v)::INTEGER AS version, max_by(run_id, v) AS run_id FROM (SELECT * FROM o UNION ALL SELECT * FROM n) GROUP BY 1""")
def register_version(spark, sf):
    """Two registrations per model, then a third round; the latest version wins the lookup."""
    runs = _runs(spark, sf).select(F.col("params.model").alias("name"), "run_id", F.col("params.series").alias("series"))
    empty = spark.createDataFrame([], "name string, run_id string, version int")
    first = tracking.register_versions(empty, runs.where("series <> 'R'"))
    second = tracking.register_versions(first, runs.where("series = 'R'"))
    return tracking.latest_versions(first.unionByName(second))


@query("stream_materialize", f"WITH {q11.HISTORY} " + q11._snap_sql("true"))
def stream_materialize(spark, sf):
    """History arrives as files in random order; late rows must not replace newer ones."""
    path = scratch_path(spark, "history")
    hist = q11.history(spark, sf)
    hist.repartition(6, "event_timestamp").write.parquet(path)
    out = jobs.stream_materialize(spark, path, hist.schema, q11.USER_STATS)
    return out.drop("created").withColumn("conversion_rate", F.round("conversion_rate", 9))


@query("stream_resample", """WITH e AS (SELECT event_type, date_trunc('hour', ts)::TIMESTAMP AS ts, avg(round(value * 100)::BIGINT) AS y, count(*) AS n FROM events GROUP BY 1, 2)
SELECT event_type, ts, y, n FROM e WHERE ts + INTERVAL 1 HOUR <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 2 HOUR FROM events)""")
def stream_resample(spark, sf):
    path = scratch_path(spark, "events")
    events = table(spark, sf, "events").select("event_type", "ts", cents("value").alias("v"))
    events.write.parquet(path)
    return jobs.stream_resample(spark, path, events.schema, "ts", "event_type", "v")
