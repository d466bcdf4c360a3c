"""Evaluation metrics."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from brindle.operators import metrics
from brindle.plans import base
from brindle.plans.registry import query
from brindle.sources.files import table

DOCS = "docs AS (SELECT d.doc_id, lang, n_chars, quality, toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"


def docs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "lang", "n_chars").join(table(spark, sf, "labels"), "doc_id")


@query("regression_metrics", f"""WITH {base.SALES}, e AS (SELECT l_extendedprice AS y, l_quantity * p_retailprice AS p FROM sales)
SELECT count(*) AS n, round(sqrt(avg((y - p) ** 2)), 3) AS rmse, round(avg(abs(y - p)), 3) AS mae, round(1 - avg((y - p) ** 2) / var_pop(y), 8) AS r2,
round(sqrt(avg((ln(1 + y) - ln(1 + p)) ** 2)), 8) AS rmsle FROM e""")
def regression_metrics(spark, sf):
    priced = base.sales(spark, sf).select("l_extendedprice", (F.col("l_quantity") * F.col("p_retailprice")).alias("p"))
    out = metrics.regression_metrics(priced, "l_extendedprice", "p")
    return out.select("n", F.round("rmse", 3).alias("rmse"), F.round("mae", 3).alias("mae"), F.round("r2", 8).alias("r2"), F.round("rmsle", 8).alias("rmsle"))


def one_step(spark, sf):
    """Yesterday's and last week's value as forecasts of today's."""
    w = Window.partitionBy("series").orderBy("day")
    df = base.daily(spark, sf).select("series", "day", "y", F.lag("y", 1).over(w).alias("naive"), F.lag("y", 7).over(w).alias("weekly"))
    return df.unpivot(["series", "day", "y"], ["naive", "weekly"], "model", "yhat").where("yhat IS NOT NULL")


ONE_STEP = f"""{base.DAILY}, lagged AS (SELECT series, day, y, lag(y, 1) OVER w AS naive, lag(y, 7) OVER w AS weekly FROM daily WINDOW w AS (PARTITION BY series ORDER BY day)),
onestep AS (SELECT 'naive' AS model, series, y, naive AS yhat FROM lagged WHERE naive IS NOT NULL UNION ALL SELECT 'weekly', series, y, weekly FROM lagged WHERE weekly IS NOT NULL)"""
_FM = """round(avg((y - yhat) ** 2) / 1e6, {r}) AS mse, round(sqrt(avg((y - yhat) ** 2)), {r}) AS rmse, round(avg(abs(y - yhat)), {r}) AS mae,
round(100 * avg(abs(y - yhat) / abs(y)), 6) AS mape, round(100 * avg(2 * abs(y - yhat) / (abs(y) + abs(yhat))), 6) AS smape"""


@query("forecast_metrics", f"WITH {ONE_STEP} SELECT model, series, {_FM.format(r=3)} FROM onestep GROUP BY 1, 2")
def forecast_metrics(spark, sf):
    out = metrics.forecast_metrics(one_step(spark, sf), "y", "yhat", ["model", "series"]).withColumn("mse", F.col("mse") / 1e6)
    return out.select("model", "series", *[F.round(c, 3).alias(c) for c in ("mse", "rmse", "mae")], *[F.round(c, 6).alias(c) for c in ("mape", "smape")])


@query("leaderboard", f"WITH {ONE_STEP} SELECT model, {_FM.format(r=4)} FROM onestep GROUP BY 1".replace("mape, 6", "mape, 4").replace("abs(y)), 6)", "abs(y)), 4)").replace("abs(yhat))), 6)", "abs(yhat))), 4)"))
def leaderboard(spark, sf):
    out = metrics.forecast_metrics(one_step(spark, sf), "y", "yhat", ["model"]).withColumn("mse", F.col("mse") / 1e6)
    return metrics.leaderboard(out, "rmse", "model")


@query("classification_metrics", f"""WITH {DOCS}, c AS (SELECT lang, count(*) FILTER (quality = 1 AND n_chars > 1000) AS tp, count(*) FILTER (quality = 0 AND n_chars > 1000) AS fp,
count(*) FILTER (quality = 1 AND n_chars <= 1000) AS fn, count(*) FILTER (quality = 0 AND n_chars <= 1000) AS tn FROM docs GROUP BY 1)
SELECT lang, tp, fp, fn, tn, (tp + tn)::DOUBLE / (tp + fp + fn + tn)::DOUBLE AS accuracy, coalesce((2 * tp)::DOUBLE / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0.0) AS f1 FROM c""")
def classification_metrics(spark, sf):
    df = docs(spark, sf).withColumn("predicted", (F.col("n_chars") > 1000).cast("int"))
    return metrics.classification_metrics(df, "quality", "predicted", ["lang"])


@query("roc_auc", f"""WITH {DOCS}, long AS (SELECT 'quality' AS target, quality AS label, n_chars AS s FROM docs UNION ALL SELECT 'toxic', toxic, n_chars FROM docs),
r AS (SELECT target, label, s, rank() OVER (PARTITION BY target ORDER BY s) + (count(*) OVER (PARTITION BY target, s) - 1) / 2.0 AS rk FROM long)
SELECT target, round((sum(rk) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2.0) / (count(*) FILTER (label = 1) * count(*) FILTER (label = 0)), 8)::DOUBLE AS auc
FROM r GROUP BY 1""")
def roc_auc(spark, sf):
    long = docs(spark, sf).unpivot(["n_chars"], ["quality", "toxic"], "target", "label")
    return metrics.roc_auc(long, "label", "n_chars", "target").withColumn("auc", F.round("auc", 8))


@query("confusion_crosstab", """SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS "F", count(*) FILTER (o_orderstatus = 'O') AS "O", count(*) FILTER (o_orderstatus = 'P') AS "P" FROM orders GROUP BY 1""")
def confusion_crosstab(spark, sf):
    return metrics.crosstab(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@query("adjusted_rand", """WITH c AS (SELECT l_returnflag AS a, l_linestatus AS b, count(*)::DOUBLE AS n FROM lineitem GROUP BY 1, 2),
t AS (SELECT sum(n * (n - 1) / 2) AS together, sum(n) AS n, (SELECT sum(x * (x - 1) / 2) FROM (SELECT sum(n) AS x FROM c GROUP BY a)) AS ra,
(SELECT sum(x * (x - 1) / 2) FROM (SELECT sum(n) AS x FROM c GROUP BY b)) AS cb FROM c)
SELECT round((together - ra * cb / (n * (n - 1) / 2)) / ((ra + cb) / 2 - ra * cb / (n * (n - 1) / 2)), 8) AS ari FROM t""")
def adjusted_rand(spark, sf):
    return metrics.adjusted_rand(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus").withColumn("ari", F.round("ari", 8))
