"""Feature selection on line items joined to parts."""

from __future__ import annotations

from pyspark.sql import functions as F

from brindle.operators import selection
from brindle.plans import base
from brindle.plans.registry import query

FEATURES = ["l_quantity", "l_discount", "l_tax", "p_size", "p_retailprice"]
TARGET = "l_extendedprice"


def _each(template: str, joiner: str = " UNION ALL ") -> str:
    return joiner.join(template.format(c=c) for c in FEATURES)


_CORR = f"WITH {base.SALES}, r AS (" + _each("SELECT '{c}' AS feature, corr({c}, l_extendedprice) AS r, count(*) AS n FROM sales") + ")"


@query("variance_threshold", f"WITH {base.SALES} " + _each("SELECT '{c}' AS feature, round(var_pop({c}), 4) AS variance, var_pop({c}) > 0.01 AS kept FROM sales"))
def variance_threshold(spark, sf):
    return selection.variance_threshold(base.sales(spark, sf), FEATURES, 0.01).withColumn("variance", F.round("variance", 4))


@query("abs_correlation_rank", _CORR + " SELECT feature, round(abs(r), 8) AS score FROM r")
def abs_correlation_rank(spark, sf):
    out = selection.abs_correlation(base.sales(spark, sf), FEATURES, TARGET)
    return out.withColumn("score", F.round("score", 8)).orderBy(F.desc("score"), "feature")


@query("f_regression_rank", _CORR + " SELECT feature, round(r * r * (n - 2) / (1 - r * r), 4) AS f, r * r * (n - 2) / (1 - r * r) > 3.8417 AS significant FROM r")
def f_regression_rank(spark, sf):
    out = selection.f_regression(base.sales(spark, sf), FEATURES, TARGET)
    return out.select("feature", F.round("f", 4).alias("f"), (F.col("p_value") < 0.05).alias("significant")).orderBy(F.desc("f"))


def _bins_sql() -> str:
    every = [*FEATURES, TARGET]
    edges = ", ".join(f"quantile_cont({c}::DOUBLE, {[i / 10 for i in range(1, 10)]}) AS e_{c}" for c in every)
    bins = ", ".join(f"len(list_filter(e_{c}, lambda e: e <= {c})) AS b_{c}" for c in every)
    long = _each("SELECT '{c}' AS feature, b_{c} AS x, b_l_extendedprice AS y FROM b")
    return f"""WITH {base.SALES}, e AS (SELECT {edges} FROM sales), b AS (SELECT {bins} FROM sales, e), long AS ({long}),
j AS (SELECT feature, x, y, count(*) AS nxy FROM long GROUP BY ALL),
c AS (SELECT *, sum(nxy) OVER (PARTITION BY feature, x) AS nx, sum(nxy) OVER (PARTITION BY feature, y) AS ny, sum(nxy) OVER (PARTITION BY feature) AS n FROM j)
SELECT feature, round(sum(nxy / n * ln(nxy * n / (nx * ny))), 8) AS score FROM c GROUP BY 1"""


@query("mutual_information_rank", _bins_sql())
def mutual_information_rank(spark, sf):
    out = selection.mutual_information(base.sales(spark, sf), FEATURES, TARGET)
    return out.withColumn("score", F.round("score", 8)).orderBy(F.desc("score"), "feature")


@query("select_k_best", _CORR + " SELECT feature, round(r * r * (n - 2) / (1 - r * r), 4) AS f FROM r ORDER BY f DESC, feature LIMIT 3")
def select_k_best(spark, sf):
    scores = selection.f_regression(base.sales(spark, sf), FEATURES, TARGET, p_values=False)
    return selection.select_k_best(scores, 3, "f").withColumn("f", F.round("f", 4))
