"""Evaluation metrics, each a grouped aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from brindle.functions.expr import ratio
from brindle.functions.ordered import running_totals


def regression_metrics(df: DataFrame, y: str, yhat: str, by: Sequence[str] = ()) -> DataFrame:
    """RMSE, MAE, R² and RMSE of log1p (null when a value is below −1)."""
    e, le = F.col(y) - F.col(yhat), F.log1p(F.col(y)) - F.log1p(F.col(yhat))
    out = df.groupBy(*by).agg(
        F.count("*").alias("n"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
        (1 - F.try_divide(F.avg(e * e), F.var_pop(y))).alias("r2"), F.sqrt(F.avg(le * le)).alias("rmsle"),
    )
    return out


def forecast_metrics(df: DataFrame, y: str, yhat: str, by: Sequence[str]) -> DataFrame:
    """MSE, RMSE, MAE, MAPE % and sMAPE %; points with a zero denominator do not enter the percentages."""
    e = F.col(y) - F.col(yhat)
    mse = F.avg(e * e)
    return df.groupBy(*by).agg(
        mse.alias("mse"), F.sqrt(mse).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
        (100 * F.avg(F.try_divide(F.abs(e), F.abs(F.col(y))))).alias("mape"),
        (100 * F.avg(F.try_divide(2 * F.abs(e), F.abs(F.col(y)) + F.abs(F.col(yhat))))).alias("smape"),
    )


def classification_metrics(df: DataFrame, label: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    y, p = F.col(label) == 1, F.col(predicted) == 1
    c = df.groupBy(*by).agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    return c.withColumns({"accuracy": ratio(tp + tn, tp + fp + fn + tn), "f1": F.coalesce(ratio(2 * tp, 2 * tp + fp + fn), F.lit(0.0))})


def roc_auc(df: DataFrame, label: str, score: str, by: str) -> DataFrame:
    """Area under the ROC curve per value of `by` (a model name); null with one class only.

    Rows become a histogram per distinct score; a positive counts the negatives below it and half of
    those tied with it.
    """
    hist = df.groupBy(by, F.col(score).cast("double").alias("_score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    ranked = running_totals(hist, "_score", ["neg"], key=by)
    wins = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2))
    return ranked.groupBy(by).agg(F.try_divide(wins, F.sum("pos").cast("double") * F.sum("neg")).alias("auc"))


def leaderboard(df: DataFrame, metric: str, name: str, ascending: bool = True, places: int = 4) -> DataFrame:
    numeric = [c for c, t in df.dtypes if t in ("double", "float")]
    rounded = df.withColumns({c: F.round(c, places) for c in numeric})
    return rounded.orderBy(F.col(metric).asc() if ascending else F.col(metric).desc(), name)


def crosstab(df: DataFrame, rows: str, columns: str, values: Sequence) -> DataFrame:
    wide = df.groupBy(rows).pivot(columns, list(values)).count()
    return wide.fillna(0)


def _pairs(n: Column) -> Column:
    return n.cast("double") * (n - 1) / 2


def adjusted_rand(df: DataFrame, a: str, b: str) -> DataFrame:
    """Agreement of two partitions from their contingency table."""
    cells = df.groupBy(a, b).agg(F.count("*").alias("n"))
    rows = cells.groupBy(a).agg(F.sum("n").alias("n")).agg(F.sum(_pairs(F.col("n"))))
    cols = cells.groupBy(b).agg(F.sum("n").alias("n")).agg(F.sum(_pairs(F.col("n"))))
    total = cells.agg(F.sum(_pairs(F.col("n"))).alias("together"), F.sum("n").alias("n"), rows.scalar().alias("ra"), cols.scalar().alias("cb"))
    expected = F.try_divide(F.col("ra") * F.col("cb"), _pairs(F.col("n")))
    best = (F.col("ra") + F.col("cb")) / 2
    return total.select(F.coalesce(F.try_divide(F.col("together") - expected, best - expected), F.lit(1.0)).alias("ari"))


def mixture_criteria(log_likelihood: float, k: int, d: int, n: int) -> dict[str, float]:
    """AIC and BIC of a full-covariance mixture."""
    import math

    free = k * d + k * d * (d + 1) / 2 + k - 1
    return {"aic": 2 * free - 2 * log_likelihood, "bic": free * math.log(n) - 2 * log_likelihood}
