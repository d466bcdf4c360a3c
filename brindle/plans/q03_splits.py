"""Splits, folds and the leakage comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from brindle.operators import splits
from brindle.plans import base
from brindle.plans.registry import query
from brindle.sources.files import table


def h_sql(key: str, seed: int | str = 0, mod: int | None = 10000) -> str:
    value = f"('0x' || substr(md5('{seed}|' || {key}), 1, 8))::BIGINT"
    return f"({value} % {mod})" if mod else value


@query("random_split", f"SELECT o_orderkey, CASE WHEN {h_sql('o_orderkey', 7)} < 2000 THEN 'test' ELSE 'train' END AS split FROM orders")
def random_split(spark, sf):
    return splits.random_split(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], 0.2, seed=7)


@query("stratified_split", f"""SELECT o_orderkey, o_orderstatus, CASE WHEN rn <= floor(n * 0.25) THEN 'test' ELSE 'train' END AS split FROM (
SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY {h_sql('o_orderkey', 0, None)}, o_orderkey) AS rn,
  count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders)""")
def stratified_split(spark, sf):
    return splits.stratified_split(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), ["o_orderkey"], "o_orderstatus", 0.25)


@query("three_way_split", f"SELECT o_orderkey, CASE WHEN {h_sql('o_orderkey')} < 1500 THEN 'test' WHEN {h_sql('o_orderkey')} < 3000 THEN 'val' ELSE 'train' END AS split FROM orders")
def three_way_split(spark, sf):
    return splits.three_way_split(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"])


@query("kfold_assign", f"SELECT o_orderkey, {h_sql('o_orderkey', 0, 5)}::INTEGER AS fold FROM orders")
def kfold_assign(spark, sf):
    return splits.kfold(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], 5)


def _folds_sql(low: str) -> str:
    return f"""WITH {base.DAILY}, p AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY day) AS pos, count(*) OVER (PARTITION BY series) AS len FROM daily),
f AS (SELECT p.*, fold, len - (5 - fold) * 60 AS start FROM p, (SELECT unnest(range(5))::INTEGER AS fold))
SELECT series, day, y, fold, role FROM (SELECT *, CASE WHEN pos > start AND pos <= start + 60 THEN 'val' WHEN pos <= start AND pos > {low} THEN 'train' END AS role FROM f) WHERE role IS NOT NULL"""


@query("timeseries_split", _folds_sql("0"))
def timeseries_split(spark, sf):
    return splits.timeseries_folds(base.daily(spark, sf), "series", "day", 5, 60)


@query("timeseries_split_sliding", _folds_sql("start - 365"))
def timeseries_split_sliding(spark, sf):
    return splits.timeseries_folds(base.daily(spark, sf), "series", "day", 5, 60, train_size=365)


@query("holdout_last_h", f"""WITH {base.DAILY} SELECT series, day, y, CASE WHEN row_number() OVER (PARTITION BY series ORDER BY day DESC) <= 60 THEN 'test' ELSE 'train' END AS split FROM daily""")
def holdout_last_h(spark, sf):
    return splits.holdout_last(base.daily(spark, sf), "series", "day", 60)


@query("leakage_fit_compare", f"""SELECT round(mean_all, 4) AS mean_all, round(mean_train, 4) AS mean_train, round(mean_all - mean_train, 4) AS difference FROM (
SELECT avg(o_totalprice) AS mean_all, avg(o_totalprice) FILTER ({h_sql('o_orderkey')} >= 2500) AS mean_train FROM orders)""")
def leakage_fit_compare(spark, sf):
    out = splits.leakage_compare(table(spark, sf, "orders"), "o_totalprice", ~splits.in_test(["o_orderkey"], 0.25))
    return out.select(*[F.round(c, 4).alias(c) for c in out.columns])
