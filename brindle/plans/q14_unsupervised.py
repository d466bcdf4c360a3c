"""Clusters, density, anomalies and day profiles."""

from __future__ import annotations

from pyspark.ml.clustering import GaussianMixture, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.recommendation import ALS
from pyspark.sql import functions as F

from brindle.functions.expr import with_params
from brindle.functions.ordered import quantile_row
from brindle.operators import density, isoforest, metrics, outliers, reachability, ts_cluster as tc
from brindle.operators.knn import knn_join
from brindle.operators.scale import apply_zscore, fit_zscore
from brindle.plans.base import cents
from brindle.plans.registry import query
from brindle.sources.files import table
from brindle.sources.scratch import cut_lineage


def user_points(spark, sf):
    """Orders per customer: how many and how large, on z-scores."""
    df = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").cast("double").alias("n"), F.avg(cents("o_totalprice")).alias("price"))
    z = apply_zscore(df, fit_zscore(df, ["n", "price"]), ["n", "price"])
    return VectorAssembler(inputCols=["n", "price"], outputCol="features").transform(z)


def _best_kmeans(rows, k, seeds=range(10)):
    fits = [KMeans(k=k, seed=s).fit(rows) for s in seeds]
    return min(fits, key=lambda m: m.summary.trainingCost)


@query("kmeans")
def kmeans(spark, sf):
    rows = user_points(spark, sf).persist()
    return _best_kmeans(rows, 3).transform(rows).groupBy("prediction").agg(F.count("*").alias("n"), F.avg("n").alias("mean_n"), F.avg("price").alias("mean_price"))


@query("gaussian_mixture")
def gaussian_mixture(spark, sf):
    rows = user_points(spark, sf).persist()
    model = GaussianMixture(k=3, seed=0, maxIter=30).fit(rows)
    return model.transform(rows).groupBy("prediction").agg(F.count("*").alias("n"), F.avg("n").alias("mean_n"), F.avg("price").alias("mean_price"))


@query("silhouette")
def silhouette(spark, sf):
    rows = user_points(spark, sf).persist()
    out = [(k, float(ClusteringEvaluator().evaluate(KMeans(k=k, seed=0).fit(rows).transform(rows)))) for k in (2, 3, 4)]
    return spark.createDataFrame(out, "k int, silhouette double")


@query("mixture_bic_aic")
def mixture_bic_aic(spark, sf):
    rows = user_points(spark, sf).persist()
    n, out = rows.count(), []
    for k in (2, 3, 4):
        ll = float(GaussianMixture(k=k, seed=0, maxIter=30).fit(rows).summary.logLikelihood)
        c = metrics.mixture_criteria(ll, k, 2, n)
        out.append((k, ll, c["aic"], c["bic"]))
    return spark.createDataFrame(out, "k int, log_likelihood double, aic double, bic double")


@query("cluster_compare")
def cluster_compare(spark, sf):
    rows = user_points(spark, sf).persist()
    n = rows.count()
    km, gm = _best_kmeans(rows, 3), GaussianMixture(k=3, seed=0, maxIter=30).fit(rows)
    score = ClusteringEvaluator()
    c = metrics.mixture_criteria(float(gm.summary.logLikelihood), 3, 2, n)
    out = [("kmeans", float(score.evaluate(km.transform(rows))), None, None), ("mixture", float(score.evaluate(gm.transform(rows))), c["aic"], c["bic"])]
    return spark.createDataFrame(out, "method string, silhouette double, aic double, bic double")


def part_points(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", F.col("p_size").cast("double").alias("a"), F.col("p_retailprice").alias("b"))
    return apply_zscore(df, fit_zscore(df, ["a", "b"]), ["a", "b"])


EPS, MIN_POINTS = 0.1, 5
_PTS = """p AS (SELECT p_partkey, (p_size - avg(p_size) OVER ()) / stddev_pop(p_size) OVER () AS a, (p_retailprice - avg(p_retailprice) OVER ()) / stddev_pop(p_retailprice) OVER () AS b FROM part)"""


@query("dbscan_core", f"""WITH {_PTS}, e AS (SELECT x.p_partkey AS i, y.p_partkey AS j FROM p x JOIN p y ON y.a BETWEEN x.a - 0.11 AND x.a + 0.11 AND sqrt((x.a - y.a) ** 2 + (x.b - y.b) ** 2) <= {EPS}),
c AS (SELECT i FROM e GROUP BY i HAVING count(*) >= {MIN_POINTS}), r AS (SELECT DISTINCT j FROM e WHERE i IN (SELECT i FROM c))
SELECT p_partkey, p_partkey IN (SELECT i FROM c) AS core, p_partkey NOT IN (SELECT j FROM r) AS noise FROM p""")
def dbscan_core(spark, sf):
    out = density.dbscan(part_points(spark, sf), "p_partkey", ["a", "b"], EPS, MIN_POINTS)
    return out.select("p_partkey", "core", (F.col("label") == -1).alias("noise"))


_DBSCAN = f"""{_PTS}, e AS (SELECT x.p_partkey AS i, y.p_partkey AS j FROM p x JOIN p y ON y.a BETWEEN x.a - 0.11 AND x.a + 0.11 AND sqrt((x.a - y.a) ** 2 + (x.b - y.b) ** 2) <= {EPS}),
c AS (SELECT i FROM e GROUP BY i HAVING count(*) >= {MIN_POINTS}), ce AS (SELECT e.i, e.j FROM e SEMI JOIN c ON c.i = e.i SEMI JOIN c AS c2 ON c2.i = e.j),
r AS (SELECT i AS x, i AS y FROM c UNION SELECT x, ce.j FROM r JOIN ce ON ce.i = r.y WHERE ce.j > r.x OR ce.j < r.x), low AS (SELECT x, min(y) AS label FROM r GROUP BY x),
lab AS (SELECT p_partkey, low.label IS NOT NULL AS core, coalesce(low.label, (SELECT min(n.label) FROM e JOIN low AS n ON n.x = e.j WHERE e.i = p_partkey), -1) AS label FROM p LEFT JOIN low ON low.x = p_partkey)"""


@query("dbscan", f"WITH RECURSIVE {_DBSCAN} SELECT label, count(*) AS n, count(*) FILTER (core) AS n_core FROM lab GROUP BY label")
def dbscan(spark, sf):
    out = density.dbscan(part_points(spark, sf), "p_partkey", ["a", "b"], EPS, MIN_POINTS)
    return out.groupBy("label").agg(F.count("*").alias("n"), F.count_if("core").alias("n_core"))


@query("core_distance", """WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings), d AS (SELECT a.vec_id, round(list_distance(a.e, b.e), 12) AS d, b.vec_id AS o FROM v a, v b)
SELECT vec_id, round(d, 6) AS core_distance FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, o) AS rn FROM d) WHERE rn = 10""")
def core_distance(spark, sf):
    vecs = table(spark, sf, "embeddings")
    near = knn_join(vecs.select(F.col("vec_id").alias("qid"), F.col("embedding").alias("vec")), vecs.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"), F.lit(0.0).alias("payload")), 10, "euclidean")
    return near.where("rank = 10").select(F.col("qid").alias("vec_id"), F.round("score", 6).alias("core_distance"))


_MREACH = """v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings), d AS (SELECT a.vec_id AS i, b.vec_id AS j, round(list_distance(a.e, b.e), 12) AS d FROM v a, v b),
core AS (SELECT i, d AS c FROM d QUALIFY row_number() OVER (PARTITION BY i ORDER BY d, j) = 10),
m AS (SELECT d.i, d.j, greatest(d, a.c, b.c) AS w FROM d JOIN core a ON a.i = d.i JOIN core b ON b.i = d.j)"""


@query("reachability_tree", f"""WITH RECURSIVE {_MREACH},
rows AS (SELECT i, list({{'w': w, 'lo': least(i, j), 'hi': greatest(i, j), 'j': j}} ORDER BY j) AS r FROM m GROUP BY i),
prim AS (SELECT (SELECT count(*) FROM core) - 1 AS left_, list_filter(r, lambda e: e.j <> i) AS front, NULL::STRUCT(w DOUBLE, lo BIGINT, hi BIGINT, j BIGINT) AS took FROM rows WHERE i = (SELECT min(i) FROM rows)
  UNION ALL SELECT left_ - 1, list_filter(list_transform(list_zip(front, list_filter(r, lambda e: list_contains(list_transform(front, lambda f: f.j), e.j))), lambda z: least(z[1], z[2])), lambda e: e.j <> p.j), p
  FROM (SELECT left_, front, list_min(front) AS p FROM prim WHERE left_ > 0) JOIN rows ON rows.i = p.j)
SELECT took.lo AS a, took.hi AS b, round(took.w, 6) AS weight FROM prim WHERE took IS NOT NULL""")
def reachability_tree(spark, sf):
    """The least spanning tree over mutual reachability of all vectors."""
    tree, _, _ = reachability.spanning_tree(table(spark, sf, "embeddings"), "vec_id", "embedding", 10)
    return tree.select("a", "b", F.round("weight", 6).alias("weight"))


LEVELS = (1.2, 1.215, 1.23)


@query("reachability_clusters", f"""WITH RECURSIVE {_MREACH}, lv AS (SELECT unnest([{', '.join(map(str, LEVELS))}]::DOUBLE[]) AS eps),
r AS (SELECT eps, i AS x, i AS y FROM core, lv WHERE c <= eps UNION SELECT eps, x, j FROM r JOIN m ON m.i = y AND m.w <= eps AND m.i <> m.j),
low AS (SELECT eps, x, min(y) AS label FROM r GROUP BY 1, 2)
SELECT lv.eps, core.i AS vec_id, coalesce(label, -1) AS label FROM lv, core LEFT JOIN low ON low.eps = lv.eps AND low.x = core.i""")
def reachability_clusters(spark, sf):
    """Clusters of the same tree at three levels of density."""
    tree, core, _ = reachability.spanning_tree(table(spark, sf, "embeddings"), "vec_id", "embedding", 10)
    return reachability.cut_tree(cut_lineage(tree), core, "vec_id", LEVELS)


def event_points(spark, sf):
    """Every event's value and payload number, on z-scores, with the known outliers."""
    df = table(spark, sf, "events").select("event_id", "value", F.get_json_object("props", "$.k").cast("double").alias("k"))
    df = df.select("event_id", (F.col("value") > 150).cast("int").alias("known"), F.col("value").alias("v"), "k")
    return apply_zscore(df, fit_zscore(df, ["v", "k"]), ["v", "k"])


def _forest_scores(spark, sf):
    pts = event_points(spark, sf)
    return isoforest.score(pts, isoforest.fit_forest(pts, "event_id", ["v", "k"], trees=200), ["v", "k"])


@query("isolation_forest")
def isolation_forest(spark, sf):
    """Scores above the contamination quantile, strongest first."""
    scored = _forest_scores(spark, sf).persist()
    share = scored.agg(outliers.contamination(F.col("known") == 1).alias("c")).first()[0]
    limit = quantile_row(scored, {"limit": ("score", 1 - share)})
    return with_params(scored, limit).where(F.col("score") > F.col("_p.limit")).select("event_id", "known", "score").orderBy(F.desc("score"), "event_id")


@query("dbscan_outliers")
def dbscan_outliers(spark, sf):
    pts = event_points(spark, sf)
    out = density.dbscan(pts, "event_id", ["v", "k"], 0.5, 10).withColumn("noise", (F.col("label") == -1).cast("int"))
    return out.agg(F.countDistinct(F.when(F.col("label") != -1, F.col("label"))).alias("clusters"), F.sum("noise").alias("noise"))


@query("anomaly_auc_table")
def anomaly_auc_table(spark, sf):
    """Area under the curve of each detector against the known outliers."""
    scored = _forest_scores(spark, sf).select("event_id", "known", F.col("score").alias("isolation_forest"), F.abs("v").alias("zscore"))
    noise = density.dbscan(event_points(spark, sf), "event_id", ["v", "k"], 0.5, 10).select("event_id", (F.col("label") == -1).cast("double").alias("dbscan"))
    long = scored.join(noise, "event_id").unpivot(["known"], ["isolation_forest", "zscore", "dbscan"], "detector", "s")
    return metrics.leaderboard(metrics.roc_auc(long, "known", "s", "detector"), "auc", "detector", ascending=False)


_PROF = """hr AS (SELECT 'all' AS series, CAST(ts AS DATE) AS day, hour(ts) AS h, avg(round(value * 100)::BIGINT) AS v FROM events GROUP BY 2, 3),
prof AS (SELECT series, day, list(v ORDER BY h) AS p FROM hr GROUP BY 1, 2 HAVING count(*) = 24)"""


def profiles(spark, sf):
    return tc.daily_profiles(table(spark, sf, "events").select(F.lit("all").alias("series"), "ts", cents("value").alias("v")), "series", "ts", "v")


@query("daily_profiles", f"WITH {_PROF} SELECT day, " + ", ".join(f"p[{i + 1}] AS h{i}" for i in range(24)) + " FROM prof")
def daily_profiles(spark, sf):
    return profiles(spark, sf).select("day", *[F.col("profile")[i].alias(f"h{i}") for i in range(24)])


@query("sample_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY ('0x' || substr(md5('0|' || o_orderkey), 1, 8))::BIGINT, o_orderkey LIMIT 200")
def sample_rows(spark, sf):
    return tc.sample_rows(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), F.col("o_orderkey"), 200)


_Z = "list_transform(p, lambda x: (x - list_avg(p)) / list_stddev_pop(p))"


@query("znorm_rows", f"WITH {_PROF}, z AS (SELECT day, {_Z} AS z FROM prof) SELECT day, " + ", ".join(f"round(z[{i + 1}], 6) AS z{i}" for i in range(24)) + " FROM z")
def znorm_rows(spark, sf):
    return profiles(spark, sf).select("day", tc.znorm(F.col("profile")).alias("z")).select("day", *[F.round(F.col("z")[i], 6).alias(f"z{i}") for i in range(24)])


@query("euclidean_vs_dtw")
def euclidean_vs_dtw(spark, sf):
    """Each day against itself two hours later, rigid, warped, and warped within a band."""
    z = profiles(spark, sf).select("day", tc.znorm(F.col("profile")).alias("z")).withColumn("s", tc.shift(F.col("z"), 2))
    a, b = F.col("z"), F.col("s")
    return z.select("day", tc.euclidean(a, b).alias("euclidean"), tc.dtw(a, b).alias("dtw"), tc.dtw(a, b, 3).alias("dtw_band"))


@query("dtw_pairs")
def dtw_pairs(spark, sf):
    z = profiles(spark, sf).select("day", tc.znorm(F.col("profile")).alias("profile"))
    return tc.dtw_pairs(tc.sample_rows(z, F.col("day"), 200), "day")


def _shape_clusters(spark, sf):
    z = profiles(spark, sf).select("day", tc.znorm(F.col("profile")).alias("profile"))
    return tc.barycentres(z, "day", 2)[0].select("day", "cluster")


@query("dtw_kmeans")
def dtw_kmeans(spark, sf):
    return _shape_clusters(spark, sf)


@query("cluster_vs_calendar", f"""WITH {_PROF}, c AS (SELECT (isodow(day) >= 6)::INTEGER AS weekend, (list_sum(list_slice(p, 1, 12)) > list_sum(list_slice(p, 13, 24)))::INTEGER AS cluster FROM prof),
g AS (SELECT weekend, cluster, count(*)::DOUBLE AS n FROM c GROUP BY 1, 2), t AS (SELECT sum(n * (n - 1) / 2) AS tg, sum(n) AS n, (SELECT sum(x * (x - 1) / 2) FROM (SELECT sum(n) AS x FROM g GROUP BY weekend)) AS ra,
(SELECT sum(x * (x - 1) / 2) FROM (SELECT sum(n) AS x FROM g GROUP BY cluster)) AS cb FROM g)
SELECT cluster, count(*) FILTER (weekend = 0) AS workday, count(*) FILTER (weekend = 1) AS weekend, (SELECT round((tg - ra * cb / (n * (n - 1) / 2)) / ((ra + cb) / 2 - ra * cb / (n * (n - 1) / 2)), 8) FROM t) AS ari FROM c GROUP BY cluster""")
def cluster_vs_calendar(spark, sf):
    """A two-way split of the days (stronger morning or evening) against weekends."""
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    days = profiles(spark, sf).select((F.weekday("day") >= 5).cast("int").alias("weekend"), (total(F.slice("profile", 1, 12)) > total(F.slice("profile", 13, 12))).cast("int").alias("cluster"))
    ari = metrics.adjusted_rand(days, "weekend", "cluster").select(F.round("ari", 8)).scalar()
    return metrics.crosstab(days, "cluster", "weekend", [0, 1]).toDF("cluster", "workday", "weekend").withColumn("ari", ari)


@query("nmf_profiles")
def nmf_profiles(spark, sf):
    """Non-negative factors of the day × hour matrix: error per rank, and groups of days by their activations."""
    cells = table(spark, sf, "events").groupBy(F.datediff(F.to_date("ts"), F.lit("2024-01-01")).alias("day"), F.hour("ts").alias("hour")).agg(F.avg("value").cast("float").alias("v")).persist()
    rows = []
    for rank in (2, 3):
        model = ALS(rank=rank, nonnegative=True, regParam=1e-6, maxIter=8, seed=0, userCol="day", itemCol="hour", ratingCol="v").fit(cells)
        rmse = model.transform(cells).agg(F.sqrt(F.avg((F.col("prediction") - F.col("v")) * (F.col("prediction") - F.col("v"))))).first()[0]
        days = model.userFactors.select("id", array_to_vector(F.col("features").cast("array<double>")).alias("features")).persist()
        sizes = KMeans(k=2, seed=0).fit(days).summary.clusterSizes
        rows.append((rank, float(rmse), int(max(sizes)), int(min(sizes))))
    return spark.createDataFrame(rows, "rank int, rmse double, larger_group int, smaller_group int")
