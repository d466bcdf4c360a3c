"""Models, ensembles and their evaluation."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression, MultilayerPerceptronClassifier, RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import PolynomialExpansion, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from brindle.operators import featurestore as fs, impute, metrics, models
from brindle.operators.forest import CellForest
from brindle.operators.grown_forest import GrownForest
from brindle.operators.splits import in_test, kfold
from brindle.plans import base, q11_featurestore as q11
from brindle.plans.registry import query
from brindle.sources.files import table
from brindle.sources.scratch import bounded, cut_lineage, scratch_path

NUM = ["l_quantity", "l_discount", "l_tax", "p_size", "p_retailprice"]
DOC_NUM = ["n_chars", "n_words", "distinct_share", "mean_word", "upper_share", "digit_share", "lines"]


def regression_data(spark, sf, categorical=()):
    """(train, test) of line items with the log price as label, features standardized on train.

    Items meet their parts once: every later pass starts from the narrow rows, in partitions of bounded size.
    """
    df = base.sales(spark, sf).select("row_id", *NUM, *categorical, F.log1p("l_extendedprice").alias("label"))
    df = bounded(cut_lineage(kfold(df, ["row_id"], 5)))
    train, test = df.where(~in_test(["row_id"], 0.25, seed=1)), df.where(in_test(["row_id"], 0.25, seed=1))
    prep = models.preprocess(NUM, categorical).fit(train)
    keep = ["row_id", "label", "features", "fold"]
    return prep.transform(train).select(*keep).persist(), prep.transform(test).select(*keep)


def document_features(docs):
    """Each text described by DOC_NUM; its words are split once, and text leaves the row here."""
    split = docs.select("doc_id", "lang", "text", F.array_remove(F.split("text", r"\s+"), "").alias("words"))
    chars = F.greatest(F.length("text"), F.lit(1)).cast("double")
    n = F.greatest(F.size("words"), F.lit(1)).cast("double")
    # runs of other characters go in one replacement each
    return split.select(
        "doc_id", "lang", F.length("text").cast("double").alias("n_chars"), n.alias("n_words"), (F.size(F.array_distinct("words")) / n).alias("distinct_share"), (chars / n).alias("mean_word"),
        (F.length(F.regexp_replace("text", r"[^\p{Lu}]+", "")) / chars).alias("upper_share"), (F.length(F.regexp_replace("text", r"[^0-9]+", "")) / chars).alias("digit_share"),
        (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("double").alias("lines"))


def document_data(spark, sf):
    """(train, test) of labelled documents described by their whole text; label is quality.

    The texts are read once: every later pass starts from the narrow rows.
    """
    docs = document_features(table(spark, sf, "documents"))
    df = cut_lineage(kfold(docs.join(table(spark, sf, "labels"), "doc_id").withColumn("label", F.col("quality").cast("double")), ["doc_id"], 5))
    train, test = df.where(~in_test(["doc_id"], 0.25)), df.where(in_test(["doc_id"], 0.25))
    prep = models.preprocess(DOC_NUM, ["lang"]).fit(train)
    keep = ["doc_id", "label", "features", "fold"]
    return prep.transform(train).select(*keep).persist(), prep.transform(test).select(*keep).persist()


def _regression_report(spark, sf, make, name):
    """Cross-validated RMSE, test RMSE and R², and how many coefficients are not zero."""
    train, test = regression_data(spark, sf)
    estimator = make(train)
    fit = estimator.fit
    score = lambda d: metrics.regression_metrics(d, "label", "prediction").select("rmse")
    cv = models.mean_sd(models.cross_validate(train, "fold", 5, fit, score), ["rmse"])
    model = fit(train)
    kept = sum(1 for c in model.coefficients if abs(c) > 1e-10)
    out = metrics.regression_metrics(model.transform(test), "label", "prediction").select(F.lit(name).alias("model"), "rmse", "r2", F.lit(kept).alias("nonzero"))
    return out.select("*", cv.select(F.struct("rmse_mean", "rmse_sd")).scalar().alias("_cv")).select("model", "rmse", "r2", "nonzero", "_cv.*")


@query("linear_regression")
def linear_regression(spark, sf):
    return _regression_report(spark, sf, lambda t: LinearRegression(solver="normal"), "linear")


@query("ridge")
def ridge(spark, sf):
    return _regression_report(spark, sf, lambda t: models.penalized(t, "label", "ridge", 1.0), "ridge")


@query("lasso")
def lasso(spark, sf):
    return _regression_report(spark, sf, lambda t: models.penalized(t, "label", "lasso", 0.01), "lasso")


@query("elastic_net")
def elastic_net(spark, sf):
    return _regression_report(spark, sf, lambda t: models.penalized(t, "label", "elastic_net", 0.01, 0.5), "elastic_net")


@query("cross_val_score")
def cross_val_score(spark, sf):
    train, _ = regression_data(spark, sf)
    score = lambda d: metrics.regression_metrics(d, "label", "prediction").select("rmse", "mae", "r2")
    return models.cross_validate(train, "fold", 5, LinearRegression(solver="normal").fit, score)


@query("regularization_path")
def regularization_path(spark, sf):
    """Twenty fits on one pass: the rows enter through their moments."""
    train, _ = regression_data(spark, sf)
    points = models.moment_points(train, "label")
    rows = []
    for kind, low, high in (("ridge", -2, 4), ("lasso", -3, 1)):
        alphas = [10 ** (low + (high - low) * i / 9) for i in range(10)]
        maps = [models.penalized(points, "label", kind, a, weight="weight") for a in alphas[:1]]
        scale = maps[0].getRegParam() / alphas[0]
        grid = [{maps[0].regParam: scale * a} for a in alphas]
        for (a, m) in zip(alphas, maps[0].fit(points, grid)):
            rows += [(kind, float(a), f, float(c)) for f, c in zip(NUM, m.coefficients)]
    return spark.createDataFrame(rows, "kind string, alpha double, feature string, coefficient double")


@query("coefficient_table")
def coefficient_table(spark, sf):
    train, _ = regression_data(spark, sf)
    fits = {k: models.penalized(train, "label", k, a).fit(train) for k, a in (("ridge", 1.0), ("lasso", 0.01), ("elastic_net", 0.01))}
    wide = models.coefficients(spark, fits, NUM).groupBy("feature").pivot("model", list(fits)).agg(F.first("coefficient"))
    return wide.orderBy(F.desc(F.abs("ridge")), "feature")


@query("rfe_select")
def rfe_select(spark, sf):
    """The weakest standardized coefficient leaves, until three are left; kept features rank 1."""
    train, _ = regression_data(spark, sf)
    from pyspark.ml.feature import VectorSlicer

    left, rank = list(range(len(NUM))), {}
    while True:
        sliced = VectorSlicer(inputCol="features", outputCol="part", indices=left).transform(train)
        coefs = LinearRegression(featuresCol="part", solver="normal").fit(sliced).coefficients
        if len(left) == 3:
            break
        worst = left[min(range(len(left)), key=lambda i: abs(coefs[i]))]
        rank[worst] = len(left) - 2
        left.remove(worst)
    return spark.createDataFrame([(NUM[i], rank.get(i, 1), i in left) for i in range(len(NUM))], "feature string, rank int, kept boolean")


@query("lasso_select")
def lasso_select(spark, sf):
    train, _ = regression_data(spark, sf)
    model = models.penalized(train, "label", "lasso", 0.1).fit(train)
    return spark.createDataFrame([(f, float(c), bool(abs(c) > 1e-10)) for f, c in zip(NUM, model.coefficients)], "feature string, coefficient double, kept boolean")


@query("tree_importance_rank")
def tree_importance_rank(spark, sf):
    train, _ = regression_data(spark, sf)
    return models.importances(spark, CellForest(200, 6, seed=0, key=["row_id"]).fit(train), NUM)


@query("fit_transform_pipeline")
def fit_transform_pipeline(spark, sf):
    """Preparation and model refitted inside every fold; a category new to a fold is all zeros."""
    df = base.sales(spark, sf).select("row_id", *NUM, "p_brand", "p_type", F.log1p("l_extendedprice").alias("label"))
    df = cut_lineage(kfold(df, ["row_id"], 5))
    pipe = Pipeline(stages=[models.preprocess(NUM, ["p_brand", "p_type"], scale=False), models.CellRegression([f"{c}_f" for c in NUM], ["p_brand_i", "p_type_i"])])
    score = lambda d: metrics.regression_metrics(d, "label", "prediction").select("rmse", "r2")
    return models.mean_sd(models.cross_validate(df, "fold", 5, pipe.fit, score), ["rmse", "r2"])


def _classifier_report(spark, sf, estimator, name):
    train, test = document_data(spark, sf)
    model = estimator.fit(train)
    return models.evaluate_classifier(models.score_all({"m": model}, test, ["label"]).withColumnRenamed("p_m", "p"), "label", name)


@query("logistic_regression")
def logistic_regression(spark, sf):
    return _classifier_report(spark, sf, LogisticRegression(maxIter=100), "logistic")


@query("decision_tree")
def decision_tree(spark, sf):
    return _classifier_report(spark, sf, DecisionTreeClassifier(maxDepth=8, seed=0), "tree")


@query("random_forest")
def random_forest(spark, sf):
    """The classifier of full trees, and the regressor on the log target."""
    found = _classifier_report(spark, sf, GrownForest(300, "sqrt", key=["doc_id"]), "forest")
    train, test = regression_data(spark, sf)
    scored = CellForest(300, 10, seed=0, key=["row_id"]).fit(train).transform(test)
    errors = metrics.regression_metrics(scored, "label", "prediction").select(F.lit("forest regressor").alias("model"), "*")
    return found.unionByName(errors, allowMissingColumns=True)


@query("gradient_boosting")
def gradient_boosting(spark, sf):
    return _classifier_report(spark, sf, GBTClassifier(maxIter=100, maxDepth=4, stepSize=0.1, subsamplingRate=0.9, seed=0), "boosting")


@query("gradient_boosting_regressor")
def gradient_boosting_regressor(spark, sf):
    train, test = regression_data(spark, sf)
    model = GBTRegressor(maxIter=10, maxDepth=5, stepSize=0.1, seed=0).fit(train)
    return metrics.regression_metrics(model.transform(test), "label", "prediction")


@query("linear_svm")
def linear_svm(spark, sf):
    return _classifier_report(spark, sf, LinearSVC(maxIter=50, regParam=0.01), "linear_svm")


@query("kernel_svm")
def kernel_svm(spark, sf):
    """Sensitivity to C and gamma of the approximated Gaussian kernel, and the polynomial kernel's degree 3."""
    train, test = document_data(spark, sf)
    dims = train.first()["features"].size
    out = None
    for c in (0.1, 10.0):
        for gamma in (0.01, 0.1):
            model, expand = models.kernel_svm(train, "label", dims, gamma, c)
            scored = models.score_all({"m": model}, expand(test), ["label"]).withColumnRenamed("p_m", "p")
            part = models.evaluate_classifier(scored, "label", f"rbf C={c} gamma={gamma}")
            out = part if out is None else out.unionByName(part)
    poly = Pipeline(stages=[PolynomialExpansion(degree=3, inputCol="features", outputCol="poly"), LinearSVC(featuresCol="poly", maxIter=20, regParam=0.1)]).fit(train)
    scored = models.score_all({"m": poly}, test, ["label"]).withColumnRenamed("p_m", "p")
    return out.unionByName(models.evaluate_classifier(scored, "label", "poly degree=3"))


@query("mlp_classifier")
def mlp_classifier(spark, sf):
    train, test = document_data(spark, sf)
    dims = train.first()["features"].size
    model = MultilayerPerceptronClassifier(layers=[dims, 64, 32, 2], maxIter=100, seed=0).fit(train)
    return models.evaluate_classifier(models.score_all({"m": model}, test, ["label"]).withColumnRenamed("p_m", "p"), "label", "mlp")


BASES = {
    "logistic": lambda d: LogisticRegression(maxIter=50).fit(d),
    "tree": lambda d: DecisionTreeClassifier(maxDepth=5, seed=0).fit(d),
    "forest": lambda d: RandomForestClassifier(numTrees=300, seed=0).fit(d),
}


@query("bagged_trees")
def bagged_trees(spark, sf):
    train, _ = document_data(spark, sf)
    _, oob = models.bagged_trees(train, "doc_id", "label", 300)
    return models.evaluate_classifier(oob.where("p IS NOT NULL"), "label", "bagged, out of bag")


@query("voting_hard")
def voting_hard(spark, sf):
    train, test = document_data(spark, sf)
    scored = models.score_all({n: f(train) for n, f in BASES.items()}, test, ["label"])
    return models.evaluate_classifier(scored.withColumn("p", models.vote_hard(scored, list(BASES))), "label", "voting_hard")


@query("voting_soft")
def voting_soft(spark, sf):
    train, test = document_data(spark, sf)
    scored = models.score_all({n: f(train) for n, f in BASES.items()}, test, ["label"]).persist()
    plain = models.evaluate_classifier(scored.withColumn("p", models.vote_soft(list(BASES))), "label", "soft")
    return plain.unionByName(models.evaluate_classifier(scored.withColumn("p", models.vote_soft(list(BASES), [1, 2, 2])), "label", "soft 1,2,2"))


def _meta_report(bases, meta, test, name):
    scored = models.score_all(bases, test, ["label"]).withColumn("meta", models.as_features(list(bases)))
    out = meta.transform(scored).withColumn("p", models.probability())
    return models.evaluate_classifier(out, "label", name)


@query("stacking_oof")
def stacking_oof(spark, sf):
    train, test = document_data(spark, sf)
    bases, meta = models.stack(train, BASES, "label", "fold", 5, ["doc_id", "label"])
    return _meta_report(bases, meta, test, "stacking")


@query("blending")
def blending(spark, sf):
    """Bases on one part of the training rows, the meta model on the other."""
    train, test = document_data(spark, sf)
    part_b = in_test(["doc_id"], 0.3, seed=5)
    bases = {n: f(train.where(~part_b)) for n, f in BASES.items()}
    held = models.score_all(bases, train.where(part_b), ["label"]).withColumn("meta", models.as_features(list(BASES)))
    return _meta_report(bases, LogisticRegression(featuresCol="meta").fit(held), test, "blending")


@query("grid_search_cv")
def grid_search_cv(spark, sf):
    """Sixteen settings by five folds; a pass over a fold is one stage of few tasks, as there are some thousands of passes."""
    train, _ = document_data(spark, sf)
    train = models.few_parts(models.random_folds(train, 5, seed=0))
    lr = LogisticRegression(maxIter=30)
    grid = ParamGridBuilder().addGrid(lr.regParam, [0.0001, 0.001, 0.01, 0.1]).addGrid(lr.elasticNetParam, [0.0, 0.33, 0.67, 1.0]).build()
    cv = CrossValidator(estimator=lr, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(), numFolds=5, foldCol="cv_fold", parallelism=8).fit(train)
    rows = [(float(p[lr.regParam]), float(p[lr.elasticNetParam]), float(s)) for p, s in zip(grid, cv.avgMetrics)]
    best = max(r[2] for r in rows)
    return spark.createDataFrame([(a, b, s, s == best) for a, b, s in rows], "reg_param double, elastic_net double, auc double, best boolean")


@query("batch_serve_model", f"WITH {base.SALES} SELECT count(*) AS n, 0.0::DOUBLE AS max_difference FROM sales")
def batch_serve_model(spark, sf):
    """A saved and reloaded pipeline must predict what the fitted one does."""
    df = base.sales(spark, sf).select("row_id", *NUM, "p_brand", F.log1p("l_extendedprice").alias("label"))
    model = Pipeline(stages=[models.preprocess(NUM, ["p_brand"]), LinearRegression(solver="normal")]).fit(df.where(~in_test(["row_id"], 0.25)))
    served = models.save_and_reload(model, scratch_path(spark, "model"))
    mine = model.transform(df).withColumnRenamed("prediction", "p").select("row_id", *NUM, "p_brand", "label", "p")
    return served.transform(mine).agg(F.count("*").alias("n"), F.max(F.abs(F.col("p") - F.col("prediction"))).alias("max_difference"))


TRAINING_FEATURES = ("clicks", "purchases", "conversion_rate")


def training_rows(joined, test, columns=TRAINING_FEATURES):
    """Every request with its features; a missing one becomes the median of the training part and is flagged.

    A request without a label has nothing to learn from or to compare with; those alone are left out.
    """
    rows = joined.where("label IS NOT NULL").withColumns({c: F.col(c).cast("double") for c in columns})
    rows = cut_lineage(rows.select("event_id", "label", *columns))
    filled = impute.apply_fill(rows, impute.fit_median(rows.where(~test), list(columns)), list(columns), indicator=True)
    # a feature that no training row has stays without a median
    return filled.fillna(0.0, list(columns))


@query("training_set_end_to_end")
def training_set_end_to_end(spark, sf):
    """Entity frame → point-in-time features → label → split → fill by the training part → model → metrics over all requests."""
    events = table(spark, sf, "events")
    frame = events.where("event_type = 'purchase'").select("event_id", "user_id", F.col("ts").alias("event_timestamp"), "value")
    joined = fs.historical_features(frame.drop("value"), q11.history(spark, sf), q11.USER_STATS)
    joined = joined.join(frame.select("event_id", F.log1p("value").alias("label")), "event_id")
    cols = [*TRAINING_FEATURES, *[f"{c}_missing" for c in TRAINING_FEATURES]]
    data = VectorAssembler(inputCols=cols, outputCol="features").transform(training_rows(joined, in_test(["event_id"], 0.2)))
    model = CellForest(300, 10, seed=42, key=["event_id"]).fit(data.where(~in_test(["event_id"], 0.2)))
    return metrics.regression_metrics(model.transform(data.where(in_test(["event_id"], 0.2))), "label", "prediction")
