"""Training, evaluation and ensembles on pyspark.ml."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, functions as F

from brindle.functions.expr import stable_hash
from brindle.operators import metrics
from brindle.operators.grown_forest import GrownForest
from brindle.sources.scratch import cut_lineage


def preprocess(numeric: Sequence[str], categorical: Sequence[str] = (), scale: bool = True) -> Pipeline:
    """Median fill, one-hot of the categories seen in training (others are all zeros), standardization."""
    filled = [f"{c}_f" for c in numeric]
    stages = [Imputer(inputCols=list(numeric), outputCols=filled, strategy="median")]
    parts = list(filled)
    if categorical:
        index = [f"{c}_i" for c in categorical]
        hot = [f"{c}_h" for c in categorical]
        stages += [StringIndexer(inputCols=list(categorical), outputCols=index, handleInvalid="keep", stringOrderType="alphabetAsc"),
                   OneHotEncoder(inputCols=index, outputCols=hot, handleInvalid="keep", dropLast=True)]
        parts += hot
    stages.append(VectorAssembler(inputCols=parts, outputCol="raw_features" if scale else "features"))
    if scale:
        stages.append(StandardScaler(inputCol="raw_features", outputCol="features", withMean=True))
    return Pipeline(stages=stages)


def penalized(df: DataFrame, label: str, kind: str, alpha: float, l1_ratio: float = 0.5, weight: str | None = None) -> LinearRegression:
    """Linear regression whose penalty has the strength it has on unscaled data.

    ridge: α‖w‖² beside the sum of squares; lasso: α‖w‖₁ beside half the mean square; elastic net mixes
    both.  The solver scales the label, so the squared part is multiplied by its sd.  The rows are read once, for their
    moments; what iterates are the moments.
    """
    if weight is None:
        n, sd = df.agg(F.count(label), F.stddev_pop(label)).first()
    else:
        w, y = F.col(weight), F.col(label)
        n, mean = df.agg(F.sum(w), F.sum(w * y) / F.sum(w)).first()
        sd = math.sqrt(df.agg(F.sum(w * (y - mean) * (y - mean))).first()[0] / n)
    if kind == "ridge":
        reg, mix = alpha / n * sd, 0.0
    elif kind == "lasso":
        reg, mix = alpha, 1.0
    else:
        reg = alpha * l1_ratio + sd * alpha * (1 - l1_ratio)
        mix = alpha * l1_ratio / reg
    made = LinearRegression(labelCol=label, featuresCol="features", regParam=reg, elasticNetParam=mix, standardization=False, solver="normal", tol=1e-10, maxIter=500)
    return made if weight is None else made.setWeightCol(weight)


def _given(label: str) -> Column:
    """The label; a missing one is an error, as it is to the estimators of pyspark.ml."""
    y = F.col(label).cast("double")
    return F.when(y.isNull() | F.isnan(y), F.raise_error(F.lit("Labels MUST NOT be Null or NaN")).cast("double")).otherwise(y)


def moment_points(df: DataFrame, label: str, features: str = "features") -> DataFrame:
    """(features, label, weight): a few points with the same count, mean and covariance as the rows.

    Least squares, penalized or not, sees nothing else of its rows, so it can be fitted to the points as often as wanted.  Moments
    are summed around the mean, in two passes.
    """
    import numpy as np

    spark = df.sparkSession
    rows = df.select(F.concat(vector_to_array(features), F.array(_given(label))).alias("v"))
    first = rows.first()
    if first is None:
        raise ValueError("no rows to fit to")
    d = len(first["v"])
    n, *mean = rows.agg(F.count("*"), *[F.avg(F.col("v")[i]) for i in range(d)]).first()
    part = [F.col("v")[i] - F.lit(mean[i]) for i in range(d)]
    sums = rows.agg(*[F.avg(part[i] * part[j]) for i in range(d) for j in range(i, d)]).first()
    cov = np.zeros((d, d))
    cov[np.triu_indices(d)] = sums
    size, axes = np.linalg.eigh(np.triu(cov) + np.triu(cov, 1).T)
    # a pair of points on each axis, as far out as gives the covariance
    step = axes * np.sqrt(np.maximum(size, 0.0) * d)
    at = np.concatenate([np.array(mean) + step.T, np.array(mean) - step.T])
    made = spark.createDataFrame([(p[:-1].tolist(), float(p[-1]), n / (2 * d)) for p in at], f"{features} array<double>, {label} double, weight double")
    return made.withColumn(features, array_to_vector(features)).coalesce(1)


class CellRegression(Estimator):
    """Least squares on columns of which the last are one-hot: the rows enter as sums for each combination of categories.

    `dense` names the numbers, `cells` the indexed categories, each of which stands for a block of indicators.  Rows of a cell share their
    indicators, so their part of the normal equations follows from the cell's count, sums and products of the numbers; no row is
    spread out to all columns.  Columns are standardized and the smallest solution is taken, as categories that add up to one leave
    it open.
    """

    def __init__(self, dense: Sequence[str], cells: Sequence[str], label: str = "label") -> None:
        super().__init__()
        self.dense, self.cells, self.label = list(dense), list(cells), label

    def _fit(self, df: DataFrame) -> Model:
        import numpy as np

        p = len(self.dense) + 1
        numbers = [F.col(c).cast("double") for c in self.dense] + [_given(self.label)]
        rows = df.select(*self.cells, *[c.alias(f"_{i}") for i, c in enumerate(numbers)])
        n, *mean = rows.agg(F.count("*"), *[F.avg(f"_{i}") for i in range(p)]).first()
        if not n:
            raise ValueError("no rows to fit to")
        part = [F.col(f"_{i}") - F.lit(mean[i]) for i in range(p)]
        pairs = [(i, j) for i in range(p) for j in range(i, p)]
        sums = rows.groupBy(*self.cells).agg(F.count("*").alias("n"), *[F.sum(c).alias(f"s{i}") for i, c in enumerate(part)], *[F.sum(part[i] * part[j]).alias(f"q{i}_{j}") for i, j in pairs])
        sums = cut_lineage(sums)
        # what comes to the driver is the matrix of the normal equations
        sizes = [len(a["vals"]) if "vals" in a else a["num_vals"] for a in (df.schema[c].metadata["ml_attr"] for c in self.cells)]
        offset = np.r_[0, np.cumsum(sizes)][:-1] + p
        d = p + sum(sizes)
        gram = np.zeros((d, d))
        for (i, j), v in zip(pairs, sums.agg(*[F.sum(f"q{i}_{j}") for i, j in pairs]).first()):
            gram[i, j] = gram[j, i] = v
        for b in range(len(self.cells)):
            for r in sums.groupBy(self.cells[b]).agg(F.sum("n"), *[F.sum(f"s{i}") for i in range(p)]).collect():
                at = offset[b] + int(r[0])
                gram[at, at] = r[1]
                gram[at, :p] = gram[:p, at] = r[2:]
            for c in range(b):
                for r in sums.groupBy(self.cells[b], self.cells[c]).agg(F.sum("n")).collect():
                    gram[offset[b] + int(r[0]), offset[c] + int(r[1])] = gram[offset[c] + int(r[1]), offset[b] + int(r[0])] = r[2]
        share = np.zeros(d)
        share[p:] = np.diag(gram)[p:] / n
        gram[p:, p:] -= n * np.outer(share[p:], share[p:])  # the numbers are centred already
        y = p - 1
        use = np.r_[0:y, p:d]
        sd = np.sqrt(np.maximum(np.diag(gram)[use], 0.0) / n)
        inverse = np.divide(1.0, sd, out=np.zeros_like(sd), where=sd > 0)
        scaled = gram[np.ix_(use, use)] * np.outer(inverse, inverse) / n
        coefficients = np.linalg.pinv(scaled, rcond=1e-10, hermitian=True) @ (gram[use, y] * inverse / n) * inverse
        centre = np.r_[mean[:y], share[p:]]
        return CellRegressionModel(coefficients.tolist(), float(mean[y] - centre @ coefficients), self.dense, list(zip(self.cells, sizes)))


class CellRegressionModel(Model):
    """Adds `prediction`: the intercept, the numbers times their coefficients and one coefficient for each category."""

    def __init__(self, coefficients: list[float], intercept: float, dense: list[str], cells: list[tuple[str, int]]) -> None:
        super().__init__()
        self.coefficients, self.intercept, self.dense, self.cells = coefficients, intercept, dense, cells

    def _transform(self, df: DataFrame) -> DataFrame:
        out, at = F.lit(self.intercept), len(self.dense)
        for c, b in zip(self.dense, self.coefficients):
            out = out + F.col(c) * F.lit(b)
        for c, size in self.cells:
            out = out + F.coalesce(F.try_element_at(F.lit(self.coefficients[at : at + size]), F.col(c).cast("int") + 1), F.lit(0.0))
            at += size
        return df.withColumn("prediction", out)


FIT_ROWS = 500_000  # rows of a partition where a model is fitted by many short passes


def random_folds(df: DataFrame, k: int, seed: int) -> DataFrame:
    """Adds `cv_fold`, the folds CrossValidator would draw with that seed, as a column that no later change of partitions moves."""
    u = F.col("_u")
    fold = F.coalesce(*[F.when((u >= i * (1.0 / k)) & (u < (i + 1) * (1.0 / k)), i) for i in range(k)], F.lit(k - 1))
    return df.withColumn("_u", F.rand(seed)).withColumn("cv_fold", fold.cast("int")).drop("_u")


def few_parts(df: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """The rows in as few partitions as hold `rows` each, four at least: up to four, a sum over them needs no second stage."""
    return df.coalesce(max(4, -(-df.count() // rows)))


def cross_validate(df: DataFrame, fold: str, k: int, fit: Callable[[DataFrame], Model], score: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(fold, metrics…): each fold scored by a model that never saw it."""
    out = None
    for i in range(k):
        scored = score(fit(df.where(F.col(fold) != i)).transform(df.where(F.col(fold) == i))).withColumn("fold", F.lit(i))
        out = scored if out is None else out.unionByName(scored)
    return out


def mean_sd(scores: DataFrame, columns: Sequence[str]) -> DataFrame:
    return scores.agg(*[e for c in columns for e in (F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_sd"))])


def coefficients(spark, models: dict[str, Model], features: Sequence[str]) -> DataFrame:
    """(feature, model, coefficient, magnitude rank) of several linear models."""
    rows = [(f, name, float(c)) for name, m in models.items() for f, c in zip(features, m.coefficients)]
    return spark.createDataFrame(rows, "feature string, model string, coefficient double")


def importances(spark, model: Model, features: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(f, float(v)) for f, v in zip(features, model.featureImportances.toArray())], "feature string, importance double").orderBy(F.desc("importance"), "feature")


def probability(column: str = "probability") -> Column:
    return vector_to_array(column)[1]


def evaluate_classifier(scored: DataFrame, label: str, name: str) -> DataFrame:
    """(model, n, accuracy, f1, auc) of rows with `p`, the probability of class 1.  Models are applied once, the metrics read narrow rows."""
    cut = cut_lineage(scored.select(F.lit(name).alias("model"), F.col(label).cast("int").alias("_y"), "p", (F.col("p") > 0.5).cast("int").alias("_hat")))
    base = metrics.classification_metrics(cut, "_y", "_hat", ["model"])
    return base.select("model", (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("n"), "accuracy", "f1").join(metrics.roc_auc(cut, "_y", "p", "model"), "model")


def poisson_steps() -> list[float]:
    """Cumulative probabilities of 0, 1, … draws at rate 1, until what is left lies below one step of a 32-bit hash."""
    steps, term, total = [], math.exp(-1.0), 0.0
    while 1.0 - total > 2.0**-32:
        total += term
        steps.append(total)
        term /= len(steps)
    return steps


def bootstrap_weight(key: str, tree: int) -> Column:
    """How often a row is drawn for a tree: a Poisson(1) count from the row key's hash."""
    u = stable_hash(key, seed=f"tree{tree}") / float(1 << 32)
    steps = F.lit(poisson_steps())
    # the hash is an element of its own, else it is worked out again for each step
    return F.transform(F.array(u), lambda x: F.size(F.filter(steps, lambda p: x >= p)))[0].cast("double")


def bagged_trees(df: DataFrame, key: str, label: str, n_trees: int) -> tuple[Model, DataFrame]:
    """Full trees on bootstrap weights, and (key, label, p) where p averages only the trees a row was left out of."""
    model = GrownForest(n_trees, "all", key=[key], label=label).fit(df)
    return model, model.votes(df, left_out=True).select(key, label, "p")


def score_all(models: dict[str, Model], df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Columns `keep` and one probability column per model; models are applied one after another, no joins."""
    out = df
    for name, model in models.items():
        scored = model.transform(out)
        p = probability() if "probability" in scored.columns else F.lit(1.0) / (1.0 + F.exp(-vector_to_array("rawPrediction")[1]))
        out = scored.withColumn(f"p_{name}", p).drop(*[c for c in ("rawPrediction", "probability", "prediction") if c in scored.columns])
    return out.select(*keep, *[f"p_{n}" for n in models])


def vote_hard(scored: DataFrame, names: Sequence[str]) -> Column:
    """1 when more than half of the models say so."""
    return (sum(((F.col(f"p_{n}") > 0.5).cast("int") for n in names), F.lit(0)) * 2 > len(names)).cast("double")


def vote_soft(names: Sequence[str], weights: Sequence[float] | None = None) -> Column:
    weights = list(weights or [1.0] * len(names))
    return sum((F.col(f"p_{n}") * w for n, w in zip(names, weights)), F.lit(0.0)) / sum(weights)


def as_features(names: Sequence[str]) -> Column:
    return array_to_vector(F.array(*[F.col(f"p_{n}") for n in names]))


def out_of_fold(df: DataFrame, bases: dict[str, Callable[[DataFrame], Model]], fold: str, k: int, keep: Sequence[str]) -> DataFrame:
    """Base probabilities of every row from models trained without its fold."""
    out = None
    for i in range(k):
        train = df.where(F.col(fold) != i)
        part = score_all({n: fit(train) for n, fit in bases.items()}, df.where(F.col(fold) == i), keep)
        out = part if out is None else out.unionByName(part)
    return out


def stack(df: DataFrame, bases: dict[str, Callable[[DataFrame], Model]], label: str, fold: str, k: int, keep: Sequence[str]) -> tuple[dict[str, Model], Model]:
    """(bases refitted on all rows, meta model trained on out-of-fold probabilities)."""
    oof = out_of_fold(df, bases, fold, k, keep).select("*", as_features(list(bases)).alias("meta"))
    meta = LogisticRegression(featuresCol="meta", labelCol=label).fit(oof)
    return {n: fit(df) for n, fit in bases.items()}, meta


def random_fourier(features: Column, dims: int, out: int, gamma: float, seed: int = 0) -> Column:
    """√(2/out)·cos(w·x + b): inner products of these columns approximate a Gaussian kernel."""
    import numpy as np

    rng = np.random.default_rng(seed)
    w = rng.normal(scale=(2 * gamma) ** 0.5, size=(out, dims))
    b = rng.uniform(0, 2 * np.pi, size=out)
    x = vector_to_array(features)
    rows = F.lit(w.tolist())
    shift = F.lit(b.tolist())
    project = F.zip_with(rows, shift, lambda r, s: F.cos(F.aggregate(F.zip_with(r, x, lambda a, c: a * c), s, lambda acc, v: acc + v)) * float((2.0 / out) ** 0.5))
    return array_to_vector(project)


def kernel_svm(df: DataFrame, label: str, dims: int, gamma: float, c: float, out: int = 64) -> tuple[Model, Callable[[DataFrame], DataFrame]]:
    expand = lambda d: d.withColumn("rff", random_fourier(F.col("features"), dims, out, gamma))
    rows = expand(df).persist()
    model = LinearSVC(featuresCol="rff", labelCol=label, regParam=1.0 / (c * rows.count()), maxIter=30).fit(rows)
    rows.unpersist()
    return model, expand


def save_and_reload(model: PipelineModel, path: str) -> PipelineModel:
    model.write().overwrite().save(path)
    return PipelineModel.load(path)
