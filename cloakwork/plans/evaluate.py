"""Cross-validation, grid search, sweeps and utility studies.

Models are pairs of functions.  A model's ``fit`` takes training rows and returns a
function that adds a ``prediction`` column.  Scores are long rows
(variant, model, fold, part, metric, value); the driver only loops over settings.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import product

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cloakwork.operators import balance, forest, metrics, nearest, select
from cloakwork.operators.encode import Mapping, Steps
from cloakwork.operators.folds import stratified_kfold
from cloakwork.operators.profile import fold_summary
from cloakwork.operators.tree import fit_forest
from cloakwork.roles import numeric_columns
from cloakwork.session import materialize

# fixed values: the tuning grids of the three classifiers and of the forest sweep
RANDOM_FOREST_GRID = {
    "n_estimators": [50, 200, 300],
    "max_depth": [None, 15, 30],
    "min_samples_split": [2, 10, 0.01],
    "min_samples_leaf": [1, 5, 30],
}
KNN_GRID = {
    "k": [3, 5, 7, 9, 11, 15, 21],
    "weights": ["uniform", "distance"],
    "metric": ["euclidean", "manhattan", "minkowski"],
    "p": [1, 2],
}
LOGISTIC_GRID = {
    "solver": ["lbfgs", "liblinear"],
    "tol": [1e-4, 1e-3, 1e-1],
    "c": [0.001, 0.1, 1, 100, 1000],
    "max_iter": [100, 1000, 5000],
}
MOST_CLASSES = 1000
FORESTS = 3  # fitted side by side
SWEEP_DEFAULTS = {"trees": 100, "max_depth": None, "min_split": 2}
SWEEP_VALUES = {"trees": [150, 80, 50], "max_depth": [50, 30, 20], "min_split": [15, 10, 5]}


@dataclass(frozen=True)
class Problem:
    """A table with a key, a label and optionally a fixed feature list."""

    df: DataFrame
    key: str
    label: str

    def features(self, df: DataFrame) -> list[str]:
        skip = {self.key, self.label, "fold", "part"}
        return [c for c in numeric_columns(df) if c not in skip]


def _assembled(df: DataFrame, features: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol="_x", handleInvalid="error").transform(df)


def _classifier(make: Callable) -> Callable:
    """Spark ML classifier over any label type; predictions come back as label texts."""

    def fit(problem: Problem, train: DataFrame):
        features = problem.features(train)
        found = train.select(F.col(problem.label).cast("string")).distinct().limit(MOST_CLASSES + 1).collect()
        if len(found) > MOST_CLASSES:
            raise ValueError(f"{problem.label} has more than {MOST_CLASSES} classes")
        names = sorted(r[0] for r in found)
        index = F.array_position(F.array(*[F.lit(v) for v in names]), F.col(problem.label).cast("string")) - 1
        data = _assembled(train, features).select("_x", index.cast("double").alias("_y"))
        model = make(data).fit(data)
        text = F.element_at(F.array(*[F.lit(v) for v in names]), F.col("_p").cast("int") + 1)

        def predict(df: DataFrame) -> DataFrame:
            model.setPredictionCol("_p")
            out = model.transform(_assembled(df, features)).withColumn("prediction", text)
            return out.select(*df.columns, "prediction")

        predict.steps = getattr(model.summary, "totalIterations", 0) if model.hasSummary else 0
        return predict

    return fit


def random_forest(
    n_estimators: int = 100, max_depth: int | None = None, max_features: int | float | str | None = "sqrt", seed: int = 42,
    min_samples_leaf: float = 1, min_samples_split: float = 2,
) -> Callable:
    """The forest of ``operators.forest`` on gini gain; least sizes are counts, or shares of the training rows below 1."""

    def fit(problem: Problem, train: DataFrame):
        model = forest.fit(
            train, problem.key, problem.features(train), problem.label, "class", n_estimators, max_depth,
            min_samples_split, min_samples_leaf, max_features=max_features, seed=seed,
        )
        return model.predict

    return fit


def library_forest(n_estimators: int = 100, max_depth: int = 5, max_features: str = "sqrt", seed: int = 42, min_samples_leaf: int = 1) -> Callable:
    """Spark ML forest, on approximate splits and to a depth of 30 at most."""
    make = lambda data: RandomForestClassifier(
        featuresCol="_x", labelCol="_y", numTrees=n_estimators, maxDepth=max_depth,
        featureSubsetStrategy=max_features, minInstancesPerNode=min_samples_leaf, seed=seed,
    )
    return _classifier(make)


def logistic_regression(c: float = 1.0, max_iter: int = 1000, tol: float = 1e-4, solver: str = "lbfgs") -> Callable:
    """L2 penalty of strength 1/C on the summed loss, unscaled features, by limited-memory quasi-Newton steps.

    Another solver minimises another function (its intercept is penalised, too) and is refused.
    """
    if solver != "lbfgs":
        raise ValueError(f"no solver {solver}: choose lbfgs")
    make = lambda data: LogisticRegression(
        featuresCol="_x", labelCol="_y", maxIter=max_iter, tol=tol, elasticNetParam=0.0, standardization=False, regParam=1.0 / (c * data.count())
    )
    return _classifier(make)


def knn(k: int = 5, weights: str = "uniform", p: float = 2.0, metric: str = "minkowski") -> Callable:
    """k nearest neighbours; ``p`` only matters for the minkowski metric."""
    p = {"euclidean": 2.0, "manhattan": 1.0}.get(metric, p)

    def fit(problem: Problem, train: DataFrame):
        features = problem.features(train)
        points = nearest.vectorize(train, problem.key, features, name="did")
        labels = train.select(F.col(problem.key).alias("did"), F.col(problem.label).cast("string").alias("label"))

        def predict(df: DataFrame) -> DataFrame:
            votes = nearest.knn_classify(points, nearest.vectorize(df, problem.key, features), labels, k, weights, p)
            return df.join(votes.withColumnRenamed("qid", problem.key), problem.key)

        return predict

    return fit


def _regressor(make: Callable) -> Callable:
    def fit(problem: Problem, train: DataFrame):
        features = problem.features(train)
        data = _assembled(train, features).select("_x", F.col(problem.label).cast("double").alias("_y"))
        model = make().fit(data)

        def predict(df: DataFrame) -> DataFrame:
            model.setPredictionCol("prediction")
            return model.transform(_assembled(df, features)).select(*df.columns, "prediction")

        return predict

    return fit


def gradient_boosting(trees: int = 100, depth: int = 3, rate: float = 0.1, seed: int = 42) -> Callable:
    return _regressor(lambda: GBTRegressor(featuresCol="_x", labelCol="_y", maxIter=trees, maxDepth=depth, stepSize=rate, seed=seed))


def forest_regression(trees: int = 100, depth: int = 10, seed: int = 42) -> Callable:
    return _regressor(
        lambda: RandomForestRegressor(featuresCol="_x", labelCol="_y", numTrees=trees, maxDepth=depth, featureSubsetStrategy="all", seed=seed)
    )


def own_forest_regression(trees: int = 100, depth: int | None = None, min_split: float = 2, seed: int = 42) -> Callable:
    """The forest of ``operators.forest`` on variance gain."""

    def fit(problem: Problem, train: DataFrame):
        model = forest.fit(train, problem.key, problem.features(train), problem.label, "number", trees, depth, min_split, seed=seed)
        return model.predict

    return fit


def stump() -> Callable:
    """A classification tree of one split, on all rows."""

    def fit(problem: Problem, train: DataFrame):
        return forest.fit(train, problem.key, problem.features(train), problem.label, trees=1, max_depth=1, bootstrap=False).predict

    return fit


def exact_forest(**options) -> Callable:
    """The exact-split forest of ``operators.tree``."""

    def fit(problem: Problem, train: DataFrame):
        model = fit_forest(train, problem.key, problem.features(train), problem.label, **options)
        return model.predict

    return fit


# --- steps that need the problem's roles ------------------------------------------------


@dataclass(frozen=True)
class _Balanced:
    problem: Problem
    k: int
    seed: object

    def apply(self, train: DataFrame) -> DataFrame:
        p = self.problem
        features = p.features(train)
        points = train.select(F.col(p.key).alias("qid"), F.array(*[F.col(f).cast("double") for f in features]).alias("v"), p.label)
        made = balance.smote(points, p.label, self.k, self.seed)
        key = F.when(F.col("copy") == 0, F.col("qid")).otherwise(F.xxhash64("qid", "copy"))
        return made.select(key.alias(p.key), *[F.col("v")[i].alias(f) for i, f in enumerate(features)], p.label)


def balanced(problem: Problem, k: int = 5, seed: object = 42) -> Callable:
    """Resampling step for numeric training rows; list its position in ``Steps.train_only``."""
    return lambda df: _Balanced(problem, k, seed)


def k_best(problem: Problem, k: int = 30) -> Callable:
    """Keep the k features with the largest ANOVA F on the training rows."""

    def make(df: DataFrame):
        features = problem.features(df)
        ranked = select.best(select.anova_f(select.melt(df, features, [problem.label]), problem.label), "f_value", k)
        keep = [r["column"] for r in ranked.collect()]  # k names
        return Mapping(lambda d: d.select(*[c for c in d.columns if c not in features or c in keep]))

    return make


def without(columns: list[str]) -> Callable:
    return lambda df: Mapping(lambda d: d.drop(*columns))


def score(problem: Problem, predicted: DataFrame, kind: str) -> DataFrame:
    if kind == "class":
        text = predicted.select(F.col(problem.label).cast("string").alias("label"), "prediction")
        return metrics.long_scores(metrics.classification_metrics(text, "label", "prediction"), [], metrics.CLASSIFICATION)
    wide = metrics.regression_metrics(predicted, problem.label, "prediction")
    out = metrics.long_scores(wide, [], ["mse", "rmse", "mae", "r2"])
    middle = metrics.median_absolute_error(predicted, problem.label, "prediction")
    return out.unionByName(metrics.long_scores(middle, [], ["median_abs_error"]))


def prepared(train: DataFrame, valid: DataFrame, steps: Steps | None) -> tuple[DataFrame, DataFrame]:
    """Both parts through transformers that are fitted on the training rows only; written tables."""
    if steps is not None:
        fitted, train = steps.fit(train)
        valid = fitted.apply(valid)
    return materialize(train), materialize(valid)


def fit_score(
    problem: Problem, train: DataFrame, valid: DataFrame, model: Callable, steps: Steps | None = None,
    kind: str = "class", with_train: bool = False,
) -> tuple[DataFrame, float]:
    """Fit transformers and model on the training rows only, time the fit, score the rest."""
    return _fit_prepared(problem, *prepared(train, valid, steps), model, kind, with_train)


def _fit_prepared(problem: Problem, train: DataFrame, valid: DataFrame, model: Callable, kind: str, with_train: bool) -> tuple[DataFrame, float]:
    start = time.time()
    predict = model(problem, train)
    seconds = time.time() - start
    judged = lambda part: materialize(predict(part).select(problem.label, "prediction"))  # every metric reads it
    out = score(problem, judged(valid), kind).withColumn("part", F.lit("valid"))
    if with_train:
        out = out.unionByName(score(problem, judged(train), kind).withColumn("part", F.lit("train")))
    return out, seconds


def cross_validate(
    problem: Problem, models: dict[str, Callable], folds: DataFrame, variant: str = "plain",
    steps: Callable[[], Steps] | None = None, kind: str = "class", with_train: bool = False, parallelism: int = 4,
) -> DataFrame:
    """Scores per (variant, model, fold).  ``folds`` is the table with its ``fold`` column.

    The steps of a fold are fitted once, for all models.
    """
    folds = materialize(folds)
    numbers = sorted(r[0] for r in folds.select("fold").distinct().collect())  # a handful

    def ready(fold):
        train, valid = folds.filter(F.col("fold") != fold).drop("fold"), folds.filter(F.col("fold") == fold).drop("fold")
        return prepared(train, valid, steps() if steps else None)

    def one(job):
        fold, name = job
        out, seconds = _fit_prepared(problem, *parts[fold].result(), models[name], kind, with_train)
        time_row = out.limit(1).select(F.lit("fit_time").alias("metric"), F.lit(seconds).alias("value"), "part")
        out = out.unionByName(time_row)
        tags = {"variant": F.lit(variant), "model": F.lit(name), "fold": F.lit(fold)}
        return materialize(out.withColumns(tags).select("variant", "model", "fold", "part", "metric", "value"))

    with ThreadPoolExecutor(parallelism) as pool:
        parts = {fold: pool.submit(ready, fold) for fold in numbers}  # before any model asks for them
        results = list(pool.map(one, product(numbers, models)))
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out


def summarize(scores: DataFrame, ddof: int = 1, digits: int | None = None) -> DataFrame:
    return fold_summary(scores, ["variant", "model", "part", "metric"], "value", ddof, digits)


def grid(values: dict[str, list]) -> list[dict]:
    return [dict(zip(values, combo)) for combo in product(*values.values())]


def one_at_a_time(defaults: dict, values: dict[str, list]) -> list[dict]:
    """Settings that change one parameter at a time around the defaults."""
    return [{**defaults, name: v} for name, choices in values.items() for v in choices]


def grid_search(
    problem: Problem, make: Callable[..., Callable], settings: list[dict], folds: DataFrame,
    refit: str = "f1_macro", kind: str = "class", steps: Callable[[], Steps] | None = None,
) -> tuple[DataFrame, dict]:
    """Mean and spread of every metric per setting, best first, and the best setting."""
    models = {str(i): make(**s) for i, s in enumerate(settings)}
    scores = cross_validate(problem, models, folds, "grid", steps, kind)
    table = summarize(scores.filter(F.col("part") == "valid"), ddof=0)
    wide = table.groupBy("model").pivot("metric").agg(F.first("mean").alias("mean"), F.first("std").alias("std"))
    names = F.create_map(*[x for i, s in enumerate(settings) for x in (F.lit(str(i)), F.lit(str(s)))])
    wide = materialize(wide.withColumn("params", F.element_at(names, F.col("model"))))
    order = F.desc(f"{refit}_mean") if refit not in ("mse", "rmse", "mae", "median_abs_error") else F.asc(f"{refit}_mean")
    best = wide.orderBy(order, F.col("model").cast("int")).first()
    return wide.orderBy(order, F.col("model").cast("int")), settings[int(best["model"])]


# --- grids whose points share their work -------------------------------------------------


def knn_predictions(problem: Problem, folds: DataFrame, settings: list[dict]) -> DataFrame:
    """(setting, fold, label, prediction) of all kNN settings from one search per distance.

    Every row looks for the largest ``k`` of neighbours among the rows of the other
    folds, all folds in one search; smaller ``k`` are the first of these, and both
    weightings count the same neighbours.
    """
    features = problem.features(folds)
    power = [{"euclidean": 2.0, "manhattan": 1.0}.get(s["metric"], float(s["p"])) for s in settings]
    label = F.col(problem.label).cast("string").alias("label")
    rows = materialize(nearest.vectorize(folds, problem.key, features, "fold").join(folds.select(F.col(problem.key).alias("qid"), label), "qid"))
    numbers = [r[0] for r in rows.select("g").distinct().collect()]  # a handful
    others = F.explode(F.filter(F.array(*[F.lit(n) for n in sorted(numbers)]), lambda n: n != F.col("g")))
    data = materialize(rows.select(F.col("qid").alias("did"), "v", others.alias("g")))
    out = None
    for p in sorted(set(power)):
        mine = [i for i, x in enumerate(power) if x == p]
        most = max(settings[i]["k"] for i in mine)
        near = nearest.search(rows.select("qid", "v", "g"), data, nearest.Metric(p), most)
        near = materialize(near.join(rows.select(F.col("qid").alias("did"), "label"), "did"))
        shape = sorted({(settings[i]["k"], settings[i]["weights"]) for i in mine})
        votes = nearest.votes(near, shape)
        place = {i: shape.index((settings[i]["k"], settings[i]["weights"])) for i in mine}
        each = F.explode(F.array(*[F.struct(F.lit(i).alias("setting"), F.col(f"p{j}").alias("prediction")) for i, j in place.items()])).alias("s")
        found = votes.select("qid", each).select("qid", "s.*")
        found = found.join(rows.select("qid", F.col("g").cast("int").alias("fold"), "label"), "qid").drop("qid")
        out = found if out is None else out.unionByName(found)
    return materialize(out.select("setting", "fold", "label", "prediction"))


def forest_predictions(problem: Problem, folds: DataFrame, settings: list[dict], max_features: int | float | str | None = "sqrt", seed: int = 42) -> DataFrame:
    """(setting, fold, label, prediction) of all forest settings from one forest per least leaf size and fold.

    Numbers of trees, depths and least split sizes are read off the largest forest.
    """
    features = problem.features(folds)
    # all folds and leaf sizes draw alike
    folds = forest.with_draws(folds, problem.key, max(s["n_estimators"] for s in settings), seed, "_drawn")
    numbers = sorted(r[0] for r in folds.select("fold").distinct().collect())  # a handful
    leaves = sorted({s["min_samples_leaf"] for s in settings})

    def one(job: tuple) -> DataFrame:
        fold, leaf = job
        train, valid = folds.filter(F.col("fold") != fold).drop("fold"), folds.filter(F.col("fold") == fold).drop("fold")
        mine = [i for i, s in enumerate(settings) if s["min_samples_leaf"] == leaf]
        trees, rows = max(settings[i]["n_estimators"] for i in mine), train.count()
        model = forest.fit(train, problem.key, features, problem.label, "class", trees, min_leaf=leaf, max_features=max_features, seed=seed, drawn="_drawn")
        shape = [(settings[i]["n_estimators"], settings[i]["max_depth"], forest.at_least(settings[i]["min_samples_split"], rows, 2)) for i in mine]
        got = model.predict_settings(valid.drop("_drawn"), shape)
        names = F.array(*[F.lit(i) for i in mine])
        return materialize(got.select(F.get(names, F.col("setting")).alias("setting"), F.lit(fold).alias("fold"), F.col(problem.label).cast("string").alias("label"), "prediction"))

    with ThreadPoolExecutor(FORESTS) as pool:
        parts = list(pool.map(one, product(numbers, leaves)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def forest_sweep(problem: Problem, settings: list[dict], folds: DataFrame, seed: int = 42) -> DataFrame:
    """Mean and spread over the folds of the regression metrics, a row per setting (trees, max_depth, min_split).

    One forest a fold answers all of them.
    """
    features, trees = problem.features(folds), max(s["trees"] for s in settings)
    folds = forest.with_draws(folds, problem.key, trees, seed, "_drawn")  # all folds draw alike
    numbers = sorted(r[0] for r in folds.select("fold").distinct().collect())  # a handful
    shape = [(s["trees"], s["max_depth"], s["min_split"]) for s in settings]

    def one(fold: int) -> DataFrame:
        train, valid = folds.filter(F.col("fold") != fold).drop("fold"), folds.filter(F.col("fold") == fold).drop("fold")
        model = forest.fit(train, problem.key, features, problem.label, "number", trees, seed=seed, drawn="_drawn")
        return materialize(model.predict_settings(valid.drop("_drawn"), shape).select("setting", F.lit(fold).alias("fold"), problem.label, "prediction"))

    with ThreadPoolExecutor(FORESTS) as pool:
        parts = list(pool.map(one, numbers))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    by = ["setting", "fold"]
    wide = metrics.regression_metrics(found, problem.label, "prediction", by).join(metrics.median_absolute_error(found, problem.label, "prediction", by), by)
    names = ["mse", "rmse", "mae", "r2", "median_abs_error"]
    sums = [f(F.col(m)).alias(f"{m}_{n}") for m in names for n, f in (("mean", F.avg), ("std", F.stddev_samp))]
    params = problem.df.sparkSession.createDataFrame([(i, named(s)) for i, s in enumerate(settings)], "setting int, params string")
    return materialize(wide.groupBy("setting").agg(*sums).join(params, "setting").drop("setting"))


def logistic_predictions(problem: Problem, folds: DataFrame, settings: list[dict], parallelism: int = 4) -> DataFrame:
    """(setting, fold, label, prediction) of all logistic settings.

    Settings that differ only in the most steps follow one path: a fit that ended by
    itself within the steps of a shorter one is that fit, too.
    """
    folds = materialize(folds)
    numbers = sorted(r[0] for r in folds.select("fold").distinct().collect())  # a handful
    parts = {n: [materialize(folds.filter(F.col("fold") != n).drop("fold")), materialize(folds.filter(F.col("fold") == n).drop("fold"))] for n in numbers}
    alike: dict[tuple, list[int]] = {}
    for i, s in enumerate(settings):
        alike.setdefault(tuple(sorted((k, v) for k, v in s.items() if k != "max_iter")), []).append(i)

    def one(job: tuple) -> list[DataFrame]:
        fold, mine = job
        train, valid = parts[fold]
        found, open_ = [], sorted(mine, key=lambda i: settings[i]["max_iter"])
        while open_:
            predict = logistic_regression(**settings[open_[0]])(problem, train)
            steps = settings[open_[0]]["max_iter"]
            same = [i for i in open_ if settings[i]["max_iter"] == steps or predict.steps < steps]
            names = F.explode(F.array(*[F.lit(i) for i in same])).alias("setting")
            got = predict(valid).select(names, F.lit(fold).alias("fold"), F.col(problem.label).cast("string").alias("label"), "prediction")
            found.append(materialize(got))
            open_ = [i for i in open_ if i not in same]
        return found

    with ThreadPoolExecutor(parallelism) as pool:
        found = [part for parts_ in pool.map(one, product(numbers, alike.values())) for part in parts_]
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out


#: Predictions of a whole grid, by model.
GRID_PREDICTIONS: dict[str, Callable[[Problem, DataFrame, list[dict]], DataFrame]] = {
    "knn": knn_predictions,
    "random_forest": forest_predictions,
    "logistic_regression": logistic_predictions,
}


def named(setting: dict) -> str:
    return ", ".join(f"{k}={v}" for k, v in sorted(setting.items()))


def shared_grid(problem: Problem, model: str, settings: list[dict], folds: DataFrame) -> DataFrame:
    """Mean and spread over the folds of every metric, a row per setting: (model, params, <metric>_mean, <metric>_std)."""
    found = GRID_PREDICTIONS[model](problem, folds, settings)
    wide = metrics.classification_metrics(found, "label", "prediction", ["setting", "fold"])
    sums = [f(F.col(m)).alias(f"{m}_{n}") for m in metrics.CLASSIFICATION for n, f in (("mean", F.avg), ("std", F.stddev_pop))]
    names = problem.df.sparkSession.createDataFrame([(i, named(s)) for i, s in enumerate(settings)], "setting int, params string")
    return materialize(wide.groupBy("setting").agg(*sums).join(names, "setting").withColumn("model", F.lit(model)))


def winner(table: DataFrame, settings: list[dict], refit: str = "f1_macro") -> dict:
    """The setting with the best mean, the first one on ties."""
    best = table.orderBy(F.round(f"{refit}_mean", 9).desc(), "setting").first()
    return settings[best["setting"]]


def refit_winner(problem: Problem, model: str, settings: list[dict], train: DataFrame, valid: DataFrame, folds: int = 5, refit: str = "f1_macro") -> tuple[dict, DataFrame]:
    """Search on the folds of the training rows, fit the winner on all of them, score it on the rest."""
    table = shared_grid(problem, model, settings, stratified_kfold(train, problem.key, problem.label, folds))
    best = winner(table, settings, refit)
    make = {"knn": knn, "random_forest": random_forest, "logistic_regression": logistic_regression}[model]
    return best, fit_score(problem, train, valid, make(**best))[0]


def refit_and_score(problem: Problem, make, setting: dict, train: DataFrame, valid: DataFrame, kind: str = "class") -> DataFrame:
    return fit_score(problem, train, valid, make(**setting), None, kind)[0]


def score_batch(problem: Problem, train: DataFrame, unlabelled: DataFrame | None, model: Callable) -> DataFrame | None:
    """(key, prediction) for a table without labels; nothing when there is no such table."""
    if unlabelled is None:
        return None
    return model(problem, train)(unlabelled).select(problem.key, "prediction")


def compare_variants(
    problem: Problem, models: dict[str, Callable], variants: dict[str, Callable[[], Steps] | None], folds: DataFrame,
    kind: str = "class",
) -> DataFrame:
    """The same models and folds over several preprocessing variants (plain, balanced, reduced, anonymized)."""
    out = None
    for name, steps in variants.items():
        scores = cross_validate(problem, models, folds, name, steps, kind)
        out = scores if out is None else out.unionByName(scores)
    return out


