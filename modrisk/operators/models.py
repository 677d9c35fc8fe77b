"""Training, tuning, cross-validation, scoring and persistence of classifiers.

A model table has ``features`` (vector), ``label`` (0/1 double) and ``weight``.
"""

from __future__ import annotations

import math
import random
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target, keyword_only
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from modrisk.functions.draws import draw
from modrisk.functions.tasks import ROWS_PER_TASK, dealt, tasks_for
from modrisk.operators import evaluation
from modrisk.operators.cleaning import LABEL, _Readable, col
from modrisk.operators.network import Network
from modrisk.operators.sampling import class_sizes, with_class_weights

# Model names, default settings and search ranges.
LOGISTIC, FOREST, NETWORK = "Logistic Regression", "Random Forest", "Neural Network (MLP)"
DEFAULTS = {
    LOGISTIC: {"C": 1.0, "max_iter": 1000},
    FOREST: {"trees": 200, "depth": 10, "min_leaf": 2, "features": "sqrt"},
    NETWORK: {"hidden": (128, 64), "max_iter": 500},
}
GRIDS = {
    LOGISTIC: {"C": [0.01, 0.1, 1.0, 10.0]},
    FOREST: {"trees": [100, 300], "depth": [5, 10, 20], "min_leaf": [1, 2]},
}
SEARCH_SPACES = {
    LOGISTIC: {"C": ("log", 1e-3, 10.0), "max_iter": ("int", 500, 2000)},
    FOREST: {
        "trees": ("int", 100, 500), "depth": ("int", 4, 20), "min_leaf": ("int", 1, 10),
        "features": ("choice", ["sqrt", "log2"]),
    },
    NETWORK: {"layer_size": ("choice", [64, 128, 256]), "layers": ("int", 1, 3)},
}
# A network spends some 50,000 operations a row in each step, a forest a walk of every tree in each level.
ROWS_PER_FITTING_TASK = {NETWORK: 1_000, FOREST: 4_000}
SEARCH_TRIALS = {LOGISTIC: 40, FOREST: 50, NETWORK: 40}
PREFERRED = [FOREST, LOGISTIC, NETWORK]


class PopulationScaler(Estimator, _Readable):
    """Learns mean and population deviation of columns in one aggregate."""

    columns = Param(Params._dummy(), "columns", "columns to scale", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, columns=None):
        super().__init__()
        self._setDefault(columns=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, rows: DataFrame) -> "PopulationScalerModel":
        names = self.getOrDefault(self.columns)
        row = rows.agg(
            *[F.avg(col(c)).alias(f"m{i}") for i, c in enumerate(names)],
            *[F.stddev_pop(col(c)).alias(f"s{i}") for i, c in enumerate(names)],
        ).first()
        moments = {c: [row[f"m{i}"] or 0.0, row[f"s{i}"] or 1.0] for i, c in enumerate(names)}
        return PopulationScalerModel(moments=moments)


class PopulationScalerModel(Model, _Readable):
    moments = Param(Params._dummy(), "moments", "mean and divisor per column")

    @keyword_only
    def __init__(self, *, moments=None):
        super().__init__()
        self._setDefault(moments={})
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, rows: DataFrame) -> DataFrame:
        moments = self.getOrDefault(self.moments)
        return rows.select(
            *[
                ((col(c) - F.lit(moments[c][0])) / F.lit(moments[c][1])).alias(c) if c in moments else col(c)
                for c in rows.columns
            ]
        )


def model_table(rows: DataFrame, columns: list[str], label: str = LABEL, keep: list[str] | None = None) -> DataFrame:
    """Assemble features (missing values as 0) and balanced class weights."""
    plain = with_class_weights(rows, label).select(
        *(keep or []),
        *[F.coalesce(col(c).cast("double"), F.lit(0.0)).alias(f"_f{i}") for i, c in enumerate(columns)],
        col(label).cast("double").alias("label"),
        "weight",
    )
    assembler = VectorAssembler(inputCols=[f"_f{i}" for i in range(len(columns))], outputCol="features")
    return assembler.transform(plain).select(*(keep or []), "features", "label", "weight")


def compacted(table: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Cache a training table in as many even partitions as its rows need.

    Iterative fits run one job per step, so a small table in many partitions
    costs mostly scheduling, and a large one takes as long as its largest
    partition. Tables that need several tasks are therefore dealt out anew:
    shuffles that come before merge small partitions, and hashing by class or
    files of one row group leave nearly all rows to a few.
    """
    cached = table.persist()
    tasks = tasks_for(cached.count(), table.sparkSession.sparkContext.defaultParallelism, rows_per_task)
    if tasks == 1:
        return cached.coalesce(1)
    even = cached.repartition(tasks).persist()
    even.count()
    cached.unpersist()
    return even


def logistic_regression(weight_sum: float, C: float = 1.0, max_iter: int = 1000) -> LogisticRegression:
    """Logistic loss with inverse penalty strength C over the summed weights."""
    return LogisticRegression(
        regParam=1.0 / (C * weight_sum), elasticNetParam=0.0, standardization=False,
        maxIter=max_iter, weightCol="weight",
    )


def random_forest(trees: int = 200, depth: int = 10, min_leaf: int = 2, features: str = "sqrt", seed: int = 42):
    return RandomForestClassifier(
        numTrees=trees, maxDepth=depth, minInstancesPerNode=min_leaf, featureSubsetStrategy=features,
        weightCol="weight", seed=seed,
    )


def neural_network(inputs: int, hidden=(128, 64), max_iter: int = 500, seed: int = 42):
    return Network(layers=[inputs, *hidden, 2], maxIter=max_iter, seed=seed)


def balanced_by_copies(table: DataFrame, key: str | None = None, seed: int = 42) -> DataFrame:
    """Repeat minority rows until both classes weigh the same, for learners without weights.

    The fractional part of the factor is drawn per row from its key.
    """
    sizes = class_sizes(table, "label")
    if len(sizes) < 2:
        return table
    minority = min(sizes, key=lambda c: (sizes[c], c))
    factor = max(sizes.values()) / sizes[minority]
    identity = F.col(key) if key else F.xxhash64(vector_to_array("features"))
    extra = (draw(seed, identity) < F.lit(factor - math.floor(factor))).cast("int")
    copies = F.when(F.col("label") == minority, F.lit(math.floor(factor)) + extra).otherwise(1)
    return table.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy")


def _hidden(params: dict) -> tuple[int, ...]:
    if "layer_size" in params:
        return tuple([params["layer_size"]] * params.get("layers", 1))
    return tuple(params.get("hidden", DEFAULTS[NETWORK]["hidden"]))


def estimator(name: str, table: DataFrame, params: dict, seed: int = 42):
    """An unfitted Spark ML classifier for one of the model names."""
    if name == LOGISTIC:
        total = table.agg(F.sum("weight")).first()[0]
        return logistic_regression(total, **params)
    if name == FOREST:
        return random_forest(seed=seed, **params)
    width = table.select(F.size(vector_to_array("features")).alias("n")).first()["n"]
    return neural_network(width, _hidden(params), params.get("max_iter", 500), seed)


class Formula:
    """A scorer given as an expression of the feature array; stands where a fitted model stands."""

    def __init__(self, probability: Callable[[Column], Column]):
        self.probability = probability

    def transform(self, rows: DataFrame) -> DataFrame:
        p = self.probability(vector_to_array("features"))
        return rows.withColumn("probability", array_to_vector(F.array(F.lit(1.0) - p, p)))


def training_rows(name: str, table: DataFrame) -> DataFrame:
    """What a model is fitted on; for a network or a forest as many tasks as its work on a row asks for."""
    rows = balanced_by_copies(table) if name == NETWORK else table
    return dealt(rows, ROWS_PER_FITTING_TASK[name]) if name in ROWS_PER_FITTING_TASK else rows


def scored_rows(model, table: DataFrame, name: str, *keep: str) -> DataFrame:
    """Score a model table: probability of class 1 and the predicted class."""
    probability = F.get(vector_to_array("probability"), F.lit(1))
    return model.transform(table).select(
        *keep, F.lit(name).alias("model"), F.col("label").cast("int").alias("label"),
        probability.alias("score"), F.col("prediction").cast("int").alias("prediction"),
    )


def cross_validated(
    name: str, table: DataFrame, params: dict, folds: int = 5, fold: str = "fold", seed: int = 42, parallelism: int = 5
) -> DataFrame:
    """Scores per fold; models are fitted as concurrent jobs, all folds are evaluated in one pass."""
    def held_out(f: int) -> DataFrame:
        train = table.filter(F.col(fold) != f)
        fitted = estimator(name, train, params, seed).fit(training_rows(name, train))
        return scored_rows(fitted, table.filter(F.col(fold) == f), name, fold)

    with ThreadPool(max(1, min(parallelism, folds))) as pool:
        scored = pool.map(inheritable_thread_target(table.sparkSession)(held_out), range(folds))
    parts = scored[0]
    for more in scored[1:]:
        parts = parts.unionByName(more)
    return evaluation.evaluate(parts.withColumn("unit", F.concat("model", F.lit("#"), fold)), "unit").select(
        F.lit(name).alias("model"), F.substring_index("unit", "#", -1).cast("int").alias("fold"),
        "roc_auc", "f1", "recall", "accuracy", "precision", "avg_precision",
    )


def auc_evaluator() -> BinaryClassificationEvaluator:
    """Exact area under the ROC curve: no score binning."""
    return BinaryClassificationEvaluator(
        rawPredictionCol="rawPrediction", labelCol="label", metricName="areaUnderROC", numBins=0
    )


def _param_maps(name: str, base, candidates: list[dict], table: DataFrame) -> list[dict]:
    """Candidates as Spark ML param maps of one estimator."""
    if name == LOGISTIC:
        total = table.agg(F.sum("weight")).first()[0]
        return [
            {base.regParam: 1.0 / (c.get("C", 1.0) * total), base.maxIter: int(c.get("max_iter", 1000))}
            for c in candidates
        ]
    if name == FOREST:
        d = DEFAULTS[FOREST]
        return [
            {
                base.numTrees: c.get("trees", d["trees"]), base.maxDepth: c.get("depth", d["depth"]),
                base.minInstancesPerNode: c.get("min_leaf", d["min_leaf"]),
                base.featureSubsetStrategy: c.get("features", d["features"]),
            }
            for c in candidates
        ]
    width = base.getLayers()[0]
    return [{base.layers: [width, *_hidden(c), 2]} for c in candidates]


def grid_candidates(name: str, grid: dict | None = None) -> list[dict]:
    """All combinations of a parameter grid."""
    combined: list[dict] = [{}]
    for key, values in (grid or GRIDS.get(name, {})).items():
        combined = [{**c, key: v} for c in combined for v in values]
    return combined


def random_candidates(name: str, trials: int | None = None, seed: int = 42, space: dict | None = None) -> list[dict]:
    """Seeded draws from the search space of a model."""
    rng = random.Random(seed)

    def one(rule):
        kind, *limits = rule
        if kind == "log":
            return math.exp(rng.uniform(math.log(limits[0]), math.log(limits[1])))
        if kind == "int":
            return rng.randint(*limits)
        return rng.choice(limits[0])

    space = space or SEARCH_SPACES[name]
    return [{key: one(rule) for key, rule in space.items()} for _ in range(trials or SEARCH_TRIALS[name])]


def search(
    name: str, table: DataFrame, candidates: list[dict], folds: int = 5, fold: str = "fold",
    parallelism: int = 2, seed: int = 42,
) -> tuple[dict, DataFrame]:
    """Best candidate by cross-validated AUC, and one row per candidate."""
    base = estimator(name, table, DEFAULTS[name], seed)
    rows = training_rows(name, table)
    validator = CrossValidator(
        estimator=base, estimatorParamMaps=_param_maps(name, base, candidates, table),
        evaluator=auc_evaluator(), numFolds=folds, foldCol=fold, parallelism=parallelism,
    )
    fitted = validator.fit(rows)
    scores = list(zip(candidates, fitted.avgMetrics, fitted.stdMetrics))
    best = max(scores, key=lambda s: s[1])[0]
    frame = table.sparkSession.createDataFrame(
        [
            (i, name, {k: str(v) for k, v in params.items()}, float(mean), float(std))
            for i, (params, mean, std) in enumerate(scores)
        ],
        "trial int, model string, params map<string,string>, cv_roc_auc_mean double, cv_roc_auc_std double",
    )
    return best, frame


@dataclass
class Trained:
    """A fitted model with its settings and scores."""

    name: str
    model: object
    params: dict
    metrics: dict
    train_time_s: float = 0.0


@dataclass
class Trainer:
    """Trains the models one by one; a failing model is logged, kept in ``failures`` and does not stop the others.

    ``results`` has trained models only, so who shows all of them asks ``require_all`` first.
    """

    folds: int = 5
    tune: str | None = None  # None, "grid" or "random"
    trials: int | None = None
    seed: int = 42
    settings: dict = field(default_factory=dict)
    results: dict[str, Trained] = field(default_factory=dict)
    log: list[str] = field(default_factory=list)
    failures: dict[str, Exception] = field(default_factory=dict)

    def train_all(self, train: DataFrame, test: DataFrame, names: list[str] | None = None) -> dict[str, Trained]:
        """``train`` needs a ``fold`` column, ``test`` is only scored once."""
        self.log.append(f"training started: tune={self.tune} folds={self.folds}")
        train, test = compacted(train), test.persist()
        for name in names or [LOGISTIC, FOREST, NETWORK]:
            self.log.append(f"training {name}")
            self.results.pop(name, None)  # of an earlier call, which would stand for a failure now
            self.failures.pop(name, None)
            try:
                done = self.results[name] = self._train(name, train, test)
            except Exception as error:  # noqa: BLE001 - one model must not stop the others
                self.failures[name] = error
                self.log.append(f"failed {name}: {error}")
            else:
                auc = done.metrics["roc_auc"]
                self.log.append(f"trained {name}: AUC {'undefined' if auc is None else format(auc, '.4f')}")
        return self.results

    def require_all(self) -> "Trainer":
        """Raises if a model failed: a table of the others would look like the whole result."""
        if self.failures:
            said = "; ".join(f"{name}: {type(e).__name__}: {e}" for name, e in self.failures.items())
            raise RuntimeError(f"{len(self.failures)} models failed: {said}") from next(iter(self.failures.values()))
        return self

    def _train(self, name: str, train: DataFrame, test: DataFrame) -> Trained:
        params = {**DEFAULTS[name], **self.settings.get(name, {})}
        if self.tune:
            candidates = (
                grid_candidates(name) if self.tune == "grid" and name in GRIDS
                else random_candidates(name, self.trials, self.seed)
            )
            params, _ = search(name, train, candidates, self.folds, seed=self.seed)
        start = time.time()
        fitted = estimator(name, train, params, self.seed).fit(training_rows(name, train))
        spent = time.time() - start
        scored = scored_rows(fitted, test, name)
        if not scored.filter(F.isnan("score")).isEmpty():
            raise ArithmeticError("scores are not numbers")
        found = evaluation.evaluate(scored).first()
        if found is None:
            raise ValueError("there is no row to test on")
        scores = found.asDict()
        across = evaluation.fold_summary(
            cross_validated(name, train, params, self.folds, seed=self.seed), ["roc_auc"]
        ).first()
        scores["cv_roc_auc_mean"], scores["cv_roc_auc_std"] = across["roc_auc_mean"], across["roc_auc_std"]
        return Trained(name, fitted, params, scores, spent)

    def metrics(self, spark: SparkSession) -> DataFrame:
        """One row per trained model."""
        return metrics_frame(spark, list(self.results.values()))


METRICS_SCHEMA = (
    "ord int, model string, accuracy double, precision double, recall double, f1 double, specificity double, "
    "npv double, roc_auc double, avg_precision double, cv_roc_auc_mean double, cv_roc_auc_std double, "
    "train_time_s double, params map<string,string>"
)


def metrics_frame(spark: SparkSession, trained: list[Trained]) -> DataFrame:
    names = [
        "accuracy", "precision", "recall", "f1", "specificity", "npv", "roc_auc", "avg_precision",
        "cv_roc_auc_mean", "cv_roc_auc_std",
    ]
    rows = [
        (i, t.name, *[t.metrics.get(n) for n in names], t.train_time_s, {k: str(v) for k, v in t.params.items()})
        for i, t in enumerate(trained)
    ]
    return spark.createDataFrame(rows, METRICS_SCHEMA)


# ---- persistence ----------------------------------------------------------


# How characters of a model name appear in its folder name.
IN_FOLDER_NAMES = str.maketrans({" ": "_", "(": None, ")": None})


def safe_name(name: str) -> str:
    return name.translate(IN_FOLDER_NAMES)


def save_model(spark: SparkSession, trained: Trained, directory: str) -> str:
    """Write a model folder and append its metrics row."""
    path = f"{directory.rstrip('/')}/{safe_name(trained.name)}"
    trained.model.write().overwrite().save(path)
    row = metrics_frame(spark, [trained]).withColumn("path", F.lit(path)).withColumn("saved_at", F.current_timestamp())
    row.write.mode("append").parquet(f"{directory.rstrip('/')}/_metrics")
    return path


def save_all(spark: SparkSession, results: dict[str, Trained], directory: str) -> list[str]:
    return [save_model(spark, t, directory) for t in results.values()]


def load_model(path: str):
    """Load a saved classifier, fitted step or pipeline by its stored class."""
    from pyspark.ml.util import DefaultParamsReader as Reader

    spark = SparkSession.getActiveSession()
    metadata = Reader.loadMetadata(path, spark)
    if metadata["class"].endswith("PipelineModel"):
        return PipelineModel.load(path)
    return DefaultParamsReader.loadParamsInstance(path, spark)


def saved_models(spark: SparkSession, directory: str) -> DataFrame:
    """The latest metrics row of every saved model."""
    rows = spark.read.parquet(f"{directory.rstrip('/')}/_metrics")
    columns = [c for c in rows.columns if c != "path"]
    return rows.groupBy("path").agg(
        *[F.max_by(c, "saved_at").alias(c) for c in columns]
    ).orderBy("path")


def allowed_models(metrics: DataFrame, names: list[str]) -> DataFrame:
    """Stored scores of the models on an allow-list."""
    return metrics.filter(F.col("model").isin(*names)).select(
        "model", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ["accuracy", "precision", "recall", "f1", "roc_auc"]]
    )


def preferred_model(results: dict[str, object]):
    """The forest when there is one, else the first model at hand."""
    return next((results[n] for n in PREFERRED if n in results), next(iter(results.values()), None))


def new_scores(model, table: DataFrame, *keep: str) -> DataFrame:
    """Probability of class 1 for unlabelled rows."""
    return model.transform(table).select(*keep, F.get(vector_to_array("probability"), F.lit(1)).alias("model_score"))


def native_importance(model, columns: list[str], top: int = 15) -> DataFrame:
    """Importance stored in a tree model, best first."""
    spark = SparkSession.getActiveSession()
    values = model.featureImportances.toArray()
    frame = spark.createDataFrame(
        [(c, float(values[i])) for i, c in enumerate(columns)], "feature string, importance double"
    )
    return frame.orderBy(F.desc("importance"), "feature").limit(top)
