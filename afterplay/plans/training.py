"""Training, prediction, evaluation and storage of churn models with MLlib."""

from __future__ import annotations

import json
import warnings
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace
from functools import reduce
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from afterplay.operators.metrics import evaluate, melt_metrics
from afterplay.operators.prepare import (
    Preparation,
    check_matrix,
    fit_preparation,
    fit_separately,
)
from afterplay.session import scratch_path
from afterplay.sources.writers import write_table

TARGET = "churned"

# Parameters ------------------------------------------------------------------------------

# The two published parameter sets.
MAIN_PARAMS: dict[str, dict[str, Any]] = {
    "DecisionTree": {
        "random_state": 42,
        "max_depth": 10,
        "min_samples_leaf": 10,
        "max_features": "sqrt",
        "class_weight": "balanced",
    },
    "LogisticRegression": {
        "random_state": 42,
        "max_iter": 5000,
        "C": 0.1,
        "tol": 0.001,
        "class_weight": "balanced",
    },
    "RandomForest": {
        "random_state": 42,
        "n_estimators": 100,
        "max_depth": 15,
        "min_samples_leaf": 5,
        "max_features": "sqrt",
        "bootstrap": True,
        "class_weight": "balanced",
    },
}
FLAT_PARAMS: dict[str, dict[str, Any]] = {
    "DecisionTree": {"random_state": 42, "max_depth": None},
    "LogisticRegression": {"random_state": 42, "max_iter": 1000, "C": 1.0, "tol": 0.0001},
    "RandomForest": {
        "random_state": 42,
        "n_estimators": 100,
        "max_depth": None,
        "max_features": "sqrt",
        "bootstrap": True,
    },
}
# The names of feature subsets.
FEATURE_SUBSETS = ("sqrt", "log2", "auto")
DEEPEST_TREE = 30  # the limit of MLlib, for trees without a depth of their own


@dataclass(frozen=True)
class ModelConfig:
    """Parameters under a name. The name chooses the learner unless ``estimator`` makes one.

    ``linear`` tells whether features are scaled where only linear models get scaled ones;
    if not said, it follows from the learner.
    """

    name: str
    params: dict[str, Any]
    estimator: EstimatorFactory | None = None
    linear: bool | None = None

    def __post_init__(self) -> None:
        validate_config(self)

    def updated(self, **params: Any) -> ModelConfig:
        return replace(self, params=self.params | params)


def validate_config(config: ModelConfig) -> None:
    """Reject what cannot be trained and warn about what probably should not."""
    params = config.params
    if not config.name:
        raise ValueError("a model needs a name")
    if not isinstance(params, dict):
        raise ValueError(f"parameters of {config.name} must be a dictionary")
    if "random_state" not in params:
        warnings.warn(f"{config.name} has no random_state, its result may vary", stacklevel=3)
    if params.get("C", 1.0) <= 0:
        raise ValueError("C must be positive")
    if params.get("max_iter", 100) < 100:
        warnings.warn(f"{config.name} may not converge in {params['max_iter']} iterations", stacklevel=3)
    if params.get("n_estimators", 10) < 10:
        warnings.warn(f"{config.name} has only {params['n_estimators']} trees", stacklevel=3)
    subset = params.get("max_features")
    if isinstance(subset, str) and subset not in FEATURE_SUBSETS:
        raise ValueError(f"max_features must be one of {FEATURE_SUBSETS}")
    depth = params.get("max_depth")
    if depth is not None and depth < 1:
        raise ValueError("max_depth must be None or positive")
    if depth is not None and depth > DEEPEST_TREE and config.estimator is None:
        raise ValueError(f"max_depth must not be above {DEEPEST_TREE}, the deepest tree that can be trained")


class ModelRegistry:
    """Named model configurations; :meth:`update` gives a new registry."""

    def __init__(self, params: dict[str, dict[str, Any]] = MAIN_PARAMS) -> None:
        self._configs = {name: ModelConfig(name, dict(p)) for name, p in params.items()}

    def names(self) -> list[str]:
        return list(self._configs)

    def get(self, name: str) -> ModelConfig:
        if name not in self._configs:
            raise KeyError(f"no model {name}, there are {self.names()}")
        return self._configs[name]

    def update(self, name: str, **params: Any) -> ModelRegistry:
        changed = ModelRegistry({})
        changed._configs = self._configs | {name: self.get(name).updated(**params)}
        return changed

    def __iter__(self):
        return iter(self._configs.values())


# Estimators ------------------------------------------------------------------------------

EstimatorFactory = Callable[[dict[str, Any], float], Estimator]


def _tree(params: dict[str, Any], trees: int, bootstrap: bool) -> RandomForestClassifier:
    """Each row remembers its node in every tree. Else all trees so far travel with the tasks of every level."""
    subset = {"auto": "auto", "sqrt": "sqrt", "log2": "log2", None: "all"}[params.get("max_features")]
    return RandomForestClassifier(
        labelCol=TARGET,
        weightCol="weight",
        numTrees=trees,
        bootstrap=bootstrap,
        featureSubsetStrategy=subset,
        impurity="gini",
        maxDepth=params.get("max_depth") or DEEPEST_TREE,
        minInstancesPerNode=params.get("min_samples_leaf", 1),
        seed=params.get("random_state", 42),
        cacheNodeIds=True,
    )


def decision_tree(params: dict[str, Any], total_weight: float) -> Estimator:
    """One tree that looks at a subset of the features in each node."""
    return _tree(params, trees=1, bootstrap=False)


def random_forest(params: dict[str, Any], total_weight: float) -> Estimator:
    return _tree(params, params.get("n_estimators", 100), params.get("bootstrap", True))


def logistic_regression(params: dict[str, Any], total_weight: float) -> Estimator:
    """L2 with strength ``C``: MLlib averages the loss, so its penalty is 1 / (C * weight)."""
    return LogisticRegression(
        labelCol=TARGET,
        weightCol="weight",
        regParam=1.0 / (params.get("C", 1.0) * max(total_weight, 1.0)),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=params.get("max_iter", 100),
        tol=params.get("tol", 1e-4),
    )


ESTIMATORS: dict[str, EstimatorFactory] = {
    "DecisionTree": decision_tree,
    "LogisticRegression": logistic_regression,
    "RandomForest": random_forest,
}
LINEAR = ("LogisticRegression",)


# Models ----------------------------------------------------------------------------------


@dataclass(frozen=True)
class FittedModel:
    """A trained classifier with everything needed to apply it to a feature table."""

    name: str
    params: dict[str, Any]
    preparation: Preparation
    pipeline: PipelineModel
    scaled: bool = True

    @property
    def features(self) -> list[str]:
        return self.preparation.features

    @property
    def classifier(self) -> Model:
        return self.pipeline.stages[-1]

    def predict(self, table: DataFrame, keep: tuple[str, ...] = ("player_id", TARGET)) -> DataFrame:
        """``prediction`` and ``score``, the probability of churn, next to the kept columns."""
        missing = [f for f in self.features if f not in table.columns]
        if missing:
            raise ValueError(f"{self.name} needs features {missing}")
        kept = tuple(c for c in keep if c in table.columns)
        prepared = self.preparation.apply(table, scale=self.scaled, keep=kept)
        rows = self.pipeline.transform(prepared)
        return rows.select(
            *kept,
            F.col("prediction").cast("int").alias("prediction"),
            vector_to_array("probability")[1].alias("score"),
        )

    def importance(self) -> list[tuple[str, float]]:
        """Tree importance, or the size of the coefficient; names travel with the vector."""
        model = self.classifier
        values = model.featureImportances if hasattr(model, "featureImportances") else model.coefficients
        return [(f, abs(float(v))) for f, v in zip(self.features, values.toArray())]

    def coefficients(self) -> list[tuple[str, float]]:
        """Signed coefficients of a linear model."""
        return [(f, float(v)) for f, v in zip(self.features, self.classifier.coefficients.toArray())]


@dataclass(frozen=True)
class TrainingMatrix:
    """A checked matrix with rows per class, kept for the many passes of the learners."""

    preparation: Preparation
    scaled: bool
    assembler: VectorAssembler
    rows: DataFrame
    class_rows: dict[int, int]

    def weighted(self, balanced: bool) -> DataFrame:
        """Rows with a weight: 1, or for each class ``n / (2 * n_class)``."""
        if not balanced:
            return self.rows.withColumn("weight", F.lit(1.0))
        total = sum(self.class_rows.values())
        weights = {c: total / (len(self.class_rows) * n) for c, n in self.class_rows.items()}
        return self.rows.withColumn(
            "weight", F.when(F.col(TARGET) == 1, F.lit(weights[1])).otherwise(F.lit(weights[0]))
        )

    def release(self) -> None:
        self.rows.unpersist()


def training_matrix(table: DataFrame, preparation: Preparation, scaled: bool = True) -> TrainingMatrix:
    """Prepare and check a feature table with a 0/1 target."""
    matrix = preparation.apply(table, scale=scaled, keep=(TARGET,))
    check = check_matrix(matrix, preparation.features, TARGET)
    if check.problems:
        raise ValueError("; ".join(check.problems))
    for concern in check.concerns:
        warnings.warn(concern, stacklevel=2)
    assembler = VectorAssembler(inputCols=preparation.features, outputCol="features")
    rows = assembler.transform(matrix).select("features", TARGET).persist()
    return TrainingMatrix(preparation, scaled, assembler, rows, {0: check.zeros, 1: check.ones})


def without_summary(model: Model) -> Model:
    """The model without the summary of its training.

    Tasks that predict get the model with all it holds. A summary holds the session, which cannot be
    sent to tasks any more once a count was observed in it. Copies of tree models have no summary;
    those of linear models keep it, but a stored model has none.
    """
    bare = model.copy()
    if not getattr(bare, "hasSummary", False):
        return bare
    path = scratch_path(SparkSession.active(), "fitted")
    bare.write().overwrite().save(path)
    return type(bare).load(path)


def train_model(
    config: ModelConfig, matrix: TrainingMatrix, estimator: EstimatorFactory | None = None
) -> FittedModel:
    """Fit one classifier. Any MLlib estimator can take the place of the named one."""
    balanced = config.params.get("class_weight") == "balanced"
    factory = estimator or config.estimator or ESTIMATORS.get(config.name)
    if factory is None:
        raise ValueError(f"{config.name} names no learner of {list(ESTIMATORS)} and has no estimator of its own")
    total = float(sum(matrix.class_rows.values()))
    model = without_summary(factory(config.params, total).fit(matrix.weighted(balanced)))
    pipeline = PipelineModel([matrix.assembler, model])
    return FittedModel(config.name, config.params, matrix.preparation, pipeline, matrix.scaled)


def check_held_out(model: FittedModel, table: DataFrame) -> None:
    """Refuse a table the model cannot be evaluated on."""
    if not isinstance(model, FittedModel):
        raise ValueError("the model is not fitted")
    lacking = [f for f in model.features if f not in table.columns]
    if lacking:
        raise ValueError(f"{model.name} needs features {lacking}")
    known = F.coalesce(F.col(TARGET).cast("double").isin(0.0, 1.0), F.lit(False))
    if not table.filter(~known).isEmpty():
        raise ValueError(f"{TARGET} must be 0 or 1 in every row to evaluate on")
    prepared = model.preparation.apply(table, scale=model.scaled, keep=(TARGET,))
    problems = check_matrix(prepared, model.features).problems
    if problems:
        raise ValueError("; ".join(problems))


def evaluate_model(model: FittedModel, table: DataFrame, checked: bool = False) -> DataFrame:
    """All metrics of a fitted model on a labelled feature table, in one wide row.

    Predictions go through a file in the scratch folder: every stage behind a prediction would carry
    the model again, and deep forests are large.
    """
    if not checked:
        check_held_out(model, table)
    path = scratch_path(table.sparkSession, "predictions")
    write_table(model.predict(table), path)
    return evaluate(table.sparkSession.read.parquet(path), label=TARGET)


# Storage ---------------------------------------------------------------------------------


def save_model(model: FittedModel, path: str) -> None:
    """The pipeline and one row that describes it, in a folder all executors can reach."""
    spark = SparkSession.active()
    model.pipeline.write().overwrite().save(f"{path}/pipeline")
    p = model.preparation
    features = [
        (i, f, p.fills.get(f), p.means.get(f), p.deviations.get(f)) for i, f in enumerate(p.features)
    ]
    schema = "i int, feature string, fill double, mean double, deviation double"
    spark.createDataFrame(features, schema).coalesce(1).write.mode("overwrite").json(f"{path}/features")
    params = [(model.name, json.dumps(model.params), model.scaled)]
    about = spark.createDataFrame(params, "name string, params string, scaled boolean")
    about.coalesce(1).write.mode("overwrite").json(f"{path}/about")


def load_model(path: str) -> FittedModel:
    """A saved model. A bare pipeline is accepted too; it gets no fills and no scaling."""
    spark = SparkSession.active()
    schema = "i int, feature string, fill double, mean double, deviation double"
    try:
        rows = spark.read.schema(schema).json(f"{path}/features").orderBy("i").collect()
    except AnalysisException:
        pipeline = PipelineModel.load(path)
        names = list(pipeline.stages[0].getInputCols())
        return FittedModel(type(pipeline.stages[-1]).__name__, {}, Preparation(names, {}), pipeline, False)
    preparation = Preparation(
        [r.feature for r in rows],
        {r.feature: r.fill for r in rows},
        {r.feature: r.mean for r in rows if r.mean is not None},
        {r.feature: r.deviation for r in rows if r.deviation is not None},
    )
    about = spark.read.schema("name string, params string, scaled boolean").json(f"{path}/about").first()
    return FittedModel(about.name, json.loads(about.params), preparation, PipelineModel.load(f"{path}/pipeline"), about.scaled)


# Grid ------------------------------------------------------------------------------------

METRIC_SCHEMA = "dataset string, model string, metric string, value double, error string"
IMPORTANCE_SCHEMA = "dataset string, model string, feature string, importance double"


@dataclass(frozen=True)
class Dataset:
    name: str
    train: DataFrame
    held_out: DataFrame


@dataclass
class GridResult:
    """Long tables of metrics and importances, and the models by dataset and name."""

    metrics: DataFrame
    importances: DataFrame
    models: dict[tuple[str, str], FittedModel] = field(default_factory=dict)


def run_grid(
    spark: SparkSession,
    datasets: Iterable[Dataset],
    registry: Iterable[ModelConfig] | None = None,
    scale: str = "all",
    separately: bool = False,
) -> GridResult:
    """Train every model on every data set. A failure becomes an error row, the rest goes on.

    ``scale`` is ``all`` or ``linear``; the latter leaves trees their raw features. With
    ``separately`` each table is cleaned by itself, as opposed to as the training table.
    Only metric and importance values pass the driver.
    """
    if scale not in ("all", "linear"):
        raise ValueError(f"scale must be all or linear, not {scale}")
    configs = list(registry if registry is not None else ModelRegistry())
    metrics: list[tuple] = []
    importances: list[tuple] = []
    models: dict[tuple[str, str], FittedModel] = {}
    for data in datasets:
        try:
            train_prep, held_prep = _prepared(data, separately)
            matrices = {s: training_matrix(data.train, train_prep, s) for s in _scalings(configs, scale)}
        except Exception as error:  # e.g. no features remain: the data set as a whole fails
            metrics += [(data.name, c.name, None, None, str(error)) for c in configs]
            continue
        checked = False
        for config in configs:
            # what the models before left in the driver goes once it has collected their plans
            spark._jvm.System.gc()
            try:
                model = train_model(config, matrices[_is_scaled(config, scale)])
                tested = replace(model, preparation=held_prep)
                found = evaluate_model(tested, data.held_out, checked)
                values = melt_metrics(found.withColumn("one", F.lit(1)), "one").collect()
            except Exception as error:
                metrics.append((data.name, config.name, None, None, str(error)))
                continue
            checked = True
            models[data.name, config.name] = tested
            metrics += [(data.name, config.name, r.metric, r.value, None) for r in values]
            importances += [(data.name, config.name, f, v) for f, v in model.importance()]
        for matrix in matrices.values():
            matrix.release()
    return GridResult(
        spark.createDataFrame(metrics, METRIC_SCHEMA),
        spark.createDataFrame(importances, IMPORTANCE_SCHEMA),
        models,
    )


def _is_scaled(config: ModelConfig, scale: str) -> bool:
    if scale == "all":
        return True
    if config.linear is not None:
        return config.linear
    return (config.estimator or ESTIMATORS.get(config.name)) in [ESTIMATORS[name] for name in LINEAR]


def _scalings(configs: list[ModelConfig], scale: str) -> set[bool]:
    return {_is_scaled(config, scale) for config in configs}


def _prepared(data: Dataset, separately: bool) -> tuple[Preparation, Preparation]:
    if data.train.isEmpty() or data.held_out.isEmpty():
        raise ValueError("empty training or evaluation table")
    if separately:
        return fit_separately(data.train, data.held_out, TARGET)
    both = fit_preparation(data.train, TARGET)
    return both, both


def all_predictions(result: GridResult, datasets: Iterable[Dataset]) -> DataFrame:
    """Held-out predictions of all models below each other."""
    frames = []
    for data in datasets:
        for (name, model_name), model in result.models.items():
            if name == data.name:
                rows = model.predict(data.held_out)
                frames.append(rows.select(F.lit(name).alias("dataset"), F.lit(model_name).alias("model"), "*"))
    return reduce(DataFrame.unionByName, frames)

