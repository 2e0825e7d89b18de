"""Models on a separable toy set: quality, repeatability, storage, failures."""

import random
import warnings

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Observation, functions as F

from afterplay.operators.metrics import roc_auc
from afterplay.operators.prepare import fit_preparation
from afterplay.plans.dataset import Game, build_all, load_dataset
from afterplay.plans.fragments import RACE
from afterplay.plans.queries_models import model_leaderboard
from afterplay.plans.queries_rows import race_events
from afterplay.plans.training import (
    FLAT_PARAMS,
    Dataset,
    ModelConfig,
    ModelRegistry,
    all_predictions,
    evaluate_model,
    load_model,
    logistic_regression,
    random_forest,
    run_grid,
    save_model,
    train_model,
    training_matrix,
)

QUICK = ModelRegistry().update("RandomForest", n_estimators=10, max_depth=5)


def toy(spark, n, seed, first=0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        churned = int(rng.random() < 0.4)
        rows.append((f"p{first + i}", churned, churned + rng.gauss(0, 0.7), rng.random(), rng.gauss(churned * 2, 2)))
    return spark.createDataFrame(rows, "player_id string, churned int, a double, b double, c double")


@pytest.fixture(scope="module")
def data(spark):
    return Dataset("toy", toy(spark, 400, 1).cache(), toy(spark, 200, 2, 400).cache())


@pytest.fixture(scope="module")
def result(spark, data):
    return run_grid(spark, [data], QUICK)


def values(result, model):
    return {r.metric: r.value for r in result.metrics.filter(F.col("model") == model).collect()}


@pytest.mark.parametrize("model", ["DecisionTree", "LogisticRegression", "RandomForest"])
def test_learns(result, model):
    found = values(result, model)
    assert set(found) == {"roc_auc", "accuracy", "precision", "recall", "f1_score"}
    assert found["roc_auc"] > 0.7
    importances = {r.feature: r.importance for r in result.importances.filter(F.col("model") == model).collect()}
    assert set(importances) == {"a", "b", "c"} and importances["a"] > importances["b"]


def test_area_equals_that_of_the_library(result, data):
    model = result.models["toy", "LogisticRegression"]
    ours = values(result, "LogisticRegression")["roc_auc"]
    matrix = model.preparation.apply(data.held_out, keep=("churned",))
    theirs = BinaryClassificationEvaluator(
        labelCol="churned", rawPredictionCol="probability", numBins=0
    ).evaluate(model.pipeline.transform(matrix))
    assert ours == pytest.approx(theirs, rel=1e-12)


def test_same_seed_same_metrics(spark, data, result):
    again = run_grid(spark, [data], [QUICK.get("RandomForest")])
    assert values(again, "RandomForest") == values(result, "RandomForest")


def test_balanced_logistic_matches_a_newton_solve(result, data):
    """The penalised, class-weighted objective has one minimum; a few Newton steps find it."""
    import numpy as np

    model = result.models["toy", "LogisticRegression"]
    rows = model.preparation.apply(data.train, keep=("churned",)).toPandas()
    x = np.column_stack([np.ones(len(rows)), rows[model.features].to_numpy()])
    y = rows["churned"].to_numpy()
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    beta = np.zeros(x.shape[1])
    ridge = np.diag([0.0] + [1.0] * len(model.features))
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ beta))
        gradient = 0.1 * x.T @ (weight * (p - y)) + ridge @ beta
        hessian = 0.1 * (x * (weight * p * (1 - p))[:, None]).T @ x + ridge
        beta -= np.linalg.solve(hessian, gradient)
    found = dict(model.coefficients())
    assert [found[f] for f in model.features] == pytest.approx(list(beta[1:]), abs=2e-3)


def test_flat_parameters_scale_the_linear_model_only(spark, data):
    registry = ModelRegistry(FLAT_PARAMS)
    grid = run_grid(spark, [data], [registry.get("LogisticRegression"), registry.get("DecisionTree")], scale="linear")
    assert grid.models["toy", "LogisticRegression"].scaled and not grid.models["toy", "DecisionTree"].scaled
    with pytest.raises(ValueError):
        run_grid(spark, [data], scale="some")


def test_storage(spark, data, result, tmp_path):
    model = result.models["toy", "RandomForest"]
    save_model(model, str(tmp_path / "model"))
    loaded = load_model(str(tmp_path / "model"))
    assert (loaded.name, loaded.features, loaded.scaled) == (model.name, model.features, True)
    before, after = (m.predict(data.held_out).orderBy("player_id").collect() for m in (model, loaded))
    assert before == after
    model.pipeline.write().save(str(tmp_path / "bare"))
    assert load_model(str(tmp_path / "bare")).features == model.features


def test_one_class_gives_error_rows_and_the_rest_goes_on(spark, data):
    lonely = Dataset("lonely", data.train.filter("churned = 1"), data.held_out)
    nothing = Dataset("nothing", data.train.limit(0), data.held_out)
    grid = run_grid(spark, [lonely, nothing, data], [QUICK.get("LogisticRegression")])
    errors = {r.dataset: r.error for r in grid.metrics.filter("error IS NOT NULL").collect()}
    assert set(errors) == {"lonely", "nothing"} and "not_binary" in errors["lonely"]
    assert values(grid, "LogisticRegression")["roc_auc"] is not None or grid.models


def test_one_class_in_the_held_out_table(spark, data, result):
    model = result.models["toy", "LogisticRegression"]
    found = evaluate_model(model, data.held_out.filter("churned = 1")).first()
    assert found.roc_auc is None and found.recall > 0


def test_evaluation_refuses_bad_input(data, result):
    model = result.models["toy", "LogisticRegression"]
    with pytest.raises(ValueError):
        evaluate_model("no model", data.held_out)
    with pytest.raises(ValueError):
        evaluate_model(model, data.held_out.drop("a"))
    with pytest.raises(ValueError):
        evaluate_model(model, data.held_out.withColumn("a", F.lit(float("inf"))))


def test_any_estimator_can_be_trained(data):
    config = ModelConfig("Boosted", {"random_state": 1})
    matrix = training_matrix(data.train, fit_preparation(data.train))
    model = train_model(config, matrix, lambda p, w: GBTClassifier(labelCol="churned", maxIter=3, seed=1))
    assert roc_auc(model.predict(data.held_out), label="churned").first().roc_auc > 0.7


def test_grid_takes_renamed_and_foreign_learners(spark, data):
    configs = [
        ModelConfig("LR_strong", {"random_state": 1, "C": 10.0}, logistic_regression),
        ModelConfig("Boosted", {"random_state": 1}, lambda p, w: GBTClassifier(labelCol="churned", maxIter=3, seed=1)),
        ModelConfig("Unknown", {"random_state": 1}),
    ]
    grid = run_grid(spark, [data], configs, scale="linear")
    assert {name: model.scaled for (_, name), model in grid.models.items()} == {"LR_strong": True, "Boosted": False}
    errors = {r.model: r.error for r in grid.metrics.filter("error IS NOT NULL").collect()}
    assert list(errors) == ["Unknown"] and "names no learner" in errors["Unknown"]


def test_registry():
    registry = ModelRegistry()
    assert registry.names() == ["DecisionTree", "LogisticRegression", "RandomForest"]
    assert registry.update("LogisticRegression", C=2.0).get("LogisticRegression").params["C"] == 2.0
    assert registry.get("LogisticRegression").params["C"] == 0.1
    with pytest.raises(KeyError):
        registry.get("Oracle")
    for name, bad in (("LogisticRegression", {"C": 0}), ("RandomForest", {"max_features": "most"}), ("DecisionTree", {"max_depth": 0}), ("DecisionTree", {"max_depth": 31})):
        with pytest.raises(ValueError):
            registry.update(name, **bad)
    with warnings.catch_warnings(record=True) as caught:
        warnings.simplefilter("always")
        registry.update("LogisticRegression", max_iter=10)
        registry.update("RandomForest", n_estimators=2)
        ModelConfig("Other", {})
    assert len(caught) == 3
    with pytest.raises(ValueError):
        ModelConfig("", {"random_state": 1})


def test_data_job(spark, sf_dir, tmp_path):
    events = race_events(spark, sf_dir)
    games = [Game("race", events, RACE, purchases=True), Game("empty", events.limit(0), RACE)]
    built = build_all(spark, games, str(tmp_path))
    assert isinstance(built["empty"], str)
    data = built["race"]
    assert data.train.count() == 12 and data.held_out.count() == 3
    assert data.train.columns == data.held_out.columns and "highestPrice" in data.train.columns
    assert load_dataset(spark, "race", str(tmp_path / "race")).train.count() == 12


def test_predictions_of_all_models(data, result):
    rows = all_predictions(result, [data])
    assert rows.count() == 3 * data.held_out.count()
    assert rows.filter("score NOT BETWEEN 0 AND 1").isEmpty()


@pytest.mark.parametrize("model", ["DecisionTree", "RandomForest"])
def test_trees_predict_after_an_observed_count(spark, data, model):
    spark.range(3).observe(Observation(), F.count(F.lit(1)).alias("n")).collect()
    grid = run_grid(spark, [data], [QUICK.get(model)])
    assert grid.metrics.filter("error IS NOT NULL").isEmpty()
    assert set(values(grid, model)) == {"roc_auc", "accuracy", "precision", "recall", "f1_score"}


def test_linear_models_predict_after_an_observed_count(spark, data):
    spark.range(3).observe(Observation(), F.count(F.lit(1)).alias("n")).collect()
    matrix = training_matrix(data.train, fit_preparation(data.train))
    model = train_model(QUICK.get("LogisticRegression"), matrix)
    fitted = logistic_regression(model.params, 400.0).fit(matrix.weighted(True))
    assert model.classifier.coefficients == fitted.coefficients and model.classifier.intercept == fitted.intercept
    assert model.predict(data.held_out).filter("score BETWEEN 0 AND 1").count() == data.held_out.count()


def test_leaderboard_ranks_all_models_after_an_observed_count(spark, sf_dir):
    spark.range(3).observe(Observation(), F.count(F.lit(1)).alias("n")).collect()
    rows = {(r.dataset, r.model) for r in model_leaderboard(spark, sf_dir).collect()}
    assert rows == {(d, m) for d in ("score", "race") for m in ModelRegistry().names()}


def test_deep_trees_do_not_travel_with_the_rows_of_each_level(data):
    """Rows that remember their nodes grow the same trees as rows that are led through them."""
    matrix = training_matrix(data.train, fit_preparation(data.train))
    learner = random_forest(FLAT_PARAMS["RandomForest"] | {"n_estimators": 10}, 400.0)
    assert learner.getCacheNodeIds()
    grown = [e.fit(matrix.weighted(False)) for e in (learner, learner.copy().setCacheNodeIds(False))]
    assert grown[0].toDebugString == grown[1].toDebugString and max(t.depth for t in grown[0].trees) > 5
    matrix.release()


def test_metrics_come_from_written_predictions(data, result):
    model = result.models["toy", "RandomForest"]
    found = evaluate_model(model, data.held_out)
    assert "UDF" in model.predict(data.held_out)._jdf.queryExecution().toString()
    assert "UDF" not in found._jdf.queryExecution().toString()
    assert found.first().roc_auc == pytest.approx(values(result, "RandomForest")["roc_auc"], rel=1e-12)
