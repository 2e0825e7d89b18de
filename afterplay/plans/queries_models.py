"""Model queries: trained on the players of both games, evaluated on players held out.

Learners differ between engines, so the SQL twins check what they cannot differ in: who is held
out, with which label, that every model scores every one of them within bounds, and which metrics
exist. The metrics themselves are checked against brute force in the tests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from afterplay.operators.metrics import leaderboard, widen_metrics
from afterplay.operators.prepare import fit_preparation
from afterplay.plans.dataset import Game, build_features, load_dataset
from afterplay.plans.fragments import RACE, RACE_EVENTS, SCORE, SCORE_EVENTS, label_ctes
from afterplay.plans.queries_rows import race_events, score_events
from afterplay.plans.queries_split import HASH_SQL
from afterplay.plans.registry import query
from afterplay.plans.training import (
    FLAT_PARAMS,
    Dataset,
    ModelRegistry,
    all_predictions,
    load_model,
    run_grid,
    save_model,
    train_model,
    training_matrix,
)
from afterplay.session import scratch_path


def score_game(spark: SparkSession, folder: str) -> Dataset:
    path = scratch_path(spark, "score-game")
    build_features(Game("score", score_events(spark, folder), SCORE), path)
    return load_dataset(spark, "score", path)


def race_game(spark: SparkSession, folder: str) -> Dataset:
    path = scratch_path(spark, "race-game")
    build_features(Game("race", race_events(spark, folder), RACE, purchases=True), path)
    return load_dataset(spark, "race", path)


def both_games(spark: SparkSession, folder: str) -> list[Dataset]:
    return [score_game(spark, folder), race_game(spark, folder)]


MODELS_SQL = "(VALUES ('DecisionTree'), ('LogisticRegression'), ('RandomForest')) m(model)"
METRICS_SQL = "(VALUES ('roc_auc'), ('accuracy'), ('precision'), ('recall'), ('f1_score')) k(metric)"


def _held_out_sql(game: str, events: str, horizon) -> str:
    return f"""SELECT '{game}' AS dataset, player_id, CAST(churned AS INTEGER) AS churned FROM (
        WITH {label_ctes(events, horizon)}
        SELECT *, row_number() OVER (ORDER BY {HASH_SQL}) AS place, count(*) OVER () AS players FROM labels)
        WHERE place > floor(players * CAST(0.8 AS DOUBLE))"""


HELD_OUT_SQL = f"({_held_out_sql('score', SCORE_EVENTS, SCORE)} UNION ALL {_held_out_sql('race', RACE_EVENTS, RACE)})"


def _metrics_sql(model: str | None = None) -> str:
    """Every metric is there and in range; there is no area with one class alone."""
    chosen = f"WHERE model = '{model}'" if model else ""
    return f"""SELECT dataset, model, metric, metric <> 'roc_auc' OR min(churned) <> max(churned) AS has_value, TRUE AS in_range
        FROM {HELD_OUT_SQL}, {MODELS_SQL}, {METRICS_SQL} {chosen} GROUP BY dataset, model, metric"""


def _in_range(value: Column) -> Column:
    return F.coalesce(value.between(0, 1), F.lit(True))


def _checked(metrics: DataFrame) -> DataFrame:
    value = F.col("value")
    return metrics.select(
        "dataset",
        "model",
        "metric",
        value.isNotNull().alias("has_value"),
        (F.col("error").isNull() & _in_range(value)).alias("in_range"),
    )


def _one_model(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return _checked(run_grid(spark, both_games(spark, folder), [ModelRegistry().get(name)]).metrics)


@query("model_decision_tree", _metrics_sql("DecisionTree"))
def model_decision_tree(spark, folder):
    return _one_model(spark, folder, "DecisionTree")


@query("model_random_forest", _metrics_sql("RandomForest"))
def model_random_forest(spark, folder):
    return _one_model(spark, folder, "RandomForest")


@query("model_logistic", _metrics_sql("LogisticRegression"))
def model_logistic(spark, folder):
    return _one_model(spark, folder, "LogisticRegression")


@query("model_predictions", f"SELECT dataset, model, player_id, churned, TRUE AS is_scored FROM {HELD_OUT_SQL}, {MODELS_SQL}")
def model_predictions(spark, folder):
    games = both_games(spark, folder)
    found = all_predictions(run_grid(spark, games), games)
    scored = F.col("score").between(0, 1) & F.col("prediction").isin(0, 1)
    return found.select("dataset", "model", "player_id", F.col("churned").cast("int").alias("churned"), scored.alias("is_scored"))


@query("feature_importance")
def feature_importance(spark, folder):
    return run_grid(spark, both_games(spark, folder)).importances


@query("model_grid", _metrics_sql())
def model_grid(spark, folder):
    """Both games and all three models with the main parameters."""
    return _checked(run_grid(spark, both_games(spark, folder)).metrics)


@query("model_grid_flat", _metrics_sql())
def model_grid_flat(spark, folder):
    """The plain parameters, with scaled features for the linear model only."""
    return _checked(run_grid(spark, both_games(spark, folder), ModelRegistry(FLAT_PARAMS), scale="linear").metrics)


@query(
    "model_leaderboard",
    f"""SELECT dataset, model, min(churned) <> max(churned) AS has_rank, 1 AS best_models
        FROM {HELD_OUT_SQL}, {MODELS_SQL} GROUP BY dataset, model""",
)
def model_leaderboard(spark, folder):
    """Ranks of all models, and how many count as the best of their game."""
    result = run_grid(spark, both_games(spark, folder), separately=True)
    board = leaderboard(widen_metrics(result.metrics.filter("error IS NULL"), "dataset", "model"))
    best = F.count_if("best_by_f1").over(Window.partitionBy("dataset"))
    return board.select("dataset", "model", F.col("auc_rank").isNotNull().alias("has_rank"), best.alias("best_models"))


@query("model_roundtrip", f"SELECT dataset, player_id, churned, TRUE AS same_score FROM {HELD_OUT_SQL}")
def model_roundtrip(spark, folder):
    """Predictions of a model and of its saved copy, side by side, for both games."""
    shown = []
    for data in both_games(spark, folder):
        matrix = training_matrix(data.train, fit_preparation(data.train))
        model = train_model(ModelRegistry().get("LogisticRegression"), matrix)
        matrix.release()
        path = scratch_path(spark, "model")
        save_model(model, path)
        again = load_model(path).predict(data.held_out).withColumnRenamed("score", "score_again")
        both = model.predict(data.held_out).join(again.drop("churned", "prediction"), "player_id")
        same = (F.col("score") == F.col("score_again")) & F.col("score").between(0, 1)
        shown.append(both.select(F.lit(data.name).alias("dataset"), "player_id", F.col("churned").cast("int").alias("churned"), same.alias("same_score")))
    return shown[0].unionByName(shown[1])
