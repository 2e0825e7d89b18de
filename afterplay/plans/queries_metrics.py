"""Metric and ranking queries on predictions that need no trained model.

Three rules of thumb stand in for models: each scores a player by one feature and
predicts churn above a threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from afterplay.functions.numbers import round_half_up
from afterplay.operators.metrics import (
    METRICS,
    best_per_dataset,
    best_per_metric,
    classification_metrics,
    evaluate,
    importance_sorted,
    leaderboard,
    mean_importance,
    melt_metrics,
    rank_models,
    roc_auc,
    top_features,
    widen_metrics,
)
from afterplay.operators.player_table import COMMON_FEATURES
from afterplay.plans.fragments import (
    RACE,
    RACE_EVENTS,
    feature_ctes,
    rounded,
    score_features,
)
from afterplay.plans.queries_rows import race_table, rounded_columns, score_table
from afterplay.plans.registry import query, table

# Name of the rule: score expression, threshold of the prediction.
RULES = {
    "few_plays": ('-"playCount"', -2),
    "short_activity": ('-"activeDuration"', -1000),
    "low_best": ('-"bestScore"', -100000),
}


def _auc_sql(rows: str) -> str:
    """Rank sum with mean ranks for ties, per dataset and model."""
    return f"""SELECT dataset, model, CASE WHEN sum(label) > 0 AND sum(1 - label) > 0 THEN
        (sum(CASE WHEN label = 1 THEN mean_rank END) - sum(label) * (sum(label) + 1) / 2.0)
        / (CAST(sum(label) AS DOUBLE) * sum(1 - label)) END AS roc_auc
        FROM (SELECT *, rank() OVER (PARTITION BY dataset, model ORDER BY score)
              + (count(*) OVER (PARTITION BY dataset, model, score) - 1) / 2.0 AS mean_rank FROM {rows})
        GROUP BY dataset, model"""


_PREDICTED_SQL = " UNION ALL ".join(
    f"""SELECT '{dataset}' AS dataset, '{model}' AS model, CAST(churned AS INTEGER) AS label,
        {score} AS score, CAST({score} >= {threshold} AS INTEGER) AS prediction FROM {features}"""
    for dataset, features in (("score", "features"), ("race", "race_features"))
    for model, (score, threshold) in RULES.items()
)
PREDICTIONS_SQL = f"""WITH {score_features()}, {feature_ctes(RACE_EVENTS, RACE, 'race_')},
    predicted AS ({_PREDICTED_SQL}),
    cells AS (SELECT dataset, model, count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
        count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
        count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn,
        count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn FROM predicted GROUP BY dataset, model),
    areas AS ({_auc_sql('predicted')}),
    wide AS (SELECT c.dataset, c.model, {rounded('a.roc_auc')} AS roc_auc,
        {rounded('(tp + tn) / (tp + tn + fp + fn)')} AS accuracy,
        {rounded('CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END')} AS "precision",
        {rounded('CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END')} AS recall,
        {rounded('CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END')} AS f1_score
        FROM cells c JOIN areas a ON c.dataset = a.dataset AND c.model = a.model)"""


def _rows_of(game: str, features: DataFrame) -> DataFrame:
    """The predictions of all rules, three per player, from one pass over the features."""
    cases = []
    for model, (expression, threshold) in RULES.items():
        score = F.expr(expression.replace('"', "`")).cast("double")
        cases.append(
            F.struct(
                F.lit(model).alias("model"),
                score.alias("score"),
                (score >= threshold).cast("int").alias("prediction"),
            )
        )
    rows = features.select(F.col("churned").cast("int").alias("label"), F.explode(F.array(*cases)).alias("r"))
    return rows.select(F.lit(game).alias("dataset"), "r.model", "label", "r.score", "r.prediction")


def predictions(spark, folder) -> DataFrame:
    score, race = score_table(spark, folder), race_table(spark, folder)
    return _rows_of("score", score).unionByName(_rows_of("race", race))


def wide_metrics(spark, folder) -> DataFrame:
    wide = evaluate(predictions(spark, folder), "dataset", "model")
    return wide.select("dataset", "model", *rounded_columns(*METRICS))


@query(
    "classification_metrics",
    f"""SELECT count(*) FILTER (WHERE quality = 1 AND toxic = 1) AS tp,
               count(*) FILTER (WHERE quality = 0 AND toxic = 1) AS fp,
               count(*) FILTER (WHERE quality = 1 AND toxic = 0) AS fn,
               count(*) FILTER (WHERE quality = 0 AND toxic = 0) AS tn,
               {rounded('avg(CAST(quality = toxic AS INTEGER))')} AS accuracy,
               {rounded('count(*) FILTER (WHERE quality = 1 AND toxic = 1) / count(*) FILTER (WHERE toxic = 1)')}
                   AS "precision",
               {rounded('count(*) FILTER (WHERE quality = 1 AND toxic = 1) / count(*) FILTER (WHERE quality = 1)')}
                   AS recall,
               {rounded('2 * count(*) FILTER (WHERE quality = 1 AND toxic = 1) / (count(*) FILTER (WHERE toxic = 1) + count(*) FILTER (WHERE quality = 1))')}
                   AS f1_score FROM labels""",
)
def classification_metrics_query(spark, folder):
    found = classification_metrics(table(spark, folder, "labels"), label="quality", prediction="toxic")
    return found.select("tp", "fp", "fn", "tn", *rounded_columns("accuracy", "precision", "recall", "f1_score"))


_SCORED_DOCUMENTS = """(SELECT d.lang AS dataset, 'length' AS model, l.quality AS label, d.n_chars AS score
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


@query("roc_auc", f"SELECT dataset, model, {rounded('roc_auc')} AS roc_auc FROM ({_auc_sql(_SCORED_DOCUMENTS)})")
def roc_auc_query(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", F.col("lang").alias("dataset"), "n_chars")
    joined = documents.join(table(spark, folder, "labels"), "doc_id").withColumn("model", F.lit("length"))
    areas = roc_auc(joined, "dataset", "model", label="quality", score="n_chars")
    return areas.select("dataset", "model", *rounded_columns("roc_auc"))


@query("evaluate_models", f"{PREDICTIONS_SQL} SELECT * FROM wide")
def evaluate_models(spark, folder):
    return wide_metrics(spark, folder)


@query(
    "metrics_long",
    f"""{PREDICTIONS_SQL} SELECT dataset, model, 'roc_auc' AS metric, roc_auc AS value FROM wide
        UNION ALL SELECT dataset, model, 'accuracy', accuracy FROM wide
        UNION ALL SELECT dataset, model, 'precision', "precision" FROM wide
        UNION ALL SELECT dataset, model, 'recall', recall FROM wide
        UNION ALL SELECT dataset, model, 'f1_score', f1_score FROM wide""",
)
def metrics_long(spark, folder):
    return melt_metrics(wide_metrics(spark, folder), "dataset", "model")


@query(
    "model_ranking",
    f"""{PREDICTIONS_SQL} SELECT *, row_number() OVER (ORDER BY roc_auc DESC, dataset, model) AS "rank"
        FROM wide WHERE roc_auc IS NOT NULL""",
)
def model_ranking(spark, folder):
    return rank_models(wide_metrics(spark, folder))


def _best_sql(metric: str) -> str:
    return f"""{PREDICTIONS_SQL} SELECT dataset, model, roc_auc, accuracy, "precision", recall, f1_score
        FROM (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY {metric} DESC, model) AS rn FROM wide
              WHERE {metric} IS NOT NULL) WHERE rn = 1"""


@query("best_model_per_dataset", _best_sql("roc_auc"))
def best_model_per_dataset(spark, folder):
    return best_per_dataset(wide_metrics(spark, folder))


@query("best_model_f1", _best_sql("f1_score"))
def best_model_f1(spark, folder):
    return best_per_dataset(wide_metrics(spark, folder), "f1_score")


@query(
    "best_model_per_metric",
    " UNION ALL ".join(
        f"""(SELECT '{m}' AS metric, dataset, model, "{m}" AS value FROM (SELECT * FROM ({PREDICTIONS_SQL}
             SELECT * FROM wide)) ORDER BY "{m}" DESC, dataset, model LIMIT 1)"""
        for m in METRICS
    ),
)
def best_model_per_metric(spark, folder):
    return best_per_metric(wide_metrics(spark, folder))


@query(
    "leaderboard",
    f"""{PREDICTIONS_SQL} SELECT *, row_number() OVER (ORDER BY roc_auc DESC, dataset, model) AS auc_rank,
        row_number() OVER (PARTITION BY dataset ORDER BY f1_score DESC, model) = 1 AS best_by_f1 FROM wide""",
)
def leaderboard_query(spark, folder):
    long = melt_metrics(wide_metrics(spark, folder), "dataset", "model")
    return leaderboard(widen_metrics(long, "dataset", "model"))


# Importance: how far a feature separates the classes, by two measures.
IMPORTANCE_MEASURES = {
    "correlation": 'abs(corr("{f}", CAST(churned AS INTEGER)))',
    "mean_shift": """abs(avg("{f}") FILTER (WHERE churned) - avg("{f}") FILTER (WHERE NOT churned))
        / stddev_pop("{f}")""",
}
_IMPORTANCE_SQL = " UNION ALL ".join(
    f"""SELECT '{dataset}' AS dataset, '{model}' AS model, '{f}' AS feature,
        {rounded(measure.replace('{f}', f))} AS importance FROM {features}"""
    for dataset, features in (("score", "features"), ("race", "race_features"))
    for model, measure in IMPORTANCE_MEASURES.items()
    for f in COMMON_FEATURES
)
IMPORTANCES_SQL = f"""WITH {score_features()}, {feature_ctes(RACE_EVENTS, RACE, 'race_')},
    importances AS ({_IMPORTANCE_SQL})"""


def importances(spark, folder) -> DataFrame:
    """One pass per game for all features and measures."""
    both = None
    for dataset, features in (("score", score_table(spark, folder)), ("race", race_table(spark, folder))):
        churned = F.col("churned")
        aggregates, rows = [], []
        for f in COMMON_FEATURES:
            shift = F.avg(F.when(churned, F.col(f))) - F.avg(F.when(~churned, F.col(f)))
            values = {
                "correlation": F.abs(F.corr(F.col(f), churned.cast("int"))),
                "mean_shift": F.abs(shift) / F.stddev_pop(f),
            }
            for model, value in values.items():
                aggregates.append(round_half_up(value).alias(f"{model}_{f}"))
                rows.append(
                    F.struct(
                        F.lit(dataset).alias("dataset"),
                        F.lit(model).alias("model"),
                        F.lit(f).alias("feature"),
                        F.col(f"{model}_{f}").alias("importance"),
                    )
                )
        part = features.agg(*aggregates).select(F.inline(F.array(*rows)))
        both = part if both is None else both.unionByName(part)
    return both


@query("feature_separation", f"{IMPORTANCES_SQL} SELECT * FROM importances")
def feature_separation(spark, folder):
    return importances(spark, folder)


_MEAN_SQL = f"""SELECT dataset, feature, {rounded('avg(importance)')} AS mean_importance
    FROM importances GROUP BY dataset, feature"""


def _means(spark, folder) -> DataFrame:
    means = mean_importance(importances(spark, folder))
    return means.select("dataset", "feature", *rounded_columns("mean_importance"))


@query("mean_importance", f"{IMPORTANCES_SQL} {_MEAN_SQL}")
def mean_importance_query(spark, folder):
    return _means(spark, folder)


@query(
    "top_features_model",
    f"""{IMPORTANCES_SQL} SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dataset, model
        ORDER BY importance DESC, feature) AS "rank" FROM importances) WHERE "rank" <= 5""",
)
def top_features_model(spark, folder):
    return top_features(importances(spark, folder), "dataset", "model")


@query(
    "top_features_dataset",
    f"""{IMPORTANCES_SQL}, means AS ({_MEAN_SQL})
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY mean_importance DESC, feature)
        AS "rank" FROM means) WHERE "rank" <= 5""",
)
def top_features_dataset(spark, folder):
    return top_features(_means(spark, folder), "dataset", value="mean_importance")


@query("importance_sorted", f"{IMPORTANCES_SQL} SELECT * FROM importances ORDER BY importance DESC, feature")
def importance_sorted_query(spark, folder):
    return importance_sorted(importances(spark, folder))
