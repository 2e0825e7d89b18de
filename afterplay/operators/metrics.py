"""Classification metrics, rankings and importance tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from afterplay.functions.numbers import ratio_or_zero

# Metric names in report order; the first one ranks models.
METRICS = ("roc_auc", "accuracy", "precision", "recall", "f1_score")

CELLS = ("tp", "fp", "fn", "tn")

_BANDS = 256


def confusion(predictions: DataFrame, *by: str, label: str = "label", prediction: str = "prediction") -> DataFrame:
    truth, guess = F.col(label) == 1, F.col(prediction) == 1
    cells = [
        F.count_if(truth & guess).alias("tp"),
        F.count_if(~truth & guess).alias("fp"),
        F.count_if(truth & ~guess).alias("fn"),
        F.count_if(~truth & ~guess).alias("tn"),
    ]
    return predictions.groupBy(*by).agg(*cells) if by else predictions.agg(*cells)


def _threshold_metrics() -> list[Column]:
    """Accuracy, precision, recall and F1 of the four cells; a division by zero gives 0."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return [
        ratio_or_zero(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        ratio_or_zero(tp, tp + fp).alias("precision"),
        ratio_or_zero(tp, tp + fn).alias("recall"),
        ratio_or_zero(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
    ]


def classification_metrics(
    predictions: DataFrame, *by: str, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    cells = confusion(predictions, *by, label=label, prediction=prediction)
    return cells.select(*by, *CELLS, *_threshold_metrics())


def roc_auc(predictions: DataFrame, *by: str, label: str = "label", score: str = "score") -> DataFrame:
    """Exact area under the ROC curve; equal scores count half, one class alone gives null."""
    rows = predictions.withColumn("_none", F.lit(0))
    return evaluate(rows, *by, label=label, prediction="_none", score=score).select(*by, "roc_auc")


def evaluate(
    predictions: DataFrame, *by: str, label: str = "label", prediction: str = "prediction", score: str = "score"
) -> DataFrame:
    """One wide row per group with every metric, from one pass over the predictions.

    Rows shrink to counts per distinct score first. Each group has its scores banded by its own
    approximate quantiles, each band is summed up by a task of its own, and bands are
    joined with the number of positives above them: no task sees all scores. Rows without
    a score count for the threshold metrics only.
    """
    keys = list(by)
    truth, guess = F.col("y") == 1, F.col("p") == 1
    rows = predictions.select(
        *keys, F.col(label).alias("y"), F.col(prediction).alias("p"), F.col(score).cast("double").alias("s")
    ).filter(F.col("y").isNotNull())
    ranked = F.col("s").isNotNull()
    counts = rows.groupBy(*keys, "s").agg(
        F.count_if(ranked & truth).alias("pos"),
        F.count_if(ranked & ~truth).alias("neg"),
        F.count_if(truth & guess).alias("tp"),
        F.count_if(~truth & guess).alias("fp"),
        F.count_if(truth & ~guess).alias("fn"),
        F.count_if(~truth & ~guess).alias("tn"),
    )
    banded = _banded(counts, keys)
    inside = Window.partitionBy(*keys, "band").orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, -1)
    # Doubled, so that the halves for ties stay whole numbers.
    higher = 2 * F.coalesce(F.sum("pos").over(inside), F.lit(0)) + F.col("pos")
    twice = F.col("neg").cast("decimal(18,0)") * higher.cast("decimal(19,0)")
    sums = [F.sum(c).alias(c) for c in ("pos", "neg", *CELLS)]
    bands = (
        banded.withColumn("twice", twice.cast("decimal(38,0)"))
        .groupBy(*keys, "band")
        .agg(F.sum("twice").alias("twice"), *sums)
    )
    above = Window.partitionBy(*keys).orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, -1)
    joined = F.col("twice") + 2 * F.col("neg").cast("decimal(18,0)") * F.coalesce(
        F.sum("pos").over(above), F.lit(0)
    ).cast("decimal(18,0)")
    summed = bands.withColumn("twice", joined.cast("decimal(38,0)")).groupBy(*keys)
    totals = summed.agg(F.sum("twice").cast("double").alias("twice"), *sums)
    area = F.col("twice") / (2.0 * F.col("pos") * F.col("neg"))
    return totals.select(
        *keys,
        F.when((F.col("pos") > 0) & (F.col("neg") > 0), area).alias("roc_auc"),
        *_threshold_metrics(),
        *CELLS,
    )


def _banded(counts: DataFrame, keys: list[str]) -> DataFrame:
    """``counts`` with the band of each score: quantiles of the distinct scores of its own group.

    The cuts of a group are one row, joined to its scores; a group with far more scores than
    others is cut as finely as they are.
    """
    shares = [i / _BANDS for i in range(1, _BANDS)]
    sketch = F.array_distinct(F.percentile_approx("s", shares, 20 * _BANDS)) if shares else F.array()
    # without keys, all rows are one group
    group = [F.col(k) for k in keys] or [F.lit(0)]
    names = [f"_of{i}" for i in range(len(group))]
    cuts = counts.groupBy(*[g.alias(n) for g, n in zip(group, names)]).agg(sketch.alias("_cuts"))
    same = reduce(lambda a, b: a & b, [g.eqNullSafe(F.col(n)) for g, n in zip(group, names)])
    band = F.coalesce(F.size(F.filter("_cuts", lambda cut: cut < F.col("s"))), F.lit(0))
    return counts.join(cuts, same).withColumn("band", band).drop(*names, "_cuts")


def melt_metrics(wide: DataFrame, *by: str, metrics: tuple[str, ...] = METRICS) -> DataFrame:
    """Long form ``(*by, metric, value)``."""
    return wide.unpivot(list(by), list(metrics), "metric", "value")


def widen_metrics(long: DataFrame, *by: str, metrics: tuple[str, ...] = METRICS) -> DataFrame:
    """Wide form, one row per group; a metric that is missing is null."""
    return long.groupBy(*by).pivot("metric", list(metrics)).agg(F.first("value"))


def rank_models(wide: DataFrame, metric: str = METRICS[0]) -> DataFrame:
    """All (dataset, model) rows by one metric, best first; rows without it are left out.

    There is a row per trained model, so one task may order them.
    """
    order = Window.orderBy(F.desc(metric), "dataset", "model")
    return wide.filter(F.col(metric).isNotNull()).withColumn("rank", F.row_number().over(order))


def best_per_dataset(wide: DataFrame, metric: str = METRICS[0]) -> DataFrame:
    order = Window.partitionBy("dataset").orderBy(F.desc(metric), "model")
    return (
        wide.filter(F.col(metric).isNotNull())
        .withColumn("rank", F.row_number().over(order))
        .filter("rank = 1")
        .drop("rank")
    )


def best_per_metric(wide: DataFrame, metrics: tuple[str, ...] = METRICS) -> DataFrame:
    """For each metric the best model over all datasets."""
    order = Window.partitionBy("metric").orderBy(F.desc("value"), "dataset", "model")
    return (
        melt_metrics(wide, "dataset", "model", metrics=metrics)
        .filter(F.col("value").isNotNull())
        .withColumn("rank", F.row_number().over(order))
        .filter("rank = 1")
        .select("metric", "dataset", "model", "value")
    )


def leaderboard(wide: DataFrame) -> DataFrame:
    """Every model with its rank over all and within its dataset; unranked models come last."""
    overall = Window.orderBy(F.desc_nulls_last("roc_auc"), "dataset", "model")
    within = Window.partitionBy("dataset").orderBy(F.desc_nulls_last("f1_score"), "model")
    has_area = F.col("roc_auc").isNotNull()
    return wide.withColumn("auc_rank", F.when(has_area, F.row_number().over(overall))).withColumn(
        "best_by_f1", F.col("f1_score").isNotNull() & (F.row_number().over(within) == 1)
    )


def mean_importance(importances: DataFrame) -> DataFrame:
    return importances.groupBy("dataset", "feature").agg(F.avg("importance").alias("mean_importance"))


def top_features(importances: DataFrame, *by: str, value: str = "importance", k: int = 5) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc(value), "feature")
    return importances.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def importance_sorted(importances: DataFrame) -> DataFrame:
    return importances.orderBy(F.desc("importance"), "feature")
