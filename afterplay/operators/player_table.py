"""Labels and features of every player in one pass over the events.

With no hot players the plan has one exchange by player and one sort, shared by the window
and the aggregate. With hot players the same stage runs on ``(player_id, slice)`` and a second,
small exchange merges one partial row per slice.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from afterplay.functions.numbers import ratio_or_zero
from afterplay.functions.timing import (
    CHURN_PERIOD,
    MICROS_PER_HOUR,
    OBSERVATION,
    iso_time,
    micros_between,
    micros_of,
    window_bounds,
)
from afterplay.operators.hot import DEFAULT_POLICY, SLICE, HotPolicy, Sliced, slice_hot_players

# Names of the features, in the order of the feature file.
COMMON_FEATURES = (
    "playCount",
    "bestScore",
    "meanScore",
    "worstScore",
    "sdScore",
    "bestScoreIndex",
    "bestSubMeanCount",
    "bestSubMeanRatio",
    "activeDuration",
    "consecutivePlayRatio",
)
PURCHASE_FEATURES = ("purchaseCount", "highestPrice")
CONSECUTIVE_GAP = timedelta(minutes=30)


@dataclass(frozen=True)
class Horizon:
    """Window lengths and the largest pause between consecutive plays.

    ``score_scale`` sums scores as exact decimals of that many digits, which gives the
    same mean and deviation whatever the order of the rows, and suits money-like scores.
    Without it, doubles are summed and deviations are merged in
    the stable way.
    """

    observation: timedelta = OBSERVATION
    churn: timedelta = CHURN_PERIOD
    gap: timedelta = CONSECUTIVE_GAP
    score_scale: int | None = None


def with_windows(sliced: Sliced, horizon: Horizon) -> DataFrame:
    """Each event with its player's window start and its ``phase``: ``op``, ``cp`` or null."""
    first = _first_time(sliced, F.min("ts").over(Window.partitionBy(*sliced.keys)))
    started = sliced.events.withColumn("op_start", first)
    return started.withColumn("phase", _phase(horizon))


def _first_time(sliced: Sliced, of_group: Column) -> Column:
    """A hot player's first time is known; else it is that of the group."""
    return of_group if sliced.cuts is None else F.coalesce("hot_first_ts", of_group)


def _phase(horizon: Horizon) -> Column:
    bounds = window_bounds(F.col("op_start"), horizon.observation, horizon.churn)
    return phase_of(F.col("ts"), bounds["op_end"], bounds["cp_end"])


def phase_of(ts: Column, op_end: Column, cp_end: Column) -> Column:
    """Closed at the end of each window; the churn window is open at its start."""
    return F.when(ts <= op_end, "op").when(ts <= cp_end, "cp")


def _label_partials() -> list[Column]:
    return [
        F.min("op_start").alias("op_start"),
        F.count_if(F.col("phase") == "op").alias("op_event_count"),
        F.count_if(F.col("phase") == "cp").alias("cp_event_count"),
        F.count_if(F.col("ts").isNull()).alias("untimed"),
    ]


def _merge_label_partials() -> list[Column]:
    return [
        F.min("op_start").alias("op_start"),
        *[F.sum(c).alias(c) for c in ("op_event_count", "cp_event_count", "untimed")],
    ]


# A player with an event that has no time cannot be labelled and is left out.
LABELLED = "untimed = 0 AND op_event_count > 0"


def _finished_labels(horizon: Horizon) -> list[Column]:
    bounds = window_bounds(F.col("op_start"), horizon.observation, horizon.churn)
    return [
        F.col("player_id"),
        (F.col("cp_event_count") == 0).alias("churned"),
        *[end.alias(name) for name, end in bounds.items()],
        F.col("op_event_count"),
        F.col("cp_event_count"),
    ]


def churn_labels(
    events: DataFrame,
    horizon: Horizon = Horizon(),
    policy: HotPolicy = DEFAULT_POLICY,
    observed_until: Column | None = None,
) -> DataFrame:
    """One row per player: window bounds, event counts and whether the player stayed away.

    ``observed_until`` drops the players whose churn window ends after the logs do.
    """
    # the place only spreads the rows of a hot player
    needed = [c for c in ("player_id", "ts", "pos") if c in events.columns]
    sliced = slice_hot_players(events.select(*needed), policy, ordered=False)
    merged = with_windows(sliced, horizon).groupBy(*sliced.keys).agg(*_label_partials())
    if sliced.cuts is not None:
        merged = merged.groupBy("player_id").agg(*_merge_label_partials())
    labels = merged.filter(LABELLED).select(*_finished_labels(horizon))
    return labels if observed_until is None else labels.filter(F.col("cp_end") <= observed_until)


def label_job_counts(players: DataFrame, labels: DataFrame) -> DataFrame:
    """How many of the players were labelled and how many were skipped."""
    total = players.agg(F.count(F.lit(1)).alias("n"))
    done = labels.agg(F.count(F.lit(1)).alias("n"))
    both = total.select(F.col("n"), F.lit(0).alias("d")).unionAll(done.select(F.lit(0).alias("n"), F.col("n")))
    return both.agg(F.sum("d").alias("processed"), (F.sum("n") - F.sum("d")).alias("skipped"))


def _marked(sliced: Sliced, horizon: Horizon) -> DataFrame:
    """Events with all the order-dependent columns, from one sort and one window pass.

    Observed events come first in a player's time line, so what precedes an observed event
    is observed as well: the window needs no knowledge of where the observation ends.
    """
    order = Window.partitionBy(*sliced.keys).orderBy("ts", "pos")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    ordered = sliced.events.select(
        "*",
        _first_time(sliced, F.min("ts").over(so_far)).alias("op_start"),
        F.last("play_ts", ignorenulls=True).over(earlier).alias("previous_play"),
        F.count("score").over(so_far).alias("score_number"),
        F.max("score").over(so_far).alias("best_so_far"),
    )
    return ordered.withColumn("phase", _phase(horizon))


def _shuffled_columns(events: DataFrame) -> DataFrame:
    """What the exchange carries: the time of a play stands for the play itself."""
    return events.select(
        "player_id",
        "ts",
        "pos",
        F.when(F.col("is_play"), F.col("ts")).alias("play_ts"),
        F.when(F.col("is_play"), F.col("score")).alias("score"),
        "is_purchase",
        "price",
    )


def _feature_partials(horizon: Horizon) -> list[Column]:
    observed = F.col("phase") == "op"
    play_ts = F.when(observed, F.col("play_ts"))
    score = F.when(observed, F.col("score"))
    bought = observed & F.col("is_purchase")
    pause = micros_between(play_ts, F.col("previous_play"))
    partials = [
        F.count(play_ts).alias("plays"),
        F.count(score).alias("scores"),
        F.max(score).alias("best"),
        # The last score that no earlier one exceeds is the last of the best ones.
        F.max(F.when(score == F.col("best_so_far"), F.col("score_number"))).alias("best_at"),
        F.min(score).alias("worst"),
        F.min(play_ts).alias("first_play"),
        F.max(play_ts).alias("last_play"),
        F.count_if(pause <= micros_of(horizon.gap)).alias("close_plays"),
        F.count_if(bought).alias("purchases"),
        F.max(F.when(bought & (F.col("price") > 0), F.col("price"))).alias("top_price"),
    ]
    if horizon.score_scale is None:
        return [*partials, F.avg(score).alias("mean"), F.var_pop(score).alias("spread")]
    amount = score.cast(f"decimal(18,{horizon.score_scale})")
    return [*partials, F.sum(amount).alias("total"), F.sum(amount * amount).alias("squares")]


def _merge_feature_partials(partials: DataFrame, horizon: Horizon) -> DataFrame:
    """Join the slices of a player: shift score numbers, count the pauses at the seams."""
    line = Window.partitionBy("player_id").orderBy(SLICE)
    earlier = line.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("player_id")
    ordered = partials.select(
        "*",
        F.coalesce(F.sum("scores").over(earlier), F.lit(0)).alias("scores_before"),
        F.last("last_play", ignorenulls=True).over(earlier).alias("last_before"),
    )
    best_at = F.when(
        F.col("best").isNotNull(),
        F.struct("best", (F.col("best_at") + F.col("scores_before")).alias("at")),
    )
    seam = micros_between(F.col("first_play"), F.col("last_before")) <= micros_of(horizon.gap)
    merges = [
        *_merge_label_partials(),
        *[F.sum(c).alias(c) for c in ("plays", "scores", "purchases")],
        F.max("best").alias("best"),
        F.max(best_at)["at"].alias("best_at"),
        F.min("worst").alias("worst"),
        F.min("first_play").alias("first_play"),
        F.max("last_play").alias("last_play"),
        (F.sum("close_plays") + F.count_if(seam)).alias("close_plays"),
        F.max("top_price").alias("top_price"),
    ]
    if horizon.score_scale is None:
        weight = F.col("scores").cast("double")
        ordered = ordered.withColumn(
            "joint_mean", F.sum(F.col("mean") * weight).over(whole) / F.sum(weight).over(whole)
        )
        offset = F.col("mean") - F.col("joint_mean")
        merges += [
            F.max("joint_mean").alias("mean"),
            (F.sum((F.col("spread") + offset * offset) * weight) / F.sum(weight)).alias("spread"),
        ]
    else:
        merges += [F.sum("total").alias("total"), F.sum("squares").alias("squares")]
    return ordered.groupBy("player_id").agg(*merges)


def _decimal_deviation(n: Column, scale: int) -> Column:
    """From exact sums where all digits fit, else (beyond 10^9 scores) from their doubles."""
    count = F.col("scores").try_cast("decimal(9,0)")
    total = F.col("total").try_cast(f"decimal(18,{scale})")
    squares = F.col("squares").try_cast(f"decimal(28,{2 * scale})")
    exact = (count * squares - total * total).cast("double") / (n * (n - 1))
    mean = F.col("total").cast("double") / n
    close = (F.col("squares").cast("double") / n - mean * mean) * n / (n - 1)
    return F.sqrt(F.coalesce(exact, F.greatest(close, F.lit(0.0))))


def _finished_features(horizon: Horizon, purchases: bool) -> list[Column]:
    scores, plays = F.col("scores"), F.col("plays")
    n = scores.cast("double")
    best, worst = (F.coalesce(c, F.lit(0.0)) for c in ("best", "worst"))
    if horizon.score_scale is None:
        mean = F.coalesce("mean", F.lit(0.0))
        deviation = F.sqrt(F.col("spread") * n / (n - 1))
    else:
        mean = ratio_or_zero(F.coalesce("total", F.lit(0)), scores)
        deviation = _decimal_deviation(n, horizon.score_scale)
    hours = micros_between(F.col("last_play"), F.col("first_play")).cast("double") / MICROS_PER_HOUR

    def if_several(count: Column, value: Column) -> Column:
        return F.when(count > 1, value).otherwise(0.0)

    features = {
        "playCount": plays,
        "bestScore": best,
        "meanScore": mean,
        "worstScore": worst,
        "sdScore": if_several(scores, deviation),
        "bestScoreIndex": if_several(scores, (F.col("best_at") - 1).cast("double") / n),
        "bestSubMeanCount": F.when(scores > 0, (best - mean) / n).otherwise(0.0),
        "bestSubMeanRatio": ratio_or_zero(best - mean, mean),
        "activeDuration": if_several(plays, hours),
        "consecutivePlayRatio": if_several(plays, F.col("close_plays").cast("double") / (plays - 1)),
        "purchaseCount": F.col("purchases"),
        "highestPrice": F.coalesce("top_price", F.lit(0.0)),
    }
    return [features[name].alias(name) for name in feature_names(purchases)]


def feature_names(purchases: bool) -> tuple[str, ...]:
    return COMMON_FEATURES + PURCHASE_FEATURES if purchases else COMMON_FEATURES


def player_table(
    events: DataFrame,
    horizon: Horizon = Horizon(),
    purchases: bool = False,
    policy: HotPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Label columns and features of every player. Players without plays keep zeros."""
    sliced = slice_hot_players(_shuffled_columns(events), policy)
    merged = _marked(sliced, horizon).groupBy(*sliced.keys).agg(*_label_partials(), *_feature_partials(horizon))
    if sliced.cuts is not None:
        merged = _merge_feature_partials(merged, horizon)
    return merged.filter(LABELLED).select(*_finished_labels(horizon), *_finished_features(horizon, purchases))


def feature_table(table: DataFrame, purchases: bool = False, metadata: bool = False) -> DataFrame:
    """The projection that models read: id, 0/1 target, features."""
    extra = [iso_time(F.col(c)).alias(c) for c in ("op_start", "op_end")] if metadata else []
    counts = ["op_event_count"] if metadata else []
    return table.select(
        "player_id",
        F.col("churned").cast("int").alias("churned"),
        *feature_names(purchases),
        *extra,
        *counts,
    )
