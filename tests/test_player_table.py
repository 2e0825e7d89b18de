"""Hand-computed cases. Offsets are seconds after the first event."""

import math
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from afterplay.operators.hot import HotPolicy, slice_hot_players
from afterplay.operators.player_table import COMMON_FEATURES, Horizon, churn_labels, player_table
from afterplay.sources.schemas import EVENT

START = datetime(2015, 1, 13, 13, 55, 20, tzinfo=timezone.utc)
ALWAYS_SLICE = HotPolicy(rows_per_slice=3)

CASES = {
    "basic": [(0, 7), (600, 0), (4000, 7), (5800, 6)],
    "single": [(0, 9)],
    "on_op_end": [(0, 1), (432000, 2)],
    "after_op_end": [(0, 1), (432001, 2)],
    "on_cp_end": [(0, 1), (1296000, 2)],
    "after_cp_end": [(0, 1), (1296001, 2)],
    "zero_mean": [(0, -2), (10, 2)],
    "no_score": [(0, 4), (10, None), (20, 6)],
    "equal_times": [(0, 3), (0, 8), (0, 8)],
}


def play(player, pos, offset, score):
    return (player, START + timedelta(seconds=offset), pos, "play", True, score, False, None)


def other(player, pos, offset, event, price=None, bought=False):
    return (player, START + timedelta(seconds=offset), pos, event, False, None, bought, price)


@pytest.fixture(scope="module")
def events(spark):
    rows = []
    for player, plays in CASES.items():
        for pos, (offset, score) in enumerate(plays):
            rows.append(play(player, pos, offset, None if score is None else float(score)))
    rows.append(other("no_plays", 0, 0, "install"))
    rows += [
        other("buyer", 0, 0, "softPurchase", 400.0, True),
        other("buyer", 1, 5, "purchase", None, True),
        other("buyer", 2, 9, "hardPurchase", None, True),
    ]
    rows += [
        play("untimed", 0, 0, 1.0),
        ("untimed", None, 1, "play", True, 2.0, False, None),
    ]
    return spark.createDataFrame(rows, EVENT).repartition(3).cache()


@pytest.fixture(scope="module", params=["whole", "sliced", "decimal", "decimal_sliced"])
def table(request, events):
    horizon = Horizon(score_scale=2 if "decimal" in request.param else None)
    policy = ALWAYS_SLICE if "sliced" in request.param else HotPolicy()
    rows = player_table(events, horizon, purchases=True, policy=policy).collect()
    return {row.player_id: row.asDict() for row in rows}


def close(actual, **expected):
    for name, value in expected.items():
        assert math.isclose(actual[name], value, rel_tol=1e-9, abs_tol=1e-9), (name, actual[name], value)


def test_basic(table):
    close(
        table["basic"],
        playCount=4,
        bestScore=7,
        meanScore=5,
        worstScore=0,
        sdScore=math.sqrt(34 / 3),
        bestScoreIndex=0.5,
        bestSubMeanCount=0.5,
        bestSubMeanRatio=0.4,
        activeDuration=5800 / 3600,
        consecutivePlayRatio=2 / 3,
        churned=1,
    )


def test_single_event(table):
    close(table["single"], playCount=1, bestScore=9, meanScore=9, worstScore=9, churned=1)
    zeros = COMMON_FEATURES[4:]
    close(table["single"], **{name: 0 for name in zeros})


@pytest.mark.parametrize(
    "case,op,cp,churned",
    [
        ("on_op_end", 2, 0, 1),
        ("after_op_end", 1, 1, 0),
        ("on_cp_end", 1, 1, 0),
        ("after_cp_end", 1, 0, 1),
    ],
)
def test_window_ends(table, case, op, cp, churned):
    close(table[case], op_event_count=op, cp_event_count=cp, churned=churned)


def test_zero_mean(table):
    close(
        table["zero_mean"],
        bestSubMeanRatio=0,
        bestSubMeanCount=1,
        sdScore=math.sqrt(8),
        bestScoreIndex=0.5,
    )


def test_scores_and_plays_are_counted_apart(table):
    close(
        table["no_score"],
        playCount=3,
        meanScore=5,
        sdScore=math.sqrt(2),
        bestScoreIndex=0.5,
        bestSubMeanCount=0.5,
    )


def test_equal_times(table):
    close(table["equal_times"], bestScoreIndex=2 / 3, consecutivePlayRatio=1, activeDuration=0)


def test_no_plays(table):
    close(table["no_plays"], **{name: 0 for name in COMMON_FEATURES})
    close(table["no_plays"], purchaseCount=0, highestPrice=0, churned=1, op_event_count=1)


def test_purchases(table):
    close(table["buyer"], purchaseCount=3, highestPrice=400, playCount=0)


def test_player_with_untimed_event_is_skipped(table):
    assert "untimed" not in table


def test_labels_alone_equal_the_table(events):
    whole = churn_labels(events)
    sliced = churn_labels(events, policy=ALWAYS_SLICE)
    full = player_table(events).select(*whole.columns)
    assert whole.exceptAll(full).isEmpty() and full.exceptAll(whole).isEmpty()
    assert whole.exceptAll(sliced).isEmpty() and sliced.exceptAll(whole).isEmpty()


def test_censored_players_can_be_left_out(events):
    until = F.lit(START + timedelta(days=14)).cast("timestamp")
    assert churn_labels(events, observed_until=until).isEmpty()


def test_hot_player_is_spread(spark):
    n = 5_000
    rows = spark.range(n).select(
        F.lit("hot").alias("player_id"),
        F.timestamp_seconds(F.lit(1_421_157_320) + F.col("id") % 997).alias("ts"),
        F.col("id").alias("pos"),
        F.lit("play").alias("event"),
        F.lit(True).alias("is_play"),
        (F.col("id") % 13).cast("double").alias("score"),
        F.lit(False).alias("is_purchase"),
        F.lit(None).cast("double").alias("price"),
    )
    cold = rows.filter("pos % 10 = 0").withColumn(
        "player_id", F.concat(F.lit("p"), (F.col("pos") / 10).cast("int") % 50)
    )
    both = rows.unionByName(cold)
    policy = HotPolicy(rows_per_slice=500)
    sizes = [r["count"] for r in slice_hot_players(both, policy).events.groupBy("player_id", "slice").count().collect()]
    assert max(sizes) <= 1_000 and sum(sizes) == both.count()
    horizon = Horizon(gap=timedelta(seconds=0), score_scale=2)
    expected = player_table(both, horizon, policy=HotPolicy())
    actual = player_table(both, horizon, policy=policy)
    assert expected.exceptAll(actual).isEmpty() and actual.exceptAll(expected).isEmpty()


def test_one_exchange_without_hot_players(spark, sf_dir):
    from afterplay.sources.adapters import events_from_orders

    plan = player_table(events_from_orders(spark.read.parquet(f"{sf_dir}/orders.parquet")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1


def test_deviation_beyond_exact_digits(spark):
    from afterplay.operators.player_table import _decimal_deviation
    from afterplay.operators.stats import dataset_stats

    row = spark.createDataFrame([(4_000_000_000,)], "scores long").select(
        "scores",
        F.lit("10000000000").cast("decimal(28,2)").alias("total"),
        F.lit("41000000000").cast("decimal(38,4)").alias("squares"),
    )
    n = F.col("scores").cast("double")
    assert row.select(_decimal_deviation(n, 2).alias("sd")).first().sd == pytest.approx(2.0, rel=1e-9)
    counts = [(True, 300_000_000_000, 0), (False, 100_000_000_000, 0)]
    labels = spark.createDataFrame(counts, "churned boolean, op_event_count long, cp_event_count long")
    assert dataset_stats(labels, exact=True).first().op_std == pytest.approx(1e11)
