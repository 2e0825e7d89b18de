"""Named queries keep their results when every player is cut and every score banded."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from afterplay.operators import hot, metrics
from afterplay.operators.events import assign_windows, time_ordered
from afterplay.operators.hot import HotPolicy, slice_hot_players
from afterplay.operators.player_table import churn_labels, player_table
from afterplay.plans.fragments import RACE
from afterplay.plans.queries_rows import race_events
from oracle import connect, difference

NAMES = (
    "churn_labels",
    "churn_labels_race_game",
    "features_score_game",
    "features_race_game",
    "feat_empty_defaults",
    "interval_assign",
    "event_position",
    "event_gaps",
    "evaluate_models",
    "roc_auc",
    "dataset_stats",
    "nest_player_events",
    "nest_labelled_events",
    "sink_jsonl_roundtrip",
    "validate_players",
    "scan_jsonl_strict",
    "feature_error_rate",
    "scan_jsonl_malformed",
    "scan_jsonl_players",
)


@pytest.fixture
def forced(monkeypatch):
    before = dict(vars(hot.DEFAULT_POLICY))
    vars(hot.DEFAULT_POLICY).update(rows_per_slice=15)
    monkeypatch.setattr(metrics, "_BANDS", 7)
    yield
    vars(hot.DEFAULT_POLICY).update(before)


@pytest.mark.parametrize("name", NAMES)
def test_same_rows(name, spark, sf_dir, forced):
    frame = contract.queries()[name](spark, sf_dir)
    assert difference(frame, connect(sf_dir), contract.oracle_sql()[name]) is None


@pytest.fixture(scope="module")
def one_time(spark, sf_dir):
    """A player with 3000 events at one time and some around it, besides the others; places in no order of rows."""
    events = race_events(spark, sf_dir).cache()
    first = events.agg(F.min("ts")).first()[0]
    n = F.col("id")
    many = spark.range(3200).select(
        F.lit("crowd").alias("player_id"),
        (F.lit(first) + F.make_dt_interval(F.when(n < 100, 0).when(n < 3100, 1).otherwise(n % 9))).alias("ts"),
        F.pmod(n * 7919, F.lit(3203)).alias("pos"),
        F.when(n % 3 == 0, "purchase").otherwise("play").alias("event"),
        (n % 3 != 0).alias("is_play"),
        F.when(n % 3 != 0, (n * 31) % 97).cast("double").alias("score"),
        (n % 3 == 0).alias("is_purchase"),
        F.when(n % 3 == 0, n % 5).cast("double").alias("price"),
    )
    kinds = {f.name: f.dataType for f in events.schema}
    return events.unionByName(many.select(*[F.col(c).cast(kinds[c]).alias(c) for c in events.columns])).cache()


def same(left, right):
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_one_time_is_cut_by_place(one_time):
    policy = HotPolicy(rows_per_slice=100)
    crowd = one_time.filter("player_id = 'crowd'")
    for ordered in (True, False):
        sizes = [r["count"] for r in slice_hot_players(crowd, policy, ordered).events.groupBy(hot.SLICE).count().collect()]
        assert len(sizes) >= 30 and max(sizes) <= 250
    cut = slice_hot_players(crowd, policy).events
    ends = cut.groupBy(hot.SLICE).agg(F.min(F.struct("ts", "pos")).alias("a"), F.max(F.struct("ts", "pos")).alias("b"))
    ends = sorted((tuple(r.a), tuple(r.b)) for r in ends.collect())
    assert all(before[1] < after[0] for before, after in zip(ends, ends[1:]))


def test_cuts_within_one_time_change_no_result(one_time):
    policy = HotPolicy(rows_per_slice=100)
    assert same(churn_labels(one_time, RACE), churn_labels(one_time, RACE, policy))
    assert same(player_table(one_time, RACE, True), player_table(one_time, RACE, True, policy))
    assert same(assign_windows(one_time, RACE), assign_windows(one_time, RACE, policy))
    assert same(time_ordered(one_time), time_ordered(one_time, policy=policy))
