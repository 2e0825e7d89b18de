"""Operators whose result is one row per event, and nested per-player records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from afterplay.functions.timing import iso_time, micros_between, window_bounds
from afterplay.operators.hot import DEFAULT_POLICY, SLICE, HotPolicy, Sliced, hot_players, slice_hot_players
from afterplay.operators.player_table import Horizon, with_windows


def first_events(events: DataFrame) -> DataFrame:
    """First time per player; combines map-side, so no player is too big."""
    return events.groupBy("player_id").agg(F.min("ts").alias("first_ts"))


def assign_windows(
    events: DataFrame, horizon: Horizon = Horizon(), policy: HotPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Each event with the window it falls in: ``op``, ``cp`` or null."""
    sliced = slice_hot_players(events, policy, ordered=False)
    return with_windows(sliced, horizon).select(*events.columns, "op_start", "phase")


def assign_to_bounds(events: DataFrame, bounds: DataFrame) -> DataFrame:
    """The same against a table of bounds per player, as an equi-join and a range test."""
    phase = F.when(F.col("ts").between(F.col("op_start"), F.col("op_end")), "op").when(
        (F.col("ts") > F.col("cp_start")) & (F.col("ts") <= F.col("cp_end")), "cp"
    )
    ends = bounds.select("player_id", "op_start", "op_end", "cp_start", "cp_end")
    return events.join(ends, "player_id").withColumn("phase", phase)


def time_ordered(
    events: DataFrame, where: Column | None = None, policy: HotPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Events with their 0-based ``position`` and the ``gap_seconds`` since the one before.

    Slices of a hot player are numbered on their own. What precedes a slice is one small
    row per slice.
    """
    chosen = events if where is None else events.filter(where)
    sliced = slice_hot_players(chosen, policy)
    order = Window.partitionBy(*sliced.keys).orderBy("ts", "pos")
    numbered = sliced.events.withColumn("position", F.row_number().over(order).cast("bigint") - 1).withColumn(
        "previous_ts", F.lag("ts").over(order)
    )
    if sliced.cuts is not None:
        line = Window.partitionBy("player_id").orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
        before = (
            sliced.events.join(sliced.cuts.select("player_id"), "player_id", "left_semi")
            .groupBy("player_id", SLICE)
            .agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("last_ts"))
            .select(
                "player_id",
                SLICE,
                F.sum("n").over(line).alias("rows_before"),
                F.last("last_ts", ignorenulls=True).over(line).alias("ts_before"),
            )
        )
        numbered = (
            numbered.join(before, ["player_id", SLICE], "left")
            .withColumn("position", F.col("position") + F.coalesce("rows_before", F.lit(0)))
            .withColumn("previous_ts", F.coalesce("previous_ts", "ts_before"))
        )
    gap = micros_between(F.col("ts"), F.col("previous_ts")) / 1e6
    return numbered.withColumn("gap_seconds", gap).select(*events.columns, "position", "gap_seconds")


def first_n_events(events: DataFrame, n: int) -> DataFrame:
    """The first ``n`` events per player. Spark keeps ``n`` rows a player before the shuffle."""
    order = Window.partitionBy("player_id").orderBy("ts", "pos")
    numbered = events.withColumn("position", F.row_number().over(order)).filter(F.col("position") <= n)
    return numbered.withColumn("position", F.col("position") - 1)


def detect_game(events: DataFrame, marker: Column, looked_at: int = 10) -> DataFrame:
    """``race`` for players with a marked event among their first ones, else ``score``."""
    return (
        first_n_events(events.withColumn("marked", F.coalesce(marker, F.lit(False))), looked_at)
        .groupBy("player_id")
        .agg(F.when(F.max("marked"), "race").otherwise("score").alias("game"))
    )


# A record is one line of text and one value in a task, so its length is limited.
RECORD_EVENTS = 1_000_000


def _refuse_long(events: DataFrame, most: int) -> None:
    """A history too long for one record is an error; it is never cut."""
    longest = hot_players(events, HotPolicy(rows_per_slice=most)).first()
    if longest is not None:
        raise ValueError(f"player {longest.player_id} has {longest.n} events; a record holds at most {most}")


def nest_events(events: DataFrame, *fields: str, most_events: int = RECORD_EVENTS) -> DataFrame:
    """One record per player with its events in time order, for interchange files only.

    A player with more than ``most_events`` events raises. Features never go this way.
    """
    _refuse_long(events, most_events)
    return (
        events.groupBy("player_id")
        .agg(_ordered(F.struct("ts", "pos", *fields)).alias("records"))
        .select("player_id", F.lit(0).alias("part"), "records")
    )


def _ordered(event: Column) -> Column:
    return F.transform(F.array_sort(F.collect_list(event)), lambda e: e.dropFields("pos"))


def nest_labelled_events(
    events: DataFrame,
    *fields: str,
    horizon: Horizon = Horizon(),
    most_events: int = RECORD_EVENTS,
) -> DataFrame:
    """Labelled records: the observed and the churn-window events as two ordered arrays."""
    _refuse_long(events, most_events)
    tagged = with_windows(Sliced(events), horizon)
    columns = ("op_start", "op_end", "cp_start", "cp_end", "op_event_count", "cp_event_count")

    def observed(phase: str) -> Column:
        return _ordered(F.when(F.col("phase") == phase, F.struct("ts", "pos", *fields)))

    arrays = [observed("op").alias("observation_records"), observed("cp").alias("churn_period_records")]
    nested = tagged.groupBy("player_id").agg(F.min("op_start").alias("op_start"), *arrays)
    bounds = window_bounds(F.col("op_start"), horizon.observation, horizon.churn)
    labelled = nested.select(
        "*",
        *[bounds[name].alias(name) for name in ("op_end", "cp_start", "cp_end")],
        F.size("observation_records").cast("bigint").alias("op_event_count"),
        F.size("churn_period_records").cast("bigint").alias("cp_event_count"),
    ).withColumn("churned", F.col("cp_event_count") == 0)
    return labelled.select(
        "player_id",
        F.lit(0).alias("part"),
        "observation_records",
        "churn_period_records",
        "churned",
        *[iso_time(F.col(c)).alias(c) for c in columns[:4]],
        *columns[4:],
    )
