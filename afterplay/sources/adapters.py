"""From raw logs to canonical event rows.

The position of an event within its player's log breaks ties between equal times, as a
stable sort would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from afterplay.functions.identity import has_player_id, resolve_player_id
from afterplay.functions.numbers import not_nan, variant_number
from afterplay.functions.timing import epoch_to_timestamp
from afterplay.sources.schemas import EVENT_COLUMNS

# The predicates are null for an event without a name, which every operator takes for false.
# Left as they are, they reach the scan when events are filtered by them.

# Names of the events that count as plays or purchases.
PLAY_EVENT = "play"
RACE_EVENT = "progress"
RACE_ACTION = "complete"
RACE_TYPE = "race"
PURCHASE_EVENTS = ("softPurchase", "hardPurchase", "purchase")


def is_score_play(event: Column) -> Column:
    return event == PLAY_EVENT


def is_race_play(event: Column, action: Column, kind: Column) -> Column:
    return (event == RACE_EVENT) & (action == RACE_ACTION) & (kind == RACE_TYPE)


def is_purchase(event: Column) -> Column:
    return event.isin(*PURCHASE_EVENTS)


def _canonical(df: DataFrame, **columns: Column) -> DataFrame:
    """Event rows; those that name no player are dropped, at the scan where it can be."""
    nothing = {
        "is_play": F.lit(False),
        "score": F.lit(None).cast("double"),
        "is_purchase": F.lit(False),
        "price": F.lit(None).cast("double"),
    }
    filled = nothing | columns
    rows = df.select(*[filled[name].alias(name) for name in EVENT_COLUMNS])
    return rows.filter(has_player_id(F.col("player_id")))


def events_from_score_csv(rows: DataFrame) -> DataFrame:
    """Rows ``device, score, time``; every row is a play.

    A CSV row has no number of its own, so rows with one device and time are ordered by
    score, which makes the result repeatable.
    """
    return _canonical(
        rows,
        player_id=F.col("device").cast("string"),
        ts=epoch_to_timestamp(F.col("time")),
        pos=F.col("score").cast("bigint"),
        event=F.lit(PLAY_EVENT),
        is_play=F.lit(True),
        score=F.col("score").cast("double"),
    )


def _exploded(players: DataFrame) -> DataFrame:
    return players.select(
        resolve_player_id(players).alias("player_id"), F.posexplode("records").alias("pos", "r")
    )


def events_from_score_logs(players: DataFrame) -> DataFrame:
    """Nested logs of the score game. A play without a numeric score is still a play."""
    rows = _exploded(players)
    score = F.col("r.score")
    numeric = variant_number(score) if isinstance(_field(rows, "score"), T.VariantType) else score.cast("double")
    return _canonical(
        rows,
        player_id=F.col("player_id"),
        ts=epoch_to_timestamp(F.col("r.time")),
        pos=F.col("pos").cast("bigint"),
        event=F.col("r.event"),
        is_play=is_score_play(F.col("r.event")),
        score=not_nan(numeric),
    )


def _field(rows: DataFrame, name: str) -> T.DataType:
    return rows.schema["r"].dataType[name].dataType


def events_from_race_logs(players: DataFrame) -> DataFrame:
    """Nested logs of the race game: plays are completed races, scores their rewards."""
    rows = _exploded(players)
    props = F.col("r.properties")
    event = F.col("r.event")
    bought = is_purchase(event)
    return _canonical(
        rows,
        player_id=F.col("player_id"),
        ts=epoch_to_timestamp(F.col("r.time")),
        pos=F.col("pos").cast("bigint"),
        event=event,
        is_play=is_race_play(
            event,
            F.try_variant_get(props, "$.action", "string"),
            F.try_variant_get(props, "$.type", "string"),
        ),
        score=not_nan(variant_number(props, "$.reward")),
        is_purchase=bought,
        price=F.when(bought, not_nan(variant_number(props, "$.price"))),
    )


def events_from_orders(orders: DataFrame) -> DataFrame:
    """Orders read as a score game: a customer is a player, an order a play."""
    return _canonical(
        orders,
        player_id=F.col("o_custkey").cast("string"),
        ts=F.col("o_orderdate").cast("timestamp"),
        pos=F.col("o_orderkey"),
        event=F.lit(PLAY_EVENT),
        is_play=F.lit(True),
        score=not_nan(F.col("o_totalprice")),
    )


def events_from_clicks(events: DataFrame, plays: tuple[str, ...] = ("view", "click")) -> DataFrame:
    """Web events read as a race game: some types are plays, ``purchase`` is a purchase."""
    kind = F.col("event_type")
    bought = is_purchase(kind)
    return _canonical(
        events,
        player_id=F.col("user_id").cast("string"),
        ts=F.col("ts").cast("timestamp"),
        pos=F.col("event_id"),
        event=kind,
        is_play=kind.isin(*plays),
        score=F.when(kind.isin(*plays), not_nan(F.col("value"))),
        is_purchase=bought,
        price=F.when(bought, not_nan(F.col("value"))),
    )
