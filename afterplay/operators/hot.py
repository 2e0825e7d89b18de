"""Splitting the players that are too big for one task.

Window functions and per-player aggregates need a player's events together. One player
may own a large share of all rows, so such players are cut into *slices*: consecutive
ranges of their own time line with about equal row counts. Every operator then works on
``(player_id, slice)`` and merges the slices of a player afterwards, one small row each.

* One count per player (combined map-side) finds the players with more than
  ``rows_per_slice`` rows. All of them are cut; file sizes play no part.
* Where order within a player does not matter, the first time from that same count is all
  that is needed, and a hash of time and place spreads the rows instead.
* The cut points are approximate quantiles of the time and, where one time holds several of
  them, of the places within that time: pairs ``(ts, pos)`` in the order in which events follow
  each other. They come to the driver once, about one pair for ``rows_per_slice`` rows, and go
  out as a literal relation. So a task that is run again sees the same slices. Spark decides by
  its size how it is joined. Only rows with the same time and place cannot be told apart.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

SLICE = "slice"
_STEP = 24
# behind every place of a time
_LAST_PLACE = 2**63 - 1


@dataclass(frozen=True)
class HotPolicy:
    rows_per_slice: int = 2_000_000


DEFAULT_POLICY = HotPolicy()


@dataclass(frozen=True)
class Sliced:
    """Events with the keys that hold a bounded number of rows each.

    ``cuts`` has one row per hot player with its first time, its number of rows and, for
    ordered slices, its cut points. It is ``None`` when no player had to be cut; then there
    is no slice column.
    """

    events: DataFrame
    cuts: DataFrame | None = None

    @property
    def keys(self) -> list[str]:
        return ["player_id"] if self.cuts is None else ["player_id", SLICE]


def hot_players(events: DataFrame, policy: HotPolicy = DEFAULT_POLICY) -> DataFrame:
    """The players above the row limit with row count and first time."""
    return (
        events.groupBy("player_id")
        .agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"))
        .filter(F.col("n") > policy.rows_per_slice)
    )


def slice_hot_players(
    events: DataFrame, policy: HotPolicy = DEFAULT_POLICY, ordered: bool = True
) -> Sliced:
    """Add the slice of each row, if any player is hot. ``ordered`` slices are ranges of (ts, pos)."""
    spark = events.sparkSession
    hot_rows = hot_players(events, policy).collect()
    if not hot_rows:
        return Sliced(events)

    hot_schema = "player_id string, n bigint, first_ts timestamp"
    hot = spark.createDataFrame(hot_rows, hot_schema)
    largest = max(row.n for row in hot_rows)
    slices = -(-largest // policy.rows_per_slice)
    if not ordered:
        known = hot.select("player_id", F.col("first_ts").alias("hot_first_ts"))
        salted = [c for c in ("ts", "pos") if c in events.columns]
        salt = F.pmod(F.xxhash64(*salted), F.lit(slices)).cast("int")
        number = F.when(F.col("hot_first_ts").isNull(), 0).otherwise(salt)
        return Sliced(events.join(known, "player_id", "left").withColumn(SLICE, number), hot)
    shares = [i / slices for i in range(1, slices)]
    quantiles = (
        events.select("player_id", F.unix_micros("ts").alias("us"))
        .join(hot.select("player_id"), "player_id")
        .groupBy("player_id")
        .agg(F.percentile_approx("us", shares, 20 * slices).alias("us"))
    )
    times = {row.player_id: list(row.us or ()) for row in quantiles.collect()}
    places = _places_within(events, times)
    points = []
    for player, us in times.items():
        fine = sorted({(u, p) for u in us for p in (*places.get((player, u), ()), _LAST_PLACE)})
        points.append((player, fine[_STEP - 1 :: _STEP], fine))
    pairs = "array<struct<us:bigint,pos:bigint>>"
    cut_schema = f"player_id string, coarse {pairs}, fine {pairs}"
    cuts = hot.join(spark.createDataFrame(points, cut_schema), "player_id")
    tagged = events.join(
        cuts.select("player_id", F.col("first_ts").alias("hot_first_ts"), "coarse", "fine"),
        "player_id",
        "left",
    )
    return Sliced(
        tagged.withColumn(SLICE, _slice_number(F.unix_micros("ts"), F.col("pos"))).drop("coarse", "fine"), cuts
    )


def _places_within(events: DataFrame, times: dict[str, list[int]]) -> dict[tuple[str, int], list[int]]:
    """Quantiles of ``pos`` for every player and time that holds several quantiles of the time."""
    crowded = [(player, us, n) for player, found in times.items() for us, n in Counter(found).items() if n > 1]
    if not crowded:
        return {}
    most = max(n for _, _, n in crowded)
    shares = [i / (most + 1) for i in range(1, most + 1)]
    known = events.sparkSession.createDataFrame([c[:2] for c in crowded], "player_id string, us bigint")
    rows = (
        events.select("player_id", F.unix_micros("ts").alias("us"), F.col("pos").cast("bigint").alias("pos"))
        .join(known, ["player_id", "us"])
        .groupBy("player_id", "us")
        .agg(F.percentile_approx("pos", shares, 20 * (most + 1)).alias("pos"))
    )
    wanted = {(player, us): n for player, us, n in crowded}
    found = {}
    for row in rows.collect():
        n, all_places = wanted[row.player_id, row.us], row.pos or ()
        # of as many places as the most crowded time has, those that cut this one into n + 1 parts
        found[row.player_id, row.us] = [all_places[i * (most + 1) // (n + 1) - 1] for i in range(1, n + 1)] if all_places else []
    return found


def _slice_number(us: Column, pos: Column) -> Column:
    """How many cut points lie below the time and place, found in two short steps."""
    here = F.struct(us.alias("us"), pos.cast("bigint").alias("pos"))

    def below(cuts: Column) -> Column:
        return F.size(F.filter(cuts, lambda cut: cut < here))

    block = below(F.col("coarse")) * _STEP
    within = below(F.slice(F.col("fine"), block + 1, F.lit(_STEP)))
    return F.when(F.col("fine").isNull() | us.isNull(), 0).otherwise(block + within).cast("int")
