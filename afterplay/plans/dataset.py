"""The data job: events to split, labelled feature tables on disk.

One run writes ``<out>/<game>/features`` partitioned by ``part`` (``train`` or ``eval``),
which is what the training job reads. Nothing else is materialised.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from afterplay.functions.timing import iso_time
from afterplay.operators.hot import DEFAULT_POLICY, HotPolicy
from afterplay.operators.player_table import Horizon, feature_names, player_table
from afterplay.operators.split import SEED, TRAIN_RATIO, fit_player_split
from afterplay.operators.stats import require_rows
from afterplay.plans.training import Dataset
from afterplay.sources.writers import write_table


@dataclass(frozen=True)
class Game:
    """A source of canonical events and how to read them."""

    name: str
    events: DataFrame
    horizon: Horizon = field(default_factory=Horizon)
    purchases: bool = False


def build_features(
    game: Game, path: str, ratio: float = TRAIN_RATIO, seed: int = SEED, policy: HotPolicy = DEFAULT_POLICY
) -> None:
    """Label and describe all players in one pass, write, then split what was written.

    The split needs the number of players, so it is fitted on the written table and not on
    the events, which are read once.
    """
    table = player_table(game.events, game.horizon, game.purchases, policy)
    shown = table.select(
        "player_id",
        F.col("churned").cast("int").alias("churned"),
        *feature_names(game.purchases),
        *[iso_time(F.col(c)).alias(c) for c in ("op_start", "op_end")],
        "op_event_count",
        "cp_event_count",
    )
    write_table(shown, f"{path}/players")
    players = game.events.sparkSession.read.parquet(f"{path}/players")
    require_rows(players)
    cut = fit_player_split(players, ratio, seed)
    write_table(players.withColumn("part", cut.part("player_id")), f"{path}/features", ("part",))


def load_dataset(spark: SparkSession, name: str, path: str) -> Dataset:
    """The two parts of a built game, ready for training; the part is a pruned partition."""
    rows = spark.read.parquet(f"{path}/features")
    metadata = ("op_start", "op_end", "op_event_count", "cp_event_count", "part")

    def part(which: str) -> DataFrame:
        return rows.filter(F.col("part") == which).drop(*metadata)

    return Dataset(name, part("train"), part("eval"))


def build_all(spark: SparkSession, games: list[Game], path: str, **options) -> dict[str, Dataset | str]:
    """Every game by name; the message of the error for a game that failed."""
    built: dict[str, Dataset | str] = {}
    for game in games:
        try:
            build_features(game, f"{path}/{game.name}", **options)
            built[game.name] = load_dataset(spark, game.name, f"{path}/{game.name}")
        except Exception as error:
            built[game.name] = str(error)
    return built
