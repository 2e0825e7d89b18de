"""Seeded splits that keep every player on one side.

Players are ordered by a hash of seed and id; the first ``floor(n * ratio)`` train. All a
split needs to remember is the hash of the last training player, so it is applied to any
table as a filter: no sort, no join, no shuffle of the events.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from afterplay.functions.identity import has_player_id
from afterplay.session import scratch_path

# Share of players that train, and the seed.
TRAIN_RATIO = 0.8
SEED = 42

_PREFIX = 3
_SMALL_BUCKET = 10_000
_EVERYONE = "g"  # above every hexadecimal digest
_NOBODY = ""


def split_hash(player_id: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), player_id.cast("string")))


@dataclass(frozen=True)
class SplitCut:
    """Per stratum (or for ``None``), the largest hash that belongs to the training part."""

    seed: int
    last_train: dict[object, str]
    strata: str | None = None

    def part(self, player_id: Column | str) -> Column:
        digest = split_hash(F.col(player_id) if isinstance(player_id, str) else player_id, self.seed)
        if self.strata is None:
            return F.when(digest <= self.last_train[None], "train").otherwise("eval")
        part = F.lit("eval")
        for value, last in self.last_train.items():
            part = F.when(F.col(self.strata).eqNullSafe(F.lit(value)) & (digest <= last), "train").otherwise(part)
        return part


def fit_player_split(
    players: DataFrame, ratio: float = TRAIN_RATIO, seed: int = SEED, id_column: str = "player_id"
) -> SplitCut:
    """The cut of an exact split of the distinct ids of ``players``."""
    ids = players.select(F.col(id_column).alias("id")).filter(has_player_id(F.col("id").cast("string"))).distinct()
    hashes = ids.select(F.lit(None).cast("string").alias("stratum"), split_hash(F.col("id"), seed).alias("h"))
    return SplitCut(seed, {r.stratum: r.last for r in _last_hashes(_kept(hashes), ratio).collect()} or {None: _NOBODY})


def fit_stratified_split(
    rows: DataFrame, strata: str, ratio: float = TRAIN_RATIO, seed: int = SEED, id_column: str = "player_id"
) -> SplitCut:
    """One exact cut per class, for few classes. With a class of a single row, one cut for all rows.

    ``rows`` has one row per id. For many strata, see :func:`stratified_parts`.
    """
    cuts = stratum_cuts(rows, strata, ratio, seed, id_column)
    if cuts is None:
        return fit_player_split(rows, ratio, seed, id_column)
    return SplitCut(seed, {r.stratum: r.last for r in cuts.collect()}, strata)


def stratum_cuts(
    rows: DataFrame, strata: str, ratio: float = TRAIN_RATIO, seed: int = SEED, id_column: str = "player_id"
) -> DataFrame | None:
    """``stratum, last``: the cut of every stratum, as a table; None if a stratum has a single row."""
    hashes = _kept(rows.select(F.col(strata).alias("stratum"), split_hash(F.col(id_column), seed).alias("h")))
    smallest = hashes.groupBy("stratum").count().agg(F.min("count")).first()[0]
    return None if smallest is not None and smallest < 2 else _last_hashes(hashes, ratio)


def stratified_parts(
    rows: DataFrame, strata: str, ratio: float = TRAIN_RATIO, seed: int = SEED, id_column: str = "player_id"
) -> DataFrame:
    """``rows`` with the ``part`` of each, exact within every stratum, however many strata there are.

    ``rows`` has one row per id. With a stratum of a single row, all rows share one cut.
    """
    cuts = stratum_cuts(rows, strata, ratio, seed, id_column)
    if cuts is None:
        return rows.withColumn("part", fit_player_split(rows, ratio, seed, id_column).part(id_column))
    train = split_hash(F.col(id_column), seed) <= F.col("last")
    joined = rows.join(cuts, F.col(strata).eqNullSafe(F.col("stratum")), "left")
    return joined.withColumn("part", F.when(train, "train").otherwise("eval")).select(*[rows[c] for c in rows.columns], "part")


def approximate_split(ratio: float = TRAIN_RATIO, seed: int = SEED) -> SplitCut:
    """A cut that needs no pass over the data; the share of players is close to ``ratio``."""
    edge = math.floor(ratio * 16**8)
    last = _EVERYONE if edge >= 16**8 else _NOBODY if edge == 0 else f"{edge - 1:08x}g"
    return SplitCut(seed, {None: last})


def _kept(frame: DataFrame) -> DataFrame:
    """The frame as a table in the shared folder, so that the steps behind it do not run it again."""
    path = scratch_path(frame.sparkSession, "split")
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _last_hashes(hashes: DataFrame, ratio: float) -> DataFrame:
    """``stratum, last``: the hash of rank ``floor(n * ratio)`` in every stratum, for all at once.

    Hashes are counted by prefix, which combines map-side, and of each stratum only the bucket
    that holds the rank is looked at again, with a longer prefix while some bucket is large.
    """
    in_order = Window.partitionBy("stratum").orderBy("prefix")
    everything = Window.partitionBy("stratum")

    def bucket_of_rank(counted: DataFrame, wanted: Column, *others: str) -> DataFrame:
        line = counted.withColumn("upto", F.sum("n").over(in_order)).withColumn("wanted", wanted)
        own = line.filter((F.col("upto") - F.col("n") < F.col("wanted")) & (F.col("wanted") <= F.col("upto")))
        return own.select("stratum", "prefix", "n", (F.col("wanted") - F.col("upto") + F.col("n")).alias("within"), *others)

    def inside(chosen: DataFrame, length: int) -> DataFrame:
        near = chosen.select(F.col("stratum").alias("of"), F.col("prefix").alias("begin"), "within", "rank", "total")
        prefix = F.substring("h", 1, length)
        return hashes.join(near, F.col("stratum").eqNullSafe(F.col("of")) & (prefix == F.col("begin")))

    length = _PREFIX
    counts = hashes.groupBy("stratum", F.substring("h", 1, length).alias("prefix")).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("total", F.sum("n").over(everything))
    counts = counts.withColumn("rank", F.floor(F.col("total").cast("double") * F.lit(float(ratio))))
    # a rank of nobody or of everybody still chooses a bucket, so that no stratum is left out
    clamped = F.least(F.greatest(F.col("rank"), F.lit(1)), F.col("total"))
    chosen = _kept(bucket_of_rank(counts, clamped, "rank", "total"))
    while length < 30 and (chosen.agg(F.max("n")).first()[0] or 0) > _SMALL_BUCKET:
        finer = inside(chosen, length).groupBy("stratum", F.substring("h", 1, length + _PREFIX).alias("prefix")).agg(
            F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in ("within", "rank", "total")]
        )
        chosen = _kept(bucket_of_rank(finer, F.col("within"), "rank", "total"))
        length += _PREFIX
    nth = F.row_number().over(Window.partitionBy("stratum").orderBy("h"))
    found = inside(chosen, length).withColumn("nth", nth).filter(F.col("nth") == F.col("within"))
    last = F.when(F.col("rank") <= 0, _NOBODY).when(F.col("rank") >= F.col("total"), _EVERYONE).otherwise(F.col("h"))
    return found.select("stratum", last.alias("last"))


def split_by_ids(records: DataFrame, train_ids: DataFrame, eval_ids: DataFrame) -> DataFrame:
    """Records with their ``part``; training wins for an id in both lists, others are skipped.

    The two id lists become one small relation, so the records take part in one join. Spark
    broadcasts it below its size limit, and splits skewed partitions of the records above.
    Records without an id match nothing; in a shuffle they spread by where they come from.
    """
    members = (
        train_ids.select("player_id", F.lit(1).alias("rank"))
        .unionByName(eval_ids.select("player_id", F.lit(2).alias("rank")))
        .filter(has_player_id(F.col("player_id")))
        .groupBy(F.col("player_id").alias("_member"))
        .agg(F.min("rank").alias("rank"))
    )
    nowhere = F.concat(F.lit("\0"), F.spark_partition_id().cast("string"))
    key = F.when(has_player_id(F.col("player_id")), F.col("player_id")).otherwise(nowhere)
    part = F.when(F.col("rank") == 1, "train").when(F.col("rank") == 2, "eval").otherwise("skipped")
    joined = records.withColumn("_key", key).join(members, F.col("_key") == F.col("_member"), "left")
    return joined.select(*records.columns, part.alias("part"))


def split_counts(parts: DataFrame) -> DataFrame:
    return parts.agg(
        *[F.count_if(F.col("part") == p).alias(f"{p}_count") for p in ("train", "eval", "skipped")]
    )


def shared_players(train: DataFrame, held_out: DataFrame) -> DataFrame:
    """Ids on both sides; empty for a sound split."""
    return train.select("player_id").intersect(held_out.select("player_id"))
