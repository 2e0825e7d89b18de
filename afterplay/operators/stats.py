"""Summaries of labelled players, feature tables and events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from afterplay.functions.numbers import ratio_or_zero
from afterplay.operators.events import first_n_events
from afterplay.sources.writers import write_counted

COUNTS = {"op": "op_event_count", "cp": "cp_event_count"}


def dataset_stats(labels: DataFrame, *by: str, exact: bool = False) -> DataFrame:
    """Players, churn and event-count statistics with the population deviation.

    An empty table gives one row of zeros. ``exact`` sums integers, so that the result
    does not depend on the order of the rows.
    """
    n = F.count(F.lit(1))
    churned = F.count_if(F.coalesce(F.col("churned").cast("boolean"), F.lit(False)))
    columns = [
        n.alias("total_players"),
        churned.alias("churned_players"),
        (n - churned).alias("retained_players"),
        ratio_or_zero(churned, n).alias("churn_rate"),
        ratio_or_zero(n - churned, n).alias("retention_rate"),
    ]
    for prefix, name in COUNTS.items():
        value = F.coalesce(F.col(name), F.lit(0))
        if exact:
            wide = value.cast("decimal(18,0)")
            total, squares = F.sum(wide), F.sum(wide * wide)
            mean = F.when(n > 0, total.cast("double") / n)
            spread = _population_deviation(n, total, squares)
        else:
            mean, spread = F.avg(value), F.stddev_pop(value)
        columns += [
            F.coalesce(mean, F.lit(0.0)).alias(f"{prefix}_mean"),
            F.coalesce(F.min(value), F.lit(0)).alias(f"{prefix}_min"),
            F.coalesce(F.max(value), F.lit(0)).alias(f"{prefix}_max"),
            F.coalesce(F.when(n > 0, spread), F.lit(0.0)).alias(f"{prefix}_std"),
        ]
    return labels.groupBy(*by).agg(*columns) if by else labels.agg(*columns)


def _population_deviation(n: Column, total: Column, squares: Column) -> Column:
    """From exact sums where all digits fit, else from their doubles."""
    digits = "decimal(18,0)"
    narrow = total.try_cast(digits)
    exact = F.sqrt((n.cast(digits) * squares.try_cast(digits) - narrow * narrow).cast("double")) / n
    mean = total.cast("double") / n
    close = F.sqrt(F.greatest(squares.cast("double") / n - mean * mean, F.lit(0.0)))
    return F.coalesce(exact, close)


def feature_means(table: DataFrame) -> DataFrame:
    names = ("activeDuration", "playCount", "meanScore")
    return table.agg(*[F.avg(name).alias(f"avg_{name}") for name in names])


def gameplay_share(table: DataFrame, feature_count: int, expected: int) -> DataFrame:
    """Plays among all observed events, churn rate and the number of features."""
    plays, total = F.sum("playCount"), F.sum("op_event_count")
    n = F.count(F.lit(1))
    return table.agg(
        n.alias("players"),
        F.coalesce(plays, F.lit(0)).alias("play_events"),
        F.coalesce(total, F.lit(0)).alias("all_events"),
        F.coalesce(ratio_or_zero(plays, total), F.lit(0.0)).alias("gameplay_ratio"),
        ratio_or_zero(F.sum(F.col("churned").cast("bigint")), n).alias("churn_rate"),
        F.lit(feature_count).alias("feature_count"),
        F.lit(expected).alias("expected_features"),
    )


def class_distribution(table: DataFrame, label: str = "churned", *by: str) -> DataFrame:
    """Rows and share per class. The counts are few, so the share is taken on them."""
    counts = table.groupBy(*by, label).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(*by)))


def flag_invalid_players(players: DataFrame, expected: str = "op_event_count") -> DataFrame:
    """Validity of labelled records: an id, an event list, and the count that was promised."""
    size = F.when(F.col("observation_records").isNotNull(), F.size("observation_records"))
    return players.withColumn(
        "is_valid", F.coalesce((F.col("player_id") != "") & size.isNotNull(), F.lit(False))
    ).withColumn("count_mismatch", F.coalesce(size != F.col(expected), F.lit(False)))


def error_rate(flagged: DataFrame, ok: str = "is_valid", limit: float = 0.1) -> DataFrame:
    """Share of rows that failed, and whether it is above the limit."""
    n, bad = F.count(F.lit(1)), F.count_if(~F.col(ok))
    return flagged.agg(
        n.alias("players"),
        bad.alias("errors"),
        ratio_or_zero(bad, n).alias("error_rate"),
        (bad > n * F.lit(limit)).alias("too_many"),
    )


def check_error_rate(flagged: DataFrame, ok: str = "is_valid", limit: float = 0.1) -> None:
    row = error_rate(flagged, ok, limit).first()
    if row.too_many:
        raise ValueError(f"{row.errors} of {row.players} players failed")


def write_valid_players(flagged: DataFrame, path: str, ok: str = "is_valid", limit: float = 0.1) -> dict[str, int]:
    """Write the valid rows and count ``players`` and ``errors`` in the same pass; too many errors raise.

    Rows that were written before it raises stay there, for a look at them.
    """
    counts = write_counted(flagged, path, {"players": F.lit(True), "errors": ~F.col(ok)}, F.col(ok))
    if counts["errors"] > counts["players"] * limit:
        raise ValueError(f"{counts['errors']} of {counts['players']} players failed")
    return counts


def sample_players(labels: DataFrame, events: DataFrame, players: int = 3, per_player: int = 3) -> DataFrame:
    """The first observed events of the first players by id.

    The chosen players are at most ``players`` rows, so they are broadcast, and Spark
    keeps ``per_player`` rows of each before the shuffle.
    """
    chosen = labels.orderBy("player_id").limit(players)
    observed = events.join(F.broadcast(chosen), "player_id").filter(F.col("ts") <= F.col("op_end"))
    return first_n_events(observed, per_player).select(
        *labels.columns,
        "position",
        "ts",
        F.coalesce("event", F.lit("play")).alias("event"),
        F.coalesce(F.col("score").cast("string"), F.lit("N/A")).alias("score_shown"),
    )


def union_features(*tables: DataFrame) -> DataFrame:
    """All rows of all tables; a column one table lacks is null there."""
    first, *rest = tables
    for table in rest:
        first = first.unionByName(table, allowMissingColumns=True)
    return first


def require_columns(df: DataFrame, names: tuple[str, ...] = ("player_id", "churned", "playCount")) -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def require_rows(df: DataFrame) -> None:
    if df.isEmpty():
        raise ValueError("no features extracted")


def column_difference(expected: list[str], actual: list[str]) -> tuple[list[str], list[str]]:
    """Missing and extra names, in their own order."""
    return [c for c in expected if c not in actual], [c for c in actual if c not in expected]


def common_columns(left: list[str], right: list[str]) -> list[str]:
    return [c for c in left if c in right]

