"""Sinks. Each writes a folder of part files in parallel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F


def write_json_lines(df: DataFrame, path: str, keep_nulls: bool = False) -> None:
    """One object per line, UTF-8."""
    df.write.mode("overwrite").option("ignoreNullFields", not keep_nulls).json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Parquet, the form in which one stage hands over to the next."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_counted(
    df: DataFrame, path: str, counts: dict[str, Column], where: Column | None = None, drop: tuple[str, ...] = ()
) -> dict[str, int]:
    """Write the rows for which ``where`` holds, without some columns, and count over all rows in the same pass.

    A count is the number of rows for which its condition holds. A stage that runs again after a
    lost executor does not count its rows twice.
    """
    seen = Observation()
    observed = df.observe(seen, *[F.count_if(condition).alias(name) for name, condition in counts.items()])
    kept = observed if where is None else observed.filter(where)
    write_table(kept.drop(*drop), path)
    return {name: seen.get[name] for name in counts}
