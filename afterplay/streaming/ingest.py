"""New log files to canonical event rows, as they arrive.

A log line is complete in itself, so intake is stateless: each file is parsed once, good
lines become event rows and bad lines are set aside. Labels and features are then computed
on the event table, which is cheaper than on nested logs, as columns can be pruned.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from afterplay.sources.adapters import events_from_race_logs
from afterplay.sources.readers import JsonLines
from afterplay.sources.schemas import RACE_LOG


def ingest_player_logs(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    schema: T.StructType = RACE_LOG,
    to_events: Callable[[DataFrame], DataFrame] = events_from_race_logs,
    files_per_batch: int = 1_000,
) -> StreamingQuery:
    """Start a run over all files not seen before; it ends when they are done.

    A batch overwrites its own folders, so a batch that is run again after a failure does
    not write its rows twice.
    """
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(source)

    def write(batch: DataFrame, number: int) -> None:
        read = batch.filter(F.trim("value") != "").persist()
        try:
            parsed = JsonLines.parse(read, schema)
            folder = f"batch={number}"
            to_events(parsed.rows).write.mode("overwrite").parquet(f"{target}/events/{folder}")
            parsed.malformed.write.mode("overwrite").text(f"{target}/malformed/{folder}")
        finally:
            read.unpersist()

    return (
        lines.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_ingested(spark: SparkSession, target: str) -> DataFrame:
    """The event rows of all batches."""
    return spark.read.parquet(f"{target}/events").drop("batch")
