"""What passes between Spark and the Python of its tasks."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

BATCH_ROWS = 256
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application; the driver serves the file."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="afterplay-"), "afterplay_package.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, files in os.walk(package):
            for name in sorted(f for f in files if f.endswith(".py")):
                full = os.path.join(folder, name)
                archive.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def small_batches(spark: SparkSession) -> SparkSession:
    """Rows here hold whole texts or sets, so a batch has fewer rows than Spark's default."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def most_frequent(counts: DataFrame, count: str, limit: int, least: int = 2) -> DataFrame:
    """The rows with the highest counts, at most ``limit`` of them, ties all in or all out.

    The smallest count that keeps to the limit comes from a histogram of counts, so nothing
    is sorted. The histogram is by powers of two up to 2^10 and finer below.
    """
    size = F.col(count).cast("bigint")
    step = F.when(size < 1024, size).otherwise(F.floor(F.log2(size.cast("double")) * 16) + 1024)
    rows = counts.filter(size >= least).groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect()
    kept, lowest = 0, None
    for row in sorted(rows, key=lambda r: -r.step):
        if kept + row.n > limit:
            break
        kept, lowest = kept + row.n, row.step
    if lowest is None:
        return counts.filter(F.lit(False))
    return counts.filter((size >= least) & (step >= lowest))


def gathered(function):
    """The same rows in fewer batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in function(batches):
            held.append(batch)
            size += batch.nbytes
            if size >= 1 << 22:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, size = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return run
