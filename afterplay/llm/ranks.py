"""Positions in a total order within a key, where one key may own a large share of all rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

SLOT_ROWS = 20_000


def shuffled_key(*columns: Column) -> Column:
    """A fixed pseudo-random order of rows: the md5 of their ids, nulls as empty text."""
    return F.md5(F.concat_ws(":", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns]))


def slot_digits(rows: int, slot_rows: int = SLOT_ROWS) -> int:
    """How many leading hex digits of the md5 cut ``rows`` into slots of about ``slot_rows``."""
    digits = 0
    while rows > slot_rows * 16**digits:
        digits += 1
    return digits


def same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[n].eqNullSafe(right[n]) for n in names])


def rows_before(counts: DataFrame, keys: list[str], buckets: list[str]) -> DataFrame:
    """``counts`` (keys, buckets, n) with the rows that lie in earlier buckets of the same key."""
    line = Window.partitionBy(*keys).orderBy(*buckets).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(
        *keys, *buckets, F.coalesce(F.sum("n").over(line), F.lit(0)).alias("rows_before")
    )


def with_rank(
    rows: DataFrame, counts: DataFrame, keys: list[str], buckets: list[str], order: list[str]
) -> DataFrame:
    """Add ``rank`` (from 0) within ``keys``, in the order of ``buckets`` and then ``order``.

    Only one (keys, buckets) group is sorted by a task. The groups before it are known from
    ``counts``, which has one row per group, so no task sees a whole key. Null keys are keys.
    """
    group = [*keys, *buckets]
    before = rows_before(counts, keys, buckets)
    within = Window.partitionBy(*group).orderBy(*order)
    numbered = rows.withColumn("rank_within", F.row_number().over(within).cast("bigint") - 1)
    joined = numbered.join(before, same(numbered, before, group))
    return joined.select(
        *[numbered[c] for c in rows.columns], (F.col("rank_within") + F.col("rows_before")).alias("rank")
    )
