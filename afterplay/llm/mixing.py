"""Mixing sources to target weights by systematic sampling.

Every source has a target number of words. A document is expected ``target / source_size``
times. The expected copies are summed up along the source, a random offset is added, and a
document is emitted once per whole number that the running sum crosses in it. The order along
the source is by size (rounded to four binary digits), then pseudo-random: neighbours are of
one size, so the words taken stay close to the target, not only the number of documents.

Defined results: null and empty texts have size 0; they take part in the sum and take 0 words.
A null source is a source of its own, the last one. An empty table gives no rows. Null and
repeated ids are sampled like others; rows with the same id, source and size may trade places,
which changes no result. The columns of the input come back in the struct ``doc``, so their
names clash with nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from afterplay.llm.ranks import shuffled_key, slot_digits, with_rank
from afterplay.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_COPIES = 3
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def size_band(size: Column) -> Column:
    """The size with all but its four leading binary digits set to 0."""
    spare = F.greatest(F.length(F.bin(size)) - 4, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", size, spare), spare)


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES
) -> DataFrame:
    """``source, source_size`` with the ``target`` of each source.

    Sources weigh ``weights`` in code point order, repeating, null last. Targets share the sum
    of all sizes by weight; none exceeds ``max_copies`` times its source, and what it leaves is
    shared by the others. In the order of ``cap / weight`` a source is capped if its share of
    what the ones before it left reaches the cap. One row per source goes through one window.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.pmod(F.row_number().over(in_order) - 1, F.lit(len(weights)))
    weighed = sizes.select(
        "source",
        "source_size",
        F.element_at(F.array(*map(F.lit, weights)), place + 1).cast("bigint").alias("weight"),
        (F.col("source_size") * max_copies).alias("cap"),
    )
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    past = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_cap.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(past), F.lit(0))
    marked = weighed.withColumn(
        "capped", F.col("cap") * F.sum("weight").over(rest) <= left * F.col("weight")
    )
    shared = F.sum("source_size").over(everything) - F.coalesce(
        F.sum(F.when(F.col("capped"), F.col("cap"))).over(everything), F.lit(0)
    )
    sharers = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(everything)
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
        shared.cast("double") * F.col("weight") / sharers
    )
    return marked.select("source", "source_size", target.alias("target"))


def source_offset(source: Column, seed: str) -> Column:
    text = F.concat(F.lit(seed), F.when(source.isNull(), ":null").otherwise(F.concat(F.lit("=:"), source)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / float(2**32)


def mix(
    docs: DataFrame,
    size: Column,
    source: str = "source",
    key: str = "doc_id",
    weights: tuple[int, ...] = WEIGHTS,
    max_copies: int = MAX_COPIES,
    seed: str = SEED,
) -> DataFrame:
    """``doc`` (all input columns), ``size, source, source_size, target, copies`` per row.

    One pass counts rows and sizes per (source, band, slot), a second one ranks and samples;
    no task sorts more than a slot. The counts are a written table, so a task that is run
    again finds the same.
    """
    spark = docs.sparkSession
    digits = slot_digits(docs.count())
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("doc"),
        docs[source].cast("string").alias("source"),
        size.alias("size"),
        shuffled_key(docs[key]).alias("place"),
        docs[key].alias("key"),
    ).select(
        "*", size_band(F.col("size")).alias("band"), F.substring("place", 1, digits).alias("slot")
    )
    buckets = ["band", "slot"]
    path = scratch_path(spark, "mix-counts")
    counted = rows.groupBy("source", *buckets).agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("words")
    )
    counted.write.parquet(path)
    counts = spark.read.parquet(path)
    targets = source_targets(counts.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_copies)
    ranked = with_rank(rows, counts, ["source"], buckets, ["place", "key", "size"])
    plan = targets.select(
        F.col("source").alias("of"),
        "source_size",
        "target",
        F.coalesce(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)), F.lit(0.0)).alias("share"),
        source_offset(F.col("source"), seed).alias("offset"),
    )
    joined = ranked.join(plan, ranked["source"].eqNullSafe(plan["of"]))
    crossed = F.floor((F.col("rank") + 1) * F.col("share") + F.col("offset")) - F.floor(
        F.col("rank") * F.col("share") + F.col("offset")
    )
    return joined.select(
        "doc", "size", "source", "source_size", "target", crossed.cast("bigint").alias("copies")
    )


def emit(mixed: DataFrame) -> DataFrame:
    """The mixed documents with their own columns, each as often as it is taken."""
    return (
        mixed.filter("copies > 0")
        .select("doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
        .select("doc.*")
    )
