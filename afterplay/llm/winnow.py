"""Document fingerprints by winnowing, with DataFrame functions only.

The units are words (runs of characters other than ASCII white space). Every run of ``GRAM``
words is hashed, and of every ``WINDOW`` hashes in a row the least is chosen, the rightmost of
equal ones. Two texts that share ``GRAM + WINDOW - 1`` words in a row share a chosen hash, and
no match shorter than ``GRAM`` words is found. Chosen hashes keep their position. Hash and
position are one number, ``hash * 2^30 + (2^30 - 1 - position)``: its least is the rightmost
least hash. A Spark string has fewer than 2^30 words.

Defined results: a null, empty or blank text has an empty fingerprint. Texts shorter than a gram
are one gram, those with fewer grams than a window have one hash. Two empty fingerprints are
alike (1.0), an empty and another one are not (0.0). An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

GRAM = 5
WINDOW = 16
POSITION_BITS = 30
HASH_MASK = (1 << 33) - 1
LAST = (1 << POSITION_BITS) - 1
SPACE = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, also where lambdas use it."""
    return F.transform(F.array(value), body)[0]


def _numbered(hashed: Column, position: Column) -> Column:
    return F.shiftleft(hashed.bitwiseAND(F.lit(HASH_MASK)), POSITION_BITS) + (F.lit(LAST) - position)


def _grams(words: Column) -> Column:
    many = F.size(words) - GRAM + 1
    nothing = F.array().cast("array<bigint>")

    def gram(word: Column, i: Column) -> Column:
        return _numbered(F.xxhash64(word, *[F.get(words, i + j) for j in range(1, GRAM)]), i)

    short = F.array(_numbered(F.xxhash64(words), F.lit(0)))
    return F.when(many > 0, F.transform(F.slice(words, 1, many), gram)).otherwise(
        F.when(F.size(words) > 0, short).otherwise(nothing)
    )


def _chosen(grams: Column) -> Column:
    windows = F.size(grams) - WINDOW + 1

    def least(_: Column, i: Column) -> Column:
        return F.array_min(F.slice(grams, i + 1, WINDOW))

    all_of_it = F.when(F.size(grams) > 0, F.array(F.array_min(grams))).otherwise(grams)
    sliding = F.array_distinct(F.transform(F.slice(grams, 1, windows), least))
    return F.when(windows > 0, sliding).otherwise(all_of_it)


def fingerprint(text: Column) -> Column:
    """Chosen hashes with their positions, by position."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return let(hashes, lambda h: let(_grams(h), _chosen))


def written_fingerprint(chosen: Column) -> Column:
    """``hash:position`` in hexadecimal and decimal, comma-joined."""

    def one(v: Column) -> Column:
        position = F.lit(LAST) - v.bitwiseAND(F.lit(LAST))
        return F.concat(F.hex(F.shiftright(v, POSITION_BITS)), F.lit(":"), position.cast("string"))

    return F.concat_ws(",", F.transform(chosen, one))


def likeness(one: Column, other: Column) -> Column:
    """Share of the hashes of either fingerprint that both have."""

    def hashes(chosen: Column) -> Column:
        return F.array_distinct(F.transform(chosen, lambda v: F.shiftright(v, POSITION_BITS)))

    def share(a: Column, b: Column) -> Column:
        both = F.size(F.array_intersect(a, b))
        either = F.size(a) + F.size(b) - both
        return F.when(either == 0, 1.0).otherwise(both / either)

    return let(hashes(one), lambda a: let(hashes(other), lambda b: share(a, b)))


def with_next(rows: DataFrame, key: str, columns: dict[str, str], buckets: int) -> DataFrame:
    """Add columns of the next row by descending ``key``; the last row is followed by the first.

    ``columns`` gives the name of each added column for a column. Rows are put into ``buckets``
    ranges of the key, whose bounds are quantiles. The first row of a range is lent to the range
    above as its last, so that each range is a window of its own. Equal keys go by the other
    columns. A null key has no place: nothing follows it.
    """
    placed = rows.filter(F.col(key).isNotNull())
    if buckets > 1:
        shares = [i / buckets for i in range(1, buckets)]
        cuts = sorted(set(placed.agg(F.percentile_approx(key, shares, 20 * buckets)).first()[0] or ()))
    else:
        cuts = []
    # the bucket of a key is the number of bounds below it; bounds are few and literal
    bounds = F.array(*map(F.lit, cuts)) if cuts else F.array().cast("array<bigint>")
    bucket = F.size(F.filter(bounds, lambda cut: cut < F.col(key)))
    heads = placed.groupBy(bucket.alias("bucket")).agg(F.max(key).alias("head")).orderBy("bucket").collect()
    if not heads:
        added = [F.lit(None).cast(rows.schema[c].dataType).alias(n) for c, n in columns.items()]
        return rows.select("*", *added)
    above = {heads[i].head: heads[(i + 1) % len(heads)].bucket for i in range(len(heads))}
    lent = F.element_at(F.create_map(*[F.lit(v) for pair in above.items() for v in pair]), F.col(key))
    guests = placed.filter(F.col(key).isin(list(above))).select("*", lent.alias("_bucket"), F.lit(1).alias("_guest"))
    own = placed.select("*", bucket.alias("_bucket"), F.lit(0).alias("_guest"))
    line = Window.partitionBy("_bucket").orderBy("_guest", F.desc(key), *columns)
    followed = own.unionByName(guests).select("*", *[F.lead(c).over(line).alias(n) for c, n in columns.items()])
    missing = [F.lit(None).cast(rows.schema[c].dataType).alias(n) for c, n in columns.items()]
    without = rows.filter(F.col(key).isNull()).select("*", *missing)
    return followed.filter("_guest = 0").drop("_bucket", "_guest").unionByName(without)


def fingerprints_and_edits(docs: DataFrame, key: str = "doc_id", buckets: int | None = None) -> DataFrame:
    """Per document its fingerprint, that of its edited text, and how near they and the next are.

    The edited text has its last half (rounded down) replaced by as much of the beginning of
    the next document. Each text is shuffled once, together with its fingerprint.
    """
    spark = docs.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.select(docs[key].alias("doc_id"), text.alias("text"), fingerprint(text).alias("chosen"))
    pairs = with_next(rows, "doc_id", {"text": "next_text", "chosen": "next_chosen"}, buckets)
    length = F.char_length("text")
    half = F.floor(length / 2).cast("int")
    begin = F.substring(F.col("text"), F.lit(1), length - half)
    edited = F.concat(begin, F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half))
    nothing = F.array().cast("array<bigint>")
    made = pairs.select(
        "doc_id",
        length.cast("bigint").alias("n_chars"),
        edited.alias("edited"),
        "chosen",
        F.coalesce("next_chosen", nothing).alias("next_chosen"),
    ).select("*", fingerprint(F.col("edited")).alias("edited_chosen"))
    return made.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        written_fingerprint(F.col("chosen")).alias("fingerprint"),
        written_fingerprint(F.col("edited_chosen")).alias("edited_fingerprint"),
        likeness(F.col("chosen"), F.col("edited_chosen")).alias("near_edited"),
        likeness(F.col("chosen"), F.col("next_chosen")).alias("near_next"),
    )
