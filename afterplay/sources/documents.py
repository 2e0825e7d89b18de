"""JSON documents of any size, one value to a file, read by many tasks.

A file is cut at every comma, so its splits are read in parallel. Which commas stand between
members of the root is found by structure: the quotes before a fragment tell whether it begins
inside a string, the brackets outside strings how deep it lies. Both are sums, within a split in
order and over the splits of a file, of which there are few. How deep a fragment lies in its split is
summed up for both cases, that the split begins inside or outside a string. A member begins with a fragment
directly inside the root, whatever its key and the space around it; its fragments are put together
again and parsed. A document whose brackets or quotes do not close raises.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

_KEY = r'^\s*"((?:[^"\\]|\\.)*)"\s*:\s*'
_ROOT = r"^\s*([\{\[])"
# what is left of an empty root
_EMPTY = r"^\s*[\}\]]"


def root_members(spark: SparkSession, path: str) -> DataFrame:
    """``file, root, entry, key, text`` of the members of the root of every file, numbered from 1.

    ``root`` is ``{`` or ``[`` with the first member and null with the others. Members of an array
    have no key. An empty root is one member without text; a file whose root is neither is one
    with the number 0. Behind the last value, what closes the root is still there.
    """
    placed = _placed(spark, path)
    inside = F.pmod(F.col("quotes_within") + F.col("odd_before"), F.lit(2)) == 1
    depth = F.col("depth_before") + F.when(F.col("odd_before") == 0, F.col("depth_0_within")).otherwise(F.col("depth_1_within"))
    first = F.col("root").isNotNull() & (depth == 0) & ~inside
    started = placed.join(_split_states(placed), ["file", "split"]).withColumns(
        {
            "start": (first | (~inside & (depth == 1))).cast("bigint"),
            "root": F.when(first, F.col("root")),
            "value": F.when(first, F.regexp_replace("value", _ROOT, "")).otherwise(F.col("value")),
        }
    )
    number = F.col("starts_before") + _within("start") + F.col("start")
    numbered = started.select("file", "split", "n", "root", "value", number.alias("entry"))
    pieces = F.array_sort(F.collect_list(F.struct("split", "n", "value")))
    entries = numbered.groupBy("file", "entry").agg(
        F.max("root").alias("root"), F.array_join(F.transform(pieces, lambda p: p["value"]), ",").alias("text")
    )
    quoted = F.concat(F.lit('["'), F.regexp_extract("text", _KEY, 1), F.lit('"]'))
    return entries.select(
        "file",
        "root",
        "entry",
        F.when(F.col("text").rlike(_KEY), F.from_json(quoted, "array<string>")[0]).alias("key"),
        F.when(~F.col("text").rlike(_EMPTY), F.regexp_replace("text", _KEY, "")).alias("text"),
    )


def _placed(spark: SparkSession, path: str) -> DataFrame:
    """The fragments with the quotes and the depth that precede each of them within its split.

    ``depth_0`` holds if the split begins outside strings and ``depth_1`` if it begins inside one. ``root``
    is the bracket that a fragment of the first split begins with.
    """
    # without escaped signs
    plain = F.when(F.contains("value", F.lit("\\")), F.regexp_replace("value", r"\\.", "")).otherwise(F.col("value"))
    fragments = spark.read.option("lineSep", ",").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("n"),
        "value",
        plain.alias("plain"),
    ).withColumn("bare", F.regexp_replace("plain", '"[^"]*("|$)', ""))
    counted = fragments.select(
        "file",
        "split",
        "n",
        "value",
        _count("plain", '"').alias("quotes"),
        _depth("plain").alias("brackets"),
        _depth("bare").alias("outside"),
        F.when((F.col("split") == 0) & F.col("value").rlike(_ROOT), F.regexp_extract("value", _ROOT, 1)).alias("root"),
    )
    quoted = counted.withColumn("quotes_within", _within("quotes"))
    odd = F.pmod("quotes_within", F.lit(2)) == 1
    # what is outside strings if a fragment begins outside them is inside if it begins inside, and the reverse
    reverse = F.col("brackets") - F.col("outside")
    known = quoted.withColumns(
        {
            "depth_0": F.when(odd, reverse).otherwise(F.col("outside")),
            "depth_1": F.when(odd, F.col("outside")).otherwise(reverse),
        }
    ).drop("brackets", "outside")
    return known.withColumns({"depth_0_within": _within("depth_0"), "depth_1_within": _within("depth_1")})


def _count(text: str, signs: str) -> Column:
    left = reduce(lambda rest, sign: F.replace(rest, F.lit(sign), F.lit("")), signs, F.col(text))
    return (F.octet_length(text) - F.octet_length(left)).cast("bigint")


def _depth(text: str) -> Column:
    """Brackets that open less those that close."""
    return _count(text, "{[") - _count(text, "}]")


def _within(column: str) -> Column:
    """What the fragments of the split before each one add up to."""
    before = Window.partitionBy("file", "split").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(before), F.lit(0))


def _split_states(placed: DataFrame) -> DataFrame:
    """``file, split, odd_before, depth_before, starts_before``: what precedes each split of a file.

    A fragment begins outside strings only if the quotes before it in its split are as odd as those before the
    split. Fragments are counted by that and by their depth in the split, so one small row tells how many
    members a split begins, whatever its own state turns out to be.
    """
    odd = F.pmod("quotes_within", F.lit(2))
    level = F.when(odd == 0, F.col("depth_0_within")).otherwise(F.col("depth_1_within"))
    levels = placed.groupBy("file", "split", odd.alias("odd"), level.alias("level")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("root").alias("roots"),
        *[F.sum(c).alias(c) for c in ("quotes", "depth_0", "depth_1")],
    )
    splits = levels.groupBy("file", "split").agg(
        F.collect_list(F.struct("odd", "level", "n", "roots")).alias("levels"),
        *[F.sum(c).alias(c) for c in ("quotes", "depth_0", "depth_1")],
    )
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")

    def before(column: str) -> Column:
        return F.coalesce(F.sum(column).over(earlier), F.lit(0))

    states = splits.withColumn("odd_before", F.pmod(before("quotes"), F.lit(2)))
    states = states.withColumn("depth", F.when(F.col("odd_before") == 0, F.col("depth_0")).otherwise(F.col("depth_1")))
    states = states.withColumns({"depth_before": before("depth"), "depth_total": F.sum("depth").over(whole), "quotes_total": F.sum("quotes").over(whole)})

    def starts(total: Column, at: Column) -> Column:
        depth = F.col("depth_before") + at["level"]
        found = F.when(depth == 1, at["n"]).when(depth == 0, at["roots"]).otherwise(0)
        return total + F.when(at["odd"] == F.col("odd_before"), found).otherwise(0)

    states = states.withColumn("starts", F.aggregate("levels", F.lit(0).cast("bigint"), starts))
    closed = (F.pmod("quotes_total", F.lit(2)) == 0) & (F.col("depth_total") == 0)
    broken = F.raise_error(F.concat(F.lit("a document does not close: "), F.col("file"))).cast("bigint")
    return states.withColumn("starts_before", before("starts")).select(
        "file", "split", "odd_before", "depth_before", F.when(closed, F.col("starts_before")).otherwise(broken).alias("starts_before")
    )


def _member(kind: T.DataType) -> Column:
    """The value of a member; what closes the root behind the last one is not looked at."""
    holder = T.StructType([T.StructField("v", kind)])
    in_object = F.from_json(F.concat(F.lit('{"v":'), F.col("text"), F.lit("}")), holder)["v"]
    in_array = F.from_json(F.concat(F.lit("["), F.col("text"), F.lit("]")), T.ArrayType(kind))[0]
    return F.when(F.col("key").isNotNull(), in_object).otherwise(in_array)


def scan_keyed_document(spark: SparkSession, path: str, value_type: T.DataType) -> DataFrame:
    """Rows ``(key, value)`` of the members of objects."""
    return root_members(spark, path).filter("key IS NOT NULL").select("key", _member(value_type).alias("value"))


def scan_array_document(spark: SparkSession, path: str, element_type: T.DataType) -> DataFrame:
    """Rows ``(file, element, value)`` of the elements of arrays, numbered from 0 in each file."""
    elements = root_members(spark, path).filter("key IS NULL AND text IS NOT NULL AND entry > 0")
    return elements.select("file", (F.col("entry") - 1).alias("element"), _member(element_type).alias("value"))


def scan_json_document(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """An array is one row per element, an object is one row, of its last members with the names of the schema.

    An element that is no object is a row of nulls. A root that is neither gives no row.
    """
    members = root_members(spark, path)
    is_element = F.col("key").isNull() & F.col("text").isNotNull()
    elements = members.filter(is_element & (F.col("entry") > 0)).select(_member(schema).alias("v"))
    named = members.filter("key IS NOT NULL OR (text IS NULL AND root = '{')")
    fields = [
        F.max_by(_member(f.dataType), F.when(F.col("key") == f.name, F.col("entry"))).alias(f.name) for f in schema
    ]
    objects = named.groupBy("file").agg(*fields).select(*[F.col(f"`{f.name}`") for f in schema])
    return elements.select(*[F.col(f"v.`{f.name}`") for f in schema]).unionByName(objects)


def document_roots(spark: SparkSession, path: str, shown_keys: int) -> DataFrame:
    """``file, root, members, first_keys``: whether a root is a list or a dict, its size and its first keys."""
    kind = F.when(F.col("root") == "{", "dict").when(F.col("root") == "[", "list")
    first = F.array_sort(F.collect_list(F.when(F.col("entry") <= shown_keys, F.struct("entry", "key"))))
    found = root_members(spark, path).groupBy("file").agg(
        F.coalesce(F.max(kind), F.lit("value")).alias("root"),
        F.count(F.when(F.col("entry") > 0, F.col("text"))).alias("members"),
        F.transform(first, lambda m: m["key"]).alias("first_keys"),
    )
    is_dict = F.col("root") == "dict"
    return found.select(
        "file",
        "root",
        F.when(F.col("root") != "value", F.col("members")).alias("members"),
        F.when(is_dict, F.filter("first_keys", lambda k: k.isNotNull())).alias("first_keys"),
    )
