"""Schema and content profiles of tables and JSON files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from afterplay.functions.display import shorten
from afterplay.session import scratch_path
from afterplay.sources.documents import document_roots, scan_keyed_document
from afterplay.sources.readers import is_one_value

# How many sample values, sample records and keys a profile shows.
SAMPLE_VALUES = 3
SAMPLE_RECORDS = 3
SHOWN_KEYS = 10


def profile_columns(df: DataFrame) -> DataFrame:
    """One row per column: type, rows, columns, nulls. One pass over the table."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)]
    )
    rows = [
        F.struct(
            F.lit(i).alias("ordinal"),
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("data_type"),
            F.col("rows").alias("total_rows"),
            F.lit(len(df.columns)).alias("column_count"),
            (F.col("rows") - F.col(f"c{i}")).alias("null_count"),
        )
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    return counts.select(F.inline(F.array(*rows)))


def sample_records(df: DataFrame, n: int = SAMPLE_RECORDS) -> DataFrame:
    """The first rows as they come, with every value as short text."""
    return df.limit(n).select(*[shorten(F.col(f"`{c}`")).alias(c) for c in df.columns])


def sample_values(df: DataFrame, looked_at: int = 5, n: int = SAMPLE_VALUES) -> DataFrame:
    """Per column the first non-null values among the first rows. Only these rows are read."""
    shown = df.limit(looked_at).select(*[shorten(F.col(f"`{c}`")).alias(c) for c in df.columns])
    rows = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.slice(F.collect_list(F.col(f"`{c}`")), 1, n).alias("sample_values"),
        )
        for c in df.columns
    ]
    return shown.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def value_kind(value: Column) -> Column:
    """Kind of a JSON value: str, int, float, bool, list, dict or null."""
    kind = F.schema_of_variant(value)
    return (
        F.when(value.isNull() | (kind == "VOID"), "null")
        .when(kind == "STRING", "str")
        .when(kind == "BOOLEAN", "bool")
        .when(kind == "BIGINT", "int")
        .when(kind.startswith("ARRAY"), "list")
        .when(kind.startswith("OBJECT"), "dict")
        .otherwise("float")
    )


def whole_json(text: Column) -> Column:
    """The text as a variant if all of it is one JSON value, else null."""
    return F.when(is_one_value(text), F.try_parse_json(text))


def text_kind(text: Column) -> Column:
    parsed = whole_json(text)
    return F.when(text.isNull(), "null").when(parsed.isNull(), "str").otherwise(value_kind(parsed))


def profile_keys(df: DataFrame, text: str) -> DataFrame:
    """Keys of the JSON objects in a text column: how many rows hold each, of which kind.

    Members are counted with map-side combining, so a key all rows share is no hot group.
    """
    members = df.select(F.explode(F.from_json(F.col(text), "map<string,variant>")).alias("key", "member"))
    return members.groupBy("key", value_kind(F.col("member")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def profile_nested(df: DataFrame, text: str) -> DataFrame:
    """Shape of JSON values in a text column: kind, length or key count, number of rows."""
    kind = text_kind(F.col(text))
    size = (
        F.when(kind == "dict", F.size(F.json_object_keys(F.col(text))))
        .when(kind == "list", F.json_array_length(F.col(text)).cast("bigint"))
        .otherwise(F.length(F.col(text)))
    )
    shaped = df.select(kind.alias("kind"), size.cast("bigint").alias("size"))
    return shaped.groupBy("kind").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("size").alias("min_size"),
        F.max("size").alias("max_size"),
        F.sum("size").alias("total_size"),
    )


def profile_paths(df: DataFrame, text: str) -> DataFrame:
    """``path, kind, n, min_size, max_size, total_size, holds_json`` of JSON in a text column, at any depth.

    ``$`` is the text itself, ``$.a`` a member, ``$[]`` all elements, and ``$.a<json>`` what text
    at ``$.a`` holds as a JSON object or array. The size of text is its length, of a list and a dict
    how much it holds; other values have none. Text that is no JSON is ``str``. Each round goes one
    level down from the table and counts with map-side combining, so only counts per path are moved;
    rounds end when no value holds others.
    """
    counted, nodes = [], df.select(F.lit("$").alias("path"), whole_json(F.col(text)).alias("v"), F.col(text).alias("raw"))
    nodes = _described(nodes)
    while True:
        counts = _kept(
            nodes.groupBy("path", "kind").agg(
                F.count(F.lit(1)).alias("n"),
                F.min("size").alias("min_size"),
                F.max("size").alias("max_size"),
                F.sum("size").alias("total_size"),
                F.count("inner").alias("holds_json"),
            )
        )
        counted.append(counts)
        if counts.filter("(kind IN ('dict', 'list') AND max_size > 0) OR holds_json > 0").isEmpty():
            return reduce(DataFrame.unionByName, counted)
        nodes = _described(nodes.select(F.inline(_below())))


def _described(nodes: DataFrame) -> DataFrame:
    """Kind, size and JSON content of ``v``; ``raw`` is text in place of a missing ``v``, at the root."""
    shown = F.coalesce(F.col("raw"), F.when(value_kind(F.col("v")) == "str", F.col("v").cast("string")))
    kind = F.when(F.col("v").isNotNull(), value_kind(F.col("v"))).when(F.col("raw").isNull(), "null").otherwise("str")
    typed = nodes.withColumn("kind", kind)
    members = F.when(F.col("kind") == "dict", F.map_entries(F.col("v").cast("map<string,variant>")))
    elements = F.when(F.col("kind") == "list", F.col("v").cast("array<variant>"))
    said = F.when(F.col("kind") == "str", shown)
    inner = F.when(F.col("raw").isNull() & said.rlike(r"^\s*[\[{]"), whole_json(said))
    wide = typed.withColumns({"members": members, "elements": elements, "inner": inner})
    size = F.coalesce(F.when(F.col("kind") == "dict", F.size("members")), F.when(F.col("kind") == "list", F.size("elements")), F.length(said))
    return wide.withColumn("size", size.cast("bigint"))


def _below() -> Column:
    """The nodes that a node holds."""

    def node(path: Column, value: Column) -> Column:
        return F.struct(path.alias("path"), value.alias("v"), F.lit(None).cast("string").alias("raw"))

    path = F.col("path")
    return (
        F.when(F.col("kind") == "dict", F.transform("members", lambda m: node(F.concat(path, F.lit("."), m["key"]), m["value"])))
        .when(F.col("kind") == "list", F.transform("elements", lambda v: node(F.concat(path, F.lit("[]")), v)))
        .when(F.col("inner").isNotNull(), F.array(node(F.concat(path, F.lit("<json>")), F.col("inner"))))
    )


def describe_paths(counts: DataFrame) -> DataFrame:
    """One row per path of ``profile_paths``: its type and that of its elements, each one kind or ``mixed``, and its first keys."""
    kinds = F.array_sort(F.collect_set(F.when(F.col("kind") != "null", F.col("kind"))))
    one = F.when(F.size(kinds) > 1, "mixed").otherwise(F.coalesce(F.get(kinds, 0), F.lit("null")))
    paths = counts.groupBy("path").agg(
        one.alias("type"),
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("kind") == "null", F.col("n")).otherwise(0)).alias("nulls"),
        F.min("min_size").alias("min_size"),
        F.max("max_size").alias("max_size"),
        F.sum("holds_json").alias("holds_json"),
    )
    elements = paths.filter(F.col("path").endswith("[]")).select(F.expr("left(path, length(path) - 2)").alias("of"), F.col("type").alias("element_type"))
    named = paths.select(F.regexp_extract("path", r"^(.*)\.([^.\[\]<>]+)$", 1).alias("in"), F.regexp_extract("path", r"([^.\[\]<>]+)$", 1).alias("key"))
    keys = named.filter("`in` <> ''").groupBy("in").agg(F.slice(F.array_sort(F.collect_set("key")), 1, SHOWN_KEYS).alias("keys"))
    return (
        paths.join(elements, F.col("path") == F.col("of"), "left")
        .join(keys, F.col("path") == F.col("in"), "left")
        .select("path", "type", "element_type", "keys", "n", "nulls", "min_size", "max_size", "holds_json")
    )


def _kept(counts: DataFrame) -> DataFrame:
    path = scratch_path(counts.sparkSession, "paths")
    counts.write.parquet(path)
    return counts.sparkSession.read.schema(counts.schema).parquet(path)


def profile_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """Records, bad lines and the joint type of all records, in one pass."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    parsed = whole_json(F.col("value"))
    return lines.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count(parsed).alias("records"),
        F.schema_of_variant_agg(parsed).alias("record_type"),
        F.max(F.length("value")).alias("longest_line"),
    )


def profile_json_document(spark: SparkSession, path: str) -> DataFrame:
    """Per file of any size: whether its root is a list or a dict, its size and its first keys."""
    return document_roots(spark, path, SHOWN_KEYS).drop("file")


def profile_keyed_members(spark: SparkSession, path: str) -> DataFrame:
    """Kinds of the members of keyed documents of any size."""
    members = scan_keyed_document(spark, path, T.VariantType())
    return members.groupBy(value_kind(F.col("value")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def profile_catalog(tables: dict[str, DataFrame]) -> DataFrame:
    """The column profiles of several tables below each other."""
    profiles = [profile_columns(df).select(F.lit(name).alias("table_name"), "*") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, profiles)
