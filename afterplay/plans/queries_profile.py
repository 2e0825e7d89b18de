"""Profile queries on tables and on JSON files written from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from afterplay.operators.profile import (
    describe_paths,
    profile_catalog,
    profile_columns,
    profile_json_document,
    profile_json_lines,
    profile_keyed_members,
    profile_keys,
    profile_nested,
    profile_paths,
    sample_records,
    sample_values,
)
from afterplay.plans.queries_sources import write_keyed_documents
from afterplay.plans.registry import query, table
from afterplay.session import scratch_path

# The columns of the given tables with their types.
CATALOG = {
    "region": {"r_regionkey": "int", "r_name": "string"},
    "nation": {"n_nationkey": "int", "n_name": "string", "n_regionkey": "int"},
    "customer": {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string"},
    "supplier": {"s_suppkey": "bigint", "s_name": "string", "s_nationkey": "int", "s_acctbal": "double"},
    "part": {
        "p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_type": "string", "p_size": "int",
        "p_retailprice": "double",
    },
    "orders": {
        "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
        "o_orderdate": "timestamp", "o_orderpriority": "string",
    },
    "lineitem": {
        "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int", "l_quantity": "double",
        "l_extendedprice": "double", "l_discount": "double", "l_tax": "double", "l_returnflag": "string",
        "l_linestatus": "string", "l_shipdate": "timestamp",
    },
    "events": {
        "event_id": "bigint", "ts": "timestamp", "user_id": "bigint", "event_type": "string", "value": "double",
        "props": "string",
    },
    "documents": {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"},
    "embeddings": {"vec_id": "bigint", "embedding": "array<float>", "label": "int"},
    "pages": {"page_id": "bigint", "url": "string", "html": "string"},
    "benchmark": {"item_id": "bigint", "text": "string"},
    "labels": {"doc_id": "bigint", "quality": "int", "toxic": "int"},
    "conversations": {"conv_id": "bigint", "turn": "bigint", "role": "string", "text": "string"},
}


def _profile_sql(name: str) -> str:
    columns = CATALOG[name]
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, {i} AS ordinal, '{c}' AS column_name, '{kind}' AS data_type,
            count(*) AS total_rows, {len(columns)} AS column_count, count(*) - count({c}) AS null_count FROM {name}"""
        for i, (c, kind) in enumerate(columns.items())
    )


@query("profile_columns", _profile_sql("orders").replace("'orders' AS table_name, ", ""))
def profile_columns_query(spark, folder):
    orders = table(spark, folder, "orders")
    plain = orders.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp"))
    return profile_columns(plain)


@query("profile_catalog", " UNION ALL ".join(map(_profile_sql, CATALOG)))
def profile_catalog_query(spark, folder):
    found = profile_catalog({name: table(spark, folder, name) for name in CATALOG})
    # times without a zone are times here
    return found.withColumn("data_type", F.regexp_replace("data_type", "_ntz$", ""))


@query(
    "profile_nested",
    """SELECT 'dict' AS kind, count(*) AS n, min(len(json_keys(props))) AS min_size,
        max(len(json_keys(props))) AS max_size, CAST(sum(len(json_keys(props))) AS BIGINT) AS total_size FROM events""",
)
def profile_nested_query(spark, folder):
    return profile_nested(table(spark, folder, "events"), "props")


@query("profile_keys", "SELECT 'k' AS key, 'int' AS kind, count(props ->> '$.k') AS n FROM events")
def profile_keys_query(spark, folder):
    return profile_keys(table(spark, folder, "events"), "props")


@query(
    "profile_text_kinds",
    """SELECT kind, count(*) AS n, min(size) AS min_size, max(size) AS max_size, CAST(sum(size) AS BIGINT) AS total_size
       FROM (SELECT CASE WHEN NOT json_valid(text) THEN 'str' ELSE CASE json_type(text)
                 WHEN 'OBJECT' THEN 'dict' WHEN 'ARRAY' THEN 'list' WHEN 'VARCHAR' THEN 'str'
                 WHEN 'BOOLEAN' THEN 'bool' WHEN 'DOUBLE' THEN 'float' WHEN 'NULL' THEN 'null' ELSE 'int' END END AS kind,
             CASE WHEN NOT json_valid(text) THEN length(text) WHEN json_type(text) = 'OBJECT' THEN len(json_keys(text))
                  WHEN json_type(text) = 'ARRAY' THEN json_array_length(text) ELSE length(text) END AS size FROM documents)
       GROUP BY kind""",
)
def profile_text_kinds(spark, folder):
    return profile_nested(table(spark, folder, "documents"), "text")


def nested_turns(spark: SparkSession, folder: str) -> DataFrame:
    """Turns of conversations as JSON with lists, objects and JSON in text; others are plain text."""
    words = F.split("text", " ")
    said = F.struct(F.col("turn"), words.alias("words"), F.to_json(F.struct("role")).alias("note"))
    record = F.to_json(F.struct(F.col("role"), said.alias("said"), F.lit(True).alias("kept")))
    turns = table(spark, folder, "conversations")
    return turns.select(F.when(F.col("turn") % 3 == 2, F.col("role")).otherwise(record).alias("record"))


PATHS_SQL = """
    WITH turns AS (
        SELECT role, turn, string_split(text, ' ') AS words, turn % 3 = 2 AS plain,
            length('{"role":"' || role || '"}') AS note FROM conversations WHERE text IS NOT NULL AND role IS NOT NULL
    ), nodes AS (
        SELECT '$' AS path, CASE WHEN plain THEN 'str' ELSE 'dict' END AS kind,
            CASE WHEN plain THEN length(role) ELSE 3 END AS size, 0 AS held FROM turns
        UNION ALL SELECT '$.role', 'str', length(role), 0 FROM turns WHERE NOT plain
        UNION ALL SELECT '$.kept', 'bool', NULL, 0 FROM turns WHERE NOT plain
        UNION ALL SELECT '$.said', 'dict', 3, 0 FROM turns WHERE NOT plain
        UNION ALL SELECT '$.said.turn', 'int', NULL, 0 FROM turns WHERE NOT plain
        UNION ALL SELECT '$.said.note', 'str', note, 1 FROM turns WHERE NOT plain
        UNION ALL SELECT '$.said.note<json>', 'dict', 1, 0 FROM turns WHERE NOT plain
        UNION ALL SELECT '$.said.note<json>.role', 'str', length(role), 0 FROM turns WHERE NOT plain
        UNION ALL SELECT '$.said.words', 'list', len(words), 0 FROM turns WHERE NOT plain
        UNION ALL SELECT '$.said.words[]', 'str', length(word), 0 FROM (SELECT unnest(words) AS word FROM turns WHERE NOT plain)
    )
    SELECT path, kind, count(*) AS n, min(size) AS min_size, max(size) AS max_size,
        CAST(sum(size) AS BIGINT) AS total_size, CAST(sum(held) AS BIGINT) AS holds_json FROM nodes GROUP BY path, kind
"""


@query("profile_paths", PATHS_SQL)
def profile_paths_query(spark, folder):
    return profile_paths(nested_turns(spark, folder), "record")


@query(
    "describe_paths",
    """SELECT * FROM (VALUES ('$', 'mixed', NULL, 'kept,role,said'), ('$.role', 'str', NULL, NULL), ('$.kept', 'bool', NULL, NULL),
        ('$.said', 'dict', NULL, 'note,turn,words'), ('$.said.turn', 'int', NULL, NULL), ('$.said.note', 'str', NULL, NULL),
        ('$.said.note<json>', 'dict', NULL, 'role'), ('$.said.note<json>.role', 'str', NULL, NULL),
        ('$.said.words', 'list', 'str', NULL), ('$.said.words[]', 'str', NULL, NULL)) t(path, type, element_type, keys)
       WHERE (SELECT count(*) FROM conversations) > 0""",
)
def describe_paths_query(spark, folder):
    found = describe_paths(profile_paths(nested_turns(spark, folder), "record"))
    return found.select("path", "type", "element_type", F.array_join("keys", ",").alias("keys"))


def _shown_sql(column: str) -> str:
    return f"CASE WHEN length({column}) > 50 THEN substr({column}, 1, 50) || '...' ELSE {column} END"


@query(
    "sample_records",
    f"""SELECT CAST(doc_id AS VARCHAR) AS doc_id, {_shown_sql('text')} AS text, lang, source,
        CAST(n_chars AS VARCHAR) AS n_chars FROM documents ORDER BY documents.doc_id LIMIT 3""",
)
def sample_records_query(spark, folder):
    """The first rows by id, so that they are the same rows everywhere."""
    return sample_records(table(spark, folder, "documents").orderBy("doc_id"))


@query(
    "sample_values",
    """WITH looked_at AS (SELECT * FROM orders ORDER BY o_orderkey LIMIT 5)
       SELECT 'o_orderstatus' AS column_name, array_to_string(list(o_orderstatus ORDER BY o_orderkey)[1:3], ',') AS sample_values FROM looked_at
       UNION ALL SELECT 'o_orderpriority', array_to_string(list(o_orderpriority ORDER BY o_orderkey)[1:3], ',') FROM looked_at
       UNION ALL SELECT 'o_orderkey', array_to_string(list(CAST(o_orderkey AS VARCHAR) ORDER BY o_orderkey)[1:3], ',') FROM looked_at
       UNION ALL SELECT 'o_custkey', array_to_string(list(CAST(o_custkey AS VARCHAR) ORDER BY o_orderkey)[1:3], ',') FROM looked_at""",
)
def sample_values_query(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority").orderBy("o_orderkey")
    return sample_values(rows).select("column_name", F.array_join("sample_values", ",").alias("sample_values"))


@query(
    "profile_jsonl",
    """SELECT count(*) AS lines, count(*) AS records,
        'OBJECT<event_id: BIGINT, event_type: STRING, user_id: BIGINT>' AS record_type FROM events""",
)
def profile_jsonl(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "profile-lines")
    table(spark, folder, "events").select("event_id", "event_type", "user_id").write.json(path)
    return profile_json_lines(spark, path).drop("longest_line")


@query(
    "profile_json_document",
    """SELECT 'dict' AS root, count(*) AS members, 'yes' AS keyed
        FROM orders GROUP BY o_orderkey // 50000""",
)
def profile_json_document_query(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "profile-documents")
    write_keyed_documents(spark, folder, path)
    found = profile_json_document(spark, path)
    return found.select("root", "members", F.when(F.size("first_keys") > 0, "yes").alias("keyed"))


@query("profile_keyed_members", "SELECT 'dict' AS kind, count(*) AS n FROM orders")
def profile_keyed_members_query(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "profile-members")
    write_keyed_documents(spark, folder, path)
    return profile_keyed_members(spark, path)
