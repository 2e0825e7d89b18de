"""File queries. The files are written from the given tables, then read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from afterplay.functions.timing import iso_time
from afterplay.operators.events import nest_events, nest_labelled_events
from afterplay.operators.metrics import melt_metrics
from afterplay.operators.player_table import feature_table
from afterplay.plans.fragments import (
    RACE,
    RACE_EVENTS,
    SCORE_EVENTS,
    iso,
    race_features,
    race_labels,
    rounded,
    score_features,
)
from afterplay.plans.queries_metrics import PREDICTIONS_SQL, wide_metrics
from afterplay.plans.queries_rows import race_events, race_table, rounded_columns, score_events, score_table
from afterplay.plans.registry import query, table
from afterplay.session import scratch_path
from afterplay.sources.adapters import events_from_race_logs, events_from_score_csv, events_from_score_logs
from afterplay.sources.readers import (
    explode_keyed_document,
    explode_match_players,
    explode_matches,
    first_json_lines,
    scan_array_document,
    scan_csv,
    scan_features,
    scan_json_document,
    scan_json_lines,
    scan_json_lines_strict,
    scan_keyed_document,
    write_json_rows,
)
from afterplay.sources.schemas import MATCH, MATCH_PLAYERS, RACE_LOG, SCORE_LOG
from afterplay.sources.writers import write_csv, write_json_lines
from afterplay.streaming.ingest import ingest_player_logs, read_ingested


@query(
    "scan_csv_events",
    f"SELECT player_id, {iso('ts')} AS ts, floor(score) AS score FROM ({SCORE_EVENTS})",
)
def scan_csv_events(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "csv-events")
    rows = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("device"),
        F.floor("o_totalprice").alias("score"),
        F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("time"),
    )
    write_csv(rows, path)
    events = events_from_score_csv(scan_csv(spark, path))
    return events.select("player_id", iso_time(F.col("ts")).alias("ts"), "score")


def race_log_records(spark: SparkSession, folder: str) -> DataFrame:
    """Nested player logs as a race game writes them: varying properties, time in ms."""
    events = race_events(spark, folder)
    play, bought = F.col("is_play"), F.col("is_purchase")
    properties = F.struct(
        F.when(play, F.lit("complete")).alias("action"),
        F.when(play, F.lit("race")).alias("type"),
        F.col("score").alias("reward"),
        F.when(bought, F.col("price")).alias("price"),
    )
    shaped = events.select(
        "player_id",
        "ts",
        "pos",
        (F.unix_micros("ts") / 1000.0).alias("time"),
        F.when(play, "progress").otherwise(F.col("event")).alias("kind"),
        properties.alias("properties"),
    )
    nested = nest_events(shaped, "time", "kind", "properties")
    record = lambda e: F.struct(e["time"].alias("time"), e["kind"].alias("event"), e["properties"].alias("properties"))
    return nested.select(F.col("player_id").alias("uid"), F.transform("records", record).alias("records"))


def _race_log_file(spark: SparkSession, folder: str, broken: bool) -> str:
    """Player logs as text lines; ``broken`` adds copies of each that are cut off, blank, or more than one value."""
    path = scratch_path(spark, "race-logs")
    line = F.to_json(F.struct("uid", "records"))
    lines = race_log_records(spark, folder).select(line.alias("value"))
    if broken:
        behind = (',"more":1', ',"_end":0', ',"_end":0,"_line":{"uid":"other","records":[]}', ',"_end":0}{"_end":0', " {}", "]")
        longer = [F.concat("value", F.lit(text)) for text in behind]
        spoiled = F.array(F.col("value"), F.substring("value", 1, 40), F.lit(""), *longer)
        lines = lines.select(F.explode(spoiled).alias("value"))
    lines.write.text(path)
    return path


@query(
    "scan_jsonl_players",
    f"""SELECT player_id, row_number() OVER (PARTITION BY player_id ORDER BY ts, pos) - 1 AS pos, {iso('ts')} AS ts,
        is_play, score, is_purchase, price FROM ({RACE_EVENTS})""",
)
def scan_jsonl_players(spark: SparkSession, folder: str) -> DataFrame:
    lines = scan_json_lines(spark, _race_log_file(spark, folder, broken=True), RACE_LOG)
    events = events_from_race_logs(lines.rows)
    return events.select(
        "player_id", "pos", iso_time(F.col("ts")).alias("ts"), "is_play", "score", "is_purchase", "price"
    )


@query("scan_jsonl_malformed", "SELECT 7 * count(DISTINCT user_id) AS malformed, 40 AS line_length FROM events")
def scan_jsonl_malformed(spark: SparkSession, folder: str) -> DataFrame:
    lines = scan_json_lines(spark, _race_log_file(spark, folder, broken=True), RACE_LOG)
    return lines.malformed.agg(
        F.count("*").alias("malformed"), F.min(F.length("line_text")).alias("line_length")
    )


@query(
    "write_jsonl_counted",
    "SELECT count(DISTINCT user_id) AS records, 7 * count(DISTINCT user_id) AS malformed, count(*) AS events FROM events",
)
def write_jsonl_counted(spark: SparkSession, folder: str) -> DataFrame:
    """Good rows go to a table; how many lines were good and bad comes from the same pass."""
    lines = spark.read.text(_race_log_file(spark, folder, broken=True))
    path = scratch_path(spark, "good-lines")
    counts = write_json_rows(lines, RACE_LOG, path)
    held = spark.read.parquet(path).agg(F.sum(F.size("records")).cast("bigint").alias("events"))
    return held.select(F.lit(counts["records"]).alias("records"), F.lit(counts["malformed"]).alias("malformed"), "events")


@query("scan_jsonl_strict", "SELECT CAST(user_id AS VARCHAR) AS uid, count(*) AS n FROM events GROUP BY user_id")
def scan_jsonl_strict(spark: SparkSession, folder: str) -> DataFrame:
    path = _race_log_file(spark, folder, broken=False)
    return scan_json_lines_strict(spark, path, RACE_LOG).select("uid", F.size("records").cast("bigint").alias("n"))


@query(
    "sample_first_n",
    "SELECT event_id, event_type FROM events ORDER BY event_id LIMIT 5",
)
def sample_first_n(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "first-lines")
    table(spark, folder, "events").select("event_id", "event_type").orderBy("event_id").write.json(path)
    schema = table(spark, folder, "events").select("event_id", "event_type").schema
    return first_json_lines(spark, f"{path}/part-00000*", schema).drop("line")


# Entries of a document. A document is one file and is read by one task, so its size is fixed.
ENTRIES = 50_000


def customer_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Customers in large documents, one JSON array over several lines each."""
    customers = table(spark, folder, "customer")
    entry = F.to_json(F.struct("c_custkey", "c_mktsegment"))
    return (
        customers.groupBy(F.floor(F.col("c_custkey") / ENTRIES).alias("bucket"))
        .agg(F.array_sort(F.collect_list(F.struct("c_custkey", entry.alias("text")))).alias("entries"))
        .select("bucket", F.concat(F.lit("[\n"), F.array_join("entries.text", ",\n"), F.lit("\n]")).alias("value"))
    )


@query("scan_json_document", "SELECT c_custkey, c_mktsegment FROM customer")
def scan_json_document_query(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "documents")
    customer_documents(spark, folder).write.partitionBy("bucket").text(path)
    schema = table(spark, folder, "customer").select("c_custkey", "c_mktsegment").schema
    return scan_json_document(spark, path, schema).select("c_custkey", "c_mktsegment")


@query(
    "scan_array_document",
    """SELECT c_custkey, c_mktsegment, row_number() OVER (PARTITION BY c_custkey // 50000 ORDER BY c_custkey) - 1 AS element
       FROM customer""",
)
def scan_array_document_query(spark: SparkSession, folder: str) -> DataFrame:
    """Elements of large arrays with their numbers."""
    path = scratch_path(spark, "arrays")
    customer_documents(spark, folder).write.partitionBy("bucket").text(path)
    kind = table(spark, folder, "customer").select("c_custkey", "c_mktsegment").schema
    return scan_array_document(spark, path, kind).select("value.*", "element")


def keyed_matches(spark: SparkSession, folder: str) -> DataFrame:
    """``bucket, key, value``: matches and the documents they belong to. Every order is a match."""
    match = F.struct(
        F.col("o_orderpriority").alias("server"),
        (F.col("o_orderstatus") == "F").alias("official"),
        F.unix_seconds(F.col("o_orderdate").cast("timestamp")).alias("date"),
        F.array(
            F.struct(F.col("o_orderstatus").alias("name"), F.floor("o_totalprice").alias("score")),
            F.struct(F.col("o_orderpriority").alias("name"), F.col("o_custkey").alias("score")),
        ).alias("teams"),
    )
    return table(spark, folder, "orders").select(
        F.floor(F.col("o_orderkey") / ENTRIES).alias("bucket"), F.col("o_orderkey").cast("string").alias("key"), match.alias("value")
    )


def keyed_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Large documents of matches keyed by number, as column values."""
    return (
        keyed_matches(spark, folder)
        .groupBy("bucket")
        .agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("m"))
        .select("bucket", F.to_json("m").alias("value"))
    )


def write_keyed_documents(spark: SparkSession, folder: str, path: str) -> None:
    """The same documents as files, written member by member, so that no task holds a whole one."""
    inside = Window.partitionBy("bucket").orderBy("key")
    repeated = F.lag("key").over(inside) == F.col("key")
    twice = F.raise_error(F.concat(F.lit("duplicate map key "), F.col("key")))
    member = F.to_json(F.create_map("key", "value"))  # {"key":{...}}; refuses a null key
    lines = keyed_matches(spark, folder).select(
        "bucket",
        "key",
        F.when(F.row_number().over(inside) == 1, "{").otherwise(",").alias("before"),
        F.when(repeated, twice).otherwise(member).alias("member"),
        F.when(F.lead("key").over(inside).isNull(), "}").otherwise("").alias("behind"),
    )
    line = F.concat("before", F.expr("substring(member, 2, length(member) - 2)"), "behind")
    ordered = lines.select("bucket", "key", line.alias("value")).sortWithinPartitions("bucket", "key")
    ordered.drop("key").write.partitionBy("bucket").text(path)


MATCHES_SQL = """SELECT CAST(o_orderkey AS VARCHAR) AS match_id, o_orderpriority AS server, o_orderstatus = 'F' AS official,
        0 AS team, o_orderstatus AS team_name, CAST(floor(o_totalprice) AS BIGINT) AS team_score FROM orders
       UNION ALL SELECT CAST(o_orderkey AS VARCHAR), o_orderpriority, o_orderstatus = 'F', 1,
        o_orderpriority, o_custkey FROM orders"""
MATCH_COLUMNS = ("match_id", "server", "official", "team", "team_name", "team_score")


@query("explode_keyed_json", MATCHES_SQL)
def explode_keyed_json(spark: SparkSession, folder: str) -> DataFrame:
    documents = keyed_documents(spark, folder).select(F.col("value").alias("document"))
    return explode_matches(explode_keyed_document(documents, MATCH)).select(*MATCH_COLUMNS)


@query("scan_keyed_document", MATCHES_SQL)
def scan_keyed_document_query(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "matches")
    write_keyed_documents(spark, folder, path)
    return explode_matches(scan_keyed_document(spark, path, MATCH)).select(*MATCH_COLUMNS)


@query(
    "explode_match_players",
    """SELECT CAST(l_orderkey AS VARCHAR) AS match_id, l_returnflag AS name, CAST(l_quantity AS BIGINT) AS score,
        CAST(l_linenumber AS BIGINT) AS team FROM lineitem""",
)
def explode_match_players_query(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    player = F.struct(
        F.col("l_returnflag").alias("name"),
        F.col("l_quantity").cast("bigint").alias("score"),
        F.col("l_linenumber").alias("team"),
    )
    # At most 1000 lines a document, however many an order has.
    part = F.floor(F.col("l_linenumber") / 1000).alias("part")
    matches = lines.groupBy("l_orderkey", part).agg(F.collect_list(player).alias("players"))
    text = F.to_json(F.create_map(F.col("l_orderkey").cast("string"), F.col("players")))
    documents = matches.select(text.alias("document"))
    players = explode_match_players(explode_keyed_document(documents, MATCH_PLAYERS))
    return players.select("match_id", "name", "score", "team")


@query(
    "scan_features_coerce",
    f"""WITH {score_features()}
        SELECT player_id, CAST(churned AS INTEGER) AS churned, "bestScore",
               CASE WHEN "playCount" > 1 THEN {rounded('"meanScore"')} END AS "meanScore" FROM features""",
)
def scan_features_coerce(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "feature-text")
    rows = feature_table(score_table(spark, folder)).select(
        "player_id",
        "churned",
        "bestScore",
        F.when(F.col("playCount") > 1, F.col("meanScore").cast("string")).otherwise("n/a").alias("meanScore"),
    )
    write_csv(rows, path)
    read = scan_features(spark, path)
    return read.select("player_id", F.col("churned").cast("int").alias("churned"), "bestScore", *rounded_columns("meanScore"))


@query(
    "sink_jsonl_roundtrip",
    f"""WITH {race_labels()}
        SELECT player_id, churned, {iso('op_start')} AS op_start, {iso('cp_end')} AS cp_end, op_event_count,
               cp_event_count FROM labels""",
)
def sink_jsonl_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "labelled")
    labelled = nest_labelled_events(race_events(spark, folder), "event", "score", horizon=RACE)
    write_json_lines(labelled, path)
    return scan_json_lines(spark, path, labelled.schema).rows.select(
        "player_id",
        "churned",
        "op_start",
        "cp_end",
        F.size("observation_records").cast("bigint").alias("op_event_count"),
        F.coalesce(F.size("churn_period_records"), F.lit(0)).cast("bigint").alias("cp_event_count"),
    )


@query(
    "sink_score_logs",
    f"""SELECT player_id, count(*) AS plays, CAST(sum(floor(score)) AS DOUBLE) AS total
        FROM ({SCORE_EVENTS}) GROUP BY player_id""",
)
def sink_score_logs(spark: SparkSession, folder: str) -> DataFrame:
    """Flat rows to nested player logs on disk, and back to events."""
    path = scratch_path(spark, "score-logs")
    events = score_events(spark, folder).withColumn("time", F.unix_seconds("ts"))
    whole = events.withColumn("score", F.floor("score"))
    nested = nest_events(whole, "time", "score", "event").withColumnRenamed("player_id", "device_id")
    write_json_lines(nested.drop("part"), path)
    read = events_from_score_logs(scan_json_lines(spark, path, SCORE_LOG).rows)
    return read.groupBy("player_id").agg(F.count_if("is_play").alias("plays"), F.sum("score").alias("total"))


@query(
    "sink_metrics_json",
    f"""{PREDICTIONS_SQL} SELECT dataset, model, 'roc_auc' AS metric, roc_auc AS value FROM wide
        UNION ALL SELECT dataset, model, 'f1_score', f1_score FROM wide""",
)
def sink_metrics_json(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "metrics")
    long = melt_metrics(wide_metrics(spark, folder), "dataset", "model", metrics=("roc_auc", "f1_score"))
    write_json_lines(long, path)
    return scan_json_lines_strict(spark, path, long.schema)


@query(
    "sink_features_csv",
    f"""WITH {race_features()} SELECT player_id, CAST(churned AS INTEGER) AS churned, "playCount", "bestScore",
        "highestPrice" FROM features""",
)
def sink_features_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "features")
    features = feature_table(race_table(spark, folder), purchases=True)
    write_csv(features, path)
    return scan_csv(spark, path, features.schema).select("player_id", "churned", "playCount", "bestScore", "highestPrice")


@query(
    "stream_player_logs",
    f"""SELECT player_id, count(*) AS n, count(*) FILTER (WHERE is_play) AS plays,
        count(*) FILTER (WHERE is_purchase) AS purchases FROM ({RACE_EVENTS}) GROUP BY player_id""",
)
def stream_player_logs(spark: SparkSession, folder: str) -> DataFrame:
    """The same logs, taken in as a stream of files."""
    source = _race_log_file(spark, folder, broken=True)
    target, checkpoint = scratch_path(spark, "ingested"), scratch_path(spark, "ingest-state")
    ingest_player_logs(spark, source, target, checkpoint).awaitTermination()
    events = read_ingested(spark, target)
    return events.groupBy("player_id").agg(
        F.count("*").alias("n"),
        F.count_if("is_play").alias("plays"),
        F.count_if("is_purchase").alias("purchases"),
    )
