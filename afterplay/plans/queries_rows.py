"""Row-level queries: time, identity, predicates, guards, projections, text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from afterplay.functions.display import PROMPT_AFTER, PROMPT_BEFORE, PROMPT_FEATURES, feature_prompt, shorten
from afterplay.functions.identity import has_player_id, resolve_player_id
from afterplay.functions.numbers import round_half_up, variant_number
from afterplay.functions.timing import (
    epoch_convert,
    epoch_to_timestamp,
    epoch_unit,
    format_time,
    iso_time,
    window_bounds,
    within_period,
)
from afterplay.operators.events import detect_game, nest_labelled_events
from afterplay.operators.player_table import feature_table, player_table
from afterplay.operators.prepare import (
    clean_features,
    drop_null_target,
    drop_present,
    target_strict,
    target_to_binary,
)
from afterplay.operators.stats import flag_invalid_players
from afterplay.plans.fragments import (
    RACE,
    RACE_EVENTS,
    SCORE,
    SCORE_EVENTS,
    iso,
    race_features,
    race_labels,
    score_features,
    score_labels,
)
from afterplay.plans.registry import query, table
from afterplay.sources.adapters import (
    events_from_clicks,
    events_from_orders,
    events_from_score_logs,
    is_purchase,
    is_race_play,
)
from afterplay.sources.readers import coerce_numeric


def score_events(spark: SparkSession, folder: str) -> DataFrame:
    return events_from_orders(table(spark, folder, "orders"))


def race_events(spark: SparkSession, folder: str) -> DataFrame:
    return events_from_clicks(table(spark, folder, "events"))


def score_table(spark: SparkSession, folder: str) -> DataFrame:
    return player_table(score_events(spark, folder), SCORE)


def race_table(spark: SparkSession, folder: str) -> DataFrame:
    return player_table(race_events(spark, folder), RACE, purchases=True)


def rounded_columns(*names: str) -> list[Column]:
    return [round_half_up(F.col(name)).alias(name) for name in names]


# Time -----------------------------------------------------------------------------------

EPOCHS_SQL = """(SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN epoch(o_orderdate) * 1000
    ELSE epoch(o_orderdate) END AS time, o_orderdate FROM orders)"""


def _epochs(spark: SparkSession, folder: str) -> DataFrame:
    seconds = F.unix_seconds(F.col("o_orderdate").cast("timestamp")).cast("double")
    time = F.when(F.col("o_orderstatus") == "F", seconds * 1000).otherwise(seconds)
    return table(spark, folder, "orders").select("o_orderkey", time.alias("time"))


@query(
    "epoch_unit",
    f"""SELECT CASE WHEN time > 1e10 THEN 'milliseconds' ELSE 'seconds' END AS unit,
        count(*) AS n FROM {EPOCHS_SQL} GROUP BY 1""",
)
def epoch_unit_query(spark, folder):
    return _epochs(spark, folder).groupBy(epoch_unit(F.col("time")).alias("unit")).agg(F.count("*").alias("n"))


@query("epoch_to_timestamp", f"SELECT o_orderkey, {iso('o_orderdate')} AS at FROM {EPOCHS_SQL}")
def epoch_to_timestamp_query(spark, folder):
    return _epochs(spark, folder).select("o_orderkey", iso_time(epoch_to_timestamp(F.col("time"))).alias("at"))


@query(
    "epoch_convert",
    """SELECT event_id, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS seconds,
        CAST(floor(epoch_us(ts) / 1000) AS BIGINT) AS milliseconds FROM events""",
)
def epoch_convert_query(spark, folder):
    millis = F.unix_micros(F.col("ts").cast("timestamp")) / 1000.0
    events = table(spark, folder, "events").select("event_id", millis.alias("time"))
    return events.select(
        "event_id",
        epoch_convert(F.col("time"), "seconds").alias("seconds"),
        epoch_convert(F.col("time"), "milliseconds").alias("milliseconds"),
    )


@query("format_ts", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS shown FROM events")
def format_ts(spark, folder):
    events = table(spark, folder, "events")
    return events.select("event_id", format_time(F.col("ts").cast("timestamp")).alias("shown"))


@query(
    "window_bounds",
    f"""SELECT event_id, {iso('ts')} AS op_start, {iso("ts + INTERVAL '5 days'")} AS op_end,
        {iso("ts + INTERVAL '5 days'")} AS cp_start, {iso("ts + INTERVAL '15 days'")} AS cp_end
        FROM events""",
)
def window_bounds_query(spark, folder):
    bounds = window_bounds(F.col("ts").cast("timestamp"))
    events = table(spark, folder, "events")
    return events.select("event_id", *[iso_time(end).alias(name) for name, end in bounds.items()])


@query(
    "within_period",
    """SELECT o_orderkey, o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate <= TIMESTAMP '1996-12-31'
        AS inside FROM orders""",
)
def within_period_query(spark, folder):
    start, end = (F.lit(day).cast("timestamp") for day in ("1995-01-01", "1996-12-31"))
    orders = table(spark, folder, "orders")
    return orders.select("o_orderkey", within_period(F.col("o_orderdate").cast("timestamp"), start, end).alias("inside"))


# Identity -------------------------------------------------------------------------------

ID_ROWS_SQL = """(SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN c_name
        WHEN 'MACHINERY' THEN '' END AS device_id,
    CASE WHEN c_mktsegment IN ('MACHINERY', 'HOUSEHOLD') THEN c_nationkey END AS uid,
    CASE WHEN c_mktsegment <> 'AUTOMOBILE' THEN c_nationkey END AS player_id FROM customer)"""
RESOLVED_SQL = """coalesce(nullif(device_id, ''), nullif(CAST(uid AS VARCHAR), '0'),
    CAST(player_id AS VARCHAR))"""


def _id_rows(spark: SparkSession, folder: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    return table(spark, folder, "customer").select(
        "c_custkey",
        F.when(segment == "BUILDING", F.col("c_name")).when(segment == "MACHINERY", "").alias("device_id"),
        F.when(segment.isin("MACHINERY", "HOUSEHOLD"), F.col("c_nationkey")).alias("uid"),
        F.when(segment != "AUTOMOBILE", F.col("c_nationkey")).alias("player_id"),
    )


@query("resolve_player_id", f"SELECT c_custkey, {RESOLVED_SQL} AS resolved FROM {ID_ROWS_SQL}")
def resolve_player_id_query(spark, folder):
    rows = _id_rows(spark, folder)
    return rows.select("c_custkey", resolve_player_id(rows).alias("resolved"))


@query(
    "drop_missing_id",
    f"""SELECT count({RESOLVED_SQL}) AS kept, count(*) - count({RESOLVED_SQL}) AS skipped
        FROM {ID_ROWS_SQL}""",
)
def drop_missing_id(spark, folder):
    rows = _id_rows(spark, folder)
    found = F.coalesce(has_player_id(resolve_player_id(rows)), F.lit(False))
    return rows.agg(F.count_if(found).alias("kept"), F.count_if(~found).alias("skipped"))


# Predicates on events -------------------------------------------------------------------


@query(
    "play_events_score_game",
    """SELECT CAST(o_custkey AS VARCHAR) AS player_id, 0 AS pos, o_totalprice AS score, o_orderkey AS second
       FROM orders WHERE o_orderstatus = 'F'
       UNION ALL SELECT CAST(o_custkey AS VARCHAR), 1, NULL, o_orderkey FROM orders WHERE o_orderpriority LIKE '1%'""",
)
def play_events_score_game(spark, folder):
    """Nested logs in which some events are plays and others carry other names, near ones too."""
    other = F.element_at(F.array(*map(F.lit, ("login", "Play", "play ", "", "replay"))), F.pmod("o_orderkey", F.lit(5)).cast("int") + 1)
    time = F.col("o_orderkey").cast("double")

    def record(event, score):
        return F.struct(time.alias("time"), score.alias("score"), event.alias("event"))

    logs = table(spark, folder, "orders").select(
        F.col("o_custkey").cast("string").alias("device_id"),
        F.array(
            record(F.when(F.col("o_orderstatus") == "F", "play").otherwise(other), F.col("o_totalprice")),
            record(F.when(F.col("o_orderpriority").startswith("1"), "play").when(time % 3 > 0, other), F.lit(None).cast("double")),
        ).alias("records"),
    )
    plays = events_from_score_logs(logs).filter("is_play")
    return plays.select("player_id", "pos", "score", F.unix_seconds("ts").alias("second"))


def _race_properties(spark: SparkSession, folder: str) -> DataFrame:
    """Web events with a nested property object whose fields vary from row to row."""
    k = F.get_json_object("props", "$.k").cast("int")
    reward = F.when(k < 60, F.col("value").cast("string"))
    quoted = F.concat(F.lit('"'), F.col("value").cast("string"), F.lit('"'))
    text = F.concat(
        F.lit('{"action":"'),
        F.when(k >= 50, "complete").otherwise("start"),
        F.lit('","type":"'),
        F.when(F.col("event_type") == "view", "race").otherwise("training"),
        F.lit('","reward":'),
        F.coalesce(reward, F.when(k < 80, quoted), F.when(k < 90, F.lit("true")), F.lit("null")),
        F.lit("}"),
    )
    kind = F.when(F.col("event_type").isin("view", "click"), "progress").otherwise(F.col("event_type"))
    return table(spark, folder, "events").select(
        "event_id", kind.alias("event"), F.parse_json(text).alias("properties")
    )


K_SQL = "CAST(props ->> '$.k' AS INTEGER)"


@query(
    "play_events_race_game",
    f"""SELECT event_id, CASE WHEN {K_SQL} < 60 THEN value END AS score FROM events
        WHERE event_type = 'view' AND {K_SQL} >= 50""",
)
def play_events_race_game(spark, folder):
    rows = _race_properties(spark, folder)
    action = F.try_variant_get("properties", "$.action", "string")
    kind = F.try_variant_get("properties", "$.type", "string")
    return rows.filter(is_race_play(F.col("event"), action, kind)).select(
        "event_id", variant_number(F.col("properties"), "$.reward").alias("score")
    )


@query("numeric_guard", f"SELECT event_id, CASE WHEN {K_SQL} < 60 THEN value END AS number FROM events")
def numeric_guard(spark, folder):
    rows = _race_properties(spark, folder)
    return rows.select("event_id", variant_number(F.col("properties"), "$.reward").alias("number"))


@query(
    "purchase_events",
    f"SELECT player_id, pos, price FROM ({RACE_EVENTS}) WHERE event IN ('softPurchase', 'hardPurchase', 'purchase')",
)
def purchase_events(spark, folder):
    return race_events(spark, folder).filter(is_purchase(F.col("event"))).select("player_id", "pos", "price")


@query(
    "detect_game_type",
    f"""SELECT player_id, CASE WHEN bool_or(event = 'purchase' AND price > 50) THEN 'race' ELSE 'score' END AS game
        FROM (SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY ts, pos) AS rn FROM ({RACE_EVENTS}))
        WHERE rn <= 10 GROUP BY player_id""",
)
def detect_game_type(spark, folder):
    marker = (F.col("event") == "purchase") & (F.col("price") > 50)
    return detect_game(race_events(spark, folder), marker)


@query(
    "validate_players",
    f"""WITH {race_labels()}
        SELECT {iso('op_start')} AS op_start, op_event_count > 15 AS is_valid,
               churned AS count_mismatch FROM labels""",
)
def validate_players(spark, folder):
    records = nest_labelled_events(race_events(spark, folder), "event", horizon=RACE)
    spoiled = records.withColumn(
        "player_id", F.when(F.col("op_event_count") > 15, F.col("player_id")).otherwise("")
    ).withColumn("op_event_count", F.col("op_event_count") + F.col("churned").cast("int"))
    return flag_invalid_players(spoiled).select("op_start", "is_valid", "count_mismatch")


# Feature rows ---------------------------------------------------------------------------


@query(
    "feature_projection",
    f"""WITH {race_features()}
        SELECT player_id, CAST(churned AS INTEGER) AS churned, "playCount", "bestScore", "purchaseCount",
               "highestPrice", {iso('op_start')} AS op_start, {iso('op_end')} AS op_end, op_event_count
        FROM features""",
)
def feature_projection(spark, folder):
    projected = feature_table(race_table(spark, folder), purchases=True, metadata=True)
    return projected.select(
        "player_id",
        "churned",
        "playCount",
        "bestScore",
        "purchaseCount",
        "highestPrice",
        "op_start",
        "op_end",
        "op_event_count",
    )


@query(
    "clean_features",
    f"""WITH {score_features()}
        SELECT player_id, "playCount",
               CASE WHEN "playCount" <= 3 THEN 0.0 ELSE "bestScore" END AS "bestScore"
        FROM features""",
)
def clean_features_query(spark, folder):
    spoiled = F.when(F.col("playCount") == 1, F.lit(float("inf")))
    spoiled = spoiled.when(F.col("playCount") == 2, F.lit(None)).when(F.col("playCount") == 3, F.lit(float("nan")))
    rows = score_table(spark, folder).select(
        "player_id", "playCount", spoiled.otherwise(F.col("bestScore")).alias("bestScore")
    )
    return clean_features(rows, ["playCount", "bestScore"])


TARGET_SQL = """(SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'True' WHEN 'O' THEN 'false'
    ELSE CASE WHEN o_totalprice > 200000 THEN '1' WHEN o_totalprice > 100000 THEN '0' END END AS churned
    FROM orders)"""


def _targets(spark: SparkSession, folder: str) -> DataFrame:
    price = F.col("o_totalprice")
    rest = F.when(price > 200000, "1").when(price > 100000, "0")
    status = F.col("o_orderstatus")
    target = F.when(status == "F", "True").when(status == "O", "false").otherwise(rest)
    return table(spark, folder, "orders").select("o_orderkey", target.alias("churned"))


@query("drop_null_target", f"SELECT o_orderkey, churned FROM {TARGET_SQL} WHERE churned IS NOT NULL")
def drop_null_target_query(spark, folder):
    return drop_null_target(_targets(spark, folder))


@query(
    "target_to_binary",
    f"""SELECT o_orderkey, CASE WHEN churned IN ('True', '1') THEN 1 ELSE 0 END AS churned
        FROM {TARGET_SQL} WHERE churned IS NOT NULL""",
)
def target_to_binary_query(spark, folder):
    rows = drop_null_target(_targets(spark, folder))
    return rows.select("o_orderkey", target_to_binary(F.col("churned")).alias("churned"))


@query(
    "target_strict",
    f"""SELECT churned IN ('True', '1') AS churned, count(*) AS n
        FROM {TARGET_SQL} WHERE churned IS NOT NULL GROUP BY 1""",
)
def target_strict_query(spark, folder):
    rows = drop_null_target(_targets(spark, folder))
    return rows.groupBy(target_strict(F.col("churned")).alias("churned")).agg(F.count("*").alias("n"))


@query(
    "coerce_numeric",
    """SELECT c_custkey, TRY_CAST(substr(c_name, 10) AS DOUBLE) AS c_name,
        CAST(NULL AS DOUBLE) AS c_mktsegment FROM customer""",
)
def coerce_numeric_query(spark, folder):
    rows = table(spark, folder, "customer").select("c_custkey", F.substring("c_name", 10, 99).alias("c_name"), "c_mktsegment")
    return coerce_numeric(rows)


@query(
    "drop_columns",
    f"""WITH {score_labels()}
        SELECT churned, op_event_count, cp_event_count FROM labels""",
)
def drop_columns(spark, folder):
    labels = score_table(spark, folder).select("player_id", "op_start", "op_end", "churned", "op_event_count", "cp_event_count")
    return drop_present(labels, "player_id", "op_start", "op_end", "cp_start", "cp_end")


# Text -----------------------------------------------------------------------------------


def _shown(name: str) -> str:
    return f"""CAST(CAST(floor("{name}" * 100 + 0.5) / 100 AS DECIMAL(18,2)) AS VARCHAR)"""


_SHORT_SQL = " || ', ' || ".join(f"'{label}: ' || {_shown(name)}" for label, name in PROMPT_FEATURES.items())
_LONG_SQL = " || ', ' || ".join(
    f"'{name}: ' || {_shown(name)}"
    for name in ("playCount", "bestScore", "worstScore", "activeDuration", "purchaseCount", "highestPrice")
)
_BEFORE, _AFTER = PROMPT_BEFORE.format(game=2), PROMPT_AFTER


@query(
    "feature_prompt",
    f"""WITH {race_features()}
        SELECT player_id, '{_BEFORE}' || {_SHORT_SQL} || '{_AFTER}' AS short_prompt,
               '{_BEFORE}' || {_LONG_SQL} || '{_AFTER}' AS long_prompt
        FROM features""",
)
def feature_prompt_query(spark, folder):
    def shown(name: str) -> Column:
        return round_half_up(F.col(name), 2).cast("decimal(18,2)")

    several = ("playCount", "bestScore", "worstScore", "activeDuration", "purchaseCount", "highestPrice")
    return race_table(spark, folder).select(
        "player_id",
        feature_prompt(2, {label: shown(name) for label, name in PROMPT_FEATURES.items()}).alias("short_prompt"),
        feature_prompt(2, {name: shown(name) for name in several}).alias("long_prompt"),
    )


@query(
    "display_truncate",
    """SELECT doc_id, CASE WHEN length(text) > 50 THEN substring(text, 1, 50) || '...' ELSE text END AS shown,
        CASE WHEN length(text) > 100 THEN substring(text, 1, 100) || '...' ELSE text END AS sample
        FROM documents""",
)
def display_truncate(spark, folder):
    documents = table(spark, folder, "documents")
    return documents.select("doc_id", shorten(F.col("text")).alias("shown"), shorten(F.col("text"), 100).alias("sample"))
