"""Per-player and per-event queries: labels, features, ordering, summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from afterplay.functions.numbers import round_half_up
from afterplay.functions.timing import iso_time
from afterplay.operators.events import (
    assign_to_bounds,
    assign_windows,
    first_events,
    nest_events,
    nest_labelled_events,
    time_ordered,
)
from afterplay.operators.player_table import (
    COMMON_FEATURES,
    PURCHASE_FEATURES,
    churn_labels,
    feature_table,
    label_job_counts,
    player_table,
)
from afterplay.operators.stats import (
    class_distribution,
    dataset_stats,
    error_rate,
    feature_means,
    flag_invalid_players,
    gameplay_share,
    sample_players,
    union_features,
)
from afterplay.plans.fragments import (
    RACE,
    RACE_EVENTS,
    SCORE,
    SCORE_EVENTS,
    feature_ctes,
    iso,
    label_ctes,
    race_features,
    race_labels,
    rounded,
    score_features,
    score_labels,
)
from afterplay.plans.queries_rows import race_events, race_table, rounded_columns, score_events, score_table
from afterplay.plans.registry import query, table

# The features that are shown as they are.
EXACT_FEATURES = ("playCount", "bestScore", "worstScore", "purchaseCount", "highestPrice")


def shown_features(purchases: bool) -> list:
    names = COMMON_FEATURES + PURCHASE_FEATURES if purchases else COMMON_FEATURES
    return [F.col(n) if n in EXACT_FEATURES else rounded_columns(n)[0] for n in names]


def shown_features_sql(purchases: bool) -> str:
    names = COMMON_FEATURES + PURCHASE_FEATURES if purchases else COMMON_FEATURES
    quoted = {n: f'"{n}"' for n in names}
    return ", ".join(q if n in EXACT_FEATURES else f"{rounded(q)} AS {q}" for n, q in quoted.items())


# Labels ---------------------------------------------------------------------------------

LABELS_SQL = f"""SELECT player_id, churned, {iso('op_start')} AS op_start, {iso('op_end')} AS op_end,
    {iso('cp_start')} AS cp_start, {iso('cp_end')} AS cp_end, op_event_count, cp_event_count FROM labels"""


def _shown_labels(labels):
    ends = ("op_start", "op_end", "cp_start", "cp_end")
    return labels.select(
        "player_id", "churned", *[iso_time(F.col(e)).alias(e) for e in ends], "op_event_count", "cp_event_count"
    )


@query("churn_labels", f"WITH {score_labels()} {LABELS_SQL}")
def churn_labels_query(spark, folder):
    return _shown_labels(churn_labels(score_events(spark, folder), SCORE))


@query("churn_labels_race_game", f"WITH {race_labels()} {LABELS_SQL}")
def churn_labels_race_game(spark, folder):
    return _shown_labels(churn_labels(race_events(spark, folder), RACE))


@query(
    "churn_labels_uncensored",
    f"WITH {race_labels()} {LABELS_SQL} WHERE cp_end <= TIMESTAMP '2024-01-06 18:00:00'",
)
def churn_labels_uncensored(spark, folder):
    until = F.lit("2024-01-06 18:00:00").cast("timestamp")
    return _shown_labels(churn_labels(race_events(spark, folder), RACE, observed_until=until))


@query(
    "label_job_counts",
    f"""WITH {score_labels()}
        SELECT (SELECT count(*) FROM labels) AS processed,
               (SELECT count(*) FROM customer) - (SELECT count(*) FROM labels) AS skipped""",
)
def label_job_counts_query(spark, folder):
    players = table(spark, folder, "customer").select("c_custkey")
    return label_job_counts(players, churn_labels(score_events(spark, folder), SCORE))


@query("first_event", f"SELECT player_id, {iso('min(ts)')} AS first_ts FROM ({RACE_EVENTS}) GROUP BY player_id")
def first_event(spark, folder):
    return first_events(race_events(spark, folder)).select("player_id", iso_time(F.col("first_ts")).alias("first_ts"))


ASSIGNED_SQL = """SELECT player_id, pos, phase FROM tagged"""


@query("interval_assign", f"WITH {race_labels()} {ASSIGNED_SQL}")
def interval_assign(spark, folder):
    return assign_windows(race_events(spark, folder), RACE).select("player_id", "pos", "phase")


@query("interval_assign_join", f"WITH {race_labels()} {ASSIGNED_SQL}")
def interval_assign_join(spark, folder):
    events = race_events(spark, folder)
    return assign_to_bounds(events, churn_labels(events, RACE)).select("player_id", "pos", "phase")


# Order ----------------------------------------------------------------------------------

ORDERED_SQL = f"""(SELECT player_id, pos, row_number() OVER w - 1 AS position,
    CAST(epoch_us(ts) - epoch_us(lag(ts) OVER w) AS DOUBLE) / 1e6 AS gap_seconds
    FROM ({SCORE_EVENTS}) WINDOW w AS (PARTITION BY player_id ORDER BY ts, pos))"""


@query("event_position", f"SELECT player_id, pos, position FROM {ORDERED_SQL}")
def event_position(spark, folder):
    return time_ordered(score_events(spark, folder)).select("player_id", "pos", "position")


@query("event_gaps", f"SELECT player_id, pos, gap_seconds FROM {ORDERED_SQL}")
def event_gaps(spark, folder):
    return time_ordered(score_events(spark, folder)).select("player_id", "pos", "gap_seconds")


@query(
    "sorted_events",
    f"""SELECT player_id, pos, event, row_number() OVER (PARTITION BY player_id ORDER BY ts, pos) - 1 AS position
        FROM ({RACE_EVENTS})""",
)
def sorted_events(spark, folder):
    return time_ordered(race_events(spark, folder)).select("player_id", "pos", "event", "position")


def _listed(phase: str | None) -> str:
    where = "" if phase is None else f" FILTER (WHERE phase = '{phase}')"
    return f"""coalesce(string_agg(event || '@' || epoch_us(ts), ',' ORDER BY ts, pos){where}, '')"""


def _listing(records: str):
    event = lambda e: F.concat(e["event"], F.lit("@"), F.unix_micros(e["ts"]).cast("string"))
    return F.array_join(F.transform(F.col(records), event), ",").alias(records)


@query(
    "nest_player_events",
    f"SELECT player_id, {_listed(None)} AS records FROM ({RACE_EVENTS}) GROUP BY player_id",
)
def nest_player_events(spark, folder):
    return nest_events(race_events(spark, folder), "event").select("player_id", _listing("records"))


@query(
    "nest_labelled_events",
    f"""WITH {race_labels()}
        SELECT player_id, {_listed('op')} AS observation_records, {_listed('cp')} AS churn_period_records
        FROM tagged GROUP BY player_id""",
)
def nest_labelled_events_query(spark, folder):
    nested = nest_labelled_events(race_events(spark, folder), "event", horizon=RACE)
    return nested.select("player_id", _listing("observation_records"), _listing("churn_period_records"))


# Features -------------------------------------------------------------------------------

FEATURE_QUERIES = {
    "feat_play_count": "playCount",
    "feat_best_score": "bestScore",
    "feat_mean_score": "meanScore",
    "feat_worst_score": "worstScore",
    "feat_sd_score": "sdScore",
    "feat_best_score_index": "bestScoreIndex",
    "feat_best_sub_mean_count": "bestSubMeanCount",
    "feat_best_sub_mean_ratio": "bestSubMeanRatio",
    "feat_active_duration": "activeDuration",
    "feat_consecutive_ratio": "consecutivePlayRatio",
}


def _register_feature(name: str, feature: str) -> None:
    shown = f'"{feature}"' if feature in EXACT_FEATURES else rounded(f'"{feature}"')

    @query(
        name,
        f"""WITH {score_features()}, {feature_ctes(RACE_EVENTS, RACE, 'race_')}
            SELECT 'score' AS game, player_id, {shown} AS "{feature}" FROM features UNION ALL
            SELECT 'race' AS game, player_id, {shown} AS "{feature}" FROM race_features""",
    )
    def one_feature(spark, folder):
        column = F.col(feature) if feature in EXACT_FEATURES else rounded_columns(feature)[0]
        games = {"score": score_table(spark, folder), "race": race_table(spark, folder)}
        score, race = (rows.select(F.lit(game).alias("game"), "player_id", column) for game, rows in games.items())
        return score.unionByName(race)


for _name, _feature in FEATURE_QUERIES.items():
    _register_feature(_name, _feature)


@query("feat_purchase_count", f"""WITH {race_features()} SELECT player_id, "purchaseCount" FROM features""")
def feat_purchase_count(spark, folder):
    return race_table(spark, folder).select("player_id", "purchaseCount")


@query("feat_highest_price", f"""WITH {race_features()} SELECT player_id, "highestPrice" FROM features""")
def feat_highest_price(spark, folder):
    return race_table(spark, folder).select("player_id", "highestPrice")


# A race game in which only dear clicks are plays leaves many players without any.
SPARSE_EVENTS = RACE_EVENTS.replace("event_type IN ('view', 'click')", "(event_type = 'click' AND value > 60)")


@query(
    "feat_empty_defaults",
    f"""WITH {feature_ctes(SPARSE_EVENTS, RACE)}
        SELECT player_id, churned, {shown_features_sql(True)} FROM features WHERE "playCount" = 0""",
)
def feat_empty_defaults(spark, folder):
    events = race_events(spark, folder)
    play = (F.col("event") == "click") & (F.col("score") > 60)
    sparse = events.withColumn("is_play", play).withColumn("score", F.when(play, F.col("score")))
    rows = player_table(sparse, RACE, purchases=True).filter("playCount = 0")
    return rows.select("player_id", "churned", *shown_features(True))


@query(
    "features_score_game",
    f"""WITH {score_features()}
        SELECT player_id, CAST(churned AS INTEGER) AS churned, {shown_features_sql(False)} FROM features""",
)
def features_score_game(spark, folder):
    return feature_table(score_table(spark, folder)).select("player_id", "churned", *shown_features(False))


@query(
    "features_race_game",
    f"""WITH {race_features()}
        SELECT player_id, CAST(churned AS INTEGER) AS churned, {shown_features_sql(True)} FROM features""",
)
def features_race_game(spark, folder):
    rows = feature_table(race_table(spark, folder), purchases=True)
    return rows.select("player_id", "churned", *shown_features(True))


@query(
    "label_feature_join",
    f"""WITH {score_features()} SELECT player_id, churned, op_event_count, "playCount", "bestScore" FROM features""",
)
def label_feature_join(spark, folder):
    events = score_events(spark, folder)
    features = score_table(spark, folder).select("player_id", "playCount", "bestScore")
    labels = churn_labels(events, SCORE).select("player_id", "churned", "op_event_count")
    return labels.join(features, "player_id")


# Summaries ------------------------------------------------------------------------------


@query(
    "feature_error_rate",
    f"""WITH {race_labels()}
        SELECT count(*) AS players, count(*) FILTER (WHERE op_event_count <= 8) AS errors,
               {rounded("count(*) FILTER (WHERE op_event_count <= 8) / count(*)")} AS error_rate,
               count(*) FILTER (WHERE op_event_count <= 8) > 0.1 * count(*) AS too_many
        FROM labels""",
)
def feature_error_rate(spark, folder):
    records = nest_labelled_events(race_events(spark, folder), "event", horizon=RACE)
    short = F.col("op_event_count") <= 8
    spoiled = records.withColumn("player_id", F.when(short, F.lit(None)).otherwise(F.col("player_id")))
    return error_rate(flag_invalid_players(spoiled)).select(
        "players", "errors", *rounded_columns("error_rate"), "too_many"
    )


@query(
    "feature_means",
    f"""WITH {race_features()}
        SELECT {rounded('avg("activeDuration")')} AS "avg_activeDuration",
               {rounded('avg("playCount")')} AS "avg_playCount",
               {rounded('avg("meanScore")')} AS "avg_meanScore" FROM features""",
)
def feature_means_query(spark, folder):
    names = ("avg_activeDuration", "avg_playCount", "avg_meanScore")
    return feature_means(race_table(spark, folder)).select(*rounded_columns(*names))


def _stats_sql(labels: str, game: str) -> str:
    parts = []
    for prefix, name in (("op", "op_event_count"), ("cp", "cp_event_count")):
        parts.append(
            f"""{rounded(f'avg({name})')} AS {prefix}_mean, min({name}) AS {prefix}_min,
                max({name}) AS {prefix}_max, {rounded(f'stddev_pop({name})')} AS {prefix}_std"""
        )
    churned = "count(*) FILTER (WHERE churned)"
    return f"""SELECT '{game}' AS game, count(*) AS total_players, {churned} AS churned_players,
        count(*) - {churned} AS retained_players, {rounded(f'{churned} / count(*)')} AS churn_rate,
        {rounded(f'(count(*) - {churned}) / count(*)')} AS retention_rate, {', '.join(parts)} FROM {labels}"""


STATS_SQL = f"""WITH {score_labels()}, {label_ctes(RACE_EVENTS, RACE, 'race_')}
    {_stats_sql('labels', 'score')} UNION ALL {_stats_sql('race_labels', 'race')}"""
STAT_RATES = ("churn_rate", "retention_rate", "op_mean", "op_std", "cp_mean", "cp_std")


def _both_labels(spark, folder):
    score = churn_labels(score_events(spark, folder), SCORE).withColumn("game", F.lit("score"))
    race = churn_labels(race_events(spark, folder), RACE).withColumn("game", F.lit("race"))
    return score.unionByName(race)


@query("dataset_stats", STATS_SQL)
def dataset_stats_query(spark, folder):
    stats = dataset_stats(_both_labels(spark, folder), "game", exact=True)
    others = [c for c in stats.columns if c not in STAT_RATES]
    return stats.select(*others, *rounded_columns(*STAT_RATES))


@query(
    "gameplay_ratio",
    f"""WITH {race_features()}
        SELECT count(*) AS players, CAST(sum("playCount") AS BIGINT) AS play_events,
               CAST(sum(op_event_count) AS BIGINT) AS all_events,
               {rounded('sum("playCount") / sum(op_event_count)')} AS gameplay_ratio,
               {rounded('avg(CAST(churned AS INTEGER))')} AS churn_rate,
               12 AS feature_count, 12 AS expected_features FROM features""",
)
def gameplay_ratio(spark, folder):
    rows = feature_table(race_table(spark, folder), purchases=True, metadata=True)
    features = [c for c in rows.columns if c in COMMON_FEATURES + PURCHASE_FEATURES]
    share = gameplay_share(rows, len(features), len(COMMON_FEATURES + PURCHASE_FEATURES))
    rates = ("gameplay_ratio", "churn_rate")
    return share.select(*[c for c in share.columns if c not in rates], *rounded_columns(*rates))


@query(
    "class_distribution",
    f"""WITH {score_labels()}
        SELECT CAST(churned AS INTEGER) AS churned, count(*) AS n,
               {rounded('count(*) / sum(count(*)) OVER ()')} AS share FROM labels GROUP BY churned""",
)
def class_distribution_query(spark, folder):
    labels = churn_labels(score_events(spark, folder), SCORE).select(F.col("churned").cast("int").alias("churned"))
    return class_distribution(labels).select("churned", "n", *rounded_columns("share"))


def samples_sql(prefix: str = "") -> str:
    """The first observed events of the first players, from the label CTEs with that prefix."""
    return f"""
    SELECT player_id, churned, op_event_count, cp_event_count, position, shown_at, event, score_shown
    FROM (SELECT t.player_id, l.churned, l.op_event_count, l.cp_event_count,
                 strftime(t.ts, '%Y-%m-%d %H:%M:%S') AS shown_at, t.event,
                 coalesce(CAST(t.score AS VARCHAR), 'N/A') AS score_shown,
                 row_number() OVER (PARTITION BY t.player_id ORDER BY t.ts, t.pos) - 1 AS position
          FROM {prefix}tagged t
          JOIN (SELECT * FROM {prefix}labels ORDER BY player_id LIMIT 3) l ON t.player_id = l.player_id
          WHERE t.phase = 'op')
    WHERE position < 3"""


def _samples(events: DataFrame, labels: DataFrame) -> DataFrame:
    return sample_players(labels, events).select(
        "player_id",
        "churned",
        "op_event_count",
        "cp_event_count",
        F.col("position").cast("bigint").alias("position"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("shown_at"),
        "event",
        "score_shown",
    )


@query("sample_players", f"WITH {race_labels()} {samples_sql()}")
def sample_players_query(spark, folder):
    events = race_events(spark, folder)
    return _samples(events, churn_labels(events, RACE))


def _inspected_sql(game: str, prefix: str) -> str:
    return f"""SELECT '{game}' AS game, p.*, s.* FROM ({samples_sql(prefix)}) p,
        (SELECT count(*) AS total_players, {rounded('avg(op_event_count)')} AS op_mean,
                {rounded('avg(cp_event_count)')} AS cp_mean FROM {prefix}labels) s"""


@query(
    "inspect_labelled",
    f"""WITH {label_ctes(SCORE_EVENTS, SCORE, 'score_')}, {label_ctes(RACE_EVENTS, RACE, 'race_')}
        {_inspected_sql('score', 'score_')} UNION ALL {_inspected_sql('race', 'race_')}""",
)
def inspect_labelled(spark, folder):
    """Summary and samples of both games."""
    shown = []
    for game, events, horizon in (("score", score_events(spark, folder), SCORE), ("race", race_events(spark, folder), RACE)):
        labels = churn_labels(events, horizon)
        stats = dataset_stats(labels, exact=True).first()
        means = rounded_columns_of({"op_mean": stats.op_mean, "cp_mean": stats.cp_mean})
        shown.append(_samples(events, labels).select(F.lit(game).alias("game"), "*", F.lit(stats.total_players).alias("total_players"), *means))
    return shown[0].unionByName(shown[1])


def rounded_columns_of(values: dict[str, float]) -> list:
    return [round_half_up(F.lit(v)).alias(name) for name, v in values.items()]


@query(
    "union_features",
    f"""WITH {score_features()}, {feature_ctes(RACE_EVENTS, RACE, 'race_')}
        SELECT player_id, "playCount", "bestScore", CAST(NULL AS BIGINT) AS "purchaseCount" FROM features
        UNION ALL SELECT player_id, "playCount", "bestScore", "purchaseCount" FROM race_features""",
)
def union_features_query(spark, folder):
    score, race = feature_table(score_table(spark, folder)), feature_table(race_table(spark, folder), purchases=True)
    return union_features(score, race).select("player_id", "playCount", "bestScore", "purchaseCount")
