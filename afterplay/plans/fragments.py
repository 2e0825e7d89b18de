"""Shared parts of the SQL twins, written independently of the Spark operators.

The twins filter plays and join them back to the labels, where the Spark plan makes one
pass, so that the two check each other.
"""

from __future__ import annotations

from datetime import timedelta

from afterplay.operators.player_table import Horizon

# How the two event tables are read: a score game of orders, a race game of web events.
SCORE = Horizon(
    observation=timedelta(days=365), churn=timedelta(days=180), gap=timedelta(days=90), score_scale=2
)
RACE = Horizon(observation=timedelta(days=5), churn=timedelta(hours=12), gap=timedelta(hours=6), score_scale=2)

SCORE_EVENTS = """
    SELECT CAST(o_custkey AS VARCHAR) AS player_id, o_orderdate AS ts, o_orderkey AS pos,
           'play' AS event, TRUE AS is_play, o_totalprice AS score,
           FALSE AS is_purchase, CAST(NULL AS DOUBLE) AS price
    FROM orders"""

RACE_EVENTS = """
    SELECT CAST(user_id AS VARCHAR) AS player_id, ts, event_id AS pos, event_type AS event,
           event_type IN ('view', 'click') AS is_play,
           CASE WHEN event_type IN ('view', 'click') THEN value END AS score,
           event_type = 'purchase' AS is_purchase,
           CASE WHEN event_type = 'purchase' THEN value END AS price
    FROM events"""


def _seconds(length: timedelta) -> str:
    return f"INTERVAL '{int(length.total_seconds())} seconds'"


def rounded(expression: str) -> str:
    return f"floor(({expression}) * 1e6 + 0.5) / 1e6"


def iso(ts: str) -> str:
    return (
        f"strftime({ts}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN strftime({ts}, '%f') = '000000' "
        f"THEN '' ELSE '.' || strftime({ts}, '%f') END"
    )


def label_ctes(events: str, horizon: Horizon, prefix: str = "") -> str:
    """CTEs ``ev``, ``tagged`` and ``labels`` (names may carry a prefix)."""
    observation, both = _seconds(horizon.observation), _seconds(horizon.observation + horizon.churn)
    p = prefix
    return f"""{p}ev AS ({events}),
{p}starts AS (SELECT player_id, min(ts) AS op_start FROM {p}ev GROUP BY player_id),
{p}tagged AS (
    SELECT e.*, s.op_start, s.op_start + {observation} AS op_end,
           s.op_start + {both} AS cp_end,
           CASE WHEN e.ts <= s.op_start + {observation} THEN 'op'
                WHEN e.ts <= s.op_start + {both} THEN 'cp' END AS phase
    FROM {p}ev e JOIN {p}starts s ON e.player_id = s.player_id),
{p}labels AS (
    SELECT player_id, count(*) FILTER (WHERE phase = 'cp') = 0 AS churned,
           min(op_start) AS op_start, min(op_end) AS op_end,
           min(op_end) AS cp_start, min(cp_end) AS cp_end,
           count(*) FILTER (WHERE phase = 'op') AS op_event_count,
           count(*) FILTER (WHERE phase = 'cp') AS cp_event_count
    FROM {p}tagged GROUP BY player_id)"""


def feature_ctes(events: str, horizon: Horizon, prefix: str = "") -> str:
    """The label CTEs and ``features``: labels with all features, unrounded."""
    p = prefix
    gap = int(horizon.gap.total_seconds()) * 1_000_000
    amount = "CAST(score AS DECIMAL(18,2))"
    return f"""{label_ctes(events, horizon, prefix)},
{p}plays AS (
    SELECT player_id, ts, pos, score,
           epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY player_id ORDER BY ts, pos)) AS pause
    FROM {p}tagged WHERE phase = 'op' AND is_play),
{p}scored AS (
    SELECT player_id, score, row_number() OVER (PARTITION BY player_id ORDER BY ts, pos) - 1 AS idx,
           max(score) OVER (PARTITION BY player_id) AS best
    FROM {p}plays WHERE score IS NOT NULL),
{p}score_sums AS (
    SELECT player_id, count(*) AS n, max(score) AS best, min(score) AS worst,
           CAST(sum({amount}) AS DOUBLE) / count(*) AS mean,
           CASE WHEN count(*) > 1 THEN
               sqrt(CAST(CAST(count(*) AS DECIMAL(9,0)) * CAST(sum({amount} * {amount}) AS DECIMAL(28,4))
                    - CAST(sum({amount}) AS DECIMAL(18,2)) * CAST(sum({amount}) AS DECIMAL(18,2)) AS DOUBLE)
                    / (count(*) * (count(*) - 1.0)))
           ELSE 0.0 END AS sd,
           CASE WHEN count(*) > 1 THEN CAST(max(idx) FILTER (WHERE score = best) AS DOUBLE) / count(*)
                ELSE 0.0 END AS best_index
    FROM {p}scored GROUP BY player_id),
{p}play_sums AS (
    SELECT player_id, count(*) AS n,
           CASE WHEN count(*) > 1 THEN CAST(epoch_us(max(ts)) - epoch_us(min(ts)) AS DOUBLE) / 3600000000
                ELSE 0.0 END AS hours,
           CASE WHEN count(*) > 1 THEN CAST(count(*) FILTER (WHERE pause <= {gap}) AS DOUBLE)
                / (count(*) - 1) ELSE 0.0 END AS close_ratio
    FROM {p}plays GROUP BY player_id),
{p}buys AS (
    SELECT player_id, count(*) AS n, max(price) FILTER (WHERE price > 0) AS top
    FROM {p}tagged WHERE phase = 'op' AND is_purchase GROUP BY player_id),
{p}features AS (
    SELECT l.*, coalesce(p.n, 0) AS "playCount", coalesce(s.best, 0.0) AS "bestScore",
           coalesce(s.mean, 0.0) AS "meanScore", coalesce(s.worst, 0.0) AS "worstScore",
           coalesce(s.sd, 0.0) AS "sdScore", coalesce(s.best_index, 0.0) AS "bestScoreIndex",
           coalesce((s.best - s.mean) / s.n, 0.0) AS "bestSubMeanCount",
           CASE WHEN s.mean <> 0 THEN (s.best - s.mean) / s.mean ELSE 0.0 END AS "bestSubMeanRatio",
           coalesce(p.hours, 0.0) AS "activeDuration",
           coalesce(p.close_ratio, 0.0) AS "consecutivePlayRatio",
           coalesce(b.n, 0) AS "purchaseCount", coalesce(b.top, 0.0) AS "highestPrice"
    FROM {p}labels l
    LEFT JOIN {p}play_sums p ON l.player_id = p.player_id
    LEFT JOIN {p}score_sums s ON l.player_id = s.player_id
    LEFT JOIN {p}buys b ON l.player_id = b.player_id)"""


def score_labels() -> str:
    return label_ctes(SCORE_EVENTS, SCORE)


def race_labels() -> str:
    return label_ctes(RACE_EVENTS, RACE)


def score_features() -> str:
    return feature_ctes(SCORE_EVENTS, SCORE)


def race_features() -> str:
    return feature_ctes(RACE_EVENTS, RACE)
