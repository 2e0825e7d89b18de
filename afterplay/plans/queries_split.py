"""Split queries: exact cuts by hash, stratified cuts, membership lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from afterplay.operators.player_table import churn_labels
from afterplay.operators.split import (
    approximate_split,
    fit_player_split,
    stratified_parts,
    shared_players,
    split_by_ids,
    split_counts,
)
from afterplay.plans.fragments import SCORE, SCORE_EVENTS, score_labels
from afterplay.plans.queries_rows import score_events
from afterplay.plans.registry import query, table

HASH_SQL = "md5('42:' || player_id)"
PARTS_SQL = f"""(SELECT player_id, CASE WHEN row_number() OVER (ORDER BY {HASH_SQL})
        <= floor(count(*) OVER () * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'eval' END AS part
    FROM (SELECT DISTINCT player_id FROM ({SCORE_EVENTS})))"""


def _players(spark, folder):
    return table(spark, folder, "orders").select(F.col("o_custkey").cast("string").alias("player_id")).distinct()


@query("player_split", f"SELECT player_id, part FROM {PARTS_SQL}")
def player_split(spark, folder):
    players = _players(spark, folder)
    return players.select("player_id", fit_player_split(players).part("player_id").alias("part"))


@query(
    "player_split_approximate",
    f"""SELECT player_id, CASE WHEN substr({HASH_SQL}, 1, 8) < 'cccccccc' THEN 'train' ELSE 'eval' END AS part
        FROM (SELECT DISTINCT player_id FROM ({SCORE_EVENTS}))""",
)
def player_split_approximate(spark, folder):
    return _players(spark, folder).select("player_id", approximate_split().part("player_id").alias("part"))


@query(
    "stratified_split",
    f"""WITH {score_labels()}
        SELECT player_id, churned,
               CASE WHEN row_number() OVER (PARTITION BY churned ORDER BY {HASH_SQL})
                    <= floor(count(*) OVER (PARTITION BY churned) * CAST(0.8 AS DOUBLE))
               THEN 'train' ELSE 'eval' END AS part
        FROM labels""",
)
def stratified_split(spark, folder):
    labels = churn_labels(score_events(spark, folder), SCORE).select("player_id", "churned")
    return stratified_parts(labels, "churned")


@query(
    "split_events",
    f"""SELECT p.part, count(*) AS events, count(DISTINCT e.player_id) AS players
        FROM ({SCORE_EVENTS}) e JOIN {PARTS_SQL} p ON e.player_id = p.player_id GROUP BY p.part""",
)
def split_events(spark, folder):
    cut = fit_player_split(_players(spark, folder))
    events = score_events(spark, folder).select("player_id", cut.part("player_id").alias("part"))
    return events.groupBy("part").agg(
        F.count("*").alias("events"), F.count_distinct("player_id").alias("players")
    )


@query(
    "split_semi_join",
    """SELECT count(*) FILTER (WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'))
               AS train_count,
           count(*) FILTER (WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING'
                                                AND c_acctbal > 0)) AS eval_count,
           count(*) FILTER (WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING'
                                                AND c_acctbal <= 0)) AS skipped_count
       FROM orders""",
)
def split_semi_join(spark, folder):
    customers = table(spark, folder, "customer").withColumn("player_id", F.col("c_custkey").cast("string"))
    train = customers.filter("c_mktsegment = 'BUILDING'").select("player_id")
    held_out = customers.filter("c_acctbal > 0").select("player_id")
    return split_counts(split_by_ids(score_events(spark, folder), train, held_out))


@query(
    "split_disjoint",
    "SELECT 0 AS shared, count(DISTINCT o_custkey) AS players FROM orders",
)
def split_disjoint(spark, folder):
    players = _players(spark, folder)
    parts = players.select("player_id", fit_player_split(players).part("player_id").alias("part"))
    train, held_out = parts.filter("part = 'train'"), parts.filter("part = 'eval'")
    shared = shared_players(train, held_out).select(F.lit(1).alias("shared"), F.lit(0).alias("player"))
    seen = parts.select(F.lit(0).alias("shared"), F.lit(1).alias("player"))
    both = shared.unionAll(seen).agg(F.sum("shared").alias("shared"), F.sum("player").alias("players"))
    return both
