"""Queries on model input: imputation, selection, scaling, weights, checks."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from afterplay.operators.player_table import feature_table
from afterplay.operators.prepare import (
    HIGH_SCALED_CORRELATION,
    Preparation,
    class_weights,
    collinear_drops,
    constant_report,
    correlation_pairs,
    dirty_counts,
    exact_medians,
    fit_preparation,
    id_column_report,
    impute,
    matrix_validation,
    quality_gate,
    scaling_audit,
    weigh_rows,
    with_scaling,
)
from afterplay.operators.split import fit_player_split
from afterplay.plans.fragments import race_features, rounded, score_features, score_labels
from afterplay.plans.queries_rows import race_table, rounded_columns, score_events, score_table
from afterplay.plans.queries_split import PARTS_SQL
from afterplay.plans.registry import query, table

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
# Prices of returned lines are taken away, which leaves gaps to fill.
GAPPED_SQL = """(SELECT l_orderkey, l_linenumber,
    CASE WHEN l_returnflag <> 'R' THEN l_quantity END AS l_quantity,
    CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END AS l_extendedprice,
    CAST(NULL AS DOUBLE) AS l_tax FROM lineitem)"""


def _gapped(spark, folder):
    kept = F.col("l_returnflag") != "R"
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(kept, F.col("l_quantity")).alias("l_quantity"),
        F.when(kept, F.col("l_extendedprice")).otherwise(float("nan")).alias("l_extendedprice"),
        F.lit(None).cast("double").alias("l_tax"),
    )


@query(
    "impute_median",
    f"""SELECT l_orderkey, l_linenumber, coalesce(l_quantity, m.quantity) AS l_quantity,
        coalesce(l_extendedprice, m.price) AS l_extendedprice, 0.0 AS l_tax
        FROM {GAPPED_SQL}, (SELECT median(l_quantity) AS quantity, median(l_extendedprice) AS price
                            FROM {GAPPED_SQL}) m""",
)
def impute_median(spark, folder):
    rows = _gapped(spark, folder)
    return impute(rows, exact_medians(rows, ["l_quantity", "l_extendedprice", "l_tax"]))


@query(
    "median_by_narrowing",
    "SELECT median(l_quantity) AS l_quantity, median(l_extendedprice) AS l_extendedprice, median(l_tax) AS l_tax FROM lineitem",
)
def median_by_narrowing(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_quantity", "l_extendedprice", "l_tax")
    medians = exact_medians(rows, rows.columns, in_memory=1_000)
    return rows.agg(*[F.lit(m).alias(c) for c, m in medians.items()])


@query(
    "missing_counts",
    f"""SELECT 'l_quantity' AS column_name, 0 AS infinite, count(*) - count(l_quantity) AS missing FROM {GAPPED_SQL}
        UNION ALL SELECT 'l_extendedprice', 0, count(*) - count(l_extendedprice) FROM {GAPPED_SQL}
        UNION ALL SELECT 'l_tax', 0, count(*) - count(l_tax) FROM {GAPPED_SQL}""",
)
def missing_counts(spark, folder):
    return dirty_counts(_gapped(spark, folder), ["l_quantity", "l_extendedprice", "l_tax"])


CONSTANT_COLUMNS = ["l_quantity", "l_tax", "one", "nothing", "flag", "almost"]


@query(
    "constant_columns",
    """SELECT 'l_quantity' AS column_name, least(count(DISTINCT l_quantity), 3) AS values_up_to_3,
              count(DISTINCT l_quantity) <= 1 AS is_constant FROM lineitem
       UNION ALL SELECT 'l_tax', least(count(DISTINCT l_tax), 3), count(DISTINCT l_tax) <= 1 FROM lineitem
       UNION ALL SELECT 'one', 1, TRUE
       UNION ALL SELECT 'nothing', 0, TRUE
       UNION ALL SELECT 'flag', count(DISTINCT l_returnflag = 'R'), FALSE FROM lineitem
       UNION ALL SELECT 'almost', count(DISTINCT l_returnflag = 'R'), TRUE FROM lineitem""",
)
def constant_columns_query(spark, folder):
    returned = (F.col("l_returnflag") == "R").cast("double")
    rows = table(spark, folder, "lineitem").select(
        "l_quantity",
        "l_tax",
        F.lit(1.0).alias("one"),
        F.lit(None).cast("double").alias("nothing"),
        returned.alias("flag"),
        (returned * 1e-6 + 1).alias("almost"),
    )
    return constant_report(rows, CONSTANT_COLUMNS)


CORRELATED = {
    "l_quantity": "l_quantity",
    "l_extendedprice": "l_extendedprice",
    "l_discount": "l_discount",
    "twice_quantity": "l_quantity * 2",
    "minus_price": "-l_extendedprice",
}
_PAIRS_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", {rounded(f'corr({CORRELATED[a]}, {CORRELATED[b]})')} AS r FROM lineitem"
    for a, b in combinations(CORRELATED, 2)
)


def _correlated(spark, folder):
    return table(spark, folder, "lineitem").select(*[F.expr(e).alias(n) for n, e in CORRELATED.items()])


@query("correlation_pairs", _PAIRS_SQL)
def correlation_pairs_query(spark, folder):
    pairs = correlation_pairs(_correlated(spark, folder), list(CORRELATED))
    return pairs.select("left", "right", *rounded_columns("r"))


@query(
    "collinear_drops",
    f"""SELECT DISTINCT greatest("left", "right") AS column_name FROM ({_PAIRS_SQL}) WHERE abs(r) > 0.95""",
)
def collinear_drops_query(spark, folder):
    return collinear_drops(correlation_pairs(_correlated(spark, folder), list(CORRELATED)))


ID_TEXT = {"customer": ("c_name", "c_mktsegment")}


@query(
    "detect_id_columns",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, {rounded(f'count(DISTINCT {c}) / count(*)')} AS distinct_ratio,
            {rounded(f'sum(length({c})) / count(*)')} AS mean_length,
            count(DISTINCT {c}) / count(*) > 0.8 AND sum(length({c})) / count(*) > 10 AS is_id FROM customer"""
        for c in ID_TEXT["customer"]
    ),
)
def detect_id_columns_query(spark, folder):
    report = id_column_report(table(spark, folder, "customer"))
    return report.select("column_name", *rounded_columns("distinct_ratio", "mean_length"), "is_id")


_SCALED_SQL = ", ".join(
    f"""{rounded(f'(f."{c}" - m."{c}_m") / CASE WHEN m."{c}_s" = 0 THEN 1 ELSE m."{c}_s" END')} AS "{c}" """
    for c in ("playCount", "bestScore", "worstScore", "activeDuration")
)
_MOMENTS_SQL = ", ".join(
    f"""avg("{c}") AS "{c}_m", stddev_pop("{c}") AS "{c}_s" """
    for c in ("playCount", "bestScore", "worstScore", "activeDuration")
)


@query(
    "standard_scale",
    f"""WITH {score_features()}, parts AS (SELECT * FROM {PARTS_SQL}),
        moments AS (SELECT {_MOMENTS_SQL} FROM features f JOIN parts p ON f.player_id = p.player_id
                    WHERE p.part = 'train')
        SELECT f.player_id, p.part, {_SCALED_SQL}
        FROM features f JOIN parts p ON f.player_id = p.player_id, moments m""",
)
def standard_scale(spark, folder):
    names = ["playCount", "bestScore", "worstScore", "activeDuration"]
    features = score_table(spark, folder).select("player_id", *names)
    cut = fit_player_split(score_events(spark, folder))
    parts = features.withColumn("part", cut.part("player_id"))
    fitted = with_scaling(parts.filter("part = 'train'"), Preparation(names, {}))
    return fitted.apply(parts, keep=("player_id", "part")).select("player_id", "part", *rounded_columns(*names))


@query(
    "scaling_audit",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) > count(z) AS has_missing, bool_or(isinf(z)) AS has_infinite,
            var_samp(z) < 1e-6 AS low_variance, abs(avg(z)) <= 1e-6 AS centered,
            abs(stddev_samp(z) - 1) <= 1.01e-3 AS unit_deviation
            FROM (SELECT ({c} - m) / s AS z FROM lineitem, (SELECT avg({c}) AS m, stddev_pop({c}) AS s FROM lineitem))"""
        for c in MEASURES
    ),
)
def scaling_audit_query(spark, folder):
    rows = table(spark, folder, "lineitem").select(*MEASURES)
    fitted = with_scaling(rows, Preparation(MEASURES, {}))
    return scaling_audit(fitted.apply(rows), MEASURES)


_AUDITED = ("playCount", "bestScore", "meanScore", "worstScore", "sdScore", "activeDuration")


@query(
    "scaled_correlations",
    f"WITH {score_features()} SELECT * FROM ("
    + " UNION ALL ".join(
        f"""SELECT '{a}' AS "left", '{b}' AS "right", {rounded(f'corr("{a}", "{b}")')} AS r FROM features"""
        for a, b in combinations(_AUDITED, 2)
    )
    + ") WHERE abs(r) > 0.8",
)
def scaled_correlations(spark, folder):
    """Scaled features that are still close to each other."""
    rows = score_table(spark, folder).select(*_AUDITED)
    scaled = with_scaling(rows, Preparation(list(_AUDITED), {})).apply(rows)
    pairs = correlation_pairs(scaled, list(_AUDITED)).filter(F.abs("r") > HIGH_SCALED_CORRELATION)
    return pairs.select("left", "right", *rounded_columns("r"))


@query("fitted_selection")
def fitted_selection(spark, folder):
    """What the whole preparation decides per feature of the race game."""
    features = feature_table(race_table(spark, folder), purchases=True)
    fitted = fit_preparation(features)
    rows = [(f, "kept", fitted.means[f], fitted.deviations[f]) for f in fitted.features]
    rows += [(f, why, None, None) for why, names in fitted.dropped.items() for f in names]
    return spark.createDataFrame(rows, "column_name string, decision string, mean double, deviation double")


def _gate_columns(spark, folder):
    late = F.col("l_shipdate") > F.lit("1998-09-01").cast("timestamp")
    return table(spark, folder, "lineitem").select(
        late.cast("int").alias("churned"),
        F.when(F.col("l_quantity") > 45, float("inf")).otherwise(F.col("l_quantity")).alias("l_quantity"),
        F.when(F.col("l_returnflag") != "R", F.col("l_tax")).alias("l_tax"),
    )


@query(
    "quality_gate",
    """WITH c AS (SELECT count(*) AS n, count(*) FILTER (WHERE l_quantity > 45) AS inf,
                 count(*) FILTER (WHERE l_returnflag = 'R') AS gaps,
                 count(*) FILTER (WHERE l_shipdate > TIMESTAMP '1998-09-01') AS ones FROM lineitem),
            d AS (SELECT *, least(CASE WHEN ones > 0 THEN ones END, CASE WHEN n > ones THEN n - ones END) AS few,
                 greatest(ones, n - ones) AS many FROM c)
       SELECT 'empty' AS check_name, n AS found, CASE WHEN n = 0 THEN 'fail' ELSE 'pass' END AS outcome FROM d
       UNION ALL SELECT 'infinite', inf, CASE WHEN inf > 0 THEN 'fail' ELSE 'pass' END FROM d
       UNION ALL SELECT 'missing', gaps, CASE WHEN gaps > 0 THEN 'fail' ELSE 'pass' END FROM d
       UNION ALL SELECT 'missing_target', 0, 'pass' FROM d
       UNION ALL SELECT 'small_class', few, CASE WHEN few < 10 THEN 'warn' ELSE 'pass' END FROM d
       UNION ALL SELECT 'class_balance', few, CASE WHEN few / many < 0.01 THEN 'warn' ELSE 'pass' END FROM d""",
)
def quality_gate_query(spark, folder):
    return quality_gate(_gate_columns(spark, folder), ["l_quantity", "l_tax"])


@query(
    "matrix_validation",
    """SELECT 'empty' AS check_name, '*' AS column_name, count(*) = 0 AS failed FROM lineitem
       UNION ALL SELECT 'missing', 'l_quantity', FALSE
       UNION ALL SELECT 'infinite', 'l_quantity', bool_or(l_quantity > 45) FROM lineitem
       UNION ALL SELECT 'missing', 'l_tax', bool_or(l_returnflag = 'R') FROM lineitem
       UNION ALL SELECT 'infinite', 'l_tax', FALSE
       UNION ALL SELECT 'missing', 'churned', FALSE
       UNION ALL SELECT 'not_binary', 'churned', NOT (bool_or(l_shipdate > TIMESTAMP '1998-09-01')
                        AND bool_or(l_shipdate <= TIMESTAMP '1998-09-01')) FROM lineitem""",
)
def matrix_validation_query(spark, folder):
    return matrix_validation(_gate_columns(spark, folder), ["l_quantity", "l_tax"], "churned")


@query(
    "class_weights",
    f"""WITH {score_labels()}
        SELECT CAST(churned AS INTEGER) AS churned, count(*) AS n,
               {rounded('sum(count(*)) OVER () / (2 * count(*))')} AS weight FROM labels GROUP BY churned""",
)
def class_weights_query(spark, folder):
    rows = feature_table(score_table(spark, folder)).select("churned")
    return class_weights(rows).select("churned", "n", *rounded_columns("weight"))


@query(
    "weighted_rows",
    f"""WITH {race_features()}
        SELECT player_id, CAST(churned AS INTEGER) AS churned,
               {rounded('count(*) OVER () / (2 * count(*) OVER (PARTITION BY churned))')} AS weight FROM features""",
)
def weighted_rows(spark, folder):
    rows = feature_table(race_table(spark, folder)).select("player_id", "churned")
    return weigh_rows(rows, class_weights(rows)).select("player_id", "churned", *rounded_columns("weight"))
