"""Preparation, split and metric cases computed by hand or by brute force."""

import math
import random
import statistics

import pytest
from pyspark.sql import Window, functions as F

from afterplay.operators import metrics as metrics_module
from afterplay.operators.metrics import best_per_dataset, classification_metrics, evaluate, rank_models, roc_auc
from afterplay.operators.prepare import (
    Preparation,
    check_matrix,
    class_weights,
    clean_features,
    collinear_drops,
    constant_columns,
    correlation_pairs,
    detect_id_columns,
    exact_medians,
    fit_preparation,
    fit_separately,
    impute,
    passes_gate,
    quality_gate,
    target_strict,
    target_to_binary,
    weigh_rows,
    with_scaling,
)
from afterplay.operators.split import (
    SplitCut,
    approximate_split,
    fit_player_split,
    fit_stratified_split,
    shared_players,
    split_by_ids,
    split_counts,
    stratified_parts,
)
from afterplay.operators.stats import (
    check_error_rate,
    column_difference,
    common_columns,
    dataset_stats,
    flag_invalid_players,
    require_columns,
    require_rows,
)


def column(spark, *values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")


def test_imputation(spark):
    rows = column(spark, 1, None, 3, 10)
    assert sorted(r.x for r in impute(rows, exact_medians(rows, ["x"])).collect()) == [1, 3, 3, 10]
    empty = column(spark, None, None)
    assert [r.x for r in impute(empty, exact_medians(empty, ["x"])).collect()] == [0, 0]


@pytest.mark.parametrize("shape", ["even", "odd", "ties", "two_lumps", "wide"])
def test_medians_by_narrowing(spark, shape):
    rng = random.Random(7)
    values = {
        "even": [rng.gauss(0, 1) for _ in range(4_000)],
        "odd": [rng.random() for _ in range(4_001)],
        "ties": [float(rng.randrange(3)) for _ in range(3_000)],
        "two_lumps": [0.0] * 1_500 + [1.0] * 1_500,
        "wide": [math.exp(rng.uniform(-300, 300)) for _ in range(2_000)],
    }[shape]
    rows = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    assert exact_medians(rows, ["x"], in_memory=20)["x"] == pytest.approx(statistics.median(values), rel=1e-12)


@pytest.mark.parametrize("in_memory", [2, 1_000])
def test_medians_of_very_large_and_infinite_values(spark, in_memory):
    inf = float("inf")
    cases = {(1e308, 1e308, 1e308): 1e308, (-1.7e308, 5.0, -1.6e308): -1.6e308, (1.0, inf, inf): inf, (-inf, -inf, 2.0): -inf, (-inf, 3.0, inf): 3.0, (1.0, 2.0, 3.0, inf, inf, inf): inf}
    for values, median in cases.items():
        rows = spark.createDataFrame([(v,) for v in values * 3], "x double").repartition(2)
        assert exact_medians(rows, ["x"], in_memory=in_memory)["x"] == median, values


def test_constants(spark):
    assert constant_columns(column(spark, 5, 5, 5), ["x"]) == ["x"]
    assert constant_columns(column(spark, 1, 1 + 1e-9), ["x"]) == ["x"]
    assert constant_columns(column(spark, 0, 1), ["x"]) == []
    assert constant_columns(column(spark, None, None), ["x"]) == ["x"]


def test_collinear_drops_the_name_that_sorts_last(spark):
    rows = spark.createDataFrame([(i * 1.0, i * 2.0, -i * 1.0, (i * i) % 7 * 1.0) for i in range(20)], "a double, b double, c double, d double")
    drops = collinear_drops(correlation_pairs(rows, ["a", "b", "c", "d"]))
    assert {r.column_name for r in drops.collect()} == {"b", "c"}


def training_rows(spark):
    rng = random.Random(3)
    rows = []
    for i in range(60):
        x = rng.random()
        gap = None if i % 7 == 0 else rng.random()
        rows.append((f"player-number-{i:04d}", i % 2, x, 3 * x + 1, 4.0, gap, rng.random()))
    return spark.createDataFrame(rows, "player_id string, churned int, a double, b double, c double, d double, e double")


def test_fit_preparation(spark):
    rows = training_rows(spark)
    fitted = fit_preparation(rows)
    assert fitted.features == ["a", "d", "e"]
    assert fitted.dropped == {"id": ["player_id"], "constant": ["c"], "collinear": ["b"]}
    data = [r.asDict() for r in rows.collect()]
    known = [r["d"] for r in data if r["d"] is not None]
    assert fitted.fills["d"] == pytest.approx(statistics.median(known))
    filled = [fitted.fills["d"] if r["d"] is None else r["d"] for r in data]
    assert fitted.means["d"] == pytest.approx(statistics.mean(filled))
    assert fitted.deviations["d"] == pytest.approx(statistics.pstdev(filled))
    applied = fitted.apply(rows, keep=("player_id", "churned"))
    assert applied.columns == ["player_id", "churned", "a", "d", "e"]
    assert applied.agg(F.avg("a")).first()[0] == pytest.approx(0, abs=1e-12)
    pandas_like = [(r.left, r.right, r.r) for r in correlation_pairs(rows, ["a", "b"]).collect()]
    assert pandas_like[0][2] == pytest.approx(1)


def test_fit_separately_keeps_shared_features_and_training_scale(spark):
    rows = training_rows(spark)
    held = rows.withColumn("e", F.lit(1.0))
    first, second = fit_separately(rows, held)
    assert first.features == second.features == ["a", "d"]
    assert first.means == second.means


def test_fit_preparation_without_features(spark):
    with pytest.raises(ValueError):
        fit_preparation(spark.createDataFrame([("p", 1, 2.0), ("q", 0, 2.0)], "player_id string, churned int, x double"))


def test_scaling(spark):
    train, held = column(spark, 1, 2, 3), column(spark, 4)
    fitted = with_scaling(train, Preparation(["x"], {}))
    assert [r.x for r in fitted.apply(train).orderBy("x").collect()] == pytest.approx([-1.224745, 0, 1.224745], abs=1e-6)
    assert fitted.apply(held).first().x == pytest.approx(2.449490, abs=1e-6)


def test_id_columns(spark):
    rows = spark.createDataFrame([(f"a-long-identifier-{i}", "red", i) for i in range(10)], "token string, color string, n int")
    assert detect_id_columns(rows) == ["token"]
    assert detect_id_columns(rows.withColumn("player_id", F.lit("x"))) == ["player_id", "token"]


def test_targets(spark):
    rows = spark.createDataFrame([("True",), ("false",), ("1",), ("0",), ("maybe",), ("",)], "t string")
    assert [r[0] for r in rows.select(target_to_binary(F.col("t"))).collect()] == [1, 0, 1, 0, 1, 0]
    with pytest.raises(Exception, match="not a target"):
        rows.select(target_strict(F.col("t"))).collect()


def test_cleaning(spark):
    rows = column(spark, 1, float("inf"), float("-inf"), float("nan"), None)
    assert sorted(r.x for r in clean_features(rows, ["x"]).collect()) == [0, 0, 0, 0, 1]


def test_gate_and_checks(spark):
    sound = spark.createDataFrame([(float(i), i % 2) for i in range(40)], "x double, churned int")
    assert passes_gate(quality_gate(sound, ["x"]))
    check = check_matrix(sound, ["x"], "churned")
    assert (check.problems, check.zeros, check.ones, check.concerns) == ([], 20, 20, [])
    broken = sound.withColumn("x", F.when(F.col("x") == 3, float("inf")).when(F.col("x") > 30, None).otherwise(F.col("x")))
    assert not passes_gate(quality_gate(broken, ["x"]))
    assert check_matrix(broken, ["x"], "churned").problems == ["missing: x", "infinite: x"]
    assert check_matrix(sound.filter("churned = 1"), ["x"], "churned").problems == ["not_binary: churned"]
    assert "missing ['y'], extra ['x']" in check_matrix(sound, ["x"], fitted=["y"]).problems[0]
    assert check_matrix(sound.withColumn("x", F.lit("a")), ["x"]).problems == ["not numeric: ['x']"]
    assert check_matrix(sound.filter("x < 0"), ["x"], "churned").problems[0] == "empty: *"
    assert check_matrix(sound.limit(5), ["x"], "churned").concerns


def test_class_weights(spark):
    rows = spark.createDataFrame([(1,), (1,), (1,), (0,)], "churned int")
    weights = {r.churned: r.weight for r in class_weights(rows).collect()}
    assert weights == {1: pytest.approx(2 / 3), 0: 2.0}
    assert sum(r.weight for r in weigh_rows(rows, class_weights(rows)).collect()) == pytest.approx(4)


def labelled(spark, pairs):
    return spark.createDataFrame(pairs, "label int, prediction int, score double")


def test_threshold_metrics(spark):
    rows = labelled(spark, [(1, 1, 0.9)] * 3 + [(0, 1, 0.8)] + [(1, 0, 0.2)] * 2 + [(0, 0, 0.1)] * 4)
    found = classification_metrics(rows).first()
    assert (found.accuracy, found.precision, found.recall) == (0.7, 0.75, 0.6)
    assert found.f1_score == pytest.approx(2 / 3)
    none = classification_metrics(labelled(spark, [(1, 0, 0.1), (0, 0, 0.1)])).first()
    assert (none.precision, none.f1_score) == (0, 0)


def test_area_with_ties_and_with_one_class(spark):
    rows = labelled(spark, [(1, 1, 0.9), (1, 1, 0.5), (0, 1, 0.5), (0, 0, 0.1)])
    assert roc_auc(rows).first().roc_auc == 0.875
    assert roc_auc(rows.filter("label = 1")).first().roc_auc is None
    assert evaluate(rows.filter("label = 1")).first().recall == 1


@pytest.mark.parametrize("bands", [1, 7, 256])
def test_area_by_brute_force(spark, monkeypatch, bands):
    monkeypatch.setattr(metrics_module, "_BANDS", bands)
    rng = random.Random(11)
    rows = [(rng.randrange(2), 0, float(rng.randrange(400))) for _ in range(1_500)]
    ups = [s for y, _, s in rows if y]
    downs = [s for y, _, s in rows if not y]
    wins = sum((u > d) + 0.5 * (u == d) for u in ups for d in downs)
    frame = labelled(spark, rows).repartition(5)
    assert roc_auc(frame).first().roc_auc == pytest.approx(wins / len(ups) / len(downs), rel=1e-12)


def test_ranking_leaves_out_models_without_area(spark):
    wide = spark.createDataFrame(
        [("d", "a", 0.7), ("d", "b", None), ("d", "c", 0.9)], "dataset string, model string, roc_auc double"
    )
    assert [(r.model, r["rank"]) for r in rank_models(wide).orderBy("rank").collect()] == [("c", 1), ("a", 2)]
    assert [r.model for r in best_per_dataset(wide).collect()] == ["c"]


# Split ----------------------------------------------------------------------------------


def players(spark, n):
    return spark.range(n).select(F.col("id").cast("string").alias("player_id"))


@pytest.mark.parametrize("n,ratio,train", [(11, 0.8, 8), (11, 0.0, 0), (11, 1.0, 11), (30_000, 0.8, 24_000), (1, 0.5, 0)])
def test_split_sizes(spark, n, ratio, train):
    rows = players(spark, n)
    cut = fit_player_split(rows, ratio)
    assert rows.filter(cut.part("player_id") == "train").count() == train


def test_split_looks_into_large_buckets(spark, monkeypatch):
    from afterplay.operators import split

    monkeypatch.setattr(split, "_SMALL_BUCKET", 1)
    rows = players(spark, 20_000)
    assert rows.filter(fit_player_split(rows, 0.37).part("player_id") == "train").count() == 7_400


def test_split_is_disjoint_and_repeatable(spark):
    rows = players(spark, 500)
    cut = fit_player_split(rows)
    assert cut == fit_player_split(rows.repartition(7)) and isinstance(cut, SplitCut)
    assert cut != fit_player_split(rows, seed=7)
    train, held = (rows.filter(cut.part("player_id") == part) for part in ("train", "eval"))
    assert shared_players(train, held).isEmpty() and train.count() + held.count() == 500


def test_stratified_split(spark):
    rows = players(spark, 100).withColumn("churned", (F.col("player_id") % 4 == 0).cast("int"))
    cut = fit_stratified_split(rows, "churned")
    counts = {(r.churned, r.part): r["count"] for r in rows.groupBy("churned", cut.part("player_id").alias("part")).count().collect()}
    assert counts == {(0, "train"): 60, (0, "eval"): 15, (1, "train"): 20, (1, "eval"): 5}
    single = rows.withColumn("churned", (F.col("player_id") == "7").cast("int"))
    assert fit_stratified_split(single, "churned").strata is None


def test_stratified_split_of_many_strata(spark):
    rows = players(spark, 60_000).withColumn("of", F.when(F.col("player_id") > "00", F.pmod(F.xxhash64("player_id"), F.lit(10_000))))
    rows = rows.withColumn("of", F.when(F.col("player_id") % 30 == 0, None).otherwise(F.col("of"))).cache()
    rows = rows.join(rows.groupBy("of").count().filter("count > 1").select(F.col("of").alias("k")), F.col("of").eqNullSafe(F.col("k"))).drop("k").cache()
    rows.count()
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("strata", "strata")
    parts = stratified_parts(rows, "of", 0.8)
    jobs = len(tracker.getJobIdsForGroup("strata"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    line = Window.partitionBy("of").orderBy(F.md5(F.concat(F.lit("42:"), "player_id")))
    rank, total = F.row_number().over(line), F.count(F.lit(1)).over(Window.partitionBy("of"))
    expected = rows.select("*", F.when(rank <= F.floor(total * F.lit(0.8)), "train").otherwise("eval").alias("part"))
    assert parts.columns == ["player_id", "of", "part"] and parts.count() == rows.count()
    assert parts.exceptAll(expected).isEmpty() and rows.select("of").distinct().count() > 9_000
    assert jobs <= 12, jobs


def test_bands_are_those_of_each_group(spark):
    n = F.col("id")
    big = spark.range(9_000).select(F.lit("big").alias("model"), (1e6 + n).cast("double").alias("s"))
    small = spark.range(1_000).select(F.when(n % 2 == 0, "small").alias("model"), (n / 1e6).alias("s"))
    banded = metrics_module._banded(big.unionByName(small), ["model"])
    sizes = {(r.model, r.band): r["count"] for r in banded.groupBy("model", "band").count().collect()}
    for model, rows in (("big", 9_000), ("small", 500), (None, 500)):
        own = [c for (m, _), c in sizes.items() if m == model]
        assert sum(own) == rows and len(own) > 200 and max(own) <= 2 * rows / 256 + 2


def test_approximate_split(spark):
    rows = players(spark, 20_000)
    share = rows.filter(approximate_split(0.3).part("player_id") == "train").count() / 20_000
    assert share == pytest.approx(0.3, abs=0.02)
    assert rows.filter(approximate_split(1.0).part("player_id") == "eval").isEmpty()
    assert rows.filter(approximate_split(0.0).part("player_id") == "train").isEmpty()


def test_split_by_ids(spark):
    records = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), (None,), ("",)], "player_id string")
    ids = lambda *names: spark.createDataFrame([(n,) for n in names], "player_id string")
    counts = split_counts(split_by_ids(records, ids("a"), ids("a", "b"))).first()
    assert (counts.train_count, counts.eval_count, counts.skipped_count) == (2, 1, 3)


# Summaries ------------------------------------------------------------------------------


@pytest.mark.parametrize("exact", [True, False])
def test_dataset_stats(spark, exact):
    rows = spark.createDataFrame([(True, 1, 0), (False, 3, 2)], "churned boolean, op_event_count long, cp_event_count long")
    stats = dataset_stats(rows, exact=exact).first()
    assert (stats.op_mean, stats.op_min, stats.op_max, stats.op_std, stats.churn_rate) == (2, 1, 3, 1, 0.5)
    empty = dataset_stats(rows.limit(0), exact=exact).first()
    assert set(empty.asDict().values()) == {0}


def test_error_rate_and_requirements(spark):
    rows = spark.createDataFrame([("a", [1], 1), ("", [1], 1), ("c", None, 0)], "player_id string, observation_records array<int>, op_event_count int")
    flagged = flag_invalid_players(rows)
    assert [r.is_valid for r in flagged.collect()] == [True, False, False]
    with pytest.raises(ValueError):
        check_error_rate(flagged)
    check_error_rate(flagged.filter("is_valid"))
    with pytest.raises(ValueError):
        require_columns(rows)
    with pytest.raises(ValueError):
        require_rows(rows.limit(0))


def test_column_lists():
    assert column_difference(["a", "b"], ["b", "c"]) == (["a"], ["c"])
    assert common_columns(["b", "a", "c"], ["c", "b"]) == ["b", "c"]
