"""Readers, adapters, intake and slicing on small files and the smallest tables."""

import json
import time
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F, types as T

from afterplay.functions.identity import resolve_player_id
from afterplay.functions.timing import epoch_convert, epoch_to_timestamp, epoch_unit, iso_time
from afterplay.operators.events import assign_windows, nest_events, nest_labelled_events, time_ordered
from afterplay.operators.hot import HotPolicy
from afterplay.operators.player_table import churn_labels, player_table
from afterplay.operators.profile import describe_paths, profile_json_document, profile_nested, profile_paths, text_kind
from afterplay.operators.stats import flag_invalid_players, write_valid_players
from afterplay.plans import queries_profile
from afterplay.plans.fragments import RACE, SCORE
from afterplay.plans.queries_rows import race_events, score_events
from afterplay.plans.queries_sources import keyed_documents, write_keyed_documents
from afterplay.plans.registry import REGISTRY
from afterplay.sources.adapters import events_from_race_logs, events_from_score_csv, events_from_score_logs
from afterplay.sources.readers import (
    first_json_lines,
    is_one_value,
    scan_array_document,
    scan_csv,
    scan_features,
    scan_json_document,
    scan_json_lines,
    scan_json_lines_strict,
    scan_keyed_document,
    write_json_rows,
)
from afterplay.sources.schemas import RACE_LOG, SCORE_LOG
from afterplay.sources.writers import write_json_lines
from afterplay.streaming.ingest import ingest_player_logs, read_ingested

FORCED = HotPolicy(rows_per_slice=10)


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def log(uid, *events):
    return json.dumps({"uid": uid, "records": list(events)})


def race(time, **properties):
    return {"time": time, "event": "progress", "properties": {"action": "complete", "type": "race"} | properties}


def test_time_units(spark):
    rows = spark.createDataFrame([(10000000000.0,), (10000000001.0,), (1406267278630.0,)], "t double")
    shown = rows.select(epoch_unit(F.col("t")).alias("u"), iso_time(epoch_to_timestamp(F.col("t"))).alias("at"))
    found = shown.collect()
    assert [r.u for r in found] == ["seconds", "milliseconds", "milliseconds"]
    assert found[2].at == "2014-07-25T05:47:58.630000"
    assert rows.select(epoch_convert(F.col("t"), "seconds").alias("s")).collect()[2].s == 1406267278
    with pytest.raises(ValueError):
        epoch_convert(F.col("t"), "weeks")


def test_player_ids(spark, tmp_path):
    schema = "device_id string, uid string, player_id string"
    rows = spark.createDataFrame([(None, None, None), ("", "u1", None), (None, None, "p")], schema)
    assert [r[0] for r in rows.select(resolve_player_id(rows)).collect()] == [None, "u1", "p"]
    numbers = spark.createDataFrame([(0, 0), (0, 7), (5, 1)], "device_id long, player_id long")
    assert [r[0] for r in numbers.select(resolve_player_id(numbers)).collect()] == ["0", "7", "5"]
    assert numbers.select(resolve_player_id(numbers, "device_id")).first()[0] == "0"
    assert numbers.select(resolve_player_id(numbers, "other")).first()[0] is None


def test_a_number_zero_in_json_is_no_player(spark, tmp_path):
    ids = [
        {"device_id": 0}, {"device_id": 0, "uid": "u2"}, {"device_id": "0"}, {"device_id": 0.0, "uid": False, "player_id": 0},
        {"device_id": 12, "uid": "u"}, {"device_id": None, "uid": ""}, {"device_id": 9007199254740993}, {"uid": "u3"}, {},
    ]
    path = write(tmp_path / "ids.jsonl", *[json.dumps(one | {"records": []}) for one in ids])
    rows = scan_json_lines(spark, path, RACE_LOG).rows
    found = [r[0] for r in rows.select(resolve_player_id(rows)).collect()]
    assert found == [None, "u2", "0", "0", "12", None, "9007199254740993", "u3", None]


def test_malformed_lines_are_set_aside(spark, tmp_path):
    bad = [log("c") + " and more", "{'uid': 'd'}", log("e")[:-3], log("f") + log("g"), '{"uid": "h"} {"_end": 0', "5"]
    path = write(tmp_path / "logs.jsonl", log("a", race(1, reward=2)), "", "not json", log("b"), *bad)
    lines = scan_json_lines(spark, path, RACE_LOG)
    assert {r.uid for r in lines.rows.collect()} == {"a", "b"}
    assert [r.line_text for r in lines.malformed.collect()] == ["not json", *bad]
    with pytest.raises(Exception):
        scan_json_lines_strict(spark, path, RACE_LOG).collect()


def test_first_lines(spark, tmp_path):
    path = write(tmp_path / "logs.jsonl", log("a"), "broken", log("b"), log("c"))
    assert [r.uid for r in first_json_lines(spark, path, RACE_LOG, 3).collect()] == ["a", "b"]
    assert first_json_lines(spark, str(tmp_path / "none.jsonl"), RACE_LOG).isEmpty()


def test_race_logs(spark, tmp_path):
    path = write(
        tmp_path / "logs.jsonl",
        log(
            "a",
            race(1406267278630, reward=4),
            race(1406267279630, reward="5"),
            {"time": 1406267280630, "event": "progress", "properties": None},
            {"time": 1406267281630, "event": "softPurchase", "properties": {"price": 400, "currency": "x"}},
            {"time": 1406267282630, "event": "purchase", "properties": {"price": "9"}},
            {"time": 1406267283630, "event": "hardPurchase", "properties": {}},
        ),
    )
    events = events_from_race_logs(scan_json_lines(spark, path, RACE_LOG).rows)
    row = player_table(events, purchases=True).first()
    assert (row.playCount, row.bestScore, row.meanScore, row.purchaseCount, row.highestPrice) == (2, 4, 4, 3, 400)
    assert row.op_event_count == 6
    first = events.orderBy("pos").first().ts
    assert first.replace(tzinfo=timezone.utc).timestamp() % 1 == pytest.approx(0.63)


def test_score_logs_and_csv(spark, tmp_path):
    path = write(
        tmp_path / "logs.jsonl",
        json.dumps({"device_id": "7", "records": [{"time": 5, "score": 3, "event": "play"}, {"time": 4, "score": "3", "event": "play"}]}),
        json.dumps({"device_id": "8", "records": []}),
        json.dumps({"records": [{"time": 5, "score": 3, "event": "play"}]}),
    )
    events = events_from_score_logs(scan_json_lines(spark, path, SCORE_LOG).rows)
    assert sorted((r.player_id, r.pos, r.score) for r in events.collect()) == [("7", 0, 3.0), ("7", 1, None)]
    assert {r.player_id: r.playCount for r in player_table(events).collect()} == {"7": 2}
    csv = write(tmp_path / "plays.csv", "device,score,time", "1,10,1421157320", "1,20,1421157321")
    rows = events_from_score_csv(scan_csv(spark, csv)).orderBy("ts").collect()
    assert [(r.player_id, r.score) for r in rows] == [("1", 10), ("1", 20)]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        scan_csv(spark, str(tmp_path / "none.csv"))


def test_documents_and_feature_files(spark, tmp_path):
    (tmp_path / "doc").mkdir()
    (tmp_path / "doc" / "a.json").write_text('[\n {"n": 1},\n {"n": 2}\n]')
    (tmp_path / "doc" / "b.json").write_text('{\n "n": 3\n}')
    schema = spark.createDataFrame([], "n long").schema
    assert sorted(r.n for r in scan_json_document(spark, str(tmp_path / "doc"), schema).collect()) == [1, 2, 3]
    path = write(tmp_path / "features.csv", "player_id,churned,x", "007,1,2.5", "008,0,n/a")
    rows = scan_features(spark, path).orderBy("player_id").collect()
    assert [(r.player_id, r.churned, r.x) for r in rows] == [("007", 1, 2.5), ("008", 0, None)]


@pytest.mark.parametrize("separators", [(",", ":"), (", ", ": ")])
def test_keyed_document_is_read_in_splits(spark, tmp_path, separators):
    folder = tmp_path / "keyed"
    folder.mkdir()
    expected = {}
    for name, base in (("a", 0), ("b", 1_000)):
        document = {}
        for i in range(base, base + 200):
            note = ['plain', 'ends with ,', '{"77": 1}', 'x,"88":{', "é" * (i % 40)][i % 5]
            document[str(i)] = {"n": i, "note": note, "inner": [{"a": 1, "b": "2,"}, {"note": note}]}
            expected[str(i)] = (i, note)
        text = json.dumps(document, separators=separators, ensure_ascii=False)
        (folder / f"{name}.json").write_text(text, encoding="utf-8")
    schema = spark.createDataFrame([], "n long, note string, inner array<struct<note: string>>").schema
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        rows = scan_keyed_document(spark, str(folder), schema).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == 400
    assert {r.key: (r.value.n, r.value.note) for r in rows} == expected
    assert all(r.value.inner[1].note == r.value.note for r in rows)


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


STYLES = [{"separators": (",", ":")}, {}, {"indent": 2}]
NOTES = ["plain", "ends with ,", '{"77": 1}', 'x,"88":{', "]}", '"', "\\", "é" * 30]


@pytest.mark.parametrize("style", STYLES)
def test_array_document_is_read_in_splits(spark, tmp_path, small_splits, style):
    (tmp_path / "doc").mkdir()
    expected = {}
    for name, many in (("a", 300), ("b", 1), ("c", 0)):
        elements = [{"n": i, "note": NOTES[i % 8], "inner": [{"note": NOTES[i % 7]}, [i, [i]]]} for i in range(many)]
        expected |= {(name, i): (e["n"], e["note"]) for i, e in enumerate(elements)}
        (tmp_path / "doc" / f"{name}.json").write_text(json.dumps(elements, **style))
    schema = spark.createDataFrame([], "n long, note string").schema
    rows = scan_array_document(spark, str(tmp_path / "doc"), schema).collect()
    assert {(r.file[-6], r.element): (r.value.n, r.value.note) for r in rows} == expected and len(rows) == 301
    found = scan_json_document(spark, str(tmp_path / "doc"), schema).collect()
    assert sorted((r.n, r.note) for r in found) == sorted(expected.values())
    assert spark.read.option("lineSep", ",").text(str(tmp_path / "doc" / "a.json")).rdd.getNumPartitions() > 5
    roots = {(r.root, r.members) for r in profile_json_document(spark, str(tmp_path / "doc")).collect()}
    assert roots == {("list", 300), ("list", 1), ("list", 0)}
    values = [5, "a,b", None, [1, 2], {"x": 1}, "k", True, 2.5, "[", -1]
    (tmp_path / "mixed.json").write_text(json.dumps(values, **style))
    kinds = scan_array_document(spark, str(tmp_path / "mixed.json"), T.VariantType()).orderBy("element")
    shown = [None if r.value is None else r.value.toPython() for r in kinds.collect()]
    assert [v if not isinstance(v, float) else v for v in shown] == values


@pytest.mark.parametrize("style", STYLES)
def test_object_documents_of_any_size(spark, tmp_path, small_splits, style):
    (tmp_path / "doc").mkdir()
    big = {f"k{i}": {"note": NOTES[i % 8]} for i in range(200)} | {"n": 7, "inner": [1, 2], "note": "a,}b"}
    roots = {"a": big, "b": {}, "c": {"note": None, "n": 8}, "d": 5, "e": []}
    for name, root in roots.items():
        (tmp_path / "doc" / f"{name}.json").write_text(json.dumps(root, **style))
    (tmp_path / "doc" / "f.json").write_text('{"n": 1, "n": 2}')
    schema = spark.createDataFrame([], "n long, note string, inner array<int>").schema
    found = [tuple(r) for r in scan_json_document(spark, str(tmp_path / "doc"), schema).collect()]
    assert sorted(found, key=str) == sorted([(7, "a,}b", [1, 2]), (None, None, None), (8, None, None), (2, None, None)], key=str)
    profile = {(r.root, r.members): r.first_keys for r in profile_json_document(spark, str(tmp_path / "doc")).collect()}
    assert profile == {
        ("dict", 203): [f"k{i}" for i in range(10)],
        ("dict", 0): [],
        ("dict", 2): profile["dict", 2],
        ("value", None): None,
        ("list", 0): None,
    }
    for text in ('[{"n": 1}, {"n": 2}', '["a, "b"]', '{"a": [1, 2}'):
        (tmp_path / "broken.json").write_text(text)
        with pytest.raises(Exception, match="does not close"):
            scan_json_document(spark, str(tmp_path / "broken.json"), schema).collect()


def test_a_line_is_one_value(spark, tmp_path):
    good = ['{"uid": "a", "records": []}', ' {"uid":"b","records":[]} ']
    bad = ['{"uid":"b"},"x":1', '{"uid":"e"},"_end":0,"_line":{"uid":"f"}', '{"uid":"g"},"_end":0}{"a":1', '{"uid":"h"}}', '{"uid":"i"} {}']
    bad += ['{"uid":"j"},"_end":0', "[1", '{"uid":"k"}]', "5 apples"]
    lines = scan_json_lines(spark, write(tmp_path / "lines.jsonl", *good, *bad, "  "), RACE_LOG)
    assert sorted(r.uid for r in lines.rows.collect()) == ["a", "b"]
    assert sorted(r.line_text for r in lines.malformed.collect()) == sorted(bad)
    for line in bad:
        path = write(tmp_path / "one.jsonl", good[0], line)
        with pytest.raises(Exception, match="malformed line"):
            scan_json_lines_strict(spark, path, RACE_LOG).collect()
        assert [r.uid for r in first_json_lines(spark, path, RACE_LOG).collect()] == ["a"]
    flags = spark.createDataFrame([(x,) for x in [*good, "5", *bad, None]], "t string").select(is_one_value(F.col("t")))
    assert [r[0] for r in flags.collect()] == [True] * 3 + [False] * (len(bad) + 1)


def test_paths_at_any_depth(spark):
    values = ['{"a": [1, {"b": null}, "x"], "c": {"d": [[2.5], []]}}', '{"a": "{\\"e\\": [true, 1]}"}', "plain", None, "5", '{"a": {}}', "[]"]
    rows = spark.createDataFrame([(v, 1, 2) for v in values], "record string, path int, kind int")
    counts = profile_paths(rows, "record")
    found = {(r.path, r.kind): (r.n, r.max_size, r.holds_json) for r in counts.collect()}
    assert found == {
        ("$", "dict"): (3, 2, 0), ("$", "str"): (1, 5, 0), ("$", "null"): (1, None, 0), ("$", "int"): (1, None, 0), ("$", "list"): (1, 0, 0),
        ("$.a", "list"): (1, 3, 0), ("$.a", "str"): (1, 16, 1), ("$.a", "dict"): (1, 0, 0), ("$.c", "dict"): (1, 1, 0),
        ("$.a[]", "int"): (1, None, 0), ("$.a[]", "dict"): (1, 1, 0), ("$.a[]", "str"): (1, 1, 0), ("$.a[].b", "null"): (1, None, 0),
        ("$.a<json>", "dict"): (1, 1, 0), ("$.a<json>.e", "list"): (1, 2, 0), ("$.a<json>.e[]", "bool"): (1, None, 0),
        ("$.a<json>.e[]", "int"): (1, None, 0), ("$.c.d", "list"): (1, 2, 0), ("$.c.d[]", "list"): (2, 1, 0), ("$.c.d[][]", "float"): (1, None, 0),
    }
    shown = {r.path: (r.type, r.element_type, r["keys"]) for r in describe_paths(counts).collect()}
    assert shown["$"] == ("mixed", None, ["a", "c"]) and shown["$.a"] == ("mixed", "mixed", None)
    assert shown["$.c.d"] == ("list", "list", None) and shown["$.c.d[]"] == ("list", "float", None)
    assert shown["$.a[].b"] == ("null", None, None) and shown["$.a[]"] == ("mixed", None, ["b"])
    assert profile_paths(rows.limit(0), "record").count() == 0


def jobs_of(spark, work):
    """What ``work`` returns, and how many jobs it took."""
    group = f"counted-{id(work)}-{time.time()}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        result = work()
        return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_counts_come_with_the_write(spark, tmp_path):
    path = write(tmp_path / "logs.jsonl", log("a", race(1, reward=2)), "broken", "  ", '{"uid":"x"},"y":1', log("b", race(3, reward=4)))
    counts, jobs = jobs_of(spark, lambda: write_json_rows(spark.read.text(path), RACE_LOG, str(tmp_path / "good")))
    assert counts == {"records": 2, "malformed": 2} and jobs == 1
    written = spark.read.parquet(str(tmp_path / "good"))
    assert sorted(r.uid for r in written.collect()) == ["a", "b"] and "_is_good" not in written.columns
    empty = write(tmp_path / "empty.jsonl", "")
    assert write_json_rows(spark.read.text(empty), RACE_LOG, str(tmp_path / "none")) == {"records": 0, "malformed": 0}
    players = spark.createDataFrame([("a", [1], 1)] * 19 + [("", [1], 1)], "player_id string, observation_records array<int>, op_event_count int")
    players.write.parquet(str(tmp_path / "players"))
    flagged = flag_invalid_players(spark.read.schema(players.schema).parquet(str(tmp_path / "players")))
    counts, jobs = jobs_of(spark, lambda: write_valid_players(flagged, str(tmp_path / "valid")))
    assert counts == {"players": 20, "errors": 1} and jobs == 1 and spark.read.parquet(str(tmp_path / "valid")).count() == 19
    with pytest.raises(ValueError, match="2 of 3"):
        write_valid_players(flag_invalid_players(players.limit(1).unionAll(players.filter("player_id = ''")).unionAll(players.filter("player_id = ''"))), str(tmp_path / "bad"))


def test_text_kinds(spark):
    values = ["plain", "[1, 2]", '{"a": 1}', "5", "2.5", "true", "null", None, '"x"', "5 apples", "1, 2"]
    rows = spark.createDataFrame([(v,) for v in values], "t string")
    kinds = [r[0] for r in rows.select(text_kind(F.col("t"))).collect()]
    assert kinds == ["str", "list", "dict", "int", "float", "bool", "null", "null", "str", "str", "str"]
    sizes = {r.kind: r.max_size for r in profile_nested(rows, "t").collect()}
    assert sizes["list"] == 2 and sizes["dict"] == 1


def test_stream_takes_each_file_once(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    paths = [str(tmp_path / name) for name in ("out", "state")]
    write(source / "1.jsonl", log("a", race(1, reward=2)), "broken")
    ingest_player_logs(spark, str(source), *paths).awaitTermination()
    write(source / "2.jsonl", log("b", race(3, reward=4), race(5, reward=6)))
    ingest_player_logs(spark, str(source), *paths).awaitTermination()
    events = read_ingested(spark, paths[0])
    assert sorted((r.player_id, r.score) for r in events.collect()) == [("a", 2), ("b", 4), ("b", 6)]
    assert [r.value for r in spark.read.text(f"{paths[0]}/malformed").collect()] == ["broken"]


# Slices of hot players change no result ---------------------------------------------------


def same(left, right):
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


@pytest.mark.parametrize("game", ["score", "race"])
def test_slicing_changes_no_result(spark, sf_dir, game):
    events, horizon = (score_events(spark, sf_dir), SCORE) if game == "score" else (race_events(spark, sf_dir), RACE)
    assert same(churn_labels(events, horizon), churn_labels(events, horizon, FORCED))
    assert same(player_table(events, horizon, True), player_table(events, horizon, True, FORCED))
    assert same(assign_windows(events, horizon), assign_windows(events, horizon, FORCED))
    assert same(time_ordered(events), time_ordered(events, policy=FORCED))


def test_long_histories_are_refused_not_cut(spark, sf_dir):
    events = race_events(spark, sf_dir)
    longest = events.groupBy("player_id").count().agg(F.max("count")).first()[0]
    assert nest_events(events, "event", most_events=longest).count() == events.select("player_id").distinct().count()
    with pytest.raises(ValueError, match="at most"):
        nest_events(events, "event", most_events=longest - 1)
    with pytest.raises(ValueError, match="at most"):
        nest_labelled_events(events, "event", horizon=RACE, most_events=longest - 1)


@pytest.mark.parametrize("style", [{"separators": (",", ":")}, {}, {"indent": 2}])
def test_keyed_document_is_read_by_structure(spark, tmp_path, style):
    root = {str(i): {"server": f'a,"{i}":{{ \\ ', "7": {"x": [1, {"2": 3}]}, "port": i} for i in range(20)}
    root |= {"m1": {"server": "}]", "port": 1}, 'q"uote': {"server": "", "port": 2}, "": {"server": "x,", "port": 3}}
    path = tmp_path / "doc.json"
    path.write_text(json.dumps(root, **style))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        kind = T.StructType([T.StructField("server", T.StringType()), T.StructField("port", T.IntegerType())])
        rows = scan_keyed_document(spark, str(path), kind).collect()
        (tmp_path / "broken.json").write_text(json.dumps(root, **style)[:-30])
        with pytest.raises(Exception, match="does not close"):
            scan_keyed_document(spark, str(tmp_path / "broken.json"), kind).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {r.key: (r.value.server, r.value.port) for r in rows} == {k: (v["server"], v["port"]) for k, v in root.items()}


@pytest.mark.parametrize("split", ["7", "40", "100000"])
def test_members_are_found_wherever_a_split_begins(spark, tmp_path, split):
    """Splits that begin inside strings, in nested values and in one value that spans many splits."""
    long = {"a": [{"t": 'x,"y":{[ \\", ' * 9}, [[1, 2], [3, ["],[", {"}": "{"}]]]]}
    root = {"k0": long, "k1": 5, "k2": ["],{", long], "k3": {}, "k4": '",{' * 20, "k5": {"a": 1}}
    (tmp_path / "keyed.json").write_text(json.dumps(root))
    (tmp_path / "list.json").write_text(json.dumps([*root.values()], separators=(",", ":")))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        keyed = scan_keyed_document(spark, str(tmp_path / "keyed.json"), T.VariantType()).collect()
        listed = scan_array_document(spark, str(tmp_path / "list.json"), T.VariantType()).orderBy("element").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {r.key: r.value.toPython() for r in keyed} == root and len(keyed) == len(root)
    assert [r.value.toPython() for r in listed] == [*root.values()]


def test_documents_are_written_member_by_member(spark, tmp_path):
    """No task gathers a document: it is 50 000 members, whatever else its task has to do."""
    schema = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
    day = datetime(2024, 1, 1)
    keys = [3, 49_999, 50_000, 100_000, 1]
    rows = [(k, k + 7, None if k == 3 else "F", 1.5 * k, day, '5,"LOW') for k in keys]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "good" / "orders.parquet"))
    write_keyed_documents(spark, str(tmp_path / "good"), str(tmp_path / "out"))
    files = {f.parent.name: f for f in (tmp_path / "out").glob("*/part-*")}
    found = {name: json.loads(f.read_text()) for name, f in files.items()}
    whole = {f"bucket={r.bucket}": json.loads(r.value) for r in keyed_documents(spark, str(tmp_path / "good")).collect()}
    assert found == whole and sorted(map(len, found.values())) == [1, 1, 3]
    assert all(f.read_text().count("\n") == len(found[name]) for name, f in files.items())
    for name, more, message in (("twice", 3, "(?i)duplicate map key"), ("null", None, "NULL_MAP_KEY")):
        spark.createDataFrame([*rows, (more, 1, "F", 1.0, day, "x")], schema).write.parquet(str(tmp_path / name / "orders.parquet"))
        with pytest.raises(Exception, match=message):
            write_keyed_documents(spark, str(tmp_path / name), str(tmp_path / f"{name}-out"))


@pytest.mark.parametrize("name, shown", [("profile_json_document", ("dict", 1500, "yes")), ("profile_keyed_members", ("dict", 1500))])
def test_profiled_documents_are_written_member_by_member(spark, sf_dir, tmp_path, monkeypatch, name, shown):
    monkeypatch.setattr(queries_profile, "scratch_path", lambda _, kind: str(tmp_path / kind))
    assert [tuple(r) for r in REGISTRY[name].run(spark, sf_dir).collect()] == [shown]
    assert sum(f.read_text().count("\n") for f in tmp_path.glob("*/bucket=*/part-*")) == 1500


def test_text_of_a_document_is_moved_twice(spark, tmp_path):
    """To its split and to its member; the counts of splits read it once more and move numbers only."""
    (tmp_path / "doc.json").write_text('{"a": 1, "b": [2, 3]}')
    rows = scan_keyed_document(spark, str(tmp_path / "doc.json"), T.VariantType())
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [value") == 2


def test_order_of_rows_does_not_matter(spark, sf_dir):
    events = race_events(spark, sf_dir)
    shuffled = events.repartition(13, "pos")
    assert same(player_table(events, RACE, True), player_table(shuffled, RACE, True))


def test_invariants(spark, sf_dir):
    events = race_events(spark, sf_dir)
    table = player_table(events, RACE, True)
    totals = events.groupBy("player_id").count()
    bad = table.join(totals, "player_id").filter(
        "op_event_count + cp_event_count > count OR worstScore > meanScore OR meanScore > bestScore "
        "OR consecutivePlayRatio NOT BETWEEN 0 AND 1 OR bestScoreIndex NOT BETWEEN 0 AND 1"
    )
    assert bad.isEmpty() and table.count() == totals.count()
    assert datetime.fromisoformat("2024-01-01") <= table.agg(F.min("op_start")).first()[0]
