import json
import os

import pytest
from pyspark.sql import functions as F

import league
from league import FAILURES, appearance, fixture, land, player, team
from touchline.plans.load import load_player_history, load_run, missing_summaries
from touchline.sources import bronze, tables
from touchline.streaming.runs import follow_runs, load_landed, loaded_run, main

RUN = "2025-09-01T03:00:00Z"
LATER = "2025-09-02T03:00:00Z"


@pytest.fixture
def places(spark, scratch):
    league.write_registry(f"{scratch}/registry")
    db = f"silver_{os.path.basename(scratch).replace('-', '_').lower()}"
    return {
        "bronze_root": f"{scratch}/bronze",
        "registry_root": f"{scratch}/registry",
        "quarantine_root": f"{scratch}/quarantine",
        "db": db,
    }


def small_run(**changes):
    run = {
        "players": [player(1, team=1), player(2, team=2, surprise=True), player(3, team=1)],
        "teams": [team(1), team(2)],
        "fixtures": [fixture(10, 1, 1, 2), fixture(11, 2, 2, 1)],
        "matches": [{"id": 1, "overrides": {"scoring": {"a": 1}}}, {"id": 2, "overrides": {}}, {"id": 3}],
        "types": [{"id": 1, "singular_name": "Goalkeeper"}],
        "histories": {
            1: [appearance(1, 10, 1), appearance(1, 11, 2, novelty=1)],
            2: [appearance(2, 10, 1)],
            3: None,
        },
    }
    return {**run, **changes}


def dead_letters(spark, places):
    found = {}
    for folder, _, files in os.walk(places["quarantine_root"]):
        for name in files:
            if name.endswith(".json"):
                table, run = (part.split("=")[1] for part in folder.split(os.sep)[-2:])
                with open(f"{folder}/{name}") as f:
                    found.setdefault((table, run), []).extend(json.loads(line) for line in f)
    return found


def test_load_run(spark, places):
    land(spark, places["bronze_root"], RUN, **small_run())
    replaced = load_run(spark, RUN, **places)
    assert all(replaced.values()) and len(replaced) == 6

    def silver(name):
        return spark.table(f"{places['db']}.{name}")

    counts = {t: silver(t).count() for t in replaced}
    assert counts == {
        "players": 3, "teams": 2, "matches": 3, "player_types": 1, "fixtures": 2, "element_summary": 3,
    }
    registered = {f["name"] for f in league.REGISTRY["players"]}
    assert set(silver("players").columns) == registered
    assert silver("players").select("ingestion_timestamp").distinct().count() == 1
    assert silver("element_summary").schema["was_home"].dataType.simpleString() == "boolean"
    overrides = {r.id: r.overrides for r in silver("matches").collect()}
    assert overrides[1].asDict() == {
        "rules": "null", "scoring": '{"a":1}', "element_types": "null", "pick_multiplier": None,
    }
    assert set(overrides[2]) == {None} and overrides[3] is None

    letters = dead_letters(spark, places)
    where = RUN.replace(":", "%3A")
    assert set(letters) == {("players", where), ("element_summary", where)}
    (letter,) = letters[("players", where)]
    assert letter["raw_record"] == player(2, team=2, surprise=True)
    assert letter["drift"] == {"new_fields": ["surprise"], "missing_fields": []}
    assert set(letter) == {"raw_record", "drift", "detected_at"}


def test_dead_letters_hold_the_rewritten_record(spark, places):
    matches = [
        {"id": 1, "extra": "é", "overrides": {"scoring": {"a": 1}, "pick_multiplier": 2, "other": 5}},
        {"id": 2, "extra": [1, None], "overrides": {}},
        {"id": 3, "extra": None, "overrides": None},
        {"id": 4, "extra": {"b": 1.5}},
        {"id": 5, "overrides": {"rules": {}}},
    ]
    land(spark, places["bronze_root"], RUN, **small_run(matches=matches))
    load_run(spark, RUN, **places)
    letters = dead_letters(spark, places)[("matches", RUN.replace(":", "%3A"))]
    texts = {"rules": "null", "scoring": '{"a":1}', "element_types": "null", "pick_multiplier": 2}
    assert sorted((le["raw_record"] for le in letters), key=lambda r: r["id"]) == [
        {**matches[0], "overrides": texts}, *matches[1:4],
    ]


def test_a_repeat_without_drift_leaves_no_dead_letters(spark, places):
    where = RUN.replace(":", "%3A")
    land(spark, places["bronze_root"], RUN, **small_run())
    load_run(spark, RUN, **places)
    load_run(spark, RUN, **places)
    assert len(dead_letters(spark, places)[("players", where)]) == 1
    land(spark, places["bronze_root"], LATER, **small_run())
    load_run(spark, LATER, **places)
    clean = small_run(players=[player(1, team=1)], histories={1: []})
    land(spark, places["bronze_root"], RUN, **clean)
    load_run(spark, RUN, show=False, **places)
    letters = dead_letters(spark, places)
    assert not any(found for (_, run), found in letters.items() if run == where)
    assert len(letters[("players", LATER.replace(":", "%3A"))]) == 1
    read = spark.read.json(places["quarantine_root"])
    assert {(r["table"], str(r.run_timestamp)[:10]) for r in read.collect()} == {("players", LATER[:10]), ("element_summary", LATER[:10])}


def test_the_bootstrap_document_is_parsed_once(spark, places):
    land(spark, places["bronze_root"], RUN, **small_run())
    read = []

    def reader(spark, root, endpoint, run):
        read.append(endpoint)
        return bronze.read_documents(spark, root, endpoint, run)

    load_run(spark, RUN, read=reader, **places)
    assert sorted(read) == sorted([bronze.BOOTSTRAP, bronze.FIXTURES, bronze.SUMMARIES])
    assert not [t.name for t in spark.catalog.listTables(places["db"]) if t.name.startswith("bootstrap_records")]


def test_element_summary_is_partitioned_by_round(spark, places):
    land(spark, places["bronze_root"], RUN, **small_run())
    load_run(spark, RUN, **places)
    load = tables.view_property(spark, places["db"], "element_summary", "load_table")
    shown = spark.sql(f"SHOW PARTITIONS {places['db']}.{load}").collect()
    assert [r[0] for r in shown] == ["round=1", "round=2"]
    one = spark.table(f"{places['db']}.element_summary").where("round = 2")
    assert one.count() == 1
    assert "PartitionFilters: [isnotnull(round" in one._jdf.queryExecution().executedPlan().toString()


def test_empty_table_keeps_the_old_contents(spark, places):
    land(spark, places["bronze_root"], RUN, **small_run())
    load_run(spark, RUN, **places)
    land(spark, places["bronze_root"], LATER, **small_run(histories={1: [], 2: None}, teams=[team(9)]))
    replaced = load_run(spark, LATER, **places)
    assert [t for t, done in replaced.items() if not done] == ["element_summary"]
    assert spark.table(f"{places['db']}.element_summary").count() == 3
    assert [r.id for r in spark.table(f"{places['db']}.teams").collect()] == [9]


def test_failed_load_keeps_the_old_contents(spark, places):
    land(spark, places["bronze_root"], RUN, **small_run())
    load_run(spark, RUN, **places)
    land(spark, places["bronze_root"], LATER, **small_run(players=[player(1, now_cost="much")]))
    with pytest.raises(FAILURES):
        load_run(spark, LATER, **places)
    assert spark.table(f"{places['db']}.players").count() == 3


def test_only_recent_loads_are_kept(spark, places):
    land(spark, places["bronze_root"], RUN, **small_run())
    for _ in range(3):
        load_run(spark, RUN, **places)
    loads = [t.name for t in spark.catalog.listTables(places["db"]) if t.name.startswith("teams__load_")]
    assert len(loads) == 2
    assert spark.table(f"{places['db']}.teams").count() == 2


def test_a_hot_partition_is_split_over_tasks(spark, scratch, places):
    rows = spark.range(400_000).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 5 + 2).otherwise(1).alias("round"),
        F.xxhash64("id").alias("element"),
        F.hex(F.xxhash64("id", F.lit(1))).alias("text"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        load = tables.write_load(
            spark, rows.repartition(4), places["db"], "t", partition_by=["round"], cluster_by=["element"]
        )
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    written = spark.table(f"{places['db']}.{load}").withColumn("file", F.col("_metadata.file_path"))
    files = {r["round"]: r["files"] for r in written.groupBy("round").agg(F.countDistinct("file").alias("files")).collect()}
    assert set(files) == {1, 2, 3, 4, 5, 6} and files[1] > 2
    assert written.count() == 400_000


def test_run_is_required(spark, places):
    for run in ("", None):
        with pytest.raises(ValueError, match="run_timestamp"):
            load_run(spark, run, **places)


def test_player_history(spark, places):
    clean = {1: [appearance(1, 10, 1), appearance(1, 11, 2)], 7: [appearance(7, 10, 1)], 8: None}
    land(spark, places["bronze_root"], RUN, **small_run(histories=clean))
    at = {k: places[k] for k in ("bronze_root", "registry_root", "db")}
    assert load_player_history(spark, RUN, **at)
    rows = spark.table(f"{places['db']}.player_history")
    assert sorted((r.player_id, r.fixture) for r in rows.collect()) == [(1, 10), (1, 11), (7, 10)]
    assert rows.columns == [f["name"] for f in league.REGISTRY["player_history"]]

    land(spark, places["bronze_root"], LATER, **small_run())
    with pytest.raises(FAILURES, match="novelty"):
        load_player_history(spark, LATER, **at)


def test_missing_summaries(spark, places):
    land(spark, places["bronze_root"], RUN, **small_run(histories={2: None}))
    missing = missing_summaries(spark, places["bronze_root"], RUN)
    assert sorted(r.element_id for r in missing.collect()) == [1, 3]


def follow(spark, places):
    assert follow_runs(spark, **places).awaitTermination(120)


def contents(spark, db):
    return {
        t: sorted(map(repr, spark.table(f"{db}.{t}").drop("ingestion_timestamp").collect()))
        for t in ("players", "teams", "matches", "fixtures", "element_summary")
    }


def test_following_runs(spark, places, scratch):
    land(spark, places["bronze_root"], RUN, **small_run())
    land(spark, places["bronze_root"], LATER, **small_run(teams=[team(5)]))
    land(spark, places["bronze_root"], "2025-09-09T03:00:00Z", **small_run(), announce=False)
    follow(spark, places)
    assert loaded_run(spark, places["db"]) == LATER
    streamed = contents(spark, places["db"])

    batch = {**places, "db": places["db"] + "_batch", "quarantine_root": f"{scratch}/other"}
    load_run(spark, LATER, **batch)
    assert streamed == contents(spark, batch["db"])

    land(spark, places["bronze_root"], "2025-08-01T03:00:00Z", **small_run(teams=[team(4)]))
    follow(spark, places)
    assert [r.id for r in spark.table(f"{places['db']}.teams").collect()] == [5]

    newest = "2025-09-03T03:00:00Z"
    land(spark, places["bronze_root"], newest, **small_run(teams=[team(6)]))
    follow(spark, places)
    assert [r.id for r in spark.table(f"{places['db']}.teams").collect()] == [6]
    assert loaded_run(spark, places["db"]) == newest


def test_loading_runs_without_marks(spark, places):
    root = places["bronze_root"]
    land(spark, root, RUN, **small_run(histories={1: None}), announce=False)
    land(spark, root, LATER, **small_run(teams=[team(5)]), announce=False)
    newest = "2025-09-03T03:00:00Z"
    land(spark, root, newest, **small_run(teams=[team(6)], histories={1: None}), announce=False)
    assert {r.run_timestamp for r in bronze.landed_runs(spark, root).collect()} == {RUN, LATER, newest}
    assert load_landed(spark, **places) == [RUN, LATER]
    assert loaded_run(spark, places["db"]) == LATER and load_landed(spark, **places) == []
    land(spark, root, newest, **small_run(teams=[team(6)]), announce=False)
    options = [f"--{k}={places[k + '_root']}" for k in ("bronze", "registry", "quarantine")]
    main([*options, f"--silver-db={places['db']}", "--unannounced"])
    assert [r.id for r in spark.table(f"{places['db']}.teams").collect()] == [6]


def test_landed_runs_of_single_files(spark, scratch):
    for name in ("bootstrap-static/r 1%.json", "fixtures/r 1%.json", "element-summaries/r 1%/7.json", "fixtures/r2.json"):
        path = f"{scratch}/{name}"
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            f.write("{}")
    assert [r.run_timestamp for r in bronze.landed_runs(spark, scratch).collect()] == ["r 1%"]
