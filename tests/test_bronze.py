import json
import os
import random

import pytest
from league import FAILURES
from pyspark.sql import functions as F

from touchline.operators.completeness import missing_snapshots
from touchline.plans.load import missing_summaries, run_records
from touchline.sources import bronze
from touchline.sources.registry import load_schema, struct_type


def docs(spark, *items):
    texts = [(i if isinstance(i, str) else json.dumps(i),) for i in items]
    return spark.createDataFrame(texts, "value string")


BOOT = {"elements": [{"id": 1}, {"id": 2}], "teams": [], "events": [{"id": 5}], "element_types": []}


def test_bootstrap_split(spark):
    df = docs(spark, BOOT)
    got = {t: [r.record for r in bronze.bootstrap_records(df, t).collect()] for t in bronze.BOOTSTRAP_ARRAYS}
    assert got == {"players": ['{"id":1}', '{"id":2}'], "teams": [], "matches": ['{"id":5}'], "player_types": []}
    assert [r.element_id for r in bronze.element_ids(df).collect()] == [1, 2]


@pytest.mark.parametrize("bad", [{k: v for k, v in BOOT.items() if k != "teams"}, '{"teams": [', "7", "{'teams': []}"])
def test_bad_bootstrap_fails(spark, bad):
    with pytest.raises(FAILURES):
        bronze.bootstrap_records(docs(spark, bad), "teams").collect()


def test_array_document(spark):
    assert [r.record for r in bronze.array_records(docs(spark, [{"id": 1}, {"id": 2}])).collect()] == [
        '{"id":1}', '{"id":2}',
    ]
    with pytest.raises(FAILURES):
        bronze.array_records(docs(spark, "[{")).collect()


def test_history(spark):
    df = docs(
        spark,
        {"element_id": 1, "history": [{"round": 1}, {"round": 2}]},
        {"element_id": 2, "history": []},
        {"element_id": 3},
    )
    rows = bronze.history_records(df, player_id="element_id").collect()
    assert [(r.player_id, r.record) for r in rows] == [(1, '{"round":1}'), (1, '{"round":2}')]
    with pytest.raises(FAILURES, match="not an array"):
        bronze.history_records(docs(spark, {"history": None})).collect()


def test_round_trip_by_run(spark, scratch):
    run = bronze.new_run()
    bronze.write_documents(docs(spark, json.dumps(BOOT, indent=1)), scratch, bronze.BOOTSTRAP, run)
    bronze.write_documents(docs(spark, "[]"), scratch, bronze.BOOTSTRAP, "other:run")
    assert [json.loads(r.value) for r in bronze.read_documents(spark, scratch, bronze.BOOTSTRAP, run).collect()] == [BOOT]


def test_one_document_per_file(spark, scratch):
    os.makedirs(f"{scratch}/element-summaries/run1")
    for i in (1, 2):
        with open(f"{scratch}/element-summaries/run1/{i:04d}.json", "w") as f:
            json.dump({"element_id": i, "history": [{"round": i}]}, f, indent=2)
    os.makedirs(f"{scratch}/bootstrap-static")
    with open(f"{scratch}/bootstrap-static/run1.json", "w") as f:
        json.dump({**BOOT, "elements": [{"id": i} for i in (1, 2, 3)]}, f, indent=2)

    rows = bronze.read_files(spark, scratch, bronze.SUMMARIES, "run1")
    assert bronze.history_records(rows).count() == 2
    assert sorted(os.path.basename(r.file_path) for r in rows.collect()) == ["0001.json", "0002.json"]
    assert run_records(spark, scratch, "run1", "players", bronze.read_files).count() == 3
    missing = missing_summaries(spark, scratch, "run1", bronze.read_files)
    assert [r.element_id for r in missing.collect()] == [3]


def test_tag_documents(spark):
    df = spark.createDataFrame(
        [(7, '{"history": [{"x": "é", "f": 1.5}], "z": null}'), (8, "{}"), (9, '{"element_id": 1}')],
        "element_id bigint, value string",
    )
    assert [json.loads(r.value) for r in bronze.tag_documents(df).collect()] == [
        {"history": [{"x": "é", "f": 1.5}], "z": None, "element_id": 7},
        {"element_id": 8},
        {"element_id": 9},
    ]


def test_as_documents(spark):
    df = spark.createDataFrame([(1, None)], "id int, name string")
    assert bronze.as_documents(df).first()[0] == '{"id":1,"name":null}'


def test_missing_snapshots(spark):
    expected = spark.createDataFrame([(1,), (2,), (3,)], "element_id bigint")
    landed = bronze.landed_ids(docs(spark, {"element_id": 1}, {"element_id": 1}, {"element_id": 3}))
    assert [r.element_id for r in missing_snapshots(expected, landed, ["element_id"]).collect()] == [2]


def test_registry(spark, scratch):
    fields = [
        {"name": "id", "type": "INTEGER", "mode": "REQUIRED"},
        {"name": "tags", "type": "STRING", "mode": "REPEATED"},
        {"name": "o", "type": "RECORD", "fields": [{"name": "x", "type": "FLOAT64"}, {"name": "t", "type": "TIMESTAMP"}]},
        {"name": "b", "type": "boolean"},
    ]
    with open(f"{scratch}/t.json", "w") as f:
        json.dump(fields, f)
    schema = load_schema(spark, scratch, "t")
    assert schema.simpleString() == (
        "struct<id:bigint,tags:array<string>,o:struct<x:double,t:timestamp>,b:boolean>"
    )
    assert not schema["id"].nullable and schema["b"].nullable
    with pytest.raises(ValueError, match="GEOGRAPHY"):
        struct_type([{"name": "g", "type": "GEOGRAPHY"}])


def test_records_of_one_document_are_spread_over_tasks(spark):
    many = [{"id": i % 7, "note": random.Random(i).randbytes(100).hex()} for i in range(100_000)]
    rows = json.dumps(many)
    boot = json.dumps({**{name: [{"id": 1}] for name in bronze.BOOTSTRAP_ARRAYS.values()}, "elements": many})
    for records in (bronze.array_records(docs(spark, rows)), bronze.tagged_records(docs(spark, boot))):
        tasks = records.select("record", F.spark_partition_id().alias("task")).groupBy("task")
        sizes = [r["count"] for r in tasks.agg(F.count("record").alias("count"), F.max("record")).collect()]
        assert sum(sizes) >= 100_000 and len(sizes) >= 4 and max(sizes) <= 2 * min(sizes)


def test_tagged_records_come_from_one_scan(spark, scratch):
    df = docs(spark, BOOT)
    tagged = bronze.tagged_records(df)
    got = {t: [r.record for r in bronze.bootstrap_records(df, t).collect()] for t in bronze.BOOTSTRAP_ARRAYS}
    assert sorted((r["table"], r.record) for r in tagged.collect()) == sorted((t, r) for t, rs in got.items() for r in rs)
    spark.createDataFrame([(json.dumps(BOOT),)], "value string").write.text(f"{scratch}/boot")
    plan = bronze.tagged_records(spark.read.text(f"{scratch}/boot"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
