import json

import pytest
from hypothesis import given, settings, strategies as st
from league import FAILURES
from pyspark.sql import functions as F, types as T

from touchline.operators import drift
from touchline.operators.transforms import overrides_as_text, rewrites_for

FIELDS = [
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("rate", T.DoubleType()),
    T.StructField("ok", T.BooleanType()),
]
NAMES = [f.name for f in FIELDS]
WHOLE = {"id": 1, "name": "a", "rate": 0.5, "ok": True}


def drifts(df):
    return [r.drift.asDict() if r.drift else None for r in drift.with_drift(df, NAMES).collect()]


def test_drift_needs_a_new_field(records):
    df = records(
        WHOLE,
        {"id": 1},
        {**WHOLE, "zeta": 1, "alpha": {"x": 1}},
        {"id": 1, "extra": None},
        {**WHOLE, "ingestion_timestamp": "x"},
    )
    assert drifts(df) == [
        None,
        None,
        {"new_fields": ["alpha", "zeta"], "missing_fields": []},
        {"new_fields": ["extra"], "missing_fields": ["name", "ok", "rate"]},
        {"new_fields": ["ingestion_timestamp"], "missing_fields": []},
    ]


def test_drifting_records_are_still_conformed(records):
    df = records({**WHOLE, "extra": 1}, {"id": 2}, {"id": "3", "name": 7, "rate": "0.25", "ok": "false"})
    assert [tuple(r) for r in drift.conform(df, FIELDS).collect()] == [
        (1, "a", 0.5, True),
        (2, None, None, None),
        (3, "7", 0.25, False),
    ]


def test_values_are_converted_as_in_a_load(records):
    df = records(
        {"id": "12", "name": 1.5, "rate": 3, "ok": True},
        {"id": -4, "name": {"a": [1]}, "rate": "1e3", "ok": "true"},
        {"id": None, "name": True, "rate": None, "ok": None},
        '{"id": 9007199254740993, "name": "", "rate": 0.1}',
    )
    assert [tuple(r) for r in drift.conform(df, FIELDS).collect()] == [
        (12, "1.5", 3.0, True),
        (-4, '{"a":[1]}', 1000.0, True),
        (None, "true", None, None),
        (9007199254740993, "", 0.1, None),
    ]


@pytest.mark.parametrize("bad", ['{"id": "x"}', '{"id": 1', "[1, 2", '{"ok": 7.5}', '{"id": 1.5}', '{"rate": "-"}', "{'id': 1}"])
def test_bad_values_fail(records, bad):
    with pytest.raises(FAILURES):
        drift.conform(records(bad), FIELDS).collect()


@pytest.mark.parametrize("bad", ['{"id": 1', "[1]", "5"])
def test_drift_fails_on_anything_but_an_object(records, bad):
    with pytest.raises(FAILURES):
        drift.with_drift(records(bad), NAMES).collect()


def test_required_field(records):
    needed = [T.StructField("id", T.LongType(), nullable=False)]
    with pytest.raises(FAILURES, match="required field id"):
        drift.conform(records({}), needed).collect()


NESTED = [
    T.StructField(
        "o",
        T.StructType(
            [
                T.StructField("n", T.LongType()),
                T.StructField("l", T.ArrayType(T.StructType([T.StructField("b", T.BooleanType())]))),
            ]
        ),
    ),
    T.StructField("tags", T.ArrayType(T.DoubleType())),
]


def test_nested_values(records):
    df = records({"o": {"n": "4", "l": [{"b": True}, None, {}], "more": 1}, "tags": ["1.5", 2, None]}, {"o": None})
    got = [r.asDict(recursive=True) for r in drift.conform(df, NESTED).collect()]
    assert got == [
        {"o": {"n": 4, "l": [{"b": True}, None, {"b": None}]}, "tags": [1.5, 2.0, None]},
        {"o": None, "tags": None},
    ]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("bad", [{"o": {"n": "x"}}, {"o": {"l": [{"b": "maybe"}]}}, {"tags": ["high"]}])
def test_nested_misfits_fail(spark, records, bad, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(FAILURES, match="is not a"):
            drift.conform(records(bad), NESTED).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_quarantine_and_counts(records):
    df = drift.with_drift(records(WHOLE, {**WHOLE, "x": 1}, {"id": 1, "x": 1, "y": 2}), NAMES)
    payload = drift.quarantine_payload(df, "t", "run", F.lit("now")).collect()
    assert [json.loads(r.raw_record) for r in payload] == [{**WHOLE, "x": 1}, {"id": 1, "x": 1, "y": 2}]
    assert {(r.table, r.run_timestamp, r.detected_at) for r in payload} == {("t", "run", "now")}
    assert sorted(map(tuple, drift.drift_counts(df).collect())) == [
        ("missing_field", "name", 1),
        ("missing_field", "ok", 1),
        ("missing_field", "rate", 1),
        ("new_field", "x", 2),
        ("new_field", "y", 1),
    ]


keys = st.sampled_from(["id", "name", "rate", "ok", "x", "y", "Id", "é", "ingestion_timestamp"])


@settings(max_examples=8, deadline=None)
@given(st.lists(st.dictionaries(keys, st.none(), max_size=7), min_size=1, max_size=20))
def test_drift_against_sets(records, items):
    def expected(item):
        new = sorted(set(item) - set(NAMES))
        return {"new_fields": new, "missing_fields": sorted(set(NAMES) - set(item))} if new else None

    df = records(*items).coalesce(1)
    assert drifts(df) == [expected(i) for i in items]
    assert drift.conform(df, FIELDS).distinct().collect() == [(None, None, None, None)]


OVERRIDES = T.StructField(
    "overrides",
    T.StructType(
        [
            T.StructField("rules", T.StringType()),
            T.StructField("pick_multiplier", T.LongType()),
            T.StructField("scoring", T.StringType()),
            T.StructField("element_types", T.StringType()),
        ]
    ),
)


def rewritten(df):
    rows = drift.conform(df, [OVERRIDES], {"overrides": overrides_as_text}).collect()
    return [tuple(r.overrides) if r.overrides is not None else None for r in rows]


def test_overrides(records):
    df = records(
        {},
        {"overrides": None},
        {"overrides": {}},
        {"overrides": {"scoring": {}}},
        {"overrides": {"rules": {"a": [1]}, "pick_multiplier": 3, "element_types": [], "other": 1}},
        {"overrides": {"other": 1}},
        {"overrides": {"rules": None}},
    )
    assert rewritten(df) == [
        None,
        None,
        (None, None, None, None),
        ("null", None, "{}", "null"),
        ('{"a":[1]}', 3, "null", "[]"),
        ("null", None, "null", "null"),
        ("null", None, "null", "null"),
    ]


def test_overrides_must_be_an_object(records):
    with pytest.raises(FAILURES, match="not a JSON object"):
        rewritten(records({"overrides": [1]}))


def test_only_matches_are_rewritten():
    assert set(rewrites_for("matches")) == {"overrides"}
    assert rewrites_for("players") == {}
