"""A small league in bronze form: registry, documents, and helpers to land a run."""

from __future__ import annotations

import json
import os

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from touchline.plans import staging
from touchline.sources import bronze

# What a failing Spark job raises, depending on where the error class comes from.
FAILURES = (PySparkException, Py4JJavaError)

INT, TEXT, NUM, BOOL = "INT64", "STRING", "FLOAT64", "BOOL"


def _fields(**kinds):
    return [{"name": n, "type": k, "mode": "NULLABLE"} for n, k in kinds.items()]


def _all(names, kind):
    return {n: kind for n in names}


STAMP = {"name": "ingestion_timestamp", "type": "TIMESTAMP", "mode": "NULLABLE"}

REGISTRY = {
    "players": _fields(
        id=INT, first_name=TEXT, second_name=TEXT, web_name=TEXT, team=INT, element_type=INT,
        status=TEXT, news=TEXT, now_cost=INT, cost_change_start=INT, cost_change_event=INT,
        **_all(staging.MATCH_COUNTS, INT),
        **_all(staging.PLAYER_TEXT_METRICS, TEXT),
        **_all(staging.RATES_PER_90, NUM),
        transfers_in=INT, transfers_out=INT, transfers_in_event=INT, transfers_out_event=INT,
    ) + [STAMP],
    "teams": _fields(
        id=INT, name=TEXT, short_name=TEXT, code=INT, position=INT, played=INT, win=INT, draw=INT,
        loss=INT, points=INT, **_all(staging.TEAM_STRENGTHS, INT), form=TEXT, unavailable=BOOL,
    ) + [STAMP],
    "matches": _fields(id=INT) + [
        {
            "name": "overrides", "type": "RECORD", "mode": "NULLABLE",
            "fields": _fields(rules=TEXT, scoring=TEXT, element_types=TEXT, pick_multiplier=INT),
        },
        STAMP,
    ],
    "player_types": _fields(id=INT, singular_name=TEXT) + [STAMP],
    "fixtures": _fields(
        id=INT, code=INT, event=INT, kickoff_time=TEXT, started=BOOL, finished=BOOL,
        finished_provisional=BOOL, team_h=INT, team_a=INT, team_h_score=INT, team_a_score=INT,
        team_h_difficulty=INT, team_a_difficulty=INT, minutes=INT,
    ) + [STAMP],
    "element_summary": _fields(
        element=INT, fixture=INT, opponent_team=INT, round=INT, was_home=BOOL, kickoff_time=TEXT,
        team_h_score=INT, team_a_score=INT,
        **_all(staging.MATCH_COUNTS, INT),
        **_all(staging.DEFENSIVE_COUNTS, INT),
        **_all(staging.TEXT_METRICS, TEXT),
        value=INT, transfers_balance=INT, selected=INT, transfers_in=INT, transfers_out=INT,
    ) + [STAMP],
}
REGISTRY["player_history"] = [*REGISTRY["element_summary"][:-1], *_fields(player_id=INT), STAMP]


def blank(table, **values):
    """A record of ``table`` with zeros and empty texts, overridden by ``values``."""
    zero = {INT: 0, TEXT: "0.0", NUM: 0.0, BOOL: False}
    record = {
        f["name"]: zero[f["type"]]
        for f in REGISTRY[table]
        if f["type"] in zero
    }
    return {**record, **values}


def write_registry(root):
    os.makedirs(root, exist_ok=True)
    for table, fields in REGISTRY.items():
        with open(f"{root}/{table}.json", "w") as f:
            json.dump(fields, f)


def player(id, **values):
    return blank("players", id=id, web_name=f"P{id}", **values)


def team(id, **values):
    return blank("teams", id=id, name=f"Team {id}", short_name=f"T{id}", **values)


def fixture(id, event, home, away, **values):
    values.setdefault("kickoff_time", f"2025-09-{event:02d}T15:00:00Z")
    return blank("fixtures", id=id, event=event, team_h=home, team_a=away, **values)


def appearance(element, fixture, round, **values):
    values.setdefault("kickoff_time", f"2025-09-{round:02d}T15:00:00Z")
    return blank("element_summary", element=element, fixture=fixture, round=round, **values)


def land(spark, root, run, *, players, teams, fixtures, histories, matches=(), types=(), announce=True):
    """Write one run. ``histories`` maps a player id to its records (None: no such array)."""
    def write(endpoint, *documents):
        rows = [(json.dumps(d),) for d in documents]
        bronze.write_documents(spark.createDataFrame(rows, "value string"), root, endpoint, run)

    write(
        bronze.BOOTSTRAP,
        {"elements": players, "teams": teams, "events": list(matches), "element_types": list(types)},
    )
    write(bronze.FIXTURES, fixtures)
    write(
        bronze.SUMMARIES,
        *[
            {"element_id": i, **({} if rows is None else {"history": rows})}
            for i, rows in histories.items()
        ],
    )
    if announce:
        bronze.announce_run(spark, root, run)
