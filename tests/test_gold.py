import os

import league
from league import appearance, fixture, land, player, team
from touchline.plans.gold import MARTS, build_gold
from touchline.plans.nightly import main

RUN = "2025-09-01T03:00:00Z"


def test_bronze_to_gold(spark, scratch):
    name = os.path.basename(scratch).replace("-", "_").lower()
    silver, gold = f"s_{name}", f"g_{name}"
    league.write_registry(f"{scratch}/registry")
    land(
        spark,
        f"{scratch}/bronze",
        RUN,
        players=[player(i, team=1 + i % 2, minutes=900 * i, status="a", now_cost=50) for i in (1, 2, 3)],
        teams=[team(1), team(2)],
        fixtures=[fixture(9, 3, 1, 2, finished=True), fixture(10, 4, 1, 2), fixture(11, 5, 2, 1)],
        histories={i: [appearance(i, f, f - 8, total_points=f) for f in (9, 10)] for i in (1, 2, 3)},
        matches=[{"id": 1}],
        types=[{"id": 1}],
    )
    places = [f"--{p}={scratch}/{p}" for p in ("bronze", "registry", "quarantine")]
    main([f"--run={RUN}", *places, f"--silver-db={silver}", f"--gold-db={gold}"])
    # a rebuild replaces, never appends
    build_gold(spark, silver_db=silver, gold_db=gold, as_of="2025-09-03T20:00:00Z")
    counts = {m: spark.table(f"{gold}.{m}").count() for m in MARTS}
    assert counts == {
        "fct_player_gameweek": 6,
        "fct_player_season_stats": 3,
        "fct_player_form": 3,
        "fct_fixture_schedule": 4,
        "fct_captain_picks": 3,
        "fct_differentials": 3,
        "fct_transfer_trends": 3,
        "fct_top_players": 2,
    }
    assert {r.next_gameweek for r in spark.table(f"{gold}.fct_captain_picks").collect()} == {4}
    rates = spark.sql("SELECT safe_divide(minutes, player_id - 1) AS rate FROM stg_players ORDER BY player_id")
    assert [r.rate for r in rates.collect()] == [None, 1800.0, 1350.0]
    later = dict(silver_db=silver, gold_db=gold, as_of="2026-01-01T00:00:00Z")
    build_gold(spark, **later)  # an emptied mart is empty, not stale
    assert spark.table(f"{gold}.fct_fixture_schedule").count() == 0
    assert {r.next_gameweek for r in spark.table(f"{gold}.fct_captain_picks").collect()} == {None}
