import random
from collections import defaultdict
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import league
from touchline.plans import marts, staging
from touchline.sources.registry import struct_type

AS_OF = "2025-09-01T00:00:00Z"


def silver(spark, table, rows):
    schema = struct_type([f for f in league.REGISTRY[table] if f["name"] != "ingestion_timestamp"])
    return spark.createDataFrame([tuple(r[n] for n in schema.names) for r in rows], schema)


def staged(spark, table, rows):
    view = {t: project for t, project in staging.STAGING.values()}[table]
    return view(silver(spark, table, rows))


def by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


@pytest.fixture
def teams(spark):
    return staged(spark, "teams", [league.team(1), league.team(2), league.team(3)])


# --- staging -----------------------------------------------------------------------------------


def test_stg_players(spark):
    rows = [
        league.player(1, element_type=1, now_cost=55, total_points=31, minutes=270, form="4.5"),
        league.player(2, element_type=9, now_cost=0, total_points=3, minutes=0, selected_by_percent=None),
    ]
    got = by(staged(spark, "players", rows), "player_id")
    assert (got[1].position, got[1].price, got[1].form) == ("Goalkeeper", 5.5, 4.5)
    assert (got[1].points_per_million, got[1].points_per_90) == (5.64, 10.33)
    assert (got[2].position, got[2].points_per_million, got[2].points_per_90) == (None, None, None)
    assert got[2].selected_by_percent is None


def test_stg_times_and_names(spark):
    fixture = staged(spark, "fixtures", [league.fixture(7, 3, 1, 2)])
    assert fixture.select(F.unix_timestamp("kickoff_time")).first()[0] == 1756911600
    assert fixture.columns[:4] == ["fixture_id", "code", "gameweek", "kickoff_time"]
    es = staged(spark, "element_summary", [league.appearance(1, 7, 3, value=123, threat="7.5")])
    assert (es.first().price, es.first().threat, es.first().gameweek) == (12.3, 7.5, 3)
    assert staged(spark, "teams", [league.team(4, points=9)]).first().league_points == 9


# --- facts -------------------------------------------------------------------------------------


def random_appearances(seed, players=12, rows=150):
    rng = random.Random(seed)
    return [
        league.appearance(
            rng.choice([1, rng.randint(1, players)]),
            fixture,
            rng.randint(1, 9),
            opponent_team=rng.randint(1, 4),
            kickoff_time=f"2025-09-0{rng.randint(1, 3)}T1{rng.randint(0, 3)}:00:00Z",
            minutes=rng.choice([0, 45, 90]),
            starts=rng.randint(0, 1),
            total_points=rng.randint(-2, 15),
            goals_scored=rng.randint(0, 3),
            assists=rng.randint(0, 2),
            expected_goals=f"{rng.random():.2f}",
            expected_goal_involvements=f"{rng.random():.2f}",
            ict_index=f"{rng.random() * 20:.1f}",
            value=rng.randint(40, 130),
        )
        for fixture in range(rows)
    ]


def half_up(x, digits):
    scaled = abs(x) * 10.0**digits + 0.5
    return (-1 if x < 0 else 1) * int(scaled) / 10.0**digits


def test_player_gameweek_keeps_every_appearance(spark, teams):
    players = staged(spark, "players", [league.player(i, team=i % 4) for i in range(1, 9)])
    es = staged(spark, "element_summary", random_appearances(1))
    got = marts.fct_player_gameweek(es, players, teams)
    assert got.count() == es.count()
    rows = by(got, "fixture_id")
    raw = {r["fixture"]: r for r in random_appearances(1)}
    for fixture, r in rows.items():
        known = r.player_id <= 8
        assert r.web_name == (f"P{r.player_id}" if known else None)
        own = r.player_id % 4
        assert r.team_name == (f"Team {own}" if known and own else None)
        opponent = raw[fixture]["opponent_team"]
        assert r.opponent_short_name == (f"T{opponent}" if opponent <= 3 else None)


def test_player_form_against_brute_force(spark, teams):
    rows = random_appearances(2)
    players = staged(spark, "players", [league.player(i, team=1) for i in range(1, 9)])
    form = by(marts.fct_player_form(staged(spark, "element_summary", rows), players, teams), "player_id")
    history = defaultdict(list)
    for r in rows:
        history[r["element"]].append(r)
    assert set(form) == set(history)
    for player, own in history.items():
        own.sort(key=lambda r: (r["round"], r["kickoff_time"], r["fixture"]))
        last, five, got = own[-1], own[-5:], form[player]
        points = [r["total_points"] for r in five]
        assert got.latest_gameweek == last["round"] and got.last_gw_points == last["total_points"]
        assert got.price == last["value"] / 10
        assert got.points_last_5_gw == sum(points) and got.gw_count_in_window == len(five)
        assert got.avg_points_last_5_gw == half_up(sum(points) / len(five), 2)
        xgi = sum(round(100 * float(r["expected_goal_involvements"])) for r in five)
        assert got.xgi_last_5_gw == xgi / 100
        assert got.minutes_last_5_gw == sum(r["minutes"] for r in five)
        ict = sum(round(10 * float(r["ict_index"])) for r in five) / 10
        assert got.avg_ict_last_5_gw == half_up(ict / len(five), 2)
        assert got.web_name == (f"P{player}" if player <= 8 else None)


@pytest.mark.parametrize("count", [1, 4, 5, 6])
def test_form_window_counts(spark, teams, count):
    rows = [league.appearance(1, i, i, total_points=i) for i in range(1, count + 1)]
    form = marts.fct_player_form(
        staged(spark, "element_summary", rows), staged(spark, "players", [league.player(1)]), teams
    ).first()
    assert form.gw_count_in_window == min(count, 5)
    assert form.points_last_5_gw == sum(range(1, count + 1)[-5:])


def test_season_stats_against_brute_force(spark, teams):
    rows = random_appearances(3)
    players = staged(spark, "players", [league.player(i, team=2) for i in range(1, 9)])
    stats = by(
        marts.fct_player_season_stats(staged(spark, "element_summary", rows), players, teams), "player_id"
    )
    history = defaultdict(list)
    for r in rows:
        history[r["element"]].append(r)
    assert set(stats) == set(history)
    for player, own in history.items():
        got = stats[player]
        minutes = sum(r["minutes"] for r in own)
        points = sum(r["total_points"] for r in own)
        assert got.gameweeks_played == len(own)
        assert got.gameweeks_with_minutes == sum(r["minutes"] > 0 for r in own)
        assert got.goal_involvements == sum(r["goals_scored"] + r["assists"] for r in own)
        xg = sum(round(100 * float(r["expected_goals"])) for r in own) / 100
        assert got.expected_goals == xg
        assert got.xg_per_90 == (half_up(xg / minutes * 90, 2) if minutes else None)
        assert got.points_per_90 == (half_up(points / minutes * 90, 2) if minutes else None)
        assert got.current_price == max(r["value"] for r in own) / 10
        assert got.avg_price == half_up(sum(r["value"] for r in own) / 10 / len(own), 1)
        assert got.team_name == ("Team 2" if player <= 8 else None)


def test_season_stats_without_minutes(spark, teams):
    es = staged(spark, "element_summary", [league.appearance(99, 1, 1, minutes=0, total_points=2, value=40)])
    got = marts.fct_player_season_stats(es, staged(spark, "players", []), teams).first()
    assert (got.web_name, got.gameweeks_played, got.gameweeks_with_minutes) == (None, 1, 0)
    assert got.points_per_90 is None and got.xg_per_90 is None and got.points_per_million == 0.5


# --- fixtures ----------------------------------------------------------------------------------


def test_fixture_schedule(spark, teams):
    fixtures = [
        league.fixture(1, 2, 1, 2, team_h_difficulty=2, team_a_difficulty=0),
        league.fixture(2, 2, 3, 9, team_h_difficulty=5, team_a_difficulty=1),
        league.fixture(3, 2, 1, 2, finished=True),
        league.fixture(4, 2, 1, 2, finished=None),
        league.fixture(5, 2, 1, 2, kickoff_time=None),
        league.fixture(6, 1, 1, 2, kickoff_time="2025-08-31T15:00:00Z"),
        league.fixture(7, 1, 1, 2, kickoff_time=AS_OF),
    ]
    got = marts.fct_fixture_schedule(staged(spark, "fixtures", fixtures), teams, AS_OF)
    rows = by(got, "fixture_id", "venue")
    assert set(rows) == {(1, "Home"), (1, "Away"), (2, "Home"), (2, "Away")}
    assert rows[1, "Home"].difficulty_label == "Easy" and rows[1, "Away"].difficulty_label is None
    assert (rows[1, "Away"].team_name, rows[1, "Away"].opponent_name) == ("Team 2", "Team 1")
    assert (rows[2, "Away"].team_id, rows[2, "Away"].team_name) == (9, None)
    ordered = [(r.fixture_id, r.venue) for r in marts.in_order("fct_fixture_schedule", got).collect()]
    assert ordered == [(2, "Away"), (1, "Home"), (1, "Away"), (2, "Home")]


def test_schedule_defaults_to_now(spark, teams):
    fixtures = [
        league.fixture(1, 1, 1, 2, kickoff_time="2001-01-01T00:00:00Z"),
        league.fixture(2, 2, 1, 2, kickoff_time=f"{datetime.now().year + 1}-01-02T00:00:00Z"),
    ]
    got = marts.fct_fixture_schedule(staged(spark, "fixtures", fixtures), teams)
    assert {r.fixture_id for r in got.collect()} == {2}


def captain_inputs(spark, seed, teams):
    """Many players and fixtures per team, so that ties and cuts matter."""
    rng = random.Random(seed)
    players = [
        league.player(
            i,
            team=rng.choice([1, 1, 2, 3, 4, None]),
            minutes=rng.choice([450, 451, 900]),
            status=rng.choice("aaai"),
            form=rng.choice(["0.0", "1.0", "2.0", None]),
        )
        for i in range(1, 120)
    ]
    fixtures = [
        league.fixture(
            i,
            rng.choice([3, 3, 4]),
            rng.choice([1, 2]),
            3,
            team_h_difficulty=rng.choice([1, 2, 3, 4, None]),
            team_a_difficulty=rng.randint(1, 5),
        )
        for i in range(1, 60)
    ]
    appearances = [
        league.appearance(rng.randint(1, 110), i, rng.randint(1, 5), total_points=rng.randint(0, 3))
        for i in range(300)
    ]
    staged_players = staged(spark, "players", players)
    form = marts.fct_player_form(staged(spark, "element_summary", appearances), staged_players, teams)
    schedule = marts.fct_fixture_schedule(staged(spark, "fixtures", fixtures), teams, AS_OF)
    return staged_players, form, schedule


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("picks", [3, 20])
def test_captain_picks_against_all_pairs(spark, teams, seed, picks):
    players, form, schedule = captain_inputs(spark, seed, teams)
    got = [
        (r.player_id, r.venue, r.fixture_difficulty, r.opponent_short_name, r.captain_score)
        for r in marts.fct_captain_picks(players, form, schedule, picks).collect()
    ]
    forms = by(form, "player_id")
    games = schedule.collect()
    first = min(g.gameweek for g in games)
    pairs = []
    for p in players.collect():
        if not (p.minutes > 450 and p.status == "a"):
            continue
        f = forms.get(p.player_id)
        base = (f.avg_points_last_5_gw if f else 0.0) * 0.4 + (f.xgi_last_5_gw if f else 0.0) * 3.0
        for g in [g for g in games if g.gameweek == first and g.team_id == p.team] or [None]:
            level = g.difficulty if g else None
            bonus = 0 if level is None else 5 if level <= 2 else 3 if level == 3 else 0
            score = half_up(base + bonus + (p.form or 0.0) * 0.5, 2)
            pairs.append(
                (
                    (-score, p.player_id, g.fixture_id if g else -1, g.venue if g else ""),
                    (p.player_id, g and g.venue, level, g and g.opponent_short_name, score),
                )
            )
    assert got == [row for _, row in sorted(pairs, key=lambda x: x[0])[:picks]]


def test_captain_without_fixture_or_form(spark, teams):
    players = staged(spark, "players", [league.player(1, team=2, minutes=900, status="a", form="3.0")])
    schedule = marts.fct_fixture_schedule(staged(spark, "fixtures", []), teams, AS_OF)
    form = marts.fct_player_form(staged(spark, "element_summary", []), players, teams)
    got = marts.fct_captain_picks(players, form, schedule).first()
    assert (got.captain_score, got.venue, got.points_last_5_gw) == (1.5, None, None)


# --- rankings ----------------------------------------------------------------------------------


def test_differentials(spark, teams):
    def p(id, **v):
        return league.player(id, **{"team": 1, "minutes": 451, "status": "a", "total_points": 10, **v})

    rows = [
        p(1, selected_by_percent="2.0"),
        p(2, selected_by_percent="0.0"),
        p(3, selected_by_percent="15.0"),
        p(4, selected_by_percent="14.9", team=9),
        p(5, selected_by_percent="1.0", minutes=450),
        p(6, selected_by_percent="1.0", status="i"),
        p(7, selected_by_percent=None),
        p(8, selected_by_percent="1.0", status=None),
    ]
    mart = marts.fct_differentials(staged(spark, "players", rows), teams)
    ordered = marts.in_order("fct_differentials", mart).collect()
    assert [(r.player_id, r.differential_score) for r in ordered] == [(1, 5.0), (4, 0.67), (2, None)]
    assert [r.team_name for r in ordered] == ["Team 1", None, "Team 1"]


def test_transfer_trends(spark, teams):
    rows = [
        league.player(1, team=1, minutes=1, transfers_in_event=11, transfers_out_event=5),
        league.player(2, team=1, minutes=0, transfers_in_event=99, transfers_out_event=5),
        league.player(3, team=1, minutes=9, transfers_in_event=5, transfers_out_event=10, transfers_in=4),
        league.player(4, team=1, minutes=9, transfers_in_event=None, transfers_out_event=1),
    ]
    mart = marts.fct_transfer_trends(staged(spark, "players", rows), teams)
    got = marts.in_order("fct_transfer_trends", mart).collect()
    assert [(r.player_id, r.net_transfers_event, r.transfer_momentum) for r in got] == [
        (1, 6, "Strong Buy"), (3, -5, "Sell"), (4, None, "Neutral"),
    ]
    assert got[1].net_transfers_season == 4


def test_top_players(spark):
    def p(id, **v):
        return league.player(
            id, **{"minutes": 1800, "now_cost": 50, "total_points": 100, "expected_goal_involvements": "2.0", **v}
        )

    players = [
        p(1, team=1, element_type=4),
        p(2, team=2, total_points=120),
        p(3, team=5),
        p(4, team=1, minutes=1500),
        p(5, team=1, expected_goal_involvements=None),
    ]
    same_time = "2025-09-05T12:00:00Z"
    fixtures = [
        league.fixture(1, 8, 1, 2, kickoff_time="2025-09-06T12:00:00Z"),
        league.fixture(3, 7, 2, 1, kickoff_time=same_time, team_a_difficulty=3),
        league.fixture(2, 7, 1, 3, kickoff_time=same_time, team_h_difficulty=4),
        league.fixture(4, 1, 1, 2, finished=True),
    ]
    mart = marts.fct_top_players(
        staged(spark, "players", players), staged(spark, "fixtures", fixtures), AS_OF
    )
    got = marts.in_order("fct_top_players", mart).collect()
    assert [r.web_name for r in got] == ["P2", "P1", "P3", "P5"]
    first, third = got[1], got[2]
    assert (first.points_per_90, first.points_per_million, first.xgi_per_90) == (5.0, 20.0, 0.1)
    assert (first.opponent, first.home_or_away, first.fixture_difficulty_label) == (3, "Home", "Hard")
    assert first.position == "Forward" and first.element_type == 4
    assert third.next_gameweek is None and third.fixture_difficulty_label is None
    assert got[3].xgi_per_90 is None
