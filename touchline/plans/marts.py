"""Mart tables over staged inputs.

Every function takes staged DataFrames and returns the unsorted table; ``in_order`` sorts one for
presentation. Ids are taken to be unique in players, teams and fixtures. Dimension joins carry no
broadcast hint: Spark broadcasts a side whose measured size allows it and otherwise shuffles, with
adaptive skew splitting. Facts are reduced to one row per player before names are joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from touchline.functions.labels import difficulty, transfer_momentum
from touchline.functions.scalars import (
    exact_avg,
    exact_sum,
    per_90,
    round_half_away,
    safe_divide,
)
from touchline.operators.fixtures import by_team, in_next_gameweek, next_per_team, upcoming
from touchline.operators.keyed import first_n_per_key
from touchline.plans.staging import DEFENSIVE_COUNTS, MATCH_COUNTS, TEXT_METRICS

FORM_ROWS = 5
REGULAR_MINUTES = 450
TOP_MINUTES = 1500
LOW_OWNERSHIP = 15
CAPTAIN_PICKS = 20

NO_FIXTURE_BONUS = 0


def _team_names(teams: DataFrame, key: str, prefix: str) -> DataFrame:
    return teams.select(
        F.col("team_id").alias(key),
        F.col("name").alias(f"{prefix}_name"),
        F.col("short_name").alias(f"{prefix}_short_name"),
    )


def with_team(df: DataFrame, teams: DataFrame, key: str, prefix: str) -> DataFrame:
    """Left join of a team's names on ``key``, in the role ``prefix``."""
    return df.join(_team_names(teams, key, prefix), key, "left")


def named_players(players: DataFrame, teams: DataFrame) -> DataFrame:
    """Players with their own team's names: small next to the facts, so joined first."""
    return with_team(players, teams, "team", "team").select(
        "player_id",
        "web_name",
        "first_name",
        "second_name",
        "position",
        "position_id",
        "team_name",
        "team_short_name",
    )


def fct_player_gameweek(appearances: DataFrame, players: DataFrame, teams: DataFrame) -> DataFrame:
    """One row per player and fixture, with the names of player, team and opponent."""
    facts = appearances.withColumnRenamed("opponent_team", "opponent")
    named = facts.join(named_players(players, teams), "player_id", "left")
    return with_team(named, teams, "opponent", "opponent").select(
        "gameweek",
        "player_id",
        "web_name",
        "first_name",
        "second_name",
        "position",
        "position_id",
        "team_name",
        "team_short_name",
        "opponent_name",
        "opponent_short_name",
        "was_home",
        "kickoff_time",
        "fixture_id",
        *MATCH_COUNTS,
        *DEFENSIVE_COUNTS,
        *TEXT_METRICS,
        "price",
        "selected",
        "transfers_in",
        "transfers_out",
        "transfers_balance",
    )


# Season totals, output column -> appearance column.
SEASON_SUMS = {
    "starts": "starts",
    "total_minutes": "minutes",
    "total_points": "total_points",
    "goals_scored": "goals_scored",
    "assists": "assists",
    "clean_sheets": "clean_sheets",
    "goals_conceded": "goals_conceded",
    "own_goals": "own_goals",
    "yellow_cards": "yellow_cards",
    "red_cards": "red_cards",
    "total_bonus": "bonus",
    "total_bps": "bps",
    "saves": "saves",
    "penalties_saved": "penalties_saved",
    "penalties_missed": "penalties_missed",
    "clearances_blocks_interceptions": "clearances_blocks_interceptions",
    "recoveries": "recoveries",
    "tackles": "tackles",
}
# The totals that stand before goal involvements.
SCORING = ("starts", "total_minutes", "total_points", "goals_scored", "assists")
SEASON_METRICS = (
    "expected_goals",
    "expected_assists",
    "expected_goal_involvements",
    "expected_goals_conceded",
)
SEASON_RATES = {
    "xg_per_90": "expected_goals",
    "xa_per_90": "expected_assists",
    "xgi_per_90": "expected_goal_involvements",
    "points_per_90": "total_points",
    "goals_per_90": "goals_scored",
    "assists_per_90": "assists",
}


def season_totals(appearances: DataFrame) -> DataFrame:
    """Totals per player. Tasks combine before the shuffle, so a very busy player is no hot spot."""
    row = F.struct("player_id", "gameweek", "fixture_id")
    return appearances.groupBy("player_id").agg(
        F.count(F.lit(1)).alias("gameweeks_played"),
        F.count_if(F.col("minutes") > 0).alias("gameweeks_with_minutes"),
        *[F.sum(source).alias(name) for name, source in SEASON_SUMS.items()],
        *[exact_sum(F.col(m), row=row).alias(m) for m in SEASON_METRICS],
        exact_avg(F.col("price"), row=row).alias("avg_price"),
        F.max("price").alias("current_price"),
    )


def fct_player_season_stats(
    appearances: DataFrame, players: DataFrame, teams: DataFrame
) -> DataFrame:
    """Season totals and rates per player.

    ``gameweeks_played`` counts fixtures, also those without minutes; ``current_price`` is the
    highest price of the season.
    """
    named = season_totals(appearances).join(named_players(players, teams), "player_id", "left")
    rates = {
        name: per_90(F.col(total), F.col("total_minutes")) for name, total in SEASON_RATES.items()
    }
    return named.select(
        "player_id",
        "web_name",
        "first_name",
        "second_name",
        "position",
        "team_name",
        "team_short_name",
        "gameweeks_played",
        "gameweeks_with_minutes",
        *SCORING,
        (F.col("goals_scored") + F.col("assists")).alias("goal_involvements"),
        *[name for name in SEASON_SUMS if name not in SCORING],
        *[round_half_away(F.col(m), 2).alias(m) for m in SEASON_METRICS],
        *[rate.alias(name) for name, rate in rates.items()],
        round_half_away(F.col("avg_price"), 1).alias("avg_price"),
        "current_price",
        round_half_away(safe_divide(F.col("total_points"), F.col("current_price")), 2).alias(
            "points_per_million"
        ),
    )


def recent_form(appearances: DataFrame) -> DataFrame:
    """Latest appearance per player with statistics over the last five, by player id.

    Only the five newest rows of a player matter, so they are selected before the shuffle and
    aggregated; no window runs over a player's whole history. Appearances in one gameweek are
    ordered by kickoff, then fixture.
    """
    newest_first = [F.col(c).desc() for c in ("gameweek", "kickoff_time", "fixture_id")]
    recent = first_n_per_key(
        appearances.select(
            "player_id",
            "gameweek",
            "kickoff_time",
            "fixture_id",
            "price",
            "total_points",
            "minutes",
            "expected_goal_involvements",
            "ict_index",
        ),
        ["player_id"],
        newest_first,
        FORM_ROWS,
    )

    def latest(name: str) -> Column:
        return F.max(F.when(F.col("rn") == 1, F.col(name)))

    return recent.groupBy("player_id").agg(
        latest("gameweek").alias("latest_gameweek"),
        latest("price").alias("price"),
        latest("total_points").alias("last_gw_points"),
        F.sum("total_points").alias("points_last_5_gw"),
        round_half_away(F.avg("total_points"), 2).alias("avg_points_last_5_gw"),
        round_half_away(exact_sum(F.col("expected_goal_involvements")), 2).alias("xgi_last_5_gw"),
        F.sum("minutes").alias("minutes_last_5_gw"),
        F.count(F.lit(1)).alias("gw_count_in_window"),
        round_half_away(latest("ict_index"), 2).alias("last_gw_ict"),
        round_half_away(exact_avg(F.col("ict_index")), 2).alias("avg_ict_last_5_gw"),
    )


def fct_player_form(appearances: DataFrame, players: DataFrame, teams: DataFrame) -> DataFrame:
    """Recent form of every player who has appeared, with names."""
    names = named_players(players, teams)
    return recent_form(appearances).join(names, "player_id", "left").select(
        "latest_gameweek",
        "player_id",
        "web_name",
        "position",
        "team_name",
        "price",
        "last_gw_points",
        "points_last_5_gw",
        "avg_points_last_5_gw",
        "xgi_last_5_gw",
        "minutes_last_5_gw",
        "gw_count_in_window",
        "last_gw_ict",
        "avg_ict_last_5_gw",
    )


def fct_fixture_schedule(fixtures: DataFrame, teams: DataFrame, as_of=None) -> DataFrame:
    """Two rows per upcoming fixture, one from each team's side."""
    own = teams.select(
        "team_id",
        F.col("name").alias("team_name"),
        F.col("short_name").alias("team_short_name"),
        "strength_overall_home",
        "strength_overall_away",
    )
    other = teams.select(
        F.col("team_id").alias("opponent_id"),
        F.col("name").alias("opponent_name"),
        F.col("short_name").alias("opponent_short_name"),
        "strength_defence_home",
        "strength_defence_away",
    )
    sides = by_team(upcoming(fixtures, as_of))
    return (
        sides.join(own, "team_id", "left")
        .join(other, "opponent_id", "left")
        .select(
            "gameweek",
            "fixture_id",
            "kickoff_time",
            "team_id",
            "team_name",
            "team_short_name",
            "opponent_name",
            "opponent_short_name",
            "venue",
            "difficulty",
            difficulty(F.col("difficulty")).alias("difficulty_label"),
            "strength_overall_home",
            "strength_overall_away",
            "strength_defence_home",
            "strength_defence_away",
        )
    )


def fixture_bonus(level: Column) -> Column:
    """Score points for an easy fixture. Whole numbers, so that they also serve as a join key."""
    return F.when(level <= 2, 5).when(level == 3, 3).otherwise(NO_FIXTURE_BONUS)


def captain_score(avg_points: Column, xgi: Column, bonus: Column, form: Column) -> Column:
    def known(x):
        return F.coalesce(x, F.lit(0.0))

    return round_half_away(known(avg_points) * 0.4 + known(xgi) * 3.0 + bonus + known(form) * 0.5, 2)


def fct_captain_picks(
    players: DataFrame, form: DataFrame, schedule: DataFrame, picks: int = CAPTAIN_PICKS
) -> DataFrame:
    """The ``picks`` best (player, fixture in the next gameweek) rows by captain score.

    ``form`` is ``fct_player_form`` or ``recent_form``. A team with several fixtures gives a player
    several rows. A score depends on the player and on which of three bonus classes the fixture is
    in, so within a team and class all pairs are ranked by (score, player, fixture). The best
    ``picks`` pairs can therefore only combine the class's best ``picks`` players with its first
    ``picks`` fixtures; the others are never paired.
    """
    upcoming_games = in_next_gameweek(schedule).select(
        F.col("team_id").alias("team"),
        fixture_bonus(F.col("difficulty")).alias("bonus"),
        F.col("gameweek").alias("next_gameweek"),
        "fixture_id",
        "opponent_short_name",
        "venue",
        F.col("difficulty").alias("fixture_difficulty"),
        "difficulty_label",
    )
    games = first_n_per_key(
        upcoming_games,
        ["team", "bonus"],
        [F.col("fixture_id"), F.col("venue")],
        picks,
    ).drop("rn")
    classes = upcoming_games.select("team", "bonus").distinct()

    regulars = players.where((F.col("minutes") > REGULAR_MINUTES) & (F.col("status") == "a"))
    recent = form.select(
        "player_id", "points_last_5_gw", "avg_points_last_5_gw", "xgi_last_5_gw"
    )
    scored = (
        regulars.select(
            "player_id",
            "web_name",
            "position",
            "price",
            "selected_by_percent",
            "form",
            "total_points",
            "points_per_game",
            "team",
        )
        .join(recent, "player_id", "left")
        .join(classes, "team", "left")
        .withColumn("bonus", F.coalesce("bonus", F.lit(NO_FIXTURE_BONUS)))
        .withColumn(
            "captain_score",
            captain_score(
                F.col("avg_points_last_5_gw"), F.col("xgi_last_5_gw"), F.col("bonus"), F.col("form")
            ),
        )
    )
    best = first_n_per_key(
        scored, ["team", "bonus"], [F.col("captain_score").desc(), F.col("player_id")], picks
    ).drop("rn")
    return (
        best.join(games, ["team", "bonus"], "left")
        .orderBy(F.col("captain_score").desc(), "player_id", "fixture_id", "venue")
        .limit(picks)
        .select(
            "player_id",
            "web_name",
            "position",
            "price",
            "selected_by_percent",
            "form",
            "points_last_5_gw",
            "avg_points_last_5_gw",
            "xgi_last_5_gw",
            "total_points",
            "points_per_game",
            "next_gameweek",
            "opponent_short_name",
            "venue",
            "fixture_difficulty",
            "difficulty_label",
            "captain_score",
        )
    )


def differential_score(points: Column, ownership: Column) -> Column:
    """Points per percent of ownership: high returns from players few people own."""
    return round_half_away(safe_divide(points, ownership), 2)


def fct_differentials(players: DataFrame, teams: DataFrame) -> DataFrame:
    """Available regulars few people own, by points per percent of ownership."""
    chosen = players.where(
        (F.col("selected_by_percent") < LOW_OWNERSHIP)
        & (F.col("minutes") > REGULAR_MINUTES)
        & (F.col("status") == "a")
    )
    return with_team(chosen, teams, "team", "team").select(
        "player_id",
        "web_name",
        "first_name",
        "second_name",
        "position",
        "team_name",
        "team_short_name",
        "price",
        "selected_by_percent",
        "form",
        "total_points",
        "points_per_game",
        "points_per_million",
        "points_per_90",
        "expected_goals",
        "expected_assists",
        "expected_goal_involvements",
        "minutes",
        "starts",
        "status",
        "news",
        differential_score(F.col("total_points"), F.col("selected_by_percent")).alias(
            "differential_score"
        ),
    )


def fct_transfer_trends(players: DataFrame, teams: DataFrame) -> DataFrame:
    """Net transfers and momentum of everyone who has played."""
    c = F.col
    active = players.where(c("minutes") > 0)
    return with_team(active, teams, "team", "team").select(
        "player_id",
        "web_name",
        "first_name",
        "second_name",
        "position",
        "team_name",
        "team_short_name",
        "price",
        "selected_by_percent",
        "form",
        "total_points",
        "points_per_game",
        "status",
        "transfers_in_event",
        "transfers_out_event",
        (c("transfers_in_event") - c("transfers_out_event")).alias("net_transfers_event"),
        "transfers_in",
        "transfers_out",
        (c("transfers_in") - c("transfers_out")).alias("net_transfers_season"),
        "cost_change_start",
        "cost_change_event",
        "points_per_million",
        "points_per_90",
        transfer_momentum(c("transfers_in_event"), c("transfers_out_event")).alias(
            "transfer_momentum"
        ),
    )


def fct_top_players(
    players: DataFrame, fixtures: DataFrame, as_of=None, min_minutes: int = TOP_MINUTES
) -> DataFrame:
    """Players with many minutes and the next fixture of their team (team ids, not names)."""
    c = F.col
    following = next_per_team(by_team(upcoming(fixtures, as_of))).select(
        c("team_id").alias("team"),
        c("gameweek").alias("next_gameweek"),
        c("kickoff_time").alias("next_kickoff"),
        c("venue").alias("home_or_away"),
        c("opponent_id").alias("opponent"),
        c("difficulty").alias("fixture_difficulty"),
        difficulty(c("difficulty")).alias("fixture_difficulty_label"),
    )
    return (
        players.where(c("minutes") > min_minutes)
        .join(following, "team", "left")
        .select(
            "first_name",
            "second_name",
            "web_name",
            "team",
            c("position_id").alias("element_type"),
            "position",
            "expected_goals",
            "expected_assists",
            "expected_goal_involvements",
            c("expected_goals_per_90").cast("double").alias("expected_goals_per_90"),
            c("expected_assists_per_90").cast("double").alias("expected_assists_per_90"),
            per_90(c("expected_goal_involvements"), c("minutes")).alias("xgi_per_90"),
            "total_points",
            "points_per_90",
            "minutes",
            "price",
            "points_per_million",
            "next_gameweek",
            "next_kickoff",
            "home_or_away",
            "opponent",
            "fixture_difficulty",
            "fixture_difficulty_label",
        )
    )


def composite_value() -> Column:
    """Ranking value of a top player; NULL when one of the three parts is."""
    return F.col("points_per_million") + F.col("points_per_90") + F.col("xgi_per_90")


def in_order(name: str, mart: DataFrame) -> DataFrame:
    """``mart`` sorted the way it is presented; a stored table keeps no order.

    The trailing keys settle ties and, in a large sort, split equal leading values.
    """
    leading = {
        "fct_player_form": [F.col("points_last_5_gw").desc(), "player_id"],
        "fct_player_season_stats": [F.col("total_points").desc(), "player_id"],
        "fct_fixture_schedule": ["kickoff_time", "team_name", "fixture_id", "venue"],
        "fct_differentials": [F.col("differential_score").desc(), "player_id"],
        "fct_transfer_trends": [F.col("net_transfers_event").desc(), "player_id"],
        "fct_top_players": [composite_value().desc(), "web_name"],
    }
    return mart.orderBy(*leading[name]) if name in leading else mart
