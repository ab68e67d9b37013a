"""Staging: silver tables renamed and typed for analysis. Pure projections, meant as views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from touchline.functions.labels import position
from touchline.functions.scalars import as_number, per_90, points_per_million, price

# Columns of the silver tables, grouped by how they are staged.
TEXT_METRICS = [
    "expected_goals",
    "expected_assists",
    "expected_goal_involvements",
    "expected_goals_conceded",
    "influence",
    "creativity",
    "threat",
    "ict_index",
]
MATCH_COUNTS = [
    "minutes",
    "starts",
    "total_points",
    "goals_scored",
    "assists",
    "clean_sheets",
    "goals_conceded",
    "own_goals",
    "yellow_cards",
    "red_cards",
    "saves",
    "bonus",
    "bps",
    "penalties_saved",
    "penalties_missed",
]
DEFENSIVE_COUNTS = ["clearances_blocks_interceptions", "recoveries", "tackles", "defensive_contribution"]
RATES_PER_90 = [
    "expected_goals_per_90",
    "expected_assists_per_90",
    "expected_goal_involvements_per_90",
    "expected_goals_conceded_per_90",
    "saves_per_90",
    "goals_conceded_per_90",
    "starts_per_90",
    "clean_sheets_per_90",
    "defensive_contribution_per_90",
]
PLAYER_TEXT_METRICS = [*TEXT_METRICS, "form", "selected_by_percent", "points_per_game"]
TEAM_STRENGTHS = [
    "strength",
    "strength_overall_home",
    "strength_overall_away",
    "strength_attack_home",
    "strength_attack_away",
    "strength_defence_home",
    "strength_defence_away",
]


def _numbers(names: Sequence[str]) -> list[Column]:
    return [as_number(F.col(n)).alias(n) for n in names]


def stg_players(players: DataFrame) -> DataFrame:
    c = F.col
    return players.select(
        c("id").alias("player_id"),
        "first_name",
        "second_name",
        "web_name",
        "team",
        c("element_type").alias("position_id"),
        position(c("element_type")).alias("position"),
        "status",
        "news",
        price(c("now_cost")).alias("price"),
        "cost_change_start",
        "cost_change_event",
        *MATCH_COUNTS,
        *_numbers(PLAYER_TEXT_METRICS),
        *RATES_PER_90,
        "transfers_in",
        "transfers_out",
        "transfers_in_event",
        "transfers_out_event",
        points_per_million(c("total_points"), c("now_cost")).alias("points_per_million"),
        per_90(c("total_points"), c("minutes")).alias("points_per_90"),
    )


def stg_teams(teams: DataFrame) -> DataFrame:
    c = F.col
    return teams.select(
        c("id").alias("team_id"),
        "name",
        "short_name",
        "code",
        c("position").alias("league_position"),
        "played",
        "win",
        "draw",
        "loss",
        c("points").alias("league_points"),
        *TEAM_STRENGTHS,
        *_numbers(["form"]),
        "unavailable",
    )


def stg_fixtures(fixtures: DataFrame) -> DataFrame:
    c = F.col
    return fixtures.select(
        c("id").alias("fixture_id"),
        "code",
        c("event").alias("gameweek"),
        c("kickoff_time").cast("timestamp").alias("kickoff_time"),
        "started",
        "finished",
        "finished_provisional",
        "team_h",
        "team_a",
        "team_h_score",
        "team_a_score",
        "team_h_difficulty",
        "team_a_difficulty",
        "minutes",
    )


def stg_element_summary(element_summary: DataFrame) -> DataFrame:
    c = F.col
    return element_summary.select(
        c("element").alias("player_id"),
        c("fixture").alias("fixture_id"),
        "opponent_team",
        c("round").alias("gameweek"),
        "was_home",
        c("kickoff_time").cast("timestamp").alias("kickoff_time"),
        "team_h_score",
        "team_a_score",
        *MATCH_COUNTS,
        *DEFENSIVE_COUNTS,
        *_numbers(TEXT_METRICS),
        price(c("value")).alias("price"),
        "transfers_balance",
        "selected",
        "transfers_in",
        "transfers_out",
    )


# staging view -> (silver table, projection)
STAGING = {
    "stg_players": ("players", stg_players),
    "stg_teams": ("teams", stg_teams),
    "stg_fixtures": ("fixtures", stg_fixtures),
    "stg_element_summary": ("element_summary", stg_element_summary),
}
