"""Fixture-list operators on staged fixtures."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from touchline.functions.labels import AWAY, HOME
from touchline.operators.keyed import first_per_key


def cutoff(as_of: Column | datetime | str | None) -> Column:
    """The instant after which a kickoff counts as upcoming: now, unless given."""
    if as_of is None:
        return F.current_timestamp()
    return (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast("timestamp")


def upcoming(fixtures: DataFrame, as_of: Column | datetime | str | None = None) -> DataFrame:
    """Unfinished fixtures that kick off after ``as_of``. NULL ``finished`` or kickoff drops the row."""
    return fixtures.where(~F.col("finished") & (F.col("kickoff_time") > cutoff(as_of)))


def by_team(fixtures: DataFrame) -> DataFrame:
    """One row per fixture and side. Both sides come from one scan instead of a union of two."""
    def side(team, opponent, level, venue):
        return F.struct(
            F.col(team).alias("team_id"),
            F.col(opponent).alias("opponent_id"),
            F.col(level).alias("difficulty"),
            F.lit(venue).alias("venue"),
        )

    sides = F.array(
        side("team_h", "team_a", "team_h_difficulty", HOME),
        side("team_a", "team_h", "team_a_difficulty", AWAY),
    )
    return fixtures.select("gameweek", "fixture_id", "kickoff_time", F.inline(sides))


def in_next_gameweek(schedule: DataFrame) -> DataFrame:
    """Rows of the lowest gameweek. The minimum is a scalar subquery, so it reaches the scan."""
    return schedule.where(F.col("gameweek") == schedule.agg(F.min("gameweek")).scalar())


def next_per_team(team_fixtures: DataFrame) -> DataFrame:
    """The earliest fixture of each team; equal kickoffs fall back to fixture id and side."""
    return first_per_key(
        team_fixtures, ["team_id"], [F.col("kickoff_time"), F.col("fixture_id"), F.col("venue").desc()]
    )
