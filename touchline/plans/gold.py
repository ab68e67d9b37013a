"""Silver -> staging views -> gold tables, in dependency order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from touchline.functions.scalars import register_sql
from touchline.plans import marts
from touchline.plans.staging import STAGING
from touchline.sources import tables

MARTS = (
    "fct_player_gameweek",
    "fct_player_season_stats",
    "fct_player_form",
    "fct_fixture_schedule",
    "fct_captain_picks",
    "fct_differentials",
    "fct_transfer_trends",
    "fct_top_players",
)


def register_staging(spark: SparkSession, silver_db: str = "silver") -> dict[str, DataFrame]:
    """Staging as temporary views, so that SQL users and the marts read the same definitions.

    SQL users also get ``safe_divide``.
    """
    staged = {
        view: project(spark.table(f"`{silver_db}`.`{table}`"))
        for view, (table, project) in STAGING.items()
    }
    for view, df in staged.items():
        df.createOrReplaceTempView(view)
    register_sql(spark)
    return staged


def build_gold(
    spark: SparkSession, *, silver_db: str = "silver", gold_db: str = "gold", as_of=None
) -> None:
    """Rebuild every mart table. Captain picks read the stored form and schedule."""
    s = register_staging(spark, silver_db)
    players, teams = s["stg_players"], s["stg_teams"]
    fixtures, appearances = s["stg_fixtures"], s["stg_element_summary"]

    def stored(name):
        return spark.table(f"`{gold_db}`.`{name}`")

    builders = {
        "fct_player_gameweek": lambda: marts.fct_player_gameweek(appearances, players, teams),
        "fct_player_season_stats": lambda: marts.fct_player_season_stats(appearances, players, teams),
        "fct_player_form": lambda: marts.fct_player_form(appearances, players, teams),
        "fct_fixture_schedule": lambda: marts.fct_fixture_schedule(fixtures, teams, as_of),
        "fct_captain_picks": lambda: marts.fct_captain_picks(
            players, stored("fct_player_form"), stored("fct_fixture_schedule")
        ),
        "fct_differentials": lambda: marts.fct_differentials(players, teams),
        "fct_transfer_trends": lambda: marts.fct_transfer_trends(players, teams),
        "fct_top_players": lambda: marts.fct_top_players(players, fixtures, as_of),
    }
    for name in MARTS:
        tables.replace(spark, builders[name](), gold_db, name)
