"""One query per operator and model, over the whole stand-in tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from touchline.functions import labels, scalars
from touchline.operators import completeness, drift, fixtures as fx, keyed, rolling, transforms
from touchline.plans import marts, staging
from touchline.sources import bronze
from touchline.sources.standins import AS_OF, EVENT_FIELDS, League

TOP_MINUTES = 700
RUN = "2001-01-01T00:00:00Z"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

EVENT_SCHEMA = [
    T.StructField("event_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
]
MATCH_SCHEMA = [
    T.StructField("id", T.LongType()),
    T.StructField(
        "overrides",
        T.StructType(
            [
                T.StructField("pick_multiplier", T.LongType()),
                T.StructField("rules", T.StringType()),
                T.StructField("scoring", T.StringType()),
                T.StructField("element_types", T.StringType()),
            ]
        ),
    ),
]
ID_SCHEMA = [T.StructField("id", T.LongType())]
FIXTURE_SCHEMA = [
    T.StructField("id", T.LongType()),
    T.StructField("event", T.LongType()),
    T.StructField("finished", T.BooleanType()),
]
HISTORY_SCHEMA = [T.StructField("fixture", T.LongType()), T.StructField("round", T.LongType())]


def query(build: Callable[[League], DataFrame]) -> Callable[[League], DataFrame]:
    """Register ``build`` under its name, as a function of session and data directory."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _plain(build(League(spark, sf_dir)))

    QUERIES[build.__name__] = run
    return build


def _plain(df: DataFrame) -> DataFrame:
    """Timestamps without zone, in UTC, so that results do not depend on the session's zone."""
    instants = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({n: scalars.utc_wall_clock(F.col(n)) for n in instants}) if instants else df


# --- staging and marts -------------------------------------------------------------------------


@query
def stg_players(g):
    return g.players


@query
def stg_teams(g):
    return g.teams


@query
def stg_fixtures(g):
    return g.fixtures


@query
def stg_element_summary(g):
    return g.appearances


@query
def fct_player_gameweek(g):
    return marts.fct_player_gameweek(g.appearances, g.players, g.teams)


@query
def fct_player_season_stats(g):
    stats = marts.fct_player_season_stats(g.appearances, g.players, g.teams)
    return marts.in_order("fct_player_season_stats", stats)


@query
def fct_player_form(g):
    return marts.in_order("fct_player_form", marts.fct_player_form(g.appearances, g.players, g.teams))


def _schedule(g):
    return marts.fct_fixture_schedule(g.fixtures, g.teams, AS_OF)


@query
def fct_fixture_schedule(g):
    return marts.in_order("fct_fixture_schedule", _schedule(g))


@query
def fct_captain_picks(g):
    return marts.fct_captain_picks(g.players, marts.recent_form(g.appearances), _schedule(g))


@query
def fct_differentials(g):
    return marts.in_order("fct_differentials", marts.fct_differentials(g.players, g.teams))


@query
def fct_transfer_trends(g):
    return marts.in_order("fct_transfer_trends", marts.fct_transfer_trends(g.players, g.teams))


@query
def fct_top_players(g):
    top = marts.fct_top_players(g.players, g.fixtures, AS_OF, min_minutes=TOP_MINUTES)
    return marts.in_order("fct_top_players", top)


# --- scalar expressions ------------------------------------------------------------------------


@query
def safe_divide(g):
    divisor, total = F.col("o_orderkey") % 5, F.col("o_totalprice")
    return g.orders.select(
        "o_orderkey",
        scalars.safe_divide(total, divisor).alias("quotient"),
        scalars.safe_divide(total, F.nullif(divisor, F.lit(0))).alias("quotient_of_nullif"),
    )


@query
def round_half_away(g):
    charge = F.col("l_extendedprice") * F.col("l_discount")
    return g.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        scalars.round_half_away(charge, 2).alias("two_digits"),
        scalars.round_half_away(-charge, 1).alias("one_digit_negative"),
    )


@query
def price_scale(g):
    return g.part.select("p_partkey", scalars.price(F.col("p_size")).alias("price"))


@query
def code_labels(g):
    code = F.col("l_linenumber")
    return (
        g.lineitem.groupBy("l_linenumber")
        .agg(F.count(F.lit(1)).alias("lines"))
        .select(
            "l_linenumber",
            labels.position(code).alias("position"),
            labels.difficulty(code).alias("difficulty"),
            "lines",
        )
    )


@query
def string_metrics(g):
    return g.appearances.select("player_id", "fixture_id", *staging.TEXT_METRICS)


@query
def value_metrics(g):
    c = F.col
    return g.players.select(
        "player_id",
        "points_per_million",
        "points_per_90",
        scalars.per_90(c("expected_goal_involvements"), c("minutes")).alias("xgi_per_90"),
        marts.differential_score(c("total_points"), c("selected_by_percent")).alias(
            "differential_score"
        ),
    )


@query
def net_transfers(g):
    c = F.col
    return g.raw_players.select(
        c("id").alias("player_id"),
        (c("transfers_in_event") - c("transfers_out_event")).alias("net_transfers_event"),
        (c("transfers_in") - c("transfers_out")).alias("net_transfers_season"),
    )


@query
def transfer_momentum(g):
    momentum = labels.transfer_momentum(F.col("transfers_in_event"), F.col("transfers_out_event"))
    return g.raw_players.select(F.col("id").alias("player_id"), momentum.alias("momentum"))


@query
def captain_score(g):
    c = F.col
    level = F.nullif(c("gameweek") % 6, F.lit(0))
    return g.appearances.select(
        "player_id",
        "fixture_id",
        marts.captain_score(
            c("total_points").cast("double"),
            F.nullif(c("expected_goal_involvements"), F.lit(0.0)),
            marts.fixture_bonus(level),
            c("ict_index"),
        ).alias("captain_score"),
    )


# --- filters, set operations, windows ----------------------------------------------------------


def _coming(g):
    return fx.upcoming(g.fixtures, AS_OF)


@query
def upcoming_fixtures(g):
    return _coming(g).select("fixture_id", "gameweek", "kickoff_time")


@query
def fixture_long(g):
    return fx.by_team(g.fixtures)


@query
def next_gameweek(g):
    return fx.in_next_gameweek(fx.by_team(_coming(g)))


@query
def next_fixture_per_team(g):
    return fx.next_per_team(fx.by_team(_coming(g)))


@query
def latest_per_key(g):
    newest_first = [F.col(c).desc() for c in ("gameweek", "kickoff_time", "fixture_id")]
    rows = g.appearances.select(
        "player_id", "gameweek", "kickoff_time", "fixture_id", "total_points", "minutes"
    )
    return keyed.first_per_key(rows, ["player_id"], newest_first)


@query
def rolling_form(g):
    rows = g.appearances.select(
        "player_id",
        "gameweek",
        "kickoff_time",
        "fixture_id",
        "total_points",
        "minutes",
        "expected_goal_involvements",
        "ict_index",
    )
    xgi, ict = F.col("expected_goal_involvements"), F.col("ict_index")
    stats = {
        "points_last_5_gw": lambda w: F.sum("total_points").over(w),
        "avg_points_last_5_gw": lambda w: scalars.round_half_away(F.avg("total_points").over(w), 2),
        "xgi_last_5_gw": lambda w: scalars.round_half_away(scalars.exact_sum(xgi, w), 2),
        "minutes_last_5_gw": lambda w: F.sum("minutes").over(w),
        "gw_count_in_window": lambda w: F.count(F.lit(1)).over(w),
        "avg_ict_last_5_gw": lambda w: scalars.round_half_away(scalars.exact_avg(ict, w), 2),
    }
    rolled = rolling.rolling_rows(
        rows,
        ["player_id"],
        ["gameweek", "kickoff_time", "fixture_id"],
        marts.FORM_ROWS,
        stats,
    )
    return rolled.select("player_id", "gameweek", "fixture_id", *stats)


# --- joins and aggregates ----------------------------------------------------------------------


@query
def role_playing_dim(g):
    """Points by own and opposing team. Reduced per player, then per team pair, then named twice."""
    per_player = g.appearances.groupBy("player_id", "opponent_team").agg(
        F.count(F.lit(1)).alias("n"), F.sum("total_points").alias("points")
    )
    pairs = (
        per_player.join(g.players.select("player_id", "team"), "player_id", "left")
        .groupBy("team", "opponent_team")
        .agg(F.sum("n").alias("appearances"), F.sum("points").alias("total_points"))
    )
    named = marts.with_team(pairs, g.teams, "team", "team")
    return marts.with_team(named, g.teams, "opponent_team", "opponent").select(
        "team_name",
        "team_short_name",
        "opponent_name",
        "opponent_short_name",
        "appearances",
        "total_points",
    )


@query
def captain_fanout(g):
    """How many rows the next gameweek gives each player; fixtures are counted per team first."""
    games = (
        fx.in_next_gameweek(fx.by_team(_coming(g)))
        .groupBy(F.col("team_id").alias("team"))
        .agg(F.count(F.lit(1)).alias("games"))
    )
    return g.players.select("player_id", "team").join(games, "team", "left").select(
        "player_id", F.coalesce("games", F.lit(0)).alias("games")
    )


@query
def conditional_count(g):
    return marts.season_totals(g.appearances).select(
        "player_id", "gameweeks_played", "gameweeks_with_minutes"
    )


@query
def ratio_of_sums(g):
    return marts.season_totals(g.appearances).select(
        "player_id",
        *[
            scalars.per_90(F.col(total), F.col("total_minutes")).alias(name)
            for name, total in marts.SEASON_RATES.items()
        ],
    )


@query
def composite_rank(g):
    ranked = marts.fct_top_players(g.players, g.fixtures, AS_OF, min_minutes=0)
    ranked = ranked.withColumn("composite", marts.composite_value())
    return marts.in_order("fct_top_players", ranked).select("web_name", "composite")


@query
def top_k(g):
    best = g.orders.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(marts.CAPTAIN_PICKS)
    return best.select("o_orderkey", "o_custkey", "o_totalprice")


# --- bronze and drift --------------------------------------------------------------------------


@query
def bootstrap_split(g):
    rows = drift.conform(bronze.tagged_records(g.bootstrap_documents), ID_SCHEMA)
    return rows.select(F.col("table").alias("silver_table"), "id")


@query
def array_documents(g):
    return drift.conform(bronze.array_records(g.fixture_documents), FIXTURE_SCHEMA)


@query
def explode_history(g):
    rows = bronze.history_records(g.summary_documents, player_id="element_id")
    return drift.conform(rows, HISTORY_SCHEMA)


def _drifting(g):
    return drift.with_drift(g.event_records, EVENT_FIELDS)


def _drift_text(kind):
    return F.array_join(F.col(f"drift.{kind}"), ",").alias(kind)


@query
def drift_split(g):
    return drift.conform(_drifting(g), EVENT_SCHEMA).select(
        "event_id", "user_id", "event_type", _drift_text("new_fields"), _drift_text("missing_fields")
    )


@query
def drift_clean(g):
    return drift.conform(g.event_records, EVENT_SCHEMA)


@query
def drift_summary(g):
    return drift.drift_counts(_drifting(g))


@query
def drift_descriptor(g):
    """Records with one or two new names that may also lack two of the known ones."""
    return drift.drift_counts(drift.with_drift(g.mixed_records, EVENT_FIELDS))


@query
def dead_letter_descriptor(g):
    drifting = drift.with_drift(g.mixed_records, EVENT_FIELDS).where("drift is not null")
    names = [_drift_text(kind) for kind in ("new_fields", "missing_fields")]
    return drifting.select(*names).groupBy("new_fields", "missing_fields").agg(F.count(F.lit(1)).alias("records"))


@query
def dlq_payload(g):
    return drift.quarantine_payload(_drifting(g), "events", RUN, F.lit(RUN)).select(
        "raw_record",
        _drift_text("new_fields"),
        _drift_text("missing_fields"),
        F.col("table").alias("silver_table"),
        "run_timestamp",
        "detected_at",
    )


@query
def json_stringify(g):
    rows = drift.conform(g.override_records, MATCH_SCHEMA, transforms.rewrites_for("matches"))
    return rows.select("id", F.col("overrides").isNotNull().alias("has_overrides"), "overrides.*")


@query
def missing_snapshots(g):
    expected = g.orders.select(F.col("o_orderkey").alias("element_id"), "o_custkey")
    landed = g.lineitem.select(F.col("l_orderkey").alias("element_id"))
    return completeness.missing_snapshots(expected, landed, ["element_id"])
