"""League-shaped silver tables derived from a generic star schema.

Customers play the players, orders their appearances (and the fixtures), nations the teams. Every
column is a function of whole tables, so the work grows with them.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from touchline.plans import staging

AS_OF = "2001-01-01T00:00:00Z"

WEEK = "1 + floor(date_diff(o_orderdate, date '1995-01-01') / 7)"
# Order date at a whole hour, as ISO text in UTC.
KICKOFF = (
    "concat(date_format(o_orderdate, 'yyyy-MM-dd'), 'T', "
    "lpad(cast(o_orderkey % 24 AS string), 2, '0'), ':00:00Z')"
)


def _text(units: str, digits: int) -> str:
    """A non-negative whole number of 1/10**digits as decimal text."""
    whole, rest = f"cast(({units}) div {10**digits} AS string)", f"cast(({units}) % {10**digits} AS string)"
    return f"concat({whole}, '.', lpad({rest}, {digits}, '0'))"


def _flag(condition: str) -> str:
    return f"CAST(CASE WHEN {condition} THEN 1 ELSE 0 END AS bigint)"


def _n(column: str) -> str:
    return f"coalesce({column}, 0L)"


LINE_TOTALS = {
    "lines": "count(1)",
    "quantity": "sum(cast(l_quantity AS bigint))",
    "returned": "count_if(l_returnflag = 'R')",
    "accepted": "count_if(l_returnflag = 'A')",
    "neither": "count_if(l_returnflag = 'N')",
    "open": "count_if(l_linestatus = 'O')",
    "filled": "count_if(l_linestatus = 'F')",
    "leading": "count_if(l_linenumber <= 2)",
    "fifth": "count_if(l_linenumber = 5)",
    "sixth": "count_if(l_linenumber = 6)",
    "seventh": "count_if(l_linenumber = 7)",
    "numbers": "sum(cast(l_linenumber AS bigint))",
    "part_5": "sum(l_partkey % 5)",
    "part_3": "sum(l_partkey % 3)",
    "supp_7": "sum(l_suppkey % 7)",
    "supp_4": "sum(l_suppkey % 4)",
    "discount_cents": "sum(cast(rint(l_discount * 100) AS bigint))",
    "tax_cents": "sum(cast(rint(l_tax * 100) AS bigint))",
}

# Metrics as whole numbers of 1/10**digits; the silver table holds them as text.
METRICS = {
    "expected_goals": (_n("tax_cents"), 2),
    "expected_assists": (f"{_n('accepted')} * 25", 2),
    "expected_goal_involvements": (_n("discount_cents"), 2),
    "expected_goals_conceded": (f"{_n('neither')} * 50", 2),
    "influence": (_n("quantity"), 1),
    "creativity": (f"{_n('part_5')} * 15", 1),
    "threat": (f"{_n('returned')} * 70", 1),
    "ict_index": (f"{_n('quantity')} % 100", 1),
}
METRIC_TEXTS = {n: _text(n, digits) for n, (_, digits) in METRICS.items()}

APPEARANCES = {
    "element": "o_custkey",
    "fixture": "o_orderkey",
    "opponent_team": "o_orderkey % 25",
    "round": WEEK,
    "was_home": "o_orderkey % 2 = 0",
    "kickoff_time": KICKOFF,
    "team_h_score": "o_orderkey % 4",
    "team_a_score": "o_custkey % 3",
    "minutes": f"least(90L, {_n('quantity')})",
    "starts": _flag("quantity >= 60"),
    "total_points": _n("lines"),
    "goals_scored": _n("returned"),
    "assists": _n("accepted"),
    "clean_sheets": _flag(f"{_n('returned')} = 0"),
    "goals_conceded": _n("neither"),
    "own_goals": _n("seventh"),
    "yellow_cards": _n("open"),
    "red_cards": _flag("lines > 8"),
    "saves": _n("filled"),
    "bonus": _n("leading"),
    "bps": _n("numbers"),
    "penalties_saved": _n("sixth"),
    "penalties_missed": _n("fifth"),
    "clearances_blocks_interceptions": _n("part_5"),
    "recoveries": _n("supp_7"),
    "tackles": _n("part_3"),
    "defensive_contribution": _n("supp_4"),
    **{n: units for n, (units, _) in METRICS.items()},
    "value": "40 + o_custkey % 90",
    "transfers_balance": "o_custkey * 7 % 300 - 150",
    "selected": "o_custkey * 11 % 1000",
    "transfers_in": "o_orderkey % 500",
    "transfers_out": "o_orderkey % 450",
}

PLAYER_TOTALS = {n: f"sum({n})" for n in [*staging.MATCH_COUNTS, *METRICS]}
# Moduli that spread the per-90 columns over customers.
RATE_MODULI = dict(zip(staging.RATES_PER_90, (83, 79, 73, 71, 67, 61, 59, 53, 47)))

PLAYERS = {
    "id": "c_custkey",
    "first_name": "concat('First ', cast(c_custkey % 97 AS string))",
    "second_name": "c_mktsegment",
    "web_name": "c_name",
    "team": "cast(c_nationkey AS bigint)",
    "element_type": "1 + c_custkey % 4",
    "status": "CASE WHEN c_acctbal < 0 THEN 'i' ELSE 'a' END",
    "news": "CASE WHEN c_acctbal < 0 THEN 'Overdrawn' ELSE '' END",
    "now_cost": "40 + c_custkey % 90",
    "cost_change_start": "c_custkey % 9 - 4",
    "cost_change_event": "c_custkey % 3 - 1",
    **{n: _n(n) for n in staging.MATCH_COUNTS},
    **METRIC_TEXTS,
    **{n: f"cast(c_custkey % {m} AS double) / 100.0D" for n, m in RATE_MODULI.items()},
    "form": _text("c_custkey % 100", 1),
    "selected_by_percent": _text("c_custkey % 400", 1),
    "points_per_game": _text("c_custkey % 120", 1),
    "transfers_in": "c_custkey * 17 % 9000",
    "transfers_out": "c_custkey * 23 % 8000",
    "transfers_in_event": "c_custkey * 13 % 500",
    "transfers_out_event": "c_custkey * 29 % 700",
}

TEAM_KEY = "cast(n_nationkey AS bigint)"
STRENGTH_FACTORS = dict(zip(staging.TEAM_STRENGTHS[1:], (37, 41, 43, 47, 53, 59)))
TEAMS = {
    "id": TEAM_KEY,
    "name": "n_name",
    "short_name": "concat('N', cast(n_nationkey AS string))",
    "code": f"{TEAM_KEY} * 3",
    "position": f"{TEAM_KEY} + 1",
    "played": f"{TEAM_KEY} % 38",
    "win": f"{TEAM_KEY} % 7",
    "draw": f"{TEAM_KEY} % 5",
    "loss": f"{TEAM_KEY} % 3",
    "points": f"{TEAM_KEY} % 7 * 3 + {TEAM_KEY} % 5",
    "strength": f"{TEAM_KEY} % 5 + 1",
    **{n: f"1000 + {TEAM_KEY} * {factor} % 300" for n, factor in STRENGTH_FACTORS.items()},
    "form": f"CASE WHEN n_nationkey % 2 = 0 THEN {_text('n_nationkey', 1)} END",
    "unavailable": "n_nationkey % 11 = 0",
}

FIXTURES = {
    "id": "o_orderkey",
    "code": "o_orderkey * 7",
    "event": WEEK,
    "kickoff_time": KICKOFF,
    "started": "o_orderstatus <> 'O'",
    "finished": "o_orderstatus = 'F'",
    "finished_provisional": "o_orderstatus = 'F'",
    "team_h": "o_orderkey % 25",
    "team_a": "(o_orderkey % 25 + 1 + o_custkey % 24) % 25",
    "team_h_score": "CASE WHEN o_orderstatus = 'F' THEN o_orderkey % 4 END",
    "team_a_score": "CASE WHEN o_orderstatus = 'F' THEN o_custkey % 3 END",
    "team_h_difficulty": "cast(substring(o_orderpriority, 1, 1) AS bigint)",
    "team_a_difficulty": "6 - cast(substring(o_orderpriority, 1, 1) AS bigint)",
    "minutes": "CASE WHEN o_orderstatus = 'F' THEN 90L ELSE 0L END",
}

# A record per event. Errors carry ``k``, a field the schema does not know; views lack ``user_id``,
# which it does.
EVENT_FIELDS = ("event_id", "user_id", "event_type")
EVENT_RECORD = """
    to_json(struct(
        event_id,
        CASE WHEN event_type <> 'view' THEN user_id END AS user_id,
        event_type,
        CASE WHEN event_type = 'error' THEN cast(get_json_object(props, '$.k') AS bigint) END AS k
    ))"""

# Events of which some have one or two names outside the schema, and some lack one or two of its names.
MIXED_RECORD = """
    to_json(struct(
        event_id,
        CASE WHEN event_id % 3 > 0 THEN user_id END AS user_id,
        CASE WHEN event_id % 7 > 0 THEN event_type END AS event_type,
        CASE WHEN event_type = 'error' THEN 1 END AS k,
        CASE WHEN event_id % 5 = 0 THEN 'x' END AS session
    ))"""

# A gameweek record per event, whose ``overrides`` is absent, empty, partial or complete.
OVERRIDE_RECORD = """
    concat('{"id": ', cast(event_id AS string), CASE event_type
        WHEN 'click' THEN ', "overrides": null'
        WHEN 'view' THEN ', "overrides": {}'
        WHEN 'error' THEN concat(', "overrides": {"scoring": ', props, ', "extra": 1}')
        WHEN 'purchase' THEN concat(
            ', "overrides": {"pick_multiplier": ', cast(event_id % 5 AS string),
            ', "rules": {}, "scoring": ', props, ', "element_types": [1, 2]}')
        ELSE '' END, '}')"""

# A player document per order with a history of two rows; pending orders have no history.
SUMMARY_DOCUMENT = f"""
    to_json(struct(
        CASE WHEN o_orderstatus <> 'P' THEN array(
            struct(o_orderkey AS fixture, {WEEK} AS round),
            struct(o_orderkey + 1 AS fixture, {WEEK} + 1 AS round)
        ) END AS history,
        o_custkey AS element_id
    ))"""

# A bootstrap document per customer: two players, a team, a position, and a gameweek unless overdrawn.
BOOTSTRAP_DOCUMENT = """
    to_json(struct(
        array(struct(c_custkey AS id), struct(c_custkey + 1 AS id)) AS elements,
        array(struct(c_nationkey AS id)) AS teams,
        filter(array(struct(c_custkey * 2 AS id)), e -> c_acctbal >= 0) AS events,
        array(struct(1 + c_custkey % 4 AS id)) AS element_types
    ))"""

# A fixture document per order: a top-level array of one or two fixtures.
FIXTURE_DOCUMENT = f"""
    to_json(filter(
        array(
            struct(o_orderkey AS id, {WEEK} AS event, o_orderstatus = 'F' AS finished),
            struct(-o_orderkey AS id, {WEEK} AS event, CAST(NULL AS boolean) AS finished)
        ),
        f -> f.id >= 0 OR o_orderstatus = 'O'
    ))"""


def _select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{sql} AS {name}" for name, sql in columns.items()])


def _group(df: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    return df.groupBy(key).agg(*[F.expr(sql).alias(name) for name, sql in columns.items()])


class League:
    """The stand-in tables over one data directory: raw (silver-shaped) and staged."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def orders(self):
        return self._read("orders")

    @cached_property
    def lineitem(self):
        return self._read("lineitem")

    @cached_property
    def customer(self):
        return self._read("customer")

    @cached_property
    def part(self):
        return self._read("part")

    @cached_property
    def events(self):
        return self._read("events")

    @cached_property
    def _appearances(self):
        """Orders with their line items reduced to one row per order."""
        lines = _group(self.lineitem, "l_orderkey", LINE_TOTALS)
        joined = self.orders.join(lines, self.orders["o_orderkey"] == lines["l_orderkey"], "left")
        return _select(joined, APPEARANCES)

    @cached_property
    def raw_element_summary(self):
        return self._appearances.withColumns({n: F.expr(t) for n, t in METRIC_TEXTS.items()})

    @cached_property
    def raw_players(self):
        """Customers with their season totals, reduced to one row per player before the join."""
        totals = _group(self._appearances, "element", PLAYER_TOTALS)
        joined = self.customer.join(totals, self.customer["c_custkey"] == totals["element"], "left")
        return _select(joined, PLAYERS)

    @cached_property
    def raw_teams(self):
        return _select(self._read("nation"), TEAMS)

    @cached_property
    def raw_fixtures(self):
        return _select(self.orders, FIXTURES)

    @cached_property
    def appearances(self):
        return staging.stg_element_summary(self.raw_element_summary)

    @cached_property
    def players(self):
        return staging.stg_players(self.raw_players)

    @cached_property
    def teams(self):
        return staging.stg_teams(self.raw_teams)

    @cached_property
    def fixtures(self):
        return staging.stg_fixtures(self.raw_fixtures)

    @cached_property
    def event_records(self):
        return _select(self.events, {"record": EVENT_RECORD})

    @cached_property
    def mixed_records(self):
        return _select(self.events, {"record": MIXED_RECORD})

    @cached_property
    def override_records(self):
        return _select(self.events, {"record": OVERRIDE_RECORD})

    @cached_property
    def bootstrap_documents(self):
        return _select(self.customer, {"value": BOOTSTRAP_DOCUMENT})

    @cached_property
    def fixture_documents(self):
        return _select(self.orders, {"value": FIXTURE_DOCUMENT})

    @cached_property
    def summary_documents(self):
        return _select(self.orders, {"value": SUMMARY_DOCUMENT})
