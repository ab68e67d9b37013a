"""Independent SQL for every query, written for DuckDB over the same parquet tables."""

from __future__ import annotations

AS_OF = "timestamp '2001-01-01 00:00:00'"


def half(x: str, digits: int = 2) -> str:
    """Round half away from zero on the double ``x``."""
    scale = f"{10**digits}.0::DOUBLE"
    return (
        f"(CASE WHEN ({x}) < 0 THEN -1 ELSE 1 END"
        f" * floor(abs(({x})::DOUBLE) * {scale} + 0.5::DOUBLE)::BIGINT / {scale})"
    )


def div(a: str, b: str) -> str:
    return f"(({a})::DOUBLE / nullif(({b})::DOUBLE, 0))"


def per_90(a: str, minutes: str) -> str:
    return half(f"{div(a, minutes)} * 90")


def esum(x: str) -> str:
    """Exact sum of a metric, to more decimals than the metrics have."""
    return f"sum(({x})::DECIMAL(38,12))::DOUBLE"


def label(code: str, names: list[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names, 1))
    return f"CASE {code} {whens} END"


POSITIONS = ["Goalkeeper", "Defender", "Midfielder", "Forward"]
LEVELS = ["Very Easy", "Easy", "Medium", "Hard", "Very Hard"]

WEEK = "(1 + date_diff('day', timestamp '1995-01-01', o_orderdate) // 7)"
KICKOFF = "(date_trunc('day', o_orderdate) + to_hours((o_orderkey % 24)::INTEGER))::TIMESTAMP"


def momentum(i: str, o: str) -> str:
    return (
        f"CASE WHEN {i} > 2 * {o} THEN 'Strong Buy' WHEN {i} > {o} THEN 'Buy' "
        f"WHEN {o} > 2 * {i} THEN 'Strong Sell' WHEN {o} > {i} THEN 'Sell' ELSE 'Neutral' END"
    )


# Building blocks, each a common table expression; later ones may use earlier ones.
BLOCKS = {
    "lines": """
        SELECT l_orderkey,
               count(*) AS lines,
               sum(l_quantity)::BIGINT AS quantity,
               count(*) FILTER (l_returnflag = 'R') AS returned,
               count(*) FILTER (l_returnflag = 'A') AS accepted,
               count(*) FILTER (l_returnflag = 'N') AS neither,
               count(*) FILTER (l_linestatus = 'O') AS open_lines,
               count(*) FILTER (l_linestatus = 'F') AS filled,
               count(*) FILTER (l_linenumber <= 2) AS leading_lines,
               count(*) FILTER (l_linenumber = 5) AS fifth,
               count(*) FILTER (l_linenumber = 6) AS sixth,
               count(*) FILTER (l_linenumber = 7) AS seventh,
               sum(l_linenumber)::BIGINT AS numbers,
               sum(l_partkey % 5)::BIGINT AS part_5,
               sum(l_partkey % 3)::BIGINT AS part_3,
               sum(l_suppkey % 7)::BIGINT AS supp_7,
               sum(l_suppkey % 4)::BIGINT AS supp_4,
               sum(l_discount::DECIMAL(18,2))::DOUBLE AS discount,
               sum(l_tax::DECIMAL(18,2))::DOUBLE AS tax
        FROM lineitem GROUP BY l_orderkey""",
    "app": f"""
        SELECT o_custkey AS player_id, o_orderkey AS fixture_id,
               o_orderkey % 25 AS opponent_team, {WEEK} AS gameweek,
               o_orderkey % 2 = 0 AS was_home, {KICKOFF} AS kickoff_time,
               o_orderkey % 4 AS team_h_score, o_custkey % 3 AS team_a_score,
               least(90, coalesce(quantity, 0))::BIGINT AS minutes,
               (coalesce(quantity, 0) >= 60)::BIGINT AS starts,
               coalesce(lines, 0) AS total_points,
               coalesce(returned, 0) AS goals_scored,
               coalesce(accepted, 0) AS assists,
               (coalesce(returned, 0) = 0)::BIGINT AS clean_sheets,
               coalesce(neither, 0) AS goals_conceded,
               coalesce(seventh, 0) AS own_goals,
               coalesce(open_lines, 0) AS yellow_cards,
               (coalesce(lines, 0) > 8)::BIGINT AS red_cards,
               coalesce(filled, 0) AS saves,
               coalesce(leading_lines, 0) AS bonus,
               coalesce(numbers, 0) AS bps,
               coalesce(sixth, 0) AS penalties_saved,
               coalesce(fifth, 0) AS penalties_missed,
               coalesce(part_5, 0) AS clearances_blocks_interceptions,
               coalesce(supp_7, 0) AS recoveries,
               coalesce(part_3, 0) AS tackles,
               coalesce(supp_4, 0) AS defensive_contribution,
               coalesce(tax, 0) AS expected_goals,
               coalesce(accepted, 0) * 0.25::DOUBLE AS expected_assists,
               coalesce(discount, 0) AS expected_goal_involvements,
               coalesce(neither, 0) * 0.5::DOUBLE AS expected_goals_conceded,
               coalesce(quantity, 0) / 10.0::DOUBLE AS influence,
               coalesce(part_5, 0) * 15 / 10.0::DOUBLE AS creativity,
               coalesce(returned, 0) * 70 / 10.0::DOUBLE AS threat,
               coalesce(quantity, 0) % 100 / 10.0::DOUBLE AS ict_index,
               {half('(40 + o_custkey % 90) / 10.0::DOUBLE', 1)} AS price,
               o_custkey * 7 % 300 - 150 AS transfers_balance,
               o_custkey * 11 % 1000 AS selected,
               o_orderkey % 500 AS transfers_in,
               o_orderkey % 450 AS transfers_out
        FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey""",
    "totals": """
        SELECT player_id AS pid, sum(minutes)::BIGINT AS minutes, sum(starts)::BIGINT AS starts,
               sum(total_points)::BIGINT AS total_points, sum(goals_scored)::BIGINT AS goals_scored,
               sum(assists)::BIGINT AS assists, sum(clean_sheets)::BIGINT AS clean_sheets,
               sum(goals_conceded)::BIGINT AS goals_conceded, sum(own_goals)::BIGINT AS own_goals,
               sum(yellow_cards)::BIGINT AS yellow_cards, sum(red_cards)::BIGINT AS red_cards,
               sum(saves)::BIGINT AS saves, sum(bonus)::BIGINT AS bonus, sum(bps)::BIGINT AS bps,
               sum(penalties_saved)::BIGINT AS penalties_saved,
               sum(penalties_missed)::BIGINT AS penalties_missed,
               sum(expected_goals::DECIMAL(18,2))::DOUBLE AS expected_goals,
               sum(expected_assists::DECIMAL(18,2))::DOUBLE AS expected_assists,
               sum(expected_goal_involvements::DECIMAL(18,2))::DOUBLE AS expected_goal_involvements,
               sum(expected_goals_conceded::DECIMAL(18,2))::DOUBLE AS expected_goals_conceded,
               sum(influence::DECIMAL(18,1))::DOUBLE AS influence,
               sum(creativity::DECIMAL(18,1))::DOUBLE AS creativity,
               sum(threat::DECIMAL(18,1))::DOUBLE AS threat,
               sum(ict_index::DECIMAL(18,1))::DOUBLE AS ict_index
        FROM app GROUP BY player_id""",
    "pl": f"""
        SELECT c_custkey AS player_id, 'First ' || (c_custkey % 97) AS first_name,
               c_mktsegment AS second_name, c_name AS web_name, c_nationkey::BIGINT AS team,
               1 + c_custkey % 4 AS position_id,
               {label('1 + c_custkey % 4', POSITIONS)} AS position,
               CASE WHEN c_acctbal < 0 THEN 'i' ELSE 'a' END AS status,
               CASE WHEN c_acctbal < 0 THEN 'Overdrawn' ELSE '' END AS news,
               {half('(40 + c_custkey % 90) / 10.0::DOUBLE', 1)} AS price,
               c_custkey % 9 - 4 AS cost_change_start, c_custkey % 3 - 1 AS cost_change_event,
               coalesce(minutes, 0) AS minutes, coalesce(starts, 0) AS starts,
               coalesce(total_points, 0) AS total_points, coalesce(goals_scored, 0) AS goals_scored,
               coalesce(assists, 0) AS assists, coalesce(clean_sheets, 0) AS clean_sheets,
               coalesce(goals_conceded, 0) AS goals_conceded, coalesce(own_goals, 0) AS own_goals,
               coalesce(yellow_cards, 0) AS yellow_cards, coalesce(red_cards, 0) AS red_cards,
               coalesce(saves, 0) AS saves, coalesce(bonus, 0) AS bonus, coalesce(bps, 0) AS bps,
               coalesce(penalties_saved, 0) AS penalties_saved,
               coalesce(penalties_missed, 0) AS penalties_missed,
               expected_goals, expected_assists, expected_goal_involvements, expected_goals_conceded,
               (c_custkey % 83) / 100.0::DOUBLE AS expected_goals_per_90,
               (c_custkey % 79) / 100.0::DOUBLE AS expected_assists_per_90,
               (c_custkey % 73) / 100.0::DOUBLE AS expected_goal_involvements_per_90,
               (c_custkey % 71) / 100.0::DOUBLE AS expected_goals_conceded_per_90,
               (c_custkey % 67) / 100.0::DOUBLE AS saves_per_90,
               (c_custkey % 61) / 100.0::DOUBLE AS goals_conceded_per_90,
               (c_custkey % 59) / 100.0::DOUBLE AS starts_per_90,
               (c_custkey % 53) / 100.0::DOUBLE AS clean_sheets_per_90,
               (c_custkey % 47) / 100.0::DOUBLE AS defensive_contribution_per_90,
               influence, creativity, threat, ict_index,
               (c_custkey % 100) / 10.0::DOUBLE AS form,
               (c_custkey % 400) / 10.0::DOUBLE AS selected_by_percent,
               (c_custkey % 120) / 10.0::DOUBLE AS points_per_game,
               c_custkey * 17 % 9000 AS transfers_in, c_custkey * 23 % 8000 AS transfers_out,
               c_custkey * 13 % 500 AS transfers_in_event, c_custkey * 29 % 700 AS transfers_out_event,
               {half(div('coalesce(total_points, 0)', '(40 + c_custkey % 90) / 10.0::DOUBLE'))}
                   AS points_per_million,
               {per_90('coalesce(total_points, 0)', 'coalesce(minutes, 0)')} AS points_per_90
        FROM customer LEFT JOIN totals ON c_custkey = pid""",
    "te": """
        SELECT n_nationkey::BIGINT AS team_id, n_name AS name, 'N' || n_nationkey AS short_name,
               n_nationkey::BIGINT * 3 AS code, n_nationkey::BIGINT + 1 AS league_position,
               n_nationkey::BIGINT % 38 AS played, n_nationkey::BIGINT % 7 AS win,
               n_nationkey::BIGINT % 5 AS draw, n_nationkey::BIGINT % 3 AS loss,
               n_nationkey::BIGINT % 7 * 3 + n_nationkey::BIGINT % 5 AS league_points,
               n_nationkey::BIGINT % 5 + 1 AS strength,
               1000 + n_nationkey::BIGINT * 37 % 300 AS strength_overall_home,
               1000 + n_nationkey::BIGINT * 41 % 300 AS strength_overall_away,
               1000 + n_nationkey::BIGINT * 43 % 300 AS strength_attack_home,
               1000 + n_nationkey::BIGINT * 47 % 300 AS strength_attack_away,
               1000 + n_nationkey::BIGINT * 53 % 300 AS strength_defence_home,
               1000 + n_nationkey::BIGINT * 59 % 300 AS strength_defence_away,
               CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey / 10.0::DOUBLE END AS form,
               n_nationkey % 11 = 0 AS unavailable
        FROM nation""",
    "fx": f"""
        SELECT o_orderkey AS fixture_id, o_orderkey * 7 AS code, {WEEK} AS gameweek,
               {KICKOFF} AS kickoff_time, o_orderstatus <> 'O' AS started,
               o_orderstatus = 'F' AS finished, o_orderstatus = 'F' AS finished_provisional,
               o_orderkey % 25 AS team_h, (o_orderkey % 25 + 1 + o_custkey % 24) % 25 AS team_a,
               CASE WHEN o_orderstatus = 'F' THEN o_orderkey % 4 END AS team_h_score,
               CASE WHEN o_orderstatus = 'F' THEN o_custkey % 3 END AS team_a_score,
               substr(o_orderpriority, 1, 1)::BIGINT AS team_h_difficulty,
               6 - substr(o_orderpriority, 1, 1)::BIGINT AS team_a_difficulty,
               CASE WHEN o_orderstatus = 'F' THEN 90 ELSE 0 END::BIGINT AS minutes
        FROM orders""",
    "sides": """
        SELECT gameweek, fixture_id, kickoff_time, finished, team_h AS team_id,
               team_a AS opponent_id, team_h_difficulty AS difficulty, 'Home' AS venue FROM fx
        UNION ALL
        SELECT gameweek, fixture_id, kickoff_time, finished, team_a, team_h, team_a_difficulty, 'Away'
        FROM fx""",
    "coming": f"SELECT * EXCLUDE (finished) FROM sides WHERE NOT finished AND kickoff_time > {AS_OF}",
    "nextweek": "SELECT * FROM coming WHERE gameweek = (SELECT min(gameweek) FROM coming)",
    "following": """
        SELECT * FROM coming
        QUALIFY row_number() OVER (PARTITION BY team_id
                                   ORDER BY kickoff_time, fixture_id, venue DESC) = 1""",
    "facts": """
        SELECT app.*, web_name, first_name, second_name, position, position_id,
               t.name AS team_name, t.short_name AS team_short_name,
               o.name AS opponent_name, o.short_name AS opponent_short_name
        FROM app LEFT JOIN (SELECT player_id, web_name, first_name, second_name, position,
                                   position_id, team FROM pl) p USING (player_id)
        LEFT JOIN te t ON p.team = t.team_id
        LEFT JOIN te o ON app.opponent_team = o.team_id""",
    "rolled": f"""
        SELECT player_id, gameweek, kickoff_time, fixture_id, web_name, position, team_name, price,
               total_points, ict_index,
               (sum(total_points) OVER five)::BIGINT AS points_last_5_gw,
               {half('avg(total_points) OVER five')} AS avg_points_last_5_gw,
               {half('(sum(expected_goal_involvements::DECIMAL(18,6)) OVER five)::DOUBLE')}
                   AS xgi_last_5_gw,
               (sum(minutes) OVER five)::BIGINT AS minutes_last_5_gw,
               count(*) OVER five AS gw_count_in_window,
               {half('(sum(ict_index::DECIMAL(18,6)) OVER five)::DOUBLE / count(ict_index) OVER five')}
                   AS avg_ict_last_5_gw
        FROM facts
        WINDOW five AS (PARTITION BY player_id ORDER BY gameweek, kickoff_time, fixture_id
                        ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""",
    "form": f"""
        SELECT gameweek AS latest_gameweek, player_id, web_name, position, team_name, price,
               total_points AS last_gw_points, points_last_5_gw, avg_points_last_5_gw, xgi_last_5_gw,
               minutes_last_5_gw, gw_count_in_window, {half('ict_index')} AS last_gw_ict,
               avg_ict_last_5_gw
        FROM rolled
        QUALIFY row_number() OVER (PARTITION BY player_id
                                   ORDER BY gameweek DESC, kickoff_time DESC, fixture_id DESC) = 1""",
    "schedule": f"""
        SELECT c.gameweek, c.fixture_id, c.kickoff_time, c.team_id, t.name AS team_name,
               t.short_name AS team_short_name, o.name AS opponent_name,
               o.short_name AS opponent_short_name, c.venue, c.difficulty,
               {label('c.difficulty', LEVELS)} AS difficulty_label,
               t.strength_overall_home, t.strength_overall_away,
               o.strength_defence_home, o.strength_defence_away
        FROM coming c LEFT JOIN te t ON c.team_id = t.team_id
        LEFT JOIN te o ON c.opponent_id = o.team_id""",
    "top": f"""
        SELECT first_name, second_name, web_name, team, position_id AS element_type, position,
               expected_goals, expected_assists, expected_goal_involvements, expected_goals_per_90,
               expected_assists_per_90,
               {per_90('expected_goal_involvements', 'minutes')} AS xgi_per_90,
               total_points, points_per_90, minutes, price, points_per_million,
               gameweek AS next_gameweek, kickoff_time AS next_kickoff, venue AS home_or_away,
               opponent_id AS opponent, difficulty AS fixture_difficulty,
               {label('difficulty', LEVELS)} AS fixture_difficulty_label
        FROM pl LEFT JOIN following ON pl.team = following.team_id""",
    "ev": """
        SELECT event_id, event_type, props, (props::JSON ->> '$.k')::BIGINT AS k,
               CASE WHEN event_type <> 'view' THEN user_id END AS user_id
        FROM events""",
}
NEEDS = {
    "app": ["lines"],
    "totals": ["app"],
    "pl": ["totals"],
    "sides": ["fx"],
    "coming": ["sides"],
    "nextweek": ["coming"],
    "following": ["coming"],
    "facts": ["app", "pl", "te"],
    "rolled": ["facts"],
    "form": ["rolled"],
    "schedule": ["coming", "te"],
    "top": ["pl", "following"],
}


def using(blocks: str, body: str) -> str:
    """``body`` with the blocks it names, and what those need, in front."""
    wanted: list[str] = []

    def want(name):
        for need in NEEDS.get(name, []):
            want(need)
        if name not in wanted:
            wanted.append(name)

    for name in blocks.split():
        want(name)
    ctes = ",\n".join(f"{name} AS ({BLOCKS[name].strip()})" for name in wanted)
    return f"WITH {ctes}\n{body.strip()}"


SEASON = f"""
    SELECT player_id, web_name, first_name, second_name, position, team_name, team_short_name,
           count(*) AS gameweeks_played,
           count(*) FILTER (minutes > 0) AS gameweeks_with_minutes,
           sum(starts)::BIGINT AS starts, sum(minutes)::BIGINT AS total_minutes,
           sum(total_points)::BIGINT AS total_points, sum(goals_scored)::BIGINT AS goals_scored,
           sum(assists)::BIGINT AS assists,
           (sum(goals_scored) + sum(assists))::BIGINT AS goal_involvements,
           sum(clean_sheets)::BIGINT AS clean_sheets, sum(goals_conceded)::BIGINT AS goals_conceded,
           sum(own_goals)::BIGINT AS own_goals, sum(yellow_cards)::BIGINT AS yellow_cards,
           sum(red_cards)::BIGINT AS red_cards, sum(bonus)::BIGINT AS total_bonus,
           sum(bps)::BIGINT AS total_bps, sum(saves)::BIGINT AS saves,
           sum(penalties_saved)::BIGINT AS penalties_saved,
           sum(penalties_missed)::BIGINT AS penalties_missed,
           sum(clearances_blocks_interceptions)::BIGINT AS clearances_blocks_interceptions,
           sum(recoveries)::BIGINT AS recoveries, sum(tackles)::BIGINT AS tackles,
           {half(esum('expected_goals'))} AS expected_goals,
           {half(esum('expected_assists'))} AS expected_assists,
           {half(esum('expected_goal_involvements'))} AS expected_goal_involvements,
           {half(esum('expected_goals_conceded'))} AS expected_goals_conceded,
           {per_90(esum('expected_goals'), 'sum(minutes)')} AS xg_per_90,
           {per_90(esum('expected_assists'), 'sum(minutes)')} AS xa_per_90,
           {per_90(esum('expected_goal_involvements'), 'sum(minutes)')} AS xgi_per_90,
           {per_90('sum(total_points)', 'sum(minutes)')} AS points_per_90,
           {per_90('sum(goals_scored)', 'sum(minutes)')} AS goals_per_90,
           {per_90('sum(assists)', 'sum(minutes)')} AS assists_per_90,
           {half(div(esum('price'), 'count(price)'), 1)} AS avg_price,
           max(price) AS current_price,
           {half(div('sum(total_points)', 'max(price)'))} AS points_per_million
    FROM facts GROUP BY ALL"""

SCORE = "coalesce({avg}, 0) * 0.4::DOUBLE + coalesce({xgi}, 0) * 3.0::DOUBLE + {bonus} + coalesce({form}, 0) * 0.5::DOUBLE"
BONUS = "CASE WHEN {x} <= 2 THEN 5.0::DOUBLE WHEN {x} = 3 THEN 3.0::DOUBLE ELSE 0.0::DOUBLE END"

CAPTAINS = f"""
    SELECT p.player_id, p.web_name, p.position, p.price, p.selected_by_percent, p.form,
           f.points_last_5_gw, f.avg_points_last_5_gw, f.xgi_last_5_gw, p.total_points,
           p.points_per_game, n.gameweek AS next_gameweek, n.opponent_short_name, n.venue,
           n.difficulty AS fixture_difficulty, n.difficulty_label,
           {half(SCORE.format(avg='f.avg_points_last_5_gw', xgi='f.xgi_last_5_gw',
                              bonus=BONUS.format(x='n.difficulty'), form='p.form'))} AS captain_score
    FROM pl p
    LEFT JOIN form f ON p.player_id = f.player_id
    LEFT JOIN (SELECT * FROM schedule WHERE gameweek = (SELECT min(gameweek) FROM schedule)) n
           ON p.team = n.team_id
    WHERE p.minutes > 450 AND p.status = 'a'
    ORDER BY captain_score DESC NULLS LAST, p.player_id, n.fixture_id NULLS FIRST, n.venue NULLS FIRST
    LIMIT 20"""

DRIFT_TEXT = """
    CASE WHEN event_type = 'error' THEN 'k' END AS new_fields,
    CASE WHEN event_type = 'error' THEN '' END AS missing_fields"""

ORACLES: dict[str, str] = {
    "stg_players": using("pl", "SELECT * FROM pl"),
    "stg_teams": using("te", "SELECT * FROM te"),
    "stg_fixtures": using("fx", "SELECT * FROM fx"),
    "stg_element_summary": using("app", "SELECT * FROM app"),
    "fct_player_gameweek": using(
        "facts", "SELECT * EXCLUDE (opponent_team, team_h_score, team_a_score) FROM facts"
    ),
    "fct_player_season_stats": using("facts", SEASON + " ORDER BY total_points DESC"),
    "fct_player_form": using("form", "SELECT * FROM form ORDER BY points_last_5_gw DESC NULLS LAST"),
    "fct_fixture_schedule": using(
        "schedule", "SELECT * FROM schedule ORDER BY kickoff_time NULLS FIRST, team_name NULLS FIRST"
    ),
    "fct_captain_picks": using("pl form schedule", CAPTAINS),
    "fct_differentials": using(
        "pl te",
        f"""
        SELECT player_id, web_name, first_name, second_name, position, name AS team_name,
               te.short_name AS team_short_name, price, selected_by_percent, pl.form, total_points,
               points_per_game, points_per_million, points_per_90, expected_goals, expected_assists,
               expected_goal_involvements, minutes, starts, status, news,
               {half(div('total_points', 'selected_by_percent'))} AS differential_score
        FROM pl LEFT JOIN te ON team = team_id
        WHERE selected_by_percent < 15 AND minutes > 450 AND status = 'a'
        ORDER BY differential_score DESC NULLS LAST""",
    ),
    "fct_transfer_trends": using(
        "pl te",
        f"""
        SELECT player_id, web_name, first_name, second_name, position, name AS team_name,
               te.short_name AS team_short_name, price, selected_by_percent, pl.form, total_points,
               points_per_game, status, transfers_in_event, transfers_out_event,
               transfers_in_event - transfers_out_event AS net_transfers_event,
               transfers_in, transfers_out, transfers_in - transfers_out AS net_transfers_season,
               cost_change_start, cost_change_event, points_per_million, points_per_90,
               {momentum('transfers_in_event', 'transfers_out_event')} AS transfer_momentum
        FROM pl LEFT JOIN te ON team = team_id
        WHERE minutes > 0 ORDER BY net_transfers_event DESC NULLS LAST""",
    ),
    "fct_top_players": using(
        "top",
        """SELECT * FROM top WHERE minutes > 700
           ORDER BY points_per_million + points_per_90 + xgi_per_90 DESC NULLS LAST""",
    ),
    "safe_divide": f"""
        SELECT o_orderkey, {div('o_totalprice', 'o_orderkey % 5')} AS quotient,
               o_totalprice / nullif(o_orderkey % 5, 0) AS quotient_of_nullif
        FROM orders""",
    "round_half_away": f"""
        SELECT l_orderkey, l_linenumber, l_partkey,
               {half('l_extendedprice * l_discount')} AS two_digits,
               {half('-(l_extendedprice * l_discount)', 1)} AS one_digit_negative
        FROM lineitem""",
    "price_scale": f"SELECT p_partkey, {half('p_size / 10.0::DOUBLE', 1)} AS price FROM part",
    "code_labels": f"""
        SELECT l_linenumber, {label('l_linenumber', POSITIONS)} AS position,
               {label('l_linenumber', LEVELS)} AS difficulty, count(*) AS lines
        FROM lineitem GROUP BY l_linenumber""",
    "string_metrics": using(
        "app",
        """SELECT player_id, fixture_id, expected_goals, expected_assists, expected_goal_involvements,
                  expected_goals_conceded, influence, creativity, threat, ict_index FROM app""",
    ),
    "value_metrics": using(
        "pl",
        f"""SELECT player_id, points_per_million, points_per_90,
                   {per_90('expected_goal_involvements', 'minutes')} AS xgi_per_90,
                   {half(div('total_points', 'selected_by_percent'))} AS differential_score FROM pl""",
    ),
    "net_transfers": """
        SELECT c_custkey AS player_id,
               c_custkey * 13 % 500 - c_custkey * 29 % 700 AS net_transfers_event,
               c_custkey * 17 % 9000 - c_custkey * 23 % 8000 AS net_transfers_season
        FROM customer""",
    "transfer_momentum": f"""
        SELECT c_custkey AS player_id,
               {momentum('(c_custkey * 13 % 500)', '(c_custkey * 29 % 700)')} AS momentum
        FROM customer""",
    "captain_score": using(
        "app",
        f"""SELECT player_id, fixture_id,
                   {half(SCORE.format(avg='total_points::DOUBLE',
                                      xgi='nullif(expected_goal_involvements, 0)',
                                      bonus=BONUS.format(x='nullif(gameweek % 6, 0)'),
                                      form='ict_index'))} AS captain_score FROM app""",
    ),
    "upcoming_fixtures": using(
        "fx",
        f"""SELECT fixture_id, gameweek, kickoff_time FROM fx
            WHERE finished = false AND kickoff_time > {AS_OF}""",
    ),
    "fixture_long": using("sides", "SELECT * EXCLUDE (finished) FROM sides"),
    "next_gameweek": using("nextweek", "SELECT * FROM nextweek"),
    "next_fixture_per_team": using("following", "SELECT * FROM following"),
    "latest_per_key": using(
        "app",
        """SELECT player_id, gameweek, kickoff_time, fixture_id, total_points, minutes FROM app
           QUALIFY row_number() OVER (PARTITION BY player_id ORDER BY gameweek DESC,
                                      kickoff_time DESC, fixture_id DESC) = 1""",
    ),
    "rolling_form": using(
        "rolled",
        """SELECT player_id, gameweek, fixture_id, points_last_5_gw, avg_points_last_5_gw,
                  xgi_last_5_gw, minutes_last_5_gw, gw_count_in_window, avg_ict_last_5_gw
           FROM rolled""",
    ),
    "role_playing_dim": using(
        "facts",
        """SELECT team_name, team_short_name, opponent_name, opponent_short_name,
                  count(*) AS appearances, sum(total_points)::BIGINT AS total_points
           FROM facts GROUP BY ALL""",
    ),
    "captain_fanout": using(
        "nextweek",
        """SELECT c_custkey AS player_id, count(n.fixture_id) AS games
           FROM customer LEFT JOIN (SELECT team_id, fixture_id, venue FROM nextweek) n
                ON c_nationkey = n.team_id
           GROUP BY c_custkey""",
    ),
    "conditional_count": using(
        "app",
        """SELECT player_id, count(*) AS gameweeks_played,
                  count(*) FILTER (minutes > 0) AS gameweeks_with_minutes
           FROM app GROUP BY player_id""",
    ),
    "ratio_of_sums": using(
        "app",
        f"""SELECT player_id,
                   {per_90(esum('expected_goals'), 'sum(minutes)')} AS xg_per_90,
                   {per_90(esum('expected_assists'), 'sum(minutes)')} AS xa_per_90,
                   {per_90(esum('expected_goal_involvements'), 'sum(minutes)')} AS xgi_per_90,
                   {per_90('sum(total_points)', 'sum(minutes)')} AS points_per_90,
                   {per_90('sum(goals_scored)', 'sum(minutes)')} AS goals_per_90,
                   {per_90('sum(assists)', 'sum(minutes)')} AS assists_per_90
            FROM app GROUP BY player_id""",
    ),
    "composite_rank": using(
        "top",
        """SELECT web_name, points_per_million + points_per_90 + xgi_per_90 AS composite
           FROM top WHERE minutes > 0 ORDER BY composite DESC NULLS LAST, web_name""",
    ),
    "top_k": """
        SELECT o_orderkey, o_custkey, o_totalprice FROM orders
        ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""",
    "bootstrap_split": """
        SELECT 'players' AS silver_table, c_custkey + i AS id
        FROM customer CROSS JOIN (VALUES (0), (1)) v(i)
        UNION ALL SELECT 'teams', c_nationkey FROM customer
        UNION ALL SELECT 'matches', c_custkey * 2 FROM customer WHERE c_acctbal >= 0
        UNION ALL SELECT 'player_types', 1 + c_custkey % 4 FROM customer""",
    "array_documents": f"""
        SELECT o_orderkey AS id, {WEEK} AS event, o_orderstatus = 'F' AS finished FROM orders
        UNION ALL
        SELECT -o_orderkey, {WEEK}, NULL FROM orders WHERE o_orderstatus = 'O' OR o_orderkey = 0""",
    "explode_history": f"""
        SELECT o_custkey AS player_id, o_orderkey + i AS fixture, {WEEK} + i AS round
        FROM orders CROSS JOIN (VALUES (0), (1)) v(i) WHERE o_orderstatus <> 'P'""",
    "drift_split": using("ev", f"SELECT event_id, user_id, event_type, {DRIFT_TEXT} FROM ev"),
    "drift_clean": using("ev", "SELECT event_id, user_id, event_type FROM ev"),
    "drift_summary": using(
        "ev",
        """SELECT 'new_field' AS kind, 'k' AS field, count(*) AS records
           FROM ev WHERE event_type = 'error' HAVING count(*) > 0""",
    ),
    "drift_descriptor": """
        WITH n AS (
          SELECT event_type = 'error' AS k, event_id % 5 = 0 AS s, user_id IS NULL OR event_id % 3 = 0 AS no_user,
                 event_type IS NULL OR event_id % 7 = 0 AS no_type FROM events),
        d AS (SELECT * FROM n WHERE k OR s)
        SELECT kind, field, records FROM (
          SELECT 'new_field' AS kind, 'k' AS field, count(*) FILTER (k) AS records FROM d
          UNION ALL SELECT 'new_field', 'session', count(*) FILTER (s) FROM d
          UNION ALL SELECT 'missing_field', 'user_id', count(*) FILTER (no_user) FROM d
          UNION ALL SELECT 'missing_field', 'event_type', count(*) FILTER (no_type) FROM d)
        WHERE records > 0""",
    "dead_letter_descriptor": """
        SELECT concat_ws(',', CASE WHEN event_type = 'error' THEN 'k' END, CASE WHEN event_id % 5 = 0 THEN 'session' END) AS new_fields,
               concat_ws(',', CASE WHEN event_type IS NULL OR event_id % 7 = 0 THEN 'event_type' END,
                         CASE WHEN user_id IS NULL OR event_id % 3 = 0 THEN 'user_id' END) AS missing_fields,
               count(*) AS records
        FROM events WHERE event_type = 'error' OR event_id % 5 = 0 GROUP BY ALL""",
    "dlq_payload": using(
        "ev",
        f"""SELECT '{{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"'
                   || event_type || '","k":' || k || '}}' AS raw_record, {DRIFT_TEXT},
                   'events' AS silver_table, '2001-01-01T00:00:00Z' AS run_timestamp,
                   '2001-01-01T00:00:00Z' AS detected_at
            FROM ev WHERE event_type = 'error'""",
    ),
    "json_stringify": using(
        "ev",
        """SELECT event_id AS id, event_type IN ('view', 'error', 'purchase') AS has_overrides,
                  CASE WHEN event_type = 'purchase' THEN event_id % 5 END AS pick_multiplier,
                  CASE event_type WHEN 'purchase' THEN '{}' WHEN 'error' THEN 'null' END AS rules,
                  CASE WHEN event_type IN ('error', 'purchase') THEN '{"k":' || k || '}' END AS scoring,
                  CASE event_type WHEN 'purchase' THEN '[1,2]' WHEN 'error' THEN 'null' END
                      AS element_types
           FROM ev""",
    ),
    "missing_snapshots": """
        SELECT o_orderkey AS element_id, o_custkey FROM orders
        WHERE NOT EXISTS (FROM lineitem WHERE l_orderkey = o_orderkey)""",
}
