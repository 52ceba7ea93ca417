"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written from the semantics by routes of its own: codes and bands are small value tables that are joined,
columns come from lists of names, lookups read a map, ranks count the rows with greater values, and sides of a
fixture are the two elements of a list.  Rounding follows the Spark side: ``R(x, n)`` rounds the shortest
decimal text of a double half away from zero; float sums are exact.
"""

from __future__ import annotations


def R(x: str, n: int = 2) -> str:
    return f"round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,18)), {n})::DOUBLE"


def EXACT(x: str) -> str:
    """The sum of doubles, exact, rounded once: every value is a whole number of 2**-64 (true above 2**-12)."""
    return f"(sum(CAST({x} * 18446744073709551616.0::DOUBLE AS HUGEINT))::VARCHAR::DOUBLE / 18446744073709551616.0::DOUBLE)"


def DSUM2(x: str) -> str:
    return R(EXACT(x))


def DAVG2(x: str) -> str:
    return R(f"({EXACT(x)} / nullif(count({x}), 0)::DOUBLE)")


def PERIOD(ts: str) -> str:
    return f"(date_diff('day', DATE '1995-01-01', CAST({ts} AS DATE)) // 7 + 1)::BIGINT"


def DEC(whole: str, frac: str) -> str:
    return f"(CAST(({whole}) AS VARCHAR) || '.' || CAST(({frac}) AS VARCHAR))"


LINE_STATS = """
  count(*) FILTER (WHERE l_linenumber = 1) AS starts,
  count(*) FILTER (WHERE l_returnflag = 'R') AS goals_scored,
  count(*) FILTER (WHERE l_returnflag = 'A') AS assists,
  count(*) FILTER (WHERE l_discount = 0.0) AS clean_sheets,
  count(*) FILTER (WHERE l_linestatus = 'O') AS goals_conceded,
  count(*) FILTER (WHERE l_quantity = 1.0) AS own_goals,
  count(*) FILTER (WHERE l_quantity = 50.0) AS penalties_saved,
  count(*) FILTER (WHERE l_quantity = 2.0) AS penalties_missed,
  count(*) FILTER (WHERE l_discount >= 0.09) AS yellow_cards,
  count(*) FILTER (WHERE l_tax >= 0.08) AS red_cards,
  count(*) FILTER (WHERE l_linenumber >= 6) AS saves,
  count(*) FILTER (WHERE l_tax = 0.0) AS bonus,
  sum(l_linenumber)::BIGINT AS bps,
  CAST(sum(l_quantity) AS BIGINT) AS total_points,
  count(*) AS n_lines"""

# --------------------------------------------------------------------------- bronze analogs
CTE = {}
DEPS = {}

CTE["b_teams"] = f"""
SELECT CAST(n.n_nationkey AS BIGINT) AS id, CAST(n.n_regionkey AS BIGINT) AS code, n.n_name AS name,
  substr(r.r_name, 1, 3) || CAST(CAST(n.n_nationkey AS BIGINT) AS VARCHAR) AS short_name,
  CAST(n.n_nationkey AS BIGINT) + 1 AS position,
  cs.played, cs.win, cs.draw, cs.played - cs.win - cs.draw AS loss, cs.win * 3 + cs.draw AS points,
  CAST(n.n_nationkey AS BIGINT) % 5 + 1 AS strength,
  CAST(n.n_nationkey AS BIGINT) * 10 + 1000 AS strength_overall_home,
  CAST(n.n_nationkey AS BIGINT) * 10 + 1010 AS strength_overall_away,
  CAST(n.n_nationkey AS BIGINT) + 1100 AS strength_attack_home,
  CAST(n.n_nationkey AS BIGINT) + 1150 AS strength_attack_away,
  CAST(n.n_nationkey AS BIGINT) + 1200 AS strength_defence_home,
  CAST(n.n_nationkey AS BIGINT) + 1250 AS strength_defence_away,
  CASE WHEN n.n_nationkey % 7 = 3 THEN 'n/a' ELSE {DEC('cs.played % 10', 'CAST(n.n_nationkey AS BIGINT) % 10')} END AS form
FROM nation n
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
LEFT JOIN (SELECT c_nationkey, count(*) AS played,
                  count(*) FILTER (WHERE c_acctbal >= 5000.0) AS win,
                  count(*) FILTER (WHERE c_acctbal >= 2000.0 AND c_acctbal < 5000.0) AS draw
           FROM customer GROUP BY c_nationkey) cs ON n.n_nationkey = cs.c_nationkey"""

CTE["order_lines"] = """
SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, l.l_discount, l.l_tax, l.l_returnflag, l.l_linestatus,
       o.o_custkey, o.o_orderdate
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""

CTE["season"] = f"""
SELECT o_custkey, {LINE_STATS} FROM order_lines GROUP BY o_custkey"""
DEPS["season"] = ["order_lines"]

CTE["b_players"] = f"""
SELECT c.c_custkey AS id, CAST(c.c_nationkey AS BIGINT) AS team,
  CAST(CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2 WHEN 'FURNITURE' THEN 3
       WHEN 'HOUSEHOLD' THEN 4 ELSE 5 END AS BIGINT) AS element_type,
  CASE WHEN c.c_custkey % 50 = 7 THEN NULL ELSE substr(c.c_name, 1, 8) END AS first_name,
  substr(c.c_name, 10) AS second_name, c.c_name AS web_name,
  CAST(floor(c.c_acctbal / 100.0) AS BIGINT) AS now_cost,
  CAST(floor(c.c_acctbal / 100.0) AS BIGINT) % 7 - 3 AS cost_change_start,
  CAST(floor(c.c_acctbal / 100.0) AS BIGINT) % 3 - 1 AS cost_change_event,
  s.n_lines * 3 AS transfers_in_event, s.starts * 5 AS transfers_out_event,
  s.n_lines * 100 AS transfers_in, s.total_points * 2 AS transfers_out,
  s.total_points, s.total_points % 17 AS event_points, s.n_lines * 30 AS minutes,
  s.starts, s.goals_scored, s.assists, s.clean_sheets, s.goals_conceded, s.own_goals,
  s.penalties_saved, s.penalties_missed, s.yellow_cards, s.red_cards, s.saves, s.bonus, s.bps,
  CAST(CASE WHEN c.c_custkey % 10 <= 3 THEN 100 WHEN c.c_custkey % 10 = 4 THEN 50 END AS BIGINT)
    AS chance_of_playing_next_round,
  s.starts % 3 AS dreamteam_count,
  CASE WHEN c.c_custkey % 13 = 0 THEN '' WHEN c.c_custkey % 17 = 0 THEN 'abc'
       WHEN c.c_custkey % 19 = 0 THEN CAST(c.c_custkey % 20 AS VARCHAR) || 'd'
       ELSE {DEC('c.c_custkey % 20', 'c.c_custkey % 10')} END AS selected_by_percent,
  {DEC('s.total_points % 9', 's.n_lines % 10')} AS points_per_game,
  {DEC('s.n_lines % 8', 'c.c_custkey % 10')} AS form,
  {DEC('s.goals_scored % 5', 's.assists % 10')} AS value_form,
  {DEC('s.total_points % 30', 's.bps % 10')} AS value_season,
  {DEC('s.bps', 's.starts % 10')} AS influence,
  CAST(s.assists * 7 AS VARCHAR) || '.5' AS creativity,
  {DEC('s.goals_scored * 11', 's.clean_sheets % 10')} AS threat,
  {DEC('s.n_lines', 's.bonus % 10')} AS ict_index,
  {DEC('s.goals_scored', 'c.c_custkey % 100')} AS expected_goals,
  {DEC('s.assists', 'c.c_custkey % 7')} AS expected_assists,
  {DEC('s.goals_scored + s.assists', 'c.c_custkey % 9')} AS expected_goal_involvements,
  CAST(s.goals_conceded AS VARCHAR) || '.25' AS expected_goals_conceded,
  CASE c.c_custkey % 10 WHEN 4 THEN 'd' WHEN 5 THEN 'i' WHEN 6 THEN 's' WHEN 7 THEN 'u'
       WHEN 8 THEN 'n' WHEN 9 THEN 'x' ELSE 'a' END AS status,
  CASE WHEN c.c_custkey % 10 = 5 THEN 'Knock - ' || c.c_name ELSE '' END AS news,
  s.total_points > 1000 AS in_dreamteam
FROM customer c LEFT JOIN season s ON c.c_custkey = s.o_custkey"""
DEPS["b_players"] = ["season"]

CTE["b_gameweeks"] = f"""
SELECT gw AS id, 'Gameweek ' || CAST(gw AS VARCHAR) AS name, deadline_time,
  gw <= 300 AS finished, gw <= 299 AS data_checked,
  average_entry_score, highest_score, ranked_count, most_selected, most_captained,
  most_vice_captained, most_transferred_in, top_element, transfers_made,
  gw = 300 AS is_previous, gw = 301 AS is_current, gw = 302 AS is_next
FROM (SELECT {PERIOD('o_orderdate')} AS gw, min(o_orderdate) AS deadline_time,
        count(*) FILTER (WHERE o_orderstatus = 'F') AS average_entry_score,
        CAST(max(floor(o_totalprice / 1000.0)) AS BIGINT) AS highest_score,
        count(*) AS ranked_count, min(o_custkey) AS most_selected, max(o_custkey) AS most_captained,
        min(o_custkey) + 1 AS most_vice_captained, max(o_custkey) - min(o_custkey) AS most_transferred_in,
        min(o_custkey) + max(o_custkey) AS top_element, sum(o_orderkey % 10)::BIGINT AS transfers_made
      FROM orders GROUP BY 1) g"""

CTE["b_fixtures"] = f"""
SELECT l.l_orderkey * 10 + l.l_linenumber AS id, l.l_partkey AS code, {PERIOD('l.l_shipdate')} AS event,
  l.l_shipdate AS kickoff_time, CAST(c.c_nationkey AS BIGINT) AS team_h, CAST(s.s_nationkey AS BIGINT) AS team_a,
  CAST(l.l_linenumber AS BIGINT) AS team_h_score, CAST(l.l_quantity AS BIGINT) % 8 AS team_a_score,
  l.l_partkey % 5 + 1 AS team_h_difficulty, l.l_suppkey % 5 + 1 AS team_a_difficulty,
  CAST(90 AS BIGINT) AS minutes, l.l_linestatus = 'F' AS finished,
  (l.l_linestatus = 'F' OR l.l_returnflag = 'N') AS started
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey JOIN supplier s ON l.l_suppkey = s.s_suppkey"""

CTE["b_live"] = f"""
SELECT o_custkey AS id, gw AS gameweek, minutes, starts, goals_scored, assists, clean_sheets, goals_conceded,
  own_goals, penalties_saved, penalties_missed, yellow_cards, red_cards, saves, bonus, bps, total_points,
  {DEC('bps', 'n_lines % 10')} AS influence,
  CAST(assists * 7 AS VARCHAR) || '.5' AS creativity,
  CAST(goals_scored * 11 AS VARCHAR) || '.0' AS threat,
  {DEC('n_lines', 'bonus % 10')} AS ict_index,
  {DEC('goals_scored', 'o_custkey % 100')} AS expected_goals,
  {DEC('assists', 'gw % 10')} AS expected_assists,
  {DEC('goals_scored + assists', 'o_custkey % 9')} AS expected_goal_involvements,
  {DEC('goals_conceded', 'gw % 4')} AS expected_goals_conceded,
  total_points > 100 AS in_dreamteam
FROM (SELECT o_custkey, {PERIOD('o_orderdate')} AS gw,
        sum(CASE WHEN l_linestatus = 'F' THEN 30 ELSE 0 END)::BIGINT AS minutes, {LINE_STATS}
      FROM order_lines GROUP BY 1, 2) g"""
DEPS["b_live"] = ["order_lines"]

# --------------------------------------------------------------------------- silver
CLOCK = "TIMESTAMP '2026-01-01 00:00:00'"

# ---- fixed values: codes, labels and bands ----
POSITIONS = "(VALUES (1, 'GKP'), (2, 'DEF'), (3, 'MID'), (4, 'FWD'))"
LABELS = """(VALUES ('a', 'Available'), ('d', 'Doubtful'), ('i', 'Injured'), ('s', 'Suspended'), ('u', 'Unavailable'),
  ('n', 'Not in Squad'))"""
BANDS = "(VALUES (-1000000, 2, 'EASY'), (3, 3, 'MEDIUM'), (4, 1000000, 'HARD'))"
# -----------------------------------------------


def columns(spec: str, cast: str = "{}") -> str:
    """Select items from words ``out=source`` (or just a name), each source in ``cast``."""
    pairs = [w.split("=") if "=" in w else [w, w] for w in spec.split()]
    return ", ".join(f"{cast.format(source)} AS {out}" for out, source in pairs)


NUMBER = "TRY_CAST({} AS DOUBLE)"
STAT_NUMBERS = """ict_index threat creativity influence xg=expected_goals xa=expected_assists xgi=expected_goal_involvements
    xgc=expected_goals_conceded"""
COUNTS = """saves bonus red_cards yellow_cards penalties_missed penalties_saved own_goals goals_conceded clean_sheets assists
    goals_scored starts minutes total_points bonus_points_system=bps"""

CTE["team_names"] = "SELECT map_from_entries(list((id, {'long': name, 'short': short_name}))) AS m FROM b_teams"
DEPS["team_names"] = ["b_teams"]


def TEAM(key: str, form: str) -> str:
    return f"(SELECT m FROM team_names)[{key}].{form}"


CTE["s_players"] = f"""
SELECT {columns("player_id=id team_id=team position_id=element_type first_name last_name=second_name display_name=web_name")},
  first_name || ' ' || second_name AS full_name, {TEAM('team', 'long')} AS team_name, {TEAM('team', 'short')} AS team_short,
  pos.label AS position, coalesce(av.label, 'Unknown') AS availability_label,
  {columns("current_price=now_cost price_change_season=cost_change_start price_change_gw=cost_change_event",
           R('{} / 10.0::DOUBLE', 1))},
  {columns("points_per_game form value_form value_season ownership_pct=selected_by_percent " + STAT_NUMBERS, NUMBER)},
  {columns(COUNTS)},
  {columns("availability_status=status injury_news=news chance_next_gw=chance_of_playing_next_round gameweek_points=event_points")},
  {columns("transfers_in_gw=transfers_in_event transfers_in_total=transfers_in transfers_out_gw=transfers_out_event")},
  {columns("transfers_out_total=transfers_out in_dreamteam dreamteam_count")}, {CLOCK} AS loaded_at
FROM b_players LEFT JOIN {POSITIONS} pos(code, label) ON pos.code = element_type LEFT JOIN {LABELS} av(code, label) ON av.code = status"""
DEPS["s_players"] = ["b_players", "team_names"]

CTE["s_teams"] = f"""
SELECT {columns("team_id=id team_name=name team_short=short_name team_code=code league_points=points league_position=position")},
  {columns("losses=loss draws=draw wins=win matches_played=played overall_strength=strength")},
  {columns("strength_home=strength_overall_home strength_away=strength_overall_away attack_home=strength_attack_home")},
  {columns("attack_away=strength_attack_away defence_home=strength_defence_home defence_away=strength_defence_away")},
  {columns("form", NUMBER)}, {CLOCK} AS loaded_at
FROM b_teams"""
DEPS["s_teams"] = ["b_teams"]

CTE["s_gameweeks"] = f"""
SELECT {columns("gameweek_id=id gameweek_name=name is_next is_current is_previous is_data_final=data_checked is_finished=finished")},
  {columns("total_transfers=transfers_made total_managers=ranked_count highest_score avg_score=average_entry_score")},
  {columns("top_scorer_player_id=top_element most_transferred_in_player_id=most_transferred_in most_vc_player_id=most_vice_captained")},
  {columns("most_captained_player_id=most_captained most_selected_player_id=most_selected deadline=deadline_time")}, {CLOCK} AS loaded_at
FROM b_gameweeks"""
DEPS["s_gameweeks"] = ["b_gameweeks"]

CTE["s_fixtures"] = f"""
SELECT {columns("fixture_id=id fixture_code=code gameweek=event kickoff_time is_started=started is_finished=finished minutes_played=minutes")},
  {", ".join(f"team_{k} AS {side}_team_id, team_{k}_score AS {side}_score, team_{k}_difficulty AS {side}_difficulty, "
             f"{TEAM(f'team_{k}', 'long')} AS {side}_team, {TEAM(f'team_{k}', 'short')} AS {side}_team_short"
             for k, side in (('a', 'away'), ('h', 'home')))},
  if(finished, ['AWAY_WIN', 'DRAW', 'HOME_WIN'][sign(team_h_score - team_a_score)::INT + 2], NULL) AS result,
  if(finished, team_h_score + team_a_score, NULL) AS total_goals, {CLOCK} AS loaded_at
FROM b_fixtures"""
DEPS["s_fixtures"] = ["b_fixtures", "team_names"]

CTE["s_live"] = f"""
SELECT {columns("player_id=id gameweek in_dreamteam " + COUNTS)}, {columns(STAT_NUMBERS, NUMBER)},
  coalesce(minutes > 0, FALSE) AS played, assists + goals_scored AS goal_involvements, {CLOCK} AS loaded_at
FROM b_live"""
DEPS["s_live"] = ["b_live"]

# --------------------------------------------------------------------------- gold


def RATIO(n: str, d: str) -> str:
    return f"if({d} > 0, {R(f'{n} / {d}::DOUBLE')}, 0.0::DOUBLE)"


CTE["g_po"] = f"""
SELECT * EXCLUDE (position_id, last_name, first_name, gameweek_points, value_form, value_season, transfers_in_total, transfers_out_total,
    goals_conceded, own_goals, penalties_saved, penalties_missed, yellow_cards, red_cards, saves, bonus_points_system, xgc,
    availability_status, loaded_at),
  assists + goals_scored AS goal_involvements, transfers_in_gw - transfers_out_gw AS net_transfers_gw,
  goals_scored - xg AS goals_vs_xg, assists - xa AS assists_vs_xa, (goals_scored + assists) - xgi AS gi_vs_xgi,
  {RATIO('total_points', 'current_price')} AS points_per_million, {RATIO('bonus', 'starts')} AS bonus_per_start,
  if(minutes > 0, {R('total_points / (minutes / 90.0::DOUBLE)')}, 0.0::DOUBLE) AS points_per_90
FROM s_players"""
DEPS["g_po"] = ["s_players"]

# a period is recent while fewer than five finished ones come after it
CTE["g_recent"] = """
SELECT gameweek_id FROM s_gameweeks g WHERE is_finished
  AND (SELECT count(*) FROM s_gameweeks later WHERE later.is_finished AND later.gameweek_id > g.gameweek_id) < 5"""
DEPS["g_recent"] = ["s_gameweeks"]

CTE["g_rp"] = f"""
SELECT player_id, count_if(played)::BIGINT AS matches_played,
  {", ".join(f"sum({'total_points' if m == 'points' else m})::BIGINT AS {m}_last_5"
             for m in 'minutes clean_sheets bonus assists points'.split())}, sum(goals_scored)::BIGINT AS goals_last_5,
  {", ".join(f"{DSUM2(m)} AS {m}_last_5" for m in ('xa', 'xg'))}, {DAVG2('ict_index')} AS avg_ict_last_5,
  {R('avg(total_points)')} AS avg_points_last_5
FROM s_live WHERE gameweek IN (FROM g_recent) GROUP BY player_id"""
DEPS["g_rp"] = ["s_live", "g_recent"]

# one row a team and fixture: the two elements of a list
CTE["g_side"] = """
SELECT is_finished, gameweek, unnest([
  {'team_id': away_team_id, 'team_name': away_team, 'other': home_team, 'other_short': home_team_short, 'difficulty': away_difficulty,
   'venue': 'AWAY', 'scored': away_score, 'allowed': home_score},
  {'team_id': home_team_id, 'team_name': home_team, 'other': away_team, 'other_short': away_team_short, 'difficulty': home_difficulty,
   'venue': 'HOME', 'scored': home_score, 'allowed': away_score}]) AS s
FROM s_fixtures"""
DEPS["g_side"] = ["s_fixtures"]

CTE["g_open"] = "SELECT gameweek, min(gameweek) OVER () AS first_open, unnest(s) FROM g_side WHERE NOT is_finished"
DEPS["g_open"] = ["g_side"]

CTE["g_next_fixture"] = "SELECT team_id, other AS opponent, difficulty, venue, gameweek FROM g_open"
DEPS["g_next_fixture"] = ["g_open"]

CTE["g_next_gw"] = "SELECT team_id, other AS opponent, difficulty, venue, gameweek FROM g_open WHERE gameweek = first_open"
DEPS["g_next_gw"] = ["g_open"]

CTE["g_team_sides"] = """
SELECT team_id, map_from_entries(list((venue, {'f': f, 'a': a, 'clean': clean}))) AS m
FROM (SELECT s.team_id AS team_id, s.venue AS venue, sum(s.scored) AS f, sum(s.allowed) AS a, count_if(s.allowed = 0) AS clean
      FROM g_side WHERE is_finished GROUP BY ALL)
GROUP BY team_id"""
DEPS["g_team_sides"] = ["g_side"]


# the four ids as one long list, named, and spread again
ROLES = ("top_scorer", "most_transferred_in", "most_selected", "most_captained")
CTE["g_role_ids"] = f"""
SELECT gameweek_id, unnest([{", ".join(f"{{'role': '{r}', 'player_id': {r}_player_id}}" for r in ROLES)}], recursive := true) FROM s_gameweeks"""
DEPS["g_role_ids"] = ["s_gameweeks"]
CTE["g_named"] = f"""
SELECT gameweek_id, {", ".join(f"max(display_name) FILTER (role = '{r}') AS {r}_player" for r in ROLES)}
FROM g_role_ids JOIN s_players USING (player_id) GROUP BY gameweek_id"""
DEPS["g_named"] = ["g_role_ids", "s_players"]

# a team's open sides as one sorted list, cut after the fifth
CTE["g_labelled"] = "SELECT *, other_short || if(venue = 'HOME', ' (H)', ' (A)') AS fixture FROM g_open"
DEPS["g_labelled"] = ["g_open"]
CTE["g_lists"] = """
SELECT team_id, list({'gameweek': gameweek, 'fixture': fixture, 'difficulty': difficulty, 'team_name': team_name}
                     ORDER BY gameweek NULLS FIRST, fixture NULLS FIRST, difficulty NULLS FIRST)[1:5] AS f
FROM g_labelled GROUP BY team_id"""
DEPS["g_lists"] = ["g_labelled"]
CTE["g_five"] = "SELECT team_id, unnest(f, recursive := true), generate_subscripts(f, 1)::BIGINT AS fixture_order FROM g_lists"
DEPS["g_five"] = ["g_lists"]


def RANKED(base: str, metric: str, by: str | None, out: str) -> str:
    """``base`` with the rank of ``metric``, greatest first: one more than the rows of the group with a greater value."""
    same = f"a.{by} IS NOT DISTINCT FROM b.{by} AND " if by else ""
    group = f"{by}, " if by else ""
    of = f"n.{by} IS NOT DISTINCT FROM base.{by} AND " if by else ""
    return f"""
SELECT base.*, n.place AS {out} FROM ({base}) base LEFT JOIN (
  WITH v AS (SELECT {group}{metric} AS x, count(*) AS n FROM ({base}) GROUP BY ALL)
  SELECT {f'a.{by}, ' if by else ''}a.x, (1 + coalesce(sum(b.n), 0))::BIGINT AS place
  FROM v a LEFT JOIN v b ON {same}(b.x > a.x OR (a.x IS NULL AND b.x IS NOT NULL)) GROUP BY ALL) n
ON {of}n.x IS NOT DISTINCT FROM base.{metric}"""


def with_ctes(final: str, *needs: str) -> str:
    """Prefix ``final`` with the CTEs it needs, dependencies first."""
    order: list[str] = []

    def visit(n: str) -> None:
        for d in DEPS.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return final
    body = ",\n".join(f"{n} AS ({CTE[n]}\n)" for n in order)
    return f"WITH {body}\n{final}"
