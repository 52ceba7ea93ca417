"""Oracle SQL per registered query key."""

from __future__ import annotations

from aurum.registry.oracle import BANDS, RANKED, ROLES, R, columns
from aurum.registry.oracle import with_ctes as W

ORACLE: dict[str, str] = {}

ORACLE["silver_teams"] = W("SELECT * FROM s_teams", "s_teams")
ORACLE["silver_players"] = W("SELECT * FROM s_players", "s_players")
ORACLE["silver_gameweeks"] = W("SELECT * FROM s_gameweeks", "s_gameweeks")
ORACLE["silver_fixtures"] = W("SELECT * FROM s_fixtures", "s_fixtures")
ORACLE["silver_gameweek_live"] = W("SELECT * FROM s_live", "s_live")
ORACLE["player_overview"] = W("SELECT * FROM g_po", "g_po")

PICKED = "availability_label = 'Available' AND minutes >= 270"
PICK_COLUMNS = """player_id, display_name, full_name, team_name, position, availability_label, form, ownership_pct, current_price, bonus,
  xgi, assists, goals_scored, total_points, points_per_90, points_per_game, points_per_million, net_transfers_gw"""
VALUE_BASE = f"SELECT {PICK_COLUMNS}, clean_sheets, starts, minutes FROM g_po WHERE {PICKED}"

ORACLE["value_picks"] = W(RANKED(RANKED(VALUE_BASE, "points_per_million", "position", "value_rank_in_position"),
                                 "points_per_million", None, "value_rank_overall"), "g_po")

ORACLE["form_leaderboard"] = W(RANKED("""
SELECT g_rp.*, full_name, display_name, team_name, position, current_price, s.total_points AS total_points_season, ownership_pct,
  availability_label FROM s_players s JOIN g_rp USING (player_id) WHERE matches_played > 0""",
                                      "avg_points_last_5", "position", "form_rank_in_position"), "g_rp", "s_players")

# ---- fixed values: the score's terms, in the order in which they are added ----
SCORE = [("form", "2.0"), ("points_per_game", "1.5"), ("bonus_per_start", "3.0"), ("threat", "0.05"), ("(5 - difficulty)", "2.0")]
# --------------------------------------------------------------------------------

ORACLE["captaincy_score"] = W(f"""
SELECT {columns("next_gameweek=gameweek next_venue=venue next_opponent=opponent fixture_difficulty=difficulty")},
  {R(" + ".join(f"{term} * {weight}::DOUBLE" for term, weight in SCORE))} AS captaincy_score,
  {columns("player_id display_name full_name team_name position bonus bonus_per_start threat ict_index xgi assists goals_scored")},
  {columns("ownership_pct total_points points_per_game form current_price")}
FROM g_next_gw JOIN (FROM g_po WHERE {PICKED}) USING (team_id)""", "g_po", "g_next_gw")


def TOTAL(part: str, *venues: str) -> str:
    return "(" + " + ".join(f"coalesce(m['{v}'].{part}, 0)" for v in venues) + ")::BIGINT"


BOTH = ("HOME", "AWAY")
ORACLE["team_overview"] = W(f"""
SELECT t.* EXCLUDE (team_code, strength_home, strength_away, loaded_at),
  {", ".join(f"{TOTAL(part, *venues)} AS {name}" for name, part, venues in (
      ("total_goals_scored", "f", BOTH), ("total_goals_conceded", "a", BOTH), ("total_clean_sheets", "clean", BOTH),
      ("home_goals_scored", "f", BOTH[:1]), ("home_goals_conceded", "a", BOTH[:1]),
      ("away_goals_scored", "f", BOTH[1:]), ("away_goals_conceded", "a", BOTH[1:])))},
  total_goals_scored - total_goals_conceded AS goal_difference,
  {R('total_goals_scored / nullif(matches_played, 0)::DOUBLE')} AS avg_goals_scored_per_match,
  {R('total_goals_conceded / nullif(matches_played, 0)::DOUBLE')} AS avg_goals_conceded_per_match
FROM s_teams t LEFT JOIN g_team_sides USING (team_id)""", "s_teams", "g_team_sides")

ORACLE["gameweek_summary"] = W(f"""
SELECT {columns("gameweek_id gameweek_name deadline is_next is_current is_finished highest_score avg_score total_transfers total_managers")},
  {", ".join(f"{r}_player" for r in ROLES)}
FROM s_gameweeks LEFT JOIN g_named USING (gameweek_id)""", "s_gameweeks", "g_named")

ORACLE["differential_picks"] = W(RANKED(f"SELECT {PICK_COLUMNS}, ict_index FROM g_po WHERE {PICKED} AND form > 3.0 AND ownership_pct < 10.0",
                                        "points_per_million", "position", "diff_rank_in_position"), "g_po")

ORACLE["fixture_difficulty"] = W(f"""
SELECT g_five.*, label AS difficulty_label FROM g_five LEFT JOIN {BANDS} b(low, high, label) ON difficulty BETWEEN low AND high""", "g_five")

# ---- projections and scalar functions -----------------------------------------------
from aurum.registry.oracle import DAVG2, DSUM2  # noqa: E402

ORACLE["project_rename"] = """
SELECT c_custkey AS player_id, c_name AS display_name, CAST(c_nationkey AS BIGINT) AS team_id,
       c_acctbal AS balance, c_mktsegment AS segment FROM customer"""

ORACLE["star_expand"] = """
SELECT a.*, o.o_orderdate, o.o_orderpriority
FROM (SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS qty FROM lineitem GROUP BY l_orderkey) a
JOIN orders o ON a.l_orderkey = o.o_orderkey"""

ORACLE["derived_arith"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice * (1 - l_discount) AS net_price,
       l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge, l_orderkey + l_partkey AS key_sum,
       l_quantity - l_linenumber AS qty_delta
FROM lineitem"""

ORACLE["guarded_ratio"] = f"""
SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN l_discount > 0 THEN {R('l_tax / l_discount')} ELSE 0.0::DOUBLE END AS tax_per_discount,
  CASE WHEN l_quantity > 0 THEN {R('l_extendedprice / l_quantity')} ELSE 0.0::DOUBLE END AS unit_price
FROM lineitem"""

ORACLE["nullif_ratio"] = f"""
SELECT l_orderkey, l_linenumber, l_partkey,
  {R('l_quantity * 1.0::DOUBLE / NULLIF(l_linenumber - 1, 0)')} AS qty_per_extra_line
FROM lineitem"""

ORACLE["weighted_score"] = f"""
SELECT l_orderkey, l_linenumber, l_partkey,
  {R('l_quantity * 2.0::DOUBLE + l_discount * 1.5::DOUBLE + l_tax * 3.0::DOUBLE + l_extendedprice * 0.05::DOUBLE + (5 - l_linenumber) * 2.0::DOUBLE')} AS score
FROM lineitem"""

ORACLE["string_concat"] = """
SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN c_name END || ' ' || c_mktsegment AS label,
       c_mktsegment || ' (H)' AS tag
FROM customer"""

ORACLE["round_half_up"] = f"""
SELECT l_orderkey, l_linenumber, l_partkey, {R('l_quantity / 8.0::DOUBLE')} AS q8,
       {R('-l_quantity / 8.0::DOUBLE')} AS neg_q8, {R('l_extendedprice / 1000.0::DOUBLE', 1)} AS k_price
FROM lineitem"""

ORACLE["safe_cast"] = """
SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS prio_num,
  TRY_CAST(o_orderpriority AS DOUBLE) AS prio_text,
  TRY_CAST(CAST(o_orderkey % 10 AS VARCHAR) || 'd' AS DOUBLE) AS suffixed,
  TRY_CAST(' ' || CAST(o_orderkey % 100 AS VARCHAR) || '.5 ' AS DOUBLE) AS padded,
  TRY_CAST(CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE CAST(o_orderkey % 1000 AS VARCHAR) END AS DOUBLE) AS blank_or_int
FROM orders"""

ORACLE["case_map"] = """
SELECT c_custkey, CAST(c_nationkey % 6 AS BIGINT) AS position_id,
  CASE c_nationkey % 6 WHEN 1 THEN 'GKP' WHEN 2 THEN 'DEF' WHEN 3 THEN 'MID' WHEN 4 THEN 'FWD' END AS position
FROM customer"""

ORACLE["case_map_default"] = """
SELECT c_custkey, status,
  CASE status WHEN 'a' THEN 'Available' WHEN 'd' THEN 'Doubtful' WHEN 'i' THEN 'Injured'
    WHEN 's' THEN 'Suspended' WHEN 'u' THEN 'Unavailable' WHEN 'n' THEN 'Not in Squad' ELSE 'Unknown' END
    AS availability_label
FROM (SELECT c_custkey, CASE WHEN c_custkey % 11 <> 0 THEN substr('adisunx', CAST(c_custkey % 8 + 1 AS INTEGER), 1) END
        AS status FROM customer) c"""

ORACLE["case_bands"] = """
SELECT l_orderkey, l_linenumber, l_partkey, difficulty,
  CASE WHEN difficulty <= 2 THEN 'EASY' WHEN difficulty = 3 THEN 'MEDIUM' WHEN difficulty >= 4 THEN 'HARD' END
    AS difficulty_label,
  CASE WHEN fin AND h > a THEN 'HOME_WIN' WHEN fin AND a > h THEN 'AWAY_WIN' WHEN fin AND h = a THEN 'DRAW' END
    AS result
FROM (SELECT l_orderkey, l_linenumber, l_partkey,
        CASE WHEN l_linenumber <> 7 THEN l_partkey % 6 + 1 END AS difficulty, l_linestatus = 'F' AS fin,
        CAST(l_linenumber AS BIGINT) AS h, CAST(l_quantity AS BIGINT) % 8 AS a FROM lineitem) x"""

ORACLE["coalesce_zero"] = """
SELECT c.c_custkey, COALESCE(a.n, 0) AS n_orders, COALESCE(a.top, 0.0::DOUBLE) AS max_order
FROM customer c LEFT JOIN (SELECT o_custkey, count(*) AS n, max(o_totalprice) AS top FROM orders
                           GROUP BY o_custkey) a ON c.c_custkey = a.o_custkey"""

ORACLE["date_format_ddmmyyyy"] = """
SELECT o_orderkey, strftime(o_orderdate, '%d%m%Y') AS load_key, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS load_date
FROM orders"""

# ---- filters --------------------------------------------------------------------------
ORACLE["filter_bool"] = """
SELECT * FROM (SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN l_returnflag <> 'N' THEN l_linestatus = 'F' END AS is_finished FROM lineitem) x
WHERE is_finished = TRUE"""

ORACLE["filter_conj"] = """
SELECT c_custkey, c_name, c_acctbal FROM customer
WHERE c_acctbal >= 1000.0 AND c_mktsegment = 'BUILDING' AND c_nationkey < 10"""

ORACLE["having_filter"] = """
WITH g AS (SELECT l_suppkey, count(*) AS n_lines, sum(l_quantity) AS qty FROM lineitem GROUP BY l_suppkey)
SELECT * FROM g WHERE qty >= 15000.0"""

ORACLE["scalar_subquery_min"] = W("SELECT * FROM g_next_gw", "g_next_gw")

# ---- joins -----------------------------------------------------------------------------
ORACLE["left_lookup"] = """
SELECT c.c_custkey, c.c_name, n.n_name AS nation_name FROM customer c
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey"""

ORACLE["role_lookup_2"] = W("""
SELECT fixture_id, fixture_code, home_team, away_team, home_team_short, away_team_short FROM s_fixtures""",
                            "s_fixtures")

ORACLE["role_lookup_4"] = W("""
SELECT g.id, ms.c_name AS ms_name, mc.c_name AS mc_name, mv.c_name AS mv_name, tp.c_name AS top_name
FROM b_gameweeks g
LEFT JOIN customer ms ON g.most_selected = ms.c_custkey
LEFT JOIN customer mc ON g.most_captained = mc.c_custkey
LEFT JOIN customer mv ON g.most_vice_captained = mv.c_custkey
LEFT JOIN customer tp ON g.top_element = tp.c_custkey""", "b_gameweeks")

ORACLE["join_recent_n"] = W("""
SELECT gl.player_id, gl.gameweek, gl.total_points FROM s_live gl JOIN g_recent r ON gl.gameweek = r.gameweek_id""",
                            "s_live", "g_recent")

# ---- aggregates ------------------------------------------------------------------------
ORACLE["agg_basic"] = """
SELECT l_returnflag, count(*) AS n, sum(l_linenumber)::BIGINT AS lines_sum,
       sum(CAST(l_quantity AS BIGINT))::BIGINT AS qty
FROM lineitem GROUP BY l_returnflag"""

ORACLE["agg_sum_avg_round"] = f"""
SELECT l_suppkey, {DSUM2('l_extendedprice')} AS sum_price, {R('avg(l_quantity)')} AS avg_qty,
       {DAVG2('l_extendedprice')} AS avg_price
FROM lineitem GROUP BY l_suppkey"""

ORACLE["agg_countif"] = """
SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_finished,
  count(*) FILTER (WHERE o_totalprice > 300000.0) AS n_large,
  count(*) FILTER (WHERE o_orderstatus = 'X') AS n_none
FROM orders GROUP BY o_orderpriority"""

ORACLE["agg_conditional"] = """
SELECT l_linestatus, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END)::BIGINT AS returned,
  sum(CASE WHEN l_discount = 0.0 THEN 1 ELSE 0 END)::BIGINT AS no_discount
FROM lineitem GROUP BY l_linestatus"""

# ---- windows, sorts, set operations --------------------------------------------------------
ORACLE["rank_partition"] = """
SELECT c_custkey, c_mktsegment, c_acctbal,
  RANK() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC) AS balance_rank
FROM customer"""

ORACLE["rank_global"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
  RANK() OVER (ORDER BY l_extendedprice DESC) AS price_rank
FROM lineitem"""

ORACLE["rank_text"] = """
SELECT c_custkey, c_nationkey, c_name, RANK() OVER (PARTITION BY c_nationkey ORDER BY c_name NULLS FIRST) AS name_rank FROM customer"""

ORACLE["rank_timestamp"] = """
SELECT event_id, event_type, ts, RANK() OVER (PARTITION BY event_type ORDER BY ts DESC NULLS LAST) AS recency_in_type,
  RANK() OVER (ORDER BY ts DESC NULLS LAST) AS recency FROM events"""

ORACLE["topn_per_group"] = """
SELECT * FROM (SELECT l_suppkey, l_orderkey, l_partkey, l_linenumber, l_shipdate, l_extendedprice,
  ROW_NUMBER() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_partkey,
                     l_linenumber, l_shipdate) AS row_no FROM lineitem) x
WHERE row_no <= 3"""

ORACLE["topk_recent"] = W("SELECT * FROM g_recent", "g_recent")
ORACLE["union_all"] = W("SELECT * FROM g_next_fixture", "g_next_fixture")
ORACLE["unpivot_home_away"] = W("SELECT * FROM g_next_fixture", "g_next_fixture")

ORACLE["cte_reuse"] = """
WITH s AS (SELECT o_custkey, count(*) AS n_orders, max(o_totalprice) AS max_order FROM orders GROUP BY o_custkey)
SELECT * FROM s WHERE n_orders > (SELECT avg(n_orders) FROM s)"""

ORACLE["order_by_serving"] = f"SELECT *, row_number() OVER (ORDER BY gameweek_id NULLS FIRST) AS served_position FROM ({ORACLE['gameweek_summary']}) served"
ORACLE["view_stacking"] = W("""
SELECT player_id, points_per_million, points_per_90, bonus_per_start FROM g_po WHERE minutes >= 270""", "g_po")

# ---- sources, sinks, control, upsert, streaming -------------------------------------------
from aurum.registry.oracle import PERIOD  # noqa: E402

ORACLE["scan_json_lines"] = "SELECT * FROM events"
ORACLE["payload_explode"] = "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate FROM lineitem"
ORACLE["payload_root_array"] = ORACLE["payload_explode"]
ORACLE["struct_flatten_literal"] = W("SELECT * FROM b_live", "b_live")
ORACLE["json_roundtrip"] = """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
  CAST(to_json({'event_id': event_id, 'k': CAST(json_extract(props, '$.k') AS BIGINT)}) AS VARCHAR) AS encoded
FROM events"""
ORACLE["filename_date"] = "SELECT event_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS load_date FROM events"
ORACLE["sink_landing_roundtrip"] = "SELECT o.*, (SELECT count(*) FROM orders) AS record_count FROM orders o"
ORACLE["archive_partitioned"] = "SELECT *, TIMESTAMP '2026-01-02 00:00:00' AS snapshot_date FROM customer"
ORACLE["audit_append"] = W("""
SELECT 'feed' AS data_source, 'gameweek_live' AS tablename, 'incremental' AS load_type, count(*) AS record_count,
  CAST(gameweek AS VARCHAR) AS load_watermark, TIMESTAMP '2026-01-01 00:00:00' AS load_timestamp, 'SUCCESS' AS status
FROM b_live GROUP BY gameweek""", "b_live")

PRIORITY_WATERMARKS = f"""
SELECT o_orderpriority AS tablename, COALESCE(max(CASE WHEN gw % 5 <> 0 THEN gw END), 0) AS latest_watermark
FROM (SELECT o_orderpriority, {PERIOD('o_orderdate')} AS gw FROM orders) o GROUP BY o_orderpriority"""
ORACLE["watermark_max"] = PRIORITY_WATERMARKS
ORACLE["current_period"] = W("""
SELECT COALESCE(min(CASE WHEN is_current = TRUE THEN gameweek_id END),
                max(CASE WHEN is_finished = TRUE THEN gameweek_id END), 1) AS current_period
FROM s_gameweeks""", "s_gameweeks")
ORACLE["latest_finished_period"] = W("""
SELECT COALESCE(max(CASE WHEN is_finished = TRUE AND is_data_final = TRUE THEN gameweek_id END), 0)
  AS latest_final_period FROM s_gameweeks""", "s_gameweeks")
ORACLE["watermark_advance"] = W(f"""
SELECT w.tablename, w.latest_watermark, w.latest_watermark + 1 AS slice_from, c.cur AS slice_to,
  c.cur > w.latest_watermark AS has_new_periods, c.fin AS next_watermark
FROM ({PRIORITY_WATERMARKS}) w,
  (SELECT COALESCE(min(CASE WHEN is_current THEN gameweek_id END), max(CASE WHEN is_finished THEN gameweek_id END), 1) AS cur,
          COALESCE(max(CASE WHEN is_finished AND is_data_final THEN gameweek_id END), 0) AS fin
   FROM s_gameweeks) c""", "s_gameweeks")
ORACLE["incremental_slice"] = W("""
SELECT * FROM s_live
WHERE gameweek BETWEEN COALESCE((SELECT max(gameweek) FROM b_live WHERE gameweek <= 290), 0) + 1
  AND (SELECT COALESCE(min(CASE WHEN is_current THEN gameweek_id END),
                       max(CASE WHEN is_finished THEN gameweek_id END), 1) FROM s_gameweeks)""",
                                "s_live", "b_live", "s_gameweeks")
ORACLE["merge_upsert"] = W("""
SELECT * REPLACE (
  CASE WHEN gameweek > 296 AND (gameweek > 300 OR played) THEN total_points + 1 ELSE total_points END AS total_points,
  CASE WHEN gameweek > 296 AND (gameweek > 300 OR played) THEN TIMESTAMP '2026-01-02 00:00:00'
       ELSE TIMESTAMP '2026-01-01 00:00:00' END AS loaded_at)
FROM s_live""", "s_live")
ORACLE["stream_live_ingest"] = W("""
SELECT * REPLACE (CASE WHEN gameweek > 296 THEN total_points + 1 ELSE total_points END AS total_points)
FROM s_live""", "s_live")
ORACLE["config_active_tables"] = """
SELECT lower(s_name) AS table_name, CASE WHEN s_suppkey % 2 = 0 THEN 'full' ELSE 'incremental' END AS load_type
FROM supplier WHERE s_acctbal >= 0 AND s_nationkey % 5 <> 4"""

# ---- documents landed whole, quarantine, drift, lasting tables, refreshes ---------------------------
DOCUMENTED = "(SELECT *, c_custkey // 200 AS doc FROM customer)"
ORACLE["raw_landing_whole"] = f"""
SELECT c_custkey AS id, c_name AS name, TIMESTAMP '2024-02-29 23:30:00' + to_hours((c_custkey % 24)::INT) AS updated,
  NULL::VARCHAR AS nickname, c_mktsegment AS segment, c_nationkey AS nation, '}}{{' AS tag
FROM {DOCUMENTED} WHERE doc % 5 <> 3 AND c_custkey % 97 <> 0"""
ORACLE["schema_drift"] = f"""
WITH landed AS (SELECT count(*) AS n, string_agg(DISTINCT CASE WHEN c_custkey % 97 = 0 THEN 'STRING' ELSE 'BIGINT' END, ',' ORDER BY CASE
                  WHEN c_custkey % 97 = 0 THEN 'STRING' ELSE 'BIGINT' END) AS kinds FROM {DOCUMENTED} WHERE doc % 5 <> 3)
SELECT field, status, CASE WHEN status = 'missing' THEN 0 ELSE n END AS rows, coalesce(types, kinds) AS types
FROM landed, (VALUES ('id', 'declared', NULL), ('name', 'declared', 'STRING'), ('updated', 'declared', 'STRING'), ('nickname', 'missing', ''),
                     ('segment', 'undeclared', 'STRING'), ('extra', 'undeclared', 'OBJECT')) f(field, status, types)"""
ORACLE["landing_rejects"] = f"""
SELECT 'truncated document' AS reason, count(DISTINCT doc) AS documents, count(*) AS rows FROM {DOCUMENTED} WHERE doc % 5 = 3 HAVING count(*) > 0
UNION ALL SELECT 'malformed element', 0, count(DISTINCT doc) FROM {DOCUMENTED} WHERE doc % 5 = 1 HAVING count(*) > 0
UNION ALL SELECT 'line does not fit the schema', 0, count(*) FROM {DOCUMENTED} WHERE doc % 5 <> 3 AND c_custkey % 97 = 0 HAVING count(*) > 0"""
ORACLE["lasting_view"] = "SELECT * FROM customer WHERE c_acctbal > 0"
ORACLE["incremental_refresh"] = W("""
SELECT * REPLACE (
  CASE WHEN gameweek > 296 AND (gameweek > 300 OR minutes > 0) THEN total_points + 1 ELSE total_points END AS total_points,
  CASE WHEN gameweek > 296 AND (gameweek > 300 OR minutes > 0) THEN TIMESTAMP '2026-01-03 00:00:00'
       ELSE TIMESTAMP '2026-01-01 00:00:00' END AS loaded_at)
FROM s_live""", "s_live")
ORACLE["full_load_replace"] = """
SELECT s_suppkey, s_name, s_nationkey::BIGINT AS s_nationkey, 'suppliers' AS tablename, 2::BIGINT AS loads,
  (SELECT count(*) + count(*) FILTER (s_suppkey % 2 = 0) FROM supplier)::BIGINT AS landed, '5' AS watermark,
  (SELECT count(*) FROM supplier WHERE s_suppkey % 2 = 0) AS archived
FROM supplier"""
ORACLE["load_stamp"] = W("SELECT team_id, TRUE AS stamped_now, TRUE AS one_stamp FROM s_teams", "s_teams")
