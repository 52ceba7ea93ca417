"""Explicit bronze schemas (no inference: no extra scan, stable types on empty input).

Only the fields the silver layer reads are declared; extra fields in the documents are
ignored by the JSON reader.
"""

from __future__ import annotations

from pyspark.sql import types as T

L, D, S, B, TS = T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType(), T.TimestampNTZType()


def _fields(spec: list[tuple[T.DataType, str]]) -> T.StructType:
    out = []
    for dtype, names in spec:
        out += [T.StructField(n.strip(), dtype, True) for n in names.split(",") if n.strip()]
    return T.StructType(out)


PLAYER_STATS = ("minutes, starts, goals_scored, assists, clean_sheets, goals_conceded, own_goals, "
                "penalties_saved, penalties_missed, yellow_cards, red_cards, saves, bonus, bps")
STAT_TEXT = ("influence, creativity, threat, ict_index, expected_goals, expected_assists, "
             "expected_goal_involvements, expected_goals_conceded")

PLAYERS = _fields([
    (L, "id, team, element_type, now_cost, cost_change_start, cost_change_event, transfers_in_event, "
        "transfers_out_event, transfers_in, transfers_out, total_points, event_points, " + PLAYER_STATS +
        ", chance_of_playing_next_round, dreamteam_count"),
    (S, "first_name, second_name, web_name, status, news"),
    (S, "selected_by_percent, points_per_game, form, value_form, value_season, " + STAT_TEXT),
    (B, "in_dreamteam"),
])

TEAMS = _fields([
    (L, "id, code, position, played, win, draw, loss, points, strength, strength_overall_home, "
        "strength_overall_away, strength_attack_home, strength_attack_away, strength_defence_home, "
        "strength_defence_away"),
    (S, "name, short_name, form"),
])

GAMEWEEKS = _fields([
    (L, "id, average_entry_score, highest_score, ranked_count, most_selected, most_captained, "
        "most_vice_captained, most_transferred_in, top_element, transfers_made"),
    (S, "name"),
    (TS, "deadline_time"),
    (B, "finished, data_checked, is_previous, is_current, is_next"),
])

FIXTURE_STAT = T.StructType([
    T.StructField("identifier", S),
    T.StructField("a", T.ArrayType(T.StructType([T.StructField("value", L), T.StructField("element", L)]))),
    T.StructField("h", T.ArrayType(T.StructType([T.StructField("value", L), T.StructField("element", L)]))),
])

FIXTURES = _fields([
    (L, "id, code, event, team_h, team_a, team_h_score, team_a_score, team_h_difficulty, "
        "team_a_difficulty, minutes"),
    (TS, "kickoff_time"),
    (B, "finished, started"),
]).add("stats", T.ArrayType(FIXTURE_STAT), True)

LIVE_STATS = _fields([(L, PLAYER_STATS + ", total_points"), (S, STAT_TEXT), (B, "in_dreamteam")])

# one element of the per-period live document: {"id": .., "stats": {..}}; the same-named
# top-level fields it may carry are overwritten by the stats object when flattened
LIVE_ELEMENT = T.StructType([T.StructField("id", L, True), T.StructField("total_points", L, True),
                             T.StructField("stats", LIVE_STATS, True)])

# flattened live row as landed: one row per player per period
LIVE = T.StructType([T.StructField("id", L, True), T.StructField("gameweek", L, True)] + list(LIVE_STATS.fields))

POSITIONS = _fields([(L, "id, squad_select, squad_min_play, squad_max_play, element_count"),
                     (S, "singular_name, singular_name_short, plural_name, plural_name_short")])

CONFIG = _fields([(S, "datasource, table_name, load_type, is_active")])

AUDIT = T.StructType([
    T.StructField("data_source", S), T.StructField("tablename", S), T.StructField("load_type", S),
    T.StructField("record_count", L), T.StructField("load_watermark", S),
    T.StructField("load_timestamp", TS), T.StructField("status", S),
])

BRONZE = {"players": PLAYERS, "teams": TEAMS, "gameweeks": GAMEWEEKS, "fixtures": FIXTURES,
          "gameweek_live": LIVE, "positions": POSITIONS}

# season document arrays: document key per bronze table
DOCUMENT_KEYS = {"players": "elements", "positions": "element_types", "teams": "teams",
                 "gameweeks": "events"}
