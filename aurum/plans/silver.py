"""Silver layer: typed, renamed and labelled tables built from bronze DataFrames.

Each builder is a pure ``DataFrame -> DataFrame`` function; writing is the caller's
choice (``aurum.sinks``).  ``loaded_at`` is injectable so results can be compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aurum.functions.scalars import positive_flag, safe_double, scaled, strict_concat, value_map
from aurum.operators.lookup import left_lookup, role_lookups

# ---- fixed values (must equal the source system's codes) -------------------------
# position codes 1..4 -> short position names; anything else has no position
POSITION_NAMES = {1: "GKP", 2: "DEF", 3: "MID", 4: "FWD"}
# availability status codes -> labels; anything else (or NULL) is 'Unknown'
AVAILABILITY_LABELS = {"a": "Available", "d": "Doubtful", "i": "Injured", "s": "Suspended",
                       "u": "Unavailable", "n": "Not in Squad"}
UNKNOWN_AVAILABILITY = "Unknown"
# -----------------------------------------------------------------------------------


def _clock(loaded_at: Column | None) -> Column:
    return (loaded_at if loaded_at is not None else F.current_timestamp()).alias("loaded_at")


def silver_players(players: DataFrame, teams: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """bronze players LEFT JOIN teams: names, position map, prices in units, safe casts."""
    p = left_lookup(players, teams, "team", "id", {"name": "team_name", "short_name": "team_short"})
    return p.select(
        F.col("id").alias("player_id"),
        "first_name",
        F.col("second_name").alias("last_name"),
        F.col("web_name").alias("display_name"),
        strict_concat("first_name", F.lit(" "), "second_name").alias("full_name"),
        F.col("team").alias("team_id"),
        "team_name",
        "team_short",
        F.col("element_type").alias("position_id"),
        value_map("element_type", POSITION_NAMES).alias("position"),
        scaled("now_cost", 10.0, 1).alias("current_price"),
        scaled("cost_change_start", 10.0, 1).alias("price_change_season"),
        scaled("cost_change_event", 10.0, 1).alias("price_change_gw"),
        safe_double("selected_by_percent").alias("ownership_pct"),
        F.col("transfers_in_event").alias("transfers_in_gw"),
        F.col("transfers_out_event").alias("transfers_out_gw"),
        F.col("transfers_in").alias("transfers_in_total"),
        F.col("transfers_out").alias("transfers_out_total"),
        "total_points",
        F.col("event_points").alias("gameweek_points"),
        safe_double("points_per_game").alias("points_per_game"),
        safe_double("form").alias("form"),
        safe_double("value_form").alias("value_form"),
        safe_double("value_season").alias("value_season"),
        "minutes", "starts", "goals_scored", "assists", "clean_sheets", "goals_conceded",
        "own_goals", "penalties_saved", "penalties_missed", "yellow_cards", "red_cards",
        "saves", "bonus",
        F.col("bps").alias("bonus_points_system"),
        safe_double("influence").alias("influence"),
        safe_double("creativity").alias("creativity"),
        safe_double("threat").alias("threat"),
        safe_double("ict_index").alias("ict_index"),
        safe_double("expected_goals").alias("xg"),
        safe_double("expected_assists").alias("xa"),
        safe_double("expected_goal_involvements").alias("xgi"),
        safe_double("expected_goals_conceded").alias("xgc"),
        F.col("status").alias("availability_status"),
        value_map("status", AVAILABILITY_LABELS, UNKNOWN_AVAILABILITY).alias("availability_label"),
        F.col("news").alias("injury_news"),
        F.col("chance_of_playing_next_round").alias("chance_next_gw"),
        "dreamteam_count",
        "in_dreamteam",
        _clock(loaded_at),
    )


def silver_teams(teams: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    return teams.select(
        F.col("id").alias("team_id"),
        F.col("code").alias("team_code"),
        F.col("name").alias("team_name"),
        F.col("short_name").alias("team_short"),
        F.col("position").alias("league_position"),
        F.col("played").alias("matches_played"),
        F.col("win").alias("wins"),
        F.col("draw").alias("draws"),
        F.col("loss").alias("losses"),
        F.col("points").alias("league_points"),
        F.col("strength").alias("overall_strength"),
        F.col("strength_overall_home").alias("strength_home"),
        F.col("strength_overall_away").alias("strength_away"),
        F.col("strength_attack_home").alias("attack_home"),
        F.col("strength_attack_away").alias("attack_away"),
        F.col("strength_defence_home").alias("defence_home"),
        F.col("strength_defence_away").alias("defence_away"),
        safe_double("form").alias("form"),
        _clock(loaded_at),
    )


def silver_gameweeks(gameweeks: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    return gameweeks.select(
        F.col("id").alias("gameweek_id"),
        F.col("name").alias("gameweek_name"),
        F.col("deadline_time").alias("deadline"),
        F.col("finished").alias("is_finished"),
        F.col("data_checked").alias("is_data_final"),
        F.col("average_entry_score").alias("avg_score"),
        "highest_score",
        F.col("ranked_count").alias("total_managers"),
        F.col("most_selected").alias("most_selected_player_id"),
        F.col("most_captained").alias("most_captained_player_id"),
        F.col("most_vice_captained").alias("most_vc_player_id"),
        F.col("most_transferred_in").alias("most_transferred_in_player_id"),
        F.col("top_element").alias("top_scorer_player_id"),
        F.col("transfers_made").alias("total_transfers"),
        "is_previous", "is_current", "is_next",
        _clock(loaded_at),
    )


def match_result(finished: Column, home: Column, away: Column) -> Column:
    """HOME_WIN / AWAY_WIN / DRAW for finished matches, otherwise NULL."""
    return (F.when(finished & (home > away), F.lit("HOME_WIN"))
             .when(finished & (away > home), F.lit("AWAY_WIN"))
             .when(finished & (home == away), F.lit("DRAW")))


def silver_fixtures(fixtures: DataFrame, teams: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """fixtures LEFT JOIN teams twice (home and away roles), result and total goals."""
    f = role_lookups(fixtures, teams, "id", {
        "team_h": {"name": "home_team", "short_name": "home_team_short"},
        "team_a": {"name": "away_team", "short_name": "away_team_short"}})
    fin = F.col("finished")
    return f.select(
        F.col("id").alias("fixture_id"),
        F.col("code").alias("fixture_code"),
        F.col("event").alias("gameweek"),
        "kickoff_time",
        F.col("team_h").alias("home_team_id"),
        "home_team", "home_team_short",
        F.col("team_h_score").alias("home_score"),
        F.col("team_h_difficulty").alias("home_difficulty"),
        F.col("team_a").alias("away_team_id"),
        "away_team", "away_team_short",
        F.col("team_a_score").alias("away_score"),
        F.col("team_a_difficulty").alias("away_difficulty"),
        fin.alias("is_finished"),
        F.col("started").alias("is_started"),
        F.col("minutes").alias("minutes_played"),
        match_result(fin, F.col("team_h_score"), F.col("team_a_score")).alias("result"),
        F.when(fin, F.col("team_h_score") + F.col("team_a_score")).alias("total_goals"),
        _clock(loaded_at),
    )


LIVE_COLUMNS = [
    "player_id", "gameweek", "minutes", "starts", "goals_scored", "assists", "clean_sheets",
    "goals_conceded", "own_goals", "penalties_saved", "penalties_missed", "yellow_cards",
    "red_cards", "saves", "bonus", "bonus_points_system", "total_points", "influence",
    "creativity", "threat", "ict_index", "xg", "xa", "xgi", "xgc", "in_dreamteam", "played",
    "goal_involvements", "loaded_at",
]
LIVE_KEYS = ["player_id", "gameweek"]


def silver_live(live: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Typed per-player-per-period rows (the MERGE source of the live table)."""
    return live.select(
        F.col("id").alias("player_id"),
        "gameweek", "minutes", "starts", "goals_scored", "assists", "clean_sheets",
        "goals_conceded", "own_goals", "penalties_saved", "penalties_missed", "yellow_cards",
        "red_cards", "saves", "bonus",
        F.col("bps").alias("bonus_points_system"),
        "total_points",
        safe_double("influence").alias("influence"),
        safe_double("creativity").alias("creativity"),
        safe_double("threat").alias("threat"),
        safe_double("ict_index").alias("ict_index"),
        safe_double("expected_goals").alias("xg"),
        safe_double("expected_assists").alias("xa"),
        safe_double("expected_goal_involvements").alias("xgi"),
        safe_double("expected_goals_conceded").alias("xgc"),
        "in_dreamteam",
        positive_flag("minutes").alias("played"),
        (F.col("goals_scored") + F.col("assists")).alias("goal_involvements"),
        _clock(loaded_at),
    )
