"""Gold layer: the eight analytic results, composed from silver DataFrames.

Views that stack on another view take the upstream DataFrame as an argument, so a
filter on the outer result is pushed through by Catalyst.  Final ORDER BY is applied
only when ``ordered=True`` (serving), never inside a stacked result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aurum.functions.scalars import (bands, coalesce_zero, guarded_ratio, is_false, is_true,
                                     lit_concat, nullif_ratio, weighted_sum)
from aurum.operators.exact_sum import exact_aggregate
from aurum.operators.lookup import resolve_ids, spread_join
from aurum.operators.ranking import rank_by, rank_columns, recent_n, top_n_per_group
from aurum.operators.reshape import unpivot_sides

# ---- fixed values (thresholds and weights of the published results) ---------------
MIN_MINUTES = 270            # "meaningful game time"
AVAILABLE = "Available"
DIFFERENTIAL_MAX_OWNERSHIP = 10.0
DIFFERENTIAL_MIN_FORM = 3.0
RECENT_PERIODS = 5           # form window: most recent finished periods
MIN_MATCHES_PLAYED = 1       # form filter on matches played in the window
UPCOMING_FIXTURES = 5        # fixtures kept per team in the difficulty tracker
# captaincy score weights: form, points per game, bonus per start, threat, (5 - difficulty)
CAPTAINCY_WEIGHTS = (2.0, 1.5, 3.0, 0.05, 2.0)
EASIEST_DIFFICULTY_PIVOT = 5
LIST_ROWS = 256              # fixtures that meet a player in one step
# difficulty bands: <= 2 EASY, = 3 MEDIUM, >= 4 HARD
DIFFICULTY_BANDS = [("<=", 2, "EASY"), ("=", 3, "MEDIUM"), (">=", 4, "HARD")]
# -----------------------------------------------------------------------------------


def player_overview(players: DataFrame) -> DataFrame:
    p = players
    return p.select(
        "player_id", "full_name", "display_name", "team_id", "team_name", "team_short",
        "position", "current_price", "total_points", "minutes", "starts", "form",
        "points_per_game", "ownership_pct", "goals_scored", "assists",
        (F.col("goals_scored") + F.col("assists")).alias("goal_involvements"),
        "clean_sheets", "xg", "xa", "xgi",
        (F.col("goals_scored") - F.col("xg")).alias("goals_vs_xg"),
        (F.col("assists") - F.col("xa")).alias("assists_vs_xa"),
        ((F.col("goals_scored") + F.col("assists")) - F.col("xgi")).alias("gi_vs_xgi"),
        guarded_ratio("total_points", "current_price").alias("points_per_million"),
        F.when(F.col("minutes") > 0,
               F.round(F.col("total_points") / (F.col("minutes") / F.lit(90.0)), 2))
         .otherwise(F.lit(0.0)).alias("points_per_90"),
        "ict_index", "influence", "creativity", "threat", "bonus",
        guarded_ratio("bonus", "starts").alias("bonus_per_start"),
        "availability_label", "injury_news", "chance_next_gw",
        "transfers_in_gw", "transfers_out_gw",
        (F.col("transfers_in_gw") - F.col("transfers_out_gw")).alias("net_transfers_gw"),
        "price_change_season", "price_change_gw", "dreamteam_count", "in_dreamteam",
    )


def value_picks(overview: DataFrame) -> DataFrame:
    base = overview.where((F.col("minutes") >= MIN_MINUTES) & (F.col("availability_label") == AVAILABLE))
    base = base.select(
        "player_id", "full_name", "display_name", "team_name", "position", "current_price",
        "total_points", "points_per_game", "form", "ownership_pct", "minutes", "starts",
        "goals_scored", "assists", "clean_sheets", "xgi", "points_per_million", "points_per_90",
        "bonus", "availability_label", "net_transfers_gw")
    return rank_columns(base, "points_per_million",
                        {"value_rank_in_position": ["position"], "value_rank_overall": []})


def recent_finished_periods(gameweeks: DataFrame, n: int = RECENT_PERIODS) -> DataFrame:
    """Ids of the ``n`` most recent finished periods (fewer if fewer exist)."""
    return recent_n(gameweeks, "gameweek_id", n, where=is_true("is_finished"))


def recent_performance(gameweeks: DataFrame, live: DataFrame, n: int = RECENT_PERIODS) -> DataFrame:
    # the live table is read only in the recent periods' partitions: the range of the (at
    # most n) recent ids bounds the scan through scalar subqueries evaluated at run time,
    # and the semi join on the ids (broadcast, <= n rows) keeps exactly those periods and
    # adds dynamic partition pruning.  Nothing is fetched while building the plan, so a
    # published view always uses the current periods.
    recent = recent_finished_periods(gameweeks, n)
    bounds = recent.agg(F.struct(F.min("gameweek_id").alias("lo"), F.max("gameweek_id").alias("hi"))).scalar()
    period = F.col("gameweek")
    gl = (live.where(period.between(bounds["lo"], bounds["hi"]))
              .join(recent, period == recent["gameweek_id"], "left_semi"))
    # float sums and averages are exact, so that they don't depend on the partitioning
    points = F.col("total_points")
    totals = exact_aggregate(gl, ["player_id"], sums={"xg": "xg", "xa": "xa"}, avgs={"ict": "ict_index"}, whole={
        "matches_played": F.coalesce(F.col("played"), F.lit(False)).cast("long"), "points_last_5": points,
        "goals_last_5": F.col("goals_scored"), "assists_last_5": F.col("assists"), "bonus_last_5": F.col("bonus"),
        "clean_sheets_last_5": F.col("clean_sheets"), "minutes_last_5": F.col("minutes"),
        "__scored": F.when(points.isNotNull(), F.lit(1).cast("long"))})
    return totals.select(
        "player_id", "matches_played", "points_last_5", "goals_last_5", "assists_last_5", "bonus_last_5", "clean_sheets_last_5",
        F.round(F.col("points_last_5").cast("double") / F.col("__scored"), 2).alias("avg_points_last_5"),
        F.round("xg", 2).alias("xg_last_5"), F.round("xa", 2).alias("xa_last_5"), F.round("ict", 2).alias("avg_ict_last_5"),
        "minutes_last_5")


def form_players(gameweeks: DataFrame, live: DataFrame, players: DataFrame,
                 n: int = RECENT_PERIODS, min_matches: int = MIN_MATCHES_PLAYED,
                 ordered: bool = False) -> DataFrame:
    rp = recent_performance(gameweeks, live, n).alias("rp")
    p = players.select("player_id", "full_name", "display_name", "team_name", "position",
                       "current_price", F.col("total_points").alias("total_points_season"),
                       "ownership_pct", "availability_label").alias("p")
    joined = rp.join(p, "player_id", "inner").where(F.col("matches_played") >= min_matches)
    out = rank_by(joined, "avg_points_last_5", ["position"], out="form_rank_in_position")
    return out.orderBy(F.col("avg_points_last_5").desc()) if ordered else out


def _open_fixture_sides(fixtures: DataFrame, sides: tuple[dict, dict]) -> DataFrame:
    return unpivot_sides(fixtures.where(is_false("is_finished")), sides)


def next_fixtures(fixtures: DataFrame) -> DataFrame:
    """Unfinished fixtures as one row per team side (single scan of fixtures)."""
    home = {"team_id": F.col("home_team_id"), "opponent": F.col("away_team"),
            "difficulty": F.col("home_difficulty"), "venue": F.lit("HOME"), "gameweek": F.col("gameweek")}
    away = {"team_id": F.col("away_team_id"), "opponent": F.col("home_team"),
            "difficulty": F.col("away_difficulty"), "venue": F.lit("AWAY"), "gameweek": F.col("gameweek")}
    return _open_fixture_sides(fixtures, (home, away))


def next_period_fixtures(fixtures: DataFrame) -> DataFrame:
    """Rows of ``next_fixtures`` in the earliest open period.

    The period is a scalar subquery over two columns; its value reaches the second scan as a filter
    (pushed to the files, and to the folders of a table kept by period), before the sides are unfolded.
    """
    first = fixtures.where(is_false("is_finished")).agg(F.min("gameweek")).scalar()
    return next_fixtures(fixtures.where(F.col("gameweek") == first))


def sides_in_lists(sides: DataFrame, size: int = LIST_ROWS) -> DataFrame:
    """Rows of ``next_fixtures`` by team and difficulty, in lists (column ``sides``) of at most ``size``."""
    w = Window.partitionBy("team_id", "difficulty").orderBy("opponent", "venue", "gameweek")
    return (sides.withColumn("__list", F.floor((F.row_number().over(w) - 1) / size))
            .groupBy("team_id", "difficulty", "__list").agg(F.collect_list(F.struct("opponent", "venue", "gameweek")).alias("sides")).drop("__list"))


def captaincy_picks(overview: DataFrame, fixtures: DataFrame, ordered: bool = False) -> DataFrame:
    p = overview.where((F.col("availability_label") == AVAILABLE) & (F.col("minutes") >= MIN_MINUTES))
    nf = sides_in_lists(next_period_fixtures(fixtures)).withColumnRenamed("team_id", "nf_team_id")
    # no hint: the view outlives the size of its tables, so the join is chosen at run time
    j = spread_join(p, nf, "team_id", "nf_team_id")
    wf, wp, wb, wt, wd = CAPTAINCY_WEIGHTS
    score = weighted_sum([
        (F.col("form"), wf), (F.col("points_per_game"), wp), (F.col("bonus_per_start"), wb),
        (F.col("threat"), wt), (F.lit(EASIEST_DIFFICULTY_PIVOT) - F.col("difficulty"), wd)])
    before = ["player_id", "full_name", "display_name", "team_name", "position", "current_price",
              "form", "points_per_game", "total_points", "ownership_pct"]
    after = ["goals_scored", "assists", "xgi", "ict_index", "threat", "bonus", "bonus_per_start"]
    # rounding a score costs more than all else of a row: once for a player and difficulty, not for each fixture
    scored = j.select(*before, "difficulty", *after, score.alias("captaincy_score"), "sides")
    out = scored.select(*before, "difficulty", *after, "captaincy_score", F.inline("sides")).select(
        *before, F.col("opponent").alias("next_opponent"), F.col("venue").alias("next_venue"),
        F.col("difficulty").alias("fixture_difficulty"), F.col("gameweek").alias("next_gameweek"),
        *after, "captaincy_score")
    return out.orderBy(F.col("captaincy_score").desc()) if ordered else out


def team_fixture_totals(fixtures: DataFrame) -> DataFrame:
    """Per team, over finished fixtures: home/away goals for and against and clean sheets.

    One scan: each fixture becomes a home row and an away row, then a single grouped
    aggregation with conditional sums (partial aggregation map-side).
    """
    fin = fixtures.where(is_true("is_finished"))
    home = {"team_id": F.col("home_team_id"), "is_home": F.lit(True),
            "scored": F.col("home_score"), "conceded": F.col("away_score")}
    away = {"team_id": F.col("away_team_id"), "is_home": F.lit(False),
            "scored": F.col("away_score"), "conceded": F.col("home_score")}
    sides = unpivot_sides(fin, (home, away))
    h, a = F.col("is_home"), ~F.col("is_home")
    cs = F.when(F.col("conceded") == 0, 1).otherwise(0)
    return sides.groupBy("team_id").agg(
        F.sum(F.when(h, F.col("scored"))).alias("home_goals_scored"),
        F.sum(F.when(h, F.col("conceded"))).alias("home_goals_conceded"),
        F.sum(F.when(h, cs)).alias("home_clean_sheets"),
        F.sum(F.when(a, F.col("scored"))).alias("away_goals_scored"),
        F.sum(F.when(a, F.col("conceded"))).alias("away_goals_conceded"),
        F.sum(F.when(a, cs)).alias("away_clean_sheets"),
    )


def team_overview(teams: DataFrame, fixtures: DataFrame, ordered: bool = False) -> DataFrame:
    st = team_fixture_totals(fixtures).withColumnRenamed("team_id", "st_team_id")
    t = teams.join(st, teams["team_id"] == st["st_team_id"], "left")
    hs, hc, hcs = (coalesce_zero(c) for c in ("home_goals_scored", "home_goals_conceded", "home_clean_sheets"))
    as_, ac, acs = (coalesce_zero(c) for c in ("away_goals_scored", "away_goals_conceded", "away_clean_sheets"))
    scored, conceded = hs + as_, hc + ac
    out = t.select(
        "team_id", "team_name", "team_short", "league_position", "league_points", "matches_played",
        "wins", "draws", "losses", "form",
        scored.cast("long").alias("total_goals_scored"),
        conceded.cast("long").alias("total_goals_conceded"),
        (scored - conceded).cast("long").alias("goal_difference"),
        (hcs + acs).cast("long").alias("total_clean_sheets"),
        hs.cast("long").alias("home_goals_scored"), hc.cast("long").alias("home_goals_conceded"),
        as_.cast("long").alias("away_goals_scored"), ac.cast("long").alias("away_goals_conceded"),
        nullif_ratio(scored, F.col("matches_played")).alias("avg_goals_scored_per_match"),
        nullif_ratio(conceded, F.col("matches_played")).alias("avg_goals_conceded_per_match"),
        "overall_strength", "attack_home", "attack_away", "defence_home", "defence_away")
    return out.orderBy(F.col("league_position").asc_nulls_first()) if ordered else out


GAMEWEEK_ROLES = {
    "most_captained_player_id": "most_captained_player",
    "most_selected_player_id": "most_selected_player",
    "most_transferred_in_player_id": "most_transferred_in_player",
    "top_scorer_player_id": "top_scorer_player",
}


def gameweek_summary(gameweeks: DataFrame, players: DataFrame, ordered: bool = False) -> DataFrame:
    gw = resolve_ids(gameweeks, players, "player_id", "display_name", GAMEWEEK_ROLES)
    out = gw.select(
        "gameweek_id", "gameweek_name", "deadline", "is_finished", "avg_score", "highest_score",
        "total_managers", "total_transfers", *GAMEWEEK_ROLES.values(), "is_current", "is_next")
    return out.orderBy(F.col("gameweek_id").asc_nulls_first()) if ordered else out


def differential_picks(overview: DataFrame, ordered: bool = False) -> DataFrame:
    base = overview.where(
        (F.col("ownership_pct") < DIFFERENTIAL_MAX_OWNERSHIP) & (F.col("minutes") >= MIN_MINUTES)
        & (F.col("availability_label") == AVAILABLE) & (F.col("form") > DIFFERENTIAL_MIN_FORM))
    base = base.select(
        "player_id", "full_name", "display_name", "team_name", "position", "current_price",
        "total_points", "points_per_game", "form", "ownership_pct", "points_per_million",
        "points_per_90", "goals_scored", "assists", "xgi", "ict_index", "bonus",
        "availability_label", "net_transfers_gw")
    out = rank_by(base, "points_per_million", ["position"], out="diff_rank_in_position")
    return out.orderBy(F.col("points_per_million").desc()) if ordered else out


def upcoming_fixtures(fixtures: DataFrame) -> DataFrame:
    home = {"team_id": F.col("home_team_id"), "team_name": F.col("home_team"), "gameweek": F.col("gameweek"),
            "fixture": lit_concat("away_team_short", " (H)"), "difficulty": F.col("home_difficulty")}
    away = {"team_id": F.col("away_team_id"), "team_name": F.col("away_team"), "gameweek": F.col("gameweek"),
            "fixture": lit_concat("home_team_short", " (A)"), "difficulty": F.col("away_difficulty")}
    return _open_fixture_sides(fixtures, (home, away))


def fixture_difficulty(fixtures: DataFrame, n: int = UPCOMING_FIXTURES, ordered: bool = False) -> DataFrame:
    """Next ``n`` open fixtures per team.  Ties on period are broken by the other output
    columns (fixture label, difficulty), so the kept rows are deterministic."""
    up = upcoming_fixtures(fixtures)
    order = [F.col("gameweek").asc_nulls_first(), F.col("fixture").asc_nulls_first(),
             F.col("difficulty").asc_nulls_first()]
    ranked = top_n_per_group(up, ["team_id"], order, n, out="fixture_order")
    out = ranked.select("team_id", "team_name", "gameweek", "fixture", "difficulty",
                        bands("difficulty", DIFFICULTY_BANDS).alias("difficulty_label"), "fixture_order")
    return (out.orderBy(F.col("team_name").asc_nulls_first(), F.col("gameweek").asc_nulls_first())
            if ordered else out)
