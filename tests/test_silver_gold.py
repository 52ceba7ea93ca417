import pytest
from pyspark.sql import functions as F

from aurum.plans import gold as G
from aurum.plans import silver as S
from tests.football import clock, season


@pytest.fixture(scope="module")
def silver(spark):
    b = season(spark)
    return dict(
        teams=S.silver_teams(b["teams"], clock()),
        players=S.silver_players(b["players"], b["teams"], clock()),
        fixtures=S.silver_fixtures(b["fixtures"], b["teams"], clock()),
        gameweeks=S.silver_gameweeks(b["gameweeks"], clock()),
        live=S.silver_live(b["live"], clock()))


def by_id(df, key):
    return {r[key]: r for r in df.collect()}


def test_silver_players_edges(silver):
    p = by_id(silver["players"], "player_id")
    assert len(silver["players"].columns) == 53
    assert p[1].position == "MID" and p[1].team_name == "Arsenal" and p[1].current_price == 10.0
    assert p[1].full_name == "First Last1" and p[1].price_change_gw == -0.1
    assert p[2].position is None and p[2].availability_label == "Unknown" and p[2].form is None
    assert p[2].full_name is None
    assert p[3].team_name is None and p[3].availability_label == "Unknown"
    assert p[4].position == "GKP" and p[4].ownership_pct == 25.0


def test_silver_fixture_results(silver):
    f = by_id(silver["fixtures"], "fixture_id")
    assert (f[1].result, f[1].total_goals, f[1].home_team, f[1].away_team_short) == ("HOME_WIN", 2, "Arsenal", "BRE")
    assert (f[2].result, f[3].result) == ("DRAW", "AWAY_WIN")
    assert (f[4].result, f[4].total_goals) == (None, None)
    assert (f[5].result, f[5].total_goals) == (None, None)
    assert (f[13].result, f[13].total_goals) == (None, None)


def test_silver_live_played(silver):
    rows = {(r.player_id, r.gameweek): r for r in silver["live"].collect()}
    assert rows[(2, 1)].played is False and rows[(5, 2)].played is False and rows[(1, 1)].played is True
    assert rows[(1, 1)].goal_involvements == 1 and rows[(1, 1)].xg == 0.45


def test_player_overview_guarded_ratios(silver):
    po = by_id(G.player_overview(silver["players"]), "player_id")
    assert po[1].points_per_million == 15.0 and po[1].points_per_90 == 15.0 and po[1].bonus_per_start == 0.7
    assert (po[3].points_per_million, po[3].points_per_90, po[3].bonus_per_start) == (0.0, 0.0, 0.0)
    assert (po[6].points_per_million, po[6].points_per_90, po[6].bonus_per_start) == (0.0, 0.0, 0.0)
    assert po[1].goals_vs_xg == pytest.approx(0.8) and po[1].net_transfers_gw == 6


def test_value_picks_ranks_tie_and_skip(silver):
    vp = by_id(G.value_picks(G.player_overview(silver["players"])), "player_id")
    assert set(vp) == {1, 4, 5, 7}               # 2 and 3: not Available; 6: no minutes
    assert vp[4].value_rank_in_position == vp[5].value_rank_in_position == 1
    assert vp[4].value_rank_overall == vp[5].value_rank_overall == 1
    assert vp[1].value_rank_overall == 3          # rank skips after the tie
    assert vp[7].position is None and vp[7].value_rank_in_position == 1


def test_form_players_recent_window(silver):
    fp = by_id(G.form_players(silver["gameweeks"], silver["live"], silver["players"]), "player_id")
    # only gameweeks 1-2 are finished (fewer than 5): gameweek 3 points are ignored
    assert fp[1].points_last_5 == 13 and fp[1].avg_points_last_5 == 6.5 and fp[1].matches_played == 2
    assert 2 not in fp                            # played no minutes in the window
    assert fp[5].matches_played == 0 if 5 in fp else True
    assert fp[4].form_rank_in_position == 1 and fp[4].xg_last_5 == 0.9


def test_captaincy_double_and_blank(silver):
    cp = G.captaincy_picks(G.player_overview(silver["players"]), silver["fixtures"]).collect()
    per_player = {}
    for r in cp:
        per_player.setdefault(r.player_id, []).append(r)
    assert len(per_player[1]) == 2 and {r.next_venue for r in per_player[1]} == {"HOME", "AWAY"}
    assert all(r.next_gameweek == 3 for r in cp)   # NULL-gameweek fixture excluded by the MIN
    r = [x for x in per_player[1] if x.next_venue == "HOME"][0]
    assert r.fixture_difficulty == 2 and r.captaincy_score == round(6.0 * 2 + 6.0 * 1.5 + 0.7 * 3 + 400 * 0.05 + 6, 2)


def test_captaincy_of_one_large_team_is_many_tasks(spark):
    """A team's result is the product of its players and fixtures, so one task mustn't make it."""
    players = [(k if k != 7 else None, f"F{k}", f"D{k}", 1, "T1", "MID", 5.0, k / 7, k / 3, k, 1.5, G.AVAILABLE, 270 if k % 2 else 269,
                k, 1, 0.1, 1.0, k / 9 if k % 5 else None, 2, 0.3) for k in [*range(90), 11]]  # a null and a repeated player
    overview = spark.createDataFrame(players, "player_id long, full_name string, display_name string, team_id long, team_name string, position string,"
                                     "current_price double, form double, points_per_game double, total_points long, ownership_pct double, availability_label string,"
                                     "minutes long, goals_scored long, assists long, xgi double, ict_index double, threat double, bonus long, bonus_per_start double").coalesce(1)
    fixtures = [(3, 1, f"H{k % 4}", None if k % 6 == 0 else k % 5 + 1, 1 if k % 50 == 0 else None, f"A{k % 3}", 2, None if k % 9 == 0 else False) for k in range(2 * G.LIST_ROWS * 6)]
    fixtures += [(4, 1, "H", 1, 2, "A", 1, False), (2, 1, "H", 1, 2, "A", 1, True), (None, 1, "H", 1, 2, "A", 1, False)]
    table = spark.createDataFrame(fixtures, "gameweek long, home_team_id long, home_team string, home_difficulty long, away_team_id long, away_team string, away_difficulty long, is_finished boolean").coalesce(1)
    sides = G.next_period_fixtures(table)
    assert sides.count() > 6 * G.LIST_ROWS
    chosen = overview.where("minutes >= 270")
    plain = (chosen.join(sides.withColumnRenamed("team_id", "t"), F.col("team_id") == F.col("t"))
             .select("player_id", "opponent", "venue", "difficulty", "gameweek",
                     F.round(F.col("form") * 2.0 + F.col("points_per_game") * 1.5 + F.col("bonus_per_start") * 3.0 + F.col("threat") * 0.05 + (F.lit(5) - F.col("difficulty")).cast("double") * 2.0, 2).alias("score")))
    got = G.captaincy_picks(overview, table)
    some = got.select("player_id", "next_opponent", "next_venue", "fixture_difficulty", "next_gameweek", "captaincy_score")
    assert some.exceptAll(plain).isEmpty() and plain.exceptAll(some).isEmpty() and got.count() == plain.count() > 100_000
    assert got.groupBy(F.spark_partition_id()).count().count() > 3


def test_team_overview_totals(silver):
    to = by_id(G.team_overview(silver["teams"], silver["fixtures"]), "team_id")
    assert (to[1].total_goals_scored, to[1].total_goals_conceded, to[1].total_clean_sheets) == (5, 0, 2)
    assert to[1].goal_difference == 5 and to[1].avg_goals_scored_per_match == 0.5
    assert to[3].avg_goals_scored_per_match is None          # matches_played 0
    assert to[4].avg_goals_scored_per_match is None          # matches_played NULL
    assert (to[2].home_goals_scored, to[2].away_goals_scored) == (0, 0)


def test_gameweek_summary_names(silver):
    gs = by_id(G.gameweek_summary(silver["gameweeks"], silver["players"]), "gameweek_id")
    assert gs[1].most_captained_player == "P2" and gs[1].top_scorer_player is None
    assert gs[3].most_captained_player == "P7"


def test_differential_picks(silver):
    dp = by_id(G.differential_picks(G.player_overview(silver["players"])), "player_id")
    assert 4 not in dp and 1 in dp and dp[1].diff_rank_in_position == 1


def test_fixture_difficulty_next_five(silver):
    fd = G.fixture_difficulty(silver["fixtures"]).collect()
    team1 = sorted((r for r in fd if r.team_id == 1), key=lambda r: r.fixture_order)
    assert [r.fixture_order for r in team1] == [1, 2, 3, 4, 5]
    assert team1[0].gameweek is None                         # NULL sorts first
    assert {r.fixture for r in team1 if r.gameweek == 3} == {"BRE (H)", "BRE (A)"}
    labels = {(r.team_id, r.gameweek, r.fixture): r.difficulty_label for r in fd}
    assert labels[(1, 3, "BRE (H)")] == "EASY" and labels[(2, 3, "ARS (A)")] == "HARD"
