"""Hand-made bronze rows in the football schemas (edge cases of FIXTURES.md §C)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from aurum.sources import schemas as SC

def clock():
    return F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")


def frame(spark, schema, rows):
    names = schema.fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def player(i, team, **kw):
    base = dict(id=i, team=team, element_type=3, now_cost=80, cost_change_start=2, cost_change_event=-1,
                transfers_in_event=10, transfers_out_event=4, transfers_in=100, transfers_out=50,
                total_points=120, event_points=6, minutes=900, starts=10, goals_scored=5, assists=3,
                clean_sheets=2, goals_conceded=8, own_goals=0, penalties_saved=0, penalties_missed=0,
                yellow_cards=1, red_cards=0, saves=0, bonus=7, bps=200, chance_of_playing_next_round=100,
                dreamteam_count=1, first_name="First", second_name=f"Last{i}", web_name=f"P{i}", status="a",
                news="", selected_by_percent="5.5", points_per_game="6.0", form="4.5", value_form="0.5",
                value_season="15.0", influence="300.2", creativity="150.5", threat="400.0", ict_index="85.1",
                expected_goals="4.20", expected_assists="2.10", expected_goal_involvements="6.30",
                expected_goals_conceded="7.00", in_dreamteam=False)
    base.update(kw)
    return base


def team(i, name, short, **kw):
    base = dict(id=i, code=100 + i, position=i, played=10, win=5, draw=3, loss=2, points=18, strength=4,
                strength_overall_home=1200, strength_overall_away=1180, strength_attack_home=1150,
                strength_attack_away=1140, strength_defence_home=1160, strength_defence_away=1170,
                name=name, short_name=short, form="2.5")
    base.update(kw)
    return base


def fixture(i, gw, h, a, hs=None, as_=None, finished=False, hd=3, ad=3):
    return dict(id=i, code=1000 + i, event=gw, team_h=h, team_a=a, team_h_score=hs, team_a_score=as_,
                team_h_difficulty=hd, team_a_difficulty=ad, minutes=90 if finished else 0,
                kickoff_time=dt.datetime(2025, 8, 1) + dt.timedelta(days=7 * (gw or 0)),
                finished=finished, started=finished)


def gameweek(i, finished, checked=None, current=False, **kw):
    base = dict(id=i, name=f"Gameweek {i}", deadline_time=dt.datetime(2025, 8, 1) + dt.timedelta(days=7 * i),
                finished=finished, data_checked=finished if checked is None else checked, is_previous=False,
                is_current=current, is_next=False, average_entry_score=50, highest_score=120, ranked_count=1000,
                most_selected=1, most_captained=2, most_vice_captained=3, most_transferred_in=4,
                top_element=99, transfers_made=12345)
    base.update(kw)
    return base


def live(pid, gw, minutes=90, points=6, **kw):
    base = dict(id=pid, gameweek=gw, minutes=minutes, starts=1 if minutes else 0, goals_scored=1, assists=0,
                clean_sheets=0, goals_conceded=1, own_goals=0, penalties_saved=0, penalties_missed=0,
                yellow_cards=0, red_cards=0, saves=0, bonus=1, bps=20, total_points=points, influence="20.2",
                creativity="10.0", threat="30.0", ict_index="6.1", expected_goals="0.45", expected_assists="0.10",
                expected_goal_involvements="0.55", expected_goals_conceded="1.20", in_dreamteam=False)
    base.update(kw)
    return base


def season(spark):
    teams = frame(spark, SC.TEAMS, [team(1, "Arsenal", "ARS"), team(2, "Brentford", "BRE"),
                                    team(3, "Chelsea", "CHE", played=0), team(4, "Dover", "DOV", played=None)])
    players = frame(spark, SC.PLAYERS, [
        player(1, 1, total_points=150, now_cost=100, form="6.0"),
        player(2, 1, element_type=5, status="x", form="1d", first_name=None),
        player(3, 99, status=None, now_cost=0, minutes=0, starts=0),
        player(4, 2, element_type=1, total_points=90, now_cost=45, selected_by_percent="25.0"),
        player(5, 2, element_type=1, total_points=90, now_cost=45),
        player(6, 3, element_type=4, minutes=None, starts=None, now_cost=None),
        player(7, 2, element_type=None, total_points=50),
    ])
    fixtures = frame(spark, SC.FIXTURES, [
        fixture(1, 1, 1, 2, 2, 0, True), fixture(2, 1, 3, 4, 1, 1, True), fixture(3, 2, 2, 1, 0, 3, True),
        fixture(4, 2, 1, 3, None, None, True), fixture(5, 3, 1, 2, hd=2, ad=4), fixture(6, 3, 2, 1, hd=5, ad=1),
        fixture(7, None, 3, 1), fixture(8, 4, 4, 2), fixture(9, 5, 1, 4), fixture(10, 6, 1, 3),
        fixture(11, 7, 2, 1), fixture(12, 8, 1, 2),
        dict(fixture(13, 3, 4, 3), finished=None),
    ])
    gameweeks = frame(spark, SC.GAMEWEEKS, [gameweek(1, True), gameweek(2, True, current=True),
                                            gameweek(3, False, most_captained=7)])
    lives = frame(spark, SC.LIVE, [live(1, 1, points=10), live(1, 2, points=3), live(2, 1, minutes=0, points=0),
                                   live(2, 2, minutes=0, points=0), live(4, 1, points=7), live(4, 2, points=8),
                                   live(5, 2, minutes=None, points=15), live(1, 3, points=99)])
    return dict(teams=teams, players=players, fixtures=fixtures, gameweeks=gameweeks, live=lives)
