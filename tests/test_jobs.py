"""End-to-end run of the medallion jobs on hand-made football documents."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from aurum.plans import jobs as J
from aurum.session import local_path
from aurum.sources import schemas as SC
from tests.football import clock, fixture, gameweek, live, player, team


def dump(path, obj, name="doc.json"):
    p = local_path(path)
    os.makedirs(p, exist_ok=True)
    with open(os.path.join(p, name), "w") as f:
        json.dump(obj, f, default=str)


def jsonable(rows):
    return [{k: (v.isoformat() if isinstance(v, dt.datetime) else v) for k, v in r.items()} for r in rows]


def test_full_refresh_landing_to_gold(spark, scratch):
    doc, fx, live_docs = scratch("season"), scratch("fixtures"), scratch("live-docs")
    landing, silver, audit = scratch("landing"), scratch("silver"), scratch("audit")
    players = [player(1, 1, total_points=150, now_cost=100), player(2, 2, status="i"), player(3, 2)]
    dump(doc, {"elements": jsonable(players), "element_types": [{"id": 1, "singular_name_short": "GKP"}],
               "teams": jsonable([team(1, "Arsenal", "ARS"), team(2, "Brentford", "BRE")]),
               "events": jsonable([gameweek(1, True), gameweek(2, False, current=True)])})
    dump(fx, jsonable([fixture(1, 1, 1, 2, 2, 1, True), fixture(2, 2, 2, 1)]))
    for gw in (1, 2):
        elems = [{"id": r["id"], "stats": {k: v for k, v in r.items() if k not in ("id", "gameweek")}}
                 for r in [live(1, gw, points=5 + gw), live(3, gw, points=2)]]
        dump(f"{live_docs}/gameweek={gw}", {"elements": elems})

    assert set(J.ensure_layers(spark, "t_")) == {"t_bronze", "t_silver", "t_gold"}
    cfg = spark.createDataFrame([("feed", "players", "full", "1"), ("feed", "teams", "full", "1"),
                                 ("feed", "gameweeks", "full", "1"), ("feed", "fixtures", "full", "1"),
                                 ("feed", "positions", "full", "1"), ("feed", "gameweek_live", "incremental", "1")],
                                SC.CONFIG)
    day = dt.date(2026, 1, 5)

    def season_table(name):
        return lambda load_type, last, current: J.land_season(spark, doc, fx, landing, day, [name])[name]

    extractors = {t: season_table(t) for t in ["players", "teams", "gameweeks", "fixtures", "positions"]}
    extractors["gameweek_live"] = lambda load_type, last, current: J.land_live(spark, live_docs, landing, day,
                                                                               last + 1, current)
    counts = J.run_loads(spark, cfg, "feed", extractors, audit, current=2, final=1, clock=clock())
    assert counts == {"players": 3, "teams": 2, "gameweeks": 2, "fixtures": 2, "positions": 1, "gameweek_live": 4}
    marks = {r.tablename: r.load_watermark for r in spark.read.parquet(audit).collect()}
    assert marks["gameweek_live"] == "1" and marks["players"] == "2"
    # nothing new: no audit row, watermark unchanged
    assert J.run_loads(spark, cfg.where("table_name = 'gameweek_live'"), "feed",
                       {"gameweek_live": lambda lt, last, cur: 0}, audit, 2, 1, clock()) == {"gameweek_live": 0}
    live_rows = [r for r in spark.read.parquet(audit).collect() if r.tablename == "gameweek_live"]
    assert sorted((r.status, r.load_watermark) for r in live_rows) == [("SUCCESS", "1")]

    bronze = J.bronze_views(spark, landing)
    assert spark.table("bronze_players").count() == 3
    tables = J.refresh_silver(spark, bronze, silver, clock(), database="t_silver", landing=landing)
    gold = J.publish_gold(J.read_silver(spark, tables))
    assert spark.table("gold_player_overview").count() == 3
    cap = spark.table("gold_captaincy_picks").collect()
    assert {(r.player_id, r.next_gameweek) for r in cap} == {(1, 2), (3, 2)}
    form = {r.player_id: r.points_last_5 for r in gold["form_players"].collect()}
    assert form == {1: 6, 3: 2}
    # a second run re-pulls the open period with corrected values: upserted, not duplicated
    for gw in (2,):
        elems = [{"id": 1, "stats": {k: v for k, v in live(1, gw, points=40).items() if k not in ("id", "gameweek")}}]
        dump(f"{live_docs}/gameweek={gw}", {"elements": elems})
    landed = J.land_live(spark, live_docs, landing, dt.date(2026, 1, 6), 2, 2)
    assert (landed, landed.loaded_to, landed.rejected) == (1, 2, 0)
    J.refresh_silver(spark, J.bronze_views(spark, landing), silver, clock(), database="t_silver", landing=landing)
    lv = spark.table("t_silver.gameweek_live")
    assert lv.count() == 4
    assert lv.where((F.col("player_id") == 1) & (F.col("gameweek") == 2)).first().total_points == 40


def test_command_line_refresh_and_gold(spark, scratch, capsys):
    from aurum.__main__ import main
    doc, fx, live_docs = scratch("season"), scratch("fixtures"), scratch("live-docs")
    landing, silver, audit, cfg = scratch("landing"), scratch("silver"), scratch("audit"), scratch("config")
    dump(doc, {"elements": jsonable([player(1, 1), player(2, 1, status="d")]),
               "element_types": [{"id": 1}],
               "teams": jsonable([team(1, "Arsenal", "ARS"), team(2, "Brentford", "BRE")]),
               "events": jsonable([gameweek(1, True), gameweek(2, False, current=True)])})
    dump(fx, jsonable([fixture(1, 1, 1, 2, 1, 0, True), fixture(2, 2, 2, 1)]))
    dump(f"{live_docs}/gameweek=1", {"elements": [{"id": 1, "stats": {"minutes": 90, "total_points": 8}}]})
    os.makedirs(local_path(cfg), exist_ok=True)
    with open(os.path.join(local_path(cfg), "tables.csv"), "w") as f:
        f.write("datasource,table_name,load_type,is_active\n"
                + "\n".join(f"season-api,{t},full,1" for t in ["players", "teams", "fixtures", "gameweeks"])
                + "\nseason-api,gameweek_live,incremental,1\nseason-api,positions,full,0\n")
    main(["land", "--season", doc, "--fixtures", fx, "--live", live_docs, "--landing", landing,
          "--config", cfg, "--audit", audit])
    main(["refresh", "--landing", landing, "--silver", silver])
    main(["gold", "--silver", silver, "--show", "captaincy_picks"])
    out = capsys.readouterr().out
    assert "players: 2 records" in out and "gameweek_live: 1 records" in out
    assert "next_opponent" in out and "Brentford" in out and "AWAY" in out   # player 1 plays away at Brentford
    assert "Last2" not in out                                                # player 2 is doubtful


def test_failures_are_isolated_per_table(spark, scratch):
    import pytest

    cfg = spark.createDataFrame([("feed", "players", "full", "1"), ("feed", "teams", "full", "1")], SC.CONFIG)
    audit = scratch("audit")

    def boom(*_):
        raise RuntimeError("feed unavailable")

    counts = J.run_loads(spark, cfg, "feed", {"players": boom, "teams": lambda *_: 3}, audit, 2, 1, clock())
    assert counts == {"players": None, "teams": 3}
    assert [r.tablename for r in spark.read.parquet(audit).collect()] == ["teams"]

    bronze = {t: spark.createDataFrame([], s) for t, s in SC.BRONZE.items()}
    bronze["gameweek_live"] = bronze["gameweek_live"].withColumn("landed_on", F.lit(None).cast("date"))
    bronze["players"] = bronze["players"].drop("web_name")           # a broken feed: players fails
    with pytest.raises(J.PartialFailure) as err:
        J.refresh_silver(spark, bronze, scratch("silver"), clock(), database="t_failing")
    assert set(err.value.failed) == {"players"}
    assert set(err.value.done) == {"teams", "gameweeks", "fixtures", "gameweek_live"}


def test_watermark_stops_at_a_missing_period(spark, scratch):
    for periods, first, end in (([1, 3, 4], 1, 1), ([2, 3], 1, 0), ([5, 6, 7, 7], 5, 7), ([], 4, 3)):
        assert J.contiguous_end(spark.createDataFrame([(p,) for p in periods], "gameweek long"), first) == end
    live_docs, landing, audit = scratch("live-docs"), scratch("landing"), scratch("audit")
    for gw in (1, 3):      # period 2 failed upstream: no document
        dump(f"{live_docs}/gameweek={gw}", {"elements": [{"id": 1, "stats": {"minutes": 90}}]})
    cfg = spark.createDataFrame([("feed", "gameweek_live", "incremental", "1")], SC.CONFIG)
    ext = {"gameweek_live": lambda lt, last, cur: J.land_live(spark, live_docs, landing, dt.date(2026, 1, 5),
                                                              last + 1, cur)}
    assert J.run_loads(spark, cfg, "feed", ext, audit, current=3, final=3, clock=clock()) == {"gameweek_live": 2}
    assert [r.load_watermark for r in spark.read.parquet(audit).collect()] == ["1"]
