"""Documents read in parallel and whole, quarantine, drift, lasting tables, incremental refresh."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aurum.operators.merge import MergeError, merge_upsert
from aurum.plans import jobs as J
from aurum.session import local_path
from aurum.sinks import versions as VS
from aurum.sinks import writers as WR
from aurum.sources import documents as DOC
from aurum.sources import landed as LD
from aurum.sources import schemas as SC
from aurum.streaming.live_ingest import ingest_live
from tests.football import clock, frame, live, player, team
from tests.test_jobs import dump, jsonable


def write(path, text, name="a.json"):
    os.makedirs(local_path(path), exist_ok=True)
    with open(os.path.join(local_path(path), name), "w") as f:
        f.write(text)


@pytest.fixture
def splits(spark):
    """Sets the size of the byte ranges that a file is dealt in."""
    keys = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = {k: spark.conf.get(k) for k in keys}

    def to(size):
        spark.conf.set(keys[0], size)
        spark.conf.set(keys[1], "0")
    yield to
    for k, v in before.items():
        spark.conf.set(k, v)


def season(rnd, n):
    def element(i):
        return {"id": i, "s": "".join(rnd.choice('ab}{][":,\\é😀 \n') for _ in range(rnd.randint(0, 30))),
                "elements": [{"x": 1}, [{"y": "}"}]], "o": {"elements": [{"z": 2}]}, "n": i / 7}
    return {"events": [element(i) for i in range(rnd.randint(0, 30))], "total": 5, "sub": {"elements": [{"no": 1}]},
            "na}me": [1, [{"q": 1}]], "elements": [element(i) for i in range(n)], "teams": None, "last": []}


def by_key(df):
    found = {}
    for r in df.collect():
        found.setdefault((os.path.basename(r.source_file), r.array_key), []).append(json.dumps(json.loads(r.raw), sort_keys=True))
    return {k: sorted(v) for k, v in found.items()}


@pytest.mark.parametrize("size", ["128m", "2000b", "701b"])
def test_documents_give_their_elements_however_they_are_split(spark, scratch, splits, size):
    rnd, path = random.Random(3), scratch("docs")
    docs = {f"d{k}.json": season(rnd, 5 + 20 * k) for k in range(3)}
    for k, (name, doc) in enumerate(docs.items()):
        write(path, json.dumps(doc, indent=(None, 1)[k % 2], ensure_ascii=bool(k % 3)) + "\n" * (k % 2), name)
    write(path, json.dumps(docs["d2.json"])[:3000], "cut.json")
    write(path, "", "empty.json")
    write(path, '{"elements":[{"id":1},{"id":2}}]', "crossed.json")
    write(path, '{"elements":[{"id":1},{"id":},{"id":2}]}', "broken.json")
    splits(size)
    got = DOC.read_elements(spark, path, ["elements", "events"])
    want = {(n, k): sorted(json.dumps(e, sort_keys=True) for e in d[k]) for n, d in docs.items() for k in ("elements", "events") if d[k]}
    want["broken.json", "elements"] = ['{"id": 1}', '{"id": 2}']
    assert by_key(got.elements) == want
    bad = {(os.path.basename(r.source_file), r.reason) for r in got.rejects.collect()}
    assert bad == {("cut.json", "truncated document"), ("empty.json", "empty document"), ("crossed.json", "unbalanced document"),
                   ("broken.json", "malformed element")}


def test_a_large_document_is_read_by_many_tasks(spark, scratch, splits):
    path, n = scratch("large"), 60_000
    row = {"id": 0, "name": "some {name}", "stats": {"minutes": 90, "list": [1, 2, {"a": "]"}]}}
    write(path, json.dumps([{**row, "id": i} for i in range(n)]))
    splits("256k")
    got = DOC.read_elements(spark, path).elements
    assert spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions() >= 16
    ids = got.select(F.get_json_object("raw", "$.id").cast("long").alias("id"), F.get_json_object("raw", "$.stats.list[2].a").alias("a"))
    assert ids.agg(F.count("id"), F.sum("id"), F.count_distinct("id"), F.count_if(F.col("a") == "]")).first()[:] == (n, n * (n - 1) // 2, n, n)


def test_landing_keeps_every_field_and_accounts_for_the_rest(spark, scratch):
    doc, fx, live_docs, landing, audit = (scratch(n) for n in ("season", "fixtures", "live-docs", "landing", "audit"))
    players = [{**p, "photo": f"{p['id']}.jpg", "extra": {"a": [1, {"b": None}]}} for p in jsonable([player(1, 1), player(2, 1)])]
    players.append({**players[0], "id": "three"})
    dump(doc, {"elements": players, "teams": jsonable([team(1, "Arsenal", "ARS")]), "events": [
        {"id": 1, "deadline_time": "2025-08-15T18:30:00+01:00"}, {"id": 2, "deadline_time": "2025-08-22T18:30:00.250Z"}]})
    write(fx, '[{"id": 1, "kickoff_time": "2025-08-15T19:00:00-05:00"}, {"id": 2')  # cut off
    day = dt.date(2026, 1, 5)
    dump(f"{live_docs}/gameweek=1", {"elements": [{"id": 7, "total_points": -1, "modified": True, "explain": [{"fixture": 3}],
                                                   "stats": {"minutes": 90, "total_points": 12, "new_stat": 1.5}}]})
    write(f"{live_docs}/gameweek=2", '{"elements": [{"id": 7, "stats": {"minutes"')
    season_tables = J.read_season(spark, doc)
    ext = {t: lambda lt, last, cur, t=t: J.land_season(spark, doc, fx, landing, day, [t], season_tables)[t] for t in ("players", "gameweeks", "fixtures")}
    ext["gameweek_live"] = lambda lt, last, cur: J.land_live(spark, live_docs, landing, day, last + 1, cur)
    cfg = spark.createDataFrame([("feed", t, "incremental" if t == "gameweek_live" else "full", "1") for t in ext], SC.CONFIG)
    assert J.run_loads(spark, cfg, "feed", ext, audit, 2, 2, clock()) == {"players": 3, "gameweeks": 2, "fixtures": 0, "gameweek_live": 1}
    rows = {(r.tablename, r.status): (r.record_count, r.load_watermark) for r in spark.read.parquet(audit).collect()}
    # the cut file itself, and what was found in it: a whole element and a piece
    assert rows[("fixtures", "REJECTED")] == (3, None) and rows[("fixtures", "EMPTY")] == (0, None)
    assert rows[("gameweek_live", "SUCCESS")] == (1, "1") and ("gameweek_live", "REJECTED") in rows and ("players", "REJECTED") not in rows
    kept = WR.read_rejects(spark, J.rejects_path(landing))
    assert {(r.table_name, r.reason) for r in kept.collect()} == {("fixtures", "truncated document"), ("gameweek_live", "truncated document")}
    before = kept.count()
    J.land_season(spark, doc, fx, landing, day, ["fixtures"])  # the same day again replaces its rejects
    assert WR.read_rejects(spark, J.rejects_path(landing)).count() == before

    bronze = J.bronze_views(spark, landing, "kept_")
    whole = bronze["players"].select("id", F.variant_get("doc", "$.photo", "string"), F.variant_get("doc", "$.extra.a[0]", "int")).collect()
    assert sorted(map(tuple, whole)) == [(1, "1.jpg", 1), (2, "2.jpg", 1)]
    assert [(r.table_name, r.reason) for r in J.bronze_rejects(spark, landing).collect()] == [("players", LD.MISFIT)]
    times = {r.id: r.deadline_time for r in bronze["gameweeks"].collect()}
    assert times == {1: dt.datetime(2025, 8, 15, 17, 30), 2: dt.datetime(2025, 8, 22, 18, 30, 0, 250_000)}
    one = bronze["gameweek_live"].select("id", "gameweek", "minutes", "total_points", F.variant_get("doc", "$.new_stat", "double"),
                                         F.variant_get("doc", "$.modified", "boolean"), F.variant_get("doc", "$.explain[0].fixture", "int")).collect()
    assert [tuple(r) for r in one] == [(7, 1, 90, 12, 1.5, True, 3)]
    drift = {r.field: (r.status, r["rows"], r.types) for r in LD.schema_drift(J.bronze_lines(spark, landing, "players"), SC.PLAYERS).collect()}
    assert drift["photo"] == ("undeclared", 3, "STRING") and drift["extra"] == ("undeclared", 3, "OBJECT") and drift["id"] == ("declared", 3, "BIGINT,STRING")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_offsets_are_read_in_any_session_zone(spark, scratch, zone):
    path, before = scratch("times"), spark.conf.get("spark.sql.session.timeZone")
    write(path, "\n".join('{"t": "%s"}' % t for t in ("2025-11-02T01:30:00-04:00", "2025-11-02T05:30:00Z", "2025-11-02T05:30:00", "2025-11-02T07:00:00.000+01:30")))
    schema = T.StructType([T.StructField("t", T.TimestampNTZType())])
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        from aurum.sources import readers as RD
        for df in (RD.read_json_lines(spark, path, schema), LD.read_lines(spark, [path], schema)):
            assert {r.t for r in df.collect()} == {dt.datetime(2025, 11, 2, 5, 30)}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_latest_landing_is_found_by_listing(spark, scratch):
    base = scratch("landing")
    for day in (dt.date(2025, 12, 31), dt.date(2026, 1, 2), dt.date(2026, 1, 1)):
        WR.write_landing(spark.createDataFrame([('{"id": %d}' % day.day,)], "raw string"), base, "teams", day, fmt="text")
    write(f"{base}/teams", '{"id": 99}', "undated.json")
    paths = LD.latest_landing(spark, f"{base}/teams")
    assert [os.path.basename(p) for p in paths] == ["load_key=teams_02012026", "undated.json"]
    df = LD.read_lines(spark, paths, T.StructType([T.StructField("id", T.LongType())]))
    assert sorted(r.id for r in df.collect()) == [2, 99]
    assert len(df.inputFiles()) == 2  # one scan of the latest day, older ones aren't opened


def test_superseded_landings_are_archived_after_a_load(spark, scratch):
    landing, archive, audit = scratch("landing"), scratch("archive"), scratch("audit")
    cfg = spark.createDataFrame([("feed", "teams", "full", "1"), ("feed", "gameweek_live", "incremental", "1")], SC.CONFIG)

    def load(day, n):
        rows = spark.createDataFrame([('{"id": %d}' % k,) for k in range(n)], "raw string")
        ext = {t: lambda *_, t=t: WR.write_landing(rows, landing, t, dt.date(2026, 1, day), fmt="text") for t in ("teams", "gameweek_live")}
        J.run_loads(spark, cfg, "feed", ext, audit, 1, 1, clock(), landing, archive)

    load(1, 3)
    load(2, 4)
    load(3, 0)   # nothing landed: nothing moves
    assert sorted(LD.landing_days(spark, f"{landing}/teams").values()) == ["20260102"]
    assert sorted(LD.landing_days(spark, f"{landing}/gameweek_live").values()) == ["20260101", "20260102"]
    load(1, 2)   # an older day landed late is archived at once, in place of its earlier copy
    old = spark.read.text(f"{archive}/teams/2026/01/01/*")
    assert old.count() == 2 and sorted(LD.landing_days(spark, f"{landing}/teams").values()) == ["20260102"]


def test_views_outlive_a_refresh_in_every_session(spark, scratch):
    base, name = scratch("versions"), "lasting_t"
    VS.replace(spark, spark.range(3).withColumn("v", F.lit("old")), name, base)
    df = VS.read(spark, name)
    df.groupBy("v").count().createOrReplaceTempView("lasting_v")
    df.groupBy("v").count().createOrReplaceGlobalTempView("lasting_v")
    first = VS.complete_versions(spark, base)[0]
    VS.replace(spark, spark.range(5).withColumn("v", F.lit("new")), name, base)
    VS.replace(spark, spark.range(5).withColumn("v", F.lit("new")), name, base)
    assert VS.drop_old(spark, name, base, keep=1) and not os.path.exists(local_path(first))
    other = spark.newSession()
    for got in (spark.table("lasting_v"), other.table("global_temp.lasting_v"), other.table(name).groupBy("v").count()):
        assert [tuple(r) for r in got.collect()] == [("new", 5)]
    # an application without that catalog finds the newest complete version in the folder
    broken = VS.new_version(base)
    write(broken, "left by a write that failed")
    spark.sql(f"DROP TABLE {name}")
    assert VS.attach(spark, name, base) and VS.read(spark, name).count() == 5 and df.count() == 5
    assert not VS.attach(spark, "lasting_none", scratch("nothing"))


def test_refresh_merges_only_new_landings(spark, scratch):
    landing, silver, table = scratch("landing"), scratch("silver"), "live_incremental"
    stamp = [F.lit(f"2026-02-0{k} 00:00:00").cast("timestamp_ntz") for k in range(1, 6)]

    def land(day, *rows):
        WR.write_landing(frame(spark, SC.LIVE, rows), landing, "gameweek_live", dt.date(2026, 1, day))

    def state():
        return sorted((r.player_id, r.gameweek, r.total_points, r.loaded_at.day) for r in VS.read(spark, table).collect())

    J.refresh_live(spark, landing, silver, table, stamp[0])  # before the first landing: an empty, readable table
    assert state() == []
    land(2, live(1, 1, points=5), live(2, 1, points=6), live(1, 2, points=7))
    J.refresh_live(spark, landing, silver, table, stamp[0])
    versions = VS.complete_versions(spark, f"{silver}/gameweek_live")
    assert J.refresh_live(spark, landing, silver, table, stamp[1]) == {"source_rows": 0, "kept_rows": 0}
    assert VS.complete_versions(spark, f"{silver}/gameweek_live") == versions
    land(4, live(1, 2, points=70))
    J.refresh_live(spark, landing, silver, table, stamp[2])
    assert state() == [(1, 1, 5, 1), (1, 2, 70, 3), (2, 1, 6, 1)]
    land(3, live(1, 2, points=8), live(3, 2, points=9))      # a day that arrives late loses to the later one
    J.refresh_live(spark, landing, silver, table, stamp[3])
    assert state() == [(1, 1, 5, 1), (1, 2, 70, 4), (2, 1, 6, 1), (3, 2, 9, 4)]
    land(4, live(1, 2, points=71))                           # a day landed again
    J.refresh_live(spark, landing, silver, table, stamp[4])
    assert state() == [(1, 1, 5, 1), (1, 2, 71, 5), (2, 1, 6, 1), (3, 2, 9, 4)]
    spark.sql(f"DROP TABLE {table}")                         # a new application: each period's newest version
    VS.attach(spark, table, f"{silver}/gameweek_live", J._live_schema(spark), "gameweek")
    assert state() == [(1, 1, 5, 1), (1, 2, 71, 5), (2, 1, 6, 1), (3, 2, 9, 4)]


def test_files_of_a_period_stay_few_after_many_upserts(spark, scratch):
    base, table = scratch("many"), "live_many"
    for k in range(12):
        rows = spark.createDataFrame([(k, 1, float(k)), (0, 1 + k % 2, 1.0)] if k else [(0, 1, 0.0)], "player_id long, gameweek long, v double")
        J.merge_live(spark, rows.dropDuplicates(["player_id", "gameweek"]), table, base)
    files = [f for f in VS.read(spark, table).where("gameweek = 1").select(F.input_file_name()).distinct().collect()]
    assert len(files) <= int(spark.conf.get("spark.sql.shuffle.partitions")) and VS.read(spark, table).where("gameweek = 1").count() == 12


def test_upsert_never_drops_a_null_period(spark, scratch):
    rows = spark.createDataFrame([(1, None), (2, 5)], "player_id long, gameweek long")
    for validate in (True, False):
        with pytest.raises(MergeError, match="NULL"):
            merge_upsert(spark, scratch("nulls"), rows, ["player_id", "gameweek"], "gameweek", validate=validate)


def test_stream_goes_on_after_bad_lines(spark, scratch):
    land, target, ckpt = scratch("land"), scratch("target"), scratch("ckpt")
    WR.write_landing(frame(spark, SC.LIVE, [live(1, 1, points=5)]), land, "gameweek_live", dt.date(2026, 1, 1))
    write(f"{land}/gameweek_live/load_key=gameweek_live_02012026", '{"id": 2, "gameweek"\n{"id": "x", "gameweek": 1}\n{"gameweek": 1}\n\n[1]\n', "bad.json")
    ingest_live(spark, f"{land}/gameweek_live", target, ckpt, loaded_at=clock())
    WR.write_landing(frame(spark, SC.LIVE, [live(3, 1, points=9)]), land, "gameweek_live", dt.date(2026, 1, 3))
    ingest_live(spark, f"{land}/gameweek_live", target, ckpt, loaded_at=clock())
    assert sorted((r.player_id, r.total_points) for r in spark.read.parquet(target).collect()) == [(1, 5), (3, 9)]
    reasons = sorted(r.reason for r in WR.read_rejects(spark, f"{ckpt}-rejects").collect())
    assert reasons == sorted([LD.MALFORMED, LD.MALFORMED, LD.MISFIT, "line without a key"])


def test_lines_are_parsed_once(spark):
    """Filters on parsed columns stay above the parsers, and every kind of line keeps its reason."""
    raws = ['{"id":1,"gameweek":2}', ' {"id":1,"gameweek":2}', '{"id":"x","gameweek":2}', '[{"id":1}]', '{"id":1,"id":2}', '{"id":1', "7", None]
    df = LD.declared(spark.createDataFrame([(r,) for r in raws], "raw string"), SC.LIVE)
    assert [r.reject_reason for r in df.collect()] == [None, None, LD.MISFIT, *[LD.MALFORMED] * 5]
    good = df.where("reject_reason is null and id is not null and gameweek is not null")
    plan = good.select("id", "gameweek", "minutes")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1 and good.count() == 2
