import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aurum.session import local_path
from aurum.sinks import writers as WR
from aurum.sources import readers as RD
from aurum.sources import schemas as SC
from aurum.streaming.live_ingest import ingest_live
from tests.football import clock, frame, live


def write_lines(path, lines, name="part-0.json"):
    p = local_path(path)
    os.makedirs(p, exist_ok=True)
    with open(os.path.join(p, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_json_lines_missing_path_and_corrupt_rows(spark, scratch):
    assert RD.read_json_lines(spark, scratch("nothing"), SC.TEAMS).count() == 0
    path = scratch("teams")
    write_lines(path, [json.dumps({"id": 1, "name": "A", "extra": 5}), "{not json"])
    df = RD.read_json_lines(spark, path, SC.TEAMS, keep_corrupt=True).cache()
    assert df.count() == 2
    assert df.where(F.col("_corrupt_record").isNotNull()).count() == 1
    assert "_corrupt_record" not in SC.TEAMS.fieldNames()


def test_payload_explode_missing_key_gives_no_rows(spark, scratch):
    path = scratch("docs")
    write_lines(path, [json.dumps({"elements": [{"id": 1, "name": "A"}, {"id": 2, "name": "B"}], "teams": []}),
                       json.dumps({"events": [{"id": 9}]}), json.dumps({"elements": None})])
    out = RD.explode_payload(spark, path, "elements", SC.TEAMS)
    assert sorted(r.id for r in out.collect()) == [1, 2]
    assert RD.explode_payload(spark, path, "element_types", SC.POSITIONS).count() == 0


def test_root_array_and_period_filter(spark, scratch):
    path = scratch("fixtures")
    write_lines(path, [json.dumps([{"id": 1, "event": 1}, {"id": 2, "event": 2}]), json.dumps([{"id": 3, "event": 2}])])
    assert RD.read_root_array(spark, path, SC.FIXTURES).count() == 3
    assert sorted(r.id for r in RD.read_root_array(spark, path, SC.FIXTURES, period=2).collect()) == [2, 3]


def test_live_documents_flatten_with_literal_period(spark, scratch):
    path = scratch("live")
    doc = {"elements": [{"id": 7, "total_points": -1, "stats": {"minutes": 90, "total_points": 12}, "explain": []}]}
    write_lines(path, [json.dumps(doc)])
    out = RD.read_live_documents(spark, path, SC.LIVE_ELEMENT, period=5).first()
    assert (out.id, out.gameweek, out.minutes, out.total_points) == (7, 5, 90, 12)


def test_streaming_ingest_dedupes_and_skips_processed_files(spark, scratch):
    land, target, ckpt = scratch("land"), scratch("target"), scratch("ckpt")
    first = frame(spark, SC.LIVE, [live(1, 1, points=5), live(2, 1, points=6)])
    WR.write_landing(first, land, "gameweek_live", dt.date(2026, 1, 1))
    WR.write_landing(frame(spark, SC.LIVE, [live(1, 1, points=50)]), land, "gameweek_live", dt.date(2026, 1, 3))
    ingest_live(spark, f"{land}/gameweek_live", target, ckpt, loaded_at=clock())

    def points():
        t = spark.read.parquet(target)
        return sorted((r.player_id, r.gameweek, r.total_points) for r in t.collect())

    assert points() == [(1, 1, 50), (2, 1, 6)]
    # a new day's file: only it is processed on the next run
    WR.write_landing(frame(spark, SC.LIVE, [live(2, 2, points=9)]), land, "gameweek_live", dt.date(2026, 1, 4))
    ingest_live(spark, f"{land}/gameweek_live", target, ckpt, loaded_at=clock())
    assert points() == [(1, 1, 50), (2, 1, 6), (2, 2, 9)]


@pytest.mark.parametrize("text", ["2025-08-15T19:00:00Z", "2025-08-15T19:00:00", "2025-08-15T19:00:00.000000", "2025-08-15T19:00:00.000Z"])
def test_feed_timestamps_with_and_without_zone_and_fraction(spark, tmp_path, text):
    (tmp_path / "a.json").write_text('{"kickoff_time": "%s"}\n' % text)
    row = RD.read_json_lines(spark, str(tmp_path), T.StructType([T.StructField("kickoff_time", T.TimestampNTZType())])).first()
    assert row.kickoff_time == dt.datetime(2025, 8, 15, 19)


def test_a_malformed_line_is_an_error_where_asked(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a": 1}\n{"a": oops\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        RD.read_json_lines(spark, str(tmp_path), T.StructType([T.StructField("a", T.LongType())]), fail_corrupt=True).collect()
