import datetime as dt

import pytest
from pyspark.sql import functions as F

from aurum.control import loads as CL
from aurum.operators.merge import MergeError, merge_upsert
from aurum.sinks import writers as WR
from aurum.sources import readers as RD
from aurum.sources import schemas as SC


def table(spark, path, schema):
    df = spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
    return sorted((tuple(r) for r in df.collect()), key=repr)


SCHEMA = "player_id long, gameweek long, points long"


def test_merge_insert_update_keep_and_idempotent(spark, scratch):
    path = scratch("merge")
    t = spark.createDataFrame([(1, 1, 5), (2, 1, 6), (1, 2, 7), (2, 2, 8)], SCHEMA)
    merge_upsert(spark, path, t, ["player_id", "gameweek"], "gameweek")
    src = spark.createDataFrame([(1, 2, 70), (3, 2, 9), (1, 3, 1)], SCHEMA)
    stats = merge_upsert(spark, path, src, ["player_id", "gameweek"], "gameweek")
    want = [(1, 1, 5), (1, 2, 70), (1, 3, 1), (2, 1, 6), (2, 2, 8), (3, 2, 9)]
    assert sorted(table(spark, path, t.schema)) == sorted(want)
    assert stats == {"source_rows": 3, "kept_rows": 1}
    merge_upsert(spark, path, src, ["player_id", "gameweek"], "gameweek")  # same source again
    assert sorted(table(spark, path, t.schema)) == sorted(want)


def test_merge_order_independent(spark, scratch):
    base = spark.createDataFrame([(1, 1, 1), (2, 1, 2)], SCHEMA)
    a = spark.createDataFrame([(1, 1, 10)], SCHEMA)
    b = spark.createDataFrame([(2, 1, 20), (3, 2, 30)], SCHEMA)
    results = []
    for order in ((a, b), (b, a)):
        path = scratch("merge-order")
        merge_upsert(spark, path, base, ["player_id", "gameweek"], "gameweek")
        for s in order:
            merge_upsert(spark, path, s, ["player_id", "gameweek"], "gameweek")
        results.append(sorted(table(spark, path, base.schema)))
    assert results[0] == results[1]


def test_merge_rejects_duplicate_and_null_keys(spark, scratch):
    path = scratch("merge-bad")
    dup = spark.createDataFrame([(1, 1, 1), (1, 1, 2)], SCHEMA)
    with pytest.raises(MergeError):
        merge_upsert(spark, path, dup, ["player_id", "gameweek"], "gameweek")
    null = spark.createDataFrame([(None, 1, 1)], SCHEMA)
    with pytest.raises(MergeError):
        merge_upsert(spark, path, null, ["player_id", "gameweek"], "gameweek")


def audit(spark, rows):
    data = [("feed", t, "incremental", 1, w, dt.datetime(2026, 1, 1), "SUCCESS") for t, w in rows]
    return spark.createDataFrame(data, SC.AUDIT)


def test_watermark_numeric_max_and_defaults(spark):
    a = audit(spark, [("live", "9"), ("live", "10"), ("none", None), ("bad", "x")])
    got = {r.tablename: r.latest_watermark for r in CL.latest_watermarks(a).collect()}
    assert got == {"live": 10, "none": 0, "bad": 0}
    assert CL.scalar(CL.latest_watermark(a, "missing")) == 0


def gws(spark, rows):
    return spark.createDataFrame(rows, "gameweek_id long, is_current boolean, is_finished boolean, is_data_final boolean")


def test_current_and_final_period_fallbacks(spark):
    assert CL.scalar(CL.current_period(gws(spark, [(1, False, True, True), (2, True, False, False)]))) == 2
    assert CL.scalar(CL.current_period(gws(spark, [(1, False, True, True), (2, False, True, False),
                                                   (3, False, False, False)]))) == 2
    assert CL.scalar(CL.current_period(gws(spark, [(1, False, False, False)]))) == 1
    # finished but not data-checked does not advance the watermark
    assert CL.scalar(CL.latest_final_period(gws(spark, [(1, False, True, True), (2, True, True, False)]))) == 1
    assert CL.scalar(CL.latest_final_period(gws(spark, [(1, True, False, False)]))) == 0


def test_incremental_slice_bounds(spark):
    live = spark.range(1, 11).select(F.col("id").alias("gameweek"))
    assert [r.gameweek for r in CL.incremental_slice(live, 3, 6).orderBy("gameweek").collect()] == [4, 5, 6]
    assert CL.incremental_slice(live, 6, 6).count() == 0


def test_config_filter_and_dispatch(spark, scratch):
    path = scratch("config")
    rows = [("feed", "players", "full", "1"), ("feed", "teams", "full", "0"), ("other", "x", "full", "1"),
            ("feed", "gameweek_live", "incremental", "1")]
    spark.createDataFrame(rows, SC.CONFIG).coalesce(1).write.option("header", True).csv(path)
    cfg = RD.read_csv_table(spark, path, SC.CONFIG)
    plan = CL.dispatch(cfg, {"players": lambda: None, "teams": lambda: None, "gameweek_live": lambda gw: None}, "feed")
    assert {k: v[0] for k, v in plan.items()} == {"players": "full", "gameweek_live": "incremental"}
    assert RD.read_csv_table(spark, path + "-missing", SC.CONFIG).count() == 0


def test_landing_counts_and_empty_input(spark, scratch):
    base = scratch("landing")
    df = spark.range(25).withColumnRenamed("id", "v")
    assert WR.write_landing(df, base, "t", dt.date(2026, 3, 4)) == 25
    assert WR.write_landing(df.limit(5), base, "t", dt.date(2026, 3, 4)) == 5   # same day: replaced
    assert WR.write_landing(df.where("v < 0"), base, "t", dt.date(2026, 3, 5)) == 0
    back = spark.read.json(f"{base}/t")
    assert back.count() == 5 and {r[0] for r in back.select("load_key").distinct().collect()} == {"t_04032026"}


def test_snapshots_latest_and_same_day_rerun(spark, scratch):
    path = scratch("snap")
    WR.write_snapshot(spark.range(3), path, dt.date(2026, 1, 1))
    WR.write_snapshot(spark.range(5), path, dt.date(2026, 1, 2))
    WR.write_snapshot(spark.range(4), path, dt.date(2026, 1, 2))
    latest = WR.latest_snapshot(spark, path)
    assert latest.count() == 4 and {r.snapshot_date for r in latest.collect()} == {dt.date(2026, 1, 2)}


def test_ensure_table_creates_once(spark, scratch):
    path = scratch("ddl")
    schema = spark.createDataFrame([], SCHEMA).schema
    assert WR.ensure_table(spark, path, schema, ["gameweek"]) is True
    assert WR.ensure_table(spark, path, schema, ["gameweek"]) is False
    assert spark.read.schema(schema).parquet(path).count() == 0


def test_upsert_spreads_a_hot_period_and_keeps_target_columns(spark, tmp_path):
    path = str(tmp_path / "hot")
    rows = [(k, 1, float(k)) for k in range(600)] + [(k, k % 20 + 2, float(k)) for k in range(200)]
    src = spark.createDataFrame(rows, "player_id long, gameweek long, v double").dropDuplicates(["player_id", "gameweek"])
    merge_upsert(spark, path, src, ["player_id", "gameweek"], "gameweek")
    assert spark.read.parquet(path).where("gameweek = 1").select("_metadata.file_path").distinct().count() > 1
    with pytest.raises(MergeError, match="lacks target columns"):
        merge_upsert(spark, path, src.drop("v"), ["player_id", "gameweek"], "gameweek")
    assert spark.read.parquet(path).where("v is null").count() == 0


def test_dispatch_lowers_load_types_and_names_missing_extractors(spark):
    from aurum.control import loads as CL

    config = spark.createDataFrame([("feed", "live", "Incremental", "1")], "datasource string, table_name string, load_type string, is_active string")
    assert CL.dispatch(config, {"live": print}, "feed")["live"][0] == "incremental"
    with pytest.raises(ValueError, match="no extractor"):
        CL.dispatch(config, {}, "feed")
