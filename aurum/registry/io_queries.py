"""Registered queries for sources, sinks, load control, upsert and streaming ingest.

Each writes driver-table data to a fresh folder under the shared checkpoint location,
runs the operator, and returns what it reads back.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from aurum.control import loads as CL
from aurum.operators.merge import merge_upsert
from aurum.plans import analogs as A
from aurum.plans import jobs as J
from aurum.plans import silver as S
from aurum.plans.silver import LIVE_COLUMNS, LIVE_KEYS
from aurum.registry.queries import as_midnight, clock, query, t_gameweeks, t_live
from aurum.session import materialized, scratch_path
from aurum.sinks import versions as VS
from aurum.sinks import writers as WR
from aurum.sources import documents as DOC
from aurum.sources import landed as LD
from aurum.sources import readers as RD
from aurum.sources import schemas as SC
from aurum.streaming.live_ingest import ingest_live

FIRST_LOAD, SECOND_LOAD = dt.date(2026, 1, 1), dt.date(2026, 1, 2)
SOURCE = "feed"

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])
LINE = T.StructType([
    T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
    T.StructField("l_partkey", T.LongType()), T.StructField("l_quantity", T.DoubleType()),
    T.StructField("l_shipdate", T.TimestampNTZType())])
ORDERS = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.TimestampNTZType()), T.StructField("o_orderpriority", T.StringType())])


def _lines(spark, d):
    return A.load(spark, d, "lineitem").select(*LINE.fieldNames())


DOC_SIZE = 64


def _documents(df):
    """Assign rows to documents of at most DOC_SIZE consecutive rows of one input split
    (no shuffle, no window): every collected array is bounded by construction, whatever
    the key distribution."""
    return df.withColumn("doc", F.floor(F.monotonically_increasing_id() / F.lit(DOC_SIZE)))


@query("scan_json_lines")
def q_scan_json(spark, d):
    base = scratch_path(spark, "events-json")
    A.load(spark, d, "events").write.options(**WR.JSON_OPTIONS).json(base)
    return RD.read_json_lines(spark, base, EVENTS)


@query("payload_explode")
def q_payload_explode(spark, d):
    base = scratch_path(spark, "order-docs")
    docs = _documents(_lines(spark, d)).groupBy("doc").agg(
        F.collect_list(F.struct(*LINE.fieldNames())).alias("elements"))
    docs.write.options(**WR.JSON_OPTIONS).json(base)
    return RD.explode_payload(spark, base, "elements", LINE)


@query("payload_root_array")
def q_payload_root_array(spark, d):
    base = scratch_path(spark, "order-arrays")
    docs = _documents(_lines(spark, d)).groupBy("doc").agg(
        F.to_json(F.collect_list(F.struct(*LINE.fieldNames())), WR.JSON_OPTIONS).alias("value"))
    docs.select("value").write.text(base)
    return RD.read_root_array(spark, base, LINE)


@query("struct_flatten_literal")
def q_struct_flatten(spark, d):
    base = scratch_path(spark, "live-docs")
    live = A.bronze_live(spark, d)
    stats = [f.name for f in SC.LIVE_STATS.fields]
    # a stale top-level total_points is overwritten by the one inside stats when flattened
    elem = F.struct(F.col("id"), F.lit(-1).cast("long").alias("total_points"), F.struct(*stats).alias("stats"))
    (live.select(F.array(elem).alias("elements"), "gameweek", "id").repartitionByRange("gameweek", "id")
         .drop("id").write.partitionBy("gameweek").json(base))
    return RD.read_live_documents(spark, base, SC.LIVE_ELEMENT)


@query("json_roundtrip")
def q_json_roundtrip(spark, d):
    ev = A.load(spark, d, "events")
    k = F.from_json("props", "k long")["k"]
    return ev.select("event_id", k.alias("k"),
                     F.to_json(F.struct(F.col("event_id"), k.alias("k"))).alias("encoded"))


@query("filename_date")
def q_filename_date(spark, d):
    base = scratch_path(spark, "events-landing")
    ev = A.load(spark, d, "events")
    (ev.withColumn(WR.LANDING_KEY, F.concat(F.lit("events_"), F.date_format("ts", "ddMMyyyy")))
       .write.partitionBy(WR.LANDING_KEY).options(**WR.JSON_OPTIONS).json(base))
    back = RD.read_json_lines(spark, base, EVENTS, with_file=True)
    from aurum.functions.scalars import date_from_name
    return back.select("event_id", as_midnight(date_from_name("source_file")).alias("load_date"))


@query("sink_landing_roundtrip")
def q_sink_landing(spark, d):
    base = scratch_path(spark, "landing")
    n = WR.write_landing(A.load(spark, d, "orders"), base, "orders", FIRST_LOAD)
    back = RD.read_json_lines(spark, f"{base}/orders", ORDERS)
    return back.select(*ORDERS.fieldNames(), F.lit(n).cast("long").alias("record_count"))


@query("archive_partitioned")
def q_archive(spark, d):
    path = scratch_path(spark, "snapshots")
    c = A.load(spark, d, "customer")
    WR.write_snapshot(c.withColumn("c_acctbal", F.col("c_acctbal") - 1.0), path, FIRST_LOAD)
    WR.write_snapshot(c.withColumn("c_acctbal", F.col("c_acctbal") + 1.0), path, SECOND_LOAD)
    WR.write_snapshot(c, path, SECOND_LOAD)   # same-day rerun replaces that day's copy
    latest = WR.latest_snapshot(spark, path)
    return latest.withColumn("snapshot_date", as_midnight(F.col("snapshot_date")))


def _live_counts(spark, d):
    return A.bronze_live(spark, d).groupBy("gameweek").agg(F.count(F.lit(1)).alias("record_count"))


@query("audit_append")
def q_audit_append(spark, d):
    path = scratch_path(spark, "audit")
    counts = _live_counts(spark, d)
    for part in (counts.where(F.col("gameweek") <= A.LAST_FINISHED), counts.where(F.col("gameweek") > A.LAST_FINISHED)):
        WR.append_audit(CL.audit_rows(part, SOURCE, "gameweek_live", "incremental", clock(), "gameweek"), path)
    return spark.read.schema(SC.AUDIT).parquet(path)


def _priority_audit(spark, d):
    """Audit history per order priority: one record per period, watermark text (NULL every 5th period)."""
    o = A.load(spark, d, "orders").withColumn("gw", A.period("o_orderdate"))
    g = o.groupBy("o_orderpriority", "gw").agg(F.count(F.lit(1)).alias("record_count"))
    return g.select(F.lit(SOURCE).alias("data_source"), F.col("o_orderpriority").alias("tablename"),
                    F.lit("incremental").alias("load_type"), "record_count",
                    F.when(F.col("gw") % 5 != 0, F.col("gw").cast("string")).alias("load_watermark"),
                    clock().alias("load_timestamp"), F.lit("SUCCESS").alias("status"))


@query("watermark_max")
def q_watermark_max(spark, d):
    return CL.latest_watermarks(_priority_audit(spark, d), SOURCE)


@query("current_period")
def q_current_period(spark, d):
    return CL.current_period(t_gameweeks(spark, d))


@query("latest_finished_period")
def q_latest_finished(spark, d):
    return CL.latest_final_period(t_gameweeks(spark, d))


@query("watermark_advance")
def q_watermark_advance(spark, d):
    gws = t_gameweeks(spark, d)
    cur, fin = CL.scalar(CL.current_period(gws)), CL.scalar(CL.latest_final_period(gws))
    return CL.watermark_plan(CL.latest_watermarks(_priority_audit(spark, d), SOURCE), cur, fin)


@query("incremental_slice")
def q_incremental_slice(spark, d):
    counts = _live_counts(spark, d).where(F.col("gameweek") <= A.LAST_FINISHED - 10)
    audit = CL.audit_rows(counts, SOURCE, "gameweek_live", "incremental", clock(), "gameweek")
    last = CL.scalar(CL.latest_watermark(audit, "gameweek_live", SOURCE))
    cur = CL.scalar(CL.current_period(t_gameweeks(spark, d)))
    return CL.incremental_slice(t_live(spark, d), last, cur)


@query("merge_upsert")
def q_merge_upsert(spark, d):
    path = scratch_path(spark, "live-table")
    live = t_live(spark, d)
    gw = F.col("gameweek")
    merge_upsert(spark, path, live.where(gw <= A.LAST_FINISHED), LIVE_KEYS, "gameweek")
    # corrections: the last four finished periods are re-sent (only rows with minutes) plus new periods
    fix = (live.where((gw > A.LAST_FINISHED - 4) & ((gw > A.LAST_FINISHED) | F.col("played")))
               .withColumn("total_points", F.col("total_points") + 1)
               .withColumn("loaded_at", F.lit("2026-01-02 00:00:00").cast("timestamp_ntz")))
    merge_upsert(spark, path, fix, LIVE_KEYS, "gameweek")
    merge_upsert(spark, path, fix, LIVE_KEYS, "gameweek")   # same source again: no change
    return spark.read.schema(live.schema).parquet(path).select(*LIVE_COLUMNS)


@query("stream_live_ingest")
def q_stream_ingest(spark, d):
    land, target, ckpt = (scratch_path(spark, n) for n in ("live-landing", "live-target", "live-checkpoint"))
    live = A.bronze_live(spark, d)
    gw = F.col("gameweek")
    WR.write_landing(live.where(gw <= A.LAST_FINISHED), land, "gameweek_live", FIRST_LOAD)
    WR.write_landing(live.where(gw > A.LAST_FINISHED - 4).withColumn("total_points", F.col("total_points") + 1),
                     land, "gameweek_live", SECOND_LOAD)
    ingest_live(spark, f"{land}/gameweek_live", target, ckpt, loaded_at=clock())
    typed = S.silver_live(live, clock())  # for its schema alone
    return spark.read.schema(typed.schema).parquet(target).select(*LIVE_COLUMNS)


@query("config_active_tables")
def q_config(spark, d):
    path = scratch_path(spark, "config")
    s = A.load(spark, d, "supplier")
    cfg = s.select(
        F.when(F.col("s_nationkey") % 5 == 4, F.lit("other-api")).otherwise(F.lit(SOURCE)).alias("datasource"),
        F.lower("s_name").alias("table_name"),
        F.when(F.col("s_suppkey") % 2 == 0, F.lit("full")).otherwise(F.lit("incremental")).alias("load_type"),
        F.when(F.col("s_acctbal") < 0, F.lit("0")).otherwise(F.lit("1")).alias("is_active"))
    cfg.write.option("header", True).csv(path)
    back = RD.read_csv_table(spark, path, SC.CONFIG)
    return CL.active_tables(back, SOURCE).select("table_name", "load_type")


# ---- documents landed whole, quarantine, drift ------------------------------------------------
CUSTOMERS = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
                          T.StructField("updated", T.TimestampNTZType()), T.StructField("nickname", T.StringType())])
DOC_ROWS = 200


def _customer_documents(spark, d) -> str:
    """Season-like documents of DOC_ROWS customers each, with fields that CUSTOMERS doesn't declare and time zone
    offsets.  Some are cut off after their last customer, some hold a broken element, some ids are text."""
    c = A.load(spark, d, "customer")
    k, doc = F.col("c_custkey"), F.floor(F.col("c_custkey") / F.lit(DOC_ROWS))
    at = F.concat(F.lit("2024-03-01T"), F.lpad((k % 24).cast("string"), 2, "0"), F.lit(":30:00+01:00"))
    element = F.to_json(F.struct(
        k.alias("id"), F.col("c_name").alias("name"), at.alias("updated"), F.col("c_mktsegment").alias("segment"),
        F.struct(F.col("c_nationkey").alias("nation"), F.array(F.lit("}{"), F.col("c_mktsegment")).alias("tags")).alias("extra")))
    element = F.when(k % 97 == 0, F.regexp_replace(element, r'^\{"id":([0-9]+)', '{"id":"$1x"')).otherwise(element)
    base = scratch_path(spark, "customer-docs")
    docs = c.select(doc.alias("doc"), element.alias("e")).groupBy("doc").agg(F.array_join(F.collect_list("e"), ",").alias("e"))
    text = F.concat(F.lit('{"meta":{"customers":[]},"customers":['), F.col("e"), F.when(F.col("doc") % 5 == 1, F.lit(',{"id":}')).otherwise(F.lit("")),
                    F.when(F.col("doc") % 5 == 3, F.lit("")).otherwise(F.lit('],"total":[1,2]}')))
    docs.select("doc", text.alias("value")).repartition("doc").write.partitionBy("doc").text(base)
    return base


def _landed_customers(spark, d):
    """(lines read back, rejects) of the customer documents."""
    found = DOC.read_elements(spark, _customer_documents(spark, d), ["customers"])
    base, rejects = scratch_path(spark, "customer-landing"), scratch_path(spark, "customer-rejects")
    WR.write_rejects(found.rejects, rejects, "customers", WR.landing_key("customers", FIRST_LOAD))
    WR.write_landing(found.elements.select("raw"), base, "customers", FIRST_LOAD, fmt="text")
    return LD.read_lines(spark, LD.latest_landing(spark, f"{base}/customers"), CUSTOMERS), WR.read_rejects(spark, rejects)


@query("raw_landing_whole")
def q_raw_landing(spark, d):
    """Declared columns beside fields that only the documents name."""
    lines, _ = _landed_customers(spark, d)
    return lines.where(F.col("reject_reason").isNull()).select(
        "id", "name", "updated", "nickname", F.variant_get("doc", "$.segment", "string").alias("segment"),
        F.variant_get("doc", "$.extra.nation", "int").alias("nation"), F.variant_get("doc", "$.extra.tags[0]", "string").alias("tag"))


@query("schema_drift")
def q_schema_drift(spark, d):
    lines, _ = _landed_customers(spark, d)
    return LD.schema_drift(lines, CUSTOMERS)


@query("landing_rejects")
def q_landing_rejects(spark, d):
    """What was rejected, by reason: whole documents, and elements or lines."""
    lines, rejects = _landed_customers(spark, d)
    misfits = lines.where(F.col("reject_reason").isNotNull()).select(F.col("reject_reason").alias("reason"), "raw")
    return rejects.select("reason", "raw").unionByName(misfits).groupBy("reason").agg(
        F.count_if(F.col("raw").isNull()).alias("documents"), F.count("raw").alias("rows"))


# ---- lasting tables, incremental refresh, load stamps ---------------------------------------------
@query("lasting_view")
def q_lasting_view(spark, d):
    """A view made over a table's first version reads the version that has replaced it."""
    table, base = f"customers_{uuid.uuid4().hex[:8]}", scratch_path(spark, "versions")
    c = A.load(spark, d, "customer")
    VS.replace(spark, c.withColumn("c_acctbal", F.col("c_acctbal") - 1.0), table, base)
    VS.read(spark, table).where("c_acctbal > 0").createOrReplaceTempView(f"{table}_in_credit")
    VS.replace(spark, c, table, base)
    return spark.table(f"{table}_in_credit")


@query("incremental_refresh")
def q_incremental_refresh(spark, d):
    """Three refreshes, the second without a new landing: only landed rows carry the stamp of a later refresh."""
    land, silver, table = scratch_path(spark, "live-landing"), scratch_path(spark, "silver-live"), f"live_{uuid.uuid4().hex[:8]}"
    live, gw = A.bronze_live(spark, d), F.col("gameweek")
    stamps = [F.lit(f"2026-01-0{k} 00:00:00").cast("timestamp_ntz") for k in (1, 2, 3)]
    WR.write_landing(live.where(gw <= A.LAST_FINISHED), land, "gameweek_live", FIRST_LOAD)
    J.refresh_live(spark, land, silver, table, stamps[0])
    J.refresh_live(spark, land, silver, table, stamps[1])
    late = live.where((gw > A.LAST_FINISHED - 4) & ((gw > A.LAST_FINISHED) | (F.col("minutes") > 0)))
    WR.write_landing(late.withColumn("total_points", F.col("total_points") + 1), land, "gameweek_live", SECOND_LOAD)
    J.refresh_live(spark, land, silver, table, stamps[2])
    return VS.read(spark, table).select(*LIVE_COLUMNS)


@query("full_load_replace")
def q_full_load(spark, d):
    """A full load run on two days: the landing delivers the later day's snapshot, the earlier one is in the archive,
    the audit holds both loads."""
    land, audit, archive = (scratch_path(spark, n) for n in ("full-landing", "full-audit", "full-archive"))
    s = A.load(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    config = spark.createDataFrame([(SOURCE, "suppliers", "full", "1")], SC.CONFIG)
    for day, rows, period in ((FIRST_LOAD, s.where("s_suppkey % 2 = 0"), 4), (SECOND_LOAD, s, 5)):
        J.run_loads(spark, config, SOURCE, {"suppliers": lambda *_, day=day, rows=rows: WR.write_landing(rows, land, "suppliers", day)},
                    audit, period, period - 1, clock(), land, archive)
    schema = T.StructType([T.StructField("s_suppkey", T.LongType()), T.StructField("s_name", T.StringType()), T.StructField("s_nationkey", T.LongType())])
    lines = LD.read_lines(spark, LD.latest_landing(spark, f"{land}/suppliers"), schema).where("reject_reason is null")
    loads = spark.read.schema(SC.AUDIT).parquet(audit).groupBy("tablename").agg(
        F.count(F.lit(1)).alias("loads"), F.sum("record_count").alias("landed"), F.max("load_watermark").alias("watermark"))
    old = LD.read_lines(spark, [f"{archive}/suppliers/{FIRST_LOAD:%Y/%m/%d}"], schema).agg(F.count("s_suppkey").alias("archived"))
    totals = loads.select("*", old.scalar().alias("archived"))
    return lines.select("s_suppkey", "s_name", "s_nationkey").join(F.broadcast(totals))  # one row of totals


@query("load_stamp")
def q_load_stamp(spark, d):
    """Without an injected clock, rows carry the time of the load."""
    rows = materialized(S.silver_teams(A.bronze_teams(spark, d)), "stamped")
    one = rows.select(F.min("loaded_at").alias("a"), F.max("loaded_at").alias("z"))
    age = F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp(F.col("loaded_at"))
    return rows.select("team_id", age.between(0, 3600).alias("stamped_now"),
                       (one.select("a").scalar() == one.select("z").scalar()).alias("one_stamp"))
