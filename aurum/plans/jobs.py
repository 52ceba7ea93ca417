"""End-to-end medallion refresh: landing -> bronze views -> silver tables -> gold views.

* land:    season document arrays and per-period live documents -> NDJSON landing folders
           (one folder per table and load date), with an audit row per table;
* bronze:  one temp view per table over its landing folder with an explicit schema
           (the external-table equivalent; latest landed copy only);
* silver:  full-replace tables (players, teams, gameweeks, fixtures) and the upserted,
           period-partitioned live table;
* gold:    the eight results as temp views, stacked views built from their base view.

Every stage reads what the previous one wrote, so the stages can run as separate,
restartable jobs; the data never passes through the driver.
"""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aurum.control import loads as CL
from aurum.functions.scalars import date_from_name
from aurum.operators.merge import merge_into
from aurum.plans import gold as G
from aurum.plans import silver as S
from aurum.session import children, materialized, path_exists
from aurum.sinks import versions as VS
from aurum.sinks import writers as WR
from aurum.sources import documents as DOC
from aurum.sources import landed as LD
from aurum.sources import schemas as SC
from aurum.streaming.live_ingest import latest_copy

log = logging.getLogger("aurum.jobs")


class PartialFailure(RuntimeError):
    """Some tables failed; ``done`` holds the results of the others, ``failed`` the errors."""

    def __init__(self, done: dict, failed: dict[str, str]):
        super().__init__(f"{len(failed)} table(s) failed: {', '.join(sorted(failed))}")
        self.done, self.failed = done, failed


LAYERS = {"bronze": "Raw landed documents", "silver": "Cleaned and typed tables",
          "gold": "Analytic results"}
FULL_TABLES = ["players", "teams", "gameweeks", "fixtures"]


def ensure_layers(spark: SparkSession, prefix: str = "") -> list[str]:
    """CREATE DATABASE IF NOT EXISTS for the three layers (with a comment)."""
    names = []
    for layer, comment in LAYERS.items():
        name = f"{prefix}{layer}"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` COMMENT '{comment}'")
        names.append(name)
    return names


class Landed(int):
    """A load's record count, with the number of rejects and, for period slices, the last period landed without a gap."""

    rejected: int
    loaded_to: int | None

    def __new__(cls, count: int, rejected: int = 0, loaded_to: int | None = None):
        it = super().__new__(cls, count)
        it.rejected, it.loaded_to = rejected, loaded_to
        return it


def rejects_path(landing: str) -> str:
    return f"{landing.rstrip('/')}/_rejects"


def read_season(spark: SparkSession, document_path: str, tables: list[str] | None = None) -> DOC.Documents:
    """All arrays of the season documents in one pass, for ``land_season`` of several tables."""
    return DOC.read_elements(spark, document_path, [k for t, k in SC.DOCUMENT_KEYS.items() if tables is None or t in tables])


def _land(spark: SparkSession, found: DOC.Documents, key: str, table: str, landing: str, load_date: dt.date) -> Landed:
    rows = found.elements.where(F.col("array_key") == key).select("raw")
    bad = found.rejects.where(F.col("array_key").isNull() | (F.col("array_key") == key))
    rejected = WR.write_rejects(bad, rejects_path(landing), table, WR.landing_key(table, load_date))
    return Landed(WR.write_landing(rows, landing, table, load_date, fmt="text"), rejected)


def land_season(spark: SparkSession, document_path: str, fixtures_path: str, landing: str,
                load_date: dt.date, tables: list[str] | None = None, season: DOC.Documents | None = None) -> dict[str, Landed]:
    """Extract season arrays (players, positions, teams, gameweeks) and the fixtures root array
    into landing folders, every element whole; returns record counts (0 = nothing written).

    Elements that are no JSON objects, and all of a cut document, go to the landing's rejects.  Documents
    are read once; pass ``season`` (``read_season``) when tables are landed one by one.
    """
    counts = {}
    wanted = [t for t in SC.DOCUMENT_KEYS if tables is None or t in tables]
    if wanted:
        season = season or read_season(spark, document_path, wanted)
        for table in wanted:
            counts[table] = _land(spark, season, SC.DOCUMENT_KEYS[table], table, landing, load_date)
    if tables is None or "fixtures" in tables:
        counts["fixtures"] = _land(spark, DOC.read_elements(spark, fixtures_path), DOC.ROOT, "fixtures", landing, load_date)
    return counts


def contiguous_end(periods: DataFrame, first: int, column: str = "gameweek") -> int:
    """Last period p such that every period first..p is present (first - 1 if none)."""
    p = F.col(column)
    distinct = periods.where(p >= first).select(p.alias("p")).distinct()  # one row a period of the slice
    placed = distinct.select("p", F.row_number().over(Window.orderBy("p")).alias("n"))
    return CL.scalar(placed.where(F.col("p") - F.col("n") == first - 1).agg(F.coalesce(F.max("p"), F.lit(first - 1))))


def land_live(spark: SparkSession, live_docs: str, landing: str, load_date: dt.date, first: int, last: int) -> Landed:
    """Land periods first..last of the per-period live documents (folders ``gameweek=N``), every field of an
    element: ``stats`` is hoisted to the top, the period added.

    The count's ``loaded_to`` is the last period up to which every period was landed: a missing
    (or cut) document in the middle stops the watermark there, so it is pulled again next run.
    """
    folders = [n for n in children(spark, live_docs) if n.startswith("gameweek=") and n[9:].isdigit() and first <= int(n[9:]) <= last]
    found = DOC.read_elements(spark, [f"{live_docs.rstrip('/')}/{n}" for n in folders], ["elements"])
    period = F.regexp_extract("source_file", "gameweek=([0-9]+)/", 1).cast("long")
    rows = materialized(LD.hoisted(found.elements.withColumn("gameweek", period), "stats", {"gameweek": period}).select("gameweek", "raw"), "live-rows")
    rejected = WR.write_rejects(found.rejects, rejects_path(landing), "gameweek_live", WR.landing_key("gameweek_live", load_date))
    n = WR.write_landing(rows.select("raw"), landing, "gameweek_live", load_date, fmt="text")
    return Landed(n, rejected, contiguous_end(rows, first))


def bronze_views(spark: SparkSession, landing: str, prefix: str = "bronze_") -> dict[str, DataFrame]:
    """Temp view per bronze table over its landing folder: the declared columns, and the whole document in ``doc``.

    Full-load tables read only their latest landing day, found by listing the folder names; the
    live table exposes every landing (deduplicated per key by the silver upsert).  Lines that
    don't fit are left out here and listed by ``bronze_rejects``.
    """
    out = {}
    for table in SC.BRONZE:
        df = bronze_lines(spark, landing, table).where(F.col("reject_reason").isNull()).drop("reject_reason", "raw", "source_file")
        df.createOrReplaceTempView(f"{prefix}{table}")
        out[table] = df
    return out


def bronze_lines(spark: SparkSession, landing: str, table: str, paths: list[str] | None = None) -> DataFrame:
    """All lines of a table's current landing (or of ``paths``), with ``reject_reason``; the live table's with ``landed_on``."""
    base = f"{landing.rstrip('/')}/{table}"
    live = table == "gameweek_live"
    if paths is None:
        paths = sorted(LD.landing_days(spark, base)) if live else LD.latest_landing(spark, base)
    df = LD.read_lines(spark, paths, SC.BRONZE[table])
    keys = ["id", "gameweek"] if live else ["id"]
    lacking = F.greatest(*[F.col(k).isNull() for k in keys]) if len(keys) > 1 else F.col("id").isNull()
    df = df.withColumn("reject_reason", F.coalesce("reject_reason", F.when(lacking, F.lit("line without a key"))))
    return df.withColumn("landed_on", date_from_name("source_file")) if live else df


def bronze_rejects(spark: SparkSession, landing: str) -> DataFrame:
    """Landed lines that no bronze view delivers: table, source file, reason, text."""
    found = None
    for table in SC.BRONZE:
        bad = bronze_lines(spark, landing, table).where(F.col("reject_reason").isNotNull()).select(
            F.lit(table).alias("table_name"), "source_file", F.col("reject_reason").alias("reason"), "raw")
        found = bad if found is None else found.unionByName(bad)
    return found


LIVE_TABLE = "gameweek_live"
MERGED = "path string, modified timestamp, size long, batch string"


def _live_schema(spark: SparkSession, loaded_at: Column | None = None) -> T.StructType:
    return S.silver_live(spark.createDataFrame([], SC.LIVE), loaded_at).schema


def unmerged_files(spark: SparkSession, landing: str, silver_base: str) -> DataFrame:
    """The live landing's files that no refresh has merged: by path, time and size, so that a day landed again counts."""
    base = f"{landing.rstrip('/')}/{LIVE_TABLE}"
    if not path_exists(spark, base):
        return spark.createDataFrame([], MERGED).drop("batch")
    # the listing alone: no file is opened
    m = F.col("_metadata")
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(base)
             .select(m.file_path.alias("path"), m.file_modification_time.alias("modified"), m.file_size.alias("size")))
    merged = VS.log_of(spark, f"{silver_base.rstrip('/')}/_merged", MERGED)
    return files.join(merged, ["path", "modified", "size"], "left_anti")


def merge_live(spark: SparkSession, source: DataFrame, table: str, base: str) -> dict:
    """MERGE typed live rows into the period table ``table``; each touched period is replaced in one step."""
    VS.ensure(spark, table, base, source.schema, "gameweek")  # CREATE TABLE IF NOT EXISTS
    target = VS.read(spark, table)
    return merge_into(target, source, S.LIVE_KEYS, "gameweek",
                      lambda rows: VS.replace_periods(spark, rows, table, base, "gameweek"))


def refresh_live(spark: SparkSession, landing: str, silver_base: str, table: str, loaded_at: Column | None = None) -> dict:
    """Merge the landings that are new since the last refresh; without one, nothing is rewritten.

    A landing day is merged with all later ones, so that one that arrives late or again never takes
    the place of newer copies.  The log is written last: a refresh that breaks off is repeated.
    """
    base = f"{silver_base.rstrip('/')}/{LIVE_TABLE}"
    VS.ensure(spark, table, base, _live_schema(spark, loaded_at), "gameweek")
    new = materialized(unmerged_files(spark, landing, silver_base), "unmerged")
    days = LD.landing_days(spark, f"{landing.rstrip('/')}/{LIVE_TABLE}")
    day = F.date_format(date_from_name("path"), "yyyyMMdd")
    seen = new.agg(F.count(F.lit(1)).alias("n"), F.min(day).alias("first"), F.count_if(day.isNull()).alias("undated")).first()
    if not seen["n"]:
        return {"source_rows": 0, "kept_rows": 0}
    paths = sorted(p for p, d in days.items() if seen["undated"] or d is None or d >= seen["first"])
    lines = bronze_lines(spark, landing, LIVE_TABLE, paths).where(F.col("reject_reason").isNull())
    fresh = latest_copy(lines.select(*SC.LIVE.fieldNames(), "landed_on"), ["id", "gameweek"], F.col("landed_on"))
    done = merge_live(spark, S.silver_live(fresh, loaded_at), table, base)
    new.withColumn("batch", F.lit(uuid.uuid4().hex)).write.mode("append").parquet(f"{silver_base.rstrip('/')}/_merged")
    return done


def refresh_silver(spark: SparkSession, bronze: Mapping[str, DataFrame], silver_base: str,
                   loaded_at: Column | None = None, strict: bool = True, database: str = "silver",
                   landing: str | None = None) -> dict[str, str]:
    """Refresh the silver tables of ``database``; returns table -> its name in the catalog.

    Each table is replaced in one step (``sinks.versions``): readers and views see the old rows or
    the new ones.  With ``landing`` the live table takes the landings that are new since the last
    refresh; else the rows of ``bronze``.

    Tables are refreshed independently: a failing table is logged and the others still
    run.  With ``strict`` a ``PartialFailure`` is raised at the end (carrying the
    tables that succeeded); otherwise only the succeeded tables are returned.
    """
    base = silver_base.rstrip("/")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` COMMENT '{LAYERS['silver']}'")

    def full(name, build):
        return lambda: VS.replace(spark, build(), f"{database}.{name}", f"{base}/{name}")   # CREATE OR REPLACE TABLE AS SELECT

    def live():
        if landing is not None:
            return refresh_live(spark, landing, base, f"{database}.{LIVE_TABLE}", loaded_at)
        rows = bronze[LIVE_TABLE].select(*SC.LIVE.fieldNames(), "landed_on")
        fresh = latest_copy(rows, ["id", "gameweek"], F.col("landed_on"))
        return merge_live(spark, S.silver_live(fresh, loaded_at), f"{database}.{LIVE_TABLE}", f"{base}/{LIVE_TABLE}")

    steps = {
        "players": full("players", lambda: S.silver_players(bronze["players"], bronze["teams"], loaded_at)),
        "teams": full("teams", lambda: S.silver_teams(bronze["teams"], loaded_at)),
        "gameweeks": full("gameweeks", lambda: S.silver_gameweeks(bronze["gameweeks"], loaded_at)),
        "fixtures": full("fixtures", lambda: S.silver_fixtures(bronze["fixtures"], bronze["teams"], loaded_at)),
        LIVE_TABLE: live,
    }
    tables, failed = {}, {}
    for name, step in steps.items():
        try:
            step()
            tables[name] = f"{database}.{name}"
        except Exception as e:  # noqa: BLE001 - isolate the table, report at the end
            log.error("silver refresh of %s failed: %s", name, e)
            failed[name] = f"{type(e).__name__}: {e}"
    if failed and strict:
        raise PartialFailure(tables, failed)
    return tables


def attach_silver(spark: SparkSession, silver_base: str, database: str = "silver") -> dict[str, str]:
    """Register the silver tables from their folders (an application with a catalog of its own); returns those found."""
    base = silver_base.rstrip("/")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` COMMENT '{LAYERS['silver']}'")
    found = {t: f"{database}.{t}" for t in FULL_TABLES if VS.attach(spark, f"{database}.{t}", f"{base}/{t}")}
    VS.attach(spark, f"{database}.{LIVE_TABLE}", f"{base}/{LIVE_TABLE}", _live_schema(spark), "gameweek")
    return {**found, LIVE_TABLE: f"{database}.{LIVE_TABLE}"}


def read_silver(spark: SparkSession, tables: Mapping[str, str]) -> dict[str, DataFrame]:
    """The silver tables, each as it is whenever it is read."""
    return {k: VS.read(spark, v) for k, v in tables.items()}


def publish_gold(silver: Mapping[str, DataFrame], prefix: str = "gold_") -> dict[str, DataFrame]:
    """CREATE OR REPLACE VIEW for the eight gold results (served with their final order).

    Each is a temp view of the session and, under the same name, one of ``global_temp`` for all sessions of
    the application.  Over ``read_silver`` they resolve the tables' current versions at every read.
    """
    po = G.player_overview(silver["players"])
    views = {
        "player_overview": po,
        "value_picks": G.value_picks(po),
        "form_players": G.form_players(silver["gameweeks"], silver["gameweek_live"], silver["players"], ordered=True),
        "captaincy_picks": G.captaincy_picks(po, silver["fixtures"], ordered=True),
        "team_overview": G.team_overview(silver["teams"], silver["fixtures"], ordered=True),
        "gameweek_summary": G.gameweek_summary(silver["gameweeks"], silver["players"], ordered=True),
        "differential_picks": G.differential_picks(po, ordered=True),
        "fixture_difficulty_tracker": G.fixture_difficulty(silver["fixtures"], ordered=True),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(f"{prefix}{name}")
        df.createOrReplaceGlobalTempView(f"{prefix}{name}")
    return views


def _audit(spark: SparkSession, datasource: str, table: str, load_type: str, count: int, mark: int | None, clock: Column,
           status: str, path: str) -> None:
    row = spark.createDataFrame([(table, count, mark)], "tablename string, record_count long, period long")
    WR.append_audit(row.select(
        F.lit(datasource).alias("data_source"), "tablename", F.lit(load_type).alias("load_type"), "record_count",
        F.col("period").cast("string").alias("load_watermark"), clock.alias("load_timestamp"), F.lit(status).alias("status")), path)


def archive_landed(spark: SparkSession, landing: str, archive: str, table: str, load_type: str) -> list[str]:
    """Archive what a successful load has superseded.  Of a table that is replaced whole that is every earlier day; the
    days of an incremental table are all current until they are merged, and stay."""
    base = f"{landing.rstrip('/')}/{table}"
    return [] if load_type == "incremental" else WR.archive_landings(spark, base, archive, table, LD.landing_days(spark, base))


def run_loads(spark: SparkSession, config: DataFrame, datasource: str, extractors: Mapping[str, callable],
              audit_path: str, current: int, final: int, clock: Column, landing: str | None = None,
              archive: str | None = None) -> dict[str, int]:
    """Config-driven landing: each active table's extractor -> record count -> audit row.  With ``landing`` and
    ``archive``, landings that a successful load supersedes are moved to the archive.

    ``extractors[table](load_type, last_watermark, current)`` lands the table and returns its
    record count (``Landed``: with rejects, which get an audit row of status REJECTED, and for period
    slices the last contiguously landed period).  Full loads record the current period; incremental loads record the last
    finished-and-checked period (so open periods are pulled again next time).  A load that
    lands nothing is audited as EMPTY without a watermark; a failing extractor is logged,
    gets ``None``, writes no audit row and does not stop the other tables.
    """
    plan = CL.dispatch(config, extractors, datasource)
    if path_exists(spark, audit_path):
        history = spark.read.schema(SC.AUDIT).parquet(audit_path)
    else:   # first run
        history = spark.createDataFrame([], SC.AUDIT)
    results: dict[str, int | None] = {}
    for table, (load_type, extract) in plan.items():
        last = CL.scalar(CL.latest_watermark(history, table, datasource)) if load_type == "incremental" else 0
        try:
            got = extract(load_type, last, current)
        except Exception as e:  # noqa: BLE001 - one failing table does not stop the others
            log.error("landing of %s failed: %s", table, e)
            results[table] = None          # no audit row: the watermark does not move
            continue
        n, loaded_to, rejected = got, getattr(got, "loaded_to", None), getattr(got, "rejected", 0)
        if rejected:
            _audit(spark, datasource, table, load_type, rejected, None, clock, "REJECTED", audit_path)
        results[table] = n
        mark = None
        if n:
            mark = final if load_type == "incremental" else current
            if load_type == "incremental" and loaded_to is not None:
                mark = min(mark, loaded_to)   # never past a period that was not landed
        if load_type == "incremental" and not n:
            continue   # nothing new: no audit row, the watermark does not move
        mark = mark or None   # a watermark of zero is recorded as none
        _audit(spark, datasource, table, load_type, int(n or 0), mark, clock, "SUCCESS" if n else "EMPTY", audit_path)
        if n and landing is not None and archive is not None:
            archive_landed(spark, landing, archive, table, load_type)
    return results
