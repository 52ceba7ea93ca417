"""Command line for the medallion jobs.

    python -m aurum land    --season DOC --fixtures DOC --live DIR --landing DIR --config CSV
                            --audit DIR [--source NAME] [--archive DIR]
    python -m aurum refresh --landing DIR --silver DIR
    python -m aurum gold    --silver DIR [--show VIEW] [--rows N]

``land`` runs the config-driven landing (full tables every run; the live table from the
last recorded watermark to the current period; one audit row per landed table).
``refresh`` rebuilds bronze views and the silver tables.  ``gold`` publishes the eight
gold views over the silver tables and optionally prints one of them.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from aurum.control import loads as CL
from aurum.plans import jobs as J
from aurum.sources import landed as LD
from aurum.sources import readers as RD
from aurum.sources import schemas as SC


def _session() -> SparkSession:
    spark = SparkSession.builder.appName("aurum").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    return spark


def cmd_land(a: argparse.Namespace) -> None:
    spark = _session()
    today = dt.date.today()
    season = J.read_season(spark, a.season)  # one pass over the document for all its tables
    events = LD.declared(season.elements.where(F.col("array_key") == "events"), SC.GAMEWEEKS)
    periods = events.select(F.col("id").alias("gameweek_id"), F.col("is_current"),
                            F.col("finished").alias("is_finished"), F.col("data_checked").alias("is_data_final"))
    current = CL.scalar(CL.current_period(periods))
    final = CL.scalar(CL.latest_final_period(periods))


    def season_table(name):
        return lambda load_type, last, cur: J.land_season(spark, a.season, a.fixtures, a.landing, today, [name], season)[name]

    extractors = {t: season_table(t) for t in ["players", "positions", "teams", "gameweeks", "fixtures"]}
    extractors["gameweek_live"] = lambda load_type, last, cur: J.land_live(spark, a.live, a.landing, today, last + 1, cur)
    config = RD.read_csv_table(spark, a.config, SC.CONFIG)
    counts = J.run_loads(spark, config, a.source, extractors, a.audit, current, final, F.current_timestamp(), a.landing, a.archive)
    for table, n in counts.items():
        print(f"{table}: {n} records")


def cmd_refresh(a: argparse.Namespace) -> None:
    spark = _session()
    J.attach_silver(spark, a.silver)  # what earlier runs left
    tables = J.refresh_silver(spark, J.bronze_views(spark, a.landing), a.silver, landing=a.landing)
    for table, name in tables.items():
        print(f"{table}: {name}")
    for r in J.bronze_rejects(spark, a.landing).groupBy("table_name", "reason").count().collect():  # a few reasons a table
        print(f"rejected, {r['table_name']}: {r['count']} ({r['reason']})")


def cmd_gold(a: argparse.Namespace) -> None:
    spark = _session()
    views = J.publish_gold(J.read_silver(spark, J.attach_silver(spark, a.silver)))
    if a.show:
        views[a.show].show(a.rows, truncate=False)
    else:
        print("\n".join(f"gold_{v}" for v in views))


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="aurum")
    sub = p.add_subparsers(dest="cmd", required=True)
    land = sub.add_parser("land")
    for flag in ("--season", "--fixtures", "--live", "--landing", "--config", "--audit"):
        land.add_argument(flag, required=True)
    land.add_argument("--source", default="season-api")
    land.add_argument("--archive")
    land.set_defaults(fn=cmd_land)
    ref = sub.add_parser("refresh")
    ref.add_argument("--landing", required=True)
    ref.add_argument("--silver", required=True)
    ref.set_defaults(fn=cmd_refresh)
    gold = sub.add_parser("gold")
    gold.add_argument("--silver", required=True)
    gold.add_argument("--show")
    gold.add_argument("--rows", type=int, default=20)
    gold.set_defaults(fn=cmd_gold)
    a = p.parse_args(argv)
    a.fn(a)


if __name__ == "__main__":
    main()
