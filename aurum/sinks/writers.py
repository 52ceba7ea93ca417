"""Sinks: landing writes, dated snapshots, the audit table and create-if-missing tables.

Writes are path based (any Hadoop-compatible shared store).  Counts come from an
``Observation`` on the written DataFrame, never from a second pass over the data.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aurum.session import children, delete_folder, move
from aurum.session import path_exists as _exists
from aurum.sources.readers import JSON_OPTIONS  # noqa: F401  (re-exported for writers' callers)

LANDING_KEY = "load_key"


def landing_key(table: str, load_date: dt.date) -> str:
    """'<table>_<DDMMYYYY>': the landing folder of one table for one load date."""
    return f"{table}_{load_date.strftime('%d%m%Y')}"


def path_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:  # noqa: ARG001
    """True when ``path`` exists (an existing empty table counts)."""
    return _exists(spark, path)


def write_landing(df: DataFrame, base: str, table: str, load_date: dt.date, fmt: str = "json") -> int:
    """Land ``df`` under ``base/<table>/load_key=<table>_<DDMMYYYY>/`` and return its row count.

    An empty input writes no landing folder and returns 0 (the write itself counts: no probe runs
    the input before).  A rerun on the same date replaces that date's folder only (dynamic
    partition overwrite).  ``fmt="text"`` lands JSON texts line by line (one string column).
    """
    obs = Observation(f"landing_{table}_{uuid.uuid4().hex[:8]}")
    key = landing_key(table, load_date)
    (df.observe(obs, F.count(F.lit(1)).alias("rows"))
       .withColumn(LANDING_KEY, F.lit(key))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(LANDING_KEY).format(fmt).options(**(JSON_OPTIONS if fmt == "json" else {}))
       .save(f"{base.rstrip('/')}/{table}"))
    return int(obs.get["rows"])


def write_snapshot(df: DataFrame, path: str, snapshot_date: dt.date) -> int:
    """Dated snapshot partitioned by year/month/day; the same date written twice keeps one copy."""
    obs = Observation(f"snapshot_{uuid.uuid4().hex[:8]}")
    (df.observe(obs, F.count(F.lit(1)).alias("rows"))
       .withColumn("year", F.lit(snapshot_date.year))
       .withColumn("month", F.lit(snapshot_date.month))
       .withColumn("day", F.lit(snapshot_date.day))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("year", "month", "day").parquet(path))
    return int(obs.get["rows"])


def latest_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the most recent snapshot, with ``snapshot_date``.

    The date is found by listing the three folder levels, so only that snapshot's files are planned and read.
    """
    base, parts = path.rstrip("/"), []
    for level in ("year", "month", "day"):
        numbers = [int(n.split("=", 1)[1]) for n in children(spark, "/".join([base, *parts])) if n.startswith(f"{level}=")]
        if not numbers:
            raise ValueError(f"no snapshot at {path}")
        parts.append(f"{level}={max(numbers)}")
    day = dt.date(*(int(p.split("=")[1]) for p in parts))
    rows = spark.read.option("basePath", base).parquet("/".join([base, *parts]))
    return rows.select(*[c for c in rows.columns if c not in ("year", "month", "day")], F.lit(day).alias("snapshot_date"))


def archive_landings(spark: SparkSession, base: str, archive: str, table: str, days: dict[str, str | None]) -> list[str]:
    """Move the table's superseded landings, all but the latest day of ``days`` (path -> yyyymmdd), to
    ``<archive>/<table>/<yyyy>/<mm>/<dd>/``; a day that is archived again replaces its copy.  Returns the new paths.

    It runs after a load, so a load that fails leaves the landing as it was.
    """
    last = max((d for d in days.values() if d), default=None)
    moved = []
    for path, day in sorted(days.items()):
        if day is not None and day != last:
            target = f"{archive.rstrip('/')}/{table}/{day[:4]}/{day[4:6]}/{day[6:]}/{path.rsplit('/', 1)[1]}"
            move(spark, path, target)
            moved.append(target)
    return moved


REJECTS = "table_name string, load_key string, source_file string, reason string, raw string"


def write_rejects(df: DataFrame, path: str, table: str, batch: str) -> int:
    """Quarantine ``df`` (source_file, reason, raw) of one table and batch; returns the number of rows.

    The table is partitioned by table and batch: a batch that is run again replaces its own rejects.
    """
    obs = Observation(f"rejects_{table}_{uuid.uuid4().hex[:8]}")
    (df.select("source_file", "reason", "raw").observe(obs, F.count(F.lit(1)).alias("rows"))
       .withColumn("table_name", F.lit(table)).withColumn("load_key", F.lit(batch))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("table_name", "load_key").parquet(path))
    rows = int(obs.get["rows"])
    if not rows:  # an overwrite without rows leaves the folder of an earlier run
        delete_folder(df.sparkSession, f"{path.rstrip('/')}/table_name={table}/load_key={batch}")
    return rows


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Everything quarantined at ``path`` (empty if nothing ever was)."""
    if not _exists(spark, path):
        return spark.createDataFrame([], REJECTS)
    return spark.read.schema(REJECTS).parquet(path)


def append_audit(df: DataFrame, path: str) -> None:
    """Append audit rows (append-only parquet table)."""
    df.write.mode("append").parquet(path)


def ensure_table(spark: SparkSession, path: str, schema: T.StructType,
                 partition_by: list[str] | None = None) -> bool:
    """CREATE TABLE IF NOT EXISTS for a path table; returns True when it was created."""
    if path_exists(spark, path):
        return False
    w = spark.createDataFrame([], schema).write.mode("ignore")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return True
