"""Tables that are replaced in one step and resolved when they are read.

A table is an external parquet table of the session's catalog whose *partition locations* are the pointers: every write
goes to a new version folder, ``<base>/v=<time>-<id>``, and becomes visible when the catalog's partition is pointed at it.
Spark asks the catalog for the locations when it plans a read, not when a view is made, so views and DataFrames over the
table, in any session of the application (or of the metastore), see the new version at their next read, and a read that
has begun goes on with the old one.  Nothing is overwritten in place.

* a table that is replaced whole has one partition (``slot = 'current'``);
* a table kept by period has one partition, and so one pointer, a period.

A write's ``_SUCCESS`` file says that a version is complete.  An application with a catalog of its own starts with
``attach``, which points the tables at the newest complete versions.  Superseded versions stay until ``drop_old``.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from aurum.session import children, delete_folder, path_exists

SLOT, CURRENT = "slot", "current"


def new_version(base: str) -> str:
    """A fresh version folder; names sort by the time of writing."""
    return f"{base.rstrip('/')}/v={dt.datetime.now(dt.timezone.utc):%Y%m%d%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def complete_versions(spark: SparkSession, base: str) -> list[str]:
    """The complete version folders of a table, oldest first."""
    base = base.rstrip("/")
    return [f"{base}/{n}" for n in children(spark, base) if n.startswith("v=") and path_exists(spark, f"{base}/{n}/_SUCCESS")]


def _quoted(table: str) -> str:
    return ".".join(f"`{x}`" for x in table.split("."))


def ensure(spark: SparkSession, table: str, base: str, schema: T.StructType, by: str | None = None) -> None:
    """Register ``table`` unless the catalog has it with this base folder and these columns (a changed schema registers it anew)."""
    have = [f for f in schema.fields if f.name != by]
    cols = [f"`{f.name}` {f.dataType.simpleString()}" for f in have]
    part = f"`{by}` {schema[by].dataType.simpleString()}" if by else f"`{SLOT}` string"
    if spark.catalog.tableExists(table):
        now = spark.table(table).schema
        same = [(f.name, f.dataType) for f in now.fields[:-1]] == [(f.name, f.dataType) for f in have] and now.fields[-1].name == (by or SLOT)
        at = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(table)}").where("col_name = 'Location'").first()
        if same and at is not None and at.data_type.split(":", 1)[-1].rstrip("/").lstrip("/") == base.split(":", 1)[-1].rstrip("/").lstrip("/"):
            return
        spark.sql(f"DROP TABLE {_quoted(table)}")  # external: the files stay
    spark.sql(f"CREATE TABLE {_quoted(table)} ({', '.join([*cols, part])}) USING parquet "
              f"PARTITIONED BY (`{by or SLOT}`) LOCATION '{base.rstrip('/')}'")


def _point(spark: SparkSession, table: str, spec: str, path: str) -> None:
    spark.sql(f"ALTER TABLE {_quoted(table)} ADD IF NOT EXISTS PARTITION ({spec}) LOCATION '{path}'")
    spark.sql(f"ALTER TABLE {_quoted(table)} PARTITION ({spec}) SET LOCATION '{path}'")


def replace(spark: SparkSession, df: DataFrame, table: str, base: str) -> str:
    """CREATE OR REPLACE TABLE AS SELECT: write a new version of ``table`` and point at it; returns its folder."""
    path = new_version(base)
    df.write.parquet(path)
    ensure(spark, table, base, df.schema)
    _point(spark, table, f"`{SLOT}` = '{CURRENT}'", path)
    return path


def replace_periods(spark: SparkSession, df: DataFrame, table: str, base: str, by: str) -> list:
    """Write ``df`` (whole periods) as a new version and point the periods that it holds at it; returns them."""
    path = new_version(base)
    df.write.partitionBy(by).parquet(path)
    ensure(spark, table, base, df.schema, by)
    return _point_periods(spark, table, path, by, None)


def _point_periods(spark: SparkSession, table: str, version: str, by: str, only: set | None) -> list:
    names = [n for n in children(spark, version) if n.startswith(f"{by}=") and (only is None or n in only)]
    known = {r.partition for r in spark.sql(f"SHOW PARTITIONS {_quoted(table)}").collect()}  # one folder a period
    specs = {n: f"PARTITION (`{by}` = '{n.split('=', 1)[1]}')" for n in names}
    fresh = [n for n in names if n not in known]
    for start in range(0, len(fresh), 1000):
        parts = " ".join(f"{specs[n]} LOCATION '{version}/{n}'" for n in fresh[start:start + 1000])
        spark.sql(f"ALTER TABLE {_quoted(table)} ADD {parts}")
    for n in names:
        if n in known:
            spark.sql(f"ALTER TABLE {_quoted(table)} {specs[n]} SET LOCATION '{version}/{n}'")
    return names


def read(spark: SparkSession, table: str) -> DataFrame:
    """The table as it is whenever the result is read."""
    df = spark.table(table)
    return df.drop(SLOT) if df.columns[-1] == SLOT else df


def attach(spark: SparkSession, table: str, base: str, schema: T.StructType | None = None, by: str | None = None) -> bool:
    """Register a table from its folder and point it at the newest complete versions; False if there is none
    (and no ``schema`` to register it empty)."""
    done = complete_versions(spark, base)
    if schema is None and not done:
        return False
    ensure(spark, table, base, schema if schema is not None else spark.read.parquet(done[-1]).schema, by)
    if by is None:
        _point(spark, table, f"`{SLOT}` = '{CURRENT}'", done[-1])
        return True
    pointed: set = set()
    for version in reversed(done):  # each period's newest version
        pointed |= set(_point_periods(spark, table, version, by, set(children(spark, version)) - pointed))
    return True


def drop_old(spark: SparkSession, table: str, base: str, keep: int = 2) -> list[str]:
    """Delete complete versions that no partition points at, but for the ``keep`` newest; returns their folders."""
    used = [r.partition for r in spark.sql(f"SHOW PARTITIONS {_quoted(table)}").collect()]  # one a period
    live = set()
    for spec in used:
        k, v = spec.split("=", 1)
        info = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(table)} PARTITION (`{k}` = '{v}')").where("col_name = 'Location'").first()
        live |= {x for x in info.data_type.split("/") if x.startswith("v=")}
    gone = [p for p in complete_versions(spark, base)[:-keep] if p.rsplit("/", 1)[1] not in live]
    for p in gone:
        delete_folder(spark, p)
    return gone


def log_of(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


__all__: Sequence[str] = ["attach", "complete_versions", "drop_old", "ensure", "log_of", "new_version", "read", "replace", "replace_periods"]
