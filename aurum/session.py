"""Session construction and shared scratch locations.

Scratch data (round-trip tables, checkpoints, snapshots) always lives under the
cluster's shared checkpoint folder (``spark.checkpoint.dir``).  A default is set
only when the session has none, which is the local/test situation.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "aurum",
                  extra: dict | None = None) -> SparkSession:
    """Local/test session.  On a cluster the platform's own session is used instead."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; set a local one only when none is configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="aurum-ckpt-")  # local/test sessions only
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint location."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/aurum-scratch/{name}-{uuid.uuid4().hex[:12]}"


def materialized(df: DataFrame, name: str) -> DataFrame:
    """``df`` written under the shared checkpoint location and read back: computed once, and again
    from files, not from lineage, when an executor is lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ready_workers(spark: SparkSession) -> None:
    """Python workers import the package from where the driver has it, unless they are told otherwise."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` (or, for a glob, any match) exists, via the Hadoop FileSystem of the
    path's scheme.  Avoids probing with a failing read, which the session's observation
    listener reports as an error once an ``Observation`` has been used."""
    try:
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
    except Exception:  # noqa: BLE001 - no JVM gateway (e.g. a remote session): probe by reading
        try:
            spark.read.schema("__probe string").format("text").load(path).schema  # noqa: B018
            return True
        except Exception:  # noqa: BLE001
            return False
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    if any(ch in path for ch in "*?[{"):
        matches = fs.globStatus(p)
        return matches is not None and len(matches) > 0
    return bool(fs.exists(p))


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in the folder ``path`` (one listing; none if it is missing), in order."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p) or not fs.getFileStatus(p).isDirectory():
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of the library's own tables, if it exists."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder (a metadata step of the store); what is at ``target`` is replaced."""
    jvm = spark.sparkContext._jvm
    a, b = jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(target)
    fs = a.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(b.getParent())
    fs.delete(b, True)
    if not fs.rename(a, b):
        raise OSError(f"could not move {source} to {target}")


def set_session_defaults(spark: SparkSession) -> None:
    """Pin the semantics the library relies on (UTC clock, dynamic partition overwrite)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for local inspection in tests."""
    return path[len("file:"):] if path.startswith("file:") else path


__all__ = ["build_session", "children", "delete_folder", "ensure_checkpoint_dir", "materialized", "move", "ready_workers", "scratch_path", "set_session_defaults",
           "local_path", "path_exists"]
