"""MERGE-style upsert of a partitioned parquet table.

``MERGE INTO t USING s ON keys WHEN MATCHED THEN UPDATE * WHEN NOT MATCHED THEN INSERT *``
re-expressed for a plain parquet table partitioned by a period column:

* only partitions the source touches are read and rewritten (run-time bounds and a semi join on
  the touched values, dynamic partition overwrite on write); no list of them reaches the driver;
* in those partitions: target rows without a source match (left anti join on the keys)
  plus all source rows;
* source keys must be unique and non-NULL (MERGE rejects several source rows matching one
  target row; a NULL key never matches and would insert again on every run).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aurum.session import children, path_exists


class MergeError(ValueError):
    pass


def touched_partitions(source: DataFrame, keys: Sequence[str], partition_col: str) -> DataFrame:
    """One row per partition value that the source touches: ``n`` rows, the largest count of a key, a NULL-key flag.

    Rows are counted per key before they are folded per value, so that no value meets in one task.
    """
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    per_key = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return per_key.groupBy(partition_col).agg(
        F.sum("__n").alias("n"), F.max("__n").alias("most"), F.max(null_key).alias("has_null"))


def _check(touched: DataFrame, keys: Sequence[str], unique: bool = True) -> int:
    """Fail on NULL keys and, with ``unique``, on duplicated ones; else the number of rows (one row reaches the driver)."""
    row = touched.agg(F.sum("n").alias("rows"), F.max("most").alias("most"),
                      F.max("has_null").alias("has_null")).first()
    if row["has_null"]:
        raise MergeError(f"source has NULL merge keys {list(keys)}")
    if unique and (row["most"] or 0) > 1:
        raise MergeError(f"source has duplicate merge keys {list(keys)}: several rows would match one target row")
    return row["rows"] or 0


def check_source_keys(source: DataFrame, keys: Sequence[str]) -> None:
    """Fail on NULL or duplicated keys (same rules as the upsert's own check)."""
    _check(touched_partitions(source.withColumn("__all", F.lit(0)), [*keys, "__all"], "__all"), keys)


def merge_upsert(spark: SparkSession, target_path: str, source: DataFrame, keys: Sequence[str],
                 partition_col: str, validate: bool = True) -> dict:
    """Upsert ``source`` into the parquet table at ``target_path`` (partitioned by ``partition_col``).

    ``partition_col`` must be one of ``keys`` so a key never spans partitions.  The table is
    created from the source when missing.  Returns the number of source rows written
    (inserted or updated) and of target rows kept unchanged in the rewritten partitions.
    """
    if partition_col not in keys:
        raise MergeError("the partition column must be part of the merge key")
    target = _target(spark, target_path, source, partition_col) if path_exists(spark, target_path) else None

    def write(result: DataFrame) -> None:
        (result.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
               .partitionBy(partition_col).parquet(target_path))

    return merge_into(target, source, keys, partition_col, write, validate)


def merge_into(target: DataFrame | None, source: DataFrame, keys: Sequence[str], partition_col: str,
               write: Callable[[DataFrame], None], validate: bool = True) -> dict:
    """Merge ``source`` into ``target`` (None: no rows yet) and hand the touched periods, whole, to ``write``.

    NULL keys are always an error; ``validate=False`` only skips the check for duplicated ones.
    """
    # the source feeds the key check, the anti join and the write; the counts per period feed the check, the
    # bounds, the semi join and the salts: both are kept (and computed again if an executor is lost)
    source = source.persist(StorageLevel.MEMORY_AND_DISK)
    touched = touched_partitions(source, keys, partition_col).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _merge(target, source, touched, keys, partition_col, write, validate)
    finally:
        touched.unpersist()
        source.unpersist()


def _target(spark: SparkSession, path: str, source: DataFrame, partition_col: str) -> DataFrame:
    """The target in its own schema; a target column that the source lacks would be lost, so that is an error."""
    # a folder without any period yet has no schema of its own
    filled = any(n.startswith(f"{partition_col}=") for n in children(spark, path))
    own = spark.read.parquet(path).schema if filled else T.StructType([])
    missing = [f.name for f in own.fields if f.name not in source.columns]
    if missing:
        raise MergeError(f"source lacks target columns {missing}")
    kind = source.schema[partition_col]  # folder names carry no type
    return spark.read.schema(T.StructType([f if f.name != partition_col else kind for f in source.schema.fields])).parquet(path)


def _merge(target: DataFrame | None, source: DataFrame, touched: DataFrame, keys: Sequence[str],
           partition_col: str, write: Callable[[DataFrame], None], validate: bool) -> dict:
    cols = source.columns
    n_rows = _check(touched, keys, validate)
    if not n_rows:
        return {"source_rows": 0, "kept_rows": 0}
    mark = "__from_source"
    src = source.select(*cols, F.lit(True).alias(mark))
    if target is not None:
        # bounds known at run time prune the folders before the join picks the touched ones
        span = touched.agg(F.min(partition_col).alias("low"), F.max(partition_col).alias("high"))
        p = F.col(partition_col)
        current = (target.where((p >= span.select("low").scalar()) & (p <= span.select("high").scalar()))
                   .join(touched.select(partition_col), partition_col, "left_semi").select(*cols))
        kept = current.join(source.select(*keys), list(keys), "left_anti")
        result = kept.withColumn(mark, F.lit(False)).unionByName(src)
    else:
        result = src
    # writer layout: hash on (period, salt of the other key columns).  A period gets as many salts as its
    # share of the rows times the writer tasks, so a hot one is spread however many periods there are.
    parts = int(source.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    salts = touched.select(F.col(partition_col).alias("__p"), F.ceil(F.lit(parts) * F.col("n") / F.lit(n_rows)).alias("__salts"))
    rest = [F.col(k) for k in keys if k != partition_col]
    salt = F.pmod(F.xxhash64(*rest), F.col("__salts")) if rest else F.lit(0)
    result = result.join(salts, F.col(partition_col) == F.col("__p")).withColumn("__salt", salt).drop("__p", "__salts")
    obs = Observation(f"merge_{uuid.uuid4().hex[:8]}")
    staged = (result.repartition(parts, F.col(partition_col), F.col("__salt"))
                    .observe(obs, F.count_if(F.col(mark)).alias("source_rows"),
                             F.count_if(~F.col(mark)).alias("kept_rows")))
    write(staged.drop(mark, "__salt"))
    m = obs.get
    return {"source_rows": int(m.get("source_rows", 0)), "kept_rows": int(m.get("kept_rows", 0))}
