"""File-arrival ingest of the per-player-per-period table with Structured Streaming.

``readStream`` over the landing folder -> per micro-batch: keep the latest landed copy of
each key, type it (silver), upsert it into the partitioned target -> ``availableNow``
trigger, so a scheduled run processes whatever arrived and stops.  The stream checkpoint
records which landing files were processed (replacing "move processed files aside"), and
a replayed batch re-applies the same upsert, so a restart after a lost executor or driver
gives the same table.

A line that is no JSON object, doesn't fit the declared types or lacks a key goes to the
rejects, under its micro-batch, and the stream goes on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aurum.functions.scalars import date_from_name
from aurum.operators.merge import merge_upsert
from aurum.plans.silver import LIVE_KEYS, silver_live
from aurum.sinks.writers import LANDING_KEY, ensure_table, write_rejects
from aurum.sources.landed import declared
from aurum.sources.schemas import LIVE


def latest_copy(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """One row per key: the row with the greatest ``order`` (ties: any one).

    A ``max_by`` aggregate, so copies of a key are combined map-side before the shuffle
    (a key landed many times never gathers all its copies in one task).
    """
    cols = df.columns
    packed = df.select(*keys, order.alias("__ord"), F.struct(*cols).alias("__row"))
    return packed.groupBy(*keys).agg(F.max_by("__row", "__ord").alias("__row")).select("__row.*")


def ingest_live(spark: SparkSession, landing_dir: str, target_path: str, checkpoint_dir: str,
                loaded_at: Column | None = None,
                transform: Callable[[DataFrame], DataFrame] | None = None,
                max_files: int = 1000, rejects: str | None = None) -> None:
    """Process every landed live file not yet seen and upsert it into ``target_path``.

    Lines that don't fit are quarantined at ``rejects`` (by default beside the checkpoint).

    A micro-batch takes at most ``max_files`` files, the oldest first, so that a first run over
    all history is several bounded upserts; each is checkpointed by itself.
    """
    # CREATE TABLE IF NOT EXISTS before the first upsert (typed like the silver rows)
    empty = silver_live(spark.createDataFrame([], LIVE), loaded_at)
    ensure_table(spark, target_path, empty.schema, ["gameweek"])
    lines = (spark.readStream.schema(f"raw string, {LANDING_KEY} string")
                  .option("maxFilesPerTrigger", max_files).text(landing_dir)
                  .select("raw", LANDING_KEY, F.col("_metadata.file_path").alias("source_file")))
    load_date = date_from_name(F.col(LANDING_KEY), r"_([0-9]{8})()$")
    quarantine = rejects or f"{checkpoint_dir.rstrip('/')}-rejects"

    def upsert(batch: DataFrame, batch_id: int) -> None:
        read = declared(batch.where(F.trim("raw") != ""), LIVE)
        lacking = F.col("id").isNull() | F.col("gameweek").isNull()
        reason = F.coalesce("reject_reason", F.when(lacking, F.lit("line without a key")))
        # kept for both writes: the typed columns, and the text of rejects only
        read = (read.withColumn("reason", reason).withColumn("raw", F.when(F.col("reason").isNotNull(), F.col("raw")))
                    .select(*LIVE.fieldNames(), LANDING_KEY, "source_file", "reason", "raw").persist())
        try:
            write_rejects(read.where(F.col("reason").isNotNull()), quarantine, "gameweek_live", f"batch_{batch_id}")
            good = read.where(F.col("reason").isNull()).select(*LIVE.fieldNames(), LANDING_KEY)
            # bronze keys are (id, gameweek); keep the most recent landing of each
            fresh = latest_copy(good.withColumn("__load_date", load_date), ["id", "gameweek"], F.col("__load_date"))
            typed = silver_live(fresh.drop("__load_date", LANDING_KEY), loaded_at)
            if transform is not None:
                typed = transform(typed)
            merge_upsert(batch.sparkSession, target_path, typed, LIVE_KEYS, "gameweek")  # holds its source itself
        finally:
            read.unpersist()

    q = (lines.writeStream.foreachBatch(upsert)
               .option("checkpointLocation", checkpoint_dir)
               .trigger(availableNow=True)
               .start())
    q.awaitTermination()
