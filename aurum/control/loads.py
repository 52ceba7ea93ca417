"""Load control: config table, watermarks, current period and incremental slices.

Scalars that steer a load (a watermark, the current period) are one-row aggregates;
``scalar`` fetches such a value so later filters are literals and prune partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aurum.functions.scalars import safe_long

ACTIVE = "1"


def active_tables(config: DataFrame, datasource: str) -> DataFrame:
    """Config rows with is_active = '1' for ``datasource`` (string comparison, as stored)."""
    return config.where((F.col("is_active") == F.lit(ACTIVE)) & (F.col("datasource") == F.lit(datasource)))


def latest_watermarks(audit: DataFrame, data_source: str | None = None) -> DataFrame:
    """Per table: the highest numeric watermark (text cast to integer, so '10' > '9');
    NULL or missing -> 0."""
    a = audit if data_source is None else audit.where(F.col("data_source") == data_source)
    return a.groupBy("tablename").agg(
        F.coalesce(F.max(safe_long("load_watermark")), F.lit(0).cast("long")).alias("latest_watermark"))


def latest_watermark(audit: DataFrame, table: str, data_source: str | None = None) -> DataFrame:
    """One-row frame: the watermark of ``table`` (0 when it has none)."""
    a = audit.where(F.col("tablename") == table)
    if data_source is not None:
        a = a.where(F.col("data_source") == data_source)
    return a.agg(F.coalesce(F.max(safe_long("load_watermark")), F.lit(0).cast("long")).alias("latest_watermark"))


def current_period(periods: DataFrame, id_col: str = "gameweek_id", current: str = "is_current",
                   finished: str = "is_finished") -> DataFrame:
    """One row: the current period, else the last finished one, else 1."""
    return periods.agg(F.coalesce(
        F.min(F.when(F.col(current) == F.lit(True), F.col(id_col))),
        F.max(F.when(F.col(finished) == F.lit(True), F.col(id_col))),
        F.lit(1).cast("long")).alias("current_period"))


def latest_final_period(periods: DataFrame, id_col: str = "gameweek_id", finished: str = "is_finished",
                        checked: str = "is_data_final") -> DataFrame:
    """One row: the last period that is finished AND data-checked, else 0."""
    ok = (F.col(finished) == F.lit(True)) & (F.col(checked) == F.lit(True))
    return periods.agg(F.coalesce(F.max(F.when(ok, F.col(id_col))), F.lit(0).cast("long"))
                       .alias("latest_final_period"))


def scalar(one_row: DataFrame) -> int:
    """Fetch the single value of a one-row aggregate (a scalar, not data)."""
    return int(one_row.first()[0])


def incremental_slice(facts: DataFrame, last_watermark: int, current: int, period_col: str = "gameweek") -> DataFrame:
    """Rows of periods last_watermark+1 .. current (literal bounds: partition pruning)."""
    return facts.where(F.col(period_col).between(F.lit(last_watermark + 1), F.lit(current)))


def watermark_plan(watermarks: DataFrame, current: Column | int, final: Column | int) -> DataFrame:
    """Per table: slice bounds of the next incremental load and the watermark to record.

    The recorded watermark is the last finished-and-checked period, so open periods are
    pulled again (and upserted) on the next run.
    """
    cur = current if isinstance(current, Column) else F.lit(current).cast("long")
    fin = final if isinstance(final, Column) else F.lit(final).cast("long")
    return watermarks.select(
        "tablename", "latest_watermark",
        (F.col("latest_watermark") + 1).alias("slice_from"),
        cur.alias("slice_to"),
        (cur > F.col("latest_watermark")).alias("has_new_periods"),
        fin.alias("next_watermark"))


def audit_rows(counts: DataFrame, data_source: str, table: str, load_type: str, clock: Column,
               period_col: str = "period", count_col: str = "record_count") -> DataFrame:
    """Audit records from per-period record counts: watermark text = the period."""
    return counts.select(
        F.lit(data_source).alias("data_source"), F.lit(table).alias("tablename"),
        F.lit(load_type).alias("load_type"), F.col(count_col).cast("long").alias("record_count"),
        F.col(period_col).cast("string").alias("load_watermark"), clock.alias("load_timestamp"),
        F.when(F.col(count_col) > 0, F.lit("SUCCESS")).otherwise(F.lit("EMPTY")).alias("status"))


def dispatch(config_rows: DataFrame, builders: Mapping[str, Callable[..., DataFrame]],
             datasource: str) -> dict[str, tuple[str, Callable[..., DataFrame]]]:
    """Active config rows -> {table: (load_type, builder)}; load types
    are lower-cased, an active table without a builder is an error.

    The config table is a handful of control rows, so it is read on the driver.
    """
    out = {}
    for r in active_tables(config_rows, datasource).select("table_name", "load_type").collect():
        if r["table_name"] not in builders:
            raise ValueError(f"no extractor for active table {r['table_name']!r}")
        out[r["table_name"]] = ((r["load_type"] or "").lower(), builders[r["table_name"]])
    return out
