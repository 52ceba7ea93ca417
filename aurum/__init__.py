"""aurum: medallion analytics (bronze -> silver -> gold) as Spark DataFrame jobs.

Sub-packages:
  functions  - column-level scalar helpers (safe casts, rounding, value maps, ratios)
  operators  - reusable relational operators (lookups, unpivot, skew-safe ranking,
               top-n per group, recent-n, partition upsert)
  sources    - bronze schemas and JSON / CSV readers
  sinks      - landing writes, dated snapshots, audit table
  control    - config table, watermarks and incremental slices
  plans      - silver and gold builders, plus the driver-table analogs
  streaming  - file-arrival ingest of the per-period fact table
"""

__all__ = ["functions", "operators", "sources", "sinks", "control", "plans", "streaming"]
