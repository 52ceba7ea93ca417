from aurum.control.loads import (  # noqa: F401
    active_tables, audit_rows, current_period, dispatch, incremental_slice, latest_final_period,
    latest_watermark, latest_watermarks, scalar, watermark_plan,
)
