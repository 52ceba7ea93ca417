from aurum.sinks.writers import (  # noqa: F401
    append_audit, ensure_table, landing_key, latest_snapshot, path_exists, write_landing, write_snapshot,
)
