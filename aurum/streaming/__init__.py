from aurum.streaming.live_ingest import ingest_live, latest_copy  # noqa: F401
