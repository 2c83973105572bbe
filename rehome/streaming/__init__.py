"""Incremental ingestion of export logs (Structured Streaming)."""

from rehome.streaming.ingest import ingest_logs, latest_snapshot  # noqa: F401
