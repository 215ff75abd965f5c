"""Structured Streaming: incremental ingestion of the daily archive."""

from stratus.streaming.ingest import ingest_daily_stream  # noqa: F401
