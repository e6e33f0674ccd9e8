"""Structured Streaming ingest of crawled fare files into the landing table."""

from faresight.streaming.ingest import FARE_RECORD, read_fare_stream, read_landing, run_until_idle, start_ingest

__all__ = ["FARE_RECORD", "read_fare_stream", "read_landing", "run_until_idle", "start_ingest"]
