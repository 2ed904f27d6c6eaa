"""Structured Streaming: incremental landing-folder ingest into bronze."""

from strata.streaming.landing import ingest_bronze, landing_stream, start_bronze_ingest

__all__ = ["ingest_bronze", "landing_stream", "start_bronze_ingest"]
