"""Incremental landing-zone ingestion with Structured Streaming."""

from barlake.streaming.landing import ingest_landing

__all__ = ["ingest_landing"]
