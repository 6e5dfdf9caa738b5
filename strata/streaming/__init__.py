"""Structured Streaming form of the Bronze ingest (restartable, exactly once)."""

from strata.streaming.ingest import ingest_available

__all__ = ["ingest_available"]
