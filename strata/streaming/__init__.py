"""Structured Streaming variants of the bronze load (re-aimed micro-batch / late data)."""

from strata.streaming.bronze_stream import dedupe_stream_to_table, dedupe_within_watermark, ingest_bronze

__all__ = ["dedupe_stream_to_table", "dedupe_within_watermark", "ingest_bronze"]
