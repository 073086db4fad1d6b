"""Structured Streaming: incremental ingest (A10) and stateful alert operators."""
