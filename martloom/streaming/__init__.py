"""Structured Streaming jobs: file ingest, micro-batch upsert, hourly windows."""
