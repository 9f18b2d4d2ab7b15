"""Retail analytics as Spark jobs: ingest, clean, version, model, test, measure."""

from martloom.session import get_spark, shared_dir

__all__ = ["get_spark", "shared_dir"]
