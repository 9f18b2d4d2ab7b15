"""Full snapshots of relational tables over JDBC, read by many tasks at once."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def partition_options(column: str, lower: int, upper: int, partitions: int) -> dict[str, str]:
    """Reader options that cut a numeric key range into one query per task.

    The bounds only shape the ranges: rows outside them and NULL keys are read
    by the outer ranges.
    """
    if partitions < 1 or upper < lower:
        raise ValueError("need partitions >= 1 and upper >= lower")
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(max(upper, lower + 1)),
        "numPartitions": str(partitions),
    }


def read_snapshot(
    spark: SparkSession,
    url: str,
    table: str,
    column: str | None = None,
    lower: int = 0,
    upper: int = 0,
    partitions: int = 1,
    fetch_size: int = 10_000,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Current state of a relational table. Filters and column picks reach the database."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    reader = reader.option("fetchsize", fetch_size).options(**dict(properties or {}))
    if column and partitions > 1:
        reader = reader.options(**partition_options(column, lower, upper, partitions))
    return reader.load()
