"""Data tests. Every check yields (table_name, check_name, column_name, failures)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.operators.upsert import matching


class DataTestFailed(RuntimeError):
    """At least one data test found failing rows."""


def _result(counts: DataFrame, table: str, check: str, column: str) -> DataFrame:
    return counts.select(
        F.lit(table).alias("table_name"),
        F.lit(check).alias("check_name"),
        F.lit(column).alias("column_name"),
        F.coalesce(F.col("failures"), F.lit(0)).cast("bigint").alias("failures"),
    )


def not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Rows without a value, for all the columns of a table in one scan."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], list(columns), "column_name", "failures").select(
        F.lit(table).alias("table_name"),
        F.lit("not_null").alias("check_name"),
        "column_name",
        "failures",
    )


def unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """Values that occur more than once (NULLs do not count)."""
    repeated = (
        df.select(column).filter(F.col(column).isNotNull()).groupBy(column).count().filter("count > 1")
    )
    return _result(repeated.agg(F.count(F.lit(1)).alias("failures")), table, "unique", column)


def accepted_values(df: DataFrame, table: str, column: str, values: Sequence[str]) -> DataFrame:
    """Distinct values outside the list, each counted once."""
    odd = df.select(column).filter(~F.col(column).isin(*values)).distinct()
    return _result(odd.agg(F.count(F.lit(1)).alias("failures")), table, "accepted_values", column)


def relationships(
    child: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Child rows whose value has no parent.

    Child rows are counted per value before the join: the shuffle moves distinct
    values, and a hot foreign key is one row.
    """
    per_value = (
        child.select(F.col(column).alias("_k"))
        .filter(F.col("_k").isNotNull())
        .groupBy("_k")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    orphans = per_value.join(parent.select(F.col(parent_column).alias("_k")), "_k", "left_anti")
    return _result(orphans.agg(F.sum("_n").alias("failures")), table, "relationships", column)


def still_unique(stored: DataFrame, added: DataFrame, table: str, column: str) -> DataFrame:
    """Values of an increment that occur more than once, within it or in stored rows that were unique before.

    Only keys of the increment are looked for; of the stored rows, no more than their
    matches are shuffled.
    """
    values = added.select(column).filter(F.col(column).isNotNull())
    own = values.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    there = matching(stored.select(column), own.select(column), [column]).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    repeated = own.unionByName(there).groupBy(column).agg(F.sum("_n").alias("_n")).filter("_n > 1")
    return _result(repeated.agg(F.count(F.lit(1)).alias("failures")), table, "unique", column)


def still_related(
    stored: DataFrame, added: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str, gone: DataFrame | None = None
) -> DataFrame:
    """Rows without a parent after an increment: new rows that never had one, and stored rows whose parent is in ``gone``.

    ``gone`` holds the parent values that the same run took away; they are not in ``parent`` any more.
    """
    keys = added.select(F.col(column).alias("_k")).filter("_k IS NOT NULL").groupBy("_k").agg(F.count(F.lit(1)).alias("_n"))
    orphans = keys.join(parent.select(F.col(parent_column).alias("_k")), "_k", "left_anti").agg(F.sum("_n").alias("failures"))
    if gone is not None:
        lost = gone.select(F.col(parent_column).alias(column)).distinct()
        left = matching(stored.select(column), lost, [column]).agg(F.count(F.lit(1)).alias("failures"))
        orphans = orphans.unionByName(left).agg(F.sum("failures").alias("failures"))
    return _result(orphans, table, "relationships", column)


def suite(checks: Sequence[DataFrame]) -> DataFrame:
    """All checks as one table with a verdict."""
    together = reduce(DataFrame.unionByName, checks)
    return together.withColumn("passed", F.col("failures") == 0)


def run_suite(checks: Sequence[DataFrame]) -> DataFrame:
    """Run the checks; raise when one finds failing rows. The result is one row per check."""
    results = suite(checks)
    rows = results.collect()
    failed = [f"{r.table_name}.{r.column_name} {r.check_name}: {r.failures}" for r in rows if not r.passed]
    if failed:
        raise DataTestFailed("; ".join(sorted(failed)))
    return results.sparkSession.createDataFrame(rows, results.schema)
