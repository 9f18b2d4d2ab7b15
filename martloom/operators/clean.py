"""Cleaning: typed columns, reject routing, latest version per key, audit counts."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions import text

REASON = "_reason"
RAW = "_raw"


def coerce(df: DataFrame, spec: Mapping[str, Callable[[str], Column]]) -> DataFrame:
    """Replace each named column by its typed form, in one projection."""
    return df.select([spec[c](c).alias(c) if c in spec else F.col(c) for c in df.columns])


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim every text column, found from the schema."""
    return df.select(
        [
            F.trim(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def drop_blank_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.filter(reduce(and_, [~text.is_blank(k) for k in keys]))


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which all the named columns have a value."""
    return df.dropna(how="any", subset=list(columns))


def with_reason(df: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Add the reason of the first rule (column, reason) whose column is NULL."""
    tests = [F.when(F.col(column).isNull(), F.lit(reason)) for column, reason in rules]
    return df.withColumn(REASON, F.coalesce(*tests))


def split_rejects(df: DataFrame, rules: Sequence[tuple[str, str]]) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected); the rejected rows keep their reason and raw text."""
    judged = with_reason(df, rules)
    accepted = judged.filter(F.col(REASON).isNull()).drop(REASON, RAW)
    rejected = judged.filter(F.col(REASON).isNotNull()).select(
        F.col(REASON).alias("reason"), F.col(RAW).alias("raw_row")
    )
    return accepted, rejected


def dedup_latest(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """The first row of every key in the given total order.

    Spark limits each key to one row per input partition before the shuffle
    (WindowGroupLimit), so a key that holds a third of the table reaches its
    reducer as one row per upstream task.
    """
    window = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def superseded_counts(
    df: DataFrame, keys: Sequence[str], version: Column, by: Sequence[str]
) -> DataFrame:
    """Rows of each group that lost against a greater ``version`` of their key.

    Versions are first counted per key and group, with a partial count before
    the shuffle; the window then sees one row per group a key occurs in, never
    all versions of the key.
    """
    counted = df.groupBy(*keys, *by).agg(F.count(F.lit(1)).alias("_n"), F.max(version).alias("_newest"))
    ranked = counted.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("_newest"))))
    lost = F.col("_n") - F.when(F.col("_rn") == 1, 1).otherwise(0)
    return ranked.groupBy(*by).agg(F.sum(lost).alias("superseded"))


def audit(judged: DataFrame, key: str) -> DataFrame:
    """raw, rejected, duplicate and clean counts of a judged batch, in one pass."""
    accepted = F.col(REASON).isNull()
    counts = judged.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(~accepted).alias("rejected_rows"),
        F.count_distinct(F.when(accepted, F.col(key))).alias("clean_rows"),
    )
    return counts.select(
        "raw_rows",
        "rejected_rows",
        (F.col("raw_rows") - F.col("rejected_rows") - F.col("clean_rows")).alias("duplicate_rows"),
        "clean_rows",
    )


def seeded_pick(df: DataFrame, column: str, seed: int, k: int = 1) -> DataFrame:
    """``k`` distinct values, picked by the hash of seed and value: the same ones however the rows are dealt.

    The values with the smallest hashes are the sample, so samples of parts merge by
    taking the smallest again; every task keeps ``k`` and nothing is sorted as a whole.
    """
    values = df.select(column).filter(F.col(column).isNotNull()).distinct()
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(column).cast("string")))
    return values.withColumn("_order", order).orderBy("_order", column).limit(k).drop("_order")


def distinct_rows(df: DataFrame, ignoring: Sequence[str] = ()) -> DataFrame:
    """Drop exact copies, judged on the data columns alone."""
    return df.dropDuplicates([c for c in df.columns if c not in ignoring])
