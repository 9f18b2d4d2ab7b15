"""Upserts of one table into another, composed from joins.

All joins here are semi, anti or left joins with the incoming rows on the right.
An increment that was measured and found small (``small_side``) is broadcast and
the big target is read without a shuffle; otherwise the plan is a sort-merge join
whose left side adaptive execution can split if it is skewed. NULL keys never
match.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.operators.clean import dedup_latest
from martloom.session import pinned

# Largest measured increment that is broadcast.
BROADCAST_BYTES = 64 * 1024 * 1024


# A target of fewer rows than this many times the increment's is joined as it is, without a filter of keys.
FILTER_FROM = 8


@dataclass(frozen=True)
class Size:
    """Rows of an increment, and about how many bytes they take in memory."""

    rows: int
    bytes: int


def measured(df: DataFrame) -> Size:
    """Texts and nested values are measured; other values count with their fixed place."""
    fixed = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)
    long = [f.name for f in df.schema.fields if not isinstance(f.dataType, fixed)]
    sums = [F.sum(F.octet_length(F.col(c).cast("string"))) for c in long]
    found = df.agg(F.count(F.lit(1)), *sums).first()
    return Size(found[0], found[0] * 24 * len(df.columns) + sum(n or 0 for n in found[1:]))


def marked(df: DataFrame, size: Size, limit: int | None = None) -> DataFrame:
    """Mark a measured increment for broadcast if it is small enough."""
    return F.broadcast(df) if size.bytes <= (BROADCAST_BYTES if limit is None else limit) else df


def small_side(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Measure a stored increment; mark it for broadcast if it is small enough.

    Stored rows carry no size estimate, so without this Spark would shuffle the
    target even for a handful of incoming rows. The mark holds for columns
    picked from the result as well.
    """
    return marked(df, measured(df), limit)


# A Bloom filter in blocks of 4 KB: about BITS bits and PROBES marks per key, 16 MB in all at most.
BLOCK_BITS, BITS, PROBES, MAX_BLOCKS = 32_768, 16, 3, 4_096


def _places(keys: Sequence[str], blocks: Column) -> tuple[Column, list[Column]]:
    """The block a key falls into and its marks there."""
    block = F.pmod(F.xxhash64(F.lit(0), *keys), blocks)
    return block, [F.pmod(F.xxhash64(F.lit(i + 1), *keys), F.lit(BLOCK_BITS)) for i in range(PROBES)]


def key_filter(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(block, bits, blocks): a Bloom filter of the keys, a row per block; filters of one size merge by bitmap_or_agg.

    Tasks set bits before the shuffle, so what moves is bitmaps, not keys. With more
    keys than MAX_BLOCKS hold at full strength, more rows pass; none is ever lost.
    """
    count = source.agg(F.count(F.lit(1)).alias("n")).select(
        F.least(F.lit(MAX_BLOCKS), F.greatest(F.lit(1), F.ceil(F.col("n") * BITS / BLOCK_BITS))).cast("bigint").alias("blocks")
    )
    blocks = F.lit(count.first().blocks)
    block, marks = _places(keys, blocks)
    set_ = source.dropna(how="any", subset=list(keys)).select(block.alias("block"), F.explode(F.array(*marks)).alias("mark"))
    return set_.groupBy("block").agg(F.bitmap_construct_agg("mark").alias("bits")).withColumn("blocks", blocks)


def may_match(target: DataFrame, bloom: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target rows whose keys the filter lets through: all that match, and few others.

    The filter is pinned and broadcast: its size is bounded by MAX_BLOCKS.
    """
    bloom = pinned(bloom)  # a few rows of bitmaps
    first = bloom.first()
    if first is None:
        return target.limit(0)
    block, marks = _places(keys, F.lit(first.blocks))
    names = ["_block", "_bits", *(f"_mark{i}" for i in range(len(marks)))]
    marked = target.withColumns(dict(zip(names[2:], marks, strict=True))).withColumn("_block", block)
    sides = F.broadcast(bloom.select(F.col("block").alias("_block"), F.col("bits").alias("_bits")))
    hit = F.lit(True)
    for name in names[2:]:
        byte = F.conv(F.hex(F.expr(f"substring(_bits, cast({name} div 8 as int) + 1, 1)")), 16, 10).cast("int")
        hit &= byte.bitwiseAND(F.expr(f"shiftleft(1, cast({name} % 8 as int))")) != 0
    # keys that hang on the filter: a join on them is not moved in front of it
    passed = [F.when(hit, F.col(c)).alias(c) if c in keys else F.col(c) for c in target.columns]
    return marked.join(sides, "_block").where(hit).select(passed)


def matching(
    target: DataFrame, source: DataFrame, keys: Sequence[str], size: Size | None = None, target_rows: int | None = None
) -> DataFrame:
    """Target rows whose key occurs in the (stored) source.

    A small source is broadcast. Otherwise a Bloom filter of its keys goes to the
    target's scan first, so that what is shuffled for the join is near the matches and not the target;
    not so where the target is known to be no more than FILTER_FROM times the source.
    """
    keys = list(keys)
    wanted = source.select(*keys)
    size = size or measured(source)
    if size.bytes > BROADCAST_BYTES and (target_rows is None or target_rows > FILTER_FROM * size.rows):
        target = may_match(target, key_filter(wanted, keys), keys)
    return target.join(wanted, keys, "left_semi")


class DuplicateKeys(ValueError):
    """More than one incoming row for one target row."""


def require_unique(source: DataFrame, keys: Sequence[str]) -> None:
    """An upsert may bring only one row per key (NULL keys are inserted as they are)."""
    repeated = (
        source.dropna(how="any", subset=list(keys))
        .groupBy(*keys)
        .count()
        .filter("count > 1")
        .limit(1)
    )
    if not repeated.isEmpty():
        raise DuplicateKeys(f"more than one source row per {list(keys)}")


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Matched rows take all columns from the source; the rest is added or kept."""
    keys = list(keys)
    kept = target.join(source.select(keys), keys, "left_anti")
    return kept.select(target.columns).unionByName(source.select(target.columns))


def merge_partial(
    target: DataFrame, source: DataFrame, keys: Sequence[str], update_columns: Sequence[str]
) -> DataFrame:
    """Matched rows take only ``update_columns``; unmatched source rows come in whole.

    A NULL in the source overwrites, so the choice hangs on a match flag and
    not on coalesce.
    """
    keys = list(keys)
    incoming = source.select(
        *keys, *[F.col(c).alias(f"_new_{c}") for c in update_columns], F.lit(True).alias("_hit")
    )
    updated = target.join(incoming, keys, "left").select(
        [
            F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
            if c in update_columns
            else F.col(c)
            for c in target.columns
        ]
    )
    return updated.unionByName(unmatched(target, source, keys).select(target.columns))


def merge_stamped(
    target: DataFrame, source: DataFrame, keys: Sequence[str], stamp: Column, column: str = "loaded_at"
) -> DataFrame:
    """Upsert that stamps inserted and changed rows; a row that comes in as it is stored keeps the time it was loaded at.

    ``target`` has the stamp's column, ``source`` does not. NULLs compare as values.
    """
    keys, data = list(keys), [c for c in target.columns if c != column]
    same = [F.col(f"s.{k}") == F.col(f"t.{k}") for k in keys]
    same += [F.col(f"s.{c}").eqNullSafe(F.col(f"t.{c}")) for c in data if c not in keys]
    changes = source.select(data).alias("s").join(target.alias("t"), same, "left_anti")
    return merge_upsert(target, changes.withColumn(column, stamp.cast(target.schema[column].dataType)), keys)


def unmatched(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows with no partner in the target.

    The target is first cut down to the keys that occur in the source, so the
    second join works on no more rows than the source has.
    """
    keys = list(keys)
    hits = target.select(keys).join(source.select(keys), keys, "left_semi")
    return source.join(hits, keys, "left_anti")


def merge_latest(
    target: DataFrame, source: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]
) -> DataFrame:
    """Upsert in which a key keeps whichever version is newest, stored or incoming."""
    keys = list(keys)
    wanted = source.select(keys)
    contenders = target.join(wanted, keys, "left_semi").unionByName(source.select(target.columns))
    winners = dedup_latest(contenders, keys, newest_first)
    return target.join(wanted, keys, "left_anti").select(target.columns).unionByName(winners)


def insert_missing(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the rows whose key is new; stored rows stay untouched."""
    return target.unionByName(unmatched(target, source, keys).select(target.columns))


def merge_counts(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many source rows would be inserted and how many would update."""
    keys = list(keys)
    hits = target.select(keys).join(source.select(keys), keys, "left_semi")
    marks = source.select(F.lit(1).alias("source"), F.lit(0).alias("hit")).unionByName(
        hits.distinct().select(F.lit(0).alias("source"), F.lit(1).alias("hit"))
    )
    return marks.agg(
        (F.coalesce(F.sum("source"), F.lit(0)) - F.coalesce(F.sum("hit"), F.lit(0))).alias("inserted"),
        F.coalesce(F.sum("hit"), F.lit(0)).alias("updated"),
    )


def shared_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur on both sides."""
    return left.select(*keys).intersect(right.select(*keys))
