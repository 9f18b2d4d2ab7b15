"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Texts are equal when identical after lower-casing A-Z; null counts as empty. A
group is only taken to the next, finer key while it has more than one row, so
most rows leave after their length or their prefix. Everything is DataFrame
expressions. The grouping works on a table of keys (no texts); groups are
counted before the shuffle, so one group may hold a third of all rows.

Defined cases: rows with a null doc_id take part and are kept only if no row of
their group has an id (``keep_id`` is then null); with several rows of the
largest doc_id, all of them count as kept; an empty table gives an empty result;
columns besides doc_id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import stored

PREFIX = 256  # characters in the prefix hash
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalized(text: str = "text") -> Column:
    return F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER, _LOWER)


def _full_hash() -> Column:
    return F.unhex(F.sha2(normalized(), 256))


def _narrowed(keys: DataFrame, *by: str) -> DataFrame:
    """The rows that share their values of ``by`` with another row.

    Both sides of the join are stored tables, so a hot value can be split.
    """
    repeated = keys.groupBy(*by).agg(F.count("*").alias("n")).where("n > 1").select(*by)
    return stored(keys.join(stored(repeated, "exact-repeated"), list(by), "left_semi"), "exact-narrowed")


def _survivors(docs: DataFrame, digest: bool) -> tuple[DataFrame, DataFrame]:
    """(keys of all rows, keys of the rows that share length and prefix with another one)."""
    columns = ["doc_id", F.octet_length(normalized()).alias("size"), F.xxhash64(F.left(normalized(), F.lit(PREFIX))).alias("prefix")]
    keys = stored(docs.select(*columns, *([_full_hash().alias("digest")] if digest else [])), "exact-keys")
    return keys, _narrowed(_narrowed(keys, "size"), "size", "prefix")


def duplicate_groups(docs: DataFrame) -> DataFrame:
    """(digest, keep_id, group_size) of every group of two or more equal texts.

    Only texts that share length and prefix with another one are hashed in full.
    """
    _, rest = _survivors(docs, digest=False)
    ids = stored(rest.select("doc_id").distinct(), "exact-ids")
    full = docs.join(ids, docs["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi").select("doc_id", _full_hash().alias("digest"))
    return _grouped(full, "digest").select("digest", "keep_id", "group_size")


def _grouped(keys: DataFrame, *by: str) -> DataFrame:
    groups = keys.groupBy(*by).agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    return groups.where("group_size > 1")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document with the row its group keeps (the largest doc_id) and the hash of its text.

    As every row's full hash is asked for here, it is taken in the one scan that
    also takes length and prefix; the refinement then decides which are compared.
    """
    keys, rest = _survivors(docs, digest=True)
    by = ["size", "prefix", "digest"]
    groups = stored(_grouped(rest, *by), "exact-groups")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return keys.join(groups, by, "left").select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
