"""Landed text to typed values. A value that does not parse becomes NULL."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_FORMAT = "yyyy-MM-dd"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trimmed(c: Column | str) -> Column:
    return F.trim(col(c))


def empty_to_null(c: Column | str) -> Column:
    """Only the empty text is NULL; blanks stay."""
    return F.nullif(col(c), F.lit(""))


def blank_to_null(c: Column | str) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(trimmed(c), F.lit(""))


def is_blank(c: Column | str) -> Column:
    return col(c).isNull() | (trimmed(c) == "")


def to_int(c: Column | str) -> Column:
    return col(c).try_cast("int")


def to_long(c: Column | str) -> Column:
    """64-bit: a transaction id is date x 1,000,000 + n and overflows 32 bits."""
    return col(c).try_cast("bigint")


def to_whole(c: Column | str) -> Column:
    """Whole number from text such as ``3`` or ``3.0``; a fraction is cut off."""
    return col(c).try_cast("double").try_cast("int")


def to_money(c: Column | str, precision: int = 10) -> Column:
    return col(c).try_cast(f"decimal({precision},2)")


def to_day(c: Column | str) -> Column:
    """The format is asked only about texts that do not look like it; a cast reads the others, faster and to the same day."""
    usual = col(c).rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}\\z") & ~col(c).startswith("0000")
    return F.when(usual, col(c).try_cast("date")).otherwise(F.try_to_date(col(c), DATE_FORMAT))


def to_instant(c: Column | str) -> Column:
    """ISO-8601 text as wall-clock time in UTC, whatever the session zone; text without an offset is UTC already."""
    since = F.make_dt_interval(secs=(F.unix_micros(F.try_to_timestamp(col(c))) / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,6)"))
    moved = F.lit("1970-01-01").cast("timestamp_ntz") + since
    has_offset = col(c).rlike(r"\d[T ]\d.*(?:[zZ]|UTC|GMT|[+-]\d{1,2}(?::?\d{2})?)\s*$")
    return F.when(has_offset, moved).otherwise(col(c).try_cast("timestamp_ntz"))


def raw_row(columns: Iterable[str]) -> Column:
    """The landed row as one line of text; NULLs are left out."""
    return F.concat_ws(",", *[F.col(c) for c in columns])


def file_name(c: Column | str) -> Column:
    return F.element_at(F.split(col(c), "/"), -1)


def plain_path(c: Column | str) -> Column:
    """``file:///a/b`` and ``file:/a/b`` both become ``/a/b``."""
    return F.regexp_replace(col(c), "^file:/+", "/")


def scanned_path(c: Column | str = "_metadata.file_path") -> Column:
    """Path of a scanned file as the file system knows it; scans report it URL-encoded."""
    decoded = F.url_decode(F.replace(col(c), F.lit("+"), F.lit("%2B")))
    return plain_path(F.when(F.contains(col(c), F.lit("%")), decoded).otherwise(col(c)))
