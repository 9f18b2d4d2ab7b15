"""The change feed: high-water mark (HWM), increment, pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martloom.session import pinned

CONTROL = "table_name string, id bigint, value timestamp_ntz, updated_at timestamp"
# HWM of a table that was never loaded (fixed value of the control table).
NEVER = "1900-01-01 00:00:00"


def read_control(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(CONTROL).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], CONTROL)
        raise


def hwm_lookup(control: DataFrame, names: DataFrame) -> DataFrame:
    """(table_name, value) for each wanted name: the newest control row, or the default."""
    newest = control.groupBy("table_name").agg(F.max_by("value", "id").alias("value"))
    default = F.lit(NEVER).cast("timestamp_ntz")
    return names.join(newest, "table_name", "left").select(
        "table_name", F.coalesce("value", default).alias("value")
    )


def hwm_value(control: DataFrame, name: str):
    """The HWM of one table as a Python datetime, None if it was never loaded."""
    return control.filter(F.col("table_name") == name).agg(F.max_by("value", "id").alias("v")).first().v


def extract_since(feed: DataFrame, hwm=None, column: str = "modified_at", overlap: str | None = None) -> DataFrame:
    """Rows changed after the HWM (strictly); everything without one.

    ``overlap`` (an interval such as ``1 hour``) reads a bit further back for rows
    that bear the HWM time itself but arrived later; the upsert absorbs repeats.
    """
    if hwm is None:
        return feed
    since = hwm if isinstance(hwm, Column) else F.lit(hwm).cast("timestamp_ntz")
    if overlap:
        since = since - F.expr(f"interval {overlap}")
    return feed.filter(F.col(column) > since)


def next_hwm(increment: DataFrame, old: DataFrame, column: str = "modified_at") -> DataFrame:
    """One row per table: old value and greatest(old value, newest change seen).

    ``increment`` has a ``table_name`` column. A table without new rows keeps its mark.
    """
    seen = increment.groupBy("table_name").agg(F.max(column).alias("_seen"))
    return old.join(seen, "table_name", "left").select(
        "table_name",
        F.col("value").alias("old_value"),
        F.greatest("value", "_seen").alias("new_value"),
    )


def hwm_advance(spark: SparkSession, path: str, name: str, value) -> None:
    """Append the new mark to the control table; the last write of a job."""
    control = read_control(spark, path)
    last = control.filter(F.col("table_name") == name).agg(F.max("id").alias("id")).first().id
    row = spark.range(1, numPartitions=1).select(
        F.lit(name).alias("table_name"),
        F.lit((last or 0) + 1).cast("bigint").alias("id"),
        F.lit(str(value)).cast("timestamp_ntz").alias("value"),
        F.current_timestamp().alias("updated_at"),
    )
    row.write.mode("append").parquet(path)


def page_slice(feed: DataFrame, order: Sequence[str], cursor: int, page_size: int) -> DataFrame:
    """One page of the ordered feed, cut by row numbers: all pages are cut alike and tile the feed.

    An offset would gather everything before the page in one task.
    """
    place = F.col("_row")
    return numbered(feed, order).filter((place >= cursor) & (place < cursor + page_size)).drop("_row")


def page_after(feed: DataFrame, order: Sequence[str], after: Sequence | None, page_size: int) -> DataFrame:
    """The next ``page_size`` rows behind a cursor, the order values of the last row seen (None for the first page).

    Every task keeps its first rows only, so one page neither sorts nor shuffles the feed, and
    rows that came in before the cursor meanwhile do not shift later pages. The order has to
    be unique; NULL comes first. The first column's bound reaches the scan.
    """
    if after is not None:
        seen = F.struct(*[F.lit(v).cast(feed.schema[c].dataType).alias(c) for c, v in zip(order, after, strict=True)])
        if after[0] is not None:
            feed = feed.filter(F.col(order[0]) >= F.lit(after[0]).cast(feed.schema[order[0]].dataType))
        feed = feed.filter(F.struct(*order) > seen)
    return feed.orderBy(*order).limit(page_size)


def cursor_of(page: DataFrame, order: Sequence[str]) -> list | None:
    """The cursor behind a page; None if the page is empty, which ends the feed."""
    last = page.agg(F.max(F.struct(*order)).alias("last")).first().last
    return list(last) if last is not None else None


def numbered(feed: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``_row``, the 0-based place of every row in the order, without one big task.

    The feed is range-partitioned and sorted, then stored once, so that row
    places are fixed even if a task runs twice. A row's place is the number of
    rows in earlier partitions plus its place in its own; the only thing that
    meets in one task is the list of partition sizes.
    """
    stored = pinned(feed.repartitionByRange(*order).sortWithinPartitions(*order))
    # Spark's row id: partition number in the upper bits, place in the lower 33.
    marked = stored.withColumn("_id", F.monotonically_increasing_id())
    marked = marked.select(
        *feed.columns,
        F.shiftright("_id", 33).alias("_part"),
        F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)).alias("_place"),
    )
    sizes = marked.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))
    # One row of two longs per range partition: bounded by the shuffle width.
    placed = marked.join(F.broadcast(starts), "_part")
    return placed.select(*feed.columns, (F.col("_start") + F.col("_place")).alias("_row"))


def paged(feed: DataFrame, order: Sequence[str], page_size: int) -> DataFrame:
    """Add the page number of every row."""
    places = numbered(feed, order)
    return places.withColumn("page", F.floor(F.col("_row") / page_size).cast("bigint"))


def page_arrays(feed: DataFrame, order: Sequence[str], page_size: int) -> DataFrame:
    """(page, rows): the rows of each page as an ordered array, bounded by the page size."""
    gathered = F.array_sort(F.collect_list(F.struct("_row", *feed.columns)))
    ordered = paged(feed, order, page_size).groupBy("page").agg(gathered.alias("_rows"))
    return ordered.select("page", F.transform("_rows", lambda r: r.dropFields("_row")).alias("rows"))


def page_summary(feed: DataFrame, order: Sequence[str], page_size: int, column: str = "modified_at") -> DataFrame:
    """Per page: rows, newest change, cursor of the next page (none on the last), total."""
    pages = (
        paged(feed.select(*dict.fromkeys([*order, column])), order, page_size)
        .groupBy("page")
        .agg(F.count(F.lit(1)).alias("page_rows"), F.max(column).alias("newest"))
    )
    total = pages.agg(F.sum("page_rows").alias("n")).scalar()
    following = (F.col("page") + 1) * page_size
    return pages.withColumn("total_rows", total).withColumn(
        "next_cursor", F.when(following < F.col("total_rows"), following)
    )

