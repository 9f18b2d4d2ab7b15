"""Physical layout of written tables and landed files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions.text import col

# Upper bound of one data file, in rows: about 1 GB of a 10-column fact.
MAX_FILE_ROWS = 20_000_000
# What one writing task takes on: bytes as stored, and files it may have to open.
TASK_BYTES, TASK_FILES = 32 << 20, 300


def write_width(scanned: DataFrame, partitions: int = 1) -> int:
    """Number of tasks for writing about as much as ``scanned``, a stored table, holds into so many table partitions."""
    size = int(scanned._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(1, -(-size // TASK_BYTES), -(-partitions // TASK_FILES))


def clustered(
    df: DataFrame,
    partition_by: Sequence[str],
    cluster_by: Sequence[str] = (),
    spread_by: Sequence[str] = (),
    tasks: int | None = None,
) -> DataFrame:
    """Range-partition and sort, so that each written file covers a narrow key range.

    The range goes over the partition columns and then the cluster columns, so
    a partition that holds a third of the table is spread over many tasks
    instead of falling to one; ``spread_by`` adds unique columns for the case
    that one cluster value is hot as well. Files come out sorted by the cluster
    columns, which is what row-group min/max skipping needs. Adaptive execution
    sizes the tasks, unless ``tasks`` fixes their number: worth it where many
    small partitions make the number of files, not of bytes, the cost.
    """
    order = [*partition_by, *cluster_by, *spread_by]
    ranged = df.repartitionByRange(tasks, *order) if tasks else df.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*partition_by, *cluster_by)


def write_clustered(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    cluster_by: Sequence[str] = (),
    spread_by: Sequence[str] = (),
    mode: str = "overwrite",
    tasks: int | None = None,
) -> None:
    (
        clustered(df, partition_by, cluster_by, spread_by, tasks)
        .write.mode(mode)
        .option("maxRecordsPerFile", MAX_FILE_ROWS)
        .partitionBy(*partition_by)
        .parquet(path)
    )


def newest(df: DataFrame, partition: str) -> Column:
    """The largest value of a partition column, as a literal, from the names of the folders.

    Only the list of folders that the table was opened with is looked at, and then
    whether the newest one has rows at all; where it has none (a writer may leave an empty
    file), the column is read. NULL for an empty table.
    """
    conf, key = df.sparkSession.conf, "spark.sql.optimizer.metadataOnly"
    kind = df.schema[partition].dataType
    before = conf.get(key)
    conf.set(key, "true")
    try:
        value = df.agg(F.max(partition)).first()[0]
    finally:
        conf.set(key, before)
    if value is not None and df.filter(F.col(partition) == F.lit(value)).isEmpty():
        value = df.agg(F.max(partition)).first()[0]
    return F.lit(value).cast(kind)


def _spread(value: Column, bits: int, columns: int) -> Column:
    """The bits of a number with room for those of the other columns between them."""
    one = F.lit(1).cast("bigint")
    moved = [F.shiftleft(F.shiftright(value, bit).bitwiseAND(one), bit * columns) for bit in range(bits)]
    return reduce(Column.bitwiseOR, moved)


def range_rank(df: DataFrame, column: str, bits: int) -> Column:
    """Which of 2**bits ranges of about as many rows a value falls into; NULL is in the first one.

    The bounds are approximate percentiles, one pass over the rows and a bounded sketch
    per task. A value that fills several ranges falls into the last of them.
    """
    ranges = 1 << bits
    order = text_place(column) if isinstance(df.schema[column].dataType, T.StringType) else F.col(column)
    shares = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    bounds = df.agg(F.percentile_approx(order, shares, 10 * ranges).alias("b")).first().b
    if not bounds:  # no row, or none with a value
        return F.lit(0).cast("bigint")
    table = F.array(*[F.lit(b) for b in bounds])
    steps = F.array(*[F.lit(1 << bit) for bit in reversed(range(bits))])
    # halving the sorted bounds: one comparison per bit
    rank = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.element_at(table, at + step) <= order, at + step).otherwise(at))
    return F.when(order.isNull(), F.lit(0)).otherwise(rank).cast("bigint")


def text_place(column: str) -> Column:
    """The first six bytes of a text as a number that sorts like them."""
    digits = F.rpad(F.substring(F.hex(F.encode(F.col(column), "UTF-8")), 1, 12), 12, "0")
    return F.conv(digits, 16, 10).cast("bigint")


def with_place(df: DataFrame, columns: Sequence[str], name: str, bits: int = 8) -> DataFrame:
    """Add the place of a row on a curve through all columns: the bits of their range ranks in turn.

    Rows that are near in every column are near on the curve, so a filter on any of
    the columns leaves few stretches of it.
    """
    if len(columns) * bits > 62:
        raise ValueError(f"{len(columns)} columns of {bits} bits do not fit into one number")
    ranks = [f"{name}{i}" for i in range(len(columns))]
    ranked = df.withColumns({r: range_rank(df, c, bits) for r, c in zip(ranks, columns, strict=True)})
    out = F.lit(0).cast("bigint")
    for i, rank in enumerate(ranks):
        out = out.bitwiseOR(F.shiftleft(_spread(F.col(rank), bits, len(columns)), i))
    return ranked.withColumn(name, out).drop(*ranks)


def recluster(
    df: DataFrame, path: str, columns: Sequence[str], spread_by: Sequence[str] = (), bits: int = 8,
    tasks: int | None = None, row_group_bytes: int | None = None,
) -> None:
    """Write a stored table anew along the curve through ``columns``: same rows, other places.

    The write is range-partitioned on the curve (and ``spread_by``, for a stretch that
    holds much), and files come out sorted by it, so that the least and greatest values
    of a row group are narrow in every column.
    """
    place = "_place"
    marked = with_place(df, columns, place, bits)
    order = [place, *spread_by]
    ranged = marked.repartitionByRange(tasks, *order) if tasks else marked.repartitionByRange(*order)
    writer = ranged.sortWithinPartitions(*order).drop(place).write.mode("overwrite").option("maxRecordsPerFile", MAX_FILE_ROWS)
    if row_group_bytes:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)


def write_indexed(
    df: DataFrame, path: str, key: str, distinct: int, tasks: int | None = None, mode: str = "overwrite"
) -> None:
    """Write a table sorted by a key, for looking single keys up.

    Files cover narrow ranges of the key; inside, pages are short and their index tells
    which of them may hold a key; a Bloom filter per row group (sized for ``distinct`` keys in
    a file) tells that a key within the range is absent. Readers use all three by themselves.
    """
    ranged = df.repartitionByRange(tasks, key) if tasks else df.repartitionByRange(key)
    (
        ranged.sortWithinPartitions(key)
        .write.mode(mode)
        .option("maxRecordsPerFile", MAX_FILE_ROWS)
        .option(f"parquet.bloom.filter.enabled#{key}", "true")
        .option(f"parquet.bloom.filter.expected.ndv#{key}", str(max(1, distinct)))
        .option("parquet.page.row.count.limit", "2000")
        .parquet(path)
    )


def mapped(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Pick and rename columns: {source name: target name}."""
    return df.select([F.col(source).alias(target) for source, target in mapping.items()])


def land_json(df: DataFrame, path: str, run_date: Column | str, page_size: int = 200) -> None:
    """JSON lines under ``run_date=yyyy-MM-dd/``, at most ``page_size`` rows per file."""
    day = F.date_format(col(run_date), "yyyy-MM-dd")
    (
        df.withColumn("run_date", day)
        .write.mode("append")
        .option("maxRecordsPerFile", page_size)
        .option("ignoreNullFields", "false")
        .partitionBy("run_date")
        .json(path)
    )


def land_json_pages(pages: DataFrame, path: str, run_date: Column | str) -> None:
    """One JSON array per file: ``pages`` has one row per page with an array ``rows``."""
    day = F.date_format(col(run_date), "yyyy-MM-dd")
    body = F.to_json("rows", {"ignoreNullFields": "false"})
    (
        pages.select(body.alias("value"), day.alias("run_date"))
        .write.mode("append")
        .option("maxRecordsPerFile", 1)
        .partitionBy("run_date")
        .text(path)
    )


def land_csv(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """CSV with a header; NULL and the empty text both land as an empty field."""
    writer = (
        df.write.mode("append")
        .option("header", True)
        .option("escape", "\\")
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)
