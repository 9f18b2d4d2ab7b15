"""Versioned tables on plain parquet.

A table is a folder:

    data/v=N/...     files written by version N, by table partition
    log/version=N    one row: what made version N, and which folder holds each
                     table partition as of then; written last

A version exists once its log row does, so a job that dies half-way leaves
nothing visible and the next one overwrites its leftovers. An upsert writes only
the partitions it touches and points to older folders for the rest; a restore
writes no data at all. Each log row carries the marks of the writers: up to which
batch of each the version goes. A restore brings the old marks back, so what it
took away is merged again. One writer per table at a time. What the driver keeps is
one entry per table partition, never rows.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterable, Sequence
from contextlib import ExitStack
from dataclasses import dataclass, field
from functools import reduce
from operator import add

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.operators.layout import MAX_FILE_ROWS, clustered
from martloom.operators import upsert as merges
from martloom.operators.clean import dedup_latest
from martloom.operators.upsert import marked, matching, measured, merge_latest, merge_partial, merge_upsert, require_unique
from martloom.session import kept

ENTRY = (
    "operation string, writer string, batch_id bigint, run string, marks map<string, bigint>, row_count bigint,"
    " partition_by array<string>,"
    " columns string, parts array<struct<part_key:string, folder:string, v:int, row_count:bigint>>"
)
LOG = f"version int, published_at timestamp, {ENTRY}"


_RESTORE = "restore@"  # mark of a restore: its own version, and the one it went back to
MARK = "mark"  # a log row that only moves a writer's mark; not a version to a reader


@dataclass(frozen=True)
class Published:
    """Outcome of a write; ``version`` is None when there was nothing to publish."""

    version: int | None
    inserted: int = 0
    updated: int = 0


@dataclass(frozen=True)
class Layout:
    """How a table is laid out; fixed when the first version is written."""

    partition_by: Sequence[str] = ()
    cluster_by: Sequence[str] = ()
    spread_by: Sequence[str] = field(default=())


def _log(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(LOG).parquet(f"{root}/log")
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def history(spark: SparkSession, root: str) -> DataFrame:
    """Versions of the table, with time, operation and row count."""
    log = _log(spark, root)
    if log is None:
        log = spark.createDataFrame([], LOG)
    return log.filter(F.col("operation") != MARK).drop("columns", "partition_by", "parts", "marks", "run")


def _entry(spark: SparkSession, root: str, version: int | None = None) -> T.Row | None:
    """The log row of a version, the newest by default. Only that row is read; the newest number is in the folder names."""
    log = _log(spark, root)
    if log is None:
        return None
    if version is None:
        version = log.agg(F.max("version").alias("v")).first().v
    return log.filter(F.col("version") == version).first()


def _schema(entry: T.Row) -> T.StructType:
    return T.StructType.fromJson(json.loads(entry.columns))


def exists(spark: SparkSession, root: str) -> bool:
    return _entry(spark, root) is not None


def latest_version(spark: SparkSession, root: str) -> int | None:
    entry = _entry(spark, root)
    return entry.version if entry else None


def _part_key(columns: Sequence[str]) -> Column:
    """Partition values as one text, equal for equal values of any type."""
    return F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in columns])) if columns else F.lit("")


def _keys_of(df: DataFrame, columns: Sequence[str]) -> set[str]:
    """The part keys that occur; made for a row per table partition and task, not for every row."""
    if not columns:
        return set() if df.isEmpty() else {""}
    values = df.select([F.col(c).cast("string").alias(c) for c in columns]).distinct()
    return {r.k for r in values.select(_part_key(columns).alias("k")).distinct().collect()}


def _read_folders(spark: SparkSession, root: str, entry: T.Row, folders: Sequence[T.Row]) -> DataFrame:
    schema = _schema(entry)
    if not folders:
        return spark.createDataFrame([], schema)
    paths = [f"{root}/data/v={f.v}/{f.folder}".rstrip("/") for f in folders]
    typed = T.StructType([*schema.fields, T.StructField("v", T.IntegerType())])
    files = spark.read.schema(typed).option("basePath", f"{root}/data").parquet(*paths)
    return files.select(*schema.fieldNames())


def read(spark: SparkSession, root: str, version: int | None = None) -> DataFrame | None:
    """The table as of a version (the latest by default); None if there is no table."""
    entry = _entry(spark, root, version)
    if entry is None:
        if version is not None and exists(spark, root):
            raise ValueError(f"no version {version} of {root}")
        return None
    return _read_folders(spark, root, entry, entry.parts)


def _write_data(df: DataFrame, root: str, version: int, layout: Layout) -> list[T.Row]:
    """Write the files of a version; return its parts, counted from the file footers."""
    spark = df.sparkSession
    target = f"{root}/data/v={version}"
    writer = clustered(df, layout.partition_by, layout.cluster_by, layout.spread_by) if layout.partition_by else df
    writer = writer.write.mode("overwrite").option("maxRecordsPerFile", MAX_FILE_ROWS)
    if layout.partition_by:
        writer = writer.partitionBy(*layout.partition_by)
    writer.parquet(target)
    stored = spark.read.schema(df.schema).option("basePath", target).parquet(target)
    # rows are counted per file; texts are made for a row per file and task
    values = [F.col(c).cast("string").alias(c) for c in layout.partition_by]
    files = stored.groupBy(F.col("_metadata.file_path").alias("_file"), *values).agg(F.count(F.lit(1)).alias("_rows"))
    path = F.url_decode(F.replace(F.col("_file"), F.lit("+"), F.lit("%2B")))
    folder = F.regexp_extract(path, rf"/v={version}/(?:(.*)/)?[^/]+$", 1)
    return (
        files.select(_part_key(layout.partition_by).alias("part_key"), folder.alias("folder"), "_rows")
        .groupBy("part_key", "folder")
        .agg(F.sum("_rows").alias("row_count"))
        .select("part_key", "folder", F.lit(version).alias("v"), "row_count")
        .collect()
    )


def _commit(
    spark: SparkSession,
    root: str,
    version: int,
    parts: Sequence[T.Row],
    operation: str,
    schema: T.StructType,
    partition_by: Sequence[str],
    writer: str | None,
    batch_id: int | None,
    marks: dict[str, int],
    run: str | None = None,
) -> int:
    """Write the log row; ``marks`` are those before it. Returns the row count of the version."""
    total = sum(p.row_count for p in parts)
    if writer is not None and batch_id is not None:
        marks = {**marks, writer: batch_id}
    row = {
        "operation": operation, "writer": writer, "batch_id": batch_id, "run": run, "marks": marks, "row_count": total,
        "partition_by": list(partition_by), "columns": schema.json(), "parts": [p.asDict() for p in parts],
    }
    (
        spark.range(1, numPartitions=1)
        .select(F.from_json(F.lit(json.dumps(row)), ENTRY).alias("e"))
        .select(F.current_timestamp().alias("published_at"), "e.*")
        .write.mode("overwrite")
        .parquet(f"{root}/log/version={version}")
    )
    return total


def _marks(entry: T.Row | None) -> dict[str, int]:
    return dict(entry.marks or {}) if entry else {}


def _already_done(entry: T.Row | None, writer: str | None, batch_id: int | None) -> bool:
    done = _marks(entry).get(writer)
    return done is not None and batch_id is not None and done >= batch_id


def _mark(
    spark: SparkSession, root: str, entry: T.Row | None, writer: str | None, batch_id: int | None, run: str | None = None
) -> Published:
    """Note that a batch had no effect, so that it is not looked at again."""
    if entry and writer is not None and batch_id is not None:
        marks, schema = _marks(entry), _schema(entry)
        _commit(spark, root, entry.version + 1, entry.parts, MARK, schema, entry.partition_by, writer, batch_id, marks, run)
    return Published(None)


def _null_parts(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Empty text in partition columns as NULL, which is what the folders give back."""
    texts = [f.name for f in df.schema.fields if f.name in partition_by and isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in texts}) if texts else df


def publish(
    df: DataFrame,
    root: str,
    operation: str = "replace",
    layout: Layout = Layout(),
    writer: str | None = None,
    batch_id: int | None = None,
    unique_by: Sequence[str] = (),
    run: str | None = None,
) -> Published:
    """Write ``df`` as the next version of the whole table (snapshot refresh).

    Keys in ``unique_by`` are checked on the written files, before the version
    becomes visible, so that a large ``df`` is computed only once.
    """
    spark = df.sparkSession
    df = _null_parts(df, layout.partition_by)
    entry = _entry(spark, root)
    version = (entry.version if entry else 0) + 1
    parts = _write_data(df, root, version, layout)
    if unique_by:
        require_unique(spark.read.schema(df.schema).parquet(f"{root}/data/v={version}"), unique_by)
    total = _commit(
        spark, root, version, parts, operation, df.schema, layout.partition_by, writer, batch_id, _marks(entry), run
    )
    return Published(version, inserted=total)


def append(
    df: DataFrame,
    root: str,
    layout: Layout = Layout(),
    writer: str | None = None,
    batch_id: int | None = None,
    run: str | None = None,
) -> Published:
    """Add rows as they are; older files stay where they are. An empty increment only moves the writer's mark.

    ``run`` names the job that makes the version, for notes it left before (see ``held``).
    """
    spark = df.sparkSession
    entry = _entry(spark, root)
    if _already_done(entry, writer, batch_id):
        return Published(None)
    if df.isEmpty() and (entry is not None or writer is None):
        return _mark(spark, root, entry, writer, batch_id, run)
    if entry is None:
        return publish(df, root, "append", layout, writer, batch_id, run=run)
    version = entry.version + 1
    df = _null_parts(df.select(_schema(entry).fieldNames()), entry.partition_by)
    added = _write_data(df, root, version, Layout(entry.partition_by, layout.cluster_by, layout.spread_by))
    total = _commit(
        spark, root, version, [*entry.parts, *added], "append", df.schema, entry.partition_by, writer, batch_id,
        _marks(entry), run,
    )
    return Published(version, inserted=total - entry.row_count)


def added_since(spark: SparkSession, root: str, version: int) -> DataFrame | None:
    """Rows that later versions added to an append-only table; older files are not opened."""
    entry = _entry(spark, root)
    if entry is None:
        return None
    return _read_folders(spark, root, entry, [p for p in entry.parts if p.v > version])


def last_batch(spark: SparkSession, root: str, writer: str) -> int:
    """Number of the last batch of a writer that the current version holds, 0 if none."""
    return _marks(_entry(spark, root)).get(writer, 0)


def held(spark: SparkSession, root: str) -> DataFrame:
    """(version, run) of the versions whose work is part of the current one: all so far but those a restore took back."""
    log, entry = _log(spark, root), _entry(spark, root)
    if log is None or entry is None:
        return spark.createDataFrame([], "version int, run string")
    out = F.lit(True)
    for name, target in _marks(entry).items():
        if name.startswith(_RESTORE):
            out &= ~((F.col("version") > F.lit(target)) & (F.col("version") < F.lit(int(name.removeprefix(_RESTORE)))))
    return log.where(out).select("version", "run")


def replace(
    df: DataFrame, root: str, touched: DataFrame, layout: Layout = Layout(), writer: str | None = None, batch_id: int | None = None
) -> Published:
    """Put the rows of ``df`` in the place of all rows of the table partitions in ``touched``; others are left alone.

    ``touched`` has the partition columns; a partition named there without rows in
    ``df`` is gone afterwards, and rows of other partitions are not allowed in ``df``.
    """
    spark = df.sparkSession
    entry = _entry(spark, root)
    if entry is None:
        return publish(df, root, "replace", layout, writer, batch_id)
    if _already_done(entry, writer, batch_id):
        return Published(None)
    schema = _schema(entry)
    gone = _keys_of(touched, entry.partition_by)
    if not gone:
        return _mark(spark, root, entry, writer, batch_id)
    version = entry.version + 1
    df = _null_parts(df.select(schema.fieldNames()), entry.partition_by)
    added = _write_data(df, root, version, Layout(entry.partition_by, layout.cluster_by, layout.spread_by))
    if stray := {p.part_key for p in added} - gone:
        raise ValueError(f"rows outside the named partitions: {sorted(stray)[:3]}")
    kept = [p for p in entry.parts if p.part_key not in gone]
    total = _commit(
        spark, root, version, [*kept, *added], "replace", schema, entry.partition_by, writer, batch_id, _marks(entry)
    )
    return Published(version, inserted=total - entry.row_count)


def read_parts(spark: SparkSession, root: str, touched: DataFrame) -> DataFrame | None:
    """The rows of the named table partitions; files of others are not opened."""
    entry = _entry(spark, root)
    if entry is None:
        return None
    wanted = _keys_of(touched, entry.partition_by)
    return _read_folders(spark, root, entry, [p for p in entry.parts if p.part_key in wanted])


def changed_parts(spark: SparkSession, root: str, old: int, new: int) -> tuple[DataFrame, DataFrame]:
    """The rows, at version ``old`` and at ``new``, of the table partitions whose files differ between the two."""
    one, two = _entry(spark, root, old), _entry(spark, root, new)
    files = [{}, {}]
    for known, entry in zip(files, (one, two), strict=True):
        for p in entry.parts:
            known.setdefault(p.part_key, set()).add((p.v, p.folder))
    same = {k for k in files[0] if files[0][k] == files[1].get(k)}
    sides = [_read_folders(spark, root, e, [p for p in e.parts if p.part_key not in same]) for e in (one, two)]
    return sides[0], sides[1]


def restore(spark: SparkSession, root: str, version: int) -> Published:
    """Make an old version current again, as a new version that points to its files."""
    entry = _entry(spark, root, version)
    if entry is None:
        raise ValueError(f"no version {version} of {root}")
    schema = _schema(entry)
    new = latest_version(spark, root) + 1
    marks = {**_marks(entry), f"{_RESTORE}{new}": version}
    total = _commit(spark, root, new, entry.parts, f"restore of {version}", schema, entry.partition_by, None, None, marks)
    return Published(new, inserted=total)


def upsert(
    source: DataFrame,
    root: str,
    keys: Sequence[str],
    layout: Layout = Layout(),
    update_columns: Sequence[str] | None = None,
    newest_first: Sequence[Column] | None = None,
    rows_may_move: bool = True,
    writer: str | None = None,
    batch_id: int | None = None,
    in_sequence: bool = False,
) -> Published:
    """Merge ``source`` into the table and publish the result.

    Only the partitions that hold a source row or a matched target row are
    rewritten. ``rows_may_move=False`` promises that a key never changes its
    partition and saves the scan that looks for matches elsewhere. With
    ``newest_first`` a stored row that is newer than the incoming one wins. Rows
    that are in the table already, unchanged, are set aside first; when none is
    left, only the writer's mark moves, so a re-run is a no-op. ``in_sequence``
    refuses a batch whose predecessor the current version does not hold.
    """
    spark = source.sparkSession
    entry = _entry(spark, root)
    if _already_done(entry, writer, batch_id):
        return Published(None)
    if in_sequence and entry is not None and batch_id > _marks(entry).get(writer, batch_id - 1) + 1:
        raise ValueError(f"batch {batch_id} of {writer} does not follow the restored version; start a new checkpoint")
    if entry is None:
        return publish(source, root, "upsert", layout, writer, batch_id, unique_by=keys)

    schema = _schema(entry)
    layout = Layout(entry.partition_by, layout.cluster_by, layout.spread_by)
    columns = schema.fieldNames()
    by_key = defaultdict(list)
    for part in entry.parts:
        by_key[part.part_key].append(part)

    def stored(part_keys: Iterable[str]) -> DataFrame:
        return _read_folders(spark, root, entry, [p for k in part_keys for p in by_key.get(k, [])])

    def matched(part_keys: Iterable[str], rows: DataFrame, size: merges.Size) -> DataFrame:
        part_keys = [k for k in part_keys if k in by_key]
        return matching(stored(part_keys), rows, keys, size, sum(p.row_count for k in part_keys for p in by_key[k]))

    with ExitStack() as until_done:
        source = until_done.enter_context(kept(_null_parts(source.select(columns), entry.partition_by), "source"))
        size = measured(source)
        source = marked(source, size)
        require_unique(source, keys)
        at_home = _keys_of(source, layout.partition_by)
        home = matched(at_home, source, size)
        if newest_first:  # rows that lose against the stored one change nothing
            source = dedup_latest(home.select(columns).unionByName(source), keys, newest_first)
        elif size.bytes > merges.BROADCAST_BYTES and sum(p.row_count for k in at_home for p in by_key.get(k, [])) <= merges.FILTER_FROM * size.rows:
            home = stored(at_home)  # one join with all of it instead of two
        compared = list(update_columns) if update_columns else [c for c in columns if c not in keys]
        changes = source.alias("s").join(home.alias("t"), _same(keys, compared), "left_anti")
        changes = until_done.enter_context(kept(changes, "changes"))
        size = measured(changes)
        if not size.rows:
            return _mark(spark, root, entry, writer, batch_id)
        changes = marked(changes, size)

        touched = _keys_of(changes, layout.partition_by)
        if rows_may_move and layout.partition_by and (others := [k for k in by_key if k not in touched]):
            touched |= _keys_of(matched(others, changes, size), layout.partition_by)
        target = stored(touched)
        if newest_first and rows_may_move:
            merged = merge_latest(target, changes, keys, newest_first)
        elif update_columns and not newest_first:
            merged = merge_partial(target, changes, keys, update_columns)
        else:  # what comes in has won against the stored rows of its partition
            merged = merge_upsert(target, changes, keys)

        version = entry.version + 1
        added = _write_data(merged, root, version, layout)
    unread = [part for part in entry.parts if part.part_key not in touched]
    total = _commit(
        spark, root, version, [*unread, *added], "upsert", schema, layout.partition_by, writer, batch_id, _marks(entry)
    )
    inserted = total - entry.row_count
    return Published(version, inserted, size.rows - inserted)


def _same(keys: Sequence[str], compared: Sequence[str]) -> Column:
    """Rows ``s`` and ``t`` agree. Only the keys are for a join to shuffle by; the rest is looked at where they meet."""
    same = reduce(lambda a, b: a & b, [F.col(f"s.{k}") == F.col(f"t.{k}") for k in keys])
    differing = [F.when(F.col(f"s.{c}").eqNullSafe(F.col(f"t.{c}")), 0).otherwise(1) for c in compared]
    return same & (reduce(add, differing) == 0) if differing else same
