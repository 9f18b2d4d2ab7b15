"""Landed files: CSV drops and JSON pages, with lineage and a list of what was loaded."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions.text import file_name, plain_path, scanned_path

SOURCE_FILE = "_source_file"
INGESTED_AT = "_ingested_at"
# Where a row stands in its file: the start of the split, then the running
# number within the split. Ordered as (file, block, position).
BLOCK = "_block"
POSITION = "_position"

FILES = "path string, modified_at timestamp, size bigint"


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def with_lineage(scan: DataFrame) -> DataFrame:
    """Source file, ingest time and row position; must follow the scan directly."""
    return scan.select(
        "*",
        scanned_path().alias(SOURCE_FILE),
        F.current_timestamp().alias(INGESTED_AT),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(POSITION),
    )


def newest_landed_first() -> list[Column]:
    """Later ingest wins, then the later file, then the later row of the file."""
    return [F.desc(INGESTED_AT), F.desc(SOURCE_FILE), F.desc(BLOCK), F.desc(POSITION)]


def read_csv_raw(
    spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str], **options: str
) -> DataFrame:
    """Delimited files with a header, every column as text. An empty field is NULL.

    A header that does not match ``columns`` is an error, not a silent shift.
    """
    reader = spark.read.schema(text_schema(columns))
    reader = reader.options(**{"header": "true", "escape": "\\", "enforceSchema": "false", **options})
    return reader.csv(list(paths) if not isinstance(paths, str) else paths)


def read_json_pages(
    spark: SparkSession,
    root: str,
    schema: T.StructType | str,
    paths: Sequence[str] | None = None,
    arrays: bool = True,
) -> DataFrame:
    """JSON pages below ``run_date=*/``; ``run_date`` becomes a column.

    ``arrays`` reads one JSON array per file, otherwise JSON lines. The schema is
    declared: an empty page contributes no rows and no surprises.
    """
    reader = spark.read.schema(schema).option("basePath", root).option("multiLine", arrays)
    return reader.json(list(paths) if paths is not None else root)


def read_reference_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A typed reference table; the columns are picked by their header names."""
    landed = read_csv_raw(spark, path, _header(spark, path))
    return landed.select([F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def _header(spark: SparkSession, path: str) -> list[str]:
    return spark.read.option("header", True).option("escape", "\\").csv(path).columns


def list_files(spark: SparkSession, glob: str, modified_after: str | None = None) -> DataFrame:
    """Path, time and size of the files of a landing folder (changed after a time in UTC); contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after).option("timeZone", "UTC")
    try:
        found = reader.load(glob)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], FILES)
        raise
    return found.select(
        plain_path("path").alias("path"),
        F.col("modificationTime").alias("modified_at"),
        F.col("length").alias("size"),
    )


def unseen(files: DataFrame, seen: DataFrame, by_name: bool = False) -> DataFrame:
    """Files that are not in the list of loaded ones, by full path or by file name only."""
    if not by_name:
        return files.join(seen.select("path"), "path", "left_anti")
    known = seen.select(file_name("path").alias("_name")).distinct()
    return files.withColumn("_name", file_name("path")).join(known, "_name", "left_anti").drop("_name")


def ledger(spark: SparkSession, path: str, held: DataFrame | None = None) -> DataFrame:
    """Files loaded by the versions in ``held`` (version, run), empty ones included; all noted files without it.

    Files are noted under the number of the version they go into and the name of the
    run that makes it, before that version becomes visible. A note counts only if the
    version of its number was made by its run: where the run died, another run, or a
    restore, takes the number, and the files are loaded again.
    """
    try:
        noted = spark.read.schema(f"{FILES}, run string, version int").parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], FILES)
        raise
    if held is not None:
        made = held.select(F.col("version").alias("_made"), F.col("run").alias("_by"))
        noted = noted.join(made, (F.col("version") == F.col("_made")) & F.col("run").eqNullSafe(F.col("_by")), "left_semi")
    return noted.drop("version", "run")


def record(files: DataFrame, path: str, version: int, run: str | None = None) -> None:
    """Note the files that a run puts into a version of the table."""
    noted = files.select("path", "modified_at", "size", F.lit(run).cast("string").alias("run"))
    noted.write.mode("overwrite").parquet(f"{path}/version={version}")
