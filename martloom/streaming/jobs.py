"""Streams over landed files. All run with ``availableNow``: take what is there, then stop."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions.text import scanned_path
from martloom.operators.clean import dedup_latest
from martloom.operators.versions import Layout, upsert
from martloom.sources.files import BLOCK, INGESTED_AT, POSITION, SOURCE_FILE


def stream_files(
    spark: SparkSession, path: str, schema: T.StructType, kind: str, max_files: int = 1000, **options: str
) -> DataFrame:
    """Stream of the files that land in a folder; the checkpoint remembers which were read."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    scan = reader.options(**options).format(kind).load(path)
    return scan.select(
        "*",
        scanned_path().alias(SOURCE_FILE),
        F.current_timestamp().alias(INGESTED_AT),
        F.col("_metadata.file_block_start").alias(BLOCK),
    )


def json_pages(spark: SparkSession, path: str, schema: str, max_files: int = 1000) -> DataFrame:
    """Stream of the rows of landed pages, one JSON array per file, with file and place in the page.

    A page is read as a whole, so its array may span lines. The checkpoint remembers
    every file, empty pages too. A page that does not parse stops the stream: its rows must
    not go missing without a word.
    """
    pages = stream_files(spark, path, T.StructType([T.StructField("value", T.StringType())]), "text", max_files, wholetext="true")
    rows = F.from_json("value", f"array<struct<{_fields(schema)}>>", {"mode": "FAILFAST"})
    placed = pages.select(F.posexplode(rows).alias("_position", "_row"), SOURCE_FILE, INGESTED_AT)
    return placed.select("_row.*", SOURCE_FILE, INGESTED_AT, F.col("_position").alias(POSITION))


def _fields(schema: str) -> str:
    return ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in T.StructType.fromDDL(schema).fields)


def ingest(stream: DataFrame, bronze: str, checkpoint: str) -> None:
    """Append the rows of new files to the bronze table; a second run finds nothing to do."""
    run = (
        stream.writeStream.format("parquet")
        .option("path", bronze)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()


def upsert_stream(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    keys: Sequence[str],
    newest_first: Sequence[Column],
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
    layout: Layout = Layout(),
    rows_may_move: bool = True,
) -> None:
    """Upsert every micro-batch into a versioned table.

    The batch is first reduced to the newest row per key. The batch number is
    kept with the version, so a batch that is replayed after a failure is not
    applied twice. A restore takes the number back with the rows, but not the
    checkpoint: the stream then refuses to go on, instead of leaving the batches
    in between out, until it is started with a new checkpoint.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        newest = dedup_latest(prepare(batch), keys, newest_first)
        upsert(
            newest, table, keys, layout, newest_first=newest_first,
            rows_may_move=rows_may_move, writer=checkpoint, batch_id=batch_id, in_sequence=True,
        )

    run = (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()


def hourly(events: DataFrame, ts: str = "ts", late: str = "5 minutes") -> DataFrame:
    """Events per hour; an hour is final once the stream is ``late`` past its end."""
    stamped = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    return (
        stamped.groupBy(F.window(ts, "1 hour").alias("w"))
        .agg(F.count(F.lit(1)).alias("n_events"), F.sum(F.col("value").cast("decimal(18,4)")).alias("total_value"))
        .select(
            F.col("w.start").alias("hour_start"), F.col("w.end").alias("hour_end"), "n_events", "total_value"
        )
    )


def write_hourly(events: DataFrame, path: str, checkpoint: str) -> None:
    """Append closed hours to a parquet table."""
    run = (
        hourly(events)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
