"""Session settings and the shared folder that jobs write their scratch tables to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings a job wants when it builds its own session. A session handed in by
# the caller is used as it is.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot key may hold a third of a table: split it even where the split
    # costs one more shuffle downstream.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
}


def get_spark(app: str = "martloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings above; ``conf`` uses ``_`` for ``.`` in key names."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session without the setting gets a folder of its own; on
    a cluster a machine-local folder would lose data with the executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="martloom-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet, under the shared folder."""
    return f"{shared_dir(spark)}/scratch/{label}-{uuid.uuid4().hex}"


def pinned(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the checkpoint folder and go on from the stored rows.

    Used where several branches of a job must see the very same rows in the same
    places (row positions): a recomputed branch after a lost executor could otherwise differ.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, label: str = "stored") -> DataFrame:
    """The same for large tables read several times, each time for some columns: kept as parquet, in no order."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def kept(df: DataFrame, label: str = "kept") -> Iterator[DataFrame]:
    """``stored`` for as long as the block runs; its files go with it."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
