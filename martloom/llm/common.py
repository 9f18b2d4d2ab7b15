"""Helpers the operators of this package share: stored tables, word hashes, components.

Words are maximal runs of bytes other than space, tab, line feed, vertical tab,
form feed and carriage return. They are hashed in bulk, a slice of documents at
a time, so no task holds more than a few megabytes of text at once.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.session import scratch_dir

SLICE_BYTES = 1 << 20  # text hashed in one go
_M1, _M2, _STEP = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53), np.uint64(0x9E3779B97F4A7C15)
_POWER, _NEXT = 0xD6E8FEB86659FD93, np.uint64(0xA0761D6478BD642F)
_SHIFT = np.uint64(32)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and go on from the stored rows.

    The stored table cuts the lineage, survives lost executors, and lets the
    shuffle files behind it go: the driver's garbage is collected so that Spark's
    cleaner sees that they are no longer needed.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    for _ in range(2):  # the first collection only makes the plan of the write unreachable
        gc.collect()
        spark._jvm.System.gc()
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(df: DataFrame) -> None:
    """Remove the files of a stored table that nothing will read any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._stored_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (a bijection)."""
    x = x ^ (x >> _SHIFT)
    x = x * _M1
    x = x ^ (x >> _SHIFT)
    x = x * _M2
    return x ^ (x >> _SHIFT)


def numbers(n: int, seed: int = 0) -> np.ndarray:
    """``n`` fixed 64-bit numbers that look random."""
    return mixed((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 20)) * _STEP)


_BYTE = numbers(256, 7)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def _powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _POWER, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def slices(texts: Sequence[str | None], lower: bool) -> Iterator[tuple[int, int, list[bytes]]]:
    """(first, last + 1, encoded texts) of runs of about SLICE_BYTES; null is empty."""
    first, size, part = 0, 0, []
    for i, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "surrogatepass")
        part.append(raw.translate(LOWER) if lower else raw)
        size += len(raw)
        if size >= SLICE_BYTES:
            yield first, i + 1, part
            first, size, part = i + 1, 0, []
    if part:
        yield first, len(texts), part


def word_hashes(raws: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the texts, in order, and the number of words before each text (and in all)."""
    data = np.frombuffer(b" ".join(raws) + b" ", dtype=np.uint8)
    blank = _SPACE[data]
    begins = ~blank
    begins[1:] &= blank[:-1]
    starts = np.flatnonzero(begins)
    edges = np.zeros(len(raws) + 1, dtype=np.int64)
    np.cumsum([len(r) + 1 for r in raws], out=edges[1:])
    bounds = np.searchsorted(starts, edges)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), bounds
    data, blank, starts = data[starts[0] :], blank[starts[0] :], starts - starts[0]
    place = np.arange(len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
    values = _BYTE[data] * _powers(int(place.max()) + 1)[place]
    values[blank] = 0
    return mixed(np.add.reduceat(values, starts)), bounds


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive words; entry i begins at word i."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        total = total * _NEXT + words[j : j + n]
    return mixed(total ^ np.uint64(k))


def batches(rows: Iterator[pa.RecordBatch], size: int = 1024) -> Iterator[pa.RecordBatch]:
    """The same rows in record batches of at most ``size`` rows."""
    for batch in rows:
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)


def slim_batches(rows: Iterator[pa.RecordBatch], column: str = "text", size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in record batches of about ``size`` bytes of a column, at least one row each."""
    for batch in rows:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy())
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, before + size, side="right")))
            yield batch.slice(at, upto - at)
            at = upto


def tidied(run: Callable) -> Callable:
    """A map over record batches that gives its memory back when its task ends.

    Workers live on for later tasks, and what one operator has left would come on
    top of what the next one needs.
    """

    def tidy(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(rows)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
            if trim is not None:
                trim(0)

    return tidy


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first()
    return tuple(row)


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, component) of every node with an edge (a, b); the component is its smallest node.

    Alternating large-star and small-star rounds until the edges stay as they
    are, each a join of two stored tables, so that adaptive execution can split
    a node with very many neighbours.
    """
    edges = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    before = None
    while (now := _fingerprint(edges)) != before and now[0]:
        before = now
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = stored(both.groupBy("a").agg(F.min("b").alias("low")), label)
        low = first.select("a", F.least("a", "low").alias("low"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = stored(large.where("a <> b").distinct(), label)
        old = [edges, first]
        low = stored(large.groupBy("a").agg(F.min("b").alias("low")), label)
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            low.select("a", F.col("low").alias("b"))
        )
        edges = stored(small.where("a <> b").distinct(), label)
        for done in (*old, large, low):
            discard(done)
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
