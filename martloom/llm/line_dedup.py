"""Reversible line deduplication: cuckoo filters over exact reference counts.

A line's key is the line without blanks at its ends and with A-Z lower-cased.
The index keeps, for every long enough key, which documents hold it, as signed
postings: inserting a document adds +1, deleting it -1. From them an exact
reference table is counted: per key, in how many documents it is, and the
largest of them. Keys are dealt to shards by their hash; each shard has a cuckoo
filter of its *common* keys (in at least ``min_docs`` documents) which takes
insertions and deletions as counts pass the limit, so an increment only touches
the filters of its own keys, and deleting it gives the former filters back.

Looking up the lines of documents asks the filter first, in blocks of keys per
shard; keys it lets through are confirmed in the shard's exact table. A filter
never misses a key, and the table takes out its false positives, so the answer
is exact. A line found in very many documents is one row per document and no
more: counts are summed before the shuffle, and look-ups are blocks by shard.

Defined cases: null text is one empty line; null ids are never the one that
keeps a line, and lose common lines (unless all their documents have null ids:
then nothing is dropped); rows of one id count as one document, and all of them
keep the lines if the id is the largest; an empty table gives an empty result;
extra columns stay as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.common import LOWER, batches, mixed, stored, tidied

SHARDS = 256
MIN_CHARS, MIN_DOCS = 40, 5
BLOCK_KEYS = 1 << 16  # keys of a task that are dealt to their shards at once
SLOTS, KICKS = 4, 500  # entries of a bucket; moves before a filter grows
_BLANK = b" \t\n\x0b\x0c\r"


class CuckooFilter:
    """Sixteen-bit fingerprints in two possible buckets; items can be deleted again.

    An item is a 64-bit hash. A fingerprint that finds no room makes the filter
    twice as large, for which ``grow`` gives all items back.
    """

    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def sized(cls, items: int) -> CuckooFilter:
        buckets = 1 << max(1, int(np.ceil(np.log2(max(items, 1) / SLOTS / 0.8 + 1))))
        return cls(np.zeros((buckets, SLOTS), dtype=np.uint16))

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        marks = ((hashes >> np.uint64(48)) | np.uint64(1)).astype(np.uint16)
        mask = np.uint64(len(self.table) - 1)
        first = hashes & mask
        return marks, first.astype(np.int64), ((first ^ mixed(marks.astype(np.uint64))) & mask).astype(np.int64)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        marks, one, two = self._places(hashes)
        return (self.table[one] == marks[:, None]).any(axis=1) | (self.table[two] == marks[:, None]).any(axis=1)

    def insert(self, value: int) -> bool:
        marks, one, two = self._places(np.array([value], dtype=np.uint64))
        mark, table = marks[0], self.table
        for at in (one[0], two[0]):
            free = np.flatnonzero(table[at] == 0)
            if len(free):
                table[at, free[0]] = mark
                return True
        before, at, moves = table.copy(), two[0], np.random.default_rng(int(value) & 0xFFFF)
        for _ in range(KICKS):
            slot = moves.integers(SLOTS)
            mark, table[at, slot] = table[at, slot], mark
            at = (int(at) ^ int(mixed(np.array([mark], dtype=np.uint64))[0])) & (len(table) - 1)
            free = np.flatnonzero(table[at] == 0)
            if len(free):
                table[at, free[0]] = mark
                return True
        self.table = before
        return False

    def delete(self, value: int) -> bool:
        """Take out one item that was inserted before."""
        marks, one, two = self._places(np.array([value], dtype=np.uint64))
        for at in (one[0], two[0]):
            found = np.flatnonzero(self.table[at] == marks[0])
            if len(found):
                self.table[at, found[0]] = 0
                return True
        return False

    @classmethod
    def of(cls, hashes: np.ndarray) -> CuckooFilter:
        size = len(hashes)
        while True:
            made = cls.sized(size)
            if all(made.insert(h) for h in hashes):
                return made
            size = 2 * max(size, 1)


def _key(line: bytes) -> bytes:
    return line.strip(_BLANK).translate(LOWER)


def line_key(line: str) -> str:
    return _key(line.encode("utf-8", "surrogatepass")).decode("utf-8", "surrogatepass")


def _long_keys(text: str | None, min_chars: int) -> list[bytes | None]:
    """Hash of the key of each line, None for those of fewer code points than ``min_chars``."""
    out: list[bytes | None] = []
    for line in (text or "").encode("utf-8", "surrogatepass").split(b"\n"):
        key = _key(line) if len(line) >= min_chars else b""
        long = len(key) >= min_chars and (key.isascii() or len(key.decode("utf-8", "surrogatepass")) >= min_chars)
        out.append(hashlib.blake2b(key, digest_size=16).digest() if long else None)
    return out


def _posted(batch: pa.RecordBatch, min_chars: int) -> tuple[list[bytes], list[int | None]]:
    """Distinct long keys of every row of a batch, and the row's id beside each."""
    keys, ids = [], []
    for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
        own = set(_long_keys(text, min_chars)) - {None}
        keys += own
        ids += [doc_id] * len(own)
    return keys, ids


def postings(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(key, doc_id): the distinct long keys of every row; the key is a 128-bit hash."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            keys, ids = _posted(batch, min_chars)
            yield pa.record_batch([pa.array(keys, pa.binary()), pa.array(ids, pa.int64())], names=["key", "doc_id"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(tidied(run), "key binary, doc_id bigint")


def _common(refs: pd.DataFrame) -> np.ndarray:
    return np.frombuffer(b"".join(refs["key"]), dtype="<u8").reshape(-1, 2)[:, 0]


class LineIndex:
    """The postings of all documents and the filters of their common lines, in stored tables.

    Every change is a new state; an index object is never altered.
    """

    def __init__(self, log: DataFrame, refs: DataFrame, shards: DataFrame, min_chars: int, min_docs: int, n_shards: int):
        self.log, self.refs, self.shards = log, refs, shards
        self.min_chars, self.min_docs, self.n_shards = min_chars, min_docs, n_shards

    @classmethod
    def empty(cls, spark: SparkSession, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, n_shards: int = SHARDS) -> LineIndex:
        log = spark.createDataFrame([], "key binary, doc_id bigint, sign int")
        refs = spark.createDataFrame([], "key binary, shard int, n_docs bigint, keep_id bigint")
        shards = spark.createDataFrame([], "shard int, filter binary, keys binary, keep_ids binary")
        return cls(log, refs, shards, min_chars, min_docs, n_shards)

    def insert(self, docs: DataFrame) -> LineIndex:
        return self._changed(postings(docs, self.min_chars).distinct().withColumn("sign", F.lit(1)))

    def delete(self, docs: DataFrame) -> LineIndex:
        """Take documents out again; they are given as they were inserted."""
        return self._changed(postings(docs, self.min_chars).distinct().withColumn("sign", F.lit(-1)))

    def _changed(self, rows: DataFrame) -> LineIndex:
        """Append signed postings, count the keys they touch again, and pass the changes on to the filters."""
        spark = rows.sparkSession
        change = stored(rows, "lines-change")
        first = self.log.isEmpty()
        log = change if first else self.log.unionByName(change)
        touched = log if first else log.join(stored(change.select("key").distinct(), "lines-keys"), "key", "left_semi")
        held = touched if first else touched.groupBy("key", "doc_id").agg(F.sum("sign").alias("sign")).where("sign > 0")
        shard = F.conv(F.hex(F.substring("key", 15, 2)), 16, 10).cast("int") % self.n_shards  # bytes that the filter does not use
        counts = held.groupBy("key").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keep_id"))
        now = counts.where((F.col("n_docs") >= self.min_docs) & F.col("keep_id").isNotNull())
        now = now.select("key", shard.alias("shard"), "n_docs", "keep_id")
        if not first:
            now = now.unionByName(self.refs.join(stored(change.select("key").distinct(), "lines-keys"), "key", "left_anti"))
        refs = stored(now, "lines-refs")
        before = self.refs.select("key", "shard", F.lit(-1).alias("was"))
        moved = refs.join(before, ["key", "shard"], "full").select("key", "shard", "keep_id", F.col("was").isNotNull().alias("was"))
        old = self.shards
        rebuilt = moved.groupBy("shard").cogroup(old.groupBy("shard")).applyInPandas(_update, "shard int, filter binary, keys binary, keep_ids binary")
        return LineIndex(log, refs, stored(rebuilt, "lines-shards"), self.min_chars, self.min_docs, self.n_shards)

    def droppable(self, docs: DataFrame) -> DataFrame:
        """(doc_id, key) of the lines that documents lose: common ones that a larger id keeps.

        The shards are joined by a shuffle however small they are: with a broadcast the maps before and
        after the join would run in one task, each in a worker of its own, and executors keep those workers.
        """
        columns = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
        blocks = columns.mapInArrow(tidied(_blocks(self.min_chars, self.n_shards)), "shard int, keys binary, ids binary, nulls binary")
        asked = blocks.join(self.shards.withColumnRenamed("keys", "common").hint("merge"), "shard")
        return asked.mapInArrow(tidied(_ask), "doc_id bigint, key binary")

    def apply(self, docs: DataFrame, counts: tuple[str, str] = ("n_lines", "n_dropped")) -> DataFrame:
        """The documents without the lines they lose; ``counts`` names the columns for lines before, and lines lost."""
        found = self.droppable(docs).distinct().groupBy(F.col("doc_id").alias("_id")).agg(F.collect_list("key").alias("_lost"))
        names, min_chars = [n for n in docs.columns if n not in counts], self.min_chars
        schema = docs.select(*names).schema.add(counts[0], "long").add(counts[1], "long")
        rows = docs.select(F.struct(*names).alias("row"), F.col("doc_id").cast("bigint").alias("_key"))
        joined = rows.join(found, F.col("_key").eqNullSafe(F.col("_id")), "left").select("row.*", F.col("_lost").alias("__lost"))

        def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches(rows):
                texts, n_lines, n_dropped = [], [], []
                for text, lost in zip(batch.column("text").to_pylist(), batch.column("__lost").to_pylist(), strict=True):
                    lines = (text or "").split("\n")
                    kept = lines
                    if lost:
                        gone = set(lost)
                        kept = [x for x, k in zip(lines, _long_keys(text, min_chars), strict=True) if k not in gone]
                        text = "\n".join(kept)
                    texts.append(text)
                    n_lines.append(len(lines))
                    n_dropped.append(len(lines) - len(kept))
                arrays = [pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in names]
                yield pa.record_batch([*arrays, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], names=[*names, *counts])

        return joined.mapInArrow(tidied(run), schema)


def _update(changes: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
    """One shard's filter and exact table after its keys changed: new keys are inserted, former ones deleted."""
    shard = int((changes if len(changes) else old)["shard"].iloc[0])
    stays = changes[changes["keep_id"].notna()].sort_values("key")
    hashes = _common(stays) if len(stays) else np.zeros(0, np.uint64)
    if len(old):
        flat = np.frombuffer(old["filter"].iloc[0], dtype=np.uint16).reshape(-1, SLOTS)
        kept = CuckooFilter(flat.copy())
        gone = changes[changes["was"] & changes["keep_id"].isna()]
        new = stays[~stays["was"]]
        deleted = all(kept.delete(h) for h in (_common(gone) if len(gone) else []))
        inserted = deleted and all(kept.insert(h) for h in (_common(new) if len(new) else []))
        if not inserted:
            kept = CuckooFilter.of(hashes)
    else:
        kept = CuckooFilter.of(hashes)
    ids = stays["keep_id"].to_numpy(dtype=np.int64)
    row = {"shard": shard, "filter": kept.table.tobytes(), "keys": b"".join(stays["key"]), "keep_ids": ids.tobytes()}
    return pd.DataFrame([row])


def _blocks(min_chars: int, n_shards: int):
    """Long keys of texts and their ids by shard, a row per shard and about BLOCK_KEYS keys."""

    def block(keys: list[bytes], ids: list[int | None]) -> pa.RecordBatch:
        found, owners = np.frombuffer(b"".join(keys), dtype="V16"), pa.array(ids, pa.int64())
        shard = found.view(np.uint8).reshape(-1, 16)[:, 14:].copy().view(">u2").ravel() % n_shards
        nulls = owners.is_null().to_numpy(zero_copy_only=False)
        order = np.argsort(shard, kind="stable")
        parts = np.split(order, np.flatnonzero(np.diff(shard[order])) + 1)
        return pa.record_batch(
            [
                pa.array([int(shard[p[0]]) for p in parts], pa.int32()),
                *(pa.array([x[p].tobytes() for p in parts], pa.binary()) for x in (found, owners.fill_null(0).to_numpy(), nulls)),
            ],
            names=["shard", "keys", "ids", "nulls"],
        )

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ids = [], []
        for batch in batches(rows):
            new = _posted(batch, min_chars)
            keys += new[0]
            ids += new[1]
            if len(keys) >= BLOCK_KEYS:
                yield block(keys, ids)
                keys, ids = [], []
        if keys:
            yield block(keys, ids)

    return run


def _ask(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The (id, key) that a shard's filter lets through and its exact table confirms, with a larger id to keep the line."""
    last, kept, exact = None, None, {}
    for batch in rows:
        out_ids, out_keys = [], []
        for row in batch.to_pylist():
            if row["shard"] != last:
                last = row["shard"]
                kept = CuckooFilter(np.frombuffer(row["filter"], dtype=np.uint16).reshape(-1, SLOTS))
                common = row["common"]
                keep = np.frombuffer(row["keep_ids"], dtype=np.int64).tolist()
                exact = {common[16 * i : 16 * i + 16]: k for i, k in enumerate(keep)}
            halves = np.frombuffer(row["keys"], dtype="<u8").reshape(-1, 2)[:, 0]
            ids, nulls = np.frombuffer(row["ids"], dtype=np.int64), np.frombuffer(row["nulls"], dtype=bool)
            for i in np.flatnonzero(kept.has(halves)).tolist():
                key = row["keys"][16 * i : 16 * i + 16]
                keeper = exact.get(key)
                if keeper is not None and (nulls[i] or ids[i] < keeper):
                    out_ids.append(None if nulls[i] else int(ids[i]))
                    out_keys.append(key)
        yield pa.record_batch([pa.array(out_ids, pa.int64()), pa.array(out_keys, pa.binary())], names=["doc_id", "key"])


def line_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and the hash of the text that stays."""
    docs = docs.select("doc_id", "text")
    kept = LineIndex.empty(docs.sparkSession).insert(docs).apply(docs)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
