"""Token ids as Arrow files of equal-length sequences, readable in place.

Documents are dealt by range of their id; each task cuts its documents' tokens,
one after the other, into sequences of ``length`` ids and writes them in the
Arrow file format: record batches of two fixed-size lists, the ids (in 16 bits
if the vocabulary allows) and a mask of bits (set for a token, not for the
filling of a shard's last sequence). A second file
lists the shard's documents with the place of their tokens. Neither has variable
offsets, so a reader maps the file and takes any sequence without copying.

Files get unused names and count only when the manifest, a stored table with one
row per shard, names them: a task that ran twice leaves a file nobody reads.

Defined cases: null text is empty text and has the end id only; null ids come
first; rows with the same id follow each other in the order of their texts; an
empty table has an empty manifest. Other columns are not read.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs, ipc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import batches, stored
from martloom.session import scratch_dir

LENGTH = 2048  # ids in a sequence
PER_BATCH = 64  # sequences in a record batch
END = 1
CACHE = 300_000  # distinct pieces of words remembered by a worker, about
_MARKS = ".,!?;:|$%&*#"  # never letters, numbers or part of a contraction
_LATIN = "^[A-Za-zªµºÀ-ÖØ-öø-ÿ]+$"  # letters that do not change with their neighbours when lower-cased
MANIFEST = "first_id bigint, shard string, n_docs bigint, n_tokens bigint"

def _gathered(pool: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ``pool`` with these begins and sizes, one after the other."""
    ends = np.cumsum(sizes)
    return pool[np.repeat(begins - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]


class WordEncoder:
    """Ids of texts for a tokenizer that drops white space and encodes each word by itself.

    Marks behind letters are a pre-token of their own, and case does not matter: a word is
    letters and marks, or one piece as it is. Distinct pieces go through the tokenizers library
    once and are remembered.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.size = self.tokenizer.get_vocab_size()
        suffix = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix")
        tokens = [self.tokenizer.id_to_token(i) or "" for i in range(self.size)]
        self.last = np.array([bool(suffix) and t.endswith(suffix) for t in tokens])  # ids that end a word
        self._forget()

    def _forget(self) -> None:
        self.known = {"": 0}  # number of a piece; by number the place of its ids in the pool, and how many
        self.begins, self.sizes, self.pool = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and the number of ids of each."""
        words = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = words.values.dictionary_encode()
        if len(self.known) > CACHE:
            self._forget()
        pieces = self._pieces(coded.dictionary)
        pool = _gathered(self.pool, self.begins[pieces].ravel(), self.sizes[pieces].ravel())
        sizes = self.sizes[pieces].sum(axis=1)
        begins = np.cumsum(sizes) - sizes
        codes = coded.indices.to_numpy()
        ends = np.concatenate([[0], np.cumsum(sizes[codes])])
        flat = _gathered(pool, begins[codes], sizes[codes])
        return flat, np.diff(ends[words.offsets.to_numpy() - words.offsets[0].as_py()])

    def _pieces(self, words: pa.Array) -> np.ndarray:
        """Numbers of the two pieces of each word: its letters and the marks behind them, or the word and nothing."""
        base = pc.utf8_rtrim(words, characters=_MARKS)
        latin = pc.match_substring_regex(base, _LATIN)
        letters = latin.to_numpy(zero_copy_only=False).copy()
        other = np.flatnonzero(~letters)
        letters[other] = [x.isalpha() for x in base.take(pa.array(other)).to_pylist()]
        first = pc.if_else(pa.array(letters), pc.if_else(latin, pc.utf8_lower(base), base), words).dictionary_encode()
        n_marks = np.where(letters, pc.subtract(pc.binary_length(words), pc.binary_length(base)).to_numpy(), 0)
        marked = np.flatnonzero(n_marks)
        marks = [w[-n:] for w, n in zip(words.take(pa.array(marked)).to_pylist(), n_marks[marked].tolist(), strict=True)]
        distinct = first.dictionary.to_pylist()
        if new := set(distinct).union(marks) - self.known.keys():
            self._learn(new)
        number = lambda x: np.fromiter(map(self.known.__getitem__, x), dtype=np.int64, count=len(x))
        out = np.zeros((len(words), 2), dtype=np.int64)
        out[:, 0] = number(distinct)[first.indices.to_numpy()]
        out[marked, 1] = number(marks)
        return out

    def _learn(self, pieces: set[str]) -> None:
        """Encode new pieces; those of letters only are one pre-token each and go in together."""
        letters, rest = [], []
        for piece in pieces:
            (letters if piece.isalpha() else rest).append(piece)
        groups = [letters[at : at + 256] for at in range(0, len(letters), 256)]
        found = self.tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)
        names, ids, sizes = [], [], []
        for group, e in zip(groups, found, strict=True):
            part = np.array(e.ids, dtype=np.uint32)
            ends = np.flatnonzero(self.last[part]) + 1
            if len(ends) == len(group):
                names += group
                ids.append(part)
                sizes.append(np.diff(ends, prepend=0))
            else:  # no mark at word ends, or a letter that the tokenizer's tables do not count as one
                rest += group
        names += rest
        for e in self.tokenizer.encode_batch_fast(rest, add_special_tokens=False):
            ids.append(np.array(e.ids, dtype=np.uint32))
            sizes.append(np.array([len(e.ids)]))
        sizes = np.concatenate(sizes)
        self.known.update(zip(names, range(len(self.sizes), len(self.sizes) + len(names)), strict=True))
        self.begins = np.concatenate([self.begins, len(self.pool) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.pool = np.concatenate([self.pool, *ids])


_loaded: dict[str, WordEncoder] = {}


def word_encoder(path: str) -> WordEncoder:
    if path not in _loaded:
        _loaded[path] = WordEncoder(path)
    return _loaded[path]


def _lists(values: np.ndarray, length: int) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(values), length)


def sequence_schema(length: int, narrow: bool) -> pa.Schema:
    return pa.schema({"ids": pa.list_(pa.uint16() if narrow else pa.uint32(), length), "mask": pa.list_(pa.bool_(), length)})


DOCUMENTS = pa.schema({"doc_id": pa.int64(), "start": pa.int64(), "n_tokens": pa.int64()})


class ShardWriter:
    """Writes one shard: its sequences as they fill up, and its list of documents."""

    def __init__(self, base: str, length: int, narrow: bool):
        store, folder = fs.FileSystem.from_uri(base)
        store.create_dir(folder)
        self.shard, self.length = f"{folder}/{uuid.uuid4().hex}", length
        self.files = [store.open_output_stream(f"{self.shard}.{kind}.arrow") for kind in ("sequences", "documents")]
        self.schema = sequence_schema(length, narrow)
        self.sequences = ipc.new_file(self.files[0], self.schema)
        self.documents = ipc.new_file(self.files[1], DOCUMENTS)
        self.rest, self.n_tokens, self.n_docs, self.first_id = np.zeros(0, np.uint32), 0, 0, None

    def add(self, doc_ids: pa.Array, ids: np.ndarray, lengths: np.ndarray) -> None:
        """Documents with the ids of all of them, one after the other, and the number of ids of each."""
        starts = self.n_tokens + np.cumsum(lengths) - lengths
        if not self.n_docs:
            self.first_id = doc_ids[0].as_py()
        self.documents.write_batch(pa.record_batch([doc_ids, pa.array(starts), pa.array(lengths)], schema=DOCUMENTS))
        self.n_docs += len(doc_ids)
        self.n_tokens += int(lengths.sum())
        data = np.concatenate([self.rest, ids])
        block = self.length * PER_BATCH
        whole = len(data) - len(data) % block
        for at in range(0, whole, block):
            self._write(data[at : at + block], block)
        self.rest = data[whole:].copy()

    def _write(self, data: np.ndarray, n_real: int) -> None:
        data = data.astype(self.schema.field("ids").type.value_type.to_pandas_dtype())
        mask = np.arange(len(data)) < n_real
        self.sequences.write_batch(pa.record_batch([_lists(data, self.length), _lists(mask, self.length)], schema=self.schema))

    def close(self) -> None:
        data = self.rest
        if len(data):
            full = np.zeros(-(-len(data) // self.length) * self.length, dtype=np.uint32)
            full[: len(data)] = data
            self._write(full, len(data))
        for x in (self.sequences, self.documents, *self.files):
            x.close()


class ShardReader:
    """Random access to the sequences and documents of a shard.

    A local file is mapped, and sequences are views of it; another store is read
    by record batch.
    """

    def __init__(self, base: str, shard: str):
        store, _ = fs.FileSystem.from_uri(base)
        local = isinstance(store, fs.LocalFileSystem)
        open_file = pa.memory_map if local else store.open_input_file
        self.sequences, self.documents = (ipc.open_file(open_file(f"{shard}.{kind}.arrow")) for kind in ("sequences", "documents"))
        self.length = self.sequences.schema.field("ids").type.list_size
        self._at, self._batch = -1, None

    def batch(self, i: int) -> pa.RecordBatch:
        if self._at != i:
            self._at, self._batch = i, self.sequences.get_batch(i)
        return self._batch

    def sequence(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Ids and mask of sequence ``i``, views of the file."""
        batch, n = self.batch(i // PER_BATCH), i % PER_BATCH
        ids, mask = (batch.column(c).values.slice(n * self.length, self.length) for c in ("ids", "mask"))
        return ids.to_numpy(zero_copy_only=True), mask

    def tokens(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from ``start`` on."""
        block = self.length * PER_BATCH
        parts = []
        while n > 0:
            at = start % block
            values = self.batch(start // block).column("ids").values.to_numpy(zero_copy_only=True)[at : at + n]
            parts.append(values)
            start, n = start + len(values), n - len(values)
        return np.concatenate(parts) if len(parts) > 1 else parts[0] if parts else np.zeros(0, np.uint16)


def write(docs: DataFrame, path: str, base: str | None = None, length: int = LENGTH, end: int = END) -> DataFrame:
    """Encode whole texts with the tokenizer file ``path`` and write them below ``base``; the manifest, one row per shard.

    ``base`` is a folder all executors share (by default one below ``spark.checkpoint.dir``).
    """
    base = base or scratch_dir(docs.sparkSession, "arrow-tokens")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        for batch in batches(rows, 1500):
            if batch.num_rows:
                encoder = word_encoder(path)
                writer = writer or ShardWriter(base, length, encoder.size <= 1 << 16)
                ids, lengths = encoder(batch.column("text"))
                ids = np.insert(ids, np.cumsum(lengths), end)
                writer.add(batch.column("doc_id"), ids, lengths + 1)
        if writer:
            writer.close()
            yield pa.record_batch(
                [pa.array([writer.first_id], pa.int64()), pa.array([writer.shard]), pa.array([writer.n_docs], pa.int64()), pa.array([writer.n_tokens], pa.int64())],
                names=["first_id", "shard", "n_docs", "n_tokens"],
            )

    ranged = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").repartitionByRange("doc_id")
    manifest = ranged.sortWithinPartitions("doc_id", "text").mapInArrow(run, MANIFEST)
    return stored(manifest.withColumn("base", F.lit(base)), "arrow-manifest")


def read_documents(manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files.

    ``start`` counts the ids of all documents before it, in ascending doc_id order.
    """
    before = Window.orderBy(F.col("first_id").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("before", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))  # one row per shard

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for row in batch.to_pylist():
                reader = ShardReader(row["base"], row["shard"])
                for i in range(reader.documents.num_record_batches):
                    part = reader.documents.get_batch(i)
                    starts, counts = (part.column(c).to_numpy() for c in ("start", "n_tokens"))
                    sums = [zlib.crc32(np.ascontiguousarray(reader.tokens(int(s), int(n)), dtype="<u4")) for s, n in zip(starts, counts, strict=True)]
                    yield pa.record_batch(
                        [part.column("doc_id"), pa.array(starts + row["before"]), part.column("n_tokens"), pa.array(sums, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    width = manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")
    spread = placed.repartition(int(width), "shard")
    return spread.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
