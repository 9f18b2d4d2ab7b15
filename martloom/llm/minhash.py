"""Near duplicates with SetSketch registers.

Each document's set of word shingles is sketched in ``REGISTERS`` registers. A
register is the floor of a logarithm (base ``BASE``) of the least of exponential
values, one per shingle, cut to 16 bits: sketches of parts merge by maximum, and
two registers are equal about as often as the sets are similar. Registers are
banded, and documents that agree in a band are candidates.

A pair is first estimated jointly: how often one register is larger, smaller or
equal, with the known set sizes, gives a likelihood of the similarity. Pairs
whose most likely value is far below the threshold go; the rest is verified on
the full sets (as 64-bit hashes of all shingles).

Not all pairs of a bucket become rows. Documents with the same words are one
class from the start. Every bucket then chooses a hub, the document that shares
its buckets with the most others; documents are compared with the hubs of their
buckets, and verified links are joined to components. As two documents of a
bucket have its hub in common, all that is left are pairs of different
components around one hub: each document outside the largest component is
compared with all the others, block by block, on full sets in one matrix
product; a block only returns links that join components.

Defined cases: null text is empty text; a text without words has size 0 and is
linked with nothing; fewer words than a shingle has form one shingle; rows with
a null id are linked with nothing and kept; rows with the same id share their
links. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import batches, components, gram_hashes, mixed, numbers, slices, stored, tidied, word_hashes

REGISTERS, BAND = 128, 4  # a pair at the threshold 0.8 shares none of the 32 bands once in 10^7
BASE, RATE, TOP = 1.001, 20.0, 65_535
SLACK = 0.24  # how far below the threshold an estimate may be, seven standard errors
BLOCK = 128  # documents of a block, on average
_FACTORS, _MASKS = numbers(REGISTERS, 11) | np.uint64(1), numbers(REGISTERS, 12)


def shingle_sets(texts: list[str | None], k: int) -> Iterator[tuple[np.ndarray, bytes]]:
    """The sorted distinct shingle hashes of each text, and a 128-bit fingerprint of its words in order."""
    for _, _, raws in slices(texts, lower=True):
        words, bounds = word_hashes(raws)
        grams = gram_hashes(words, k)
        for first, last in zip(bounds[:-1], bounds[1:], strict=True):
            own = words[first:last]
            found = grams[first : last - k + 1] if len(own) >= k else gram_hashes(own, len(own)) if len(own) else own
            places = np.arange(1, len(own) + 1, dtype=np.uint64) * _FACTORS[0]
            marks = [np.add.reduce(mixed(own ^ (places * f))) for f in _FACTORS[1:3]] if len(own) else [np.uint64(0)] * 2
            yield np.unique(found), np.array([*marks], dtype=np.uint64).tobytes()


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """One row of registers per set; an empty set has zeros."""
    out = np.zeros((len(sets), REGISTERS), dtype=np.uint16)
    full = [i for i, s in enumerate(sets) if len(s)]
    for part in (full[at : at + 256] for at in range(0, len(full), 256)):
        joined = np.concatenate([sets[i] for i in part])
        starts = np.cumsum([0, *(len(sets[i]) for i in part[:-1])])
        least = np.empty((len(part), REGISTERS), dtype=np.uint64)
        for r in range(REGISTERS):
            least[:, r] = np.minimum.reduceat((joined ^ _MASKS[r]) * _FACTORS[r], starts)
        waits = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / RATE
        out[part] = np.clip(np.floor(1 - np.log(np.maximum(waits, 1e-300)) / np.log(BASE)), 0, TOP)
    return out


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def likeliest(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Most likely similarity of each pair of register rows, given the set sizes."""
    larger, smaller = (a > b).sum(axis=1), (a < b).sum(axis=1)
    equal = a.shape[1] - larger - smaller
    u = size_a / np.maximum(size_a + size_b, 1)
    v = 1 - u
    lift = lambda x: -np.log1p(-np.clip(x, 1e-12, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def likelihood(j: np.ndarray) -> np.ndarray:
        up, down = lift(u - v * j), lift(v - u * j)
        return larger * np.log(up) + smaller * np.log(down) + equal * np.log(np.maximum(1 - up - down, 1e-12))

    low, high = np.zeros(len(u)), np.minimum(u / np.maximum(v, 1e-12), v / np.maximum(u, 1e-12))
    for _ in range(24):  # the likelihood has one peak
        one, two = low + (high - low) * 0.382, low + (high - low) * 0.618
        right = likelihood(two) > likelihood(one)
        low, high = np.where(right, one, low), np.where(right, high, two)
    return (low + high) / 2


def sketches(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, size, words (a fingerprint of the word sequence) and regs of every document."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, 512):
            found = list(shingle_sets(batch.column("text").to_pylist(), k))
            regs = registers([s for s, _ in found])
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array([len(s) for s, _ in found], pa.int64()),
                    pa.array([w for _, w in found], pa.binary()),
                    pa.array([r.tobytes() for r in regs], pa.binary()),
                ],
                names=["doc_id", "size", "words", "regs"],
            )

    columns = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return columns.mapInArrow(tidied(run), "doc_id bigint, size bigint, words binary, regs binary")


def _bands(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = REGISTERS // BAND
    salt = numbers(n, 13)
    for batch in rows:
        regs = np.frombuffer(b"".join(batch.column("regs").to_pylist()), dtype=np.uint16).reshape(-1, n, BAND)
        keys = np.zeros(regs.shape[:2], dtype=np.uint64)
        for i in range(BAND):
            keys = (keys << np.uint64(16)) | regs[:, :, i]
        keys = mixed(mixed(keys) ^ salt).astype(np.int64)
        ids = np.repeat(batch.column("doc_id").to_numpy(), n)
        yield pa.record_batch([pa.array(keys.ravel()), pa.array(ids)], names=["bucket", "doc_id"])


def _likely(threshold: float):
    """Keeps the pairs whose sizes allow the threshold and whose estimate is not far below it."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, 8192):
            size_a, size_b = (batch.column(c).to_numpy().astype(np.float64) for c in ("size_a", "size_b"))
            near = np.minimum(size_a, size_b) >= threshold * np.maximum(size_a, size_b) - 1e-9
            a, b = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS) for c in ("regs_a", "regs_b")
            )
            near &= likeliest(a, b, size_a, size_b) >= threshold - SLACK
            yield pa.record_batch([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(near))

    return run


def _verified(k: int, percent: int):
    """Keeps the pairs (a, text_a, b, text_b) whose sets are similar enough; texts hashed once per batch."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, 256):
            names = [*zip(batch.column("a").to_pylist(), batch.column("text_a").to_pylist(), strict=True)]
            names += zip(batch.column("b").to_pylist(), batch.column("text_b").to_pylist(), strict=True)
            distinct = list(dict.fromkeys(names))
            sets = dict(zip(distinct, (s for s, _ in shingle_sets([t for _, t in distinct], k)), strict=True))
            keep = []
            for one, two in zip(names[: batch.num_rows], names[batch.num_rows :], strict=True):
                common = len(np.intersect1d(sets[one], sets[two], assume_unique=True))
                keep.append(100 * common >= percent * (len(sets[one]) + len(sets[two]) - common) > 0)
            yield pa.record_batch([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _incidence(sets: list[np.ndarray], shared: np.ndarray) -> np.ndarray:
    """Which of the shared hashes each set holds, as zeros and ones."""
    out = np.zeros((len(sets), len(shared)), dtype=np.float32)
    for row, own in zip(out, sets, strict=True):
        at = np.searchsorted(shared, own)
        at[at == len(shared)] = 0
        row[at[shared[at] == own]] = 1
    return out


def joining(labels_a: np.ndarray, labels_b: np.ndarray, linked: np.ndarray) -> list[tuple[int, int]]:
    """Positions of linked pairs that join components, no more than needed."""
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while root.get(x, x) != x:
            x = root[x]
        return x

    out = []
    for i, j in zip(*(x.tolist() for x in np.nonzero(linked)), strict=True):
        one, two = top(int(labels_a[i])), top(int(labels_b[j]))
        if one != two:
            root[max(one, two)] = min(one, two)
            out.append((i, j))
    return out


def _blocks_joined(k: int, percent: int):
    """Links between the documents of two blocks, from the sizes of all intersections at once."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in rows:
            for batch in batches(iter([whole]), 1):
                left, right = batch.column("minors").to_pylist()[0], batch.column("rows").to_pylist()[0]
                sets = [s for s, _ in shingle_sets([r["text"] for r in (*left, *right)], k)]
                own, other = sets[: len(left)], sets[len(left) :]
                labels = [np.array([r["label"] for r in side]) for side in (left, right)]
                sizes = [np.array([len(s) for s in side], dtype=np.float64) for side in (own, other)]
                shared = np.intersect1d(np.unique(np.concatenate(own)), np.unique(np.concatenate(other)))
                common = np.zeros((len(own), len(other)))
                for at in range(0, len(shared), 4096):
                    part = shared[at : at + 4096]
                    common += _incidence(own, part) @ _incidence(other, part).T
                near = 100 * common >= percent * (sizes[0][:, None] + sizes[1][None] - common)
                near &= (labels[0][:, None] != labels[1][None]) & (common > 0)
                links = [(left[i]["doc_id"], right[j]["doc_id"]) for i, j in joining(*labels, near)]
                yield pa.record_batch([pa.array([x[n] for x in links], pa.int64()) for n in (0, 1)], names=["a", "b"])

    return run


class _Linker:
    """Filters and verifies candidate pairs of one run."""

    def __init__(self, docs: DataFrame, reps: DataFrame, k: int, percent: int):
        self.docs, self.reps, self.k, self.percent = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), reps, k, percent

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose full sets are similar enough."""
        side = lambda x: self.reps.select(F.col("doc_id").alias(x), F.col("size").alias(f"size_{x}"), F.col("regs").alias(f"regs_{x}"))
        near = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "size_a", "size_b", "regs_a", "regs_b")
        near = stored(near.mapInArrow(tidied(_likely(self.percent / 100)), "a bigint, b bigint"), "minhash-near")
        text = lambda x: self.docs.select(F.col("doc_id").alias(x), F.col("text").alias(f"text_{x}"))
        full = near.join(text("b"), "b").join(text("a"), "a").select("a", "b", "text_a", "text_b")
        return stored(full.mapInArrow(tidied(_verified(self.k, self.percent)), "a bigint, b bigint").distinct(), "minhash-links")

    def links_apart(self, stars: DataFrame, labels: DataFrame) -> DataFrame:
        """Links (a, b) that join components around a hub: blocks of the documents outside the largest one, against all blocks."""
        labels = stored(labels, "minhash-labels")
        known = stars.join(labels, F.col("doc_id") == F.col("node"), "left")
        known = stored(known.select("hub", "doc_id", F.coalesce("component", "doc_id").alias("label")), "minhash-known").where("doc_id <> hub")
        sizes = known.groupBy("hub", "label").agg(F.count("*").alias("n"))
        split = sizes.groupBy("hub").agg(F.max(F.struct("n", "label"))["label"].alias("major"), F.count("*").alias("labels"), F.sum("n").alias("docs"))
        split = stored(split.where("labels > 1").select("hub", "major", F.ceil(F.col("docs") / BLOCK).alias("blocks")), "minhash-split")
        block = F.pmod(F.xxhash64("doc_id"), "blocks").alias("block")
        rows = stored(known.join(split, "hub").select("hub", "doc_id", "label", block, (F.col("label") != F.col("major")).alias("minor")), "minhash-mixed")
        rows = rows.join(self.docs, "doc_id").withColumn("row", F.struct("doc_id", "label", "minor", "text"))
        all_ = stored(rows.groupBy("hub", "block").agg(F.collect_list("row").alias("rows")), "minhash-blocks")
        minor = all_.withColumn("minors", F.filter("rows", lambda r: r["minor"])).where(F.size("minors") > 0)
        minor = minor.select("hub", F.col("block").alias("other"), "minors")
        # two blocks with documents outside the largest component on both sides meet twice; that is harmless
        pairs = all_.join(minor, "hub")
        pairs = pairs.select("hub", "block", "other", "minors", "rows")
        return stored(pairs.mapInArrow(tidied(_blocks_joined(self.k, self.percent)), "a bigint, b bigint").distinct(), "minhash-joined")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document.

    Documents are linked when 100 * intersection >= percent * union of their
    shingle sets; a component is named after its smallest doc_id, which is kept.
    """
    sketched = stored(sketches(docs, shingle), "minhash-sketches")
    usable = sketched.where("size > 0 and doc_id is not null")
    classes = usable.groupBy("words").agg(F.min("doc_id").alias("b"), F.count("*").alias("n")).where("n > 1").select("words", "b")
    same = usable.select("words", F.col("doc_id").alias("a")).join(stored(classes, "minhash-classes"), "words")
    same = stored(same.where("a <> b").distinct(), "minhash-same")

    copy = (usable["doc_id"] == same["a"]) & (usable["words"] == same["words"])
    reps = usable.join(same, copy, "left_anti").select("doc_id", "size", "regs")
    reps = stored(reps.dropDuplicates(["doc_id", "size", "regs"]), "minhash-reps")
    linker = _Linker(docs, reps, shingle, percent)

    bands = reps.select("doc_id", "regs").mapInArrow(tidied(_bands), "bucket bigint, doc_id bigint")
    stars = stored(_stars(bands), "minhash-stars")
    found = linker.links(stars.where("doc_id <> hub").select(F.col("doc_id").alias("a"), F.col("hub").alias("b")))

    rest = linker.links_apart(stars, components(found, "minhash-first"))
    edges = found.unionByName(same.select("a", "b")).unionByName(rest)
    joined = stored(components(edges, "minhash-all"), "minhash-components")
    out = sketched.select("doc_id", F.col("size").alias("n_shingles")).join(joined, F.col("doc_id") == F.col("node"), "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def _stars(bands: DataFrame) -> DataFrame:
    """(doc_id, hub): every document of a bucket with another one, and the hub of its bucket."""
    shared = bands.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = stored(bands.join(stored(shared, "minhash-shared"), "bucket"), "minhash-members")
    crowd = stored(members.groupBy("doc_id").agg(F.sum("n").alias("crowd")), "minhash-crowd")
    most = members.join(crowd, "doc_id").groupBy("bucket").agg((-F.max(F.struct("crowd", (-F.col("doc_id")).alias("id")))["id"]).alias("hub"))
    return members.join(stored(most, "minhash-hubs"), "bucket").select("doc_id", "hub").distinct()
