"""Near duplicates of vectors: learned binary codes, multi-index Hamming tables, exact rerank.

A rotation of the principal directions is learned on a bounded sample so that
the signs of the rotated vectors lose as little as possible (iterative
quantisation); two starts give two rotations and a code of up to 128 bits. The
code is cut into chunks of ``CHUNK`` bits, a hash table each. Two vectors are
candidates if some chunk differs in one bit at most. How many bits a pair at the
wanted cosine differs in depends on the table: 0.1 of them where vectors have no
common part, many more where they share a direction, since codes are taken about
the centre. So pairs at exactly this cosine are made from the sample, and
rotations are added, then chunks halved, until ``RECALL`` of them meet. Each
candidate pair is looked at in the first of its tables only, must agree in as
many bits of the whole code as made pairs do, and is then ranked by the cosine of
the original vectors in double precision. With a large common part the made
chunks are short and the candidates near all pairs.

Identical vectors are one class from the start: they meet in no table, and their
number only enters the count of links.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, vectors of another length than most of the sample, and rows with a
null id link with nothing and are kept; rows with one id are vectors of their
own that share the component. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import components, mixed, stored

SAMPLE = 8_000  # vectors that the rotations are learned on, at most
CHUNK, BITS, ROTATIONS, ROUNDS = 16, 64, 2, 30
FAR = 0.28  # share of differing bits beyond which a candidate is no pair, at least; 0.1 is expected at the threshold without a common part
RECALL, MOST = 0.995, 24  # share of made pairs that meet in a table; rotations at most before chunks are halved


def matrix(column: pa.Array, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Vectors as rows of doubles, and which of them are usable; the others are rows of zeros.

    Without ``width`` it is the most frequent length.
    """
    lists = [None if v is None else np.array(v, dtype=np.float64) for v in column.to_pylist()]
    if width is None:
        lengths = [len(v) for v in lists if v is not None and len(v)]
        width = max(set(lengths), key=lambda n: (lengths.count(n), n)) if lengths else 1
    out, good = np.zeros((len(lists), width)), np.zeros(len(lists), dtype=bool)
    for i, v in enumerate(lists):
        if v is not None and len(v) == width and np.isfinite(v).all() and v.any():
            out[i], good[i] = v / np.abs(v).max(), True  # so that squares neither overflow nor vanish
    return out, good


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.sqrt((rows * rows).sum(axis=1, keepdims=True)), 1e-300)


class Codes:
    """Centre and rotated directions; ``projections`` has one matrix per rotation."""

    def __init__(self, centre: np.ndarray, projections: list[np.ndarray], chunk: int = CHUNK, far: float = FAR):
        self.centre, self.projections, self.far = centre, projections, far
        self.bits = projections[0].shape[1]
        self.chunk = min(chunk, self.bits)
        self.chunks = self.bits // self.chunk  # per rotation

    def codes(self, rows: np.ndarray) -> np.ndarray:
        """One unsigned 64-bit number per row and rotation."""
        powers = np.uint64(1) << np.arange(self.bits, dtype=np.uint64)
        return np.stack([((rows - self.centre) @ p > 0) @ powers for p in self.projections], axis=1).astype(np.uint64)


def made_pairs(rows: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors and partners at this cosine: each turned towards another vector of the sample, and in a random direction."""
    make = np.random.default_rng(1)
    rows = rows[:4_000]
    sides = []
    for other in (rows[make.permutation(len(rows))], make.standard_normal(rows.shape)):
        away = other - (other * rows).sum(axis=1, keepdims=True) * rows
        some = (away * away).sum(axis=1) > 1e-12
        sides.append((rows[some], cosine * rows[some] + np.sqrt(max(0.0, 1 - cosine * cosine)) * unit(away[some])))
    return np.concatenate([s[0] for s in sides]), np.concatenate([s[1] for s in sides])


def meeting(codes: Codes, one: np.ndarray, two: np.ndarray) -> tuple[float, float]:
    """Share of the pairs that meet in a table (the lower of the two kinds of made pairs), and differing bits of nearly all, as a share."""
    differ = codes.codes(one) ^ codes.codes(two)
    shifts = np.arange(codes.chunks, dtype=np.uint64) * np.uint64(codes.chunk)
    parts = (differ[:, :, None] >> shifts) & np.uint64((1 << codes.chunk) - 1)
    met = (np.bitwise_count(parts) <= 1).any(axis=(1, 2))
    apart = np.bitwise_count(differ).sum(axis=1) / (codes.bits * differ.shape[1])
    half = len(met) // 2
    return float(min(met[:half].mean(), met[half:].mean()) if half else met.mean()), float(np.quantile(apart, 0.9995))


def fitted(rows: np.ndarray, cosine: float) -> Codes:
    """Codes with as many rotations, as short chunks and as wide a limit as made pairs at ``cosine`` need."""
    codes = learn(rows)
    one, two = made_pairs(rows, cosine)
    if not len(one):
        return codes
    width, count = codes.chunk, len(codes.projections)
    turns = codes.projections
    while True:
        codes = Codes(codes.centre, turns[:count], width)
        share, far = meeting(codes, one, two)
        codes.far = max(FAR, min(1.0, far + 0.05))
        if share >= RECALL:
            return codes
        if count < MOST:
            count = min(MOST, count * 2)
        elif width > 1:
            width, count = width // 2, ROTATIONS
        else:
            return codes
        if count > len(turns):
            turns = learn(rows, count).projections


def learn(rows: np.ndarray, rotations: int = ROTATIONS, rounds: int = ROUNDS) -> Codes:
    """Principal directions, rotated so that signs of the rows are near the rows themselves."""
    centre = rows.mean(axis=0) if len(rows) else np.zeros(rows.shape[1])
    around = rows - centre
    width = rows.shape[1]
    bits = min(BITS, width) if width < CHUNK else min(BITS, width // CHUNK * CHUNK)
    _, directions = np.linalg.eigh(around.T @ around + 1e-9 * np.eye(width))
    directions = directions[:, ::-1][:, :bits]
    seen = around @ directions
    out = []
    for start in range(rotations):
        turn, _ = np.linalg.qr(np.random.default_rng(start).standard_normal((bits, bits)))
        for _ in range(rounds if len(rows) else 0):
            u, _, v = np.linalg.svd(np.where(seen @ turn > 0, 1.0, -1.0).T @ seen)
            turn = (u @ v).T
        out.append(directions @ turn)
    return Codes(centre, out)


def fit(vectors: DataFrame, sample: int = SAMPLE, cosine: float = 0.95) -> Codes:
    """Learn the codes for pairs from ``cosine`` on, on at most ``sample`` vectors, taken by the hash of their id."""
    rows = vectors.select("vec_id", "embedding").where("embedding is not null").orderBy(F.xxhash64("vec_id")).limit(sample)
    found, good = matrix(rows.select("embedding").toArrow().column(0).combine_chunks())
    return fitted(unit(found[good]) if good.any() else np.zeros((0, found.shape[1])), cosine)


def encoded(vectors: DataFrame, codes: Codes) -> DataFrame:
    """vec_id, class key and unit vector (null if unusable), and a code per rotation."""
    width, n = len(codes.centre), len(codes.projections)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            found, good = matrix(batch.column("embedding"), width)
            good &= batch.column("vec_id").is_valid().to_numpy(zero_copy_only=False)
            own, marks = unit(found), codes.codes(unit(found)).view(np.int64)
            keys = [hashlib.md5(x.tobytes()).digest() if g else None for x, g in zip(found, good, strict=True)]
            vecs = [x.tobytes() if g else None for x, g in zip(own, good, strict=True)]
            yield pa.record_batch(
                [batch.column("vec_id"), pa.array(keys, pa.binary()), pa.array(vecs, pa.binary()), *(pa.array(marks[:, i]) for i in range(n))],
                names=["vec_id", "key", "vec", *(f"code{i}" for i in range(n))],
            )

    columns = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    return columns.mapInArrow(run, "vec_id bigint, key binary, vec binary" + "".join(f", code{i} bigint" for i in range(n)))


def _tables(codes: Codes, probe: bool):
    """Rows (bucket, place, id, codes) of every vector: its chunks, or all chunks within one bit of them."""
    n, chunk = len(codes.projections), codes.chunk
    flips = np.concatenate([[0], 1 << np.arange(chunk)]).astype(np.uint64) if probe else np.zeros(1, np.uint64)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in rows:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                marks = np.stack([batch.column(f"code{i}").to_numpy().view(np.uint64) for i in range(n)], axis=1)
                parts, places = [], []
                for place in range(n * codes.chunks):
                    part = (marks[:, place // codes.chunks] >> np.uint64(place % codes.chunks * chunk)) & np.uint64((1 << chunk) - 1)
                    parts.append(part[:, None] ^ flips)
                    places.append(np.full((len(part), len(flips)), place))
                keys = np.concatenate(parts, axis=1).astype(np.uint64)
                place = np.concatenate(places, axis=1)
                each = keys.shape[1]
                bucket = mixed((place.astype(np.uint64) << np.uint64(chunk)) | keys).view(np.int64)
                yield pa.record_batch(
                    [
                        pa.array(bucket.ravel()), pa.array(place.ravel().astype(np.int32)), pa.array(np.repeat(batch.column("rep").to_numpy(), each)),
                        *(pa.array(np.repeat(marks[:, i].view(np.int64), each)) for i in range(n)),
                    ],
                    names=["bucket", "place", "rep", *(f"code{i}" for i in range(n))],
                )

    return run, "bucket bigint, place int, rep bigint" + "".join(f", code{i} bigint" for i in range(n))


def _pairs(reps: DataFrame, codes: Codes) -> DataFrame:
    """Candidate pairs (a, b), b smaller: near in a chunk, looked at in the first such chunk, near in the whole code."""
    n, mask = len(codes.projections), (1 << codes.chunk) - 1
    columns = ["rep", *(f"code{i}" for i in range(n))]
    side = lambda name, probe: reps.select(*columns).mapInArrow(*_tables(codes, probe)).toDF("bucket", "place", name, *(f"{name}{i}" for i in range(n)))
    differ = [F.col(f"a{i}").bitwiseXOR(F.col(f"b{i}")) for i in range(n)]
    chunk = lambda place: F.shiftrightunsigned(differ[place // codes.chunks], place % codes.chunks * codes.chunk).bitwiseAND(F.lit(mask))
    first: Column = F.lit(None).cast("int")
    for place in reversed(range(n * codes.chunks)):
        first = F.when(F.bit_count(chunk(place)) <= 1, F.lit(place)).otherwise(first)
    apart = sum((F.bit_count(x) for x in differ[1:]), F.bit_count(differ[0]))
    found = side("a", True).join(side("b", False), ["bucket", "place"])
    return found.where((F.col("b") < F.col("a")) & (apart <= int(codes.far * codes.bits * n)) & (first == F.col("place"))).select("a", "b")


def _near(cosine: float):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            one, two = (np.frombuffer(b"".join(batch.column(c).to_pylist())).reshape(batch.num_rows, -1) for c in ("vec_a", "vec_b"))
            near = (one * two).sum(axis=1) >= cosine if batch.num_rows else np.zeros(0, dtype=bool)
            yield pa.record_batch([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(near))

    return run


def near_vectors(vectors: DataFrame, cosine: float = 0.95, codes: Codes | None = None) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector."""
    codes = codes or fit(vectors, cosine=cosine)
    rows = stored(encoded(vectors, codes), "vectors-encoded")
    usable = rows.where("key is not null")
    classes = stored(usable.groupBy("key").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "vectors-classes")
    reps = usable.join(classes, "key").where("vec_id = rep").drop("vec_id").dropDuplicates(["rep", "key"])
    reps = stored(reps, "vectors-reps")
    pairs = stored(_pairs(reps, codes).distinct(), "vectors-pairs")
    side = lambda x: reps.select(F.col("rep").alias(x), F.col("vec").alias(f"vec_{x}"))
    ranked = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "vec_a", "vec_b")
    links = stored(ranked.mapInArrow(_near(cosine), "a bigint, b bigint"), "vectors-links")

    both = links.select(F.col("a").alias("rep"), F.col("b").alias("other")).unionByName(links.select(F.col("b").alias("rep"), F.col("a").alias("other")))
    weights = reps.groupBy("rep").agg(F.sum("copies").alias("copies"))
    counts = both.join(weights.withColumnRenamed("rep", "other"), "other").groupBy("rep").agg(F.sum("copies").alias("around"))
    joined = classes.join(counts, "rep", "left").join(components(links, "vectors-components"), F.col("rep") == F.col("node"), "left")
    joined = joined.select("key", (F.col("copies") - 1 + F.coalesce("around", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    out = rows.select("vec_id", "key").join(stored(joined, "vectors-joined"), "key", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
