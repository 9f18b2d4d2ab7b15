"""Centroid clustering of vectors with centroids filtered in rotated coordinates.

Vectors and centroids have whole components. On a bounded sample a rotation to the
principal directions is learned. Of each vector the leading rotated coordinates are
stored, and the norm of the rest. The squared distance of the leading coordinates
plus the squared difference of the rest norms can not be more than the squared
distance, so a centroid whose bound is above the distance of another one is out.
Only the centroids left are compared with the whole vector, in integers: bounds
save work and never decide.

A round is one pass over the stored vectors. A task adds up its vectors per cluster
and component, Spark adds up the tasks, and what reaches the driver is the next
centroids: as many numbers as clusters times components. The cluster of a vector
depends on the centroids only, so a task that runs again gives the same rows.

Defined cases: vectors that are null, of another length than ``width`` or hold null
or non-finite components take no part and have no row in the result, nor do those
with a component of ``FAR`` or more, whose distances could not be told in 64 bits;
rows with one id are vectors of their own; rows with a null id are clustered like
others but start no centroid; with fewer vectors than centroids there are as many
centroids as vectors; equally near centroids lose to the one with the smaller
number; a centroid without vectors stays; an empty table has an empty result. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import discard, stored

WIDTH, SCALE, CENTROIDS, ROUNDS = 64, 64, 16, 3
LEADING = 16  # rotated coordinates that are stored
SAMPLE = 4_096  # vectors that the rotation is learned on, at most about
FAR = 1 << 20  # components are below this, before scaling
SLICE = 4_096  # vectors worked on at a time


def whole_vectors(column: pa.Array, width: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """floor(scale * x) of the usable vectors as 64-bit integers, and which rows these are."""
    good = pc.fill_null(pc.equal(pc.list_value_length(column), width), False).to_numpy(zero_copy_only=False)
    flat = pc.list_flatten(column.filter(pa.array(good)))
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, width)
    fine = (np.abs(np.nan_to_num(values, nan=np.inf)) < FAR).all(axis=1) if len(values) else np.zeros(0, dtype=bool)
    good[good] = fine
    return np.floor(scale * values[fine]).astype(np.int64), good


class Rotation:
    """Principal directions of a sample: the leading coordinates of a vector and the norm of the rest."""

    def __init__(self, sample: np.ndarray, width: int, leading: int = LEADING):
        rows = sample.astype(float)
        around = rows - rows.mean(axis=0) if len(rows) else rows
        _, directions = np.linalg.eigh(around.T @ around + 1e-9 * np.eye(width))
        self.directions = np.ascontiguousarray(directions[:, ::-1][:, :leading])

    def __call__(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = vectors.astype(float)
        lead = rows @ self.directions
        rest = np.maximum((rows * rows).sum(axis=1) - (lead * lead).sum(axis=1), 0.0)
        return lead, np.sqrt(rest)


class Filter:
    """The centroids with their leading coordinates, ready to be compared with blocks of vectors."""

    def __init__(self, centroids: np.ndarray, rotation: Rotation):
        self.centroids = centroids
        self.lead, self.rest = rotation(centroids)
        self.size = (centroids.astype(float) ** 2).sum(axis=1)
        self.verified = 0  # distances taken in integers so far

    def nearest(self, vectors: np.ndarray, lead: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroid of each vector, the smaller number of equally near ones, and the squared distance."""
        bound = (lead * lead).sum(axis=1)[:, None] + (self.lead * self.lead).sum(axis=1) - 2 * lead @ self.lead.T
        bound += (rest[:, None] - self.rest) ** 2
        # what rounding may have added to a bound, many times over
        bound -= 1e-9 * ((lead * lead).sum(axis=1) + rest * rest)[:, None] + 1e-9 * self.size + 1e-6
        best = bound.argmin(axis=1)
        distance = ((vectors - self.centroids[best]) ** 2).sum(axis=1)
        left = bound <= distance[:, None]
        left[np.arange(len(best)), best] = False
        self.verified += len(vectors) + int(left.sum())
        for number in np.flatnonzero(left.any(axis=0)):
            rows = np.flatnonzero(left[:, number])
            found = ((vectors[rows] - self.centroids[number]) ** 2).sum(axis=1)
            nearer = (found < distance[rows]) | ((found == distance[rows]) & (number < best[rows]))
            best[rows[nearer]], distance[rows[nearer]] = number, found[nearer]
        return best, distance


def _blocks(rows: Iterator[pa.RecordBatch], width: int):
    """(batch, vectors, leading coordinates, rest norms) of slices of the stored vectors."""
    for whole in rows:
        for at in range(0, whole.num_rows, SLICE):
            batch = whole.slice(at, SLICE)
            n = batch.num_rows
            vectors = np.frombuffer(b"".join(batch.column("whole").to_pylist()), dtype="<i4").reshape(n, width).astype(np.int64)
            lead = np.frombuffer(b"".join(batch.column("lead").to_pylist())).reshape(n, -1)
            yield batch, vectors, lead, batch.column("rest").to_numpy()


class Clustering:
    """The stored vectors, their rotation and the centroids so far."""

    def __init__(self, vectors: DataFrame, width: int = WIDTH, scale: int = SCALE, leading: int = LEADING, sample: int = SAMPLE):
        self.spark, self.width = vectors.sparkSession, width
        columns = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
        share = min(1.0, sample / max(1, columns.count()))
        chance = F.pmod(F.xxhash64(F.lit(13), "vec_id"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
        some = columns.where(chance).select("embedding").limit(2 * sample).toArrow().column(0).combine_chunks()
        rotation = self.rotation = Rotation(whole_vectors(some, width, scale)[0], width, leading)

        def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for large in rows:
                for at in range(0, large.num_rows, SLICE):
                    batch = large.slice(at, SLICE)
                    whole, good = whole_vectors(batch.column("embedding"), width, scale)
                    lead, rest = rotation(whole)
                    yield pa.record_batch(
                        [
                            batch.column("vec_id").filter(pa.array(good)),
                            pa.array([x.tobytes() for x in whole.astype("<i4")], pa.binary()),
                            pa.array([x.tobytes() for x in lead], pa.binary()), pa.array(rest),
                        ],
                        names=["vec_id", "whole", "lead", "rest"],
                    )

        self.rows = stored(columns.mapInArrow(run, "vec_id bigint, whole binary, lead binary, rest double"), "clusters-vectors")
        self.centroids = np.zeros((0, width), dtype=np.int64)

    def start(self, count: int = CENTROIDS) -> None:
        """The vectors with the smallest hashes of their ids become the centroids."""
        order = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
        first = self.rows.where("vec_id is not null").select(order.alias("order"), "whole").orderBy("order", "whole").limit(count)
        found = [np.frombuffer(r["whole"], dtype="<i4") for r in first.collect()]
        self.centroids = np.array(found, dtype=np.int64).reshape(-1, self.width)

    def _filter(self) -> Filter:
        return Filter(self.centroids, self.rotation)

    def step(self) -> None:
        """Assign all vectors, and move every centroid that has some to the floor of their mean."""
        if not len(self.centroids):
            return
        near, width, count = self._filter(), self.width, len(self.centroids)

        def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, sizes = np.zeros((count, width), dtype=np.int64), np.zeros(count, dtype=np.int64)
            for _, vectors, lead, rest in _blocks(rows, width):
                best, _ = near.nearest(vectors, lead, rest)
                for number in np.unique(best):
                    own = vectors[best == number]
                    sums[number] += own.sum(axis=0)
                    sizes[number] += len(own)
            some = np.flatnonzero(sizes)
            yield pa.record_batch(
                [
                    pa.array(np.repeat(some, width).astype(np.int32)), pa.array(np.tile(np.arange(width, dtype=np.int32), len(some))),
                    pa.array(np.repeat(sizes[some], width)), pa.array(sums[some].ravel()),
                ],
                names=["cluster", "place", "n", "total"],
            )

        parts = self.rows.select("whole", "lead", "rest").mapInArrow(run, "cluster int, place int, n bigint, total bigint")
        wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
        moved = self.centroids.copy()
        for r in parts.groupBy("cluster", "place").agg(wide("n"), wide("total")).collect():  # clusters x components
            moved[r["cluster"], r["place"]] = int(r["total"]) // int(r["n"])
        self.centroids = moved

    def assigned(self) -> DataFrame:
        """vec_id, cluster and squared distance of every vector, for the centroids as they are now."""
        near, width = self._filter(), self.width

        def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch, vectors, lead, rest in _blocks(rows, width):
                best, distance = near.nearest(vectors, lead, rest) if len(near.centroids) else (np.full(len(vectors), -1), np.full(len(vectors), -1))
                yield pa.record_batch([batch.column("vec_id"), pa.array(best.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"])

        out = self.rows.mapInArrow(run, "vec_id bigint, cluster int, distance bigint")
        return out.where("cluster >= 0")  # no centroid: only rows with null ids


def cluster_digests(vectors: DataFrame, count: int = CENTROIDS, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, cluster, distance, the inertia of the cluster and of all, and a hash of the centroid."""
    work = Clustering(vectors)
    work.start(count)
    for _ in range(rounds):
        work.step()
    rows = stored(work.assigned(), "clusters-assigned")
    discard(work.rows)
    spark = vectors.sparkSession
    totals = {r["cluster"]: int(r["d"]) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    whole = sum(totals.values())
    digest = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in work.centroids]
    table = [(n, d, whole, digest[n]) for n, d in totals.items()]
    made = spark.createDataFrame(table, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    out = rows.join(F.broadcast(made), "cluster")  # a row per centroid
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
