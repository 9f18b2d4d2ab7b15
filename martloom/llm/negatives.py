"""Hard negatives by threshold joins on an inverted index with norm bounds.

Anchors look for rows whose inner product reaches a threshold. Rows and anchors are
dealt into groups of bounded size, and every group of rows meets every group of
anchors once. Inside such a pair of groups

- components stand in one order for all, those that hold most first, and behind
  each step of ``PANEL`` components the norm of what is left is known;
- the index of a group of rows has, per component, the rows that still need it: the
  end of a row whose norm, times the largest norm of an anchor, can not reach the
  lowest threshold alone is left out. Rows stand in the order of how far they are
  indexed, so the rows of a component are the first ones;
- partial scores are added up panel by panel, and an anchor and a row part as soon
  as the partial score and the product of the norms left are below the threshold;
- what is left is scored in integers, and a group keeps the best few per anchor (and
  positive) only, so a group of copies gives no more rows than any other.

First the positives: an anchor begins with a high threshold, the best score of its
label in a bounded sample, and if fewer rows than wanted reach it, goes on with the
score that as many rows of the sample reach, and at last without one. Then the
windows of negatives below each positive: thresholds go from ``STEPS[0]`` of the
positive's score down to the end of the window, and only windows that are not full
go on. Every score of the result is exact, and a threshold never costs a row.

Defined cases: rows with a null id, label, vector or a null or non-finite component
take no part, nor do those with a component of ``FAR`` or more, whose scores could
not be told in 64 bits; a vector's missing components count as zero, so vectors of
other lengths and empty ones take part; rows with one id are rows of their own (a copy of an
anchor may be its positive, and each copy is an anchor); equal scores go by the
smaller id; an anchor alone with its label, or whose window is empty, has no row;
an empty table has an empty result. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import discard, stored

SCALE, POSITIVES, NEGATIVES = 256, 5, 5
LOWEST = 80  # percent of the positive's score that a negative reaches
STEPS = (0.92,)  # thresholds of a window before its end, as shares of the positive's score
GROUP = 16_384  # rows, or anchors, of a group
SAMPLE = 2_048  # rows that the first thresholds come from, at most about
PANEL = 16  # components between two looks at the bounds
SLICE = 256  # anchors worked on at a time
PAIRS = 1 << 16  # exact scores taken at a time
FAR = 1 << 20  # components are below this, before scaling
ALL = -(1 << 62)  # threshold that every score reaches


def whole_rows(column: pa.Array, scale: int = SCALE) -> tuple[list[bytes | None], int]:
    """floor(scale * x) of each vector as 32-bit integers, None for those that take no part, and the largest length."""
    ends = column.offsets.to_numpy()
    values = column.values.cast(pa.float64()).fill_null(math.nan).to_numpy(zero_copy_only=False)
    fine = np.abs(np.nan_to_num(values, nan=math.inf)) < FAR
    whole = np.floor(scale * np.where(fine, values, 0)).astype("<i4")
    bad = np.concatenate([[0], np.cumsum(~fine)])
    given = column.is_valid().to_numpy(zero_copy_only=False)
    good = given & (bad[ends[1:]] == bad[ends[:-1]])
    out = [whole[a:b].tobytes() if g else None for a, b, g in zip(ends, ends[1:], good, strict=False)]
    return out, int(max([b - a for a, b, g in zip(ends, ends[1:], good, strict=False) if g], default=0))


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors of 32-bit integers as rows of one matrix; missing components are zero."""
    raws = column.to_pylist()
    if all(len(r) == 4 * width for r in raws):
        return np.frombuffer(b"".join(raws), dtype="<i4").reshape(len(raws), width).astype(np.int64)
    out = np.zeros((len(raws), width), dtype=np.int64)
    for i, raw in enumerate(raws):
        out[i, : len(raw) // 4] = np.frombuffer(raw, dtype="<i4")
    return out


def exact(one: np.ndarray, two: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows ``a`` of one matrix and ``b`` of the other, in integers."""
    out = np.empty(len(a), dtype=np.int64)
    for at in range(0, len(a), PAIRS):
        out[at : at + PAIRS] = np.einsum("ij,ij->i", one[a[at : at + PAIRS]], two[b[at : at + PAIRS]])
    return out


class Index:
    """Inverted index of a group of rows for anchors of at most a norm and thresholds of at least a value."""

    def __init__(self, rows: np.ndarray, order: np.ndarray, largest: float, lowest: float):
        self.cuts = [*range(0, len(order), PANEL), len(order)]
        values = rows[:, order].astype(float)
        self.left = self.norms(values)
        # the fewest panels whose rest can not reach the threshold alone (a bit more, for rounding)
        needed = self.left * largest * (1 + 1e-9) + 1e-6 >= lowest
        self.depth = np.minimum(needed.sum(axis=0), len(self.cuts) - 1)
        self.place = np.argsort(-self.depth, kind="stable")  # rows that need most panels first
        self.depth, self.left = self.depth[self.place], self.left[:, self.place]
        self.values = values[self.place]
        self.first = [int((self.depth > p).sum()) for p in range(len(self.cuts) - 1)]  # rows of each panel

    def norms(self, values: np.ndarray) -> np.ndarray:
        """Norms of what is left behind each cut (one row per cut)."""
        squares = np.concatenate([np.cumsum((values**2)[:, ::-1], axis=1)[:, ::-1], np.zeros((len(values), 1))], axis=1)
        return np.sqrt(squares[:, self.cuts].T)

    def candidates(self, anchors: np.ndarray, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(anchor, row) places of all pairs whose score may reach the anchor's threshold."""
        left = self.norms(anchors)
        size = left[0][:, None]
        want = thresholds.astype(float)[:, None] - 1e-6
        slack = 1e-9 * size  # times the row's norm: what rounding may have taken from a partial score
        scores = np.zeros((len(anchors), self.first[0] if self.first else 0))
        live = np.ones(scores.shape, dtype=bool)
        for p, n in enumerate(self.first):
            if not n:
                break
            part = slice(self.cuts[p], self.cuts[p + 1])
            scores[:, :n] += anchors[:, part] @ self.values[:n, part].T
            bound = scores[:, :n] + left[p + 1][:, None] * self.left[p + 1, :n] + slack * self.left[0, :n]
            live[:, :n] &= bound >= want
        a, b = np.nonzero(live)
        return a, self.place[b]


def best_of(anchor: np.ndarray, score: np.ndarray, row_id: np.ndarray, count: int) -> np.ndarray:
    """Places of the first ``count`` of each anchor, by score and then the smaller id."""
    order = np.lexsort((row_id, -score, anchor))
    own = anchor[order]
    begins = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.zeros(0, dtype=np.int64)
    place = np.arange(len(own)) - np.repeat(begins, np.diff(np.append(begins, len(own))))
    return order[place < count]


class Search:
    """One kind of look-up between a group of rows and a group of anchors."""

    def __init__(self, order: np.ndarray, same_label: bool, count: int):
        self.order, self.same_label, self.count = order, same_label, count

    def scored(self, rows: dict, anchors: dict) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(anchor, row, score) of every pair that reaches the anchor's threshold, a few anchors at a time."""
        if not len(anchors["key"]):
            return
        norms = np.sqrt((anchors["whole"].astype(float) ** 2).sum(axis=1))
        index = Index(rows["whole"], self.order, float(norms.max()), float(anchors["threshold"].min()))
        ordered = anchors["whole"][:, self.order].astype(float)
        for at in range(0, len(norms), SLICE):
            a, b = index.candidates(ordered[at : at + SLICE], anchors["threshold"][at : at + SLICE])
            a += at
            fits = (anchors["label"][a] == rows["label"][b]) == self.same_label
            fits &= anchors["key"][a] != rows["key"][b]
            a, b = a[fits], b[fits]
            score = exact(anchors["whole"], rows["whole"], a, b)
            found = score >= anchors["threshold"][a]
            yield a[found], b[found], score[found]

    def positives(self, rows: dict, anchors: dict) -> Iterator[dict]:
        for label in np.unique(rows["label"]):
            own, asked = (np.flatnonzero(x["label"] == label) for x in (rows, anchors))
            some, ask = ({k: v[at] for k, v in x.items()} for x, at in ((rows, own), (anchors, asked)))
            for a, b, score in self.scored(some, ask):
                kept = best_of(a, score, some["vec_id"][b], self.count)
                yield {"anchor": ask["key"][a[kept]], "window": np.zeros(len(kept), dtype=np.int64), "key": some["key"][b[kept]], "vec_id": some["vec_id"][b[kept]], "score": score[kept]}

    def windows(self, rows: dict, anchors: dict) -> Iterator[dict]:
        for a, b, score in self.scored(rows, anchors):
            for w in range(anchors["high"].shape[1]):
                inside = np.flatnonzero((score <= anchors["high"][a, w]) & (score >= anchors["low"][a, w]))
                kept = inside[best_of(a[inside], score[inside], rows["vec_id"][b[inside]], self.count)]
                yield {"anchor": anchors["key"][a[kept]], "window": np.full(len(kept), w), "key": rows["key"][b[kept]], "vec_id": rows["vec_id"][b[kept]], "score": score[kept]}


FOUND = "anchor bigint, window bigint, key bigint, vec_id bigint, score bigint"


class Rows:
    """The rows that take part, stored as integers, with the order of their components and a bounded sample."""

    def __init__(self, vectors: DataFrame, label: Column | str = "label", scale: int = SCALE):
        spark = self.spark = vectors.sparkSession
        columns = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), (F.col(label) if isinstance(label, str) else label).cast("bigint").alias("label"), "embedding")
        columns = columns.where("vec_id is not null and label is not null and embedding is not null")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                whole, width = whole_rows(batch.column("embedding"), scale)
                out = pa.record_batch([batch.column("vec_id"), batch.column("label"), pa.array(whole, pa.binary()), pa.array([width] * len(whole), pa.int32())], names=["vec_id", "label", "whole", "width"])
                yield out.filter(pc.is_valid(out.column("whole")))

        made = columns.mapInArrow(run, "vec_id bigint, label bigint, whole binary, width int")
        self.rows = stored(made.withColumn("key", F.monotonically_increasing_id()), "negatives-rows")
        seen = self.rows.agg(F.count("*").alias("n"), F.max("width").alias("width")).first()
        self.count, self.width = seen["n"], max(1, seen["width"] or 0)
        share = min(1.0, SAMPLE / max(1, self.count))
        chance = F.pmod(F.xxhash64(F.lit(12), "key"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
        some = self.rows.where(chance).select("key", "label", "whole").limit(2 * SAMPLE).toArrow()
        self.sample = {"key": some.column("key").to_numpy(), "label": some.column("label").to_numpy(), "whole": matrix(some.column("whole"), self.width)}
        self.order = np.argsort(-(self.sample["whole"].astype(float) ** 2).sum(axis=0), kind="stable")

    def first_thresholds(self, anchors: DataFrame, wanted: int) -> DataFrame:
        """The anchors with ``high``, the best score of their label in the sample, and ``sure``, the one that ``wanted`` rows of it reach."""
        sample, width = self.sample, self.width  # at most 2 * SAMPLE rows

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for large in batches:
                for at in range(0, large.num_rows, SLICE):
                    batch = large.slice(at, SLICE)
                    own, labels, keys = matrix(batch.column("whole"), width), batch.column("label").to_numpy(), batch.column("key").to_numpy()
                    high, sure = [], []
                    for vector, label, key in zip(own, labels, keys, strict=True):
                        there = np.flatnonzero((sample["label"] == label) & (sample["key"] != key))
                        score = np.sort(sample["whole"][there] @ vector)[::-1]
                        high.append(int(score[0]) if len(score) else ALL)
                        sure.append(int(score[wanted - 1]) if len(score) >= wanted else ALL)
                    yield pa.record_batch([*batch.columns, pa.array(high, pa.int64()), pa.array(sure, pa.int64())], names=[*batch.schema.names, "high", "sure"])

        return anchors.mapInArrow(run, anchors.select("*").schema.add("high", "long").add("sure", "long"))

    def meet(self, anchors: DataFrame, same_label: bool, count: int, windows: int) -> DataFrame:
        """Every group of rows with every group of anchors: the best ``count`` per anchor and window of each pair of groups.

        A row goes to as many places as there are groups of anchors, an anchor to as
        many as there are groups of rows.
        """
        width, search = self.width, Search(self.order, same_label, count)
        cores = self.spark.sparkContext.defaultParallelism
        across = max(1, -(-anchors.count() // GROUP))
        down = max(-(-self.count // GROUP), min(2 * cores, -(-self.count // 1024)), 1)

        def dealt(df: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
            return df.withColumn(own, F.pmod(F.xxhash64(F.lit(3), "key"), F.lit(n)).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1))))

        def arrays(table: pa.Table, names: list[str]) -> dict:
            out = {n: table.column(n).to_numpy() for n in names}
            return out | {"whole": matrix(table.column("whole"), width)}

        names = ["anchor", "window", "key", "vec_id", "score"]

        def run(rows: pa.Table, asked: pa.Table) -> pa.Table:
            if not rows.num_rows or not asked.num_rows:  # such a side may come without columns
                return pa.table({n: pa.array([], pa.int64()) for n in names})
            one = arrays(rows, ["key", "vec_id", "label"])
            asked = asked.rename_columns([n.removeprefix("asked_") for n in asked.column_names])
            two = arrays(asked, ["key", "label", "threshold"])
            for side in ("low", "high"):
                two[side] = np.array(asked.column(side).to_pylist(), dtype=np.int64).reshape(-1, windows)
            found = list(search.positives(one, two) if same_label else search.windows(one, two))
            nothing = [np.zeros(0, dtype=np.int64)]
            return pa.table({n: pa.array(np.concatenate([f[n] for f in found] or nothing), pa.int64()) for n in names})

        left = dealt(self.rows.select("key", "vec_id", "label", "whole"), "down", down, "across", across)
        # under new names, so that anchors may be picked from the very rows they meet
        asked = anchors.select(*[F.col(n).alias(f"asked_{n}") for n in ("key", "label", "whole", "threshold", "low", "high")])
        right = dealt(asked.withColumn("key", F.col("asked_key")), "across", across, "down", down).drop("key")
        return left.groupBy("down", "across").cogroup(right.groupBy("down", "across")).applyInArrow(run, FOUND)


def best_rows(found: DataFrame, by: list[str], count: int) -> DataFrame:
    """The first ``count`` rows per key with their rank, by score and then the smaller id; cut in each task before the shuffle."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id", "key")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def positives(rows: Rows, anchors: DataFrame, count: int = POSITIVES) -> DataFrame:
    """(anchor, key, vec_id, score, rank) of the best rows of each anchor's label; anchors are rows of ``rows`` with ``wanted``."""
    none = F.array(F.lit(ALL))
    asked = stored(rows.first_thresholds(anchors, count), "negatives-anchors")
    done, steps = [], [F.col("high"), F.col("sure"), F.lit(ALL)]
    for i, threshold in enumerate(steps):
        turn = asked.withColumn("threshold", threshold).withColumn("low", none).withColumn("high", none)
        found = rows.meet(turn, True, count, 1).drop("window")
        best = stored(best_rows(found, ["anchor"], count), "negatives-positives")
        full = best.groupBy("anchor").agg(F.count("*").alias("n"))
        state = asked.join(full, F.col("key") == F.col("anchor"), "left").where(F.coalesce("n", F.lit(0)) < F.col("wanted"))
        rest = stored(state.select(*asked.columns), "negatives-anchors")
        done.append(best.join(rest.select(F.col("key").alias("anchor")), "anchor", "left_anti"))
        asked = rest
        if i + 1 == len(steps) or asked.isEmpty():
            break
    return _union(done)


def negatives(rows: Rows, anchors: DataFrame, found: DataFrame, count: int = NEGATIVES, lowest: int = LOWEST, most: int = POSITIVES) -> DataFrame:
    """(anchor, window, vec_id, score, rank): the best rows of other labels in the window below each positive, by the positive's rank."""
    # a window that no score can be in is never looked for
    low = F.ceil(F.col("score").cast("decimal(20,0)") * F.lit(Decimal(lowest) / 100)).cast("bigint")
    asked = found.where("score >= 0").select("anchor", (F.col("rank") - 1).cast("bigint").alias("window"), F.col("score").alias("high"), low.alias("end"))
    done = []
    for i, step in enumerate([*STEPS, 0.0]):
        turn = asked.withColumn("low", F.greatest("end", F.ceil(F.col("high") * F.lit(step))))
        asked = stored(turn, "negatives-windows")
        slots = [F.max(F.when(F.col("window") == w, F.col(c))).alias(f"{c}{w}") for c in ("low", "high") for w in range(most)]
        wide = asked.groupBy("anchor").agg(F.min("low").alias("threshold"), *slots)
        # a window that is full or missing is empty: its end is above its beginning
        sides = [F.array(*[F.coalesce(f"{c}{w}", F.lit(0 if c == "low" else -1).cast("bigint")) for w in range(most)]).alias(c) for c in ("low", "high")]
        turn = anchors.select("key", "label", "whole").join(wide, F.col("key") == F.col("anchor")).select("key", "label", "whole", "threshold", *sides)
        part = rows.meet(stored(turn, "negatives-asked"), False, count, most)
        best = stored(best_rows(part, ["anchor", "window"], count), "negatives-found")
        full = best.groupBy("anchor", "window").agg(F.count("*").alias("n"))
        rest = asked.join(full, ["anchor", "window"], "left").where((F.coalesce("n", F.lit(0)) < count) & (F.col("low") > F.col("end")))
        rest = stored(rest.select("anchor", "window", "high", "end"), "negatives-windows")
        done.append(best.join(rest.select("anchor", "window"), ["anchor", "window"], "left_anti"))
        asked = rest
        if asked.isEmpty():
            break
    return _union(done)


def hard_negatives(vectors: DataFrame, anchor: Column | str, label: Column | str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id and the two scores for every row that ``anchor`` picks."""
    rows = Rows(vectors, label)
    of_label = rows.rows.groupBy("label").agg((F.count("*") - 1).alias("others"))
    asked = rows.rows.where(anchor).drop("width").join(of_label, "label").withColumn("wanted", F.least("others", F.lit(POSITIVES)))
    asked = stored(asked.where("wanted > 0").drop("others"), "negatives-anchors")
    best = stored(positives(rows, asked), "negatives-positives")
    below = negatives(rows, asked, best)
    sides = best.select("anchor", (F.col("rank") - 1).alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = below.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"}).join(sides, ["anchor", "window"])
    out = out.join(asked.select(F.col("key").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
    out = stored(out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"), "negatives")
    for done in (rows.rows, asked, best):
        discard(done)
    return out
