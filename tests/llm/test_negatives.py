"""Hard negatives against plain integer arithmetic over all pairs."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from martloom.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, key string, score string, rank string"


def _brute(rows):
    """Rows of the result for (vec_id, vector, label), anchors being the ids divisible by 10."""
    usable = lambda i, v, c: i is not None and c is not None and v is not None and all(x is not None and abs(x) < negatives.FAR for x in v)
    kept = [(n, i, [math.floor(256 * float(x)) for x in v], c) for n, (i, v, c) in enumerate(rows) if usable(i, v, c)]
    out = Counter()
    for n, i, q, c in kept:
        if i % 10:
            continue
        scored = sorted([(-sum(a * b for a, b in zip(q, p, strict=False)), j, m, d) for m, j, p, d in kept if m != n])
        for ps, j, _, _ in [s for s in scored if s[3] == c][:5]:
            inside = [s for s in scored if s[3] != c and 80 * -ps <= 100 * -s[0] <= 100 * -ps][:5]
            out.update((i, j, rank, k, -ps, -ns) for rank, (ns, k, _, _) in enumerate(inside, 1))
    return out


def _same(spark, rows):
    df = spark.createDataFrame([(i, v, c, "x", "y", "z") for i, v, c in rows], SCHEMA).repartition(3)
    found = Counter(tuple(r) for r in negatives.hard_negatives(df, "vec_id % 10 = 0").collect())
    assert found == _brute(rows)
    return found


def _vectors(make, n, width=64):
    rows = make.standard_normal((n, width))
    return (rows / np.linalg.norm(rows, axis=1, keepdims=True)).astype(np.float32).tolist()


def test_odd_rows(spark):
    make = np.random.default_rng(1)
    good = _vectors(make, 60)
    rows = [(i, v, i % 3) for i, v in enumerate(good[:50])]
    rows += [(10, good[10], 1), (10, good[10], 1), (11, good[11], 2), (None, good[50], 1), (70, good[51], None), (80, None, 1), (90, [None, *good[52][1:]], 1)]
    rows += [(100, [float("nan")] * 64, 0), (110, [float("inf")] * 64, 0), (120, good[53][:20], 0), (121, [], 0), (130, [], 1), (140, good[54], 77), (150, [2e6] * 64, 0)]
    assert _same(spark, rows)
    assert negatives.hard_negatives(spark.createDataFrame([], SCHEMA), "vec_id % 10 = 0").collect() == []


@pytest.mark.parametrize("sample", [1, 40, 2_048])
def test_thresholds_go_down_until_windows_are_full(spark, monkeypatch, sample):
    """Several groups on either side; few rows in the sample make the later thresholds necessary."""
    monkeypatch.setattr(negatives, "SAMPLE", sample)
    monkeypatch.setattr(negatives, "GROUP", 30)
    make = np.random.default_rng(2)
    centres = np.array(_vectors(make, 12))
    near = centres[make.integers(0, 12, 400)] + 0.1 * make.standard_normal((400, 64))
    rows = [(i, v, int(make.integers(0, 6)) if i % 50 else 9) for i, v in enumerate(near.astype(np.float32).tolist())]
    assert len(_same(spark, rows)) > 100


def test_a_group_of_copies_and_ties(spark, monkeypatch):
    """A third of the rows are one vector, in two labels: ties go by the id, and a group gives few rows."""
    monkeypatch.setattr(negatives, "GROUP", 100)
    make = np.random.default_rng(3)
    one, others = _vectors(make, 1)[0], _vectors(make, 200)
    rows = [(i, one if i % 3 == 0 else others[i % 200], (i // 3) % 2) for i in range(450)]
    _same(spark, rows)
    rows = negatives.Rows(spark.createDataFrame([(i, v, c, "", "", "") for i, v, c in rows], SCHEMA))
    asked = rows.rows.where("vec_id % 10 = 0").withColumn("wanted", F.lit(5))
    empty = F.array(F.lit(0).cast("bigint"))
    found = rows.meet(asked.select("key", "label", "whole", F.lit(negatives.ALL).alias("threshold"), empty.alias("low"), empty.alias("high")), True, 5, 1)
    assert found.count() <= asked.count() * 5 * 8


def test_the_index_leaves_out_what_bounds_cover():
    make = np.random.default_rng(4)
    rows = np.floor(256 * np.array(_vectors(make, 500)) * (0.8 ** np.arange(64) * 8)).astype(np.int64)
    anchors, order = rows[:50], np.arange(64)
    scores = anchors @ rows.T
    thresholds = np.sort(scores, axis=1)[:, -20]
    norms = np.sqrt((anchors.astype(float) ** 2).sum(axis=1))
    index = negatives.Index(rows, order, norms.max(), thresholds.min())
    a, b = index.candidates(anchors.astype(float), thresholds)
    found = np.zeros(scores.shape, dtype=bool)
    found[a, b] = True
    assert found[scores >= thresholds[:, None]].all()
    assert found.mean() < 0.2 and (index.depth < 4).any()
    every = negatives.Index(rows, order, norms.max(), float(negatives.ALL))
    a, _ = every.candidates(anchors.astype(float), np.full(50, negatives.ALL))
    assert len(a) == scores.size
