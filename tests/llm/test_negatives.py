"""Hard negatives against scoring every pair, whatever the tree looks like."""

import math
import random

import numpy as np
import pytest

from pintulog.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, cell string, low string"


def brute(rows):
    points = {}
    for vec_id, vector, label, *_ in rows:
        if vec_id is None or label is None or not vector or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        row = (label, [math.floor(256 * float(np.float32(x))) for x in vector])
        points[vec_id] = min(points.get(vec_id, row), row)
    out = set()
    for a, (label, v) in points.items():
        if a % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other == label) for i, (other, w) in points.items() if i != a)
        for p_score, p, same in [s for s in scored if s[2]][:5]:
            fits = [s for s in scored if not s[2] and 30 * -p_score <= 100 * -s[0] <= 90 * -p_score][:10]
            out |= {(a, p, rank + 1, n, -p_score, -n_score) for rank, (n_score, n, _) in enumerate(fits)}
    return out


def random_rows(seed, count, size=6, copies=0.3):
    rng = random.Random(seed)
    hot = [rng.gauss(0, 1) for _ in range(size)]
    centers = [[rng.gauss(0, 1) for _ in range(size)] for _ in range(12)]
    rows = []
    for i in range(count):
        center = rng.choice(centers)
        vector = hot if rng.random() < copies else [x + rng.gauss(0, 0.3) for x in center]
        rows.append((i, [float(np.float32(x)) for x in vector], rng.randint(0, 9), "x", "y"))
    odd = [(None, hot, 1), (5000, None, 1), (5001, [], 1), (5002, [None] * size, 1), (5003, [float("nan")] * size, 1), (5004, hot, None), (5006, [0.0] * size, 3), (5007, hot, -3)]
    rows += [(*r, "x", "y") for r in odd]
    return rows + rows[:20]


def mined(spark, rows, block=negatives.BLOCK):
    points = negatives.labelled_points(spark.createDataFrame(rows, SCHEMA).repartition(5))
    found = negatives.hard_negatives(points, points.filter("id % 100 = 0"), block=block).collect()
    assert len(set(found)) == len(found)
    return {(r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in found}


@pytest.mark.parametrize("seed, count, block", [(1, 600, 4096), (2, 900, 40), (3, 130, 1)])
def test_equals_scoring_every_pair(spark, monkeypatch, seed, count, block):
    monkeypatch.setattr(negatives, "SEARCHES", 7)
    rows = random_rows(seed, count)
    expected = brute(rows)
    assert expected
    assert mined(spark, rows, block) == expected


def test_all_copies_no_rows_one_row(spark):
    copies = [(i, [0.5, 0.25], i % 3, "x", "y") for i in range(300)]
    assert mined(spark, copies) == brute(copies)
    assert mined(spark, []) == set()
    assert mined(spark, [(100, [0.5], 1, "x", "y")]) == set()


def test_negative_scores_and_unequal_lengths(spark):
    rows = [(100 * i, [-1.0 if i % 2 else 1.0, 0.01 * i], 1 if i < 4 else 2, "x", "y") for i in range(9)]
    assert mined(spark, rows) == brute(rows)
    with pytest.raises(ValueError, match="vectors have 1 to 2 components"):
        mined(spark, [(100, [1.0], 1, "x", "y"), (1, [1.0, 2.0], 1, "x", "y")])


def test_siblings_outside_the_annulus_are_left_out():
    rng = np.random.default_rng(4)
    centers = rng.integers(-400, 400, (10, 8))
    vectors = np.repeat(centers, 200, axis=0) + rng.integers(-12, 13, (2000, 8))
    most = float((vectors.astype(float) ** 2).sum(axis=1).max())
    points = negatives.lifted(vectors, most)
    ids = np.arange(2000)
    labels = np.zeros(2000, np.int64)
    anchors = vectors[:50]
    scores = negatives.products(anchors, vectors)
    top = np.sort(scores, axis=1)[:, -1]
    low, high = np.ceil(0.7 * top).astype(np.int64), np.floor(0.8 * top).astype(np.int64)
    met = []

    class Counting(negatives.Searches):
        def meet(self, at, vectors, ids, labels):
            met.append(len(at) * len(ids))
            super().meet(at, vectors, ids, labels)

    found = Counting(anchors, np.full(50, -1), labels[:50], np.full(50, True), low, high, 3, most)
    found.through(negatives.Node(ids, points), points, vectors, ids, labels)
    assert sum(met) < 0.5 * 50 * 2000
    for i in range(50):
        fits = sorted((-s, j) for j, s in enumerate(scores[i].tolist()) if low[i] <= s <= high[i])[:3]
        got = [(-s, j) for s, j in zip(found.best[i].tolist(), found.best_id[i].tolist()) if s != negatives.NONE]
        assert got == fits
