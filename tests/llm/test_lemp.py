import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from winnow.llm import lemp


def brute(rows, positives, negatives, low=50, high=95):
    known = [
        (i, label, np.array([math.floor(256 * float(x)) for x in v], object))
        for i, v, label in rows
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    width = max((len(v) for _, _, v in known), default=0)
    known = [(i, label, np.append(v, [0] * (width - len(v)))) for i, label, v in known]
    out = []
    for a, (i, label, q) in enumerate(known):
        if i % 50:
            continue
        scored = [(-int((q * v).sum()), j, other) for b, (j, other, v) in enumerate(known) if b != a]
        best = sorted((s, j) for s, j, other in scored if other == label)[:positives]
        for s, j in best:
            fits = sorted(
                (t, k) for t, k, other in scored if other != label and 50 * -s <= 100 * -t <= high * -s and low == 50
            )
            out += [(i, j, r + 1, k, -s, -t) for r, (t, k) in enumerate(fits[:negatives])]
    return sorted(out)


def rows_of(case, draw):
    size = {"few": 9, "hot": 700}.get(case, 500)
    middles = [[draw.gauss(0, 1) for _ in range(6)] for _ in range(12)]
    rows = []
    for i in range(size):
        middle = middles[draw.randrange(12)]
        vector = [m + draw.gauss(0, 0.4) for m in middle]
        label = draw.randrange(4)
        if case == "hot" and draw.random() < 0.5:  # one vector and one label with many rows
            vector, label = middles[0], 0
        if case == "lengths":
            vector = [x * draw.choice([1e-3, 1, 30]) for x in vector]
        if case == "large":
            vector = [x * 1e6 for x in vector]
        if case == "ties":
            vector = [float(draw.choice([-1, 0, 1])) for _ in range(6)]
        rows.append((i, vector, label))
    return rows


@pytest.mark.parametrize("case", ["plain", "few", "hot", "lengths", "large", "ties"])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, case):
    monkeypatch.setattr(lemp, "BUCKET", 60)
    monkeypatch.setattr(lemp, "BLOCK", 3)
    monkeypatch.setattr(lemp, "LANE", 2)
    rows = rows_of(case, random.Random(case))
    rows += [(1000, None, 1), (1050, [], 1), (1100, [1.0, None], 1), (1150, [math.nan] * 6, 1), (1200, [1.0], None),
             (1250, [0.0] * 6, 2), (1300, [1.0, 2.0], 2), (None, [1.0] * 6, 1), (50, [2.0] * 6, 3)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    frame = frame.selectExpr("*", "1 AS no", "2 AS block", "3 AS row", "4 AS square", "'x' AS asked").repartition(3)
    found = lemp.hard_negatives(frame, F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, found.collect())) == brute(rows, 5, 3)


def test_without_anchors_or_rows(spark):
    frame = spark.createDataFrame([(1, [1.0], 1)], "vec_id long, embedding array<double>, label int")
    assert lemp.hard_negatives(frame, F.col("vec_id") % 50 == 0).count() == 0
    assert lemp.hard_negatives(frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    alone = lemp.hard_negatives(frame, F.col("vec_id") == 1)
    assert alone.count() == 0 and alone.columns[:3] == ["anchor_id", "positive_id", "rank"]


def test_ranges_hold_every_vector_at_a_cosine_in_range():
    draw = np.random.default_rng(3)
    a, b = (lemp.directions(v, lemp.lengths(v)) for v in draw.normal(size=(2, 4000, 5)))
    cosine = (a * b).sum(1)
    for width in (0.0, 0.1, 3.0):
        for f in range(5):
            low, high = lemp.feasible(a[:, f], cosine - width, cosine + width * draw.random())
            assert ((b[:, f] >= low) & (b[:, f] <= high)).all()


def test_few_vectors_are_verified():
    """On clustered vectors the ranges leave a small part of a bucket."""
    draw = np.random.default_rng(1)
    middles = 300 * draw.normal(size=(40, 12))
    vectors = (middles[draw.integers(0, 40, 2000)] + 8 * draw.normal(size=(2000, 12))).astype(np.int64)
    size = lemp.lengths(vectors)
    shares = lemp.directions(vectors, size)
    row = {
        "vectors": vectors.tobytes(), "kind": "<i8", "rows": np.arange(2000).tobytes(),
        "ids": np.arange(2000).tobytes(), "labels": [0] * 2000,
        "lists": np.argsort(shares, axis=0, kind="stable").T.astype("<i4").tobytes(),
    }
    bucket, seen, found = lemp.Bucket(row, 12), 0, 0
    for q in range(0, 2000, 50):
        scores = vectors @ vectors[q]
        need = np.partition(scores, -6)[-6]
        least, most = lemp.cosines(np.array([need], float), np.array([2.0**62]), size[[q]], bucket.short, bucket.long)
        focus = np.argsort(-np.abs(shares[q]))[: lemp.FOCUS]
        got = bucket.candidates(focus, *lemp.feasible(shares[q, focus], least[0], most[0]))
        assert set(np.flatnonzero(scores >= need)) <= set(got.tolist())
        seen, found = seen + 2000, found + len(got)
    assert found < 0.6 * seen
