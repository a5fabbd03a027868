import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from winnow.llm import mtree


def brute(rows, asked, k):
    known = [
        (i, np.array([math.floor(64 * float(x)) for x in v], object))
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    width = max(len(v) for _, v in known)
    known = [(i, np.append(v, [0] * (width - len(v)))) for i, v in known]
    out = {}
    for i, q in known:
        if i % 20 == 0 and asked:
            scored = sorted((-int((q * v).sum()), j) for j, v in known if j != i)[:k]
            out.update({(i, rank + 1): (j, -s) for rank, (s, j) in enumerate(scored)})
    return out


@pytest.mark.parametrize("case", ["clusters", "equal", "few", "large"])
def test_top_k_is_exact(spark, monkeypatch, case):
    monkeypatch.setattr(mtree, "SUBTREE", 40)
    monkeypatch.setattr(mtree, "PAGE", 8)
    monkeypatch.setattr(mtree, "BLOCK", 6)
    draw = random.Random(case)
    size = 12 if case == "few" else 500
    scale = 1e7 if case == "large" else 1.0
    rows = []
    for i in range(size):
        middle = [draw.choice([-1, 0, 1]) for _ in range(6)]
        if case == "equal" and draw.random() < 0.5:
            vector = [0.5] * 6
        else:
            vector = [scale * (m + draw.gauss(0, 0.2)) for m in middle]
        rows.append((i, vector))
    rows += [(1000, None), (1020, []), (1040, [1.0, None, 0.0]), (1060, [math.nan] * 6),
             (1080, [math.inf, 0.0]), (1100, [1.0, 2.0]), (None, [1.0] * 6)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    frame = frame.selectExpr("*", "1 AS node", "2 AS block").repartition(3)
    found = mtree.top_k(frame, F.col("vec_id") % 20 == 0, k=7).collect()
    assert {(r.query_id, r.rank): (r.vec_id, r.score) for r in found} == brute(rows, True, 7)


def test_without_queries_or_rows(spark):
    frame = spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<double>")
    assert mtree.top_k(frame, F.col("vec_id") % 20 == 0).count() == 0
    assert mtree.top_k(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_functions_that_travel_are_free_of_the_session(spark):
    """The index is built where the package travels with the job, as in a registered query."""
    rows = [(i, [float(i % 3), 1.0]) for i in range(40)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").select(
        "vec_id", mtree.whole(F.col("embedding"), 64).alias("v")
    )
    assert mtree.Index(vectors, 2.0 * 128**2, 2).subtrees.agg(F.sum("n")).first()[0] == 40
