import math
import random
from collections import Counter

import numpy as np
import pytest
from test_ngram_join import brute, family

from winnow.llm import minhash_bayes as op


def check(spark, rows, size=2, percent=80, parts=4):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    frame = frame.selectExpr("*", "1 AS key", "2 AS sig", "3 AS doc", "4 AS h", "'x' AS band").repartition(parts)
    found = op.near_duplicates(frame, size, percent).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute(rows, size, percent)
    assert all(r.kept == (r.doc_id == r.component_id) or r.doc_id is None for r in found)


@pytest.mark.parametrize(("size", "percent"), [(2, 80), (3, 90)])
def test_equals_brute_force(spark, monkeypatch, size, percent):
    monkeypatch.setattr(op, "TILE", 8)
    monkeypatch.setattr(op, "SLICE", 5)
    draw = random.Random(size)
    texts = []
    for _ in range(6):
        base = [f"w{draw.randrange(900)}" for _ in range(draw.choice([12, 60, 300]))]
        texts += family(draw, base, draw.choice([2, 9, 30]), max(1, len(base) // 12))
    texts += [" ".join(f"r{draw.randrange(50)}" for _ in range(draw.randint(1, 40))) for _ in range(40)]
    draw.shuffle(texts)
    rows = list(enumerate(texts))
    rows += [(900 + i, t) for i, t in enumerate([None, "", " \t\n", "one", "One", "ONE two", "one  two", "İ ẞ", "İ ẞ"])]
    rows += [(3, texts[7]), (5, texts[5]), (None, texts[0]), (None, None), (None, "one")]
    check(spark, rows, size, percent)


def test_large_group_of_chained_copies(spark, monkeypatch):
    """Each copy is near its neighbours alone: nothing but the tiles joins the far ones."""
    monkeypatch.setattr(op, "TILE", 16)
    draw = random.Random(2)
    words = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(90):
        for _ in range(6):
            words[draw.randrange(200)] = f"n{draw.randrange(10**6)}"
        rows.append((draw.randrange(10**9), " ".join(words)))
    check(spark, rows)


def test_texts_of_one_template_make_few_items(spark, monkeypatch, tmp_path):
    """Below the threshold but near it: no pairs are emitted, and the result is whole."""
    draw = random.Random(4)
    common = [f"c{i}" for i in range(1000)]
    counts = []
    real = op.tile_items

    def counted(*args):
        items = real(*args)
        counts.append(items.count())
        return items

    monkeypatch.setattr(op, "tile_items", counted)
    for size in (40, 80):
        rows = [
            (i, " ".join(common + [f"o{draw.randrange(10**7)}" for _ in range(150)])) for i in range(size)
        ]
        rows.append((size, rows[3][1].replace("c500 ", "")))
        check(spark, rows, parts=2)
    # At most an item for each tile of a band, whatever the number of pairs.
    assert max(counts) <= op.BANDS * 4 and counts[1] <= 2 * max(counts[0], op.BANDS)


def test_words_that_collide_in_polynomial_hashes(spark):
    word = ["a"]
    while len(word) < 4096:
        word += ["b" if c == "a" else "a" for c in word]
    other = ["b" if c == "a" else "a" for c in word]
    rows = []
    for i, n in enumerate((1024, 2048, 4096)):
        rows += [(2 * i, "".join(word[:n])), (2 * i + 1, "".join(other[:n]))]
    rows += [(10, " ".join(word[:2048])), (11, " ".join(other[:2048])), (12, " ".join(word[:2047]))]
    check(spark, rows)


def test_bounds_keep_pairs_that_reach_the_threshold():
    """The chance that a pair at the threshold is dropped stays near what is chosen."""
    for percent in (80, 90):
        t, alive, dropped = percent / 100, {0: 1.0}, 0.0
        for _, least in op.least_agreements(percent):
            after = {}
            for m, chance in alive.items():
                for k in range(op.BATCH + 1):
                    p = chance * math.comb(op.BATCH, k) * t**k * (1 - t) ** (op.BATCH - k)
                    after[m + k] = after.get(m + k, 0.0) + p
            dropped += sum(p for m, p in after.items() if m < least)
            alive = {m: p for m, p in after.items() if m >= least}
        assert dropped < 40 * op.MISS


def test_signatures_estimate_similarity():
    draw = np.random.default_rng(2)
    for share in (0.3, 0.6, 0.9):
        agreed = []
        for _ in range(30):
            all_ = draw.integers(0, 2**63, 400, dtype=np.uint64)
            shared = int(400 * share)
            one, other = all_[: shared + (400 - shared) // 2], np.append(all_[:shared], all_[shared + (400 - shared) // 2 :])
            a, b = op.signatures([np.unique(one), np.unique(other)])
            agreed.append((a == b).mean())
        assert abs(np.mean(agreed) - share) < 0.03


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert op.near_duplicates(frame).count() == 0
    frame = spark.createDataFrame([(1, None), (None, " ")], "doc_id long, text string")
    assert sorted(map(tuple, op.near_duplicates(frame).collect()), key=str) == [(1, 0, 1, True), (None, 0, None, True)]
