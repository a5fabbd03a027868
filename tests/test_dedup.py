import random

import pytest
from pyspark.sql import functions as F

from winnow.functions import minhash
from winnow.operators import dedup


def brute_components(edges):
    label = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


@pytest.mark.parametrize("hot", [False, True])
def test_dedup_clusters(spark, request, hot):
    if hot:
        request.getfixturevalue("small_hot")
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(500, i) for i in range(501, 540)]
    tangle = [(rng.randrange(1000, 1060), rng.randrange(1000, 1060)) for _ in range(45)]
    tangle = [(a, b) for a, b in tangle if a != b]
    edges = chain + star + tangle
    rng.shuffle(edges)
    df = spark.createDataFrame(edges, "src bigint, dst bigint").repartition(5)
    found = {r.id: r.component for r in dedup.dedup_clusters(df).collect()}
    assert found == brute_components(edges)


def test_no_edges(spark):
    empty = spark.createDataFrame([], "src bigint, dst bigint")
    assert dedup.dedup_clusters(empty).count() == 0


def test_signature_matches_definition(spark):
    texts = ["one two three four five six seven", "too short a text", "a b c d e"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    found = {r.id: r.sig for r in dedup.minhash_signature(df).collect()}
    assert set(found) == {0, 2}
    import hashlib

    words = [int(hashlib.md5(w.encode()).hexdigest()[:8], 16) for w in texts[0].split()]
    factors = minhash.word_coefficients(5)
    hashes = [
        sum(w * c % minhash.PRIME for w, c in zip(words[i:], factors)) % minhash.PRIME
        for i in range(3)
    ]
    expected = [min((a * h + b) % minhash.PRIME for h in hashes) for a, b in minhash.permutations(112)]
    assert found[0] == expected


@pytest.mark.parametrize("hot", [False, True])
def test_minhash_dedup(spark, request, hot):
    if hot:
        request.getfixturevalue("small_hot")
    rng = random.Random(2)
    vocabulary = [f"word{i}" for i in range(500)]
    base = [rng.choices(vocabulary, k=120) for _ in range(6)]
    texts = [" ".join(b) for b in base]
    texts += [" ".join(base[0])] * 30  # a hot group of copies
    near = list(base[1])
    near[60] = "changed"
    texts.append(" ".join(near))
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    once = dedup.minhash_dedup(df)
    assert sorted(r.id for r in once.collect()) == [0, 1, 2, 3, 4, 5]
    assert dedup.minhash_dedup(once).count() == 6
    sizes = dedup.dedup_cluster_sizes(dedup.text_clusters(df)).collect()
    assert {(r.cluster_size, r.clusters) for r in sizes} == {(31, 1), (2, 1)}


@pytest.mark.parametrize("last", [("w11739", "w98582"), ("w28254", "w130106")])
def test_texts_with_colliding_hashes_stay(spark, last):
    """One shingle each, whose 31-bit hashes are equal; of the second pair, a word's 32 bits are."""
    texts = [f"one two three four {word}" for word in (*last, last[0])]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    signed = dedup.minhash_signature(df).collect()
    assert signed[0].sig == signed[1].sig == signed[2].sig
    assert sorted(r.id for r in dedup.minhash_dedup(df).collect()) == [0, 1]


def test_result_does_not_depend_on_partitions(spark):
    words = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(words[i % 7 : i % 7 + 20])) for i in range(60)]
    df = spark.createDataFrame(rows, "id bigint, text string")
    few = {tuple(r) for r in dedup.text_clusters(df.repartition(1)).collect()}
    many = {tuple(r) for r in dedup.text_clusters(df.repartition(13, F.col("id"))).collect()}
    assert few == many
