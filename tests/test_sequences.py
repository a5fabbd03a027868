from collections import Counter

import pytest
from pyspark.sql import functions as F

from winnow.operators import sampling, sequences


@pytest.mark.parametrize("length", [4, 7])
def test_pack_sequences(spark, length):
    texts = ["a b c", "", "d", " ".join(f"t{i}" for i in range(23)), "x, y! z"]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string").repartition(3)
    stream = ["a", "b", "c", "d", *[f"t{i}" for i in range(23)], "x", ",", "y", "!", "z"]
    expected = [stream[i : i + length] for i in range(0, len(stream) - length + 1, length)]
    found = sequences.pack_sequences(df, length).orderBy("block").collect()
    assert [r.block for r in found] == list(range(len(expected)))
    assert [r.tokens for r in found] == expected


def test_token_budget(spark):
    blocks = lambda n: spark.createDataFrame([(n,)], "blocks long")
    row = sequences.token_budget(blocks(79)).first()
    assert tuple(row) == (163_840, 79 * 2048, False, 9)
    assert sequences.token_budget(blocks(80)).first().enough


def test_block_count_is_what_packing_makes(spark):
    texts = ["a b c, d", None, "e " * 37, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    for length in (1, 4, 7, 100):
        blocks = sequences.block_count(df, length).first().blocks
        assert blocks == sequences.pack_sequences(df, length).count()
    plan = sequences.batch_plan(sequences.block_count(df, 2))._jdf.queryExecution().toString()
    assert "text" not in plan


def test_batch_plan_and_stages(spark):
    plan = sequences.batch_plan(spark.createDataFrame([(17,)], "blocks long"))
    rows = plan.orderBy("block").collect()
    assert [r.step for r in rows] == [0] * 8 + [1] * 8
    assert [(r.micro_batch, r.slot) for r in rows[:8]] == [(i // 2, i % 2) for i in range(8)]
    wide = sequences.batch_plan(spark.createDataFrame([(112,)], "blocks long"))
    stages = {r.stage: r for r in sequences.data_stages(wide, steps=12, done=4).collect()}
    stable, annealing = stages["Stable Training Stage"], stages["Annealing Phase"]
    assert (stable.first_step, stable.last_step, stable.planned) == (1, 9, 72)
    assert (stable.consumed, stable.remaining_steps) == (32, 5)
    assert (annealing.first_step, annealing.last_step, annealing.remaining_steps) == (10, 12, 3)
    usual = {r.stage: r for r in sequences.data_stages(wide).collect()}
    assert usual["Annealing Phase"].planned == 8  # the last of 10 steps has its stage


def test_smallest_hashes(spark):
    df = spark.range(1000)
    h = sampling._small_hash(F.col("id"), 3)
    order = [r.id for r in df.orderBy(h, "id").collect()]
    for k in (0, 1, 17, 999, 1000):
        assert {r.id for r in sampling.smallest_hashes(df, k, 3, "id").collect()} == set(order[:k])


def test_samples_of_repeated_ids(spark):
    df = spark.range(4).crossJoin(spark.range(3).withColumnRenamed("id", "k"))
    for n in range(13):
        found = sampling.sample_rows(df, n, 9).collect()
        assert len(found) == n
        # Whole ids before the last one.
        assert sum(c % 3 != 0 for c in Counter(r.id for r in found).values()) <= 1


def test_a_sample_is_the_first_of_the_order(spark):
    df = spark.range(500)
    order = [r.id for r in df.orderBy(sampling.sample_key(F.col("id"), 9), "id").collect()]
    for n in (1, 40, 499, 600):
        assert {r.id for r in sampling.sample_rows(df, n, 9).collect()} == set(order[:n])


def test_weighted_mix(spark):
    sources = {"big": spark.range(100), "small": spark.range(10)}
    mixed = sequences.weighted_mix(sources, {"big": 1.0, "small": 1.0}, 61, seed=1)
    counts = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert counts == {"big": 30, "small": 31}
    small = mixed.where("source = 'small'").groupBy("id").count().collect()
    assert sorted(r["count"] for r in small) == [3] * 9 + [4]


def test_pack_sequences_with_repeated_and_missing_ids(spark):
    """Every token lies in one place: rows that share an id, a text or have no id follow each other."""
    texts = [(1, "a b c d"), (1, "e f g h"), (2, "i j k l"), (2, "i j k l"), (None, "m n"), (None, "m n o p"),
             (None, None), (3, ""), (3, None), (4, "q r s t u v w x y z")]
    df = spark.createDataFrame(texts, "id long, text string").repartition(3)
    for length in (1, 3, 4, 7):
        blocks = sequences.pack_sequences(df, length).orderBy("block").collect()
        assert [r.block for r in blocks] == list(range(sequences.block_count(df, length).first().blocks))
        laid = " ".join(t for r in blocks for t in r.tokens)
        whole = " ".join(t for r in sequences.pack_sequences(df, 1).orderBy("block").collect() for t in r.tokens)
        assert whole.startswith(laid) and sorted(whole.split()) == sorted(w for _, t in texts for w in (t or "").split())
    assert whole.endswith("i j k l i j k l q r s t u v w x y z") and {"m n m n o p", "m n o p m n"} & {whole[:11]}


@pytest.mark.parametrize("n", [0, 1, 49, 50, 51, 80, 99, 100, 150])
def test_samples_have_n_rows_with_missing_and_repeated_ids(spark, n):
    df = spark.range(50).unionByName(spark.range(30)).unionByName(
        spark.range(20).select(F.lit(None).cast("long").alias("id"))
    )
    found = sampling.smallest_hashes(df, n, 5, "id")
    assert found.count() == min(n, 100)
