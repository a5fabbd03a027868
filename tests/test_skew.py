import random

import pytest
from pyspark.sql import functions as F

from winnow.operators import skew


@pytest.fixture
def rows(spark):
    rng = random.Random(3)
    data = [(i, "hot" if i % 3 == 0 else f"k{rng.randrange(40)}", rng.randrange(100)) for i in range(600)]
    return spark.createDataFrame(data, "id bigint, key string, v bigint").repartition(7)


def test_with_totals(spark, rows, small_hot):
    found = skew.with_totals(rows, ["key"], total=F.sum("v"))
    expected = rows.join(rows.groupBy("key").agg(F.sum("v").alias("total")), "key")
    columns = ["id", "key", "v", "total"]
    assert sorted(found.select(columns).collect()) == sorted(expected.select(columns).collect())


def test_lookup_keeps_or_drops_rows_without_match(spark, rows, small_hot):
    table = spark.createDataFrame([("hot", 1), ("k1", 2)], "key string, x int")
    inner = skew.lookup(rows, table, ["key"])
    assert inner.count() == rows.where("key in ('hot', 'k1')").count()
    outer = skew.lookup(rows, table, ["key"], how="left")
    assert outer.count() == rows.count()
    assert outer.where("x is not null").count() == inner.count()


def test_hot_keys_are_bounded(spark, small_hot):
    totals = spark.range(1000).select(F.col("id").alias("key"), F.lit(50).alias("_n"))
    assert skew.hot_keys(totals).count() <= skew.HOT_KEYS


def test_ranked(spark, rows):
    data = sorted((r.key, r.v, r.id) for r in rows.collect())
    expected, place, before = {}, {}, {}
    for key, v, id in data:
        place[key] = place.get(key, 0) + 1
        expected[id] = (place[key], before.get(key, 0))
        before[key] = before.get(key, 0) + v
    found = skew.ranked(rows, ["key"], [F.col("v"), F.col("id")], F.col("v")).collect()
    assert {r.id: (r["_rank"], r["_before"]) for r in found} == expected


def test_ranked_without_groups(spark, rows):
    found = skew.ranked(rows, [], [F.col("id")]).collect()
    assert {r.id: r["_rank"] for r in found} == {i: i + 1 for i in range(600)}
