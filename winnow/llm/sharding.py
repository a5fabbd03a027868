"""Placing rows on shards through a permutation-filled lookup table.

Every shard prefers the slots of a prime-sized table in an order of its own, taken from two hashes
of its name; the shards take turns and claim the next free slot they prefer. So each shard gets
within one of the same number of slots, and a shard that comes or goes moves few others. A row
goes to the shard of the slot its key hashes to: one broadcast lookup, no shuffle, and a key with
a third of all rows is no different from others.

The table has `size` rows whatever the data, so its broadcast is bounded by that parameter. It is
filled turn by turn in the driver, once, from the hashes that Spark computes. Null keys count as
the empty string. Repeated rows go where their key goes. An empty table gives no rows; columns
`slot` and `shard` of the input are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SHARDS = 64
SIZE = 8191  # prime, over a hundred slots per shard: loads differ by less than one in a hundred


def hashed(key: Column, salt: str = "") -> Column:
    """60 bits of a key's MD5 as a long; other engines can compute the same."""
    text = F.concat(F.lit(salt), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def preferences(spark: SparkSession, names: list[str], size: int) -> list[tuple[str, int, int]]:
    """(name, offset, skip) of each shard: it prefers the slots offset + i * skip."""
    frame = spark.createDataFrame([(n,) for n in names], "shard string")
    rows = frame.select(
        "shard",
        (hashed(F.col("shard"), "offset:") % size).alias("offset"),
        (hashed(F.col("shard"), "skip:") % (size - 1) + 1).alias("skip"),
    )
    return sorted((r["shard"], r["offset"], r["skip"]) for r in rows.collect())


def fill(shards: list[tuple[str, int, int]], size: int) -> list[str]:
    """The shard of each slot."""
    table: list[str | None] = [None] * size
    place = [offset for _, offset, _ in shards]
    claimed = 0
    while claimed < size:
        for i, (name, _, skip) in enumerate(shards):
            while table[place[i]] is not None:
                place[i] = (place[i] + skip) % size
            table[place[i]] = name
            claimed += 1
            if claimed == size:
                break
    return table


def lookup_table(spark: SparkSession, names: list[str], size: int = SIZE) -> DataFrame:
    """(slot, shard), one row per slot."""
    if not names or len(set(names)) < len(names):
        raise ValueError("shards need distinct names")
    if size < 100 * len(names) or any(size % d == 0 for d in range(2, int(size**0.5) + 1)):
        raise ValueError("the table size must be prime and 100 times the shards or more")
    table = fill(preferences(spark, names, size), size)
    return spark.createDataFrame(list(enumerate(table)), "slot long, shard string")


def place(df: DataFrame, key: str, table: DataFrame, size: int = SIZE) -> DataFrame:
    """`df` with `slot` and `shard`."""
    keyed = df.drop("slot", "shard").withColumn("slot", hashed(F.col(key)) % size)
    return keyed.join(F.broadcast(table), "slot")
