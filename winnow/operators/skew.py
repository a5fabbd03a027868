"""Joins and orderings that hold when one key owns a large part of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from winnow.session import materialize

# At most HOT_KEYS keys can own one HOT_KEYS-th of all rows each, so the table of those keys
# has a size bound that does not grow with the data and may be broadcast.
HOT_KEYS = 10_000
HOT_ROWS = 100_000

# A table of one narrow row per key is broadcast up to this many rows, counted first.
BROADCAST_ROWS = 500_000


def hot_keys(totals: DataFrame, rows: str = "_n") -> DataFrame:
    """Rows of `totals` (one per key, with the key's row count) whose key is hot."""
    floor = totals.agg(
        F.greatest(F.sum(rows) / F.lit(float(HOT_KEYS)), F.lit(float(HOT_ROWS)))
    ).scalar()
    return totals.where(F.col(rows).cast("double") >= floor)


def join_totals(
    df: DataFrame,
    totals: DataFrame,
    on: list[str],
    rows: str = "_n",
    how: str = "inner",
    at_most: int | None = None,
) -> DataFrame:
    """Attach one row per key to all rows of the key.

    `totals` holds `rows`, the row count per key. It is written down and counted: a small table
    is broadcast. Beyond that size, rows of hot keys meet a bounded broadcast and are never
    shuffled, and the others meet an ordinary join in which no key is large. `at_most` is a
    known bound on the rows of `df`: too few for any hot key, a plain join will do.
    """
    if at_most is not None and at_most < HOT_ROWS:
        return df.join(totals.drop(rows), on, how)
    totals = materialize(totals, "totals")
    if totals.count() <= BROADCAST_ROWS:
        return df.join(F.broadcast(totals.drop(rows)), on, how)
    hot = hot_keys(totals, rows)
    spread_out = df.join(F.broadcast(hot), on, "inner").drop(rows)
    others = df.join(F.broadcast(hot.select(*on)), on, "left_anti")
    shuffled = others.join(totals.drop(rows), on, how)
    return spread_out.unionByName(shuffled)


def with_totals(
    df: DataFrame, on: list[str], at_most: int | None = None, **aggregates: Column
) -> DataFrame:
    """Every row with aggregates over its group; a window would put a group in one task."""
    totals = df.groupBy(*on).agg(
        F.count(F.lit(1)).alias("_n"), *[agg.alias(name) for name, agg in aggregates.items()]
    )
    return join_totals(df, totals, on, at_most=at_most)


def ranked(df: DataFrame, keys: list[str], order: list[Column], value: Column | None = None):
    """Exact position of every row in its group, and the sum of `value` before it.

    Adds `_rank` (1-based) and `_before`. Rows are range-partitioned by group and order, so a
    group spans as many tasks as its size needs; each slice is ranked on its own and the slice
    totals, at most one row per group and task, give the offsets. The placement is written
    down first because both passes must see the same one. The order must be total.
    """
    spark = df.sparkSession
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(
        df.withColumn("_value", F.lit(1) if value is None else value)
        .repartitionByRange(slices, *[F.col(k) for k in keys], *order)
        .withColumn("_slice", F.spark_partition_id()),
        "ranked",
    )
    here = Window.partitionBy("_slice", *keys).orderBy(*order)
    local = placed.withColumn("_local", F.row_number().over(here)).withColumn(
        "_sum", F.sum("_value").over(here.rowsBetween(Window.unboundedPreceding, -1))
    )
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # The carried frame holds one row per group and slice. A slice mixes many small groups but
    # a group reaches into a further slice only when it fills one, so `_carry` > 0 is rare.
    carried = (
        placed.groupBy("_slice", *keys)
        .agg(F.count(F.lit(1)).alias("_rows"), F.sum("_value").alias("_total"))
        .withColumn("_carry", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .withColumn("_carry_sum", F.coalesce(F.sum("_total").over(earlier), F.lit(0)))
        .where("_carry > 0")
        .select("_slice", *keys, "_carry", "_carry_sum")
    )
    # Fewer than one continued group per slice: bounded by the number of tasks.
    joined = local.join(F.broadcast(carried), ["_slice", *keys], "left")
    zero = F.lit(0)
    return joined.select(
        *df.columns,
        (F.col("_local") + F.coalesce("_carry", zero)).alias("_rank"),
        (F.coalesce("_sum", zero) + F.coalesce("_carry_sum", zero)).alias("_before"),
    )


def lookup(df: DataFrame, table: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join rows to a table with one row per key, whatever share of the rows a key has."""
    table = materialize(table, "lookup")
    if table.count() <= BROADCAST_ROWS:
        return df.join(F.broadcast(table), on, how)
    counts = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    return join_totals(df, table.join(counts, on), on, how=how)
