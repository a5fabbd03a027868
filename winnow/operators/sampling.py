"""Random samples that do not depend on partitioning: rows with the smallest seeded hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from winnow.functions.limits import SAMPLE_ROWS

HASH_BITS = 60
BUCKET_BITS = 20


def sample_key(id: Column, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), id.cast("string")))


def _small_hash(id: Column, seed: int) -> Column:
    return F.conv(F.substring(sample_key(id, seed), 1, HASH_BITS // 4), 16, 10).cast("long")


def smallest_hashes(df: DataFrame, k: int, seed: int, id: str) -> DataFrame:
    """Exactly the k rows with the smallest seeded hash of their id, for any k.

    Counts per hash bucket find the bucket in which the k-th hash lies, a sort of that bucket
    alone finds the hash, and one filter takes the rows. Of rows that share the last id as many
    are taken as are still missing.
    """
    hashed = df.select(id, _small_hash(F.col(id), seed).alias("_h")).withColumn(
        "_bucket", F.shiftright("_h", HASH_BITS - BUCKET_BITS)
    )
    # At most 2 ** BUCKET_BITS rows whatever the size of the data.
    sizes = hashed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    running = F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_bucket"))
    edge = (
        sizes.withColumn("_end", running)
        .where(F.col("_end") >= k)
        .orderBy("_bucket")
        .select("_bucket", (F.col("_end") - F.col("_n")).alias("_before"))
        .first()
    )
    if k <= 0:
        return df.limit(0)
    if edge is None:
        return df
    last = (
        hashed.where(F.col("_bucket") == edge["_bucket"])
        .orderBy("_h", id)
        .limit(k - edge["_before"])
        .agg(F.max(F.struct("_h", id)).alias("m"))
        .first()["m"]
    )
    h, own = _small_hash(F.col(id), seed), F.col(id)

    # Rows without an id are one hash; like a sort, they come before others of that hash.
    def split(hash: Column) -> tuple[Column, Column]:
        same = (hash == last["_h"]) & own.eqNullSafe(F.lit(last[id]))
        if last[id] is None:
            return hash < last["_h"], same
        smaller = own.isNull() | (own < F.lit(last[id]))
        return (hash < last["_h"]) | ((hash == last["_h"]) & smaller), same

    before, same = split(h)
    first, tied = hashed.where(F.col("_bucket") == edge["_bucket"]).select(
        *(F.count_if(c) for c in split(F.col("_h")))
    ).first()
    missing = k - edge["_before"] - first
    if missing == tied:
        return df.where(before | same)
    return df.where(before).unionByName(df.where(same).limit(missing))


def sample_rows(
    df: DataFrame,
    n: int = SAMPLE_ROWS,
    seed: int = 0,
    id: str = "id",
    by: str | None = None,
    strict: bool = False,
) -> DataFrame:
    """n random rows without replacement, of the whole frame or of every group in `by`.

    Ids alone are looked at to find the sample, then one filter takes its rows, so nothing but
    ids is moved whatever n. A frame with fewer rows is returned whole unless `strict`.
    """
    key = sample_key(F.col(id), seed)
    if by is not None:
        best = Window.partitionBy(by).orderBy(key, id)
        return df.withColumn("_k", F.row_number().over(best)).where(F.col("_k") <= n).drop("_k")
    if strict and df.select(id).limit(n).count() < n:
        raise ValueError(f"sample of {n} rows is larger than the data")
    return smallest_hashes(df, n, seed, id)
