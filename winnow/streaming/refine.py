"""Refining of pages as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from winnow.operators import dedup, language, pii
from winnow.plans.refine import RefineSettings, kept, refine
from winnow.session import materialize, scratch_owned


def spread_batch(batch: DataFrame) -> DataFrame:
    """A batch of few files with a task for each core: what refining costs is not reading."""
    cores = batch.sparkSession.sparkContext.defaultParallelism
    return batch if batch.rdd.getNumPartitions() >= cores else batch.repartition(cores, "id")


def refine_batches(
    profiles: language.Profiles, path: str, settings: RefineSettings = RefineSettings()
) -> Callable[[DataFrame, int], None]:
    """A batch step: refine, count tokens, drop duplicates, mask, publish.

    Texts are compared with each other and, by band keys, with every text of earlier batches,
    also those that were dropped as copies: a copy of a copy is one too, as in a batch job. A
    batch owns its folders, so repeating it after a failure changes nothing.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with scratch_owned(spark):
            batch = spread_batch(batch)
            fresh = pii.token_count(kept(refine(batch, profiles, settings)))
            fresh = materialize(fresh, "refined")
            bands = materialize(dedup.band_keys(dedup.minhash_signature(fresh)), "bands")
            if batch_id == 0:
                seen = spark.createDataFrame([], "band int, key binary")
            else:
                seen = spark.read.schema("band int, key binary, batch bigint").parquet(f"{path}/bands")
                seen = seen.where(F.col("batch") < batch_id).select("band", "key")
            known = bands.join(seen, ["band", "key"], "left_semi").select("id").distinct()
            clusters = dedup.dedup_clusters(dedup.star_edges(bands))
            # A copy of an earlier text takes its whole cluster with it.
            spoiled = clusters.join(known, "id", "left_semi").select("component").distinct()
            again = clusters.join(spoiled, "component", "left_semi").select("id")
            unique = dedup.drop_duplicates(fresh, clusters).join(
                known.unionByName(again).distinct(), "id", "left_anti"
            )
            unique = materialize(unique, "unique")
            bands.select("band", "key").distinct().write.mode("overwrite").parquet(
                f"{path}/bands/batch={batch_id}"
            )
            pii.pii_mask(unique).write.mode("overwrite").parquet(f"{path}/corpus/batch={batch_id}")

    return step
