"""JSON Lines in and out, removed documents, published datasets, score reports."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

DOCUMENT_SCHEMA = (
    "id string, text string, url string, language string, language_score double, "
    "token_count bigint, metadata map<string,string>"
)


def read_jsonl(spark: SparkSession, path: str, schema: str = DOCUMENT_SCHEMA) -> DataFrame:
    """All .jsonl.gz (or plain) files of a folder; the schema is given, never inferred."""
    return spark.read.schema(schema).json(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Gzip JSON Lines, one file per task."""
    df.write.mode(mode).option("compression", "gzip").json(path)


def write_removed(refined: DataFrame, path: str) -> None:
    """Dropped documents as gzip JSON Lines, one folder per stage.

    Documents in another language go to a folder per language. Both writes only read the rows
    they keep; give a materialized frame.
    """
    foreign = F.col("drop_stage") == "2_non_english"
    dropped = refined.where("drop_stage is not null")
    dropped.where(~foreign).write.partitionBy("drop_stage").option("compression", "gzip").json(
        f"{path}/removed"
    )
    dropped.where(foreign).write.partitionBy("language").option("compression", "gzip").json(
        f"{path}/2_non_english"
    )


def publish_dataset(shards: list[DataFrame], folder: str, name: str, at: datetime) -> str:
    """Merge the shards in one `train` split under <folder>/<name>_<yyyy_MM_dd_HH>."""
    merged = shards[0]
    for shard in shards[1:]:
        merged = merged.unionByName(shard, allowMissingColumns=True)
    path = f"{folder}/{name}_{at:%Y_%m_%d_%H}"
    merged.withColumn("split", F.lit("train")).write.partitionBy("split").parquet(path)
    return path


def report_scores(scored: DataFrame, path: str, batch_id: int) -> None:
    """Add (task_id, score) report rows and (uid, score) log rows of one batch.

    Each batch owns its folder, so a repeated batch replaces itself instead of adding rows twice.
    """
    reports = scored.select("task_id", "score")
    log = scored.select("uid", "score", F.lit(batch_id).cast("long").alias("step"))
    reports.write.mode("overwrite").parquet(f"{path}/reports/batch={batch_id}")
    log.write.mode("overwrite").parquet(f"{path}/log/batch={batch_id}")
