"""Parquet tables as input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give a scan of few files enough tasks for CPU-heavy text work.

    One file with one row group is one task however many cores there are. A table with at
    least as many files as cores is left alone, so large inputs are never shuffled for this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if len(df.inputFiles()) >= cores:
        return df
    return df.repartition(cores, *keys)
