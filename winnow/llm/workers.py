"""Python functions that leave little memory behind in the workers that ran them."""

from __future__ import annotations

import ctypes
import functools

import pyarrow as pa

from pyspark.sql import DataFrame

from winnow.session import scratch_path, shuffles_dropped


def give_back() -> None:
    """Return freed memory to the system.

    Spark keeps idle workers for their next task; several of them beside the running ones would
    otherwise hold the largest amount that each has ever used.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(run):
    """A function over batches that gives memory back at its end."""

    @functools.wraps(run)
    def batches(source):
        try:
            yield from run(source)
        finally:
            give_back()

    return batches


def lean_group(run):
    """A function of a group that gives memory back after it."""

    def group(rows):
        try:
            return run(rows)
        finally:
            give_back()

    return group


def write_kinds(rows: DataFrame, label: str) -> str:
    """Write packed rows, a folder for each kind; the folder of all.

    The few kinds are open at once, with small row groups, so that a task need not sort its
    large rows by kind or hold many of them.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, label)
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, "16")
    try:
        with shuffles_dropped(spark):
            rows.write.option("parquet.block.size", 8 << 20).partitionBy("kind").parquet(path)
    finally:
        spark.conf.set(key, before)
    return path
