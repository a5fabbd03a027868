"""Running streaming jobs to the end of their input."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    )
}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Session settings for the duration of a block; a query keeps those it started with."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def run_available(
    stream: DataFrame,
    path: str,
    each_batch: Callable[[DataFrame, int], None] | None = None,
    mode: str = "append",
) -> str:
    """Process everything there is, then stop; progress is kept under <path>/progress.

    Rows go to <path>/rows as Parquet, or to `each_batch`. Run again with the same path, the
    job takes up where it stopped.
    """
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/progress")
    if each_batch is None:
        writer = writer.format("parquet").option("path", f"{path}/rows")
    else:
        writer = writer.foreachBatch(each_batch)
    with settings(stream.sparkSession, STATE_STORE):
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
    return path


def file_stream(
    spark: SparkSession,
    folder: str,
    schema,
    glob: str = "*.parquet",
    bytes_per_batch: int = 256 << 20,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Parquet files as they arrive.

    A batch takes a bounded number of bytes, or of files: the rows of one key in a batch, which
    a stateful step sees together, are bounded with it.
    """
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_batch is None:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    else:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)
