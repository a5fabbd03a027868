"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_owned: ContextVar[list[str] | None] = ContextVar("owned", default=None)


def build_session(app: str = "winnow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for; `conf` overrides."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, as the cluster names it.

    Only a local session without the setting gets a temporary folder of its own:
    on a cluster a machine-local folder would be lost with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="winnow-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the scratch folder."""
    return f"{scratch_root(spark)}/winnow/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to shared storage and read it back.

    Cuts the lineage so that a lost executor re-reads a file instead of replaying the
    job, fixes values that depend on physical placement, and gives Catalyst real sizes
    to choose join strategies from.
    """
    path = scratch_path(df.sparkSession, label)
    if (owned := _owned.get()) is not None:
        owned.append(path)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_back(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A written table that may have no rows, hence no files to take a schema from."""
    return spark.read.schema(schema).parquet(path)


def small_batches(spark: SparkSession, size: str = "4m", rows: int = 2000) -> None:
    """Exchange long texts with Python in batches of a few megabytes.

    A batch exists several times at once, outside the heap and in Python, for each running task;
    Spark's default of 64 MB would need gigabytes beside the heap. The Parquet reader likewise
    fills a batch of rows before it hands on the first.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", "256")


@contextmanager
def written(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """`df` as a written table that is discarded at the end."""
    path = scratch_path(df.sparkSession, label)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    try:
        yield read_back(df.sparkSession, path, df.schema)
    finally:
        discard(df.sparkSession, path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table that nothing will read again."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch_owned(spark: SparkSession) -> Iterator[None]:
    """Discard at the end every table that `materialize` wrote within.

    For jobs whose result is written elsewhere: no frame made within may be used afterwards.
    """
    paths: list[str] = []
    token = _owned.set(paths)
    try:
        yield
    finally:
        _owned.reset(token)
        for path in paths:
            discard(spark, path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Let Spark remove the shuffle files of a write as soon as it has ended.

    They would otherwise stay until the driver happens to collect its garbage, so a chain of
    written tables would hold the shuffles of all its steps at once.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
