"""From raw documents to packed training sequences, each stage written before the next reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from winnow.llm import ngram_join, quality, substring_dedup
from winnow.llm.queries import packed, taught
from winnow.session import discard, materialize, read_back, scratch_path, shuffles_dropped
from winnow.sources.tables import read_table


#: What the last stage wrote for itself. The next stage reads that one's written result.
_rows_of_last: list[str] = []


def until_next(rows: DataFrame, label: str) -> DataFrame:
    """`rows` as a written table that the next stage discards."""
    spark = rows.sparkSession
    path = scratch_path(spark, label)
    with shuffles_dropped(spark):
        rows.write.parquet(path)
    _rows_of_last.append(path)
    return read_back(spark, path, rows.schema)


def discard_last(spark: SparkSession, but: int = 0) -> None:
    """Discard what an earlier stage wrote for itself, once its result has been read; `but` the latest."""
    while len(_rows_of_last) > but:
        discard(spark, _rows_of_last.pop(0))


def keyed(docs: DataFrame, label: str) -> DataFrame:
    """`docs` written with a key `_key` of each row, in the order of the ids; those without one last.

    The rows that an earlier stage wrote for itself are discarded then: its result is a table.
    """
    order = docs.orderBy(F.col("doc_id").asc_nulls_last(), F.xxhash64("text"))
    order = order.withColumn("_key", F.monotonically_increasing_id())
    rows = until_next(order, label)
    discard_last(docs.sparkSession, but=1)
    return rows


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects, also those without an id."""
    rows = keyed(docs, "judged-rows")
    known = taught(read_table(spark, sf_dir, "labels")).withColumnRenamed("doc_id", "_id")
    known = rows.join(known, F.col("doc_id") == F.col("_id")).select(F.col("_key").alias("doc_id"), "label")
    scores = quality.classify(rows.select(F.col("_key").alias("doc_id"), "text"), known)
    rejected = scores.where("score < 0.5").select(F.col("doc_id").alias("_key"))
    return rows.join(rejected, "_key", "left_anti").select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the row of the smallest id of every group of rows linked by word shingles.

    Near-duplicate stages take five words and a similarity of 0.8.
    """
    rows = keyed(docs, "linked-rows")
    groups = ngram_join.join(rows, size=5, percent=80, id="_key")
    copies = groups.where("doc_id != component_id").select(F.col("doc_id").alias("_key"))
    kept = rows.join(copies, "_key", "left_anti")
    return kept.dropDuplicates(["doc_id", "text"]).select(*docs.columns)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take out words of passages of 20 words that start earlier too; drop what is left empty.

    Texts without such a passage stay as they are. The others are written first, so that the
    shuffles which find them are gone when whole texts are joined again.
    """
    rows = keyed(docs, "passage-rows")
    cut = substring_dedup.remove_repeats(rows, id="_key").where("n_removed > 0")
    cut = cut.select(F.col("doc_id").alias("_key"), F.col("kept").alias("_kept"))
    joined = rows.join(until_next(cut, "cut-texts"), "_key", "left")
    text = F.coalesce("_kept", "text")
    return (
        joined.withColumn("n_chars", F.when(F.col("_kept").isNull(), F.col("n_chars")).otherwise(
            F.length(text).cast(docs.schema["n_chars"].dataType)
        ))
        .withColumn("text", text)
        .where(F.col("_kept").isNull() | (F.col("_kept") != ""))
        .select(*docs.columns)
    )


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every kept document in windows of 1024 tokens: the ids of each piece beside its place."""
    return packed(docs, keep_ids=True, after_read=lambda: discard_last(spark))


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", one_of_each),
    ("substring dedup", cut_passages),
    ("packing", pack_sequences),
]

#: The stages train, tokenise and iterate, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
