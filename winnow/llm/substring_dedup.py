"""Repeated word passages by level-wise doubling of windows.

First, windows of half the length are compared, at places chosen by their content such that every
whole window has one (see `repeats`). Where such a window is repeated, and only there, it is
extended to the whole length: all windows around it at once while their stretch of text is
repeated as a whole, one by one at the edges. Where no window of a
level is repeated, nothing is left to extend.

Nulls have no words. Ids, repeated rows and further columns are treated as in `suffix_dedup`.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from winnow.llm.repeats import (
    PACKED,
    SPAN,
    Shape,
    anchor_rows,
    buckets_for,
    edge_windows,
    plain,
    resolve,
    spans,
    with_spans,
)
from winnow.llm.workers import lean, lean_group, write_kinds
from winnow.session import read_back

WORDS = 20


def repeated_runs(docs: DataFrame, shape: Shape) -> DataFrame:
    """Packed runs of windows of `docs` (from `plain`) that start earlier too."""
    spark = docs.sparkSession
    act = resolve(shape, 0, -1)

    def extend(group: pd.DataFrame) -> pd.DataFrame:
        if group["_local"].iloc[0]:  # what a flush knows is keyed by document already
            return group[["kind", "bucket", "level", "data"]]
        return act(group)

    half = anchor_rows(docs, shape).withColumn("_local", F.col("kind").isin("run", "edge"))
    grouped = half.groupBy("_local", "bucket").applyInPandas(lean_group(extend), PACKED)
    path = write_kinds(grouped, "windows")
    found = read_back(spark, path, PACKED)
    edges = edge_windows(docs, found.where("kind = 'edge'"), shape)
    return found.where("kind = 'run'").unionByName(edges)


def cut(docs: DataFrame) -> DataFrame:
    """Texts without the words of their spans: (doc_id, n_words, n_removed, spans, kept).

    `kept` has the words that are left, one space between two.
    """
    schema = (
        "doc_id long, n_words long, n_removed long, "
        "spans array<struct<start: bigint, end: bigint>>, kept string"
    )

    def run(batches):
        for batch in batches:
            rows = [[], [], [], []]
            found = batch.column("_found").to_pylist()
            for text, spans_ in zip(batch.column("text").to_pylist(), found, strict=True):
                words = text.split()  # of bytes: ASCII white space
                at, kept, gone = 0, [], []
                for start, end in np.frombuffer(spans_ or b"", SPAN).tolist():
                    start, end = min(start, len(words)), min(end, len(words))
                    if start < end:
                        kept += words[at:start]
                        gone.append({"start": start, "end": end})
                        at = end
                kept += words[at:]
                for column, value in zip(
                    rows, (len(words), len(words) - len(kept), gone, b" ".join(kept)), strict=True
                ):
                    column.append(value)
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(rows[0], pa.int64()),
                    pa.array(rows[1], pa.int64()),
                    pa.array(rows[2], kind),
                    pa.array(rows[3], pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "n_removed", "spans", "kept"],
            )

    return docs.select("doc_id", "text", "_found").mapInArrow(lean(run), schema)


def word_spans(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """`docs` (from `plain`) with the packed spans of repeated windows of `words` words."""
    shape = Shape("words", words, max(1, words // 2), buckets_for(docs))
    return with_spans(docs, spans(repeated_runs(docs, shape), shape))


def remove_repeats(
    docs: DataFrame, words: int = WORDS, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept): without words of windows that start earlier too."""
    return cut(word_spans(plain(docs, id, text), words))

