"""Exact substring deduplication with a logarithmic family of suffix indexes.

Every batch of texts gets a suffix index: one suffix per anchor (see `repeats`), sorted. The sort
is by the hash of what the suffix starts with instead of its bytes: equal beginnings of a window
are neighbours in either order, which is all that a search for matches of a fixed least length
needs, and a record stays 30 bytes. A batch's index is merge-scanned against the existing levels;
as in a binary counter, levels of equal size merge, so an anchor is rewritten a logarithmic number
of times. A level keeps one of equal stretches of text.

The order of the batches does not matter: "earlier" is decided by (doc_id, start).

Nulls are empty texts. Rows without an id come after all others. Rows that share an id are one
document at the same place: repeated rows get equal results, and of an id with several texts each
row loses what is repeated at that place in any of them. Columns other than the id and the text
are ignored.
"""

from __future__ import annotations

import numpy as np
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
from winnow.session import discard, materialize, read_back

LEAST = 100  # bytes of a match
BATCHES = 4
TASKS = 2000  # that a scan of the index is cut into at most, or as many as the session asks for


class SuffixIndex:
    """Levels of sorted anchors; `add` scans a batch against them and takes it up."""

    def __init__(self, spark, shape: Shape):
        self.spark, self.shape = spark, shape
        self.levels: dict[int, str] = {}
        self.found: list[str] = []

    def _read(self, path: str, kind: str) -> DataFrame:
        rows = read_back(self.spark, path, PACKED)
        return rows.where(F.col("kind") == kind)

    def add(self, docs: DataFrame, keep: bool = True) -> None:
        """Search `docs` (from `plain`) against the index and itself; `keep` indexes it."""
        merged = 0
        while merged in self.levels:
            merged += 1
        rows = anchor_rows(docs, self.shape)
        for level in self.levels:
            rows = rows.unionByName(self._read(self.levels[level], "level"))
        shape = self.shape
        act = resolve(shape, merged, merged if keep else -1)

        def run(group):
            if group["_local"].iloc[0]:  # what a flush knows is keyed by document already
                return group[["kind", "bucket", "level", "data"]]
            return act(group)

        # Tasks of a few buckets each: one that holds many keeps all their records in memory to
        # sort them by bucket.
        tasks = min(shape.buckets, max(TASKS, int(self.spark.conf.get("spark.sql.shuffle.partitions"))))
        placed = rows.withColumn("_local", F.col("kind").isin("run", "edge")).repartition(
            tasks, "_local", "bucket"
        )
        scanned = placed.groupBy("_local", "bucket")
        path = write_kinds(scanned.applyInPandas(lean_group(run), PACKED), "suffixes")
        if keep:
            for level in range(merged):
                discard(self.spark, f"{self.levels.pop(level)}/kind=level")
            self.levels[merged] = path
        self.found.append(path)

    def runs(self, docs: DataFrame) -> DataFrame:
        """Packed runs of repeated windows of `docs`, all documents that were added."""

        def all_of(kind: str) -> DataFrame:
            out = self._read(self.found[0], kind)
            for path in self.found[1:]:
                out = out.unionByName(self._read(path, kind))
            return out

        windows = edge_windows(docs, all_of("edge"), self.shape)
        return all_of("run").unionByName(materialize(windows, "edge-windows"))

    def close(self) -> None:
        """Remove the levels; what was found stays."""
        for path in self.levels.values():
            discard(self.spark, f"{path}/kind=level")
        self.levels.clear()


def cut(docs: DataFrame) -> DataFrame:
    """Texts without their spans: (doc_id, n_bytes, n_removed, spans, kept)."""
    schema = (
        "doc_id long, n_bytes long, n_removed long, "
        "spans array<struct<start: bigint, end: bigint>>, kept binary"
    )

    def run(batches):
        for batch in batches:
            rows = [[], [], [], []]
            found = batch.column("_found").to_pylist()
            for text, spans_ in zip(batch.column("text").to_pylist(), found, strict=True):
                at, kept, gone = 0, [], []
                for start, end in np.frombuffer(spans_ or b"", SPAN).tolist():
                    start, end = min(start, len(text)), min(end, len(text))
                    if start < end:
                        kept.append(text[at:start])
                        gone.append({"start": start, "end": end})
                        at = end
                kept = b"".join([*kept, text[at:]]) if gone else text
                for column, value in zip(
                    rows, (len(text), len(text) - len(kept), gone, kept), strict=True
                ):
                    column.append(value)
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(rows[0], pa.int64()),
                    pa.array(rows[1], pa.int64()),
                    pa.array(rows[2], kind),
                    pa.array(rows[3], pa.binary()),
                ],
                ["doc_id", "n_bytes", "n_removed", "spans", "kept"],
            )

    return docs.select("doc_id", "text", "_found").mapInArrow(lean(run), schema)


def remove_repeats(
    docs: DataFrame,
    least: int = LEAST,
    batches: int = BATCHES,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept) of every row.

    A byte goes if a string of `least` bytes over it starts earlier too. `docs` is added to the
    index in `batches` ranges of ids.
    """
    spark = docs.sparkSession
    docs = plain(docs, id, text)
    index = SuffixIndex(spark, Shape("bytes", least, max(1, least * 2 // 5), buckets_for(docs)))
    shares = [i / batches for i in range(1, batches)]
    # An approximate split is as good: every row falls into one range.
    marks = docs.agg(F.percentile_approx("_doc", F.array(*map(F.lit, shares)))).first()[0] or []
    low = None
    for no, high in enumerate([*marks, None]):
        part = docs
        if low is not None:
            part = part.where(F.col("_doc") > low)
        if high is not None:
            part = part.where(F.col("_doc") <= high)
        index.add(part, keep=no < len(marks))
        low = high
    index.close()
    return cut(with_spans(docs, spans(index.runs(docs), index.shape)))


