"""Best-fit decreasing packing of tokenised texts into windows of fixed length.

A text longer than a window is first cut into full windows. What is left of each text is smaller
than a window, so the remainders have fewer than `window` distinct sizes, and best-fit decreasing
needs no more than their number per size: runs of equal remainders go to runs of equally filled
windows. That plan has a few rows per size whatever the number of texts; ranks within a size,
computed by Spark, place every text by it.

Null texts count as empty and are one closing id. Repeated rows are packed once each. Columns
other than the id and the text are ignored. An empty table gives no pieces.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from winnow.llm.bpe import Encoder
from winnow.llm.workers import lean
from winnow.operators.skew import ranked
from winnow.session import small_batches, written

WINDOW = 1024


class CapacityTree:
    """A segment tree over remaining capacities: the tightest one that is open and fits."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.open = [False] * (2 * self.leaves)

    def set(self, capacity: int, value: bool) -> None:
        node = self.leaves + capacity
        self.open[node] = value
        while node > 1:
            node //= 2
            self.open[node] = self.open[2 * node] or self.open[2 * node + 1]

    def tightest(self, size: int) -> int | None:
        """The smallest open capacity of at least `size`."""
        node = self.leaves + size
        while not self.open[node]:
            while node % 2:  # a right child: nothing larger below its parent
                if node == 1:
                    return None
                node //= 2
            if node == 0:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node if self.open[2 * node] else 2 * node + 1
        return node - self.leaves


def best_fit(sizes: dict[int, int], window: int = WINDOW) -> tuple[list[tuple], int]:
    """Place `sizes` {size: count}, largest first; (placements, windows used).

    A placement (size, first, last, k, sequence, offset) puts the items of the size with ranks
    first..last (from 0), k by k, into the windows from `sequence` on, where `offset` is taken.
    The tightest window stays the tightest for the next item of the size, so k is what fits.
    """
    tree = CapacityTree(window)
    runs: dict[int, list[tuple[int, int]]] = {}
    placements, used = [], 0

    def put(capacity: int, first: int, count: int) -> None:
        if count and capacity:
            runs.setdefault(capacity, []).append((first, count))
            tree.set(capacity, True)

    for size in sorted((s for s, n in sizes.items() if n), reverse=True):
        placed, left = 0, sizes[size]
        while left:
            capacity = tree.tightest(size)
            if capacity is None:
                capacity, first = window, used
                count = -(-left // (window // size))
                used += count
            else:
                first, count = runs[capacity].pop()
                if not runs[capacity]:
                    tree.set(capacity, False)
            k = capacity // size
            taken = min(left, k * count)
            placements.append((size, placed, placed + taken - 1, k, first, window - capacity))
            full, rest = divmod(taken, k)
            put(capacity - k * size, first, full)
            if rest:
                put(capacity - rest * size, first + full, 1)
            put(capacity, first + full + bool(rest), count - full - bool(rest))
            placed, left = placed + taken, left - taken
    return placements, used


def tokenised(
    docs: DataFrame,
    ranks_path: str,
    vocabulary_path: str,
    pattern: str,
    closing: int = 0,
    window: int = WINDOW,
    keep_ids: bool = False,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, doc_tokens, pieces): each text's ids and the closing id, cut into windows.

    A piece has the checksum of its ids (little-endian unsigned 32-bit) and, with `keep_ids`,
    the ids. Added tokens of the vocabulary are recognised in a text, as its tokenizer does.
    """
    schema = "doc_id long, doc_tokens long, pieces array<struct<crc32: bigint, ids: binary>>"

    def run(batches):
        import regex

        encoder = split = None
        for batch in batches:
            if encoder is None:
                encoder = Encoder(ranks_path, pattern)
                with open(vocabulary_path, encoding="utf-8") as file:
                    added = {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}
                longest = sorted(map(regex.escape, added), key=len, reverse=True)
                split = regex.compile(f"({'|'.join(longest)})") if added else None
            texts, special, row_of = [], [], []
            for row, whole in enumerate(batch.column("text").to_pylist()):
                parts = split.split(whole) if split and split.search(whole) else [whole]
                for part in parts:
                    row_of.append(row)
                    special.append(added.get(part, -1) if len(parts) > 1 else -1)
                    texts.append("" if special[-1] >= 0 else part)
            pieces, totals, held = [], [], []
            encoded = zip(row_of, special, encoder.encode(texts), strict=True)
            for at, (row, known, ids) in enumerate(encoded):
                held.append(ids if known < 0 else np.array([known], np.uint32))
                if at + 1 < len(row_of) and row_of[at + 1] == row:
                    continue
                ids = np.append(np.concatenate(held), np.uint32(closing)).astype("<u4")
                held = []
                totals.append(len(ids))
                cuts = [ids[i : i + window].tobytes() for i in range(0, len(ids), window)]
                pieces.append(
                    [{"crc32": zlib.crc32(c), "ids": c if keep_ids else None} for c in cuts]
                )
            kind = pa.list_(pa.struct([("crc32", pa.int64()), ("ids", pa.binary())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(totals, pa.int64()), pa.array(pieces, kind)],
                ["doc_id", "doc_tokens", "pieces"],
            )

    small_batches(docs.sparkSession)
    plain = docs.select(
        F.col(id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    return plain.mapInArrow(lean(run), schema)


def pack(cut: DataFrame, window: int = WINDOW, after_read: Callable[[], None] | None = None) -> DataFrame:
    """(doc_id, start, length, crc32, ids, doc_tokens, sequence_id, offset) of every piece.

    `cut` comes from `tokenised`. Remainders fill the first sequences, full windows follow.
    `after_read` is called once the texts have been read for the last time.
    """
    spark = cut.sparkSession
    cut = cut.withColumn("_rest", F.col("doc_tokens") % window).withColumn(
        "_full", F.floor(F.col("doc_tokens") / window)
    )
    order = [F.col("doc_id").asc_nulls_last(), F.col("doc_tokens"), F.xxhash64("pieces.crc32")]
    with written(cut, "tokenised") as cut:
        if after_read is not None:
            after_read()
        # At most `window` rows.
        classes = (
            cut.groupBy("_rest").agg(F.count(F.lit(1)).alias("n"), F.sum("_full").alias("full")).collect()
        )
        ranks = ranked(cut, ["_rest"], order, F.col("_full"))  # writes the pieces again, in order
    placements, used = best_fit({r["_rest"]: r["n"] for r in classes if r["_rest"]}, window)
    base, bases = used, []
    for row in classes:
        bases.append((row["_rest"], base))
        base += row["full"]
    bases = spark.createDataFrame(bases, "_rest long, _base long")
    plan = spark.createDataFrame(
        placements, "_rest long, _first long, _last long, _k long, _seq long, _offset long"
    )
    placed = ranks.join(F.broadcast(bases), "_rest")
    rank = F.col("_rank") - 1
    placed = placed.withColumn("_r", rank).join(
        F.broadcast(plan.withColumnRenamed("_rest", "_size")),
        (F.col("_rest") == F.col("_size")) & F.col("_r").between(F.col("_first"), F.col("_last")),
        "left",
    )
    nth = F.col("_r") - F.col("_first")
    tail = F.col("_pos") == F.col("_full")
    return placed.select("*", F.posexplode("pieces").alias("_pos", "_piece")).select(
        "doc_id",
        (F.col("_pos") * window).cast("long").alias("start"),
        F.when(tail, F.col("_rest")).otherwise(window).cast("long").alias("length"),
        F.col("_piece.crc32").alias("ids_crc32"),
        F.col("_piece.ids").alias("ids"),
        "doc_tokens",
        F.when(tail, F.col("_seq") + F.floor(nth / F.col("_k")))
        .otherwise(F.col("_base") + F.col("_before") + F.col("_pos"))
        .cast("long")
        .alias("sequence_id"),
        F.when(tail, F.col("_offset") + (nth % F.col("_k")) * F.col("_rest"))
        .otherwise(0)
        .cast("long")
        .alias("offset"),
    )
