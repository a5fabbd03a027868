"""Documents whose sets of word shingles have a high Jaccard similarity, and what they connect.

The join is the product of the document by shingle matrix with its transpose, of which only the
cells at or above the threshold are wanted. Equal rows of the matrix, documents with equal sets, are
one row first. The columns are cut into blocks by a hash, so many that the size bound decides: two
sets of sizes a and b that reach the threshold differ in at most (a + b) / 19 shingles (for 0.9), so
in at most as many blocks. Each set shows one block more than that, its fullest ones: of the blocks
that two linked sets share, the fullest has at most as many before it in either as they differ in,
so both show it. There are half as many blocks again as a set shows; so empty ones, which unrelated
sets have in common, are not shown, and those of a single shingle hardly ever. Documents that agree
in a block that both show are the only pairs looked at.
For these pairs the overlaps are accumulated over all shingles and compared with the exact bound.

A block's documents are not paired with each other: each is paired with the smallest of the smallest
ids of its blocks. Where the
links so found leave a block in several components, the documents outside its largest one are
paired with one of that; when this finds no more links, all documents of different components
that are still in one block are paired, blocks of two included. So every link lies within a component, and a group of near copies costs
about one pair for each copy.

Before the overlap of a pair is counted, parity sketches discard it if they differ in more bits
than the bound allows shingles: every differing shingle changes one bit, so no link is lost. The
sketch of a set of more than `LONG` shingles would be full; a second one, of two to four bits a
shingle, is compared then, so that whole sets are sent only for pairs that are linked or nearly so.

Words are runs without ASCII white space; A-Z is lower-cased. A document with fewer words than a shingle has is one
shingle, one without words has none and is linked with nothing. Rows without an id take no part in
links and have no component; rows with one id are one node, each with its own text. Other columns
are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from winnow.llm.bpe import BASE, MIX_A, MIX_B
from winnow.llm.repeats import (
    NO_ID,
    PACKED,
    Sums,
    bucket_of,
    buckets_for,
    byte_slabs,
    by_document,
    from_bytes,
    in_order,
    mixed,
    new_values,
    packed,
    plain,
    row_batches,
    word_hashes,
)
from winnow.operators.dedup import dedup_clusters
from winnow.llm.workers import give_back, lean, lean_group, write_kinds
from winnow.operators.skew import ranked
from winnow.session import discard, materialize, read_back, written

SHINGLE = 3
PERCENT = 90
ROOM = 1.5  # blocks for each that the bound asks for, as some have no or few shingles
SPARE = 2  # blocks beyond those

SKETCH = [f"k{i}" for i in range(32)]  # 64 bits each
DOC = np.dtype(
    [("doc", "<i8"), ("n", "<i8"), ("s1", "<i8"), ("s2", "<i8")] + [(k, "<i8") for k in SKETCH]
)
LONG = 32 * len(SKETCH)  # shingles from which a sketch is too full to tell sets apart
BITS = np.dtype([("doc", "<i8"), ("n", "<i8")])  # before the sketch of a long set
SET = np.dtype([("s1", "<i8"), ("s2", "<i8"), ("doc", "<i8"), ("count", "<i8")])
KEY = np.dtype([("h", "<u8"), ("s", "<u8"), ("doc", "<i8"), ("n", "<u4")])
MEMBER = np.dtype([("h", "<i8"), ("doc", "<i8"), ("n", "<i8")])
PAIR = np.dtype([("a", "<i8"), ("b", "<i8")])

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER = LOWER.tobytes()

FLUSH = 1 << 18
TILE = 512  # documents on a side of a cell of the product
SKETCH_TILE = 1024  # of sketches of long sets
CELLS = 1 << 23  # cells of a block of columns
COMPARED = 8 << 20  # bytes of sketches compared at once


class Sizes:
    """Classes of set sizes: partners that can reach the threshold are in one class or the next."""

    def __init__(self, percent: int):
        self.percent = percent
        low, bounds = -(-percent // (100 - percent)), []
        # Smaller sets reach the threshold only if they are equal.
        while low < 1 << 40:
            bounds.append(low)
            low = low * 100 // percent + 1
        self.bounds = np.array(bounds)
        top = np.append(self.bounds[1:], low) - 1
        # a + b - 2 * overlap, with overlap >= t / (1 + t) * (a + b) and b <= a / t.
        share = (100 - percent) / (100 + percent) * (1 + 100 / percent)
        self.most = np.floor(top * share + 1e-6).astype(np.int64)  # shingles that may differ
        self.blocks = np.floor(ROOM * self.most).astype(np.int64) + 1 + SPARE

    def of(self, n: np.ndarray) -> np.ndarray:
        """The class of each size, -1 for those that only equal sets can match."""
        return np.searchsorted(self.bounds, n, side="right") - 1


def shingle_sets(texts: list[bytes], size: int, sums: Sums) -> tuple[np.ndarray, np.ndarray]:
    """(owner, hash) of the distinct shingles of each text, sorted by both."""
    words = word_hashes([t.translate(LOWER) for t in texts], sums)
    counts = np.array([len(w) for w in words])
    flat = np.concatenate([np.zeros(0, np.uint64), *words])
    owner = np.repeat(np.arange(len(texts)), counts)
    n = len(flat) - size + 1
    rows, hashes = [], []
    if n > 0:
        whole = np.flatnonzero(owner[:n] == owner[size - 1 :])
        value = np.zeros(len(whole), np.uint64)
        for i in range(size):
            value = mixed(value * np.uint64(MIX_B) + flat[whole + i])
        rows.append(owner[whole])
        hashes.append(value)
    starts = np.cumsum(counts) - counts
    for i in np.flatnonzero((counts > 0) & (counts < size)):
        value = np.array([counts[i]], np.uint64)
        for word in flat[starts[i] : starts[i] + counts[i]]:
            value = mixed(value * np.uint64(MIX_A) + word)
        rows.append(np.array([i]))
        hashes.append(value)
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    pairs = np.empty(sum(map(len, rows)), [("o", "<i8"), ("v", "<u8")])
    pairs["o"], pairs["v"] = np.concatenate(rows), np.concatenate(hashes)
    pairs = pairs[np.lexsort([pairs["v"], pairs["o"]])]
    pairs = pairs[new_values(pairs, "o", "v")]
    return pairs["o"], pairs["v"]


def summed(index: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(size, np.uint64)
    np.add.at(out, index, values)
    return out


def block_keys(
    owner: np.ndarray, hashes: np.ndarray, n: np.ndarray, kind: np.ndarray, sizes: Sizes
) -> tuple[np.ndarray, np.ndarray]:
    """(owner, key) of the column blocks that each set shows, cut as its size class `kind` asks for."""
    take = kind[owner] >= 0
    owner, hashes = owner[take], hashes[take]
    most = sizes.most[np.maximum(kind, 0)]
    blocks = np.where(kind >= 0, sizes.blocks[np.maximum(kind, 0)], 0)
    first = np.cumsum(blocks) - blocks
    block = (mixed(hashes + np.uint64(BASE)) >> np.uint64(32)).astype(np.int64) % blocks[owner]
    at, total = first[owner] + block, int(blocks.sum())
    signature = summed(at, mixed(hashes ^ np.uint64(MIX_A)), total)
    held = np.bincount(at, minlength=total)
    whose = np.repeat(np.arange(len(n)), blocks)
    number = np.arange(total) - first[whose]
    tag = kind[whose].astype(np.uint64) << np.uint64(32) | number.astype(np.uint64)
    key = mixed(mixed(signature + np.uint64(MIX_B)) + tag * np.uint64(BASE))
    # The order is one of keys, the same in all sets: equal blocks are equally full.
    place = np.empty(total, np.int64)
    place[np.lexsort([key, -held, whose])] = number
    # A set with too few filled blocks for the bound shows all, its empty ones as well.
    few = np.bincount(whose[held > 0], minlength=len(n)) <= most
    shown = few[whose] | (place <= most[whose])
    return whose[shown], key[shown]


def long_sketch(hashes: np.ndarray) -> bytes:
    """Parities of the shingles that fall on each of two to four bits a shingle.

    There are a power of two of them, so a longer sketch folds to any shorter one.
    """
    bits = 1 << (2 * len(hashes) - 1).bit_length()
    odd = np.zeros(bits, np.uint8)
    np.bitwise_xor.at(odd, mixed(hashes ^ np.uint64(MIX_B)) & np.uint64(bits - 1), np.uint8(1))
    return np.packbits(odd).tobytes()


def long_rows(ids: np.ndarray, owner: np.ndarray, hashes: np.ndarray, n: np.ndarray, buckets: int) -> list[dict]:
    """A packed row `bits` of each long set."""
    ends, rows = np.cumsum(n), []
    for at in np.flatnonzero((n > LONG) & (ids != NO_ID)):
        head = np.array([(ids[at], n[at])], BITS)
        bucket = bucket_of(mixed(head["doc"].astype(np.uint64)), buckets)[0]
        data = head.tobytes() + long_sketch(hashes[ends[at] - n[at] : ends[at]])
        rows.append({"kind": "bits", "bucket": int(bucket), "level": -1, "data": data})
    return rows


def matrix_rows(docs: DataFrame, size: int, sizes: Sizes, buckets: int) -> DataFrame:
    """Packed rows: `doc`, `bits` by document, `set` by set, `key` by column block of a set."""

    def flushed(held: list[list]) -> Iterator[pa.RecordBatch]:
        docs_, sets, keys = (np.concatenate([h[i] for h in held]) for i in range(3))
        rows = by_document("doc", docs_, buckets)
        rows += [row for h in held for row in h[3]]
        sets = in_order(sets, "s1", "s2", "doc")
        first = np.flatnonzero(new_values(sets, "s1", "s2"))
        counts = np.diff(np.append(first, len(sets)))
        sets = sets[first]
        sets["count"] = counts
        rows += packed("set", sets, bucket_of(sets["s1"].astype(np.uint64), buckets).astype(np.int64))
        keys = in_order(keys, "h", "s", "doc")
        keys = keys[new_values(keys, "h", "s")]
        rows += packed("key", keys, bucket_of(keys["h"], buckets).astype(np.int64))
        yield from row_batches(rows)

    def slab(ids: np.ndarray, texts: list[bytes], sums: Sums) -> list:
        owner, hashes = shingle_sets(texts, size, sums)
        n = np.bincount(owner, minlength=len(texts))
        docs_ = np.empty(len(texts), DOC)
        docs_["doc"], docs_["n"] = ids, n
        docs_["s1"] = summed(owner, mixed(hashes + np.uint64(1)), len(texts)).view(np.int64)
        docs_["s2"] = summed(owner, mixed(hashes * np.uint64(MIX_B)), len(texts)).view(np.int64)
        # Bit i of a sketch: whether an odd number of shingles fall on i.
        bits = 64 * len(SKETCH)
        spot = (mixed(hashes + np.uint64(BASE)) % np.uint64(bits)).astype(np.int64)
        odd = np.bincount(owner * bits + spot, minlength=bits * len(texts)).reshape(-1, bits) & 1
        words = np.packbits(odd.astype(np.uint8), axis=1).view(np.int64)
        for i, field in enumerate(SKETCH):
            docs_[field] = words[:, i]
        known = (n > 0) & (ids != NO_ID)
        sets = np.zeros(int(known.sum()), SET)
        for field in ("s1", "s2", "doc"):
            sets[field] = docs_[field][known]
        keys = []
        kind = sizes.of(n)
        kind[~known] = -1
        for lower in (0, 1):  # as the smaller and as the larger of a pair
            whose, key = block_keys(owner, hashes, n, np.maximum(kind - lower, -1), sizes)
            out = np.empty(len(whose), KEY)
            out["h"], out["doc"], out["n"] = key, ids[whose], n[whose]
            out["s"] = docs_["s1"][whose].view(np.uint64)
            keys.append(out)
        return [docs_, sets, np.concatenate(keys), long_rows(ids, owner, hashes, n, buckets)]

    def run(batches):
        sums, held, taken = Sums(), [], 0
        for batch in batches:
            ids = batch.column("_doc").to_numpy()
            at = 0
            for group in byte_slabs(batch.column("text").to_pylist()):
                held.append(slab(ids[at : at + len(group)], group, sums))
                at += len(group)
                taken += len(held[-1][2]) + len(held[-1][0])
                if taken >= FLUSH:
                    yield from flushed(held)
                    held, taken = [], 0
        if held:
            yield from flushed(held)

    return docs.select("_doc", "text").mapInArrow(lean(run), PACKED)


def near_enough(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of two sizes can reach the threshold."""
    return np.minimum(a, b) * 100 >= np.maximum(a, b) * percent


def gathered(buckets: int, percent: int):
    """The group function of a bucket of any kind."""

    def shared(data: list[bytes]) -> list[dict]:
        sets = in_order(np.concatenate([from_bytes(d, SET) for d in data]), "s1", "s2", "doc")
        first = np.flatnonzero(new_values(sets, "s1", "s2"))
        counts = np.add.reduceat(sets["count"], first)
        return by_document("shared", sets[first][counts > 1], buckets)

    def candidates(data: list[bytes]) -> list[dict]:
        keys = in_order(np.concatenate([from_bytes(d, KEY) for d in data]), "h", "s", "doc")
        keys = keys[new_values(keys, "h", "s")]
        keys = in_order(keys, "h", "doc")
        first = np.flatnonzero(new_values(keys, "h"))
        counts = np.diff(np.append(first, len(keys)))
        pivot = np.repeat(first, counts)
        other = np.arange(len(keys)) != pivot
        other &= near_enough(keys["n"].astype(np.int64), keys["n"][pivot].astype(np.int64), percent)
        pairs = np.empty(int(other.sum()), PAIR)
        pairs["a"], pairs["b"] = keys["doc"][pivot][other], keys["doc"][other]
        pairs = in_order(pairs[pairs["a"] != pairs["b"]], "a", "b")
        pairs = pairs[new_values(pairs, "a", "b")]
        mixed_ids = mixed(mixed(pairs["a"].astype(np.uint64)) + pairs["b"].astype(np.uint64))
        rows = packed("pair", pairs, bucket_of(mixed_ids, buckets).astype(np.int64))
        many = np.repeat(counts > 2, counts)
        members = np.empty(int(many.sum()), MEMBER)
        members["h"] = keys["h"][many].view(np.int64)
        members["doc"], members["n"] = keys["doc"][many], keys["n"][many]
        return rows + by_document("member", members, buckets)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        kind, data = rows["kind"].iloc[0], list(rows["data"])
        if kind in ("doc", "bits"):
            return rows[["kind", "bucket", "level", "data"]]
        out = shared(data) if kind == "set" else candidates(data)
        return pd.DataFrame(out, columns=["kind", "bucket", "level", "data"])

    return run


def unpacked(rows: DataFrame, kind: np.dtype) -> DataFrame:
    """Packed records as rows of longs."""
    schema = ", ".join(f"{name} long" for name in kind.names)

    def run(batches):
        for batch in batches:
            for data in batch.column("data").to_pylist():
                records = from_bytes(data, kind)
                columns = [pa.array(records[f].astype(np.int64)) for f in kind.names]
                yield pa.RecordBatch.from_arrays(columns, list(kind.names))

    return rows.select("data").mapInArrow(run, schema)


def long_sketches(rows: DataFrame, each: DataFrame) -> DataFrame:
    """(doc, n, bits) of the long sets, from packed rows; not of ids with several texts, as one of
    these may be short. `each` has a row (doc, n) of each text."""

    def run(batches):
        for batch in batches:
            data = batch.column("data").to_pylist()
            heads = np.frombuffer(b"".join(d[: BITS.itemsize] for d in data), BITS)
            columns = [pa.array(heads[f].astype(np.int64)) for f in BITS.names]
            columns.append(pa.array([d[BITS.itemsize :] for d in data], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, ["doc", "n", "bits"])

    one = each.groupBy("doc").agg(F.count("*").alias("texts"), F.max("n").alias("n"))
    one = one.where((F.col("texts") == 1) & (F.col("n") > LONG)).select("doc")
    found = rows.select("data").mapInArrow(lean(run), "doc long, n long, bits binary")
    return materialize(found.join(one, "doc", "left_semi"), "long-sketches")


def overlaps(sets: list[np.ndarray], pairs: np.ndarray) -> np.ndarray:
    """Shared shingles of pairs of rows of a tile of the matrix.

    The tile times its transpose, a block of columns after the other; columns with one entry add
    nothing. Few pairs are counted by merging their rows.
    """
    if len(pairs) <= 4 * len(sets):
        return np.array(
            [len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in pairs.tolist()], np.int64
        )
    _, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = counts > 1
    number = np.cumsum(shared) - 1
    row, column = row[shared[column]], number[column[shared[column]]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    total = np.zeros((len(sets), len(sets)), np.float32)
    width = max(1, CELLS // len(sets))
    for first in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(column, [first, first + width])
        block = np.zeros((len(sets), min(width, int(shared.sum()) - first)), np.float32)
        block[row[a:b], column[a:b] - first] = 1
        total += block @ block.T
    return total[pairs[:, 0], pairs[:, 1]].astype(np.int64)


def tiles(pairs: DataFrame, size: int = TILE) -> DataFrame:
    """(i, j, a, b): the cell of the matrix product that each written pair lies in.

    Documents are numbered in order of the smallest document that they are paired with, so those of
    one group are in few tiles of `size` documents, and a row of the matrix goes to few cells.
    """
    both = pairs.select(F.col("a").alias("doc"), F.col("b").alias("other")).unionByName(
        pairs.select(F.col("b").alias("doc"), F.col("a").alias("other"))
    )
    nodes = both.groupBy("doc").agg(F.min("other").alias("least"))
    nodes = nodes.withColumn("least", F.least("least", "doc"))
    placed = ranked(nodes, [], [F.col("least"), F.col("doc")])
    placed = materialize(placed.select("doc", F.floor((F.col("_rank") - 1) / size).alias("tile")), "tiles")
    one = placed.select(F.col("doc").alias("a"), F.col("tile").alias("i"))
    other = placed.select(F.col("doc").alias("b"), F.col("tile").alias("j"))
    return materialize(pairs.join(other, "b").join(one, "a").select("i", "j", "a", "b"), "cells")


def asked_of(cells: DataFrame) -> DataFrame:
    """(_i, _j, _doc): the documents of the pairs of each cell."""
    ends = [cells.select(F.col("i").alias("_i"), F.col("j").alias("_j"), F.col(c).alias("_doc")) for c in "ab"]
    return ends[0].unionByName(ends[1]).distinct()


def differing(bits: list[bytes], pairs: np.ndarray) -> np.ndarray:
    """How many bits differ in each pair of sketches, the longer one folded to the shorter."""
    sizes = np.array([len(b) for b in bits])
    least, out = sizes[pairs].min(1), np.zeros(len(pairs), np.int64)
    for width in np.unique(least):
        where = np.flatnonzero(least == width)
        used, spots = np.unique(pairs[where], return_inverse=True)
        spots = spots.reshape(-1, 2)
        folded = [np.bitwise_xor.reduce(np.frombuffer(bits[u], np.uint64).reshape(-1, width // 8), 0) for u in used]
        folded, step = np.stack(folded), max(1, COMPARED // int(width))
        for at in range(0, len(where), step):
            a, b = spots[at : at + step].T
            out[where[at : at + step]] = np.bitwise_count(folded[a] ^ folded[b]).sum(1, dtype=np.int64)
    return out


def possible(pairs: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """The pairs that the sketches of long sets, `bits` (doc, n, bits), leave; `pairs` is written."""
    ids = bits.select("doc")
    long = pairs.join(ids.select(F.col("doc").alias("a")), "a", "left_semi")
    long = materialize(long.join(ids.select(F.col("doc").alias("b")), "b", "left_semi").select("a", "b"), "long-pairs")
    if long.isEmpty():
        return pairs
    cells = tiles(long, SKETCH_TILE)
    wanted = asked_of(cells).join(bits.withColumnRenamed("doc", "_doc"), "_doc")

    def told_apart(pairs: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        place = pd.Index(rows["_doc"])
        spots = np.stack([place.get_indexer(pairs[c]) for c in "ab"], 1)
        sizes = rows["n"].to_numpy()[spots].sum(1)
        far = differing(list(rows["bits"]), spots) * (100 + percent) > sizes * (100 - percent)
        give_back()
        return pairs.loc[far, ["a", "b"]]

    far = cells.groupBy("i", "j").cogroup(wanted.groupBy("_i", "_j")).applyInPandas(told_apart, "a long, b long")
    return materialize(pairs.join(far, ["a", "b"], "left_anti"), "possible")


def linked(docs: DataFrame, pairs: DataFrame, size: int, percent: int, bits: DataFrame) -> DataFrame:
    """The pairs whose overlap reaches the threshold. `pairs` (a, b) is written.

    The product is computed cell by cell: a row of the matrix goes once to each cell that it has a
    pair in, however many pairs those are.
    """
    pairs = possible(pairs, bits, percent)
    ends = pairs.select(F.col("a").alias("_end")).unionByName(pairs.select(F.col("b").alias("_end")))

    def sets(batches):
        sums = Sums()
        for batch in batches:
            texts, found = batch.column("text").to_pylist(), []
            for group in byte_slabs(texts):
                owner, hashes = shingle_sets(group, size, sums)
                cuts = np.searchsorted(owner, np.arange(1, len(group)))
                found += [h.tobytes() for h in np.split(hashes, cuts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_doc"), pa.array(found, pa.binary())], ["_doc", "set"]
            )

    asked = docs.join(ends.distinct(), docs["_doc"] == F.col("_end"), "left_semi")
    rows = asked.select("_doc", "text").mapInArrow(lean(sets), "_doc long, set binary")
    cells = tiles(pairs)
    wanted = asked_of(cells).join(rows, "_doc")

    def product(pairs: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        held = [np.frombuffer(s, np.uint64) for s in rows["set"]]
        own: dict[int, list[int]] = {}  # an id may have several texts
        for at, doc in enumerate(rows["_doc"].tolist()):
            own.setdefault(doc, []).append(at)
        where, spots = [], []
        for n, (a, b) in enumerate(zip(pairs["a"].tolist(), pairs["b"].tolist(), strict=True)):
            for x in own.get(a, ()):
                for y in own.get(b, ()):
                    where.append(n)
                    spots.append((x, y))
        if not spots:
            return pairs[["a", "b"]][:0]
        spots = np.array(spots)
        sizes = np.array([len(s) for s in held])[spots].sum(1)
        both = overlaps(held, spots)
        near = np.unique(np.array(where)[100 * both >= percent * (sizes - both)])
        give_back()
        return pairs[["a", "b"]].iloc[near]

    return cells.groupBy("i", "j").cogroup(wanted.groupBy("_i", "_j")).applyInPandas(product, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(id, component) of all linked documents."""
    return dedup_clusters(links.select(F.col("a").alias("src"), F.col("b").alias("dst")))


def can_link(percent: int, x: str, y: str) -> Column:
    """Whether sizes and sketches of two documents, with these prefixes, leave room for a link."""
    n, m = F.col(f"{x}n"), F.col(f"{y}n")
    bits = [F.bit_count(F.col(x + k).bitwiseXOR(F.col(y + k))) for k in SKETCH]
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (
        sum(bits[1:], bits[0]) * (100 + percent) <= (n + m) * (100 - percent)
    )


def sided(df: DataFrame, side: str, keep: list[str]) -> DataFrame:
    """The columns that describe a document, with a prefix."""
    named = [F.col(c).alias(side + c) for c in ("doc", "n", *SKETCH, "component") if c in df.columns]
    return df.select(*keep, *named)


def plausible(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and sketches of any of their texts leave."""
    one = sided(sketches, "x_", []).withColumnRenamed("x_doc", "a")
    other = sided(sketches, "y_", []).withColumnRenamed("y_doc", "b")
    return pairs.join(one, "a").join(other, "b").where(can_link(percent, "x_", "y_")).select("a", "b").distinct()


def torn_blocks(members: DataFrame, groups: DataFrame, sketches: DataFrame) -> DataFrame:
    """Members of blocks in several components, with sketch, component and the largest one."""
    known = members.join(groups, members["doc"] == groups["id"], "left").select(
        "h", "doc", F.coalesce("component", "doc").alias("component")
    )
    sizes = known.groupBy("h", "component").agg(F.count("*").alias("size"))
    largest = (
        sizes.groupBy("h")
        .agg(F.max(F.struct("size", "component")).alias("top"), F.count("*").alias("kinds"))
        .where("kinds > 1")
        .select("h", F.col("top.component").alias("home"))
    )
    return known.join(largest, "h").join(sketches, "doc")


def across(torn: DataFrame, tried: DataFrame, percent: int, every: bool) -> DataFrame:
    """New pairs of documents that share a block and are in different components.

    Documents outside a block's largest component meet its smallest id or, with `every`, all
    documents of other components.
    """
    few = sided(torn.where("component != home"), "x_", ["h"])
    others = torn
    if not every:
        home = F.struct("doc", "n", *SKETCH, "component")
        others = torn.where("component = home").groupBy("h").agg(F.min(home).alias("m"))
        others = others.select("h", "m.*")
    met = few.join(sided(others, "y_", ["h"]), "h").where(
        (F.col("x_component") != F.col("y_component")) & can_link(percent, "x_", "y_")
    )
    pairs = met.select(F.least("x_doc", "y_doc").alias("a"), F.greatest("x_doc", "y_doc").alias("b"))
    return materialize(pairs.distinct().join(tried, ["a", "b"], "left_anti"), "pairs")


def apart(pairs: DataFrame, groups: DataFrame, tried: DataFrame) -> DataFrame:
    """The pairs (a, b) not tried yet whose documents are in different components."""
    one = groups.select(F.col("id").alias("a"), F.col("component").alias("_x"))
    other = groups.select(F.col("id").alias("b"), F.col("component").alias("_y"))
    left = pairs.join(tried, ["a", "b"], "left_anti").join(one, "a", "left").join(other, "b", "left")
    return left.where(F.coalesce("_x", "a") != F.coalesce("_y", "b")).select("a", "b")


def join(
    docs: DataFrame,
    size: int = SHINGLE,
    percent: int = PERCENT,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row; the component's smallest id."""
    if not 50 < percent <= 100:
        raise ValueError("the size bound needs a threshold over 50 percent")
    spark = docs.sparkSession
    docs = plain(docs, id, text)
    buckets, sizes = buckets_for(docs), Sizes(min(percent, 99))
    rows = matrix_rows(docs, size, sizes, buckets).withColumn("_of", F.col("kind"))
    grouped = rows.groupBy("_of", "bucket").applyInPandas(
        lean_group(gathered(buckets, percent)), PACKED
    )
    path = write_kinds(grouped, "shingles")
    found = read_back(spark, path, PACKED)
    of = lambda kind: found.where(F.col("kind") == kind)

    # An id has a sketch for each of its texts.
    sketches = unpacked(of("doc"), DOC).where(F.col("doc") != NO_ID).select("doc", "n", *SKETCH)
    sketches = materialize(sketches.distinct(), "sketches")
    shared = unpacked(of("shared"), SET).select("s1", "s2", F.col("doc").alias("rep"))
    each = unpacked(of("doc"), DOC).join(shared, ["s1", "s2"], "left")
    rep = F.when(F.col("n") > 0, F.coalesce("rep", "doc")).otherwise(F.col("doc"))
    each = materialize(each.select("doc", "n", rep.alias("rep")), "sets")
    # Texts of one id are linked, also where they stand for equal sets of other ids.
    several = each.where(F.col("doc") != NO_ID).groupBy("doc")
    several = several.agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low != high")
    own = each.join(several, "doc", "left_semi").where("doc != rep")
    own = own.select(F.col("rep").alias("a"), F.col("doc").alias("b")).distinct()
    members = unpacked(of("member"), MEMBER).select("h", "doc")
    pairs = plausible(unpacked(of("pair"), PAIR).distinct(), sketches, percent)
    pairs = materialize(pairs, "plausible")
    # One centre each at first; most links are found with it, and torn blocks show what is missing.
    bits = long_sketches(of("bits"), each)
    tried = materialize(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "pairs")
    links = materialize(linked(docs, tried, size, percent, bits).unionByName(own), "links")
    groups = components(links)
    for every in (False, True):
        while True:
            with written(torn_blocks(members, groups, sketches), "torn-blocks") as torn:
                more = across(torn, tried, percent, every)
            if every:
                # Two documents that are a block of their own are in no torn block.
                more = materialize(more.unionByName(apart(pairs, groups, tried)).distinct(), "pairs")
            new = materialize(linked(docs, more, size, percent, bits), "links")
            tried = tried.unionByName(more)
            if new.isEmpty():
                break
            links = links.unionByName(new)
            groups = components(links)
            if every:  # all that could be linked have met
                break
    discard(spark, path)  # what follows reads the tables made of it

    named = each.join(groups, each["rep"] == groups["id"], "left")
    known = F.col("doc") != NO_ID
    return named.select(
        F.when(known, F.col("doc")).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(known, F.coalesce("component", "rep")).alias("component_id"),
    )
