"""Exactly repeated windows of units (bytes or words), found through content-chosen anchors.

A window has `length` units. In every window the smallest hash of a run of `seed` units is its
anchor, so equal windows have equal anchors, and consecutive windows share one. An anchor's
windows together are its stretch. The work is per anchor, about one in half a window:

* stretches that are equal as a whole are repeats but for the first of them;
* where anchors are equal and stretches differ, at the edges of a repeated passage, the windows
  of one stretch of each kind are compared one by one (`edge_windows`).

Records travel in packed arrays, one per bucket of the anchor hash and flush of a task. A flush
keeps the first of equal stretches, so a passage in a third of all texts is one record per flush.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from winnow.llm.bpe import BASE, MIX_A, MIX_B, powers
from winnow.llm.workers import lean, lean_group
from winnow.session import small_batches

SLAB = 1 << 17  # units worked on at once
FLUSH = 1 << 18  # records held by a task before it hands them on
ROW = 1 << 13  # records in a row: rows of a megabyte and more are hard on the heap
BUCKET_BYTES = 6 << 20  # of text whose records a bucket should hold

ANCHOR = np.dtype([("h", "<u8"), ("s", "<u8"), ("doc", "<i8"), ("p", "<u4"), ("n", "<u2")])
EDGE = np.dtype([("h", "<u8"), ("doc", "<i8"), ("p", "<u4"), ("n", "<u2")])
WINDOW = np.dtype([("h", "<u8"), ("w", "<u8"), ("doc", "<i8"), ("p", "<u4")])
#: Windows p .. p + n - 1 of a document start with something seen earlier.
RUN = np.dtype([("doc", "<i8"), ("p", "<u4"), ("n", "<u4")])
#: Units start .. end - 1 of a document go.
SPAN = np.dtype([("start", "<u4"), ("end", "<u4")])

#: Rows without an id come after all others.
NO_ID = (1 << 63) - 1

PACKED = "kind string, bucket int, level int, data binary"
SEPARATORS = np.zeros(256, bool)
SEPARATORS[[32, 9, 10, 11, 12, 13]] = True
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
KEY = b"words of a text"  # of the word hash
KEPT_WORD, KEPT_WORDS = 64, 1 << 18  # bytes of a word, and words, whose hashes a task keeps


@dataclass(frozen=True)
class Shape:
    """What is compared: windows of `length` units with anchors of `seed`; `buckets` of records."""

    units: str  # "bytes" or "words"
    length: int
    seed: int
    buckets: int


def mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(33))
    values *= np.uint64(MIX_A)
    values ^= values >> np.uint64(29)
    values *= np.uint64(MIX_B)
    return values ^ (values >> np.uint64(32))


BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


class Sums:
    """Hashes of words, and of any run of units from the prefix sums of a polynomial."""

    def __init__(self):
        self.words = Words()
        self.up, self.down = powers(SLAB + 4096)

    def of(self, units: np.ndarray) -> np.ndarray:
        if len(units) >= len(self.up):
            self.up, self.down = powers(len(units) + 4096)
        sums = np.zeros(len(units) + 1, np.uint64)
        np.cumsum(units * self.up[: len(units)], out=sums[1:])
        return sums

    def run(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (sums[end] - sums[start]) * self.down[start]


class Words(dict):
    """64-bit keyed hashes of words; those of short words are kept."""

    def __missing__(self, word: bytes) -> int:
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8, key=KEY).digest(), "little")
        if len(word) <= KEPT_WORD:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = value
        return value


def word_hashes(texts: list[bytes], sums: Sums) -> list[np.ndarray]:
    """The hash of each word of each text; words are runs without ASCII white space.

    A polynomial would give some long words the same hash (two letters in Thue-Morse order), so
    words have a keyed hash that no text can aim at.
    """
    out = []
    for text in texts:
        words = text.split() if len(text) <= SLAB else (m[0] for m in WORD.finditer(text))
        out.append(np.fromiter(map(sums.words.__getitem__, words), np.uint64))
    return out


def byte_slabs(texts: list[bytes]) -> Iterator[list[bytes]]:
    group, held = [], 0
    for text in texts:
        if group and held + len(text) > SLAB:
            yield group
            group, held = [], 0
        group.append(text)
        held += len(text)
    if group:
        yield group


def unit_arrays(shape: Shape, texts: list[bytes], sums: Sums) -> list[np.ndarray]:
    """One unsigned 64-bit number per unit (bytes stay bytes until they are worked on)."""
    if shape.units == "words":
        return word_hashes(texts, sums)
    return [np.frombuffer(t, np.uint8) for t in texts]


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every `width` consecutive values."""
    n = len(values)
    rows = -(-n // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    block = padded.reshape(rows, width)
    ahead = np.minimum.accumulate(block, axis=1).ravel()
    behind = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def segments(arrays: list[np.ndarray], docs: list[int], length: int):
    """Slabs of (units, segment of each unit, documents, places of the segments in them).

    A document longer than a slab is several segments that overlap by a window less one unit.
    """
    held, size = [], 0
    for units, doc in zip(arrays, docs, strict=True):
        for at in range(0, max(len(units) - length + 1, 0), SLAB):
            part = units[at : at + SLAB + length - 1]
            if held and size + len(part) > SLAB:
                yield _slab(held)
                held, size = [], 0
            held.append((part, doc, at))
            size += len(part)
    if held:
        yield _slab(held)


def _slab(held):
    units = np.concatenate([h[0] for h in held])
    if units.dtype == np.uint8:
        units = BYTES[units]
    sizes = np.array([len(h[0]) for h in held])
    return (
        units,
        np.repeat(np.arange(len(held), dtype=np.int32), sizes),
        np.array([h[1] for h in held], np.int64),
        np.array([h[2] for h in held], np.int64) - (np.cumsum(sizes) - sizes),
    )


def anchors(shape: Shape, slab, sums: Sums) -> np.ndarray:
    """ANCHOR records of a slab: hash of the anchor, hash and place of its stretch of windows."""
    units, segment, docs, shift = slab
    length, seed, n = shape.length, shape.seed, len(units)
    prefix = sums.of(units)
    grams = mixed((prefix[seed:] - prefix[:-seed]) * sums.down[: n - seed + 1])
    bits = np.uint64(n.bit_length())
    # Ties go to the first place, which depends on the window's content alone.
    order = ((grams >> bits) << bits) | np.arange(len(grams), dtype=np.uint64)
    least = sliding_least(order, length - seed + 1) & ((np.uint64(1) << bits) - np.uint64(1))
    place = np.flatnonzero(segment[: n - length + 1] == segment[length - 1 :])
    anchor = least[place].astype(np.int64)
    turn = np.ones(len(place), bool)
    turn[1:] = (anchor[1:] != anchor[:-1]) | (place[1:] != place[:-1] + 1)
    first = np.flatnonzero(turn)
    last = np.append(first[1:], len(place)) - 1
    start, end, anchor = place[first], place[last] + length, anchor[first]
    second = sums.of(mixed(units + np.uint64(BASE)))
    out = np.empty(len(first), ANCHOR)
    out["h"] = grams[anchor]
    out["s"] = mixed(sums.run(second, start, end) + (end - start).astype(np.uint64))
    out["doc"] = docs[segment[start]]
    out["p"] = start + shift[segment[start]]
    out["n"] = last - first + 1
    return out


def to_bytes(records: np.ndarray) -> bytes:
    """Records byte plane by byte plane: planes of zeros cost a compressed shuffle nothing."""
    width = records.dtype.itemsize
    return np.ascontiguousarray(records).view(np.uint8).reshape(-1, width).T.tobytes()


def from_bytes(data: bytes, kind: np.dtype) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets in the order of the hashes."""
    return ((hashes >> np.uint64(40)) * np.uint64(buckets)) >> np.uint64(24)


def anchor_buckets(records: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of anchors. Their hash is the smallest of a window, so it says nothing until mixed:
    by the hash itself a quarter of all anchors would be in the first of a hundred buckets."""
    return bucket_of(mixed(records["h"]), buckets).astype(np.int64)


def in_order(records: np.ndarray, *fields: str) -> np.ndarray:
    return records[np.lexsort([records[f] for f in reversed(fields)])]


def new_values(records: np.ndarray, *fields: str) -> np.ndarray:
    """Whether a record is the first with its values in sorted records."""
    new = np.ones(len(records), bool)
    if len(records) > 1:
        new[1:] = False
        for field in fields:
            new[1:] |= records[field][1:] != records[field][:-1]
    return new


def runs_of(records: np.ndarray, n: np.ndarray | int) -> np.ndarray:
    """RUN records of places, those that touch or overlap joined."""
    runs = np.empty(len(records), RUN)
    runs["doc"], runs["p"], runs["n"] = records["doc"], records["p"], n
    return joined_runs(runs)


def joined_runs(runs: np.ndarray) -> np.ndarray:
    if not len(runs):
        return runs
    runs = in_order(runs, "doc", "p")
    start, end = runs["p"].astype(np.int64), runs["p"].astype(np.int64) + runs["n"]
    # The furthest end so far in the document: documents are set apart by a large step.
    step = np.cumsum(new_values(runs, "doc")).astype(np.int64) << 33
    reach = np.maximum.accumulate(end + step) - step
    fresh = new_values(runs, "doc")
    fresh[1:] |= start[1:] > reach[:-1]
    first = np.flatnonzero(fresh)
    out = runs[first].copy()
    out["n"] = reach[np.append(first[1:], len(runs)) - 1] - start[first]
    return out


def packed(kind: str, records: np.ndarray, bucket: np.ndarray, level: int = -1) -> list[dict]:
    """Rows of the records of each bucket, at most ROW of them in a row."""
    if not len(records):
        return []
    order = np.argsort(bucket, kind="stable")
    bucket, records = bucket[order], records[order]
    cuts = np.flatnonzero(np.diff(bucket, prepend=bucket[:1] - 1 if bucket[0] else 1 << 40))
    cuts[0] = 0
    return [
        {"kind": kind, "bucket": int(bucket[a]), "level": level, "data": to_bytes(records[c : min(b, c + ROW)])}
        for a, b in zip(cuts, [*cuts[1:], len(records)], strict=True)
        for c in range(a, b, ROW)
    ]


def by_document(kind: str, records: np.ndarray, buckets: int) -> list[dict]:
    hashes = mixed(records["doc"].astype(np.uint64))
    return packed(kind, records, bucket_of(hashes, buckets).astype(np.int64))


def row_batches(rows: list[dict], size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches of about `size` bytes."""
    schema = pa.schema(
        [("kind", pa.string()), ("bucket", pa.int32()), ("level", pa.int32()), ("data", pa.binary())]
    )
    held, taken = [], 0
    for row in rows:
        held.append(row)
        taken += len(row["data"])
        if taken >= size:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, taken = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def plain(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, _doc, text): `_doc` orders the rows and `text` is bytes, never null."""
    small_batches(docs.sparkSession)
    key = F.col(id).cast("long")
    return docs.select(
        key.alias("doc_id"),
        F.coalesce(key, F.lit(NO_ID)).alias("_doc"),
        F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("text"),
    )


def buckets_for(docs: DataFrame) -> int:
    """Enough buckets that one is a small task; `docs` comes from `plain`."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(96, -(-size // BUCKET_BYTES))


def edges_of(records: np.ndarray) -> np.ndarray:
    edges = np.empty(len(records), EDGE)
    for field in EDGE.names:
        edges[field] = records[field]
    return edges


def anchor_rows(docs: DataFrame, shape: Shape) -> DataFrame:
    """Packed rows: `anchor` by the anchors' hash, `run` and `edge` of a flush by document.

    An anchor that a third of all texts have is two records of a flush.
    """

    def flushed(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        records = in_order(np.concatenate(held), "h", "s", "doc", "p")
        records = records[new_values(records, "h", "s", "doc", "p")]  # repeated rows
        first = new_values(records, "h", "s")
        again = records[~first]
        records = records[first]
        # Stretches of an anchor that has several are edges already; two of them tell the bucket.
        new = new_values(records, "h")
        kind = np.cumsum(new) - 1
        several = (np.bincount(kind) > 1)[kind]
        nth = np.arange(len(records)) - np.flatnonzero(new)[kind]
        sent = records[nth < 2]
        rows = packed("anchor", sent, anchor_buckets(sent, shape.buckets))
        rows += by_document("run", runs_of(again, again["n"]), shape.buckets)
        rows += by_document("edge", edges_of(records[several]), shape.buckets)
        yield from row_batches(rows)

    def run(batches):
        sums, held, size = Sums(), [], 0
        for batch in batches:
            ids = batch.column("_doc").to_pylist()
            arrays = unit_arrays(shape, batch.column("text").to_pylist(), sums)
            for slab in segments(arrays, ids, shape.length):
                held.append(anchors(shape, slab, sums))
                size += len(held[-1])
                if size >= FLUSH:
                    yield from flushed(held)
                    held, size = [], 0
        if size:
            yield from flushed(held)

    return docs.select("_doc", "text").mapInArrow(lean(run), PACKED)


def resolved(records: np.ndarray, new: np.ndarray):
    """(order of the first of equal stretches, repeats, edges) of a bucket's anchors.

    `new` marks records that nothing was compared with yet. Edges are stretches of anchors with
    several kinds of stretch, a new one among them.
    """
    order = np.lexsort([records[f] for f in ("p", "doc", "s", "h")])
    order = order[new_values(records[order], "h", "s", "doc", "p")]  # a place that came twice
    records, new = records[order], new[order]
    first = new_values(records, "h", "s")
    again = records[~first]
    records, new = records[first], new[first]
    kind = np.cumsum(new_values(records, "h")) - 1
    at_edge = (np.bincount(kind) > 1) & (np.bincount(kind, weights=new) > 0)
    at_edge = at_edge[kind] if len(kind) else np.zeros(0, bool)
    return order[first], runs_of(again, again["n"]), edges_of(records[at_edge])


def resolve(shape: Shape, merged: int, target: int):
    """The group function of a bucket: new anchors (level -1) against the levels of an index.

    Levels below `merged` and the new anchors become one run of level `target`, if that is not
    negative; higher levels are read alone.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        parts = [from_bytes(data, ANCHOR) for data in rows["data"]]
        level = np.repeat(rows["level"].to_numpy(), [len(p) for p in parts])
        records = np.concatenate(parts)
        first, repeats, edges = resolved(records, level < 0)
        out = by_document("run", repeats, shape.buckets)
        out += by_document("edge", edges, shape.buckets)
        if target >= 0:
            found = records[first[level[first] < merged]]
            out += packed("level", found, anchor_buckets(found, shape.buckets), target)
        return pd.DataFrame(out, columns=["kind", "bucket", "level", "data"])

    return run


def per_document(rows: DataFrame, kind: np.dtype, finish, schema: str) -> DataFrame:
    """One row per document from packed rows by document: `finish(records)` of each."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        records = np.concatenate([from_bytes(d, kind) for d in group["data"]])
        records = in_order(records, "doc", "p")
        cuts = np.flatnonzero(new_values(records, "doc"))
        parts = np.split(records, cuts[1:])
        return pd.DataFrame({"_id": records["doc"][cuts], "_found": [finish(p) for p in parts]})

    return rows.groupBy("bucket").applyInPandas(lean_group(run), schema)


def edge_windows(docs: DataFrame, edges: DataFrame, shape: Shape) -> DataFrame:
    """Packed rows of kind `run`: windows of the edges that equal an earlier window."""

    asked = np.dtype([(f, EDGE[f]) for f in ("h", "p", "n")])
    own = per_document(
        edges,
        EDGE,
        lambda r: np.unique(r[["h", "p", "n"]].astype(asked)).tobytes(),
        "_id long, _found binary",
    )

    def flushed(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        records = in_order(np.concatenate(held), "h", "w", "doc", "p")
        records = records[new_values(records, "h", "w", "doc", "p")]
        first = new_values(records, "h", "w")
        again = runs_of(records[~first], 1)
        records = records[first]
        # By the windows, not by their anchors, which may have very many of them.
        bucket = bucket_of(mixed(records["h"] ^ records["w"]), shape.buckets).astype(np.int64)
        rows = packed("window", records, bucket) + by_document("run", again, shape.buckets)
        yield from row_batches(rows)

    def run(batches):
        sums, held, size = Sums(), [], 0
        for batch in batches:
            ids = batch.column("_doc").to_pylist()
            found = batch.column("_found").to_pylist()
            arrays = unit_arrays(shape, batch.column("text").to_pylist(), sums)
            for doc, wanted, units in zip(ids, found, arrays, strict=True):
                wanted = np.frombuffer(wanted, asked)
                n = wanted["n"].astype(np.int64)
                place = np.repeat(wanted["p"].astype(np.int64) - (np.cumsum(n) - n), n)
                place += np.arange(len(place))
                hashes = np.repeat(wanted["h"], n)
                whole = place + shape.length <= len(units)  # an id with several texts
                place, hashes = place[whole], hashes[whole]
                out = np.empty(len(place), WINDOW)
                for at in range(0, max(len(units) - shape.length + 1, 0), SLAB):
                    here = np.flatnonzero((place >= at) & (place < at + SLAB))
                    if not len(here):
                        continue
                    part = units[at : at + SLAB + shape.length - 1]
                    part = BYTES[part] if part.dtype == np.uint8 else part
                    prefix = sums.of(mixed(part + np.uint64(MIX_B)))
                    start = place[here] - at
                    out["w"][here] = mixed(sums.run(prefix, start, start + shape.length))
                out["h"], out["doc"], out["p"] = hashes, doc, place
                held.append(out)
                size += len(out)
                if size >= FLUSH:
                    yield from flushed(held)
                    held, size = [], 0
        if size:
            yield from flushed(held)

    def again(rows: pd.DataFrame) -> pd.DataFrame:
        if rows["kind"].iloc[0] == "run":
            return rows[["kind", "bucket", "level", "data"]]
        records = np.concatenate([from_bytes(d, WINDOW) for d in rows["data"]])
        records = in_order(records, "h", "w", "doc", "p")
        # The same place can be asked for by several batches of an index.
        records = records[new_values(records, "h", "w", "doc", "p")]
        later = records[~new_values(records, "h", "w")]
        out = by_document("run", runs_of(later, 1), shape.buckets)
        return pd.DataFrame(out, columns=["kind", "bucket", "level", "data"])

    joined = docs.join(own, docs["_doc"] == own["_id"]).select("_doc", "text", "_found")
    found = joined.mapInArrow(lean(run), PACKED).withColumn("_of", F.col("kind"))
    return found.groupBy("_of", "bucket").applyInPandas(lean_group(again), PACKED)


def spans(runs: DataFrame, shape: Shape) -> DataFrame:
    """(_id, _found): the units of each document that repeats cover, as SPAN records."""

    def covered(records: np.ndarray) -> bytes:
        wide = records.copy()
        wide["n"] += shape.length - 1
        wide = joined_runs(wide)
        out = np.empty(len(wide), SPAN)
        out["start"], out["end"] = wide["p"], wide["p"] + wide["n"]
        return out.tobytes()

    return per_document(runs, RUN, covered, "_id long, _found binary")


def with_spans(docs: DataFrame, found: DataFrame) -> DataFrame:
    """`docs` with the spans of each, null without any."""
    return docs.join(found, docs["_doc"] == found["_id"], "left").drop("_id")
