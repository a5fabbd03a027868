"""Byte-level BPE encoding and decoding over overlapping chunks.

Short texts are encoded where they are scanned. A long text is cut into overlapping chunks that
are pre-tokenised in parallel; two neighbouring chunks are stitched at the first pre-token
boundary that both find in their overlap, and the pieces between stitches are encoded apart.

Nulls count as empty texts. Repeated rows and repeated ids give one result each. Columns other
than the id and the text are ignored, whatever their names.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window, functions as F

from winnow.llm.workers import lean
from winnow.session import materialize, small_batches

CHUNK = 1 << 16  # characters a chunk owns
OVERLAP = 1 << 10  # characters a chunk shares with the next one
SLAB = 1 << 18  # characters worked on at once
CACHE = 1 << 20  # slots for encoded pre-tokens per worker

LETTER, NUMBER, OTHER, SPACE, END = range(5)
# Base and finalisers of the rolling hash: odd 64-bit constants.
BASE, MIX_A, MIX_B = 0x9E3779B97F4A7C15, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53

ENCODED = "_key long, doc_id long, piece int, pieces int, n_tokens long, ids binary"


def char_classes() -> np.ndarray:
    """The class of every code point in the pattern's terms."""
    points = [i for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    every, where = "".join(map(chr, points)), np.array(points)
    classes = np.full(0x110000, OTHER, np.uint8)
    for pattern, value in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", SPACE)):
        for run in regex.finditer(pattern, every):
            classes[where[run.start() : run.end()]] = value
    return classes


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverse modulo 2 ** 64, for i < n."""
    inverse = pow(BASE, -1, 1 << 64)
    out = []
    for base in (BASE, inverse):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


def token_starts(points: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Whether a match of the pre-token pattern starts at each position.

    A run of letters, numbers or other signs takes one blank before it along; a run of white
    space before a word gives its last character away; an apostrophe that starts a match takes
    the letters of a contraction. `classes` is END after each text.
    """
    n = len(points)
    start = np.ones(n, bool)
    start[1:] = classes[1:] != classes[:-1]
    start[classes == END] = True
    last = np.flatnonzero((classes[:-1] == SPACE) & (classes[1:] < SPACE))
    start[last] = True
    start[last[points[last] == 32] + 1] = False
    quote = np.flatnonzero((points[:-1] == 39) & start[:-1] & (classes[1:] == LETTER))
    if len(quote):
        first = points[quote + 1]
        second = points[np.minimum(quote + 2, n - 1)]
        single = np.isin(first, [ord(c) for c in "stmd"])
        double = np.zeros(len(quote), bool)
        for pair in ("re", "ve", "ll"):
            double |= (first == ord(pair[0])) & (second == ord(pair[1]))
        for chosen, length in ((quote[single], 1), (quote[double], 2)):
            start[chosen + 1] = False
            after = chosen + 1 + length
            after = after[after < n]
            start[after[classes[after] == LETTER]] = True
    return start


class Encoder:
    """Encodes texts in slabs; pre-tokens met before come from a table of their hashes.

    The table holds their characters too: a pre-token takes the ids of another one only if both
    are equal character by character, whatever their hashes.
    """

    def __init__(self, ranks_path: str, pattern: str):
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.merges = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self.line = self.merges.encode_ordinary("\n")[0]
        self.classes = char_classes()
        self.up, self.down = powers(SLAB + CHUNK)
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(CACHE, np.uint64)
        self.first = np.zeros(CACHE, np.int64)
        self.length = np.zeros(CACHE, np.int64)
        self.pool = np.zeros(1 << 20, np.uint32)
        self.used = 0
        self.origin = np.zeros(CACHE, np.int64)
        self.size = np.zeros(CACHE, np.int64)
        self.held = np.zeros(1 << 20, np.uint32)  # characters of the pre-tokens in the table
        self.filled = 0

    def remember(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Merge new pre-tokens; (place of the ids in the pool, their number) for each.

        They are encoded together, a line break between them: it is a pre-token of its own there,
        and no pre-token but white space holds one.
        """
        blank = np.array([w.isspace() for w in words])
        lines = [w for w, b in zip(words, blank, strict=True) if not b]
        ids = np.array(self.merges.encode_ordinary("\n".join(lines) + "\n"), np.uint32)
        apart = ids == self.line
        stops = np.flatnonzero(apart) - np.arange(len(lines) + (not lines))
        length = np.zeros(len(words), np.int64)
        at = np.zeros(len(words), np.int64)
        if lines:
            length[~blank] = np.diff(stops, prepend=0)
            at[~blank] = stops - length[~blank]
        found = [ids[~apart]]
        held = len(found[0])
        for i in np.flatnonzero(blank):
            own = np.array(self.merges.encode_ordinary(words[i]), np.uint32)
            at[i], length[i] = held, len(own)
            held += len(own)
            found.append(own)
        while self.used + held > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(len(self.pool), np.uint32)])
        self.pool[self.used : self.used + held] = np.concatenate(found)
        at += self.used
        self.used += held
        return at, length

    def hold(self, points: np.ndarray, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Keep the characters of pre-tokens; the place of each."""
        total = np.cumsum(size)
        at = self.filled + total - size
        kept = points[np.repeat(starts - (total - size), size) + np.arange(total[-1])]
        self.held[self.filled : self.filled + len(kept)] = kept
        self.filled += len(kept)
        return at

    def slab(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, end of each text's ids)."""
        if max(self.used, self.filled) > 1 << 23:
            self.clear()
        joined = "\0".join(texts) + "\0"
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        classes = self.classes[points]
        ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        classes[ends] = END
        starts = np.flatnonzero(token_starts(points, classes))
        stops = np.append(starts[1:], len(points))
        if len(points) + 1 > len(self.up):
            self.up, self.down = powers(len(points) + 1)
        weighed = (points.astype(np.uint64) + np.uint64(1)) * np.uint64(MIX_A)
        weighed ^= weighed >> np.uint64(31)
        weighed *= self.up[: len(points)]
        sums = np.zeros(len(points) + 1, np.uint64)
        np.cumsum(weighed, out=sums[1:])
        keys = (sums[stops] - sums[starts]) * self.down[starts]
        keys ^= keys >> np.uint64(32)
        keys *= np.uint64(MIX_B)
        keys ^= keys >> np.uint64(29)
        keys |= np.uint64(1)  # zero marks a free slot
        slots = (keys >> np.uint64(20)).astype(np.int64) & (CACHE - 1)
        size = stops - starts
        # Room for the new pre-tokens, and for reading past the end where hashes collide.
        room = self.filled + 2 * len(points) - len(self.held)
        if room > 0:
            grown = max(room, len(self.held))
            self.held = np.concatenate([self.held, np.zeros(grown, np.uint32)])
        known = (self.keys[slots] == keys) & (self.size[slots] == size)
        real = classes[starts] != END
        at = np.where(known, self.first[slots], 0)
        length = np.where(known & real, self.length[slots], 0)
        origin = np.where(known, self.origin[slots], 0)
        alike = known | ~real
        new = np.flatnonzero(~known & real)
        if len(new):
            distinct, where, back = np.unique(keys[new], return_index=True, return_inverse=True)
            first = new[where]
            spans = zip(starts[first].tolist(), stops[first].tolist(), strict=True)
            own_at, own_length = self.remember([joined[a:b] for a, b in spans])
            own_origin = self.hold(points, starts[first], size[first])
            at[new], length[new] = own_at[back], own_length[back]
            origin[new] = own_origin[back]
            alike[new] = size[new] == size[first][back]
            # Of two keys for a slot the last one stays, whole: all five are set in order.
            slots = (distinct >> np.uint64(20)).astype(np.int64) & (CACHE - 1)
            self.keys[slots], self.first[slots], self.length[slots] = distinct, own_at, own_length
            self.origin[slots], self.size[slots] = own_origin, size[first]
        differs = self.held[np.repeat(origin - starts, size) + np.arange(len(points))] != points
        other = np.flatnonzero(real & ~(alike & ~np.logical_or.reduceat(differs, starts)))
        if len(other):
            spans = zip(starts[other].tolist(), stops[other].tolist(), strict=True)
            at[other], length[other] = self.remember([joined[a:b] for a, b in spans])
        total = np.cumsum(length)
        ids = self.pool[np.repeat(at - (total - length), length) + np.arange(total[-1])]
        return ids, total[np.searchsorted(starts, ends)]

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text, in order."""
        for group in slabs(texts):
            ids, ends = self.slab(group)
            yield from np.split(ids, ends[:-1])


def slabs(texts: list[str], size: int = SLAB) -> Iterator[list[str]]:
    """Consecutive texts of about `size` characters; a longer text is alone."""
    group, held = [], 0
    for text in texts:
        if group and held + len(text) > size:
            yield group
            group, held = [], 0
        group.append(text)
        held += len(text) + 1
    if group:
        yield group


def binary_column(arrays: list[np.ndarray]) -> pa.Array:
    return pa.array([a.tobytes() for a in arrays], pa.binary())


def _encode_batches(batches, ranks_path: str, pattern: str):
    encoder = None
    for batch in batches:
        encoder = encoder or Encoder(ranks_path, pattern)
        ids = list(encoder.encode(batch.column("text").to_pylist()))
        columns = [batch.column(c) for c in ("_key", "doc_id", "piece", "pieces")]
        columns += [pa.array([len(a) for a in ids], pa.int64()), binary_column(ids)]
        yield pa.RecordBatch.from_arrays(
            columns, ["_key", "doc_id", "piece", "pieces", "n_tokens", "ids"]
        )


def chunks(docs: DataFrame, size: int, overlap: int) -> DataFrame:
    """Overlapping chunks of long texts, dealt out evenly, with their boundaries in the overlaps."""

    schema = pa.schema(
        [("_key", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()),
         ("pieces", pa.int32()), ("text", pa.string())]
    )

    def cut(batches):
        for batch in batches:
            for row in batch.to_pylist():
                text = row["text"]
                count = -(-len(text) // size)
                bodies = (text[no * size : (no + 1) * size + overlap] for no in range(count))
                rows = [
                    {**row, "text": body, "piece": no, "pieces": count}
                    for no, body in enumerate(bodies)
                ]
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    def boundaries(batches):
        classes = char_classes()
        for batch in batches:
            heads, tails = [], []
            for text in batch.column("text").to_pylist():
                points = np.frombuffer((text + "\0").encode("utf-32-le"), np.uint32)
                kinds = classes[points]
                kinds[-1] = END
                starts = np.flatnonzero(token_starts(points, kinds))
                # A piece may end after white space only where its text ends.
                starts = starts[(starts > 0) & (kinds[starts - 1] != SPACE)]
                heads.append(starts[starts < overlap])
                tails.append(starts[(starts >= size) & (starts < len(text) - 4)] - size)
            columns = [batch.column(c) for c in ("_key", "doc_id", "piece", "pieces", "text")]
            kind = pa.list_(pa.int32())
            columns += [pa.array([a.tolist() for a in x], kind) for x in (heads, tails)]
            yield pa.RecordBatch.from_arrays(
                columns, ["_key", "doc_id", "piece", "pieces", "text", "head", "tail"]
            )

    plain = "_key long, doc_id long, piece int, pieces int, text string"
    return (
        docs.mapInArrow(cut, plain)
        .repartition("_key", "piece")
        .mapInArrow(boundaries, plain + ", head array<int>, tail array<int>")
    )


def stitched(cut: DataFrame, size: int) -> DataFrame:
    """Pieces between common boundaries; a text with an overlap without one is one piece."""
    order = Window.partitionBy("_key").orderBy("piece")
    joint = F.array_min(F.array_intersect("tail", F.lead("head").over(order)))
    seen = cut.withColumn("_joint", joint)
    lost = (F.col("piece") < F.col("pieces") - 1) & F.col("_joint").isNull()
    seen = seen.withColumn("_lost", F.max(lost).over(Window.partitionBy("_key"))).withColumn(
        "_from", F.coalesce(F.lag("_joint").over(order), F.lit(0))
    )
    seen = materialize(seen.drop("head", "tail"), "chunks")

    def slice_out(batches):
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                stop = len(row["text"]) if row["_joint"] is None else size + row["_joint"]
                row["text"] = row["text"][row["_from"] : stop]
            yield pa.RecordBatch.from_pylist(rows, schema=batch.schema)

    def whole(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("piece")
        text = "".join(t[:size] for t in rows["text"])
        one = rows.iloc[:1].copy()
        one["text"], one["piece"], one["pieces"] = text, 0, 1
        return one[["_key", "doc_id", "piece", "pieces", "text"]]

    names = ["_key", "doc_id", "piece", "pieces", "text"]
    plain = "_key long, doc_id long, piece int, pieces int, text string"
    good = seen.where("not _lost").mapInArrow(slice_out, seen.schema).select(*names)
    return good.unionByName(seen.where("_lost").groupBy("_key").applyInPandas(whole, plain))


def encode_parts(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    id: str = "doc_id",
    text: str = "text",
    size: int = CHUNK,
    overlap: int = OVERLAP,
) -> tuple[DataFrame, DataFrame]:
    """(short texts, long texts): as `encode`; every short text is one piece."""

    def run(batches):
        yield from _encode_batches(batches, ranks_path, pattern)

    small_batches(docs.sparkSession)
    plain = docs.select(
        F.monotonically_increasing_id().alias("_key"),
        F.col(id).cast("long").alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    long = F.length("text") > size + overlap
    short = plain.where(~long).select(
        "_key", "doc_id", F.lit(0).alias("piece"), F.lit(1).alias("pieces"), "text"
    )
    pieces = stitched(chunks(plain.where(long), size, overlap), size)
    return short.mapInArrow(lean(run), ENCODED), pieces.mapInArrow(lean(run), ENCODED)


def encode(docs: DataFrame, ranks_path: str, pattern: str, **options) -> DataFrame:
    """(_key, doc_id, piece, pieces, n_tokens, ids): ids are little-endian unsigned 32-bit.

    `_key` is one per row of `docs`; the pieces of a row, in order, are its ids.
    """
    short, long = encode_parts(docs, ranks_path, pattern, **options)
    return short.unionByName(long)


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """`encoded` with `decoded`: the bytes of each piece's ids, concatenated."""

    def run(batches):
        pool = first = length = None
        for batch in batches:
            if pool is None:
                with open(ranks_path, "rb") as lines:
                    table = {int(b): base64.b64decode(a) for a, b in map(bytes.split, lines)}
                words = [table.get(i, b"") for i in range(max(table) + 1)]
                length = np.array([len(w) for w in words])
                first = np.cumsum(length) - length
                pool = np.frombuffer(b"".join(words), np.uint8)
            out = []
            for ids in batch.column("ids").to_pylist():
                ids = np.frombuffer(ids, np.uint32)
                sizes = length[ids]
                ends = np.cumsum(sizes)
                total = ends[-1] if len(ends) else 0
                out.append(pool[np.repeat(first[ids] - (ends - sizes), sizes) + np.arange(total)])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, binary_column(out)], [*batch.schema.names, "decoded"]
            )

    return encoded.mapInArrow(lean(run), ENCODED + ", decoded binary")


def digests(short: DataFrame, long: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), one row per encoded row.

    Both frames are decoded; a row of `short` is a whole text, the pieces of a long one are
    grouped, each text by itself.
    """
    single = short.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

    def join(rows: pd.DataFrame) -> pd.DataFrame:
        import hashlib

        rows = rows.sort_values("piece")
        sums = [hashlib.sha256(b"".join(rows[c])).hexdigest() for c in ("ids", "decoded")]
        return pd.DataFrame(
            {"doc_id": rows["doc_id"].iloc[:1], "n_tokens": [rows["n_tokens"].sum()],
             "ids_sha256": sums[0], "decoded_sha256": sums[1]}
        )

    return single.unionByName(long.groupBy("_key").applyInPandas(join, single.schema))
