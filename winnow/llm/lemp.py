"""Hard negatives by inner product, found with coordinate pruning in length buckets (LEMP).

Vectors are sorted by length and cut into buckets of `BUCKET`. A bucket holds, for each coordinate,
the order of its vectors by that coordinate's share of the vector's length: a sorted list. Anchors
are searched in blocks. For an anchor of length a, a score s and a bucket of lengths from `short`
to `long`, the cosine of a vector that reaches s is at least s / (a * long). Where that is over 1,
the bucket holds nothing. Otherwise, a vector at an angle of at most that cosine has, in each
coordinate, a value within a range around the anchor's own. An anchor's focus coordinates, its
largest ones, each give such a range as a stretch of the bucket's sorted list; the vectors in all
stretches are candidates, and only they are verified by exact, integer inner products. An upper
limit on the score narrows the ranges from the other side in the same way.

The search takes two passes twice over. The longest bucket gives each anchor a score that its k-th
best reaches, and all other buckets that can hold more are searched with it:

* positives, the best rows of the anchor's own label, in buckets of one label each;
* negatives, rows of other labels with scores between two shares of a positive's score, in buckets
  of all labels; all positives of an anchor are served by one look at a bucket.

Blocks of anchors meet buckets by equal lanes, and a block carries its vectors to a bucket, which
stays where it is. Labels are cut into buckets by rank, so a label with a third of all rows is many.

Rows without an id or a label and rows whose vector is null, empty or holds a null or non-finite
component take no part; shorter vectors count as continued with zeros. Repeated ids are rows of
their own: each is an anchor, a positive and a negative for others. Ties go to the smaller id, then
to one of the rows. A positive with no row in range gives none. Other columns are ignored, whatever
their names. A table without anchors gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from winnow.llm.mtree import matrix, products, whole
from winnow.llm.workers import lean
from winnow.operators.skew import ranked
from winnow.session import materialize

BUCKET = 2048  # vectors in a bucket
BLOCK = 256  # anchors searched together
FOCUS = 5  # focus coordinates of an anchor
LANE = 64  # buckets in a lane, about
LOOSE = 1e-9  # more than rounding can move a cosine

LOWEST = np.iinfo(np.int64).min
PACKED = (
    "no long, label string, longest double, n int, vectors binary, kind string, "
    "rows binary, ids binary, labels array<string>, lists binary"
)
HIT = "row long, anchor long, slot int, positive long, floor long, other_row long, other long, score long"


def narrow(vectors: np.ndarray) -> np.ndarray:
    """The same integers in as few bytes as they fit."""
    top = np.abs(vectors).max(initial=0)
    for kind, limit in (("<i2", 2**15), ("<i4", 2**31)):
        if 0 <= top < limit:
            return vectors.astype(kind)
    return vectors


def lengths(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors.astype(float) ** 2).sum(1))


def directions(vectors: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Vectors at length 1; those of length 0 stay."""
    return vectors / np.where(size > 0, size, 1.0)[:, None]


def packed(points: DataFrame, keys: list[str], size: int, width: int, lists: bool) -> DataFrame:
    """Rows of at most `size` vectors each, longest first; within `keys`, numbered from 0 by `no`."""
    order = [F.desc("square"), F.col("row")]
    cut = ranked(points.withColumn("_all", F.lit(0)), keys or ["_all"], order)
    cut = cut.withColumn("no", F.floor((F.col("_rank") - 1) / size))

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        vectors = matrix(frame["v"], width)
        far = lengths(vectors)
        small = narrow(vectors)
        sorted_lists = b""
        if lists:
            shares = directions(vectors, far)
            sorted_lists = np.argsort(shares, axis=0, kind="stable").T.astype("<i4").tobytes()
        return pd.DataFrame(
            [
                {
                    "no": frame["no"].iloc[0],
                    "label": frame["label"].iloc[0],
                    "longest": far.max(),
                    "n": len(frame),
                    "vectors": small.tobytes(),
                    "kind": small.dtype.str,
                    "rows": frame["row"].to_numpy(np.int64).tobytes(),
                    "ids": frame["vec_id"].to_numpy(np.int64).tobytes(),
                    "labels": frame["label"].tolist(),
                    "lists": sorted_lists,
                }
            ]
        )

    taken = cut.select("no", *({*keys, "label"}), "row", "vec_id", "v")
    return taken.groupBy("no", *keys).applyInPandas(pack, PACKED)


def cosines(need: np.ndarray, top: np.ndarray, own: np.ndarray, short: float, long: float):
    """(least, most) cosine between an anchor and a vector of the bucket with a score in range."""
    with np.errstate(divide="ignore", invalid="ignore"):
        least = np.where(need > 0, need / (own * long), need / (own * short))
        most = np.where(top > 0, top / (own * short), top / (own * long))
    free = own <= 0  # all its scores are 0
    least = np.where(free | np.isnan(least), -1.0, least) - LOOSE
    most = np.where(free | np.isnan(most), 1.0, most) + LOOSE
    return least, most


def feasible(share: np.ndarray, least: np.ndarray, most: np.ndarray):
    """(low, high) of a coordinate of a unit vector at a cosine in range to one that has `share`."""
    wide, close = np.arccos(np.clip(least, -1, 1)), np.arccos(np.clip(most, -1, 1))
    own = np.arccos(np.clip(share, -1, 1))
    # cos(angle - own) is largest nearest to own, cos(angle + own) smallest nearest to pi - own.
    high = np.cos(np.clip(own, close, wide) - own)
    low = np.cos(np.clip(np.pi - own, close, wide) + own)
    return low - LOOSE, high + LOOSE


class Bucket:
    """A bucket of vectors with its sorted lists."""

    def __init__(self, row: dict, width: int):
        self.vectors = np.frombuffer(row["vectors"], row["kind"]).reshape(-1, width).astype(np.int64)
        self.rows = np.frombuffer(row["rows"], np.int64)
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.labels = row["labels"]
        self.lists = np.frombuffer(row["lists"], "<i4").reshape(width, -1)
        size = lengths(self.vectors)
        self.short, self.long = float(size.min()), float(size.max())
        self.shares = directions(self.vectors, size)
        self.sorted: dict[int, np.ndarray] = {}

    def values(self, coordinate: int) -> np.ndarray:
        """The sorted list of a coordinate."""
        if coordinate not in self.sorted:
            self.sorted[coordinate] = self.shares[self.lists[coordinate], coordinate]
        return self.sorted[coordinate]

    def candidates(self, focus: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The vectors within the ranges of all focus coordinates: the shortest stretch, then the others."""
        begin = [self.values(f).searchsorted(a, "left") for f, a in zip(focus, low, strict=True)]
        end = [self.values(f).searchsorted(b, "right") for f, b in zip(focus, high, strict=True)]
        first = int(np.argmin(np.subtract(end, begin)))
        found = self.lists[focus[first], begin[first] : end[first]]
        for i, f in enumerate(focus):
            if i != first and len(found) and end[i] - begin[i] < len(self.ids):
                share = self.shares[found, f]
                found = found[(share >= low[i]) & (share <= high[i])]
        return found


def best(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties by id, then row."""
    if len(scores) > 4 * k:
        kept = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        return kept[np.lexsort([rows[kept], ids[kept], ~scores[kept]])[:k]]
    return np.lexsort([rows, ids, ~scores])[:k]


def search(block: dict, bucket: Bucket, width: int, k: int, same: bool) -> list[tuple]:
    """Hits of the asked ranges of a block of anchors in a bucket, the k best of each."""
    vectors = np.frombuffer(block["vectors"], block["kind"]).reshape(-1, width).astype(np.int64)
    rows, ids = np.frombuffer(block["rows"], np.int64), np.frombuffer(block["ids"], np.int64)
    asked = np.frombuffer(block["asked"], np.int64).reshape(-1, 6)
    own = lengths(vectors)
    shares = directions(vectors, own)
    need, top = asked[:, 4], asked[:, 5]
    # The ranges of one anchor are looked for at once, then told apart by exact scores.
    starts = np.flatnonzero(np.append(True, asked[1:, 0] != asked[:-1, 0]))
    ends = np.append(starts[1:], len(asked))
    who = asked[starts, 0]
    floor, ceiling = np.minimum.reduceat(need, starts), np.maximum.reduceat(top, starts)
    least, most = cosines(
        floor.astype(float), ceiling.astype(float), own[who], bucket.short, bucket.long
    )
    focus = np.argsort(-np.abs(shares), axis=1, kind="stable")[:, :FOCUS]
    labels = np.array(bucket.labels, object)
    other = labels != block["label"]
    hits = []
    for i in np.flatnonzero((least <= 1) & (most >= -1) & (least <= most)):
        anchor = who[i]
        spots = focus[anchor]
        low, high = feasible(shares[anchor, spots], least[i], most[i])
        found = bucket.candidates(spots, low, high)
        found = found[(bucket.rows[found] != rows[anchor]) if same else other[found]]
        if not len(found):
            continue
        scores = products(vectors[anchor][None, :], bucket.vectors[found])[0]
        for at in range(starts[i], ends[i]):
            fits = np.flatnonzero((scores >= need[at]) & (scores <= top[at]))
            chosen = found[fits]
            taken = best(scores[fits], bucket.ids[chosen], bucket.rows[chosen], k)
            _, slot, positive, reach, _, _ = asked[at].tolist()
            hits += [
                (int(rows[anchor]), int(ids[anchor]), slot, positive, reach, int(r), int(n), int(s))
                for r, n, s in zip(
                    bucket.rows[chosen[taken]], bucket.ids[chosen[taken]], scores[fits][taken],
                    strict=True,
                )
            ]
    return hits


def searched(pairs: DataFrame, width: int, k: int, same: bool) -> DataFrame:
    """The hits of blocks in buckets; `pairs` holds both."""
    mine = ["label", "vectors", "kind", "rows", "ids", "asked"]
    theirs = ["vectors", "kind", "rows", "ids", "labels", "lists"]
    flat = pairs.select("lane", "no", *[F.col(f"b_{c}") for c in mine], *theirs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, bucket = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                one = batch.slice(row, 1).to_pylist()[0]
                here = (one["rows"], one["ids"])
                if here != last:
                    last, bucket = here, Bucket(one, width)
                block = {c: one[f"b_{c}"] for c in mine}
                hits = search(block, bucket, width, k, same)
                columns = list(zip(*hits, strict=True)) or [()] * 8
                names = [c.split()[0] for c in HIT.split(", ")]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(c, pa.int32() if n == "slot" else pa.int64())
                        for c, n in zip(columns, names, strict=True)
                    ],
                    names,
                )

    return flat.mapInArrow(lean(run), HIT)


def reached(blocks: DataFrame, asked: DataFrame, width: int) -> DataFrame:
    """Blocks with what their anchors ask for, and the least length of a vector that can serve them.

    `asked` has row, slot, positive, floor, need and top; anchors that ask for nothing stay out.
    """
    spots = blocks.select("block", F.posexplode(F.col("row_list")).alias("at", "row"))
    needs = asked.join(spots, "row").groupBy("block").agg(
        F.array_sort(F.collect_list(F.struct("at", "slot", "positive", "floor", "need", "top"))).alias("list")
    )

    def pack(frames):
        for frame in frames:
            out, reach = [], []
            for vectors, kind, wanted in zip(frame["vectors"], frame["kind"], frame["list"], strict=True):
                table = np.array([[r[c] for c in ("at", "slot", "positive", "floor", "need", "top")] for r in wanted])
                own = lengths(np.frombuffer(vectors, kind).reshape(-1, width))[table[:, 0]]
                need = table[:, 4].astype(float)
                bound = np.where((need > 0) & (own > 0), need / np.where(own > 0, own, 1), 0.0)
                bound = np.where((need > 0) & (own <= 0), np.inf, bound)  # scores of 0 alone
                out.append(table.astype(np.int64).tobytes())
                reach.append(float(bound.min()) * (1 - LOOSE))
            frame["asked"], frame["reach"] = out, reach
            yield frame[["block", "asked", "reach"]]

    known = blocks.select("block", "vectors", "kind").join(needs, "block")
    packed_needs = known.mapInPandas(pack, "block long, asked binary, reach double")
    return materialize(blocks.drop("row_list").join(packed_needs, "block"), "asking-blocks")


def met(blocks: DataFrame, buckets: DataFrame, lanes: int, first: bool, same: bool) -> DataFrame:
    """Blocks of anchors beside the buckets that they search: the first one, or the others in reach."""
    spots = buckets.select("no", "label", "longest", "lane")
    wanted = (F.col("no") == 0) if first else (F.col("no") > 0)
    sides = [F.col(c).alias(f"b_{c}") for c in blocks.columns if c != "block"]
    asking = blocks.select("block", F.col("label").alias("_label"), "reach")
    if same:
        pairs = asking.join(spots.where(wanted), F.col("_label") == F.col("label"))
        pairs = pairs.withColumn("_key", F.col("label"))
    else:
        # A row for each block of anchors and lane of buckets.
        every = asking.withColumn("lane", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lanes - 1).cast("long"))))
        pairs = every.join(spots.where(wanted), "lane").withColumn("_key", F.lit(""))
    pairs = pairs.where("longest >= reach").select("block", "_key", "no")
    carried = pairs.join(blocks.select("block", *sides), "block").drop("block")
    held = buckets.withColumn("_key", F.col("label") if same else F.lit(""))
    return carried.join(held, ["_key", "no"])


def top_hits(hits: DataFrame, k: int) -> DataFrame:
    """The k best hits of each anchor and slot, ranked; cut before the shuffle too."""
    order = Window.partitionBy("row", "slot").orderBy(F.desc("score"), "other", "other_row")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def both_passes(
    blocks: DataFrame, asked: DataFrame, buckets: DataFrame, lanes: int, width: int, k: int, same: bool
) -> DataFrame:
    """The k best hits for everything asked."""

    def hits(wanted: DataFrame, first: bool) -> DataFrame:
        asking = reached(blocks, wanted, width)
        return searched(met(asking, buckets, lanes, first, same), width, k, same)

    early = materialize(hits(asked, True), "first-hits")
    kth = top_hits(early, k).where(F.col("rank") == k).select("row", "slot", F.col("score").alias("_kth"))
    raised = asked.join(kth, ["row", "slot"], "left").withColumn(
        "need", F.greatest("need", F.coalesce("_kth", "need"))
    )
    late = hits(raised.drop("_kth"), False)
    return materialize(top_hits(early.unionByName(late), k), "hits")


def hard_negatives(
    df: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = 256,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    For each anchor and each of its best `positives` rows of its label, the best `negatives` rows of
    other labels with scores from `low` to `high` percent of the positive's.
    """
    out = (
        "anchor_id long, positive_id long, rank int, negative_id long, "
        "positive_score long, negative_score long"
    )
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    points = materialize(
        df.select(
            F.col(id).cast("long").alias("vec_id"),
            F.col(label).cast("string").alias("label"),
            whole(F.col(vector), scale).alias("v"),
            F.coalesce(anchors, F.lit(False)).alias("asked"),
        )
        .where("v is not null and vec_id is not null and label is not null")
        .withColumn("square", square)
        .withColumn("row", F.monotonically_increasing_id()),
        "vectors",
    )
    facts = points.agg(
        F.max(F.size("v")).alias("width"), F.count_if("asked").alias("asked"), F.count("*").alias("n")
    ).first()
    if not facts["asked"]:
        return df.sparkSession.createDataFrame([], out)
    width = facts["width"]
    lanes = max(1, facts["n"] // (BUCKET * LANE))
    lane = F.pmod(F.xxhash64("label", "no"), F.lit(lanes)).cast("long")
    own = materialize(packed(points, ["label"], BUCKET, width, True).withColumn("lane", lane), "label-buckets")
    every = materialize(packed(points, [], BUCKET, width, True).withColumn("lane", lane), "buckets")

    @F.arrow_udf("array<long>")
    def longs(data: pa.Array) -> pa.Array:
        return pa.array([np.frombuffer(d, np.int64) for d in data.to_pylist()], pa.list_(pa.int64()))

    blocks = packed(points.where("asked"), ["label"], BLOCK, width, False)
    blocks = materialize(
        blocks.drop("labels", "lists", "no", "longest", "n")
        .withColumn("block", F.monotonically_increasing_id())
        .withColumn("row_list", longs("rows")),
        "anchor-blocks",
    )
    none = F.lit(int(LOWEST) + 1).cast("long")
    asked = points.where("asked").select(
        "row",
        F.lit(0).alias("slot"),
        F.lit(-1).cast("long").alias("positive"),
        none.alias("floor"),
        none.alias("need"),
        F.lit(2**63 - 1).cast("long").alias("top"),
    )
    found = both_passes(blocks, asked, own, lanes, width, positives, True)
    # From low to high percent of the score, rounded inwards in integers.
    least = F.expr(f"score div 100 * {low} + ceil((score % 100) * {low} / 100.0D)")
    most = F.expr(f"score div 100 * {high} + floor((score % 100) * {high} / 100.0D)")
    ranges = found.select(
        "row",
        F.col("rank").alias("slot"),
        F.col("other").alias("positive"),
        F.col("score").alias("floor"),
        least.cast("long").alias("need"),
        most.cast("long").alias("top"),
    ).where("need <= top")
    mined = both_passes(blocks, ranges, every, lanes, width, negatives, False)
    return mined.select(
        F.col("anchor").alias("anchor_id"),
        F.col("positive").alias("positive_id"),
        "rank",
        F.col("other").alias("negative_id"),
        F.col("floor").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
