"""Near-duplicate texts by min-hash bands, with candidates verified batch by batch (BayesLSH).

A text's set of word shingles has a signature of `BANDS * ROWS` min-hashes. Texts that agree in a
band are candidates; at a similarity of 0.8 a pair shares none of 32 bands of 5 with a probability
of 3e-6. A candidate pair compares its signatures in batches of `BATCH`: with a uniform prior, m
agreements in n hashes leave the similarity a beta distribution, and the pair is dropped as soon as
it reaches the threshold with less than `MISS`. What survives all batches is verified on the full
sets, so a wrong link is never made.

Equal sets are one set first. A band's texts are not paired with each other:

1. Each meets one centre of its band, and then those outside the largest component of a band meet
   a centre of that one. A group of near copies costs about one pair for each copy.
2. Bands that are still in several components are searched in tiles of about `TILE` by `TILE` texts:
   texts outside the band's largest component against all others. A tile compares signatures as
   matrices, leaves a pair to the first band that it shares, and returns its surviving pairs as one
   work item. An item meets the full sets of its texts and returns links, at most one less than
   texts: pairs that its links connect already are not verified again. So no pairs of a group are
   emitted, and every link between different components is found.

Words are runs without ASCII white space; A-Z is lower-cased. A text with fewer words than a
shingle is one shingle; one without words has none and is linked with nothing. Rows without an id
are kept, and take no part in links; rows with one id are one node, each with its own text. Other
columns are ignored, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from winnow.llm.ngram_join import overlaps
from winnow.llm.periodic_runs import pair_hash, scrambled
from winnow.llm.workers import give_back, lean, lean_group
from winnow.operators.dedup import dedup_clusters
from winnow.operators.skew import join_totals
from winnow.session import materialize

SHINGLE = 2
PERCENT = 80
BANDS, ROWS = 32, 5
BATCH = 32  # hashes compared at once
MISS = 1e-6  # chance, at most, that a pair that reaches the threshold is dropped by a batch
TILE = 256
SLAB = 1 << 17  # words hashed at once, unless one text has more
SLICE = 1 << 16  # pairs of one centre in a slice, about

HASHES = BANDS * ROWS
KEY = b"shingle words"  # of the word hash

SIGNED = "doc long, n long, key binary, sig binary"
LINK = "a long, b long"


def least_agreements(percent: int) -> list[tuple[int, int]]:
    """(hashes compared, fewest agreements to go on) after each batch.

    The chance that the similarity is at least t after m agreements in n is that of at most m
    successes in n + 1 trials of chance t.
    """
    t, out = percent / 100, []
    for n in range(BATCH, HASHES + 1, BATCH):
        chance, m = 0.0, -1
        while chance < MISS:
            m += 1
            chance += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append((n, m))
    return out


def multipliers() -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and offsets of the hash functions."""
    numbers = scrambled(np.arange(1, 2 * HASHES + 1, dtype=np.uint64))
    halves = (numbers >> np.uint64(32)).astype(np.uint32)
    return halves[:HASHES] | np.uint32(1), halves[HASHES:]


class Words(dict):
    """64-bit keyed hashes of words, each computed once."""

    def __missing__(self, word: bytes) -> int:
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8, key=KEY).digest(), "little")
        self[word] = value
        return value


def slabs(texts: list[bytes | None]) -> Iterator[list[list[bytes]]]:
    held, size = [], 0
    for text in texts:
        words = text.lower().split() if text else []  # of bytes: ASCII alone
        if held and size + len(words) > SLAB:
            yield held
            held, size = [], 0
        held.append(words)
        size += len(words)
    if held:
        yield held


def shingle_sets(texts: list[list[bytes]], size: int, known: Words) -> list[np.ndarray]:
    """The sorted hashes of the distinct shingles of each text."""
    if len(known) > 1 << 20:
        known.clear()
    sets = []
    for words in texts:
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        if len(words) >= size:
            value = hashes[: len(words) - size + 1]
            for i in range(1, size):
                value = pair_hash(value, hashes[i : len(words) - size + 1 + i])
            sets.append(np.unique(value))
        elif len(words):
            value = np.full(1, len(words), np.uint64)
            for i in range(len(words)):
                value = pair_hash(value, hashes[i : i + 1])
            sets.append(value)
        else:
            sets.append(hashes)
    return sets


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """A row of min-hashes for each set, none of them empty."""
    factors, offsets = multipliers()
    flat = (scrambled(np.concatenate(sets)) >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), HASHES), np.uint32)
    for i in range(HASHES):
        out[:, i] = np.minimum.reduceat(flat * factors[i] + offsets[i], starts)
    return out


def set_key(one: np.ndarray) -> bytes:
    return hashlib.blake2b(one.tobytes(), digest_size=16).digest()


def signed(docs: DataFrame, size: int) -> DataFrame:
    """(doc, n, key, sig): the size of each row's set, a name of the set and its min-hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        for batch in batches:
            at = 0
            for held in slabs(batch.column(1).cast(pa.binary()).to_pylist()):
                sets = shingle_sets(held, size, known)
                filled = [i for i, s in enumerate(sets) if len(s)]
                keys: list = [None] * len(sets)
                sigs: list = [None] * len(sets)
                if filled:
                    rows = signatures([sets[i] for i in filled])
                    for i, row in zip(filled, rows, strict=True):
                        keys[i], sigs[i] = set_key(sets[i]), row.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(held)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(keys, pa.binary()),
                        pa.array(sigs, pa.binary()),
                    ],
                    ["doc", "n", "key", "sig"],
                )
                at += len(held)

    return docs.mapInArrow(lean(run), SIGNED)


def band_hashes(sigs: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each band of each signature."""
    rows = sigs.reshape(-1, BANDS, ROWS).astype(np.uint64)
    value = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), rows.shape[:2])
    for i in range(ROWS):
        value = pair_hash(value, rows[:, :, i])
    return value.view(np.int64)


def bands(sets: DataFrame) -> DataFrame:
    """(h, band, doc, key) of each band of each set."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sigs = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint32)
            hashes = band_hashes(sigs.reshape(-1, HASHES))
            index = pa.array(np.repeat(np.arange(batch.num_rows), BANDS))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hashes.ravel()),
                    pa.array(np.tile(np.arange(BANDS, dtype=np.int32), batch.num_rows)),
                    batch.column("doc").take(index),
                    batch.column("key").take(index),
                ],
                ["h", "band", "doc", "key"],
            )

    return sets.select("doc", "key", "sig").mapInArrow(
        lean(run), "h long, band int, doc long, key binary"
    )


def both_sides(pairs: DataFrame, table: DataFrame, columns: list[str]) -> DataFrame:
    """Pairs (a, b) of keys with columns of `table` for both; a key may be in any share of all pairs.

    `a` is the common side. Its pairs are sliced, and its row goes to the slices that it is in.
    """
    slices = 1 + pairs.count() // SLICE
    sliced = pairs.withColumn("_slice", F.pmod(F.xxhash64("b"), F.lit(slices)))
    one = [F.col(c).alias(f"a_{c}") for c in columns]
    other = [F.col(c).alias(f"b_{c}") for c in columns]
    centres = sliced.select("a", "_slice").distinct()
    centres = centres.join(table.select(F.col("key").alias("a"), *one), "a")
    return sliced.join(table.select(F.col("key").alias("b"), *other), "b").join(centres, ["a", "_slice"])


def survivors(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The candidates (a, b) that no batch of their signatures drops."""
    steps = least_agreements(percent)

    def run(batches):
        for batch in batches:
            sizes = [batch.column(c).to_numpy() for c in ("a_n", "b_n")]
            left = np.flatnonzero(near_sizes(*sizes, percent))
            sides = [
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, HASHES)
                for c in ("a_sig", "b_sig")
            ]
            agreed = np.zeros(len(left), np.int64)
            for n, least in steps:
                one, other = (s[left, n - BATCH : n] for s in sides)
                agreed += (one == other).sum(1)
                left, agreed = left[agreed >= least], agreed[agreed >= least]
            where = pa.array(left)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(where) for c in ("a", "b")], ["a", "b"]
            )

    met = both_sides(pairs, sets, ["n", "sig"]).select("a", "b", "a_n", "b_n", "a_sig", "b_sig")
    return met.mapInArrow(run, "a binary, b binary")


def near_sizes(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of two sizes can reach the threshold."""
    return np.minimum(a, b) * 100 >= np.maximum(a, b) * percent


def full_sets(docs: DataFrame, sets: DataFrame, keys: DataFrame, size: int) -> DataFrame:
    """(key, set) of the wanted keys, from their texts."""
    wanted = keys.join(sets.select("key", "doc"), "key")
    texts = docs.join(wanted.select(F.col("doc").alias("_doc")).distinct(), F.col("_id") == F.col("_doc"), "left_semi")

    def run(batches):
        known = Words()
        for batch in batches:
            for held in slabs(batch.column(0).cast(pa.binary()).to_pylist()):
                found = [s for s in shingle_sets(held, size, known) if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([set_key(s) for s in found], pa.binary()),
                        pa.array([s.tobytes() for s in found], pa.binary()),
                    ],
                    ["key", "set"],
                )

    rows = texts.select("_text").mapInArrow(lean(run), "key binary, set binary")
    # Rows of one id may repeat a text or have another one.
    return rows.groupBy("key").agg(F.first("set").alias("set")).join(keys, "key", "left_semi")


def verified(pairs: DataFrame, docs: DataFrame, sets: DataFrame, size: int, percent: int) -> DataFrame:
    """The written pairs whose full sets reach the threshold."""
    keys = pairs.select(F.col("a").alias("key")).union(pairs.select(F.col("b").alias("key"))).distinct()
    full = materialize(full_sets(docs, sets, keys, size), "full-sets")

    def run(batches):
        for batch in batches:
            near = []
            for a, b in zip(batch.column("a_set"), batch.column("b_set"), strict=True):
                one, other = (np.frombuffer(x.as_buffer(), np.uint64) for x in (a, b))
                both = len(np.intersect1d(one, other, assume_unique=True))
                near.append(100 * both >= percent * (len(one) + len(other) - both))
            where = pa.array(np.flatnonzero(near))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(where) for c in ("a", "b")], ["a", "b"]
            )

    met = both_sides(pairs, full, ["set"]).select("a", "b", "a_set", "b_set")
    return met.mapInArrow(lean(run), "a binary, b binary")


def torn(members: DataFrame, sets: DataFrame, groups: DataFrame) -> DataFrame:
    """Members of bands in several components, with their component and the band's largest one."""
    of = sets.select("key", "doc").join(groups, F.col("doc") == F.col("id"), "left")
    of = of.select("key", F.coalesce("component", "doc").alias("component"))
    known = materialize(members.join(of, "key"), "members-known")
    sizes = known.groupBy("h", "band", "component").agg(F.count("*").alias("_size"))
    home = (
        sizes.groupBy("h", "band")
        .agg(
            F.max(F.struct("_size", "component")).alias("_top"),
            F.count("*").alias("_kinds"),
            F.sum("_size").alias("_n"),
        )
        .where("_kinds > 1 and _n > 2")  # a pair alone has met
        .select(
            "h", "band", F.col("_top.component").alias("home"), "_n",
            (F.col("_n") - F.col("_top._size")).alias("_rest"), F.col("_n").alias("_all"),
        )
    )
    return materialize(join_totals(known, home, ["h", "band"]), "torn-bands")


def linked_docs(links: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between sets as links between the documents that stand for them."""
    docs = sets.select("key", "doc")
    one = docs.select(F.col("key").alias("b"), F.col("doc").alias("_b"))
    other = docs.select(F.col("key").alias("a"), F.col("doc").alias("_a"))
    met = links.join(one, "b").join(other, "a")
    return met.select(F.col("_a").alias("a"), F.col("_b").alias("b")).where("a != b")


def star(pairs: DataFrame, docs: DataFrame, sets: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b) documents: candidates that pass all batches and the full sets."""
    near = materialize(pairs.where("a != b").distinct(), "candidates")
    left = materialize(survivors(near, sets, percent), "survivors")
    return materialize(linked_docs(verified(left, docs, sets, size, percent), sets), "links")


def tile_items(torn_bands: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(item, keys, pairs, components) of each tile with surviving pairs."""
    steps = least_agreements(percent)
    rest = F.greatest(F.lit(1), F.ceil(F.col("_rest") / TILE)).cast("long")
    every = F.greatest(F.lit(1), F.ceil(F.col("_all") / TILE)).cast("long")
    spot = F.xxhash64("key")
    zero = F.lit(0).cast("long")
    rows = torn_bands.select("h", "band", "key", "component", "home", spot.alias("_s"), rest.alias("_r"), every.alias("_e"))
    few = rows.where("component != home").select(
        "*", F.pmod("_s", "_r").alias("i"), F.explode(F.sequence(zero, F.col("_e") - 1)).alias("j"), F.lit(True).alias("few")
    )
    others = rows.select(
        "*", F.explode(F.sequence(zero, F.col("_r") - 1)).alias("i"), F.pmod("_s", "_e").alias("j"), F.lit(False).alias("few")
    )
    placed = few.unionByName(others).select(
        "h", "band", "i", "j", "few", "key", "component", "_s", (F.col("component") != F.col("home")).alias("outside")
    )
    met = placed.join(sets.select("key", "n", "sig"), "key")
    places = max(1, torn_bands.count() // (16 * TILE))
    met = met.withColumn("_place", F.pmod(F.xxhash64("h", "band", "i", "j"), F.lit(places)))

    def tile(frame: pd.DataFrame) -> dict | None:
        sides = []
        for few in (True, False):
            part = frame[frame["few"] == few].sort_values("key")
            sig = np.frombuffer(b"".join(part["sig"]), np.uint32).reshape(-1, HASHES)
            sides.append((*(part[c].to_numpy() for c in ("key", "component", "n", "_s", "outside")), sig))
        (ka, ca, na, ha, _, sa), (kb, cb, nb, hb, outside, sb) = sides
        if not len(ka) or not len(kb):
            return None
        open_pairs = (ca[:, None] != cb[None, :]) & near_sizes(na[:, None], nb[None, :], percent)
        # Two texts outside the largest component also meet the other way round.
        open_pairs &= ~(outside[None, :] & (ha[:, None] > hb[None, :]))
        one, other = np.nonzero(open_pairs)
        agreed = np.zeros(len(one), np.int64)
        for n, least in steps:
            agreed += (sa[one, n - BATCH : n] == sb[other, n - BATCH : n]).sum(1)
            keep = agreed >= least
            one, other, agreed = one[keep], other[keep], agreed[keep]
        if not len(one):
            return None
        band = int(frame["band"].iloc[0])
        rows = lambda s, w: s[w].reshape(-1, BANDS, ROWS)[:, :band]
        earlier = (rows(sa, one) == rows(sb, other)).all(2).any(1)
        one, other, agreed = one[~earlier], other[~earlier], agreed[~earlier]
        if not len(one):
            return None
        keys = np.concatenate([ka, kb])
        parts = np.concatenate([ca, cb])
        # Best first: links found early spare the verification of later pairs.
        order = np.argsort(-agreed, kind="stable")
        pairs = np.column_stack([one[order], other[order] + len(ka)])
        used, pairs = np.unique(pairs, return_inverse=True)
        return {
            "keys": [keys[k] for k in used],
            "components": parts[used].tolist(),
            "pairs": pairs.reshape(-1, 2).astype("<i4").tobytes(),
        }

    def place(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["h", "band", "i", "j"], ignore_index=True)
        mark = frame[["h", "band", "i", "j"]].to_numpy()
        cut = np.flatnonzero((mark[1:] != mark[:-1]).any(1)) + 1
        found = []
        for a, b in zip(np.append(0, cut), np.append(cut, len(frame)), strict=True):
            item = tile(frame.iloc[a:b])
            if item is not None:
                found.append(item)
        return pd.DataFrame(found, columns=["keys", "components", "pairs"])

    grouped = met.groupBy("_place").applyInPandas(
        lean_group(place), "keys array<binary>, components array<long>, pairs binary"
    )
    return materialize(grouped.withColumn("item", F.monotonically_increasing_id()), "items")


def item_links(sets: list[np.ndarray], components: list[int], pairs: np.ndarray, percent: int):
    """Verified pairs that join components of an item, at most one less than components."""
    root = {c: c for c in components}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    sizes = np.array([len(s) for s in sets])
    links = []
    step = 4 * len(sets)
    at = 0
    while at < len(pairs):
        chunk = pairs[at : at + step]
        at, step = at + step, 4 * step
        chunk = chunk[[find(components[a]) != find(components[b]) for a, b in chunk.tolist()]]
        if not len(chunk):
            continue
        both = overlaps(sets, chunk)
        near = 100 * both >= percent * (sizes[chunk].sum(1) - both)
        for a, b in chunk[near].tolist():
            x, y = find(components[a]), find(components[b])
            if x != y:
                root[max(x, y)] = min(x, y)
                links.append((x, y))
    return links


def tile_links(items: DataFrame, docs: DataFrame, sets: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b) components that verified pairs of the items join."""
    keys = items.select(F.explode("keys").alias("key")).distinct()
    full = materialize(full_sets(docs, sets, keys, size), "full-sets")
    each = items.select("item", F.posexplode("keys").alias("at", "key")).join(full, "key")
    each = each.select(F.col("item").alias("_item"), "at", "set")

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return pd.DataFrame([], columns=["a", "b"])
        found = dict(zip(right["at"].tolist(), right["set"], strict=True))
        held = [np.frombuffer(found[i], np.uint64) for i in range(len(found))]
        pairs = np.frombuffer(left["pairs"].iloc[0], "<i4").reshape(-1, 2)
        components = [int(c) for c in left["components"].iloc[0]]
        links = item_links(held, components, pairs, percent)
        give_back()
        return pd.DataFrame(links, columns=["a", "b"])

    asked = items.select("item", "components", "pairs").groupBy("item")
    return asked.cogroup(each.groupBy("_item")).applyInPandas(run, LINK)


def near_duplicates(
    df: DataFrame,
    size: int = SHINGLE,
    percent: int = PERCENT,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row; the component's smallest id."""
    docs = df.select(F.col(id).cast("long").alias("_id"), F.col(text).alias("_text"))
    rows = materialize(signed(docs, size), "signatures")
    sets = materialize(
        rows.where("key is not null and doc is not null")
        .groupBy("key")
        .agg(F.min("doc").alias("doc"), F.first("n").alias("n"), F.first("sig").alias("sig")),
        "sets",
    )
    # Texts of one id belong together, also where others stand for them.
    each = rows.select("doc", "n", "key").join(
        sets.select("key", F.col("doc").alias("rep")), "key", "left"
    )
    each = materialize(each.select("doc", "n", F.coalesce("rep", "doc").alias("rep")), "rows")
    several = each.where("doc is not null and n > 0").groupBy("doc")
    several = several.agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low != high")
    own = each.join(several.select("doc"), "doc", "left_semi").where("doc != rep and n > 0")
    own = own.select(F.col("rep").alias("a"), F.col("doc").alias("b")).distinct()

    keyed = bands(sets)
    centres = keyed.groupBy("h", "band").agg(
        F.min(F.struct("doc", "key")).alias("_c"), F.count("*").alias("_n")
    )
    centres = centres.where("_n > 1").select("h", "band", F.col("_c.key").alias("centre"), "_n")
    members = materialize(join_totals(keyed, centres, ["h", "band"]).drop("doc"), "members")
    first = star(members.select(F.col("centre").alias("a"), F.col("key").alias("b")), docs, sets, size, percent)
    links = first.unionByName(own)
    members = members.select("h", "band", "key")
    groups = materialize(clusters(links), "groups")

    apart = torn(members, sets, groups)
    home = apart.where("component = home").groupBy("h", "band").agg(
        F.min("key").alias("a"), F.max("_all").alias("_n")
    )
    outside = apart.where("component != home").select("h", "band", F.col("key").alias("b"))
    second = star(join_totals(outside, home, ["h", "band"]).select("a", "b"), docs, sets, size, percent)
    links = links.unionByName(second)
    groups = materialize(clusters(links), "groups")

    apart = torn(members, sets, groups)
    items = tile_items(apart, sets, percent)
    last = materialize(tile_links(items, docs, sets, size, percent), "links")
    groups = clusters(links.unionByName(last))

    named = each.join(groups, F.col("rep") == F.col("id"), "left")
    return named.select(
        F.col("doc").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc").isNotNull(), F.coalesce("component", "rep")).alias("component_id"),
        F.coalesce(F.col("doc") == F.coalesce("component", "rep"), F.lit(True)).alias("kept"),
    )


def clusters(links: DataFrame) -> DataFrame:
    return dedup_clusters(links.select(F.col("a").alias("src"), F.col("b").alias("dst")))
