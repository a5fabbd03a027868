"""Near-duplicate removal: shingles, min-hash, banding, connected components."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from winnow.functions.limits import MINHASH_BANDS, MINHASH_ROWS, SHINGLE_WORDS
from winnow.functions.minhash import signature, signatures, word_hash
from winnow.functions.text import computed, folded_words, let
from winnow.operators.skew import join_totals
from winnow.session import materialize


def shingles(df: DataFrame, id: str = "id", text: str = "text", n: int = SHINGLE_WORDS):
    """(id, pos, shingle): every run of n words; none in a shorter text."""
    grams = let(
        folded_words(F.col(text)),
        lambda w: F.when(
            F.size(w) >= n,
            F.transform(
                F.sequence(F.lit(0), F.size(w) - n),
                lambda i: F.concat_ws(" ", *[F.get(w, i + k) for k in range(n)]),
            ),
        ),
    )
    return df.select(id, F.posexplode(grams).alias("pos", "shingle"))


def minhash_signature(
    df: DataFrame,
    id: str = "id",
    text: str = "text",
    bands: int = MINHASH_BANDS,
    rows: int = MINHASH_ROWS,
    n: int = SHINGLE_WORDS,
) -> DataFrame:
    """(id, sig, minima); texts with fewer than n words have no signature. Does not shuffle.

    `minima` are the values of `sig` with their tags, which tell the shingles apart.
    """

    @F.arrow_udf("array<bigint>")
    def sign(words: pa.Array) -> pa.Array:
        return signatures(words, n, bands * rows)

    hashed = F.transform(folded_words(F.col(text)), word_hash)
    signed = computed(df, "minima", sign(hashed)).where("minima is not null")
    return signed.select(id, signature(F.col("minima")).alias("sig"), "minima")


def band_keys(sigs: DataFrame, id: str = "id", rows: int = MINHASH_ROWS) -> DataFrame:
    """(id, band, key): one row per band of a signature."""
    keys = F.transform(
        F.sequence(F.lit(0), F.size("minima") - rows, F.lit(rows)),
        lambda start: F.unhex(
            F.md5(F.concat_ws(",", *[F.get(F.col("minima"), start + k).cast("string") for k in range(rows)]))
        ),
    )
    return sigs.select(id, F.posexplode(keys).alias("band", "key"))


def star_edges(bands: DataFrame, id: str = "id") -> DataFrame:
    """(src, dst): a star around the smallest id of every band bucket.

    A bucket of n texts gives n - 1 edges instead of n * (n - 1) / 2 pairs, and the stars
    connect the same texts. Give materialized bands: they are counted and read twice.
    """
    at_most = bands.count()
    buckets = (
        bands.groupBy("band", "key")
        .agg(F.min(id).alias("dst"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
    )
    members = join_totals(bands, buckets, ["band", "key"], at_most=at_most)
    return (
        members.where(F.col(id) != F.col("dst")).select(F.col(id).alias("src"), "dst").distinct()
    )


def lsh_candidates(sigs: DataFrame, id: str = "id", rows: int = MINHASH_ROWS) -> DataFrame:
    """(src, dst): texts that share a band, as stars.

    The band keys are written down, not the signatures: they take less than half the space.
    """
    return star_edges(materialize(band_keys(sigs, id, rows), "bands"), id)


def _smallest_neighbour(links: DataFrame, at_most: int) -> DataFrame:
    """(u, v, m): links with the smallest v of their u."""
    smallest = links.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("_n"))
    return join_totals(links, smallest, ["u"], at_most=at_most)


def _large_star(edges: DataFrame, size: int) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest one."""
    links = edges.select(F.col("src").alias("u"), F.col("dst").alias("v"))
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (
        _smallest_neighbour(both, 2 * size)
        .where("v > u")
        .select(F.col("v").alias("src"), F.least("m", "u").alias("dst"))
        .distinct()
    )


def _small_star(edges: DataFrame, size: int) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest one."""
    links = edges.select(F.col("src").alias("u"), F.col("dst").alias("v"))
    joined = _smallest_neighbour(links, size)
    return (
        joined.select(F.col("v").alias("src"), F.col("m").alias("dst"))
        .unionByName(joined.select(F.col("u").alias("src"), F.col("m").alias("dst")))
        .where("src != dst")
        .distinct()
    )


def _shape(edges: DataFrame) -> tuple[int, bool]:
    """(number of edges, whether every node is a root or a leaf with one edge)."""
    ends = edges.select(F.col("src").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(edges.select(F.col("dst").alias("node"), F.lit(0).alias("up"),
                                         F.lit(1).alias("down")))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    row = nodes.agg(
        F.sum("up").alias("edges"),
        F.count_if((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).alias("loose"),
    ).first()
    return row["edges"] or 0, not row["loose"]


def dedup_clusters(edges: DataFrame) -> DataFrame:
    """(id, component): every id on an edge with the smallest id it is connected to.

    Alternates large-star and small-star steps (Kiveris et al. 2014), which need about the
    logarithm of the component size in rounds. Each step is a grouped minimum and a join,
    written to shared storage, until every component is a star.
    """
    current = materialize(
        edges.where("src != dst")
        .select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
        .distinct(),
        "edges",
    )
    while True:
        size, stars = _shape(current)
        if stars:
            break
        # A large-star step replaces edges one by one, so `size` still bounds its result.
        halfway = materialize(_large_star(current, size), "large-star")
        current = materialize(_small_star(halfway, size), "small-star")
    roots = current.select(F.col("dst").alias("id"), F.col("dst").alias("component")).distinct()
    return current.select(F.col("src").alias("id"), F.col("dst").alias("component")).unionByName(
        roots
    )


def dedup_cluster_sizes(clusters: DataFrame) -> DataFrame:
    """(cluster_size, clusters)."""
    sizes = clusters.groupBy("component").agg(F.count(F.lit(1)).alias("cluster_size"))
    return sizes.groupBy("cluster_size").agg(F.count(F.lit(1)).alias("clusters"))


def text_clusters(df: DataFrame, id: str = "id", text: str = "text") -> DataFrame:
    """(id, component) of near-duplicate texts."""
    return dedup_clusters(lsh_candidates(minhash_signature(df, id, text), id))


def drop_duplicates(df: DataFrame, clusters: DataFrame, id: str = "id") -> DataFrame:
    """Keep the smallest id of every cluster and all texts outside clusters."""
    extra = clusters.where("id != component").select(F.col("id").alias(id))
    return df.join(extra, id, "left_anti")


def minhash_dedup(df: DataFrame, id: str = "id", text: str = "text") -> DataFrame:
    """Drop near-duplicates. Reads `df` twice: materialize it if it is costly to compute."""
    return drop_duplicates(df, text_clusters(df, id, text), id)
