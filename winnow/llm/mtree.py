"""Exact search for the highest inner products with an M-tree.

With one more component, sqrt(M**2 - |v|**2) for a vector and 0 for a query, the vectors with the
highest inner products are the nearest ones: |q - v'|**2 = |q|**2 + M**2 - 2 q.v. The tree is over
these distances. The root routes to pivots, drawn from a bounded sample; a pivot's vectors are cut
into subtrees of bounded size by a hash, so a vector with a third of all rows fills several; a
subtree holds leaf pages. Routing objects carry covering radii, entries their distance to their
parent.

A block of queries first searches its nearest subtrees, in order of their least possible distance,
which gives every query a distance that its k-th neighbour is within. Only subtrees that can hold
something nearer are sent to the block in the second step. Inside a subtree pages are taken best
first; the triangle inequality over stored parent distances passes over pages and entries before
any distance to them is computed. Scores are computed exactly, in integers.

Vectors that are null, empty or hold nulls or non-finite components take no part; shorter vectors
count as continued with zeros. Repeated ids are candidates of their own, except that a query meets no
row with its own id. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from winnow.session import materialize

PIVOTS = 64  # at most; one for 4096 vectors
SAMPLE = 8192  # rows the pivots are drawn from, by hash
SUBTREE = 8192  # vectors in a subtree, about
PAGE = 256  # vectors in a leaf page
BLOCK = 2048  # queries searched together
FIRST = 2  # subtrees a query block searches first

NONE = np.iinfo(np.int64).min  # the score of a place that nothing fills yet

POINTS = "node long, part long, parent double, vec_id long, v array<bigint>"


def whole(vector: Column, scale: int) -> Column:
    """Components as floor(scale * x); null unless all are finite."""
    numbers = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(numbers, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(False))
    return F.when(good, F.transform(numbers, lambda x: F.floor(x * scale)))


def matrix(vectors, width: int) -> np.ndarray:
    """Integer vectors as rows; exact in doubles while sums of products stay below 2 ** 53."""
    out = np.zeros((len(vectors), width), np.int64)
    for i, vector in enumerate(vectors):
        out[i, : len(vector)] = vector
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two integer matrices."""
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if bound < 2**53:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    return a @ b.T


def lifted(vectors: np.ndarray, top: float) -> np.ndarray:
    """Vectors with the component that makes all of them equally long."""
    plain = vectors.astype(float)
    rest = np.sqrt(np.maximum(top - (plain * plain).sum(1), 0))
    return np.column_stack([plain, rest])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def slack(top: float) -> float:
    """More than rounding can change a distance: bounds are loosened by it."""
    return 1e-5 * (1 + np.sqrt(top))


def apart(points: np.ndarray, wanted: int) -> list[int]:
    """Pivots far from each other: each next one is the farthest from those before."""
    chosen = [0]
    nearest = distances(points, points[:1])[:, 0]
    while len(chosen) < wanted:
        far = int(nearest.argmax())
        if nearest[far] <= 0:
            break
        chosen.append(far)
        nearest = np.minimum(nearest, distances(points, points[far : far + 1])[:, 0])
    return chosen


class Index:
    """Subtrees of the tree as rows of a written table, and what routes to them."""

    def __init__(self, vectors: DataFrame, top: float, width: int):
        """`vectors` has vec_id and v (integers), written; `top` is the largest squared length."""
        self.top, self.width = top, width
        rows = vectors.count()
        wanted = min(PIVOTS, max(1, rows // 4096))
        sample = [
            r["v"]
            for r in vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(min(SAMPLE, 64 * wanted)).collect()
        ]
        points = lifted(matrix(sample, width), top)
        pivots = points[apart(points, wanted)]
        self.subtrees = self._build(vectors, pivots)
        self.routes = (
            self.subtrees.groupBy("node", "part")
            .agg(F.max("radius").alias("radius"), F.sum("n").alias("n"))
            .withColumn("_id", F.concat_ws("-", "node", "part"))
        )
        self.pivots = pivots

    def _build(self, vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
        top, width = self.top, self.width

        def assign(frames):
            for frame in frames:
                far = distances(lifted(matrix(frame["v"], width), top), pivots)
                frame["node"] = far.argmin(1)
                frame["parent"] = far.min(1)
                frame["part"] = 0
                yield frame[["node", "part", "parent", "vec_id", "v"]]

        assigned = materialize(
            vectors.select("vec_id", "v").mapInPandas(assign, POINTS), "assigned"
        )
        sizes = assigned.groupBy("node").agg(F.ceil(F.count("*") / F.lit(SUBTREE)).alias("parts"))
        spread = assigned.join(F.broadcast(sizes), "node").withColumn(
            "part", F.pmod(F.xxhash64("vec_id"), "parts")
        )

        def pages(frame: pd.DataFrame) -> pd.DataFrame:
            vectors = matrix(frame["v"], width)
            points = lifted(vectors, top)
            wanted = -(-len(frame) // PAGE)
            step = np.arange(len(frame))[:: max(1, len(frame) // min(len(frame), 8 * wanted))]
            centres = points[step[apart(points[step], wanted)]]
            far = distances(points, centres)
            nearest, far = far.argmin(1), far.min(1)
            rows = []
            for no in range(len(centres)):
                mine = np.flatnonzero(nearest == no)
                mine = mine[np.argsort(far[mine], kind="stable")]
                for at in range(0, len(mine), 4 * PAGE):  # equal vectors fill several pages
                    own = mine[at : at + 4 * PAGE]
                    rows.append(
                        {
                            "node": frame["node"].iloc[0],
                            "part": frame["part"].iloc[0],
                            "radius": frame["parent"].max(),
                            "n": len(own),
                            "centre": centres[no].tobytes(),
                            "centre_parent": float(
                                distances(centres[no : no + 1], pivots[[frame["node"].iloc[0]]])[0, 0]
                            ),
                            "page_radius": float(far[own].max()),
                            "far": far[own].tobytes(),
                            "ids": frame["vec_id"].to_numpy(np.int64)[own].tobytes(),
                            "vectors": vectors[own].tobytes(),
                        }
                    )
            return pd.DataFrame(rows)

        schema = (
            "node long, part long, radius double, n long, centre binary, centre_parent double, "
            "page_radius double, far binary, ids binary, vectors binary"
        )
        return materialize(spread.groupBy("node", "part").applyInPandas(pages, schema), "subtrees")


class Best:
    """The k best (score, vec_id) of each query of a block so far."""

    def __init__(self, queries: np.ndarray, ids: np.ndarray, top: float, k: int, floor: np.ndarray):
        self.queries, self.ids, self.k = queries, ids, k
        self.score = np.full((len(ids), k), NONE)
        self.found = np.full((len(ids), k), -1, np.int64)
        self.floor = floor.copy()  # a score that the k-th best is known to reach
        self.lengths = (queries.astype(float) ** 2).sum(1) + top
        self.loose = slack(top)

    def reach(self) -> np.ndarray:
        """The distance beyond which nothing can enter."""
        worst = np.maximum(self.score[:, -1], self.floor).astype(float)
        return np.sqrt(np.maximum(self.lengths - 2 * worst, 0)) + self.loose

    def offer(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Candidates for the queries at `rows`: a matrix of scores, the candidates' ids."""
        enters = scores >= np.maximum(self.score[rows, -1], self.floor[rows])[:, None]
        enters &= ids[None, :] != self.ids[rows][:, None]
        who, which = np.nonzero(enters)
        if not len(who):
            return
        hit = rows[np.unique(who)]
        row = np.concatenate([np.repeat(hit, self.k), rows[who]])
        score = np.concatenate([self.score[hit].ravel(), scores[who, which]])
        found = np.concatenate([self.found[hit].ravel(), ids[which]])
        order = np.lexsort([found, ~score, row])  # ~x falls as x grows, without overflow
        first = np.searchsorted(row[order], hit)
        best = order[first[:, None] + np.arange(self.k)]
        self.score[hit], self.found[hit] = score[best], found[best]


def search_subtree(best: Best, points: np.ndarray, to_pivot: np.ndarray, pages: pd.DataFrame):
    """Best-first through the pages of a subtree for a block of queries.

    `to_pivot` are the queries' distances to the subtree's pivot.
    """
    width = best.queries.shape[1]
    parent = pages["centre_parent"].to_numpy()
    radius = pages["page_radius"].to_numpy()
    # Known from stored distances alone, before any page is looked at.
    far = np.abs(to_pivot[:, None] - parent[None, :]) - radius[None, :]
    order = np.argsort(far.min(0), kind="stable")
    for no in order:
        reach = best.reach()
        rows = np.flatnonzero(far[:, no] <= reach)
        if not len(rows):
            continue
        centre = np.frombuffer(pages["centre"].iloc[no])[None, :]
        to_centre = distances(points[rows], centre)[:, 0]
        near = to_centre - radius[no] <= reach[rows]
        rows, to_centre = rows[near], to_centre[near]
        if not len(rows):
            continue
        entry = np.frombuffer(pages["far"].iloc[no])
        bound = np.abs(to_centre[:, None] - entry[None, :]) <= reach[rows][:, None]
        wanted = np.flatnonzero(bound.any(0))
        rows = rows[bound.any(1)]
        if not len(rows) or not len(wanted):
            continue
        ids = np.frombuffer(pages["ids"].iloc[no], np.int64)[wanted]
        vectors = np.frombuffer(pages["vectors"].iloc[no], np.int64).reshape(-1, width)[wanted]
        best.offer(rows, products(best.queries[rows], vectors), ids)


def top_k(
    df: DataFrame,
    queries: Column,
    k: int = 20,
    scale: int = 64,
    id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer products of each row of `queries`."""
    out = "query_id long, vec_id long, score long"
    points = materialize(
        df.select(F.col(id).cast("long").alias("vec_id"), whole(F.col(vector), scale).alias("v"), queries.alias("asked"))
        .where("v is not null and vec_id is not null"),
        "vectors",
    )
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    facts = points.agg(
        F.max(square).alias("top"),
        F.max(F.size("v")).alias("width"),
        F.count_if("asked").alias("asked"),
    ).first()
    if not facts["asked"]:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    index = Index(points, facts["top"], facts["width"])
    top, width, pivots = index.top, index.width, index.pivots
    blocks = -(-facts["asked"] // BLOCK)
    asked = (
        points.where("asked")
        .groupBy(F.col("vec_id").alias("query_id"))
        .agg(F.min("v").alias("q"))
        .withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)))
    )
    routes = index.routes.select("node", "part", "radius").collect()  # a row for thousands of vectors
    nodes = np.array([r["node"] for r in routes])
    radii = np.array([r["radius"] for r in routes])
    parts = np.array([r["part"] for r in routes])

    def route(first: bool):
        """Rows of a query for the subtrees to search, first the nearest, then the others."""

        def run(frames):
            for frame in frames:
                query = matrix(frame["q"], width)
                far = distances(np.column_stack([query.astype(float), np.zeros(len(query))]), pivots)
                least = far[:, nodes] - radii[None, :]
                order = np.argsort(least, axis=1, kind="stable")
                early = np.zeros(least.shape, bool)
                np.put_along_axis(early, order[:, :FIRST], True, axis=1)
                if first:
                    take = early
                else:
                    length = (query.astype(float) ** 2).sum(1) + top
                    reach = np.sqrt(np.maximum(length - 2 * frame["floor"].to_numpy(float), 0))
                    take = ~early & (least <= reach[:, None] + slack(top))
                who, where = np.nonzero(take)
                yield pd.DataFrame(
                    {
                        "block": frame["block"].to_numpy()[who],
                        "node": nodes[where],
                        "part": parts[where],
                        "query_id": frame["query_id"].to_numpy()[who],
                        "q": pd.Series([frame["q"].iloc[i] for i in who], dtype=object),
                        "floor": frame["floor"].to_numpy()[who],
                    }
                )

        return run

    def search(key, queries: pd.DataFrame, pages: pd.DataFrame) -> pd.DataFrame:
        vectors = matrix(queries["q"], width)
        spots = np.column_stack([vectors.astype(float), np.zeros(len(vectors))])
        floor = queries["floor"].to_numpy(np.int64)
        best = Best(vectors, queries["query_id"].to_numpy(np.int64), top, k, floor)
        to_pivot = distances(spots, pivots[[int(key[1])]])[:, 0]
        search_subtree(best, spots, to_pivot, pages)
        real = (best.score > NONE) & (best.score >= floor[:, None])
        who, _ = np.nonzero(real)
        return pd.DataFrame(
            {"query_id": best.ids[who], "vec_id": best.found[real], "score": best.score[real]}
        )

    routed = "block long, node long, part long, query_id long, q array<bigint>, floor long"
    place = ["block", "node", "part"]

    def searched(queries: DataFrame, first: bool) -> DataFrame:
        """Each block of queries in each subtree that it is routed to."""
        sent = materialize(queries.mapInPandas(route(first), routed), "routed")
        pairs = sent.groupBy(*[F.col(c).alias(f"_{c}") for c in place]).agg(F.lit(1).alias("_1"))
        on = (F.col("node") == F.col("_node")) & (F.col("part") == F.col("_part"))
        pages = index.subtrees.join(pairs, on).groupBy(*[f"_{c}" for c in place])
        return sent.groupBy(*place).cogroup(pages).applyInPandas(search, out)

    lowest = -(1 << 62)
    early = materialize(
        searched(asked.withColumn("floor", F.lit(lowest)), True), "first-neighbours"
    )
    # The k-th best of the first subtrees is a bound for all others.
    floors = (
        early.groupBy("query_id")
        .agg(F.sort_array(F.collect_list("score"), asc=False).alias("s"))
        .select("query_id", F.coalesce(F.get("s", F.lit(k - 1)), F.lit(lowest)).alias("floor"))
    )
    late = searched(asked.join(floors, "query_id", "left").fillna(lowest, ["floor"]), False)
    # At most k from each subtree that was searched: few candidates for each query.
    best = early.unionByName(late).groupBy("query_id").agg(
        F.slice(
            F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k
        ).alias("top")
    )
    return best.select("query_id", F.posexplode("top").alias("pos", "t")).select(
        "query_id",
        (F.col("pos") + 1).cast("int").alias("rank"),
        F.col("t.vec_id").alias("vec_id"),
        (-F.col("t.s")).alias("score"),
    )
