"""A quality classifier over document statistics.

Random Fourier features approximate a Gaussian kernel over standardised statistics of a text.
Normal equations are summed in a fixed number of partitions and then once more; their ridge
solution gives a raw score. Isotonic regression over a fixed number of score bins turns it into the
share of good documents among the labelled ones with such a score.

Only the text is an input of a score. Null texts are empty texts; they are scored as such. Rows
without a label teach nothing, rows that repeat a label count as often as they occur. Without any
labelled row every score is 1. Columns other than the id and the text are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from winnow.llm.repeats import BYTES, SEPARATORS, Sums, byte_slabs, mixed, new_values
from winnow.llm.workers import lean
from winnow.session import materialize, small_batches

FEATURES = 384
RIDGE = 1e-3  # of the number of labelled rows
PARTS = 32  # partitions that sum normal equations
BINS = 512  # of the calibration
SEED = 20240


def _kinds() -> np.ndarray:
    """The class of each byte: what the shares of a text are taken of."""
    kind = np.zeros(256, np.int64)
    for value, members in enumerate(
        (
            b"abcdefghijklmnopqrstuvwxyz",
            b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
            b"0123456789",
            b" ",
            b"\n\r\t\x0b\x0c",
            b".,;:",
            b"!?",
            b"'\"-()",
            b"|",
            b"#$%&*+/<=>@[\\]^_`{}~",
        ),
        1,
    ):
        kind[list(members)] = value
    kind[128:] = 11
    return kind


KINDS = _kinds()
N_KINDS = 12
STATISTICS = N_KINDS + 12


def statistics(texts: list[bytes], sums: Sums) -> np.ndarray:
    """One row of statistics per text."""
    return np.concatenate(
        [np.zeros((0, STATISTICS)), *[_slab_statistics(group, sums) for group in byte_slabs(texts)]]
    )


def _distinct(owner: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values, largest count of one) of each owner."""
    pairs = np.empty(len(owner), [("o", "<i8"), ("v", "<u8")])
    pairs["o"], pairs["v"] = owner, value
    pairs = pairs[np.lexsort([pairs["v"], pairs["o"]])]
    first = np.flatnonzero(new_values(pairs, "o", "v"))
    counts = np.diff(np.append(first, len(pairs)))
    most = np.zeros(n)
    np.maximum.at(most, pairs["o"][first], counts)
    return np.bincount(pairs["o"][first], minlength=n), most


def _slab_statistics(group: list[bytes], sums: Sums) -> np.ndarray:
    n = len(group)
    data = np.frombuffer(b"\n".join(group) + b"\n", np.uint8)
    sizes = np.array([len(t) for t in group])
    owner = np.repeat(np.arange(n), sizes + 1)
    inner = np.ones(len(data), bool)
    inner[np.cumsum(sizes + 1) - 1] = False  # the breaks between the texts
    shares = np.bincount(owner[inner] * N_KINDS + KINDS[data[inner]], minlength=n * N_KINDS)
    shares = shares.reshape(n, N_KINDS) / np.maximum(sizes, 1)[:, None]
    prefix = sums.of(BYTES[data])

    def runs(breaks: np.ndarray):
        edges = np.flatnonzero(np.diff(breaks, prepend=True, append=True))
        starts, ends = edges[::2], edges[1::2]
        hashes = mixed(sums.run(prefix, starts, ends) + (ends - starts).astype(np.uint64))
        return owner[starts], ends - starts, hashes

    who, length, words = runs(SEPARATORS[data])
    count = np.bincount(who, minlength=n)
    some = np.maximum(count, 1)
    mean = np.bincount(who, weights=length, minlength=n) / some
    spread = np.sqrt(np.bincount(who, weights=length.astype(float) ** 2, minlength=n) / some)
    distinct, most = _distinct(who, words, n)
    next_to = who[1:] == who[:-1]
    equal = np.bincount(who[1:][next_to & (words[1:] == words[:-1])], minlength=n)
    pairs = mixed(words[:-1] * np.uint64(3) + words[1:])[next_to]
    bigrams, top_pair = _distinct(who[1:][next_to], pairs, n)
    some_pairs = np.maximum(count - 1, 1)
    line_who, line_length, lines = runs(data == 10)
    line_count = np.bincount(line_who, minlength=n)
    some_lines = np.maximum(line_count, 1)
    line_distinct, _ = _distinct(line_who, lines, n)
    short = np.bincount(line_who[line_length < 40], minlength=n)
    columns = [
        np.log1p(sizes),
        np.log1p(count),
        mean,
        spread,
        distinct / some,
        np.log1p(distinct) / np.log1p(some),
        most / some,
        equal / some,
        bigrams / some_pairs,
        top_pair / some_pairs,
        line_distinct / some_lines,
        short / some_lines,
    ]
    return np.column_stack([np.sqrt(shares), *columns])


@dataclass
class Model:
    """What a score needs; a few hundred kilobytes whatever the corpus."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None
    edges: np.ndarray  # bins of raw scores
    heights: np.ndarray  # the calibrated score of each bin

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return fourier(stats, self.mean, self.scale) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.ones(len(stats))
        return np.interp(self.raw(stats), self.edges, self.heights)


def fourier(stats: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random Fourier features of standardised statistics, the statistics and a constant."""
    draw = np.random.default_rng(SEED)
    z = np.clip((stats - mean) / scale, -6, 6)
    width = z.shape[1]
    turns = draw.normal(0, 1 / np.sqrt(2 * width), (width, FEATURES))
    shifts = draw.uniform(0, 2 * np.pi, FEATURES)
    waves = np.sqrt(2 / FEATURES) * np.cos(z @ turns + shifts)
    return np.column_stack([waves, z / 10, np.ones(len(z))])


def document_statistics(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, stats): computed where the text is scanned."""
    small_batches(docs.sparkSession)

    def run(batches):
        sums = Sums()
        for batch in batches:
            stats = statistics(batch.column("text").to_pylist(), sums)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(list(stats), pa.list_(pa.float64()))],
                ["doc_id", "stats"],
            )

    plain = docs.select(
        F.col(id).cast("long").alias("doc_id"),
        F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("text"),
    )
    return plain.mapInArrow(lean(run), "doc_id long, stats array<double>")


def _summed(rows: DataFrame, part) -> np.ndarray | None:
    """The sum of `part(stats, label)` over all rows: by partitions, then over these."""

    def partition(batches):
        total = None
        for frame in batches:
            if len(frame):
                value = part(np.stack(frame["stats"]), frame["label"].to_numpy(float))
                total = value if total is None else total + value
        if total is not None:
            yield pd.DataFrame({"g": [0], "data": [total.tobytes()], "cols": [total.shape[-1]]})

    def over(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(d) for d in frame["data"])
        return pd.DataFrame({"data": [total.tobytes()], "cols": frame["cols"].iloc[:1]})

    parts = rows.mapInPandas(partition, "g int, data binary, cols int")
    found = parts.groupBy("g").applyInPandas(over, "data binary, cols int").first()
    return None if found is None else np.frombuffer(found["data"]).reshape(-1, found["cols"])


def monotone(good: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: the non-decreasing shares nearest to good / total."""
    blocks: list[list[float]] = []
    for g, t in zip(good, total, strict=True):
        blocks.append([g, t, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            g2, t2, n2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + g2, blocks[-1][1] + t2, blocks[-1][2] + n2]
    return np.concatenate([np.full(int(n), g / t) for g, t, n in blocks])


def train(labelled: DataFrame) -> Model:
    """`labelled` has stats and label (1 is good)."""
    rows = materialize(
        labelled.where("label is not null").select("stats", F.col("label").cast("double"))
        .repartition(PARTS),
        "labelled",
    )
    moments = _summed(
        rows, lambda s, y: np.stack([s.sum(0), (s * s).sum(0), np.full(s.shape[1], len(s))])
    )
    if moments is None:
        none = np.zeros(STATISTICS)
        return Model(none, none + 1, None, np.zeros(1), np.ones(1))
    count = moments[2, 0]
    mean = moments[0] / count
    scale = np.sqrt(np.maximum(moments[1] / count - mean**2, 0))
    scale[scale < 1e-9] = 1

    def equations(stats: np.ndarray, label: np.ndarray) -> np.ndarray:
        z = fourier(stats, mean, scale)
        return z.T @ np.column_stack([z, 2 * label - 1])

    sums = _summed(rows, equations)
    matrix, right = sums[:, :-1], sums[:, -1]
    penalty = RIDGE * count * np.eye(len(matrix))
    penalty[-1, -1] = 0
    model = Model(mean, scale, np.linalg.lstsq(matrix + penalty, right, rcond=None)[0], None, None)
    edges = np.linspace(-2, 2, BINS)

    def binned(stats: np.ndarray, label: np.ndarray) -> np.ndarray:
        at = np.clip(np.searchsorted(edges, model.raw(stats)), 0, BINS - 1)
        return np.stack([np.bincount(at, label, BINS), np.bincount(at, minlength=BINS)]).astype(float)

    good, total = _summed(rows, binned)
    # A hundredth of a row of the overall share keeps empty bins defined and every score inside 0..1.
    share = good.sum() / total.sum()
    model.heights = monotone(good + 0.01 * share, total + 0.01)
    model.edges = edges
    return model


def score(stats: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score)."""

    def run(batches):
        for batch in batches:
            values = batch.column("stats").flatten().to_numpy(zero_copy_only=False)
            scores = model.score(values.reshape(-1, STATISTICS))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"]
            )

    return stats.mapInArrow(run, "doc_id long, score double")


def held_out(id: str = "doc_id"):
    return F.crc32(F.col(id).cast("string").cast("binary")) % 3 == 1


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, score) of every row, from `labels` (doc_id, label)."""
    stats = materialize(document_statistics(docs), "statistics")
    return score(stats, train(stats.join(labels, "doc_id")))
