"""Runs of words that repeat with a period, found with string synchronising sets.

A run is a stretch of words with smallest period q, at least `TIMES` periods and `SHORTEST` words
long, that no neighbouring word extends. Documents are searched many at once, one after the other
in an array with a separator of its own after each, so the work is array operations:

* Periods below `DIRECT` are found where words equal those q places on.
* Larger periods are found by scale. For periods from `low` below `high`, half an octave apart, a
  position is described by its context, the hash of the next 1.5 `high` words. The synchronising
  set holds the positions whose context has the smallest hash of a window. It depends on the words
  alone, so inside a run it repeats with the run's period, and a run of four periods has at least
  one pair of its positions with equal contexts. A context of that length occurs once in a period
  (two occurrences less than q apart would make the period smaller), so such pairs are neighbours
  among equal contexts and their distance is the period. They propose it.
* Positions whose context itself has a small period would flood the set. They are left out; their
  regions are the runs of smaller periods, which the scales before have found.

Proposals are extended and checked word by word, so a hash never decides: words are numbered by
their bytes. A proposal in which a larger multiple of the period was met has the extent of the run
with the smaller period, and only the smallest is kept.

Words are runs without ASCII white space, unchanged. A null text has none. Repeated rows and
repeated ids give one row each; rows without an id are searched like others. Columns other than
the id and the text are ignored. An empty table gives no rows. A document is searched by one task,
in memory of about 200 bytes a word.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from winnow.llm.workers import lean

TIMES = 4  # periods in a run, at least
SHORTEST = 6  # words in a run, at least
DIRECT = 8  # periods below it are compared word by word everywhere
SLAB = 1 << 18  # words searched at once, unless one document has more

NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)
RUNS = "runs array<struct<start: long, length: long, period: long>>"


def scrambled(x: np.ndarray) -> np.ndarray:
    """Each of 2 ** 64 values as another one, without structure."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two hashes, one after the other."""
    return scrambled(scrambled(a + np.uint64(0x9E3779B97F4A7C15)) + b)


def sliding(x: np.ndarray, width: int, smallest: bool) -> np.ndarray:
    """The smallest (or largest) of each `width` neighbours, by blocks met from both sides."""
    take = np.minimum if smallest else np.maximum
    n = len(x) - width + 1
    rest = -len(x) % width
    filled = np.concatenate([x, np.full(rest, NEVER if smallest else 0, x.dtype)])
    blocks = filled.reshape(-1, width)
    ahead = take.accumulate(blocks, axis=1).ravel()
    behind = take.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return take(behind[:n], ahead[width - 1 : width - 1 + n])


def stretches(equal: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, past the last) of each stretch of at least `least` places in ascending `equal`."""
    if not len(equal):
        return equal, equal
    cut = np.flatnonzero(np.diff(equal) != 1)
    first = equal[np.append(0, cut + 1)]
    past = equal[np.append(cut, len(equal) - 1)] + 1
    long = past - first >= least
    return first[long], past[long]


def direct_runs(x: np.ndarray) -> list[np.ndarray]:
    """(start, length, period) of stretches with a period below `DIRECT`."""
    found = []
    for q in range(1, DIRECT):
        first, past = stretches(np.flatnonzero(x[:-q] == x[q:]), max(TIMES * q, SHORTEST) - q)
        found.append(np.column_stack([first, past - first + q, np.full(len(first), q)]))
    return found


def periodic(runs: np.ndarray, size: int, context: int) -> np.ndarray:
    """Whether the context of each position lies in a run of a period up to a quarter of it."""
    inside = runs[
        (runs[:, 0] < size) & (runs[:, 1] >= context) & (runs[:, 2] <= context // TIMES)
    ]
    step = np.zeros(size + 1, np.int32)
    np.add.at(step, inside[:, 0], 1)
    np.add.at(step, inside[:, 0] + inside[:, 1] - context + 1, -1)
    return np.cumsum(step[:size]) > 0


def proposals(
    contexts: np.ndarray, omitted: np.ndarray, window: int, low: int, high: int
) -> tuple[np.ndarray, np.ndarray]:
    """(position, distance) of neighbouring equal contexts in the synchronising set."""
    if len(contexts) < window:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashes = np.where(omitted, NEVER, contexts)
    least = sliding(hashes, window, True)
    edge = np.zeros(window - 1, np.uint64)
    best = sliding(np.concatenate([edge, least, edge]), window, False)
    chosen = np.flatnonzero((best == hashes) & ~omitted)
    chosen = chosen[np.argsort(hashes[chosen], kind="stable")]
    gap = np.diff(chosen)
    paired = (hashes[chosen[:-1]] == hashes[chosen[1:]]) & (gap >= low) & (gap < high)
    return chosen[:-1][paired], gap[paired]


def extended(x: np.ndarray, q: int, first: int, past: int) -> tuple[int, int]:
    """The places around [first, past) whose words equal those q places on."""
    step = 64
    while first > 0:
        start = max(0, first - step)
        differ = np.flatnonzero(x[start:first] != x[start + q : first + q])
        if len(differ):
            first = start + int(differ[-1]) + 1
            break
        first, step = start, 2 * step
    step, top = 64, len(x) - q
    while past < top:
        end = min(top, past + step)
        differ = np.flatnonzero(x[past:end] != x[past + q : end + q])
        if len(differ):
            past = past + int(differ[0])
            break
        past, step = end, 2 * step
    return first, past


def verified(x: np.ndarray, at: np.ndarray, q: np.ndarray, context: int) -> np.ndarray:
    """The runs that proposals of one scale lead to."""
    order = np.lexsort([at, q])
    at, q = at[order], q[order]
    fresh = np.ones(len(at), bool)
    fresh[1:] = (q[1:] != q[:-1]) | (at[1:] > at[:-1] + context)
    begin = np.flatnonzero(fresh)
    close = np.append(begin[1:], len(at)) - 1
    found = []
    for i, j in zip(begin.tolist(), close.tolist(), strict=True):
        period = int(q[i])
        first, past = extended(x, period, int(at[i]), int(at[j]) + context)
        same = np.flatnonzero(x[first:past] == x[first + period : past + period]) + first
        for a, b in zip(*stretches(same, (TIMES - 1) * period), strict=True):
            found.append((int(a), int(b - a) + period, period))
    return np.array(found, np.int64).reshape(-1, 3)


def smallest_periods(runs: np.ndarray) -> np.ndarray:
    """Runs in order of start, length and period; of those with one extent, the smallest period."""
    runs = np.unique(runs, axis=0)
    fresh = np.ones(len(runs), bool)
    fresh[1:] = (runs[1:, :2] != runs[:-1, :2]).any(1)
    return runs[fresh]


def find_runs(x: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """(start, length, period) of all runs in `x`, documents in falling order of length.

    Each document ends with a separator, a number of its own; `ends` are the places after those.
    """
    lengths = np.diff(np.append(0, ends)) - 1
    runs = smallest_periods(np.concatenate(direct_runs(x)))
    width, hashes = 1, scrambled(x.astype(np.uint64))
    low = DIRECT
    while True:
        high = low + low // 2 if low & (low - 1) == 0 else (low // 3) * 4
        reach = int(np.searchsorted(-lengths, -TIMES * low, side="right"))
        if not reach:
            return runs
        size = int(ends[reach - 1])
        x, hashes = x[:size], hashes[: size - width + 1]
        context = -(-3 * (high - 1) // 2)
        while 2 * width <= context and 2 * width <= size:
            hashes = pair_hash(hashes[:-width], hashes[width:])
            width *= 2
        if context > size:
            return runs
        contexts = pair_hash(hashes[: size - context + 1], hashes[context - width :])
        window = (TIMES - 1) * low - context + 1
        omitted = periodic(runs, len(contexts), context)
        at, q = proposals(contexts, omitted, window, low, high)
        if len(at):
            runs = smallest_periods(np.concatenate([runs, verified(x, at, q, context)]))
        low = high


def slab_runs(texts: list[list[bytes]]) -> list[np.ndarray]:
    """The runs of each document, by start and period, words counted from 0."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    numbers: dict[bytes, int] = defaultdict(count(1).__next__)
    parts, separator = [], -1
    for i in order:
        words = texts[i]
        parts.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
        parts.append(np.array([separator]))
        separator -= 1
    x = np.concatenate(parts)
    ends = np.cumsum([len(texts[i]) + 1 for i in order])
    runs = find_runs(x, ends)
    which = np.searchsorted(ends, runs[:, 0], side="right")
    cuts = np.searchsorted(which, np.arange(len(order) + 1))
    out: list[np.ndarray] = [runs[:0]] * len(texts)
    for k, i in enumerate(order):
        own = runs[cuts[k] : cuts[k + 1]].copy()
        own[:, 0] -= ends[k] - len(texts[i]) - 1
        out[i] = own[np.lexsort([own[:, 2], own[:, 0]])]
    return out


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words without those that a run holds after its first period."""
    if not len(runs):
        return b" ".join(words)
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, runs[:, 0] + runs[:, 2], 1)
    np.add.at(step, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(step[:-1]) == 0)])


def slabs(texts: list[bytes | None]) -> Iterator[list[list[bytes]]]:
    held, size = [], 0
    for text in texts:
        words = text.split() if text else []  # bytes split at ASCII white space alone
        if held and size + len(words) > SLAB:
            yield held
            held, size = [], 0
        held.append(words)
        size += len(words)
    if held:
        yield held


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
    for batch in batches:
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        at = 0
        for held in slabs(texts):
            found = slab_runs(held)
            counts = np.cumsum([0] + [len(r) for r in found])
            flat = np.concatenate(found)
            structs = pa.StructArray.from_arrays(
                [pa.array(flat[:, i]) for i in range(3)], ["start", "length", "period"]
            )
            kept = [collapsed(w, r) for w, r in zip(held, found, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(at, len(held)),
                    pa.array([len(w) for w in held], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(counts, pa.int32()), structs).cast(kind),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "runs", "kept"],
            )
            at += len(held)


def collapse_runs(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, kept): every run of each document and its text without repeats."""
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(lean(_search), f"doc_id long, n_words long, {RUNS}, kept string")
