"""Repeated word n-grams of a batch of texts, vectorised over Arrow word lists.

Counting n-grams with JVM array functions costs a few microseconds per n-gram and size, and
exploding them would shuffle the corpus many times over. This keeps each text where it is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_WORDS = 1 << 16  # work arrays take some 200 bytes a word


def list_chunks(lists: pa.Array, limit: int = CHUNK_WORDS):
    """(values, offsets) of runs of rows with at most `limit` values, or of one longer row."""
    offsets = lists.offsets.to_numpy().astype(np.int64)
    row = 0
    while row < len(lists):
        end = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        end = min(max(end, row + 1), len(lists))
        bounds = offsets[row : end + 1]
        yield lists.values.slice(bounds[0], bounds[-1] - bounds[0]), bounds - bounds[0]
        row = end


def _rank(keys: np.ndarray):
    """Dense ranks, first positions and counts of the distinct keys, in key order."""
    _, first, ranks, counts = np.unique(
        keys, return_index=True, return_inverse=True, return_counts=True
    )
    return ranks.astype(np.int64), first, counts


def repeated_chars(
    words: pa.Array, bounds: np.ndarray, top: list[int], dup: list[int]
) -> np.ndarray:
    """One row per text, one column per size: characters of the most frequent n-gram for the
    sizes in `top`, characters covered by repeated occurrences for the sizes in `dup`.

    The columns after those hold the characters of all words.
    """
    texts = len(bounds) - 1
    result = np.zeros((texts, len(top) + len(dup) + 1), dtype=np.int64)
    if len(words) == 0:
        return result
    lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = words.dictionary_encode()
    ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    vocabulary = len(coded.dictionary)
    text_of = np.repeat(np.arange(texts), np.diff(bounds))
    text_end = bounds[1:][text_of]
    chars_before = np.concatenate(([0], np.cumsum(lengths)))
    result[:, -1] = np.bincount(text_of, weights=lengths, minlength=texts)

    # Ranks stay ordered by text, because the text number leads the first key.
    starts = np.arange(len(ids))
    ranks, _, _ = _rank(text_of * vocabulary + ids)
    sizes = sorted({*top, *dup})
    for n in range(2, sizes[-1] + 1):
        fits = starts + n <= text_end[starts]
        starts, ranks = starts[fits], ranks[fits]
        if len(starts) == 0:
            break
        ranks, first, counts = _rank(ranks * vocabulary + ids[starts + n - 1])
        if n in top:
            at = starts[first]
            gram_length = chars_before[at + n] - chars_before[at] + n - 1
            owner = text_of[at]
            heads = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            scale = int(gram_length.max()) + 1
            best = np.maximum.reduceat(counts * scale + gram_length, heads)
            result[owner[heads], top.index(n)] = (best // scale) * (best % scale)
        if n in dup:
            later = starts[np.arange(len(starts)) != first[ranks]]
            marks = np.bincount(later, minlength=len(ids) + 1)
            marks -= np.bincount(later + n, minlength=len(ids) + 1)[: len(ids) + 1]
            covered = np.cumsum(marks)[:-1] > 0
            result[:, len(top) + dup.index(n)] = np.bincount(
                text_of[covered], weights=lengths[covered], minlength=texts
            )
        if n >= max([*top, 1]):
            # A repeated longer n-gram starts where a repeated shorter one starts.
            repeated = counts[ranks] > 1
            starts, ranks = starts[repeated], ranks[repeated]
    return result


def repeated_chars_column(words: pa.Array, top: list[int], dup: list[int]) -> pa.Array:
    """`repeated_chars` of an Arrow list column; NULL for NULL."""
    parts = [repeated_chars(values, bounds, top, dup) for values, bounds in list_chunks(words)]
    width = len(top) + len(dup) + 1
    flat = np.concatenate(parts).ravel() if parts else np.zeros(0, dtype=np.int64)
    offsets = np.arange(len(words) + 1, dtype=np.int32) * width
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat), mask=words.is_null())
