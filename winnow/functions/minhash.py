"""Min-hash signatures of a batch of texts, vectorised over Arrow lists of word hashes.

A word hashes to the first 32 bits of its MD5, a shingle to a linear combination of its word
hashes modulo a prime, and signature value k is the smallest (a_k * h + b_k) modulo that prime.
The same numbers come out of any SQL engine.

31 bits tell too few shingles apart to compare texts by them. So each value comes with 32 more bits
of its shingle, from 64 bits of the MD5 of its words, and texts agree in a value only with these.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

from winnow.functions.ngrams import list_chunks

PRIME = 2**31 - 1
TAG_BITS = 32
CHUNK_WORDS = 32_000  # keeps the work arrays in the CPU cache, three times as fast as 1M


def coefficient(label: str) -> int:
    """A fixed multiplier in 1 .. PRIME - 1, derived from its label."""
    return int(hashlib.md5(label.encode()).hexdigest()[:12], 16) % (PRIME - 1) + 1


def word_coefficients(n: int) -> list[int]:
    return [coefficient(f"word-{i}") for i in range(n)]


def permutations(count: int) -> list[tuple[int, int]]:
    return [(coefficient(f"a-{i}"), coefficient(f"b-{i}")) for i in range(count)]


def word_hash(word: Column) -> Column:
    """First 64 bits of the MD5, as a signed number."""
    return F.conv(F.substring(F.md5(word), 1, 16), 16, -10).cast("bigint")


def signature(minima: Column) -> Column:
    """The signature values of tagged ones."""
    return F.transform(minima, lambda v: F.shiftright(v, TAG_BITS))


def _shingle_hashes(words: np.ndarray, bounds: np.ndarray, n: int):
    """Hashes and tags of all shingles and the number per text, from 64 bits of each word."""
    counts = np.maximum(np.diff(bounds) - n + 1, 0)
    total = int(counts.sum())
    first = np.concatenate(([0], np.cumsum(counts)[:-1]))
    at = np.arange(total) + np.repeat(bounds[:-1] - first, counts)
    whole = words.view(np.uint64)
    start = (whole >> np.uint64(32)).astype(np.int64)
    hashes, tags = np.zeros(total, dtype=np.int64), np.zeros(total, dtype=np.uint64)
    for offset, factor in enumerate(word_coefficients(n)):
        hashes += start[at + offset] * factor % PRIME
        odd = int(hashlib.md5(f"tag-{offset}".encode()).hexdigest()[:16], 16) | 1
        tags += whole[at + offset] * np.uint64(odd)
    return hashes % PRIME, (tags >> np.uint64(64 - TAG_BITS)).astype(np.int64), counts


def signatures(words: pa.Array, n: int, count: int) -> pa.Array:
    """`count` min-hashes per text, each above the tag of its shingle; NULL for texts with fewer
    than n words."""
    flat, present = [], []
    for values, bounds in list_chunks(words, CHUNK_WORDS):
        hashes, tags, shingles = _shingle_hashes(
            values.to_numpy(zero_copy_only=False).astype(np.int64), bounds, n
        )
        filled = shingles > 0
        present.append(filled)
        if not len(hashes):
            continue
        starts = np.cumsum(shingles[filled]) - shingles[filled]
        smallest = np.empty((len(starts), count), dtype=np.int64)
        for k, (a, b) in enumerate(permutations(count)):
            values = (hashes * a + b) % PRIME << TAG_BITS | tags
            smallest[:, k] = np.minimum.reduceat(values, starts)
        flat.append(smallest.ravel())
    filled = np.concatenate(present) if present else np.zeros(0, dtype=bool)
    values = np.concatenate(flat) if flat else np.zeros(0, dtype=np.int64)
    offsets = np.concatenate(([0], np.cumsum(filled))) * count
    return pa.ListArray.from_arrays(
        pa.array(offsets.astype(np.int32)), pa.array(values), mask=pa.array(~filled)
    )
