"""Character trigram codes of a batch of texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

CHUNK_CHARS = 1 << 18  # work arrays take some 200 bytes a character


def text_chunks(texts: pa.Array, limit: int = CHUNK_CHARS):
    """Runs of texts with at most `limit` characters, or one longer text."""
    run, size = [], 0
    for text in texts.to_pylist():
        text = text or ""
        if run and size + len(text) > limit:
            yield run
            run, size = [], 0
        run.append(text)
        size += len(text)
    if run:
        yield run


def trigram_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code, text number) of every trigram; 21 bits per character."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    points = points.astype(np.int64)
    lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    if len(points) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    codes = (points[:-2] << 42) | (points[1:-1] << 21) | points[2:]
    owner = np.repeat(np.arange(len(texts)), lengths)
    whole = owner[:-2] == owner[2:]
    return codes[whole], owner[:-2][whole]
