import hashlib
import random
import re

import numpy as np
import pytest

from winnow.llm import repeats, substring_dedup, suffix_dedup
from winnow.session import build_session  # noqa: F401


def marks(units, length):
    """Units covered by a window that starts earlier too: {document: marks}, in order of ids."""
    seen, out = set(), {}
    for doc in sorted(units):
        own = units[doc]
        gone = bytearray(len(own))
        for at in range(len(own) - length + 1):
            window = tuple(own[at : at + length])
            if window in seen:
                gone[at : at + length] = b"\1" * length
            seen.add(window)
        out[doc] = bytes(gone)
    return out


def as_documents(rows):
    """By id; rows without an id come last, repeated ids are one document."""
    return {repeats.NO_ID if i is None else i: t for i, t in rows}


def made(seed, count, alphabet, longest):
    draw = random.Random(seed)
    parts = ["".join(draw.choices(alphabet, k=draw.randint(1, 60))) for _ in range(6)]
    texts = []
    for _ in range(count):
        text = "".join(
            draw.choice(parts) if draw.random() < 0.5 else "".join(draw.choices(alphabet, k=draw.randint(0, 40)))
            for _ in range(draw.randint(0, longest))
        )
        texts.append(text)
    return list(enumerate(texts))


def check_bytes(spark, rows, least, batches, frame=None):
    frame = frame if frame is not None else spark.createDataFrame(rows, "doc_id long, text string")
    units = {d: (t or "").encode() for d, t in as_documents(rows).items()}
    gone = marks(units, least)
    found = suffix_dedup.remove_repeats(frame, least, batches).collect()
    assert len(found) == len(rows)
    for r in found:
        doc = repeats.NO_ID if r.doc_id is None else r.doc_id
        kept = bytes(c for c, g in zip(units[doc], gone[doc], strict=True) if not g)
        spans = [(m.start(), m.end()) for m in re.finditer(b"\1+", gone[doc])]
        assert (r.n_bytes, r.n_removed) == (len(units[doc]), sum(gone[doc]))
        assert [(s.start, s.end) for s in r.spans] == spans and bytes(r.kept) == kept


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_suffix_dedup_equals_brute_force(spark, batches):
    check_bytes(spark, made(batches, 60, "ab ", 8), 12, batches)


def test_suffix_dedup_in_any_order_of_batches(spark):
    rows = made(9, 40, "abc", 8)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    docs = repeats.plain(frame)
    index = suffix_dedup.SuffixIndex(spark, repeats.Shape("bytes", 12, 4, 7))
    for rest in (3, 0, 2, 1, 4):
        index.add(docs.where(docs["_doc"] % 5 == rest))
        assert len(index.levels) == bin(len(index.found)).count("1")  # a binary counter
    found = suffix_dedup.cut(
        repeats.with_spans(docs, repeats.spans(index.runs(docs), index.shape))
    ).collect()
    gone = marks({d: t.encode() for d, t in rows}, 12)
    assert {r.doc_id: r.n_removed for r in found} == {d: sum(g) for d, g in gone.items()}


def test_suffix_dedup_on_awkward_rows(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.where("doc_id is not null").collect()]
    frame = docs.where("doc_id is not null")
    check_bytes(spark, rows, 100, 3, frame)


def check_words(rows, found, length):
    pattern = re.compile(r"[^\x20\x09-\x0D]+")
    units = {d: pattern.findall(t or "") for d, t in as_documents(rows).items()}
    gone = marks(units, length)
    assert len(found) == len(rows)
    for r in found:
        doc = repeats.NO_ID if r.doc_id is None else r.doc_id
        kept = [w for w, g in zip(units[doc], gone[doc], strict=True) if not g]
        assert (r.n_words, r.n_removed, r.kept) == (len(units[doc]), sum(gone[doc]), " ".join(kept))


@pytest.mark.parametrize("seed", [1, 2])
def test_substring_dedup_equals_brute_force(spark, seed):
    rows = made(seed, 80, "ab  ", 12)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    check_words(rows, substring_dedup.remove_repeats(frame, 6).collect(), 6)


def test_substring_dedup_on_awkward_rows(docs):
    frame = docs.where("doc_id is not null")
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    check_words(rows, substring_dedup.remove_repeats(frame).collect(), 20)


def test_rows_without_an_id_come_last(spark):
    text = " ".join(f"w{i}" for i in range(40))
    frame = spark.createDataFrame([(None, text), (7, text)], "doc_id long, text string")
    found = {r.doc_id: r.n_removed for r in substring_dedup.remove_repeats(frame).collect()}
    assert found == {7: 0, None: 40}


def test_empty_tables(docs):
    assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0
    assert substring_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_documents_longer_than_a_slab(spark, monkeypatch):
    """Segments of a long document overlap by a window less one unit."""
    monkeypatch.setattr(repeats, "SLAB", 64)
    draw = random.Random(4)
    units = np.array([draw.randrange(3) for _ in range(700)], np.uint8)
    shape, sums = repeats.Shape("bytes", 12, 4, 5), repeats.Sums()
    found = [repeats.anchors(shape, s, sums) for s in repeats.segments([units], [1], 12)]
    starts = np.concatenate([np.arange(r["p"], r["p"] + r["n"]) for f in found for r in f])
    assert sorted(starts) == list(range(700 - 12 + 1))


def test_packed_records_survive():
    records = np.zeros(5, repeats.ANCHOR)
    records["h"], records["p"] = np.arange(5), 7
    assert (repeats.from_bytes(repeats.to_bytes(records), repeats.ANCHOR) == records).all()
    assert hashlib.sha256(repeats.to_bytes(records[:0])).hexdigest()


def test_words_that_a_polynomial_takes_as_equal(spark, alike_words):
    common = " ".join(f"w{i}" for i in range(19))
    rows = [(2 * i + k, f"{word} {common}{i}") for i, pair in enumerate(alike_words)
            for k, word in enumerate(pair)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.n_removed for r in substring_dedup.remove_repeats(frame).collect()} == {0}


@pytest.mark.parametrize(("units", "length", "seed"), [("bytes", 100, 40), ("words", 20, 10)])
def test_anchors_are_dealt_evenly(spark, units, length, seed):
    """An anchor's hash is the smallest of a window: buckets by the hash itself are very uneven."""
    draw = random.Random(6)
    rows = [(i, " ".join(f"{draw.randrange(10**6)}" for _ in range(2000))) for i in range(40)]
    docs = repeats.plain(spark.createDataFrame(rows, "doc_id long, text string"))
    found = repeats.anchor_rows(docs, repeats.Shape(units, length, seed, 20)).where("kind = 'anchor'")
    held = dict.fromkeys(range(20), 0)
    for r in found.collect():
        held[r.bucket] += len(repeats.from_bytes(r.data, repeats.ANCHOR))
    assert max(held.values()) < 1.5 * sum(held.values()) / 20
