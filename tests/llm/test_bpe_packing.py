import base64
import hashlib
import json
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as vocabularies
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from winnow.llm import bpe, packing

RANKS = vocabularies.path("byte_bpe_50k.tiktoken")
VOCABULARY = vocabularies.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "own", pat_str=vocabularies.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(RANKS, vocabularies.PATTERN)


PIECES = ["'", "'s", "re", "'ll", " ", "  ", "\n", "\r\n", "\t", "a", "b1", "9", "!", "''", "é",
          " ", " ", "中", "'S", "'ve", "d", "́", "👍", "\x00", "x" * 90]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=30).map("".join), min_size=1, max_size=5))
def test_encoder_is_exact(reference, encoder, texts):
    assert [x.tolist() for x in encoder.encode(texts)] == [reference.encode_ordinary(t) for t in texts]


def test_every_code_point(reference, encoder):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000][::37]
    texts = [f"a{c}{c}b 1{c} ! {c}" for c in points]
    found = list(encoder.encode(texts))
    assert all(f.tolist() == reference.encode_ordinary(t) for f, t in zip(found, texts, strict=True))


def test_words_that_a_polynomial_takes_as_equal(reference, alike_words):
    encoder = bpe.Encoder(RANKS, vocabularies.PATTERN)
    for one, other in alike_words:
        for texts in ([one, other], [f"{other} {one} {one} x {other}"], [other, one]):
            found = [x.tolist() for x in encoder.encode(texts)]
            assert found == [reference.encode_ordinary(t) for t in texts]


def test_tokens_of_one_hash(reference):
    encoder = bpe.Encoder(RANKS, vocabularies.PATTERN)
    encoder.up, encoder.down = (np.zeros(1 << 20, np.uint64) for _ in range(2))
    for texts in (["one two one", " other  words"], ["two one other", "", " words 12 12\n\nx"]):
        found = [x.tolist() for x in encoder.encode(texts)]
        assert found == [reference.encode_ordinary(t) for t in texts]


def digest(reference, text):
    ids = np.array(reference.encode_ordinary(text), "<u4")
    return (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(),
            hashlib.sha256(text.encode()).hexdigest())


@pytest.mark.parametrize(("size", "overlap"), [(1 << 16, 1 << 10), (64, 16), (40, 39)])
def test_round_trip_over_chunks(spark, reference, docs, plain_rows, size, overlap):
    parts = bpe.encode_parts(docs, RANKS, vocabularies.PATTERN, size=size, overlap=overlap)
    rows = bpe.digests(*[bpe.decode(p, RANKS) for p in parts]).collect()
    found = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows)
    assert found == Counter((i, *digest(reference, t)) for i, t in plain_rows)


def test_runs_without_a_boundary(spark, reference):
    texts = ["z" * 900, " " * 700 + "x" * 50, "ab " * 60 + "q" * 400 + " tail" * 30, "\n" * 300]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    parts = bpe.encode_parts(frame, RANKS, vocabularies.PATTERN, size=50, overlap=10)
    rows = bpe.digests(*[bpe.decode(p, RANKS) for p in parts]).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows} == {
        i: digest(reference, t) for i, t in enumerate(texts)
    }


def test_encode_gives_pieces_in_order(spark, reference, docs, plain_rows):
    pieces = defaultdict(dict)
    for r in bpe.encode(docs, RANKS, vocabularies.PATTERN, size=64, overlap=16).collect():
        pieces[r._key][r.piece] = np.frombuffer(r.ids, "<u4").tolist()
    whole = Counter(tuple(x for no in sorted(p) for x in p[no]) for p in pieces.values())
    assert whole == Counter(tuple(reference.encode_ordinary(t)) for _, t in plain_rows)


# --- packing -------------------------------------------------------------------


def plain_best_fit(sizes, window):
    """Best-fit decreasing, item by item: how full each window is."""
    windows = []
    for size in sorted(sizes, reverse=True):
        fits = [i for i, used in enumerate(windows) if used + size <= window]
        if fits:
            best = max(fits, key=lambda i: windows[i])
            windows[best] += size
        else:
            windows.append(size)
    return sorted(windows)


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_equals_item_by_item(seed):
    draw = random.Random(seed)
    window = draw.choice([10, 64, 1024])
    sizes = [min(window, max(1, int(draw.expovariate(3 / window)))) for _ in range(400)]
    placements, used = packing.best_fit(Counter(sizes), window)
    taken = defaultdict(list)
    seen = Counter()
    for size, first, last, k, sequence, offset in placements:
        for rank in range(first, last + 1):
            nth = rank - first
            taken[sequence + nth // k].append((offset + nth % k * size, size))
            seen[size] += 1
    assert seen == Counter(sizes) and set(taken) == set(range(used))
    for parts in taken.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= window
    assert sorted(sum(s for _, s in p) for p in taken.values()) == plain_best_fit(sizes, window)


def test_packing_covers_every_id_once(spark, docs, plain_rows):
    cut = packing.tokenised(docs, RANKS, VOCABULARY, vocabularies.PATTERN, keep_ids=True)
    rows = packing.pack(cut).collect()
    tokenizer = Tokenizer.from_file(VOCABULARY)
    wanted = Counter()
    for doc_id, text in plain_rows:
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4")
        for start in range(0, len(ids), 1024):
            part = ids[start : start + 1024].tobytes()
            wanted[doc_id, start, len(part) // 4, zlib.crc32(part), part, len(ids)] += 1
    found = Counter((r.doc_id, r.start, r.length, r.ids_crc32, bytes(r.ids), r.doc_tokens) for r in rows)
    assert found == wanted
    windows = defaultdict(list)
    for r in rows:
        windows[r.sequence_id].append((r.offset, r.length))
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024


def test_added_tokens_are_those_of_the_vocabulary():
    with open(VOCABULARY, encoding="utf-8") as file:
        assert json.load(file)["added_tokens"]


def test_empty_table(spark, docs):
    none = docs.limit(0)
    assert packing.pack(packing.tokenised(none, RANKS, VOCABULARY, vocabularies.PATTERN)).count() == 0
    assert bpe.encode(none, RANKS, vocabularies.PATTERN).count() == 0
