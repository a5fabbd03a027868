import random
import re
from collections import Counter

import numpy as np
import pytest

from winnow.llm import ngram_join

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def sets_of(rows, size):
    out = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        if len(words) >= size:
            out.append(frozenset(zip(*[words[i:] for i in range(size)], strict=False)))
        else:
            out.append(frozenset([tuple(words)]) if words else frozenset())
    return out


def brute(rows, size, percent):
    """Expected rows: every pair of documents with an id is compared."""
    sets = sets_of(rows, size)
    root = {i: i for i, _ in rows if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, _) in enumerate(rows):
        for b in range(a):
            j = rows[b][0]
            if i is None or j is None or not sets[a] or not sets[b]:
                continue
            if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return Counter(
        (i, len(s), None if i is None else find(i)) for (i, _), s in zip(rows, sets, strict=True)
    )


def family(draw, base, copies, edits):
    """Copies of a text with a few words replaced each."""
    out = []
    for _ in range(copies):
        words = list(base)
        for _ in range(draw.randint(0, edits)):
            words[draw.randrange(len(words))] = f"n{draw.randrange(10**6)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80), (1, 60)])
def test_join_equals_brute_force(spark, size, percent):
    draw = random.Random(size)
    texts = []
    for length in (11, 40, 150, 400):
        base = [f"w{draw.randrange(3000)}" for _ in range(length)]
        texts += family(draw, base, 18, max(1, length // 25))
    texts += [" ".join(f"w{draw.randrange(40)}" for _ in range(draw.randint(0, 30))) for _ in range(40)]
    draw.shuffle(texts)
    rows = [(i * 2 + 1, t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = ngram_join.join(frame, size, percent).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute(rows, size, percent)


def test_links_that_a_star_misses(spark):
    """A chain: each text is near the next, the ends are far apart."""
    base = [f"w{i}" for i in range(200)]
    texts = []
    for step in range(8):
        words = list(base)
        for k in range(step * 3):
            words[k * 7] = f"x{k}"
        texts.append(" ".join(words))
    order = [5, 0, 7, 2, 6, 1, 4, 3]
    rows = [(100 + i, texts[k]) for i, k in enumerate(order)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = ngram_join.join(frame).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute(rows, 3, 90)


def test_awkward_rows(docs, plain_rows):
    found = ngram_join.join(docs).collect()
    wanted = brute(plain_rows, 3, 90)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == wanted
    assert ngram_join.join(docs.limit(0)).count() == 0


def test_ids_with_several_texts(spark):
    draw = random.Random(8)
    long, short, third = ([f"{k}{i}" for i in range(n)] for k, n in (("l", 300), ("s", 30), ("t", 90)))
    near = lambda words: family(draw, words, 1, 1)[0]
    rows = [(5, " ".join(short)), (5, " ".join(long)), (6, near(long)), (9, near(third)), (9, None)]
    rows += [(3, near(third)), (12, "one more text"), (12, " ".join(third)), (20, "same words here"),
             (21, "same words here"), (21, "other words there"), (22, "other words there"), (21, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    found = ngram_join.join(frame).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute(rows, 3, 90)


@pytest.mark.parametrize("percent", [60, 80, 90, 99])
def test_size_classes(percent):
    """Partners are in one class or the next, and the bound on differing shingles holds."""
    sizes = ngram_join.Sizes(percent)
    for a in range(1, 400):
        for b in range(a, a * 100 // percent + 1):
            low, high = sizes.of(np.array([a, b]))
            least = -(-percent * (a + b) // (100 + percent))  # overlap that reaches the threshold
            if low < 0:
                assert least > a or a == b == least or a + b - 2 * least == 0
                continue
            assert high in (low, low + 1)
            assert a + b - 2 * least <= sizes.most[low]


def test_words_that_a_polynomial_takes_as_equal(spark, alike_words):
    rows = list(enumerate(word for pair in alike_words for word in pair))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = ngram_join.join(frame, size=3, percent=90)
    assert {(r.doc_id, r.component_id) for r in found.collect()} == {(i, i) for i, _ in rows}


@pytest.mark.parametrize("seed", [5])
def test_partners_in_different_blocks_of_two(spark, seed):
    """The longest text links with both others, in blocks that hold no third text."""
    draw = random.Random(seed)
    words = [f"w{draw.randrange(10**6)}" for _ in range(62)]
    texts = [words[6:], words[:-6], words]
    rows = [(i + 1, " ".join(t)) for i, t in enumerate(texts)]
    found = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r.component_id for r in found] == [1, 1, 1]


def shown(sets, kinds, sizes):
    """The keys of the blocks that each set shows."""
    n = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), n)
    whose, keys = ngram_join.block_keys(owner, np.concatenate(sets), n, np.array(kinds), sizes)
    return [set(keys[whose == i].tolist()) for i in range(len(sets))]


@pytest.mark.parametrize("percent", [80, 90])
def test_unrelated_sets_show_no_common_block(percent):
    """Blocks without a shingle are the same in all sets; a few shingles in common are few blocks."""
    draw = np.random.default_rng(percent)
    sizes = ngram_join.Sizes(percent)
    passage = draw.integers(0, 1 << 62, 40)
    sets = [np.unique(np.append(passage, draw.integers(0, 1 << 62, 4960 + 8 * i))).astype(np.uint64) for i in range(40)]
    kinds = sizes.of(np.array([len(s) for s in sets]))
    for lower in (0, 1):
        keys = Counter(key for own in shown(sets, kinds - lower, sizes) for key in own)
        pairs = sum(count * (count - 1) // 2 for count in keys.values())
        assert pairs < 40  # of 780


@pytest.mark.parametrize("percent", [60, 80, 90, 99])
def test_linked_sets_show_a_common_block(percent):
    draw = np.random.default_rng(percent)
    sizes = ngram_join.Sizes(percent)
    for n in (int(sizes.bounds[0]), 7, 12, 40, 41, 150, 700, 1500):
        for m in {n, (n + n * 100 // percent) // 2, n * 100 // percent}:
            if sizes.of(np.array([n]))[0] < 0:
                continue
            for _ in range(20):
                both = -(-percent * (n + m) // (100 + percent))
                own = draw.integers(0, 1 << 62, n + m - both).astype(np.uint64)
                sets = [np.sort(own[:n]), np.sort(own[n - both :])]
                kind = sizes.of(np.array([n]))[0]
                assert set.intersection(*shown(sets, [kind, kind], sizes)), (n, m)


def edited(draw, words, share):
    """The words with a share of them replaced, hence about five times that of their 5-word shingles."""
    return [f"n{draw.randrange(10**6)}" if draw.random() < share else w for w in words]


def test_sketches_of_long_sets_differ_in_no_more_bits_than_shingles():
    draw = np.random.default_rng(2)
    sets = [np.unique(draw.integers(0, 1 << 62, n).astype(np.uint64)) for n in (1500, 1500, 2100, 9000)]
    sets.append(np.concatenate([sets[2][:2000], sets[0][:40]]))
    bits = [ngram_join.long_sketch(np.sort(s)) for s in sets]
    assert len({len(b) for b in bits}) == 3
    pairs = np.array([(a, b) for a in range(5) for b in range(5)])
    for (a, b), found in zip(pairs, ngram_join.differing(bits, pairs), strict=True):
        least = len(np.setxor1d(sets[a], sets[b]))
        assert found <= least and found % 2 == least % 2
    assert ngram_join.differing(bits, np.array([(2, 4)]))[0] > 130  # of 140


def test_whole_sets_are_sent_for_near_pairs_only(spark, monkeypatch):
    """Long texts of one template share blocks, but are not near: their sketches tell that."""
    draw = random.Random(9)
    template = [f"w{draw.randrange(10**6)}" for _ in range(3000)]
    texts = [edited(draw, template, 0.05) for _ in range(12)]
    texts += [edited(draw, texts[0], 0.005), edited(draw, texts[5], 0.01), texts[7][:300]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    rows += [(40, rows[3][1]), (40, "short"), (41, " ".join(edited(draw, texts[3], 0.005)))]
    sent = []
    left = ngram_join.possible

    def seen(pairs, bits, percent):
        out = left(pairs, bits, percent)
        sent.extend((r.a, r.b) for r in out.collect())
        return out

    monkeypatch.setattr(ngram_join, "possible", seen)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = ngram_join.join(frame, 5, 80).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == brute(rows, 5, 80)
    assert {(0, 12), (5, 13)} <= set(sent) and len(sent) < 12
