import hashlib
import random
import zlib

import pytest
from pyspark.sql import Row

from winnow.llm import periodic_runs, queries
from winnow.llm.periodic_runs import collapse_runs, slab_runs


def brute(words):
    """Every run, by comparing all words at every distance."""
    seen = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                seen.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((start, length, q) for (start, length), q in seen.items())


def mixed(draw):
    """Words with periodic stretches around the limits of length, period and scale."""
    out, size = [], draw.choice([1, 2, 3, 50])
    for _ in range(draw.randint(0, 6)):
        if draw.random() < 0.4:
            out += [draw.randrange(size) for _ in range(draw.randint(0, 60))]
            continue
        q = draw.choice([1, 2, 3, 5, 7, 8, 9, 11, 12, 13, 15, 16, 17, 24, 31, 32, 33, 48, 64, 65, draw.randint(1, 130)])
        base = [draw.randrange(size) for _ in range(q)]
        if draw.random() < 0.3:  # a period that nearly has a smaller one
            base = (base[: max(1, q // 3)] * 5)[: q - 1] + [draw.randrange(size)]
        length = int(q * draw.choice([3, 3.9, 4, 4.1, 5, 7.5])) + draw.randint(-1, 1)
        out += [base[i % q] for i in range(max(0, length))]
    return [b"w%d" % x for x in out]


def thue_morse(n):
    word = [0]
    while len(word) < n:
        word += [1 - c for c in word]
    return [b"a%d" % c for c in word]


def test_runs_equal_brute_force():
    draw = random.Random(5)
    for _ in range(150):
        texts = [mixed(draw) for _ in range(draw.randint(1, 5))]
        for words, runs in zip(texts, slab_runs(texts), strict=True):
            assert sorted(map(tuple, runs.tolist())) == brute(words)


@pytest.mark.parametrize("direct", [2, 4, 8, 32])
def test_scales_need_no_direct_search(monkeypatch, direct):
    monkeypatch.setattr(periodic_runs, "DIRECT", direct)
    draw = random.Random(direct)
    fibonacci = [b"a"], [b"a", b"b"]
    for _ in range(12):
        fibonacci = fibonacci[1], fibonacci[1] + fibonacci[0]
    texts = [mixed(draw) for _ in range(40)] + [fibonacci[1][:500], thue_morse(256) * 5, [b"x"] * 900]
    for words, runs in zip(texts, slab_runs(texts), strict=True):
        assert sorted(map(tuple, runs.tolist())) == brute(words)


def expected(doc, text):
    words = [w for w in (text or "").encode().split()]
    n = len(words)
    h = zlib.crc32(str(doc).encode()) if doc is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    lines = "".join(f"{a},{b},{c}\n" for a, b, c in sorted(runs, key=lambda r: (r[0], r[2])))
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return Row(
        doc_id=doc, n_runs=len(runs), start=top[0], length=top[1], period=top[2],
        exponent_milli=1000 * top[1] // top[2] if runs else None,
        runs_sha256=hashlib.sha256(lines.encode()).hexdigest(),
        collapsed_sha256=hashlib.sha256(kept).hexdigest(),
    )


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((v is not None, v) for v in r))


def test_query_equals_brute_force(spark, docs, plain_rows, tmp_path):
    draw = random.Random(1)
    more = [(i, " ".join(w.decode() for w in mixed(draw))) for i in range(100, 220)]
    more += [(300, "a\x1fb\xa0c " * 8), (301, "\t\x0b é é é é é é é é\x0c"), (301, "é " * 9)]
    rows = [(doc, text) for doc, text in plain_rows if len(text) < 20_000] + more
    frame = spark.createDataFrame(rows + [(None, None)], "doc_id long, text string")
    frame.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op13_periodic_runs(spark, str(tmp_path))
    assert ordered(found.collect()) == ordered(expected(*r) for r in rows + [(None, None)])


def test_columns_empty_tables_and_whole_tables(spark, docs):
    found = collapse_runs(docs.withColumn("runs", docs.text).withColumn("kept", docs.text))
    assert found.columns == ["doc_id", "n_words", "runs", "kept"] and found.count() == docs.count()
    assert collapse_runs(docs.limit(0)).count() == 0
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    result = queries.op13_periodic_runs(spark, "/root/testdata/sf0.001")
    assert ordered(result.collect()) == ordered(expected(r.doc_id, r.text) for r in table.collect())
