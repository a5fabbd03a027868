import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from winnow.llm import fingerprint, sharding


def md5_number(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def plain_table(names, size):
    """Turn by turn: every shard walks its own preference list."""
    lists = {
        n: [(md5_number("offset:" + n) % size + i * (md5_number("skip:" + n) % (size - 1) + 1)) % size
            for i in range(size)]
        for n in names
    }
    table = {}
    while len(table) < size:
        for name in sorted(names):
            if len(table) == size:
                break
            slot = next(s for s in lists[name] if s not in table)
            table[slot] = name
            lists[name] = lists[name][lists[name].index(slot) :]
    return table


def test_lookup_table(spark):
    names = [f"s{i}" for i in range(5)]
    found = {r.slot: r.shard for r in sharding.lookup_table(spark, names, 503).collect()}
    assert found == plain_table(names, 503)
    counts = Counter(found.values())
    assert max(counts.values()) - min(counts.values()) <= 1
    fewer = plain_table(names[:-1], 503)
    moved = sum(found[s] != fewer[s] and found[s] != "s4" for s in found)
    assert moved < 503 * 0.25  # a shard that leaves moves few slots of the others


def test_placement(spark, docs):
    names = [f"s{i}" for i in range(5)]
    table = sharding.lookup_table(spark, names, 503)
    plain = plain_table(names, 503)
    rows = sharding.place(docs, "doc_id", table, 503).collect()
    assert len(rows) == docs.count()
    for r in rows:
        slot = md5_number("" if r.doc_id is None else str(r.doc_id)) % 503
        assert (r.slot, r.shard) == (slot, plain[slot])
    assert sharding.place(docs.limit(0), "doc_id", table, 503).count() == 0
    plan = sharding.place(docs, "doc_id", table, 503)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "SortMergeJoin" not in plan


@pytest.mark.parametrize(("names", "size"), [([], 503), (["a", "a"], 503), (["a"], 500), (["a"] , 97)])
def test_bad_tables(spark, names, size):
    with pytest.raises(ValueError):
        sharding.lookup_table(spark, names, size)


def test_fingerprints(spark, docs):
    found = fingerprint.fingerprints(docs).orderBy(F.col("doc_id").asc_nulls_first()).collect()
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    assert Counter((r.doc_id, r.n_chars) for r in found) == Counter((i, len(t)) for i, t in rows)
    # Rows with an id of their own have one possible predecessor.
    once = [i for i, n in Counter(i for i, _ in rows).items() if n == 1]
    texts = dict(rows)
    order = sorted(i for i in texts if i is not None)
    got = {r.doc_id: r for r in found if r.doc_id in once}
    for doc, after in zip(order, order[1:], strict=False):
        if doc in got:
            text, half = texts[doc], len(texts[doc]) // 2
            edited = text[: len(text) - half] + texts[after][:half]
            assert got[doc].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    prints = {}
    for r in found:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.fingerprint == r.edited_fingerprint) <= (r.near_edited == 1)
    for r in fingerprint.fingerprints(docs).collect():
        if r.doc_id in once:
            prints.setdefault(texts[r.doc_id], set()).add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())
    assert fingerprint.fingerprints(docs.limit(0)).count() == 0


@pytest.mark.parametrize("step", [1, 64, 100_000, 1 << 50])
def test_following(spark, step):
    ids = [i * step - 3 for i in range(150)]
    frame = spark.createDataFrame(
        [(k, i, f"t{i}") for k, i in enumerate(ids)], "_key long, doc_id long, text string"
    ).repartition(5)
    found = {r.doc_id: r._next.text for r in fingerprint.following(frame).collect()}
    assert found == {a: f"t{b}" for a, b in zip(ids, [*ids[1:], ids[0]], strict=True)}


def test_lexicon_is_a_band(spark):
    frame = spark.createDataFrame([(f"all some{i % 4} one{i}",) for i in range(40)], "text string")
    found = {r.term for r in fingerprint.lexicon(frame, 0.1, 0.5).collect()}
    assert found == {f"some{i}" for i in range(4)}
