import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from winnow.operators import audit, commits, poller, scores

G = ["netuid", "epoch"]


def group(spark, weights, column="weight"):
    rows = [(1, 1, i, float(w)) for i, w in enumerate(weights)]
    return spark.createDataFrame(rows, f"netuid int, epoch int, uid int, {column} double")


def values(df, column="weight"):
    return [r[column] for r in df.orderBy("uid").collect()]


def test_ema(spark):
    rows = [(1, 10, 0, 0.5), (1, 20, 0, 1.0), (1, 9000, 0, 0.0), (2, 5, 0, 0.5), (2, 5, 1, 1.0)]
    df = spark.createDataFrame(rows, "uid int, step bigint, tie int, score double")
    found = {r.uid: r.score for r in scores.ema_score(df).collect()}
    assert found == pytest.approx({1: 0.224, 2: 0.28})


def test_latest_and_dense(spark):
    log = spark.createDataFrame(
        [(1, 1, 0.2), (1, 2, None), (1, 3, 0.4), (None, 9, 1.0)], "uid int, step int, score double"
    )
    latest = scores.latest_score(log)
    assert [tuple(r) for r in latest.collect()] == [(1, 0.4)]
    members = spark.createDataFrame([(1,), (2,)], "uid int")
    assert {tuple(r) for r in scores.dense_scores(members, latest).collect()} == {(1, 0.4), (2, 0.0)}


def test_l1(spark, small_hot):
    assert values(scores.l1_weights(group(spark, [1, 3, -4], "score"), G)) == [0.125, 0.375, -0.5]
    assert values(scores.l1_weights(group(spark, [0, 0], "score"), G)) == [0, 0]
    assert values(scores.l1_weights(group(spark, [1, math.nan], "score"), G)) == []


def water_fill(weights, limit, epsilon=1e-7):
    """Brute force: cap the k largest, with the smallest k that leaves none above the cutoff."""
    total = sum(weights)
    if total == 0 or len(weights) * limit <= 1:
        return [1 / len(weights)] * len(weights)
    shares = sorted((w / total for w in weights), reverse=True)
    if shares[0] <= limit:
        return [w / total for w in weights]
    for k in range(1, len(weights)):
        cutoff = (limit * sum(shares[k:]) - epsilon) / (1 - limit * k)
        if shares[k] <= cutoff:
            break
    cut = [min(w, cutoff * total) for w in weights]
    return [w / sum(cut) for w in cut]


@pytest.mark.parametrize("hot", [False, True])
def test_capped(spark, request, hot):
    if hot:
        request.getfixturevalue("small_hot")
    weights = [0.9, 0.6, 0.5, 0.2] + [0.05] * 12 + [0.0] * 4
    found = values(scores.capped_weights(group(spark, weights), 0.1, G))
    assert sum(found) == pytest.approx(1)
    assert max(found) == pytest.approx(0.0999997, abs=1e-6)
    assert found == pytest.approx(water_fill(weights, 0.1), abs=1e-6)
    assert values(scores.capped_weights(group(spark, [5, 1, 1, 0, 0]), 0.1, G)) == [0.2] * 5
    assert values(scores.capped_weights(group(spark, [0] * 20), 0.1, G)) == [0.05] * 20


def test_capped_random(spark):
    rng = random.Random(4)
    rows, expected = [], {}
    for epoch in range(12):
        weights = [rng.random() ** rng.choice((1, 4, 12)) for _ in range(rng.randrange(3, 60))]
        limit = 0.07
        for uid, (w, x) in enumerate(zip(weights, water_fill(weights, limit))):
            rows.append((1, epoch, uid, w))
            expected[epoch, uid] = x
    df = spark.createDataFrame(rows, "netuid int, epoch int, uid int, weight double")
    found = scores.capped_weights(df, 0.07, G).collect()
    assert {(r.epoch, r.uid): r.weight for r in found} == pytest.approx(expected, abs=1e-6)


def test_process(spark):
    uniform = values(scores.process_weights(group(spark, [0, 0, 0, 0]), 2, 0.5, G))
    assert uniform == [0.25] * 4
    few = values(scores.process_weights(group(spark, [1, 0, 0, 0]), 2, 0.9, G))
    assert few == pytest.approx(water_fill([1 + 1e-5, 1e-5, 1e-5, 1e-5], 0.9), abs=1e-6)
    short = values(scores.process_weights(group(spark, [1, 2]), 3, 0.9, G))
    assert short == [0.5, 0.5]


@pytest.mark.parametrize("quantile", [0, 20000, 65535])
def test_process_quantile(spark, quantile):
    import numpy as np

    weights = [0.0, 0.3, 0.1, 0.25, 0.2, 0.15, 0.05, 0.4]
    positive = np.array([w for w in weights if w > 0])
    cut = min(quantile / 65535, max(0, len(positive) - 3) / len(positive))
    low = np.quantile(positive, cut)
    kept = [(i, w) for i, w in enumerate(weights) if w > 0 and w >= low]
    expected = water_fill([w for _, w in kept], 0.5)
    found = scores.process_weights(group(spark, weights), 3, 0.5, G, quantile).orderBy("uid").collect()
    assert [r.uid for r in found] == [i for i, _ in kept]
    assert [r.weight for r in found] == pytest.approx(expected, abs=1e-6)


def test_emit(spark):
    emitted = scores.emit_weights(group(spark, [0.5, 0.25, 0.000001]), G).orderBy("uid").collect()
    assert [(r.uid, r.w_u16) for r in emitted] == [(0, 65535), (1, 32768)]
    assert scores.emit_weights(group(spark, [0, 0]), G).count() == 0
    with pytest.raises(Exception, match="negative weight"):
        scores.emit_weights(group(spark, [1, -1]), G).collect()


def test_emit_does_not_depend_on_the_last_bits_of_a_sum(spark):
    norms = [1_000_000.7 + 0.37 * i for i in range(60)]
    rows = [(i, uid, score / norm) for i, norm in enumerate(norms) for uid, score in ((0, 256.0), (1, 25.6))]
    df = spark.createDataFrame(rows, "epoch int, uid int, weight double")
    emitted = scores.emit_weights(df, ["epoch"]).where("uid = 1").collect()
    assert [r.w_u16 for r in emitted] == [6554] * 60  # 65535 / 10 is a half


def test_weight_epochs(spark):
    rows = [(1, 100, 0, 0.5), (1, 150, 0, 0.6), (1, 401, 0, 0.7), (2, 300, 0, 0.1)]
    df = spark.createDataFrame(rows, "uid int, step bigint, tie int, score double")
    found = {(r.epoch, r.uid): r.score for r in scores.weight_epochs(df).collect()}
    assert found == {
        (100, 1): 0.5, (200, 1): 0.6, (300, 1): 0.6, (400, 1): 0.6, (500, 1): 0.7,
        (300, 2): 0.1, (400, 2): 0.1, (500, 2): 0.1,
    }


def test_weight_intervals_and_norms_equal_every_epoch(spark):
    draw = random.Random(5)
    rows = [(draw.randrange(6), draw.randrange(3000), i, draw.randrange(-50, 100) / 100) for i in range(200)]
    rows.append((9, 2950, 200, 0.25))
    df = spark.createDataFrame(rows, "uid int, step bigint, tie int, score double")
    intervals = scores.weight_intervals(df)
    held = intervals.collect()
    assert len(held) <= len(rows) and all(r.epoch < r.until for r in held)
    every = {(r.epoch, r.uid): r.score for r in scores.weight_epochs(df).collect()}
    assert every == {(e, r.uid): r.score for r in held for e in range(r.epoch, r.until, 100)}
    norms = scores.epoch_norms(intervals).collect()
    found = {e: (r.members, round(r.norm, 9)) for r in norms for e in range(r.epoch, r.until, 100)}
    epochs = {e for e, _ in every}
    assert found == {
        e: (len(own), round(sum(map(abs, own)), 9))
        for e in epochs for own in [[v for (at, _), v in every.items() if at == e]]
    }
    none = scores.weight_intervals(df.limit(0))
    assert none.count() == 0 and scores.epoch_norms(none).count() == 0


def test_new_commits(spark):
    rows = [
        (1, "a", 1000, 8199), (1, "a", 1000, 8200), (1, "b", 9000, 9001), (1, "b", 9000, 16_200),
        (1, "a", 16_250, 16_300), (2, "z", 0, 7200),
    ]
    df = spark.createDataFrame(rows, "uid int, commit string, commit_block bigint, seen_block bigint")
    found = commits.new_commits(df).orderBy("seen_block").collect()
    assert [(r.uid, r.commit, r.seen_block) for r in found] == [
        (1, "a", 8199), (1, "b", 9001), (1, "a", 16_300),
    ]


def test_stale_decay(spark):
    rows = [
        (1, "a", 1000, 1005), (1, "a", 1000, 8200), (1, "a", 1000, 8201), (1, "a", 1000, 15_401),
        (1, "a", 1000, 15_402), (2, "old", 0, 9000), (3, "a", 190, 200), (3, "b", 700, 8000), (3, "a", 8900, 9000),
    ]
    df = spark.createDataFrame(rows, "uid int, commit string, commit_block bigint, seen_block bigint")
    decays = sorted((r.uid, r.block) for r in commits.stale_decay(df).collect())
    assert decays == [(1, 8201), (1, 15_402), (2, 9000), (3, 8000)]
    # The stale poll of another commit was taken, so the first one is new again.
    accepted = commits.new_commits(df.where("uid = 3")).collect()
    assert sorted(r.seen_block for r in accepted) == [200, 9000]


def polls_of(draw, size, age, uids):
    rows, seen = [], 0
    for i in range(size):
        seen += draw.choice([0, 1, 2, 3, 9, age, age + 1])
        commit = draw.choice(["a", "b", "c", None])
        rows.append((draw.choice(uids), commit, seen - draw.randint(0, 2 * age), seen, i))
    return rows


POLLS = "uid bigint, commit string, commit_block bigint, seen_block bigint, event_id bigint"


def expected_events(rows, age):
    """The poller's loop, as it is written down for one machine."""
    state, out = {}, []
    order = lambda r: (r[3], r[2], r[1], r[4])
    known = (r for r in rows if r[0] is not None and r[1] is not None)
    for uid, commit, block, seen, event in sorted(known, key=order):
        last, timer = state.get(uid, (None, 0))
        if seen - block < age and commit != last:
            state[uid] = (commit, block)
            out.append((uid, event, "commit"))
        elif seen - timer > age:
            state[uid] = (commit, seen)
            out.append((uid, event, "decay"))
    return sorted(out, key=str)


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_stretches_of_polls_compose(spark, width):
    """A submitter with most polls is many stretches, with one result."""
    draw = random.Random(width)
    rows = polls_of(draw, 400, 10, [1, 1, 1, 2, 3, None])
    df = spark.createDataFrame(rows, POLLS).repartition(3)
    found = commits.replay_commits(df, 10, width).collect()
    assert sorted(((r.uid, r.event_id, r.kind) for r in found), key=str) == expected_events(rows, 10)


def test_summaries_lead_where_polls_lead():
    draw = random.Random(3)
    for _ in range(3000):
        age = draw.choice([5, 10, 30])
        rows = sorted((r for r in polls_of(draw, draw.randint(0, 14), age, [1]) if r[1]), key=lambda r: (r[3], r[2], r[1]))
        polls = [poller.Poll(*r[1:4]) for r in rows]
        before = draw.choice([None, "a", "b", "c"]), draw.randint(-2 * age, rows[-1][3] if rows else 9)
        after = [before, *(state for _, _, state in poller.replay(polls, before, age))][-1]
        assert poller.applied(poller.summary(polls, age), before, age) == after


def test_commit_key_and_pair_hash(spark):
    df = spark.createDataFrame([("u/r:h",), ("a:b:c",), ("plain",)], "k string")
    found = df.select(commits.commit_key(F.col("k")).alias("p")).collect()
    assert [r.p and tuple(r.p) for r in found] == [("u/r", "h"), None, None]
    import base64
    import hashlib

    expected = base64.b64encode(hashlib.sha256(b"abcd").digest()).decode()
    pair = spark.range(1).select(commits.pair_hash(F.lit("ab"), F.lit("cd")).alias("h"))
    assert pair.first().h == expected


def test_similarity_gate(spark):
    def gate(sims):
        tasks = spark.createDataFrame([(1,)], "uid int")
        rows = spark.createDataFrame([(1, float(s)) for s in sims], "uid int, similarity double")
        return audit.similarity_gate(rows, tasks, ["uid"]).first().gate

    assert gate([70.0] * 9 + [99] * 21) == 0
    assert gate([70.0] * 8 + [99] * 22) == 1
    assert gate([]) == 0


def test_submission_score(spark):
    rows = [(1, 0.4, 0.03, 43200), (1, 0.4, 0.03, 200_000), (1, 0.4, 0.03, -5), (0, 0.4, 0.03, 0)]
    df = spark.createDataFrame(rows, "gate int, value double, stderr double, elapsed bigint")
    found = [r.score for r in audit.submission_score(df).collect()]
    assert found == pytest.approx([0.4216, 0.2716, 0.5716, 0.0])


def test_elapsed_time(spark, small_hot):
    work = spark.createDataFrame([(1, 7, 100)], "uid int, task_id int, request_block bigint")
    seen = spark.createDataFrame([(1, 200), (2, 200)], "uid int, commit_block bigint")
    assert [(r.uid, r.elapsed) for r in audit.elapsed_time(seen, work).collect()] == [(1, 1200)]


def test_word_overlap(spark):
    rows = [
        (1, "the cat cat sat", "cat cat cat sat dog"), (2, "anything", "the and of"),
        (3, "re-used x1 words", "Words WORDS"), (4, "", "lonely"),
    ]
    df = spark.createDataFrame(rows, "id int, original string, refined string")
    found = {r.id: r.similarity for r in audit.word_overlap(df).collect()}
    assert found == {1: 60.0, 2: 0.0, 3: 50.0, 4: 0.0}


def test_audit_pairs_by_id(spark):
    refined = spark.createDataFrame([(i, f"alpha beta w{i}") for i in range(5)], "id int, text string")
    raw = spark.createDataFrame([(i, f"alpha w{i}") for i in range(1, 5)], "id int, text string")
    found = audit.audit_corpus(refined, raw, n=10).collect()
    assert {r.id: r.similarity for r in found} == {i: 50.0 for i in range(1, 5)}


@pytest.mark.parametrize("n", [3, 40])
def test_audit_of_many_submissions(spark, n):
    # Submission 0 is much larger than the others, 2 repeats rows, 3 copies nothing, 4 is unknown.
    rows = [(0, i, f"alpha w{i}") for i in range(300)]
    rows += [(1, i, f"alpha beta w{i}") for i in range(10)]
    rows += [(2, 5, "alpha"), (2, 5, "alpha"), (2, 6, None), (2, None, "alpha"), (None, 7, "alpha")]
    rows += [(3, i, "other words here") for i in range(20)] + [(4, 900, "alpha")]
    refined = spark.createDataFrame(rows, "uid int, id int, text string").repartition(5)
    raw = spark.createDataFrame([(i, f"alpha w{i}") for i in range(300)], "id int, text string")
    picked = audit.sampled_ids(refined, ["uid"], n, 7)

    def key(i):
        return hashlib.md5(f"7:{i}".encode()).hexdigest(), i

    expected = set()
    for uid in range(5):
        ids = sorted({i for u, i, _ in rows if u == uid and i is not None}, key=key)
        expected |= {(uid, i) for i in ids[:n]}
    assert sorted((r.uid, r.id) for r in picked.collect()) == sorted(expected)
    found = audit.audit_samples(picked, refined, raw, ["uid"])
    share = {0: 100.0, 1: 50.0, 2: 100.0, 3: 0.0}
    assert {(r.uid, r.id): r.similarity for r in found.collect()} == {
        (u, i): 0.0 if (u, i) == (2, 6) else share[u] for u, i in expected if u != 4
    }
    tasks = spark.range(6).selectExpr("CAST(id AS int) AS uid")
    gates = audit.similarity_gate(found, tasks, ["uid"]).collect()
    assert {r.uid: r.gate for r in gates} == {0: 1, 1: 0, 2: 0, 3: 0, 4: 0, 5: 0}


def test_audit_of_no_rows(spark):
    nothing = spark.createDataFrame([], "uid int, id int, text string")
    picked = audit.sampled_ids(nothing, ["uid"], 3, 7)
    assert audit.audit_samples(picked, nothing, nothing.select("id", "text"), ["uid"]).count() == 0


def test_sample_rows(spark):
    df = spark.range(100).selectExpr("id", "id % 3 as g")
    one = {r.id for r in audit.sample_rows(df, 10, 1).collect()}
    assert len(one) == 10
    assert one == {r.id for r in audit.sample_rows(df.repartition(9), 10, 1).collect()}
    assert one != {r.id for r in audit.sample_rows(df, 10, 2).collect()}
    assert audit.sample_rows(df, 4, 1, by="g").count() == 12
    assert audit.sample_rows(df, 500, 1).count() == 100
    with pytest.raises(ValueError):
        audit.sample_rows(df, 500, 1, strict=True)


def test_parse_eval_log(spark):
    line = "|     truthfulqa_mc2|0.4123|±  |0.0312|\n|truthfulqa_mc2 |0.41|± |0.0312|\n|other|0.4123|± |0.03|"
    df = spark.createDataFrame([(1, line)], "run_id int, line string")
    rows = audit.parse_eval_log(df)
    assert [tuple(r) for r in rows.collect()] == [(1, "truthfulqa_mc2", 0.4123, 0.0312)]
    none = rows.withColumn("metric", F.lit("other"))
    assert tuple(audit.eval_summary(none).first()) == (1, 0.0, 0.0)


def test_corpus_quality_eval(spark):
    rng = random.Random(6)
    rows = []
    for i in range(300):
        label = i % 2
        words = rng.choices(["sun", "sea", "sand"] if label else ["rock", "ice", "wind"], k=12)
        rows.append((i, " ".join(words), label))
    df = spark.createDataFrame(rows, "id int, text string, label int")
    clean = audit.corpus_quality_eval(df).first()
    assert (clean.value, clean.stderr) == (1.0, 0.0)
    noisy = df.withColumn("label", F.when(F.col("id") % 10 < 3, F.lit(0)).otherwise(F.lit(1)))
    worse = audit.corpus_quality_eval(noisy).first()
    held_out = audit.sample_key(F.col("id"), 0)
    share = F.conv(F.substring(held_out, 1, 4), 16, 10).cast("int") < int(0.2 * 65536)
    n = df.where(share).count()
    assert 0.4 < worse.value < 1.0
    assert worse.stderr == pytest.approx(math.sqrt(worse.value * (1 - worse.value) / n))
