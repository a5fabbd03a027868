"""Streams over several batches against the same work in one batch."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window, functions as F

from winnow.operators import dedup, language, scores
from winnow.plans import queries as q
from winnow.plans import refine
from winnow.session import scratch_path
from winnow.sources.tables import read_table
from winnow.streaming import chunks, commits, refine as refine_streams, runner

SF = "/root/testdata/sf0.001"


def in_files(spark, df, path, order, count):
    """Write `df` as `count` files in `order`; returns a stream of one file per batch."""
    cut = df.withColumn("_f", F.ntile(count).over(Window.orderBy(order)))
    for k in range(1, count + 1):
        part = cut.where(F.col("_f") == k).drop("_f").coalesce(1)
        part.write.mode("append").parquet(path)
    return runner.file_stream(spark, path, df.schema, files_per_batch=1)


def test_commit_stream_over_batches(spark, tmp_path):
    polls = q.observations(spark, SF).where("commit is not null")
    stream = in_files(spark, polls, str(tmp_path / "in"), "seen_block", 4)
    path = runner.run_available(commits.commit_stream(stream), str(tmp_path / "out"))
    rows = spark.read.parquet(f"{path}/rows")
    found = sorted(tuple(r) for r in rows.select("uid", "kind", "commit", "block").collect())
    assert found == sorted(tuple(r) for r in q.commit_stream(spark, SF).collect())
    # The batch operators find the same events.
    accepted = {(r.uid, "commit", r.commit, r.seen_block) for r in q.new_commits(spark, SF).collect()}
    decays = {(r.uid, r.block) for r in q.stale_decay(spark, SF).collect()}
    assert accepted == {r for r in found if r[1] == "commit"}
    assert decays == {(r[0], r[3]) for r in found if r[1] == "decay"}


def test_commit_stream_rules(spark, tmp_path):
    rows = [
        (1, "a", 0, 10), (1, "a", 0, 7200), (1, "a", 0, 7201), (1, "a", 0, 14_401),
        (1, "a", 0, 14_402), (1, "b", 14_000, 14_500), (2, "old", 0, 9000),
    ]
    df = spark.createDataFrame(rows, "uid bigint, commit string, commit_block bigint, seen_block bigint")
    stream = in_files(spark, df, str(tmp_path / "in"), "seen_block", 3)
    path = runner.run_available(commits.commit_stream(stream), str(tmp_path / "out"))
    found = sorted((r.uid, r.block, r.kind) for r in spark.read.parquet(f"{path}/rows").collect())
    assert found == [
        (1, 10, "commit"), (1, 7201, "decay"), (1, 14_402, "decay"), (1, 14_500, "commit"),
        (2, 9000, "decay"),
    ]


def score_inputs(spark):
    """Polls of five uids over some days, one of them without a task, one failing its gate."""
    draw = random.Random(8)
    polls = []
    for i in range(160):
        seen = 10_000 + i * 500
        polls.append((draw.randrange(5), draw.choice("abcd"), seen - draw.randint(0, 9000), seen))
    observed = spark.createDataFrame(polls, "uid bigint, commit string, commit_block bigint, seen_block bigint")
    tasks = [(u, u * 10, 9000 + u, int(u != 1)) for u in range(4)]
    evaluations = [(u, c, (u + 1) / 7, 0.1 * ord(c) / 97) for u in range(5) for c in "abd"]
    return (
        polls,
        observed,
        {t[0]: t for t in tasks},
        {(e[0], e[1]): e for e in evaluations},
        spark.createDataFrame(tasks, "uid bigint, task_id bigint, request_block bigint, gate int"),
        spark.createDataFrame(evaluations, "uid bigint, commit string, value double, stderr double"),
    )


def expected_log(polls, tasks, evaluations, known=()):
    state, totals, count, log = {}, dict(known), {}, []
    for uid, commit, block, seen in sorted(polls, key=lambda p: (p[3], p[2], p[1])):
        last, timer = state.get(uid, (None, 0))
        if seen - block < 7200 and commit != last:
            state[uid], kind = (commit, block), "commit"
        elif seen - timer > 7200:
            state[uid], kind = (commit, seen), "decay"
        else:
            continue
        count[uid] = count.get(uid, 0) + 1
        score = None
        if kind == "commit":
            if uid not in tasks or (uid, commit) not in evaluations:
                continue
            _, _, request, gate = tasks[uid]
            _, _, value, stderr = evaluations[uid, commit]
            late = max(0, min((block - request) * 12, 86400)) / 86400
            score = (0.7 * value * (1 - stderr) + 0.3 * (1 - late)) if gate else 0.0
        totals[uid] = 0.8 * totals.get(uid, 0.0) + 0.2 * (score or 0.0)
        log.append((uid, count[uid], seen, kind, score, totals[uid]))
    return sorted(log, key=str)


def log_rows(frame):
    return sorted(((r.uid, r.seq, r.block, r.kind, r.score, r.total) for r in frame.collect()), key=str)


def same_log(found, expected):
    assert [r[:4] for r in found] == [r[:4] for r in expected]
    for f, e in zip(found, expected, strict=True):
        assert f[4:] == pytest.approx(e[4:])


def test_score_stream_stops_and_goes_on(spark, tmp_path):
    """Commits accepted and decays move one score, also over a stop in the middle of the polls."""
    polls, observed, known_tasks, known_evaluations, tasks, evaluations = score_inputs(spark)
    path, folder = str(tmp_path / "out"), str(tmp_path / "in")
    expected = expected_log(polls, known_tasks, known_evaluations)
    assert {r[3] for r in expected} == {"commit", "decay"} and {r[0] for r in expected} == {0, 1, 2, 3, 4}
    for part in ("seen_block < 40000", "seen_block >= 40000"):
        stream = in_files(spark, observed.where(part), folder, "seen_block", 2)
        looped = commits.score_stream(stream, tasks, evaluations)
        runner.run_available(looped, path, commits.report_batches(path))
    log = spark.read.parquet(f"{path}/totals")
    same_log(log_rows(log), expected)
    reports = spark.read.parquet(f"{path}/reports")
    assert reports.count() == sum(r[3] == "commit" for r in expected)
    # A repeated batch changes nothing.
    last = log.where("batch = 3").drop("batch")
    commits.report_batches(path)(last, 3)
    log = spark.read.parquet(f"{path}/totals")
    same_log(log_rows(log), expected)
    # A new loop takes up the scores of the log.
    before = scores.latest_score(log.selectExpr("uid", "seq AS step", "total AS score"))
    stream = in_files(spark, observed, str(tmp_path / "again"), "seen_block", 1)
    looped = commits.score_stream(stream, tasks, evaluations, before)
    again = runner.run_available(looped, str(tmp_path / "new"))
    held = {r.uid: r.score for r in before.collect()}
    same_log(log_rows(spark.read.parquet(f"{again}/rows")), expected_log(polls, known_tasks, known_evaluations, held))


def test_weight_stream_has_all_members_and_last_epochs(spark, tmp_path):
    log = [(1, 1, 130, 0.5), (1, 2, 150, 0.6), (2, 1, 200, 0.2), (1, 3, 460, 0.9), (77, 1, 300, 1.0), (2, 2, 201, 0.4)]
    frame = spark.createDataFrame(log, "uid bigint, seq bigint, block bigint, total double")
    members = spark.createDataFrame([(1,), (2,), (3,)], "uid bigint")
    spark.createDataFrame([(700,)], "block bigint").write.parquet(str(tmp_path / "ticks"))
    clock = runner.file_stream(spark, str(tmp_path / "ticks"), "block bigint")
    stream = in_files(spark, frame, str(tmp_path / "in"), "block", 2)
    epochs = commits.member_epochs(stream, members, 100, clock, delay="1200 seconds")
    path = runner.run_available(epochs, str(tmp_path / "out"))
    found = {(r.epoch, r.uid): r.score for r in spark.read.parquet(f"{path}/rows").collect()}
    one = [0.0, 0.6, 0.6, 0.6, 0.9, 0.9]
    two = [0.0, 0.2, 0.4, 0.4, 0.4, 0.4]
    expected = {(100 * (i + 1), uid): s for uid, row in ((1, one), (2, two), (3, [0.0] * 6)) for i, s in enumerate(row)}
    assert {k: v for k, v in found.items() if k[0] <= 600} == expected
    with pytest.raises(ValueError):
        commits.member_epochs(stream, members, 150)


class Held:
    """A state of a processor, and its handle, in memory."""

    def __init__(self):
        self.rows, self.timers = [], []
        self.get = lambda: iter(self.rows) if self.many else self.rows
        self.exists = lambda: bool(self.rows)
        self.appendList = lambda rows: self.rows.extend(rows)
        self.clear = lambda: self.put([])

    def put(self, rows):
        self.rows = rows

    update = put

    def of(self, many):
        state = Held()
        state.many = many
        return state

    getValueState = lambda self, name, schema: self.of(False)
    getListState = lambda self, name, schema: self.of(True)
    registerTimer = lambda self, at: self.timers.append(at)
    getCurrentWatermarkInMs = lambda self: self.watermark


def test_one_timer_closes_epochs_of_all_members_of_a_bucket(monkeypatch):
    monkeypatch.setattr(commits, "CELLS", 100)  # three epochs at once
    rng = np.random.default_rng(5)
    log = pd.DataFrame({"uid": rng.integers(0, 40, 400), "block": rng.integers(0, 3000, 400) // 50 * 50})
    log["seq"], log["total"] = np.arange(400), rng.random(400)
    handle = Held()
    one = commits.MemberProcessor(100)
    one.init(handle)
    one.handleInitialState((0,), pd.DataFrame({"uid": range(30)}), None)
    found = {}
    for first, until, closed in ((0, 1500, 1250), (1500, 3000, 2900)):
        part = log[(log["block"] >= first) & (log["block"] < until)]
        list(one.handleInputRows((0,), iter([part]), None))
        handle.watermark = closed * commits.BLOCK_SECONDS * 1000
        for frame in one.handleExpiredTimer((0,), handle, None):
            found |= {(e, u): s for e, u, s in frame.itertuples(index=False)}
    assert handle.timers[-1] == 3000 * commits.BLOCK_SECONDS * 1000 and len(handle.timers) == 3
    for uid in range(30):
        for epoch in range(100, 3000, 100):
            before = log[(log["uid"] == uid) & (log["block"] <= epoch)].sort_values(["block", "seq"])
            assert found.pop((epoch, uid)) == (before["total"].iloc[-1] if len(before) else 0.0)
    assert not found


def test_weights_of_a_closed_epoch(spark, tmp_path):
    rows = [(100, u, 0.1 * u) for u in range(12)] + [(200, u, 0.0) for u in range(12)]
    frame = spark.createDataFrame(rows, "epoch bigint, uid bigint, score double")
    step = commits.weight_batches(str(tmp_path), 8, 0.5)
    for _ in range(2):  # a repeated batch replaces itself
        step(frame, 0)
    found = {(r.epoch, r.uid): r.w_u16 for r in spark.read.parquet(f"{tmp_path}/weights").collect()}
    assert found[100, 11] == 65535 and found[100, 1] == round(65535 / 11) and (100, 0) not in found
    assert {found[200, u] for u in range(12)} == {65535}  # nobody has a score: all alike
    step(frame.limit(0), 1)


def test_recent_commits(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, 0, 7199), (2, 0, 7200)], "uid bigint, commit_block bigint, seen_block bigint"
    ).withColumn("ts", F.timestamp_seconds("seen_block"))
    stream = in_files(spark, df, str(tmp_path / "in"), "seen_block", 1)
    path = runner.run_available(commits.recent_commits(stream), str(tmp_path / "out"))
    assert [r.uid for r in spark.read.parquet(f"{path}/rows").collect()] == [1]


def test_chunk_reassembly(spark):
    rows = [(1, 0, "ab\ncd"), (1, 1, "\nef"), (2, 1, "y"), (2, 0, "x\n\n")]
    df = spark.createDataFrame(rows, "conv_id bigint, seq bigint, chunk string")
    whole = {(r.conv_id, r.completion) for r in chunks.chunk_reassembly(df).collect()}
    assert whole == {(1, "abcdef"), (2, "xy")}
    long = spark.range(5000).selectExpr("7 AS conv_id", "id AS seq", "'x' AS chunk")
    assert [r.completion for r in chunks.chunk_reassembly(long).collect()] == ["x" * 5000]


def test_chunk_stream_out_of_order(spark, tmp_path):
    rows = [(1, 2, "c", 0), (1, 0, "a\n", 1), (1, 1, "b", 2), (1, 3, "d", 2), (2, 0, "z", 0)]
    df = spark.createDataFrame(rows, "conv_id bigint, seq bigint, chunk string, batch int")
    stream = in_files(spark, df, str(tmp_path / "in"), "batch", 5)
    path = runner.run_available(chunks.chunk_stream(stream), str(tmp_path / "out"))
    pieces = spark.read.parquet(f"{path}/rows").orderBy("conv_id", "at").collect()
    assert "".join(p.text for p in pieces if p.conv_id == 1) == "abcd"
    assert [p.text for p in pieces if p.conv_id == 2] == ["z"]


def test_batch_of_one_file_is_spread(spark):
    cores = spark.sparkContext.defaultParallelism
    one = refine_streams.spread_batch(spark.range(100).coalesce(1))
    assert one.rdd.getNumPartitions() == cores and one.count() == 100


def test_refine_stream_over_batches(spark, tmp_path):
    profiles = q.profiles(spark, SF)
    pages = q.pages(spark, SF).select("id", "url", "html")
    settings = refine.RefineSettings(domains=q.BLOCKED_DOMAINS)
    clean = refine.kept(refine.refine(pages, profiles, settings)).select("id").limit(3)
    copies = pages.join(clean, "id").withColumn("id", F.col("id") + 100_000)
    both = pages.unionByName(copies)
    stream = in_files(spark, both, str(tmp_path / "in"), "id", 3)
    path = str(tmp_path / "out")
    runner.run_available(stream, path, refine_streams.refine_batches(profiles, path, settings))
    corpus = spark.read.parquet(f"{path}/corpus")
    whole = refine.kept(refine.refine(both, profiles, settings))
    expected = {r.id for r in dedup.minhash_dedup(whole).collect()}
    assert {r.id for r in corpus.collect()} == expected
    assert corpus.where("id >= 100000").count() == 0


def test_refine_stream_remembers_dropped_texts(spark, tmp_path, monkeypatch):
    """B is a copy of A, C of B but not of A: C goes too, as in one batch."""
    profiles = q.profiles(spark, SF)
    settings = refine.RefineSettings()
    page = refine.kept(refine.refine(q.pages(spark, SF).select("id", "url", "html"), profiles, settings)).first()
    words = page.text.split(" ")
    rows = []
    for step in range(3):
        changed = list(words)
        for k in range(step * (len(words) // 40)):
            changed[(k * 31) % len(words)] += f"x{k}"
        rows.append((step, page.text, changed))
    frame = spark.createDataFrame([(i, " ".join(c)) for i, _, c in rows], "id bigint, text string")
    bands = {}
    for r in dedup.band_keys(dedup.minhash_signature(frame)).collect():
        bands.setdefault(r.id, set()).add((r.band, bytes(r.key)))
    fresh = lambda df, *_: df.select("id", "text").withColumns(
        {"drop_stage": F.lit(None).cast("string"), "drop_reason": F.lit(None).cast("string")}
    )
    monkeypatch.setattr(refine_streams, "refine", fresh)
    stream = in_files(spark, frame.withColumn("_b", F.col("id")), str(tmp_path / "in"), "_b", 3)
    path = str(tmp_path / "out")
    runner.run_available(stream, path, refine_streams.refine_batches(profiles, path, settings))
    found = {r.id for r in spark.read.parquet(f"{path}/corpus").collect()}
    assert found == {r.id for r in dedup.minhash_dedup(frame).collect()}


def test_kept_and_removed_are_the_input(spark):
    refined = q.refined_pages(spark, SF).cache()
    total = read_table(spark, SF, "pages").count()
    assert refine.kept(refined).count() + refine.removed(refined).count() == total
    assert refined.select("id").distinct().count() == total


def test_batch_and_stream_scores_agree(spark):
    log = q.score_events(spark, SF)
    assert scores.ema_score(log, width=10).select(F.round("score", 9)).subtract(
        scores.ema_score(log, width=100_000).select(F.round("score", 9))
    ).count() == 0


def test_language(spark):
    profiles = q.profiles(spark, SF)
    docs = read_table(spark, SF, "documents").select("doc_id", "text", "lang")
    judged = language.with_language(docs, profiles).where("length(text) > 200")
    wrong = judged.where("language != lang").count()
    assert wrong <= judged.count() * 0.02
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    blank = spark.createDataFrame([("",), (None,), ("12 34",)], "text string")
    assert [r.language for r in language.with_language(blank, profiles).collect()] == [None] * 3


def test_language_tables_of_any_size(spark):
    """A joined table scores as one in every task does, with rare trigrams and many languages."""
    draw = random.Random(2)
    rows = [(f"l{i:03d}", "".join(draw.choice("abcdefghijklmnop") for _ in range(60)) + chr(0x4E00 + i) * 3) for i in range(300)]
    counts = language.train_profiles(spark.createDataFrame(rows, "lang string, text string"))
    texts = [(i, text[20:]) for i, (_, text) in enumerate(rows)] + [(900, ""), (901, None), (902, "12"), (903, "\u4e07\u4e07\u4e07")]
    frame = spark.createDataFrame(texts, "id long, text string").selectExpr("*", "1 AS row", "2 AS code")
    local = language.with_language(frame, language.Profiles(counts)).collect()
    joined = language.with_language(frame, language.Profiles(counts, local_bytes=0)).collect()
    one, other = ({r.id: r for r in rows_} for rows_ in (local, joined))
    assert len(local) == len(joined) == len(texts) and set(local[0].asDict()) == set(joined[0].asDict())
    for id in one:
        assert one[id].language == other[id].language
        assert one[id].language_score == pytest.approx(other[id].language_score)
    assert all(one[i].language == f"l{i:03d}" for i in range(300))
    assert [one[i].language for i in (900, 901, 902, 903)] == [None, None, None, "l007"]
    with pytest.raises(ValueError):
        language.Profiles(counts.limit(0))


def test_chunk_stream_of_a_folder_of_files(spark, tmp_path, monkeypatch):
    """A table may be a folder, and a conversation in files of several batches is one row."""
    rows = [(c, t, f"{c}a\nb{t}" if (c + t) % 5 else None) for t in range(6) for c in range(8)]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, text string")
    for part in range(3):
        some = table.where(F.col("turn") % 3 == part).coalesce(1)
        some.write.mode("append").parquet(f"{tmp_path}/conversations.parquet")
    one_file = runner.file_stream
    monkeypatch.setattr(
        runner, "file_stream", lambda *args: one_file(*args, files_per_batch=1)
    )
    found = {tuple(r) for r in q.chunk_stream(spark, str(tmp_path)).collect()}
    whole = {(r.conv_id, 0, r.completion_md5) for r in q.chunk_reassembly(spark, str(tmp_path)).collect()}
    assert found == whole and len(found) == 8


def test_uids_that_share_a_call_keep_their_own_state(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "BUCKETS", 2)
    polls = q.observations(spark, SF).where("commit is not null")
    stream = in_files(spark, polls, str(tmp_path / "in"), "seen_block", 2)
    path = runner.run_available(commits.commit_stream(stream), str(tmp_path / "out"))
    found = spark.read.parquet(f"{path}/rows").where("kind = 'commit'")
    accepted = {(r.uid, r.commit, r.seen_block) for r in q.new_commits(spark, SF).collect()}
    assert accepted == {(r.uid, r.commit, r.block) for r in found.collect()}
