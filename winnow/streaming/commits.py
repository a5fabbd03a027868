"""Submissions as a stream: accepted commits, decays, smoothed scores, weights."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, GroupedData, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from winnow.functions.limits import BLOCK_SECONDS, DAY_BLOCKS, KEEP_SHARE, WEIGHT_EPOCH_BLOCKS
from winnow.operators import audit, scores
from winnow.operators.commits import late_commits
from winnow.operators.poller import START, Poll, replay
from winnow.session import materialize
from winnow.sources.files import report_scores

EVENT_SCHEMA = "uid bigint, kind string, commit string, block bigint, commit_block bigint, seq bigint"
LOG_SCHEMA = "uid bigint, seq bigint, block bigint, kind string, task_id bigint, score double, total double"
EPOCH_SCHEMA = "epoch bigint, uid bigint, score double"


CELLS = 1 << 18  # members times epochs that are worked on at once
NO_UID = -(1 << 63)  # of a member without one
BUCKETS = 1024  # uids share a call of a processor, not their state; fixed for a stream's life


def by_bucket(rows: DataFrame) -> GroupedData:
    """Rows grouped into the parts of all uids that a processor is called for at once."""
    return rows.withColumn("_bucket", F.pmod(F.xxhash64("uid"), F.lit(BUCKETS))).groupBy("_bucket")


class CommitProcessor(StatefulProcessor):
    """Per uid: the commit taken last, the block its timer runs from, the number of events.

    Polls of a batch are replayed in block order by the rule of `poller`; between batches only
    the state row is kept. A call takes a bucket of uids, and touches those with polls alone.
    """

    def __init__(self, max_age: int = DAY_BLOCKS):
        self.max_age = max_age

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getMapState("last", "uid bigint", "commit string, block bigint, seq bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows)).sort_values(["uid", "seen_block", "commit_block", "commit"])
        columns = (frame[c].tolist() for c in ("uid", "commit", "commit_block", "seen_block"))
        out = []
        for uid, own in groupby(zip(*columns, strict=True), itemgetter(0)):
            polls = [Poll(*poll) for _, *poll in own]
            commit, timer, seq = self.last.getValue((uid,)) or (*START, 0)
            for i, kind, (commit, timer) in replay(polls, (commit, timer), self.max_age):
                seq += 1
                out.append((uid, kind, commit, polls[i].seen_block, polls[i].commit_block, seq))
            self.last.updateValue((uid,), (commit, timer, seq))
        yield pd.DataFrame(out, columns=["uid", "kind", "commit", "block", "commit_block", "seq"])

    def close(self) -> None:
        pass


def commit_stream(observed: DataFrame, max_age: int = DAY_BLOCKS) -> DataFrame:
    """(uid, kind, commit, block, commit_block, seq) of accepted commits and decays, from polls.

    `block` is that of the poll, and `seq` counts the events of a uid. Polls without a uid, a
    commit or a block say nothing.
    """
    polls = observed.select("uid", "commit", "commit_block", "seen_block").dropna()
    return by_bucket(polls).transformWithStateInPandas(
        CommitProcessor(max_age), EVENT_SCHEMA, outputMode="append", timeMode="none"
    )


def recent_commits(observed: DataFrame, time: str = "ts", delay: str = "24 hours") -> DataFrame:
    """Commits young enough to be scored; the watermark bounds any state built on them."""
    return late_commits(observed.withWatermark(time, delay)).where("not late").drop("late")


def _batch_path(path: str, table: str, batch_id: int) -> str:
    return f"{path}/{table}/batch={batch_id}"


class ScoreProcessor(StatefulProcessor):
    """Per uid: the smoothed score, moved by scored commits and by decays in their one order."""

    def __init__(self, keep: float = KEEP_SHARE):
        self.keep = keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getMapState("total", "uid bigint", "score double")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        for uid, score in zip(initialState["uid"].tolist(), initialState["score"].tolist(), strict=True):
            self.total.updateValue((uid,), (score,))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(rows)).sort_values(["uid", "seq"])
        columns = (frame[c].tolist() for c in ("uid", "kind", "score"))
        totals = []
        for uid, own in groupby(zip(*columns, strict=True), itemgetter(0)):
            total = (self.total.getValue((uid,)) or (0.0,))[0]
            for _, kind, score in own:
                total = self.keep * total if kind == "decay" else self.keep * total + (1 - self.keep) * score
                totals.append(total)
            self.total.updateValue((uid,), (total,))
        frame["total"] = totals
        yield frame[[c.split()[0] for c in LOG_SCHEMA.split(", ")]]

    def close(self) -> None:
        pass


def scored_events(events: DataFrame, tasks: DataFrame, evaluations: DataFrame) -> DataFrame:
    """Events of `commit_stream` with the score of each accepted commit; decays have none.

    `tasks` (uid, task_id, request_block, gate) and `evaluations` (uid, commit, value, stderr)
    have one row a key. A commit without its task or evaluation is skipped, as if it had not been
    made: its uid's score stays.
    """
    known = events.join(tasks, "uid", "left").join(evaluations, ["uid", "commit"], "left")
    elapsed = (F.col("commit_block") - F.col("request_block")) * BLOCK_SECONDS
    score = audit.score_column(F.col("gate"), F.col("value"), F.col("stderr"), elapsed)
    complete = F.col("request_block").isNotNull() & F.col("value").isNotNull()
    is_commit = F.col("kind") == "commit"
    return known.where(~is_commit | complete).select(
        "uid", "seq", "block", "kind",
        F.when(is_commit, F.col("task_id")).alias("task_id"),
        F.when(is_commit, score).alias("score"),
    )


def score_stream(
    observed: DataFrame,
    tasks: DataFrame,
    evaluations: DataFrame,
    known: DataFrame | None = None,
    keep: float = KEEP_SHARE,
    max_age: int = DAY_BLOCKS,
) -> DataFrame:
    """The score loop: polls to accepted commits and decays, to scores, to smoothed scores.

    Rows are the score log: (uid, seq, block, kind, task_id, score, total), `total` after the
    event. A uid's score is state, and only the uids of a batch are touched. `known` (uid, score),
    as `latest_score` reads it from a log, is where a new loop takes up another's scores.
    """
    scored = scored_events(commit_stream(observed, max_age), tasks, evaluations)
    return by_bucket(scored).transformWithStateInPandas(
        ScoreProcessor(keep),
        LOG_SCHEMA,
        outputMode="append",
        timeMode="none",
        initialState=None if known is None else by_bucket(known.select("uid", "score")),
    )


def report_batches(path: str) -> Callable[[DataFrame, int], None]:
    """A batch step that writes the log and the reports of scored commits, each batch once."""

    def step(batch: DataFrame, batch_id: int) -> None:
        log = materialize(batch, "score-log")
        log.write.mode("overwrite").parquet(_batch_path(path, "totals", batch_id))
        report_scores(log.where("kind = 'commit'"), path, batch_id)

    return step


class MemberProcessor(StatefulProcessor):
    """Per bucket of members: the scores that hold, those of blocks to come, and the next epoch.

    A timer of event time closes an epoch once the watermark has passed it, whether a member
    has had an event or not, and gives the scores that hold there; 0 for one never scored.
    """

    def __init__(self, start: int, width: int = WEIGHT_EPOCH_BLOCKS):
        self.start, self.width = start, width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.epoch = handle.getValueState("epoch", "epoch bigint")
        self.held = handle.getListState("held", "uid bigint, score double")
        self.coming = handle.getListState("coming", "uid bigint, block bigint, seq bigint, total double")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.held.appendList([(uid, 0.0) for uid in initialState["uid"].tolist()])
        self.epoch.update((self.start,))
        self.handle.registerTimer(self.start * BLOCK_SECONDS * 1000)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if self.epoch.exists():  # other buckets have no members
            for frame in rows:
                frame = frame.dropna()  # ticks
                if len(frame):
                    columns = (frame[c].tolist() for c in ("uid", "block", "seq", "total"))
                    events = zip(*columns, strict=True)
                    self.coming.appendList([(u, int(b), int(s), float(t)) for u, b, s, t in events])
        yield pd.DataFrame([], columns=["epoch", "uid", "score"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        (epoch,) = self.epoch.get()
        closed = timerValues.getCurrentWatermarkInMs() // (BLOCK_SECONDS * 1000)
        epochs = np.arange(epoch, closed + 1, self.width)
        if not len(epochs):
            self.handle.registerTimer(int(epoch) * BLOCK_SECONDS * 1000)
            return
        held = np.array(list(self.held.get()), [("uid", "<i8"), ("score", "<f8")])
        uids, first = np.unique(held["uid"], return_index=True)
        score = held["score"][first]
        coming = sorted(self.coming.get()) if self.coming.exists() else []
        events = np.array(coming, [("uid", "<i8"), ("block", "<i8"), ("seq", "<i8"), ("total", "<f8")])
        member = np.minimum(np.searchsorted(uids, events["uid"]), len(uids) - 1)
        events, member = events[uids[member] == events["uid"]], member[uids[member] == events["uid"]]
        late = events["block"] > epochs[-1]
        rest, events, member = events[late].tolist(), events[~late], member[~late]
        at = np.searchsorted(epochs, events["block"])  # the first epoch that an event holds for
        last = np.ones(len(events), bool)  # of a member and epoch
        last[:-1] = (member[1:] != member[:-1]) | (at[1:] != at[:-1])
        member, at, total = member[last], at[last], events["total"][last]
        wide = max(1, CELLS // len(uids))
        for begin in range(0, len(epochs), wide):
            some = epochs[begin : begin + wide]
            here = (at >= begin) & (at < begin + wide)
            values = np.concatenate([score, total[here]])
            spot = np.zeros((len(uids), len(some)), np.int64)
            spot[:, 0] = np.arange(len(uids))
            spot[member[here], at[here] - begin] = np.arange(len(uids), len(values))
            # Values are in order of time for each member, after the one that held before.
            found = values[np.maximum.accumulate(spot, axis=1)]
            score = found[:, -1]
            yield pd.DataFrame(
                {"epoch": np.tile(some, len(uids)), "uid": np.repeat(uids, len(some)), "score": found.ravel()}
            )
        self.coming.put(rest) if rest else self.coming.clear()
        self.held.put(list(zip(uids.tolist(), score.tolist(), strict=True)))
        following = int(epochs[-1]) + self.width
        self.epoch.update((following,))
        self.handle.registerTimer(following * BLOCK_SECONDS * 1000)

    def close(self) -> None:
        pass


def member_epochs(
    log: DataFrame,
    members: DataFrame,
    start: int,
    ticks: DataFrame | None = None,
    delay: str = "20 minutes",
    width: int = WEIGHT_EPOCH_BLOCKS,
) -> DataFrame:
    """(epoch, uid, score) of every member at every block divisible by `width`, from `start` on.

    `log` (uid, block, seq, total) is the score log as it comes, at most `delay` late. All
    members are state from the beginning. An epoch closes for all of them in one batch, when the
    log or `ticks` (block), a clock that need not say anything about scores, has passed it.
    """
    if start % width:
        raise ValueError(f"the first epoch must be a multiple of {width}")
    rows = log.select("uid", "block", "seq", "total")
    if ticks is not None:
        nothing = F.lit(None)
        rows = rows.unionByName(
            ticks.select(
                F.lit(-1).cast("bigint").alias("uid"), "block",
                nothing.cast("bigint").alias("seq"), nothing.cast("double").alias("total"),
            )
        )
    timed = rows.withColumn("ts", block_time(F.col("block"))).withWatermark("ts", delay)
    uid = F.coalesce("uid", F.lit(NO_UID)).alias("uid")
    closed = by_bucket(timed.where("uid is not null")).transformWithStateInPandas(
        MemberProcessor(start, width),
        EPOCH_SCHEMA,
        outputMode="append",
        timeMode="eventTime",
        initialState=by_bucket(members.select(uid)),
    )
    return closed.withColumn("uid", F.when(F.col("uid") != NO_UID, F.col("uid")))


def weight_batches(path: str, min_allowed: int, limit: float) -> Callable[[DataFrame, int], None]:
    """A batch step: the weights of every epoch that the batch closes, each a whole vector."""

    def step(batch: DataFrame, batch_id: int) -> None:
        group = ["epoch"]
        vectors = materialize(batch.select("epoch", "uid", "score"), "vectors")
        size = vectors.count()
        weights = materialize(
            scores.l1_weights(vectors, group, size).drop("score"), "weights"
        )
        final = scores.process_weights(weights, min_allowed, limit, group, at_most=size)
        emitted = scores.emit_weights(materialize(final, "weights"), group, size)
        emitted.write.mode("overwrite").parquet(_batch_path(path, "weights", batch_id))

    return step


def block_time(block: Column) -> Column:
    """Start of a block as a timestamp."""
    return F.timestamp_seconds(block * 12)
