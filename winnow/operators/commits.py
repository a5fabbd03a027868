"""Submissions: keys, eligibility, new and stale commits."""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from winnow.functions.limits import DAY_BLOCKS, MIN_STAKE
from winnow.operators.poller import START, Poll, Stretch, applied, replay, summary
from winnow.operators.skew import lookup, ranked
from winnow.session import materialize

STRETCH_POLLS = 20_000  # polls of a submitter that one task replays


def commit_key(key: Column) -> Column:
    """struct(url, hash) of "url:hash"; NULL unless there is exactly one colon."""
    parts = F.split(key, ":")
    return F.when(
        F.size(parts) == 2,
        F.struct(F.get(parts, F.lit(0)).alias("url"), F.get(parts, F.lit(1)).alias("hash")),
    )


def pair_hash(first: Column, second: Column) -> Column:
    """Base64 of the SHA-256 of both strings, one after the other."""
    return F.base64(F.unhex(F.sha2(F.concat(first, second), 256)))


def eligible_submitters(
    commits: DataFrame, members: DataFrame, min_stake: float = MIN_STAKE, key: str = "uid"
) -> DataFrame:
    """Commits of registered members with enough stake; others are refused."""
    staked = members.where(F.col("stake") >= min_stake).select(key).distinct()
    return lookup(commits, staked, [key])


def late_commits(commits: DataFrame, max_age: int = DAY_BLOCKS) -> DataFrame:
    """Marks commits that are too old to be scored when they are seen."""
    return commits.withColumn("late", F.col("seen_block") - F.col("commit_block") >= max_age)


def replay_commits(
    observed: DataFrame, max_age: int = DAY_BLOCKS, width: int = STRETCH_POLLS
) -> DataFrame:
    """The observations that change a submitter's state, with `kind`: "commit" or "decay".

    The rule is that of `poller`, poll by poll in order of seen_block, commit_block and commit.
    A submitter's polls are cut into stretches of `width`; each stretch is summed up on its own,
    the summaries of a submitter, few rows each, are applied one after the other, and every
    stretch is replayed from the state before it. Polls without a uid, a commit or a block say nothing.
    """
    polls = observed.dropna(subset=["uid", "commit", "commit_block", "seen_block"])
    columns = [*observed.columns, "kind"]
    others = [c for c in observed.columns if c not in ("uid", "commit", "commit_block", "seen_block")]
    order = [F.col("seen_block"), F.col("commit_block"), F.col("commit"), *[F.col(c) for c in others]]
    placed = materialize(
        ranked(polls, ["uid"], order)
        .drop("_before")
        .withColumn("_stretch", F.floor((F.col("_rank") - 1) / width)),
        "polls",
    )
    long = placed.groupBy("uid").agg(F.max("_stretch").alias("_last")).where("_last > 0")
    states = _states_before(placed.join(long, "uid", "left_semi"), max_age)
    same = (placed["uid"] == states["_uid"]) & (placed["_stretch"] == states["_at"])
    known = placed.join(states, same, "left").drop("_uid", "_at")
    places = 1 + placed.count() // (4 * width)
    spread = known.withColumn("_place", F.pmod(F.xxhash64("uid", "_stretch"), F.lit(places)))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in ("uid", "_stretch", "_rank")]).combine_chunks()
        uids, stretches = table["uid"].to_pylist(), table["_stretch"].to_pylist()
        given = table.select(["commit", "commit_block", "seen_block"]).to_pylist()
        polls = [Poll(**p) for p in given]
        states = zip(table["_commit"].to_pylist(), table["_timer"].to_pylist(), strict=True)
        before = [START if timer is None else (commit, timer) for commit, timer in states]
        cut = [i for i in range(len(polls)) if not i or (uids[i], stretches[i]) != (uids[i - 1], stretches[i - 1])]
        found = []
        for first, past in zip(cut, [*cut[1:], len(polls)], strict=True):
            found += [(first + i, kind) for i, kind, _ in replay(polls[first:past], before[first], max_age)]
        events = table.take(pa.array([i for i, _ in found], pa.int64()))
        return events.append_column("kind", pa.array([k for _, k in found], pa.string())).select(columns)

    fields = [*observed.schema.fields, StructField("kind", StringType())]
    return spread.groupBy("_place").applyInArrow(run, StructType(fields))


def _polls(frame: pd.DataFrame) -> list[Poll]:
    columns = (frame[c].tolist() for c in ("commit", "commit_block", "seen_block"))
    return [Poll(c, int(b), int(s)) for c, b, s in zip(*columns, strict=True)]


def _states_before(placed: DataFrame, max_age: int) -> DataFrame:
    """(_uid, _at, _commit, _timer): the state before each stretch of submitters with several."""
    summed = (
        "_uid long, _at long, first string, early int, until array<long>, commits array<string>, "
        "timers array<long>, other_commit string, other_timer long, same_commit string, same_timer long"
    )
    names = [c.split()[0] for c in summed.split(", ")]

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        found = summary(_polls(frame.sort_values("_rank")), max_age)
        row = (
            frame["uid"].iloc[0], frame["_stretch"].iloc[0], found.first, found.early, found.until,
            [c for c, _ in found.after], [t for _, t in found.after],
            *(found.other or (None, None)), *(found.same or (None, None)),
        )
        return pd.DataFrame([row], columns=names)

    def fold(frame: pd.DataFrame) -> pd.DataFrame:
        now, out = START, []
        for row in frame.sort_values("_at").to_dict("records"):
            out.append((row["_uid"], row["_at"], *now))
            ends = [
                None if pd.isna(row[f"{c}_timer"]) else (row[f"{c}_commit"], int(row[f"{c}_timer"]))
                for c in ("other", "same")
            ]
            after = list(zip(row["commits"], map(int, row["timers"]), strict=True))
            until = [int(u) for u in row["until"]]
            now = applied(Stretch(row["first"], row["early"], until, after, *ends), now, max_age)
        return pd.DataFrame(out, columns=["_uid", "_at", "_commit", "_timer"])

    summaries = placed.groupBy("uid", "_stretch").applyInPandas(run, summed)
    states = summaries.groupBy("_uid").applyInPandas(fold, "_uid long, _at long, _commit string, _timer long")
    return materialize(states, "poll-states")


def new_commits(observed: DataFrame, max_age: int = DAY_BLOCKS) -> DataFrame:
    """Observations of a recent commit that differs from the one the poller took before."""
    return replay_commits(observed, max_age).where("kind = 'commit'").drop("kind")


def stale_decay(observed: DataFrame, max_age: int = DAY_BLOCKS) -> DataFrame:
    """(uid, block): the polls at which a commit has not changed for more than `max_age` blocks."""
    decays = replay_commits(observed, max_age).where("kind = 'decay'")
    return decays.select("uid", F.col("seen_block").alias("block"))
