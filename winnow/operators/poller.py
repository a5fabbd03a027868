"""What a poller makes of a submitter's commits, poll by poll, and over whole stretches of polls.

The state is the commit taken last and the block its timer runs from. A poll that shows a recent
commit other than that one accepts it; the timer starts at the commit's own block. Otherwise, once
the timer is older than a day of blocks, the poll is a decay: its commit is taken and the timer
starts at the poll.

Over a stretch of polls the state is a finite-state function. What happens first depends on the
state before in two ways only: whether its commit is the first recent one of the stretch, and after
which poll its timer is too old. From that first event on, nothing before matters. So a stretch is
summed up by what it leads to from each first event, in few pieces, and summaries are applied one
after the other: a submitter's polls are as many tasks as they need.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

START = (None, 0)  # before any poll


class Poll(NamedTuple):
    commit: str
    commit_block: int
    seen_block: int


def replay(polls: list[Poll], state: tuple, max_age: int) -> Iterator[tuple[int, str, tuple]]:
    """(index, kind, state after it) of every event, from a state."""
    commit, timer = state
    for i, poll in enumerate(polls):
        if poll.seen_block - poll.commit_block < max_age and poll.commit != commit:
            commit, timer = poll.commit, poll.commit_block
            yield i, "commit", (commit, timer)
        elif poll.seen_block - timer > max_age:
            commit, timer = poll.commit, poll.seen_block
            yield i, "decay", (commit, timer)


class Stretch(NamedTuple):
    """Where a stretch of polls leads to.

    `until` has, for pieces of polls that come before an accepted commit, the last block of the
    piece; a decay in the piece leads to the state in `after`. The first `early` pieces lie before
    the first recent poll. `other` is where accepting that poll leads to, `same` where the next
    different commit does; None if there is no such poll.
    """

    first: str | None
    early: int
    until: list[int]
    after: list[tuple]
    other: tuple | None
    same: tuple | None


def summary(polls: list[Poll], max_age: int) -> Stretch:
    """The function of a stretch; polls in order of their blocks."""
    n = len(polls)
    seen = [p.seen_block for p in polls]
    recent = [p.seen_block - p.commit_block < max_age for p in polls]
    following, different = n, [n] * (n + 1)
    exits: list[tuple[tuple, tuple]] = [(START, START)] * n
    for i in range(n - 1, -1, -1):
        poll = polls[i]
        accepts = following
        if following < n and polls[following].commit == poll.commit:
            accepts = different[following]

        def leads(timer: int, i=i, accepts=accepts, commit=poll.commit) -> tuple:
            decays = bisect_right(seen, timer + max_age, i + 1)
            if accepts <= decays and accepts < n:
                return exits[accepts][0]
            return exits[decays][1] if decays < n else (commit, timer)

        exits[i] = leads(poll.commit_block), leads(poll.seen_block)
        different[i] = accepts
        if recent[i]:
            following = i
    one = following
    two = different[one] if one < n else n
    until, after, early = [], [], 0
    for i in range(min(two, n)):
        if i and i != one and exits[i][1] == after[-1]:
            until[-1] = seen[i]
        else:
            until.append(seen[i])
            after.append(exits[i][1])
        if i < one:
            early = len(until)
    return Stretch(
        polls[one].commit if one < n else None,
        early,
        until,
        after,
        exits[one][0] if one < n else None,
        exits[two][0] if two < n else None,
    )


def applied(stretch: Stretch, state: tuple, max_age: int) -> tuple:
    """The state after a stretch."""
    commit, timer = state
    same = stretch.first is not None and commit == stretch.first
    pieces = len(stretch.until) if same or stretch.first is None else stretch.early
    at = bisect_right(stretch.until, timer + max_age, 0, pieces)
    if at < pieces:
        return stretch.after[at]
    return (stretch.same if same else stretch.other) or state
