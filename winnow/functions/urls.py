"""URL parts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from winnow.functions.text import let


def host(url: Column) -> Column:
    """Lower-case host; NULL where the URL has none."""
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def host_suffixes(name: Column) -> Column:
    """a.b.c -> [a.b.c, b.c, c]."""
    return let(
        F.split(name, r"\."),
        lambda parts: F.transform(
            F.sequence(F.lit(1), F.size(parts)),
            lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."),
        ),
    )
