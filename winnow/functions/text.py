"""Column helpers for words, lines and tokens. All stay on the JVM side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

BLANKS = r"[ \t\n\r\f]+"
WORD = r"[\p{L}\p{N}]+"
TOKEN = r"[\p{L}\p{N}]+|[^ \t\n\r\f\p{L}\p{N}]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once per row and hand it to `body`.

    A plain column used inside a lambda may be inlined by the optimizer and then computed
    again for every array element; a lambda variable never is.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def computed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """`df` with a column that the optimizer computes once, and below which other filters go.

    Filters on a computed column are pushed below it as a copy of its expression, and later
    columns inline it; with rules this long the copies multiply. The output of a generator is
    neither copied nor inlined, and a filter on any other column still reaches the scan.
    """
    return df.select(
        *[F.col(f"`{c}`") for c in df.columns if c != name], F.explode(F.array(value)).alias(name)
    )


def raw_words(text: Column) -> Column:
    """Runs of non-blank characters."""
    return F.array_remove(F.split(text, BLANKS), "")


def folded_words(text: Column) -> Column:
    """Lower-case runs of letters and digits, used for shingles."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def tokens(text: Column) -> Column:
    """Words and single punctuation marks."""
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def count_tokens(text: Column) -> Column:
    return F.regexp_count(text, F.lit(TOKEN))


def filled_lines(text: Column) -> Column:
    """Lines with something in them."""
    return F.array_remove(F.transform(F.split(text, "\n"), lambda line: F.trim(line)), "")


def total_length(items: Column) -> Column:
    return F.aggregate(items, F.lit(0).cast("long"), lambda acc, item: acc + F.length(item))


def share(part: Column, whole: Column) -> Column:
    """part / whole, 0 where there is nothing to divide by."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double")).otherwise(F.lit(0.0))


def count_of(text: Column, needle: str) -> Column:
    """Non-overlapping occurrences of a literal."""
    gone = F.length(text) - F.length(F.replace(text, F.lit(needle), F.lit("")))
    return gone / F.lit(float(len(needle)))
