"""Rule filters on document text.

Every rule set is an expression over the text of one row and never shuffles. A rule set yields
the name of the first rule that fails, or NULL for a document that passes. Only the n-gram
counts leave the JVM, as Arrow batches.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from winnow.functions.limits import (
    LINE_END_PUNCTUATION,
    C4Quality,
    FineWebQuality,
    GopherQuality,
    GopherRepetition,
)
from winnow.functions.ngrams import repeated_chars_column
from winnow.functions.text import (
    BLANKS,
    count_of,
    computed,
    filled_lines,
    let,
    raw_words,
    share,
    total_length,
)


def first_failure(rules: list[tuple[str, Column]]) -> Column:
    """CASE over (name, failed) pairs, evaluated in order and only as far as needed."""
    result = None
    for name, failed in rules:
        result = F.when(failed, name) if result is None else result.when(failed, name)
    return result.otherwise(F.lit(None).cast("string"))


def _verdict(df: DataFrame, reason: Column) -> DataFrame:
    return computed(df, "drop_reason", reason).withColumn("keep", F.col("drop_reason").isNull())


# --- repetition ------------------------------------------------------------


def _dup_count(items: Column) -> Column:
    return share(F.size(items) - F.size(F.array_distinct(items)), F.size(items))


def _dup_chars(items: Column, chars: Column) -> Column:
    return share(total_length(items) - total_length(F.array_distinct(items)), chars)


def repeated_word_chars(text: Column, limits: GopherRepetition) -> Column:
    """Characters in repeated n-grams, one number per size, then the characters of all words."""
    top, dup = sorted(limits.top_ngram), sorted(limits.dup_ngram)

    @F.arrow_udf("array<bigint>")
    def count(words: pa.Array) -> pa.Array:
        return repeated_chars_column(words, top, dup)

    return count(raw_words(text))


def repetition_reason(
    text: Column, repeated: Column, limits: GopherRepetition = GopherRepetition()
) -> Column:
    """`repeated` is the column made by `repeated_word_chars`."""
    body = F.regexp_replace(text, r"\A\n+|\n+\z", "")
    chars = F.length(text)

    def by_lines(lines: Column, paragraphs: Column) -> Column:
        return first_failure(
            [
                ("dup_paragraph", _dup_count(paragraphs) > limits.dup_paragraph),
                ("dup_paragraph_chars", _dup_chars(paragraphs, chars) > limits.dup_paragraph_chars),
                ("dup_line", _dup_count(lines) > limits.dup_line),
                ("dup_line_chars", _dup_chars(lines, chars) > limits.dup_line_chars),
            ]
        )

    top, dup = sorted(limits.top_ngram.items()), sorted(limits.dup_ngram.items())
    word_chars = F.get(repeated, F.lit(len(top) + len(dup)))
    rules = [
        (f"top_{n}_gram", share(F.get(repeated, F.lit(i)), chars) > limit)
        for i, (n, limit) in enumerate(top)
    ] + [
        (f"dup_{n}_gram", share(F.get(repeated, F.lit(len(top) + i)), word_chars) > limit)
        for i, (n, limit) in enumerate(dup)
    ]
    return F.coalesce(
        let(
            F.split(body, "\n+"),
            lambda lines: let(F.split(body, "\n{2,}"), lambda paras: by_lines(lines, paras)),
        ),
        first_failure(rules),
    )


def gopher_repetition(
    df: DataFrame, text: str = "text", limits: GopherRepetition = GopherRepetition()
) -> DataFrame:
    counted = computed(df, "_repeated", repeated_word_chars(F.col(text), limits))
    reason = repetition_reason(F.col(text), F.col("_repeated"), limits)
    return _verdict(counted, reason).drop("_repeated")


# --- quality ---------------------------------------------------------------


def quality_reason(text: Column, limits: GopherQuality = GopherQuality()) -> Column:
    def words_in(value: Column) -> Column:
        return F.size(raw_words(value))

    # Stripping everything but letters and blanks leaves exactly the words with a letter, so
    # counting needs no lambda per word.
    measures = F.struct(
        words_in(text).alias("words"),
        words_in(F.regexp_replace(text, r"[^\p{L} \t\n\r\f]+", "")).alias("alpha"),
        F.length(F.regexp_replace(text, BLANKS, "")).alias("letters"),
        F.size(
            F.array_intersect(
                F.split(F.lower(text), r"[^\p{L}]+"),
                F.array(*[F.lit(w) for w in limits.stop_words]),
            )
        ).alias("stops"),
        filled_lines(text).alias("lines"),
    )

    def rules(m: Column) -> Column:
        n, lines = m.getField("words"), m.getField("lines")
        mean_length = share(m.getField("letters"), n)
        bullets = F.filter(lines, lambda line: line.rlike(r"^[•‣*-]"))
        ellipses = F.filter(lines, lambda line: line.rlike(r"(\.\.\.|…)\z"))
        dots = count_of(text, "...") + count_of(text, "…")
        return first_failure(
            [
                ("too_few_words", n < limits.min_words),
                ("too_many_words", n > limits.max_words),
                ("short_words", mean_length < limits.min_mean_length),
                ("long_words", mean_length > limits.max_mean_length),
                ("hash_ratio", share(count_of(text, "#"), n) > limits.max_symbol_ratio),
                ("ellipsis_ratio", share(dots, n) > limits.max_symbol_ratio),
                ("bullet_lines", share(F.size(bullets), F.size(lines)) > limits.max_bullet_lines),
                (
                    "ellipsis_lines",
                    share(F.size(ellipses), F.size(lines)) > limits.max_ellipsis_lines,
                ),
                ("alpha_words", share(m.getField("alpha"), n) < limits.min_alpha_words),
                ("stop_words", m.getField("stops") < limits.min_stop_words),
            ]
        )

    return let(measures, rules)


def gopher_quality(
    df: DataFrame, text: str = "text", limits: GopherQuality = GopherQuality()
) -> DataFrame:
    return _verdict(df, quality_reason(F.col(text), limits))


# --- C4 --------------------------------------------------------------------


def c4_text(text: Column, limits: C4Quality = C4Quality()) -> Column:
    """The text without citation marks and without the lines the line rules drop."""
    lines = F.transform(
        F.split(F.regexp_replace(text, r"\[\d*\]|\[edit\]|\[citation needed\]", ""), "\n"),
        lambda line: F.trim(line),
    )
    enough_words = r"^[^ \t\r\f]+" + r"[ \t\r\f]+[^ \t\r\f]+" * (limits.min_line_words - 1)

    def keep(line: Column) -> Column:
        low = F.lower(line)
        bad = low.contains("javascript")
        for phrase in limits.policy_phrases:
            bad = bad | low.contains(phrase)
        long_word = line.rlike(r"[^ \t\r\f]{%d}" % (limits.max_word_length + 1))
        good = line.rlike(enough_words) & ~bad & ~long_word
        if limits.terminal_punctuation:
            good = good & F.right(line, F.lit(1)).isin(*LINE_END_PUNCTUATION)
        return good

    return F.array_join(F.filter(lines, keep), "\n")


def count_sentences(text: Column) -> Column:
    """Sentence ends inside the text plus lines that stop without one."""
    ends = F.regexp_count(text, F.lit(r"[.!?]+(?:[ \t\n\r\f]|\z)"))
    open_lines = F.filter(filled_lines(text), lambda line: ~line.rlike(r"[.!?]\z"))
    return ends + F.size(open_lines)


def c4_reason(text: Column, cleaned: Column, limits: C4Quality = C4Quality()) -> Column:
    return first_failure(
        [
            ("lorem_ipsum", F.lower(text).contains("lorem ipsum")),
            ("curly_bracket", text.contains("{")),
            ("too_few_sentences", count_sentences(cleaned) < limits.min_sentences),
        ]
    )


def c4_quality(df: DataFrame, text: str = "text", limits: C4Quality = C4Quality()) -> DataFrame:
    """Rewrites the text column, then judges the documents."""
    marked = computed(df, "_cleaned", c4_text(F.col(text), limits))
    judged = _verdict(marked, c4_reason(F.col(text), F.col("_cleaned"), limits))
    return judged.withColumn(text, F.col("_cleaned")).drop("_cleaned")


# --- FineWeb ---------------------------------------------------------------


def fineweb_reason(text: Column, limits: FineWebQuality = FineWebQuality()) -> Column:
    newlines = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    chars = F.length(text) - newlines

    def rules(lines: Column) -> Column:
        n = F.size(lines)
        ended = F.filter(lines, lambda ln: F.right(ln, F.lit(1)).isin(*LINE_END_PUNCTUATION))
        short = F.filter(lines, lambda ln: F.length(ln) < limits.short_line_chars)
        return first_failure(
            [
                ("empty", n == 0),
                ("line_punctuation", share(F.size(ended), n) <= limits.min_line_punctuation),
                ("short_lines", share(F.size(short), n) >= limits.max_short_lines),
                ("dup_line_chars", _dup_chars(lines, chars) >= limits.max_dup_line_chars),
                (
                    "list_like",
                    share(newlines, F.size(raw_words(text))) > limits.max_newline_ratio,
                ),
            ]
        )

    return let(filled_lines(text), rules)


def fineweb_quality(
    df: DataFrame, text: str = "text", limits: FineWebQuality = FineWebQuality()
) -> DataFrame:
    return _verdict(df, fineweb_reason(F.col(text), limits))
