"""Language identification with character trigram profiles.

A text's score for a language is that of naive Bayes over all trigrams that any language was trained
with: the sum of ln((c + 1) / (t + k)) over the text's known trigrams, c being the trigram's count in
the language, t the language's trigrams and k the number of different ones. Only trigrams that a
language has need a row: the others add ln(1) less the same denominator. The table is thus sparse,
with every trigram and any number of languages.

Where the table is small in bytes, as counted before, every task has it and texts are scored where
they are. Otherwise the texts' trigram counts meet the table in a join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from winnow.functions.text import computed
from winnow.functions.trigrams import text_chunks, trigram_codes
from winnow.session import materialize, small_batches

MIN_SCORE = 0.65
ENTRY_BYTES = 20  # of a trigram of a language: a code, a number, a logarithm
LOCAL_BYTES = 64 << 20  # of the largest table that is sent to every task
BLOCK_BITS = 8  # 256 neighbouring texts meet the table together
TRAIN_CHARS = 1 << 20  # counted together: more repeat each other, fewer take less memory


def letters_only(text: Column) -> Column:
    """Lower-case letters, anything else folded to single blanks."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}]+", " ")


def _count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts per language and trigram within each batch, to shrink the shuffle."""
    for batch in batches:
        langs = batch.column(0).to_pylist()
        row = 0
        for texts in text_chunks(batch.column(1), TRAIN_CHARS):
            names = np.array([str(x) for x in langs[row : row + len(texts)]], dtype=object)
            row += len(texts)
            codes, owner = trigram_codes(texts)
            known, number = np.unique(names, return_inverse=True)
            for k, name in enumerate(known):
                found, counts = np.unique(codes[number[owner] == k], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(found), pa.string()), pa.array(found), pa.array(counts)],
                    ["lang", "code", "n"],
                )


def train_profiles(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, code, n): how often each language has each trigram; written."""
    small_batches(df.sparkSession)
    counts = (
        df.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
        .select(F.col(lang).alias("lang"), letters_only(F.col(text)).alias("text"))
        .mapInArrow(_count_trigrams, "lang string, code bigint, n bigint")
        .groupBy("lang", "code")
        .agg(F.sum("n").alias("n"))
    )
    return materialize(counts, "trigrams")


class Profiles:
    """What `train_profiles` found, in every task if it is small, else as a table to join with."""

    def __init__(self, counts: DataFrame, local_bytes: int = LOCAL_BYTES):
        """`counts` (lang, code, n) is written."""
        self.counts = counts
        found = counts.groupBy("lang").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("rows"))
        found = materialize(found, "languages")
        rows = found.agg(F.sum("rows")).first()[0]
        if not rows:
            raise ValueError("there is no text to train languages on")
        known = counts.select("code").distinct().count()
        self.languages = found.select("lang", F.ln(F.col("total") + known).alias("rest"))
        self.shared = None
        if rows * ENTRY_BYTES <= local_bytes:
            self.shared = self._local()

    def _local(self):
        """The table as arrays, broadcast: its size has been checked."""
        names = self.languages.orderBy("lang").toArrow()
        table = self.counts.toArrow()
        order = np.argsort(table["code"].to_numpy(), kind="stable")
        codes = table["code"].to_numpy()[order]
        number = {name: i for i, name in enumerate(names["lang"].to_pylist())}
        languages = np.array([number[name] for name in table["lang"].to_pylist()], np.int32)[order]
        logs = np.log(table["n"].to_numpy()[order] + 1.0)
        known, first = np.unique(codes, return_index=True)
        arrays = (list(number), names["rest"].to_numpy(), known, np.append(first, len(codes)), languages, logs)
        return self.counts.sparkSession.sparkContext.broadcast(arrays)

    def column(self, text: Column) -> Column:
        """struct(language, score) where the table is in every task; NULL, 0 for no known trigram."""
        shared = self.shared

        @F.arrow_udf("language string, score double")
        def guess(texts: pa.Array) -> pa.Array:
            names, rest, known, first, numbers, logs = shared.value
            names = np.array(names, dtype=object)
            languages, scores = [], []
            for run in text_chunks(texts):
                odds, hits = posterior(run, rest, known, first, numbers, logs)
                best = odds.argmax(axis=1)
                found = hits > 0
                languages += np.where(found, names[best], None).tolist()
                scores += np.where(found, odds[np.arange(len(run)), best], 0.0).tolist()
            return pa.StructArray.from_arrays(
                [pa.array(languages, pa.string()), pa.array(scores, pa.float64())],
                ["language", "score"],
            )

        return guess(letters_only(text))

    def joined(self, df: DataFrame, text: str) -> DataFrame:
        """`df` with struct `_guess` from a join of its trigrams with the table.

        The trigrams of `2 ** BLOCK_BITS` neighbouring texts meet the table together, each once however many of
        the texts have it, and a block is scored with the part of the table that it asks for. Hence a
        trigram has no more rows than there are blocks, also one that all texts have.
        """
        numbered = df.withColumn("_row", F.monotonically_increasing_id())
        rows = materialize(numbered, "language-rows")
        texts = rows.select(
            F.shiftright("_row", BLOCK_BITS).alias("block"), F.col("_row").alias("row"),
            letters_only(F.col(text)).alias("text"),
        )
        codes = texts.select("block", "text").mapInArrow(_block_trigrams, "block bigint, code bigint").distinct()
        found = self.languages.orderBy("lang").toArrow()
        names, rest = found["lang"].to_pylist(), found["rest"].to_numpy()
        spark = df.sparkSession
        number = spark.createDataFrame(list(enumerate(names)), "number int, lang string")
        own = F.struct("number", F.ln(F.col("n") + 1.0).alias("log"))
        table = self.counts.join(F.broadcast(number), "lang").groupBy("code").agg(F.collect_list(own).alias("own"))
        table = table.select("code", F.col("own.number").alias("numbers"), F.col("own.log").alias("logs"))
        asked = codes.join(table, "code").select(F.col("block").alias("_block"), "code", "numbers", "logs")

        def guess(texts: pa.Table, entries: pa.Table) -> pa.Table:
            entries = entries.sort_by("code")
            known = entries["code"].to_numpy()
            sizes = np.diff(np.concatenate([[0], *_ends(entries["logs"])]))
            first = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
            numbers = np.concatenate([np.zeros(0, np.int32), *(c.flatten().to_numpy() for c in entries["numbers"].chunks)])
            logs = np.concatenate([np.zeros(0), *(c.flatten().to_numpy() for c in entries["logs"].chunks)])
            languages, scores = [], []
            for run in text_chunks(texts["text"]):  # a few texts at once
                if not len(known):
                    languages += [None] * len(run)
                    scores += [0.0] * len(run)
                    continue
                odds, hits = posterior(run, rest, known, first, numbers, logs)
                best = odds.argmax(axis=1)
                languages += [names[k] if h else None for k, h in zip(best.tolist(), hits.tolist(), strict=True)]
                scores += np.where(hits > 0, odds[np.arange(len(run)), best], 0.0).tolist()
            columns = [texts["row"], pa.array(languages, pa.string()), pa.array(scores, pa.float64())]
            return pa.table(columns, ["_at", "language", "score"])

        guessed = texts.groupBy("block").cogroup(asked.groupBy("_block")).applyInArrow(
            guess, "_at bigint, language string, score double"
        )
        guessed = guessed.select("_at", F.struct("language", "score").alias("_guess"))
        return rows.join(guessed, F.col("_row") == F.col("_at"), "left").drop("_row", "_at")


def _ends(lists: pa.ChunkedArray) -> list[np.ndarray]:
    """The places in all values at which the lists of each chunk end."""
    ends, at = [], 0
    for chunk in lists.chunks:
        ends.append(np.cumsum(chunk.value_lengths().to_numpy()) + at)
        at += len(chunk.flatten())
    return ends


def posterior(
    texts: list[str], rest: np.ndarray, known: np.ndarray, first: np.ndarray, languages: np.ndarray, logs: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(probability per text and language, number of known trigrams per text)."""
    codes, owner = trigram_codes(texts)
    at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
    there = known[at] == codes
    at, owner = at[there], owner[there]
    hits = np.bincount(owner, minlength=len(texts))
    sizes = first[at + 1] - first[at]
    entry = np.repeat(first[at] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
    spot = np.repeat(owner, sizes) * len(rest) + languages[entry]
    sums = np.bincount(spot, weights=logs[entry], minlength=len(texts) * len(rest))
    sums = sums.reshape(len(texts), -1) - hits[:, None] * rest
    odds = np.exp(sums - sums.max(axis=1, keepdims=True))
    return odds / odds.sum(axis=1, keepdims=True), hits


def _block_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different trigrams of each block within a chunk."""
    for batch in batches:
        blocks, at = batch.column(0).to_numpy(), 0
        for texts in text_chunks(batch.column(1)):
            codes, owner = trigram_codes(texts)
            block = blocks[at + owner]
            at += len(texts)
            for known in np.unique(block):
                found = np.unique(codes[block == known])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(found), known)), pa.array(found)], ["block", "code"]
                )


def with_language(df: DataFrame, profiles: Profiles, text: str = "text") -> DataFrame:
    small_batches(df.sparkSession)
    if profiles.shared is None:
        guessed = profiles.joined(df, text)
    else:
        guessed = computed(df, "_guess", profiles.column(F.col(text)))
    return (
        guessed.withColumn("language", F.col("_guess.language"))
        .withColumn("language_score", F.col("_guess.score"))
        .drop("_guess")
    )


def language_reason(target: str = "en", min_score: float = MIN_SCORE) -> Column:
    return (
        F.when(~F.col("language").eqNullSafe(target), "language")
        .when(F.col("language_score") < min_score, "language_score")
    )


def language_filter(
    df: DataFrame,
    profiles: Profiles,
    target: str = "en",
    min_score: float = MIN_SCORE,
    text: str = "text",
) -> DataFrame:
    judged = with_language(df, profiles, text).withColumn(
        "drop_reason", language_reason(target, min_score)
    )
    return judged.withColumn("keep", F.col("drop_reason").isNull())
