"""Python's share of a task does not grow with the rows that it gets."""

import tracemalloc

import numpy as np
import pyarrow as pa

from winnow.functions.ngrams import repeated_chars_column
from winnow.functions.trigrams import text_chunks, trigram_codes
from winnow.operators import language
from winnow.operators.language import posterior

WORDS = "the quick brown fox jumps over a lazy dog while nobody looks at it from above".split()


def peak_mb(run):
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_guessing_languages():
    texts = pa.array([" ".join(np.random.default_rng(i).permutation(WORDS)) for i in range(40_000)])
    known = np.unique(trigram_codes(texts[:100].to_pylist())[0])
    every, four = np.arange(len(known) + 1) * 4, np.tile(np.arange(4, dtype=np.int32), len(known))

    def run():
        for chunk in text_chunks(texts):
            posterior(chunk, np.ones(4), known, every, four, np.ones(len(four)))

    assert peak_mb(run) < 150


def test_repeated_ngrams():
    words = pa.array([WORDS * 4] * 10_000)
    assert peak_mb(lambda: repeated_chars_column(words, [2, 3], [5, 6])) < 50


def test_a_block_of_texts_asks_once_for_a_trigram():
    rows = pa.RecordBatch.from_pydict({"block": [7] * 256 + [8], "text": ["the same text"] * 257})
    asked = pa.Table.from_batches(language._block_trigrams([rows]))
    assert asked.num_rows == 2 * len(asked.group_by("code").aggregate([]))


def test_joined_guesses_of_texts_without_trigrams(spark):
    counts = language.train_profiles(spark.createDataFrame([("abcd", "x"), ("bcde", "y")], "text string, lang string"))
    table = language.Profiles(counts, local_bytes=0)
    rows = [(0, "abc"), (1, None), (2, ""), (3, "zzz"), (4, "cde"), (5, "bcd")]
    found = language.with_language(spark.createDataFrame(rows, "id int, text string"), table).orderBy("id").collect()
    assert [r.language for r in found] == ["x", None, None, None, "y", "x"]
    assert [round(r.language_score, 4) for r in found] == [0.6667, 0.0, 0.0, 0.0, 0.6667, 0.5]
