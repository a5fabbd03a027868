import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="session")
def docs(spark):
    """Few texts with every awkward case: nulls, blanks, copies, ties, a long one, more columns."""
    import random

    draw = random.Random(3)
    words = [f"w{draw.randrange(4000)}" for _ in range(30_000)]
    passage = " ".join(words[:60])
    base = " ".join(words[100:400])
    texts = [
        base,
        base,  # a copy
        base.replace(words[150], "edited", 1),
        passage + " one tail " + " ".join(words[500:600]),
        "head " + passage + "\n\nanother " + " ".join(words[600:700]),
        None,
        "",
        "   \n\t ",
        "word",
        "two words",
        "Ünïcödé 中文 👍🏽 text. " * 30,
        " ".join(words[700:]),  # long
        "aaaa " * 200,
        "ab" * 300,
        "It's 3 o'clock, they'll say <|endoftext|> and \x00 leave.",
    ]
    rows = [(i * 3, t, "en", "src", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[0], (None, base, "en", "src", 1), (None, None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    frame = spark.createDataFrame(rows, schema)
    return frame.selectExpr("*", "1 AS spans", "'x' AS kept", "2 AS slot", "3 AS _slice").repartition(4)


@pytest.fixture(scope="session")
def plain_rows(docs):
    return [(r.doc_id, r.text or "") for r in docs.collect()]


@pytest.fixture(scope="session")
def alike_words():
    """Pairs of words of two letters in Thue-Morse order, equal under any polynomial modulo 2**64."""
    pairs = []
    for size in (1024, 2048, 4096, 65536):
        one = "".join("ab"[i.bit_count() & 1] for i in range(size))
        pairs.append((one, one.translate({97: 98, 98: 97})))
    return pairs
