import pytest
from pyspark.sql import functions as F

from winnow.operators import extract, pii, quality, url

PROSE = (
    "The weather in the northern hills changed quickly that autumn and nobody had planned to "
    "stay. A group of walkers left the village with two maps and a lamp. They hoped to be back "
    "before dark! Would they have enough water with them? The old guide said nothing of that, "
    "but he packed bread, cheese and apples for everyone in the party. Later they thanked him."
)


def reasons(spark, rule, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    return [r.drop_reason for r in rule(df).orderBy("id").collect()]


def test_gopher_quality(spark):
    bullets = "\n".join("- " + line for line in PROSE.split(". "))
    dots = "\n".join(line + "..." for line in PROSE.replace("?", "").split(" and "))
    texts = {
        PROSE: None,
        "too short to keep": "too_few_words",
        "a b " * 40 + "the be": "short_words",
        "incomprehensibilities " * 60: "long_words",
        "# " * 10 + PROSE: "hash_ratio",
        "..." * 9 + PROSE: "ellipsis_ratio",
        bullets: "bullet_lines",
        dots + " word" * 60: "ellipsis_lines",
        " ".join(["12345"] * 30) + " " + PROSE: "alpha_words",
        " ".join(["zebra quagga"] * 40): "stop_words",
    }
    assert reasons(spark, quality.gopher_quality, list(texts)) == list(texts.values())


def brute_repetition(text, n):
    """Characters in words covered by an n-gram that occurred before, over all characters."""
    words = text.split()
    seen, covered = set(), set()
    for i in range(len(words) - n + 1):
        gram = tuple(words[i : i + n])
        if gram in seen:
            covered.update(range(i, i + n))
        seen.add(gram)
    return sum(len(words[i]) for i in covered), sum(map(len, words))


def test_repeated_word_chars(spark):
    import random

    rng = random.Random(5)
    texts = ["", "one", "a b a b a b a b a b a b", None]
    texts += [" ".join(rng.choice("ab cde fg".split()) for _ in range(40)) for _ in range(20)]
    texts += [" ".join(rng.choices(PROSE.split(), k=300)) + " " + PROSE + " " + PROSE]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    limits = quality.GopherRepetition()
    counted = df.withColumn("r", quality.repeated_word_chars(F.col("text"), limits))
    for row in counted.collect():
        if row.text is None:
            assert row.r is None
            continue
        for k, n in enumerate(sorted(limits.dup_ngram)):
            assert (row.r[3 + k], row.r[-1]) == brute_repetition(row.text, n)
        words = row.text.split()
        for k, n in enumerate((2, 3, 4)):
            grams = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
            best = max(((grams.count(g), len(g)) for g in set(grams)), default=(0, 0))
            assert row.r[k] == best[0] * best[1]


def test_gopher_repetition(spark):
    line = "A line that comes back in the text again and again without change."
    texts = [PROSE, "\n".join([line] * 5), "\n\n".join([line, line, PROSE]), "go on " * 60]
    assert reasons(spark, quality.gopher_repetition, texts) == [
        None, "dup_line", "dup_paragraph", "top_2_gram",
    ]


def test_c4_quality(spark):
    text = "\n".join(
        [
            "First line of the text. It has words.", "Please enable JavaScript to go on.",
            "two words", "Read our cookie policy before you go.", "x" * 1001 + " is too long.",
            "Second line [12] of the text. Good. More. End.",
        ]
    )
    df = spark.createDataFrame(
        [(0, text), (1, "Lorem ipsum dolor sit."), (2, "if (x) { y }"), (3, "One line only.")],
        "id int, text string",
    )
    rows = quality.c4_quality(df).orderBy("id").collect()
    assert rows[0].text == (
        "First line of the text. It has words.\nSecond line  of the text. Good. More. End."
    )
    assert [r.drop_reason for r in rows] == [
        None, "lorem_ipsum", "curly_bracket", "too_few_sentences",
    ]


def test_fineweb_quality(spark):
    long_line = "This line is certainly longer than thirty characters"
    texts = [
        PROSE, "", "\n".join([long_line] + [long_line + str(i) for i in range(9)]),
        "\n".join(["Short one."] + [f"Number {i}." for i in range(9)]),
        "\n".join([long_line + "."] * 3), "\n".join(f"{c * 15} {c * 15}." for c in "abcdef"),
    ]
    assert reasons(spark, quality.fineweb_quality, texts) == [
        None, "empty", "line_punctuation", "short_lines", "dup_line_chars", "list_like",
    ]


@pytest.mark.parametrize("as_table", [False, True])
def test_url_filter(spark, as_table):
    rows = [
        ("http://www.Bad.example.com/x", "domain"), ("https://bad.example.com:80/", "domain"),
        ("http://notbad.example.com/", None), ("http://ok.org/win-casino.html", "word"),
        ("http://ok.org/casinos", None), ("::bad", None), (None, None),
    ]
    df = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows)], "id int, url string")
    domains = ["bad.example.com", "unused.net"]
    if as_table:
        domains = spark.createDataFrame([(d,) for d in domains], "domain string")
    judged = url.url_filter(df, domains, ["casino"]).orderBy("id").collect()
    assert [r.drop_reason for r in judged] == [reason for _, reason in rows]


def test_url_filter_without_broadcast(spark, small_hot):
    urls = ["http://hot.bad.com/1"] * 20 + ["http://a.bad.com"] + ["http://fine.org"] * 9
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    domains = spark.createDataFrame([("bad.com",)], "domain string")
    judged = url.url_filter(df, domains).groupBy("drop_reason").count().collect()
    assert {r.drop_reason: r["count"] for r in judged} == {"domain": 21, None: 9}


def test_extract_main_text(spark):
    page = (
        "<html><head><title>No title please, thank you all</title></head><body>"
        "<nav>Navigation links that are long enough to be kept</nav><script>var a='</p>';</script>"
        "<article><h1>A heading long enough to be kept</h1><p>First &amp; best <b>paragraph of the "
        "page.<p>Second paragraph &#233;crit with &quot;quotes&quot; in it.<p>short<p>"
        "<a href='x'>A long list of links that is nothing but links</a></article>"
        "<footer>Footer text that is long enough to be kept</footer><!-- a comment"
    )
    df = spark.createDataFrame([(page,), ("",), (None,)], "html string")
    texts = [r.text for r in extract.extract_main_text(df).collect()]
    assert texts[0] == (
        "A heading long enough to be kept\nFirst & best paragraph of the page.\n"
        'Second paragraph écrit with "quotes" in it.'
    )
    assert texts[1:] == ["", None]


def test_pii_mask(spark):
    text = (
        "mail jane.doe+x@mail.example.co.uk now, 8.8.8.8 and 233.233.171.252, not 10.0.0.1 "
        "192.168.1.1 127.0.0.1 172.20.1.1 or 300.1.1.1, v1.2.3"
    )
    df = spark.createDataFrame([(text,)], "text string")
    assert pii.pii_mask(df).first().text == (
        "mail email@example.com now, 22.214.171.124 and 22.214.171.124, not 10.0.0.1 "
        "192.168.1.1 127.0.0.1 172.20.1.1 or 300.1.1.1, v1.2.3"
    )
