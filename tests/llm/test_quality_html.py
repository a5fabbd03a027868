import html
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from winnow.llm import html_crf, quality


def texts(draw, good):
    words = [f"{draw.choice('abcdefgh')}{draw.choice('aeiou')}{draw.choice('lmnrst')}{draw.randrange(9)}" for _ in range(300)]
    n = draw.randint(20, 120)
    if good:
        return ". ".join(" ".join(draw.choices(words, k=8)) for _ in range(n // 8 + 1)) + "."
    return draw.choice([" ".join(["spam"] * n), " | ".join(draw.choices(words, k=n)), "!!! ".join(draw.choices(words, k=n)).upper()])


def test_held_out_accuracy(spark):
    draw = random.Random(1)
    rows = [(i, draw.random() < 0.8) for i in range(600)]
    docs = spark.createDataFrame([(i, texts(draw, g)) for i, g in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(g)) for i, g in rows if i % 3], "doc_id long, label int")
    scores = {r.doc_id: r.score for r in quality.classify(docs, labels).collect()}
    assert all(0 <= s <= 1 for s in scores.values())
    unseen = [(scores[i] >= 0.5) == g for i, g in rows if i % 3 == 0]
    assert np.mean(unseen) > 0.97


def test_awkward_rows(spark, docs):
    labels = docs.where("doc_id is not null").select("doc_id", (F.col("doc_id") % 2).alias("label"))
    found = quality.classify(docs, labels).collect()
    assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found)
    one_class = quality.classify(docs, labels.withColumn("label", F.lit(1))).collect()
    assert all(r.score > 0.5 for r in one_class)
    none = quality.classify(docs, labels.withColumn("label", F.lit(None).cast("int"))).collect()
    assert {r.score for r in none} == {1.0}
    assert quality.classify(docs.limit(0), labels).count() == 0


def test_monotone():
    good, total = np.array([1.0, 0, 3, 1, 4]), np.array([2.0, 1, 3, 2, 4])
    found = quality.monotone(good, total)
    assert np.allclose(found, [1 / 3, 1 / 3, 0.8, 0.8, 1.0])


def test_statistics_do_not_depend_on_neighbours():
    sums = quality.Sums()
    group = [b"", b"one two two\nthree", b"  ", "é|é".encode(), b"A!" * 400]
    alone = np.concatenate([quality.statistics([t], sums) for t in group])
    assert np.allclose(quality.statistics(group, sums), alone)


# --- pages -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def field():
    draw = random.Random(2)
    return html_crf.fit([(html_crf.features(b), y) for b, y in html_crf.made_pages([texts(draw, True) for _ in range(40)], 400)])


SENTENCE = "A sentence of the article with several words, and another one follows it here."


@pytest.mark.parametrize("frame", [
    "<article>{}</article>", '<div class="post-content">{}</div>', "<main>{}</main>",
])
def test_parts_of_a_page(field, frame):
    body = f"<h1>A title of some words</h1><p>{SENTENCE}</p><p>{SENTENCE} &amp; more&hellip;</p>"
    page = (
        "<html><head><title>t</title><style>p{}</style></head><body><script>var t='</p>';</script>"
        '<nav><ul><li><a href="/a">Home</a><li><a href="/b">News</a></ul></nav>'
        '<div class="cookie-notice">We use cookies. <button>OK</button></div>'
        + frame.format(body)
        + '<aside class="sidebar"><p>Other stories</p></aside><form><label>Name</label><input></form>'
        f'<section class="comments"><div class="comment"><p>{SENTENCE}</p></div></section>'
        "<footer>&copy; site</footer></body></html>"
    )
    wanted = f"A title of some words\n{SENTENCE}\n{SENTENCE} & more…"
    assert html_crf.main_text(page, field) == wanted


def test_blocks():
    found = [(b.tag, b.text) for b in html_crf.blocks(
        "<p>one <b>two<br>three<p>a < b &lt;c&gt; &#x1F600;&amp;amp;<!-- <p>no --><div a='>'>x\n\t y</div>"
        "<textarea><p>no</p></textarea><li>k<li>l</ul>tail<a href=\"q>w\">link"
    )]
    assert found == [("p", "one two three"), ("p", "a < b <c> 😀&amp;"), ("div", "x y"), ("li", "k"),
                     ("li", "l tail link")] or found[:4] == [
        ("p", "one two three"), ("p", "a < b <c> 😀&amp;"), ("div", "x y"), ("li", "k")]


@pytest.mark.parametrize("page", [
    "", "<", "<p", "<!--", "<script>" + "x" * 50, "<a href='" * 3000, "<" * 20_000, "<div>" * 20_000,
    '="' * 20_000 + "<p a=\"" * 2000, "&#xD800;&#99999999;&bogus;",
])
def test_broken_pages_end(page):
    html_crf.blocks(page)


@pytest.mark.parametrize("part", [
    '<svg class="i" viewBox="0 0 1 1"/>', "<svg><path d='M0'/>", "<svg><svg><text>no</text></svg><text>no</text></svg>",
    "<svg><title>no</title><foreignObject><p>no</p></foreignObject><text>no</text></svg>", "<SVG><g><style/></g></SVG>",
    "<template><p>no</p><template><p>no</p></template><p>no</p></template>", "<template>", "<noscript>",
    "<noscript><p>no</p></noscript>", "<!-- <svg> --><script>'<template>'</script>", "<svg><path></g><svg></svg>",
])
@pytest.mark.parametrize("frame", ["<body>{}<article><p>{}</p></article>", "<body><article>{}<p>{}</p></article>"])
def test_pictures_and_templates_take_only_themselves(part, frame):
    page = frame.format(part, SENTENCE) + f"<p>{SENTENCE}</p><svg><path/></svg><p>end</p>"
    assert [b.text for b in html_crf.blocks(page)] == [SENTENCE, SENTENCE, "end"]


@pytest.mark.parametrize("part", ["<svg>", "<svg><foreignObject>", "<template>", "<noscript>", "<svg><foreignObject><div>"])
def test_many_open_parts_end(part):
    html_crf.blocks(part * 20_000 + "</svg></foreignObject></template>")


def test_viterbi_is_the_best_sequence(field):
    draw = np.random.default_rng(1)
    rows = [[int(x) for x in draw.integers(1 << html_crf.BITS, size=4)] for _ in range(9)]
    own = html_crf.Field()
    own.weights = draw.normal(size=1 << html_crf.BITS)
    own.turns = draw.normal(size=(2, 2))
    scores = own.emissions(rows)

    def total(labels):
        return sum(s for s, y in zip(scores, labels, strict=True) if y) + sum(own.turns[a, b] for a, b in zip(labels, labels[1:], strict=False))

    every = [[n >> i & 1 for i in range(9)] for n in range(512)]
    assert total(own.decode(rows)) == pytest.approx(max(map(total, every)))


def test_table_of_pages(spark):
    page = "<html><body><nav><a href='/'>x</a></nav><article><p>{}</p></article><footer>f</footer></body></html>"
    rows = [(i, f"u{i}", page.format(html.escape(SENTENCE) + str(i))) for i in range(30)]
    rows += [(30, None, None), (31, "u", ""), (0, "u0", rows[0][2]), (None, "u", rows[1][2]),
             (32, "long", page.format((SENTENCE + " ") * 3000))]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text")
    field = html_crf.train(frame)
    found = html_crf.extract(frame, field).collect()
    wanted = {r[0]: "" if not r[2] else " ".join(html.unescape(r[2].split("<p>")[1].split("</p>")[0]).split()) for r in rows}
    assert len(found) == len(rows)
    assert all(r.text == wanted[r.page_id] for r in found)
    assert html_crf.extract(frame.limit(0), html_crf.train(frame.limit(0))).count() == 0
