"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of a page.

A leaf block is text between two tags that break lines. Its features are the tags around it, words
of their classes and ids, and facts of its text; the field adds which label follows which. It is
trained on labelled pages: a bounded sample of the pages at hand that mark their article, some of
them with the marks taken off, and pages made from their paragraphs in a number of layouts whose
labels are known. Viterbi decoding labels all blocks of a page at once.

Null and empty pages give an empty text. Repeated rows give equal results. Whole pages are read,
whatever their length; scripts, styles and other raw text end where their element does. An svg also
ends at a slash in its tag or before an HTML block tag, as in browsers; a template or noscript that
never closes takes nothing with it. Columns other than the id, the address and the page are ignored.
An empty table gives no rows.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from winnow.llm.workers import lean
from winnow.session import small_batches

SAMPLE = 384  # labelled pages of the table, at most
SAMPLE_CHARS = 20_000  # a longer page teaches nothing that a shorter one does not
MADE = 600  # pages in made layouts
BITS = 15  # hashed features
EPOCHS = 8

# HTML elements by what they do to the text around them.
BREAKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li "
    "main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th "
    "thead tr ul".split()
)
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
VOID = frozenset("hr".split())
#: An opening tag ends these open elements first.
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "body": ("head",),
}
KEEPS_P = frozenset("option optgroup select button caption legend".split())

NAME = re.compile(r"/?[a-zA-Z][^\s/>]*")
NEXT = re.compile(r"[\"'>]")
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
WORD = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+")


class Block:
    __slots__ = ("links", "path", "tag", "text")

    def __init__(self, text: str, tag: str, path: tuple, links: int):
        self.text, self.tag, self.path, self.links = text, tag, path, links


def tag_end(page: str, at: int, none: dict[str, int]) -> int:
    """Where the tag that starts before `at` ends. A quote that never closes is no quote.

    `none` remembers from where on a sign is not found, which keeps long broken pages linear.
    """
    while True:
        found = NEXT.search(page, at)
        if found is None:
            return -1
        sign, at = found[0], found.end()
        if sign == ">":
            return at
        if page[found.start() - 1] != "=" or at >= none.get(sign, len(page) + 1):
            continue
        close = page.find(sign, at)
        if close < 0:
            none[sign] = at
        else:
            at = close + 1


def raw_end(page: str, name: str, at: int, none: dict[str, int]) -> int:
    """Where the raw text of an element ends with its closing tag; -1 if there is none."""
    if at >= none.get(name, len(page) + 1):
        return -1
    end = re.compile(f"</{name}(?=[\\s/>])", re.I).search(page, at)
    if end is None:
        none[name] = at
        return -1
    stop = tag_end(page, end.end(), none)
    return len(page) if stop < 0 else stop


def tags(page: str, at: int, none: dict[str, int]) -> Iterator[tuple[int, str, int]]:
    """(start, name, end) of the tags from `at` on, without those in comments and raw text."""
    while (mark := page.find("<", at)) >= 0:
        found = NAME.match(page, mark + 1)
        if found is None:
            at = mark + 1
            if page.startswith("<!--", mark):
                at = page.find("-->", mark + 4) + 3
                if at < 3:
                    return
            continue
        at = tag_end(page, found.end(), none)
        if at < 0:
            return
        name = found[0].lower()
        yield mark, name, at
        if name in RAW and page[at - 2] != "/":
            at = max(at, raw_end(page, name, at, none))


def closed(page: str, none: dict[str, int]) -> dict[int, int]:
    """Ends of the templates and foreign objects of a page that close, by the ends of their tags."""
    ends: dict[int, int] = {}
    opened: dict[str, list[int]] = {"template": [], "foreignobject": []}
    for _, name, stop in tags(page, 0, none):
        if name in opened:
            if name == "template" or page[stop - 2] != "/":
                opened[name].append(stop)
        elif name[0] == "/" and opened.get(name[1:]):
            ends[opened[name[1:]].pop()] = stop
    return ends


def svg_end(page: str, at: int, none: dict[str, int], ends: Callable[[], dict[int, int]]) -> int:
    """Where the svg whose tag ends at `at` ends: at its closing tag or before an HTML block tag."""
    depth, skip = 1, at
    for mark, name, stop in tags(page, at, none):
        if mark < skip:  # HTML in a foreign object
            continue
        if name.removeprefix("/") in BREAKS:
            return mark
        if name == "foreignobject":
            skip = ends().get(stop, stop)
        elif name == "svg" and page[stop - 2] != "/":
            depth += 1
        elif name == "/svg":
            depth -= 1
            if not depth:
                return stop
    return len(page)


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page, in order."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    held: list[str] = []
    links = anchor = at = 0
    none: dict[str, int] = {}
    ends = cache(lambda: closed(page, {}))

    def flush() -> None:
        nonlocal links
        if held:
            text = " ".join("".join(held).split())
            if text:
                tag = stack[-1][0] if stack else "body"
                out.append(Block(text, tag, tuple(stack), links))
            held.clear()
            links = 0

    def take(start: int, stop: int) -> None:
        nonlocal links
        if stop > start:
            part = page[start:stop]
            part = html.unescape(part) if "&" in part else part
            held.append(part)
            if anchor:
                links += len(part.strip())

    def close(name: str) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == name:
                del stack[i:]
                return

    size = len(page)
    while at < size:
        mark = page.find("<", at)
        if mark < 0:
            take(at, size)
            break
        found = NAME.match(page, mark + 1)
        if found is None:
            if page.startswith("<!--", mark):
                stop = page.find("-->", mark + 4)
                take(at, mark)
                at = size if stop < 0 else stop + 3
            elif page.startswith(("<!", "<?", "</"), mark):
                stop = page.find(">", mark)
                take(at, mark)
                at = size if stop < 0 else stop + 1
            else:  # a bare sign
                take(at, mark + 1)
                at = mark + 1
            continue
        take(at, mark)
        stop = tag_end(page, found.end(), none)
        if stop < 0:
            break  # a tag cut off by the end of the page
        name, at = found[0].lower(), stop
        if name[0] == "/":
            name = name[1:]
            if name == "a":
                anchor = 0
            elif name in BREAKS:
                flush()
                close(name)
        elif name in RAW:
            at = raw_end(page, name, at, none)
            at = size if at < 0 else at
        elif name == "svg":
            at = at if page[at - 2] == "/" else svg_end(page, at, none, ends)
        elif name == "template":
            at = ends().get(at, at)
        elif name == "noscript":
            at = max(at, raw_end(page, name, at, none))
        elif name == "a":
            anchor = 1
        elif name == "br":
            held.append(" ")
        elif name in BREAKS:
            flush()
            if name not in KEEPS_P and stack and stack[-1][0] == "p":
                stack.pop()
            for other in ENDS.get(name, ()):
                if stack and stack[-1][0] == other:
                    stack.pop()
            if name not in VOID:
                words: list[str] = []
                if stop - found.end() > 4:
                    for groups in NAMES.findall(page, found.end(), stop):
                        words += [w.lower() for w in WORD.findall("".join(groups))]
                stack.append((name, tuple(words)))
    flush()
    return out


HASHED: dict[str, int] = {}


def slot(feature: str) -> int:
    found = HASHED.get(feature)
    if found is None:
        if len(HASHED) > 200_000:
            HASHED.clear()
        found = HASHED[feature] = zlib.crc32(feature.encode()) >> (32 - BITS)
    return found


def features(page: list[Block], hidden: frozenset[str] = frozenset()) -> list[list[int]]:
    """Slots of the active features of each block; tags in `hidden` look like a div."""
    out = []
    paths: dict[tuple, list[str]] = {}
    for no, block in enumerate(page):
        known = paths.get(block.path)
        if known is None:
            names = {"div" if t in hidden else t for t, _ in block.path}
            words = {w for _, own in block.path for w in own}
            inner = ["div" if t in hidden else t for t, _ in block.path[-3:]]
            known = [f"in:{t}" for t in names] + [f"word:{w}" for w in words]
            known += ["path:" + ">".join(inner)]
            known += [f"own:{w}" for _, own in block.path[-2:] for w in own]
            paths[block.path] = known
        text = block.text
        length = len(text)
        words_ = text.count(" ") + 1
        linked = 0 if not block.links else 1 + min(3, 4 * block.links // (length + 1))
        stops = text.count(".") + text.count("?") + text.count("!")
        facts = (
            "bias",
            f"tag:{'div' if block.tag in hidden else block.tag}",
            f"size:{min(words_, 120).bit_length()}",
            f"links:{linked}",
            f"size-links:{min(words_, 63).bit_length()},{linked}",
            f"stops:{min(stops, 4)}",
            f"end:{text[-1] if not text[-1].isalnum() else 'a'}",
            f"sign:{'c' if '©' in text else ''}{'p' if '|' in text else ''}{'q' if '»' in text else ''}",
            f"first:{no == 0}",
            f"last:{no == len(page) - 1}",
        )
        out.append([slot(f) for f in (*known, *facts)])
    return out


class Field:
    """Weights of the label "main text" against the other, and of one label after another."""

    def __init__(self):
        self.weights = np.zeros(1 << BITS)
        self.turns = np.zeros((2, 2))

    def emissions(self, rows: list[list[int]]) -> list[float]:
        weights = self.weights
        return [float(weights[r].sum()) for r in rows]

    def decode(self, rows: list[list[int]]) -> list[int]:
        """Viterbi: the most likely labels of a page's blocks."""
        if not rows:
            return []
        (a, b), (c, d) = self.turns.tolist()
        back, other, main = [], 0.0, None
        for value in self.emissions(rows):
            if main is None:
                main = value
                continue
            stay, leave, enter, go = other + a, main + c, other + b, main + d
            back.append((int(leave > stay), int(go > enter)))
            other, main = max(stay, leave), max(enter, go) + value
        label = int(main > other)
        labels = [label]
        for step in reversed(back):
            label = step[label]
            labels.append(label)
        return labels[::-1]

    def step(self, rows: list[list[int]], labels: list[int], history: dict, rate: float) -> None:
        """One gradient step (AdaGrad) on the log-likelihood of a labelled page."""
        n = len(rows)
        score = np.zeros((n, 2))
        score[:, 1] = self.emissions(rows)
        ahead, behind = np.zeros((n, 2)), np.zeros((n, 2))
        ahead[0] = score[0]
        for i in range(1, n):
            ahead[i] = np.logaddexp.reduce(ahead[i - 1][:, None] + self.turns, axis=0) + score[i]
        for i in range(n - 2, -1, -1):
            behind[i] = np.logaddexp.reduce(self.turns + score[i + 1] + behind[i + 1], axis=1)
        total = np.logaddexp.reduce(ahead[-1])
        chance = np.exp(ahead[:, 1] + behind[:, 1] - total)
        wrong = np.asarray(labels) - chance
        turns = np.zeros((2, 2))
        for i in range(1, n):
            joint = ahead[i - 1][:, None] + self.turns + score[i] + behind[i]
            turns -= np.exp(joint - total)
            turns[labels[i - 1], labels[i]] += 1
        slots = np.concatenate([np.asarray(r) for r in rows])
        slope = np.bincount(slots, np.repeat(wrong, [len(r) for r in rows]), 1 << BITS)
        slope -= 1e-4 * self.weights
        history["w"] += slope**2
        history["t"] += turns**2
        self.weights += rate * slope / np.sqrt(history["w"])
        self.turns += rate * turns / np.sqrt(history["t"])


def fit(pages: list[tuple[list[list[int]], list[int]]]) -> Field:
    """Train on labelled pages: feature rows and labels of their blocks."""
    field = Field()
    history = {"w": np.full(1 << BITS, 1e-2), "t": np.full((2, 2), 1e-2)}
    draw = np.random.default_rng(5)
    pages = [p for p in pages if p[0]]
    for epoch in range(EPOCHS):
        for i in draw.permutation(len(pages)):
            field.step(*pages[i], history, 0.3 / (1 + epoch / 4))
    return field


MARKS = frozenset(("article", "main"))
ASIDE = frozenset("nav header footer aside form menu select button dialog".split())
ASIDE_WORDS = frozenset(
    "comment comments reply replies respond share social related sidebar ad ads advert sponsored "
    "promo cookie notice newsletter breadcrumb pagination".split()
)


def marked(page: list[Block]) -> list[int] | None:
    """Labels of a page that marks one article; None if it marks none."""
    labels = []
    for block in page:
        names = [t for t, _ in block.path]
        inside = [i for i, t in enumerate(names) if t in MARKS]
        inner = block.path[inside[0] + 1 :] if inside else ()
        aside = any(t in ASIDE or ASIDE_WORDS & set(words) for t, words in inner)
        labels.append(int(bool(inside) and not aside))
    return labels if any(labels) else None


# How pages of different makers name their parts. Each part is a pattern for its pieces and a
# frame around them; {} is where the text goes.
FRAMES = {
    "main": (
        ("<article>{}</article>", "<main>{}</main>", "<main><article>{}</article></main>",
         '<div class="post-content">{}</div>', '<div id="content"><div class="entry">{}</div></div>',
         '<div class="article-body">{}</div>', '<section class="story">{}</section>', "<div>{}</div>",
         '<table><tr><td class="content">{}</td></tr></table>', '<div role="main">{}</div>'),
        ("<p>{}</p>", "<p>{}", "<p><b>{}<br>", "<div>{}</div>", "<blockquote>{}</blockquote>", "<h2>{}</h2>", "<ul><li>{}</li></ul>",
         "<p>{}</p>", "<p>{}</p>", "<pre>{}</pre>"),
    ),
    "menu": (
        ("<nav><ul>{}</ul></nav>", '<div class="menu"><ul>{}</ul></div>', '<ul id="navbar">{}</ul>',
         '<div class="breadcrumb">{}</div>', "<nav>{}</nav>", '<div role="navigation">{}</div>'),
        ('<li><a href="/x">{}</a></li>', '<a href="/x">{}</a> | ', '<li><a href="/y">{}</a>'),
    ),
    "header": (
        ("<header>{}</header>", '<div id="header">{}</div>', '<div class="masthead">{}</div>'),
        ('<a class="logo" href="/">{}</a>', "<p>{}</p>", "<h1>{}</h1>", "<div>{}</div>"),
    ),
    "footer": (
        ("<footer>{}</footer>", '<div id="footer">{}</div>', '<div class="site-footer">{}</div>'),
        ("&copy; site &middot; {}", "<p>{}</p>", '<a href="/imprint">{}</a> ', "<div>&copy; {}</div>"),
    ),
    "sidebar": (
        ("<aside>{}</aside>", '<div class="sidebar">{}</div>', '<div id="sidebar-right">{}</div>',
         '<div class="related">{}</div>', '<div class="widget">{}</div>', '<div class="share social">{}</div>'),
        ('<h3>{}</h3><ul><li><a href="/z">{}</a></li></ul>', "<p>{}</p>", "<div>{}</div>"),
    ),
    "notice": (
        ('<div class="cookie-notice">{}</div>', '<div id="cookie-banner">{}</div>',
         '<div class="alert">{}</div>', '<div class="newsletter">{}</div>', '<div class="notice">{}</div>',
         '<div class="gdpr consent">{}</div>', '<dialog>{}</dialog>', '<div role="alert">{}</div>'),
        ("<p>{}</p>", "{}", "<p>{}</p><button>OK</button>"),
    ),
    "advert": (
        ('<div class="ad">{}</div>', '<div class="advert">{}</div>', '<div class="sponsored">{}</div>',
         '<div id="banner-ads">{}</div>', '<aside class="promo">{}</aside>', '<div class="advertisement">{}</div>'),
        ("{}", "<p>{}</p>", '<a href="//x">{}</a>'),
    ),
    "form": (
        ('<form action="/s">{}</form>', '<form class="search">{}</form>', '<form id="login">{}</form>'),
        ("<label>{}</label><input>", "<button>{}</button>", "<p>{}</p>", "<select><option>{}</select>"),
    ),
    "comments": (
        ('<section class="comments">{}</section>', '<div id="comments">{}</div>', '<ol class="comment-list">{}</ol>',
         '<div class="replies">{}</div>', '<div class="disqus comment-thread">{}</div>',
         '<section id="respond">{}</section>', '<div class="user-comments">{}</div>'),
        ('<div class="comment"><p>{}</p></div>', "<p>{}</p>", "<li>{}</li>", "<article><p>{}</p></article>"),
    ),
}


def made_pages(texts: list[str], number: int) -> Iterator[tuple[list[Block], list[int]]]:
    """Labelled pages: paragraphs at hand in pages of many layouts."""
    draw = np.random.default_rng(11)
    one = lambda options: options[draw.integers(len(options))]
    stamp = "\x02"  # tells blocks of the main part from others, and is taken off again

    def part(kind: str) -> str:
        frames, pieces = FRAMES[kind]
        body = ""
        for _ in range(draw.integers(1, 9 if kind in ("main", "menu", "comments") else 4)):
            piece = one(pieces)
            for _ in range(piece.count("{}")):
                words = one(texts).split()
                long = kind in ("main", "comments") or draw.random() < 0.3
                least = 4 if long else 1
                most = 120 if kind == "main" else 40 if long else 6
                count = int(draw.integers(least, most))
                start = int(draw.integers(max(1, len(words) - count)))
                said = html.escape(" ".join(words[start : start + count]) or "x")
                if kind == "main" and not said.endswith(".") and draw.random() < 0.8:
                    said += "."
                piece = piece.replace("{}", (stamp if kind == "main" else "") + said, 1)
            body += piece
        if kind == "main":
            body = (f"<h1>{stamp}{html.escape(one(texts)[:60])}</h1>" if draw.random() < 0.7 else "") + body
            for other in ("advert", "comments", "sidebar", "form"):
                if draw.random() < 0.12:
                    body += part(other)
        return one(frames).replace("{}", body, 1)

    for _ in range(number):
        before = [k for k in ("header", "menu", "notice", "advert", "form") if draw.random() < 0.45]
        after = [k for k in ("sidebar", "comments", "form", "advert", "notice", "footer") if draw.random() < 0.5]
        if draw.random() < 0.2:
            before, after = [*before, "sidebar"], [k for k in after if k != "sidebar"]
        page = "".join(map(part, [*before, "main", *after]))
        frame = one(("{}", "<div id='page'>{}</div>", '<div class="wrapper"><div>{}</div></div>'))
        found = blocks(f"<html><body>{frame.replace('{}', page, 1)}</body></html>")
        labels = [int(stamp in b.text) for b in found]
        for block in found:
            block.text = block.text.replace(stamp, "") or "x"
        yield found, labels


def train(pages: DataFrame, page: str = "html") -> Field:
    """A field from at most SAMPLE pages that mark their article, and from made pages."""
    fit_for_it = F.length(page).between(1, SAMPLE_CHARS) & F.col(page).rlike("(?i)<(article|main)[\\s>]")
    hashed = pages.where(fit_for_it).select(F.col(page).alias("page"), F.xxhash64(page).alias("h"))
    # First the hashes alone: else every task would send so many whole pages to the driver.
    last = hashed.select("h").orderBy("h").limit(SAMPLE).agg(F.max("h")).first()[0]
    sample = hashed.where(F.col("h") <= F.lit(last)).orderBy("h", "page").limit(SAMPLE)
    known, texts = [], []
    for no, row in enumerate(sample.collect()):
        found = blocks(row["page"])
        labels = marked(found)
        if labels:
            known.append((features(found, MARKS if no % 2 else frozenset()), labels))
            texts += [b.text for b, main in zip(found, labels, strict=True) if main]
    texts = texts or ["A page without any text, and one more sentence. Then an end."]
    known += [(features(found), labels) for found, labels in made_pages(texts, MADE)]
    return fit(known)


def main_text(page: str, field: Field) -> str:
    found = blocks(page)
    labels = field.decode(features(found))
    return "\n".join(b.text for b, label in zip(found, labels, strict=True) if label)


def extract(
    pages: DataFrame, field: Field, id: str = "page_id", url: str = "url", page: str = "html"
) -> DataFrame:
    """(page_id, url, text) of every row."""
    small_batches(pages.sparkSession)

    def run(batches):
        for batch in batches:
            texts = [main_text(p, field) for p in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                ["page_id", "url", "text"],
            )

    plain = pages.select(
        F.col(id).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(page), F.lit("")).alias("html"),
    )
    return plain.mapInArrow(lean(run), "page_id long, url string, text string")
