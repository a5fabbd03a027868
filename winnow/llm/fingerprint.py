"""I-Match fingerprints: hashes of a document's terms in randomised lexicons.

Terms are lower-case runs without ASCII blanks, signs and controls. The lexicon holds the terms whose document
frequency lies between two shares of the corpus: rare terms tell nothing about other texts, common
ones say nothing. A document has at most so many distinct terms, so the number of terms above a
share is at most the mean number of terms divided by that share: the lexicon does not grow with
the corpus and may be broadcast. Each randomised lexicon keeps a share of it, chosen by a hash of
the term; a fingerprint is the hash of the sorted distinct terms in each, and of all terms.

The likeness of two fingerprints is the share of equal hashes among the lexicons in which either
text has terms; 1 for equal texts.

Nulls are empty texts. Documents are ordered by id (those without one first, equal ids in an order
of their own); repeated rows are documents of their own with equal fingerprints. Columns other
than the id and the text are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from winnow.operators.skew import ranked
from winnow.session import materialize

LOWEST, HIGHEST = 0.001, 0.2  # document frequency of lexicon terms, as shares of the documents
#: The share of the lexicon that each randomised lexicon keeps, of 65536.
RATES = [4096] * 16 + [1024] * 24 + [512] * 24
SLICE = 64  # ids worked on together


def terms(text: Column) -> Column:
    """Distinct terms, without order."""
    # ASCII signs alone: a class that the pattern matcher looks up in a table.
    words = F.split(F.lower(text), "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
    return F.array_remove(F.array_distinct(words), "")


def lexicon(
    docs: DataFrame, lowest: float = LOWEST, highest: float = HIGHEST, text: str = "text"
) -> DataFrame:
    """(term, member): terms within the band, and the randomised lexicons that have them."""
    rows = docs.count()
    found = docs.select(F.explode(terms(F.col(text))).alias("term")).groupBy("term").count()
    share = F.col("count") / F.lit(max(rows, 1))
    digits = F.md5("term")
    # Sixteen draws of 16 bits from each of several salted hashes of the term.
    salts = range(-(-len(RATES) // 16))
    drawn = found.where((share >= lowest) & (share <= highest)).select(
        "term", *[F.sha2(F.concat(F.lit(f"{s}:"), "term"), 256).alias(f"_d{s}") for s in salts]
    )
    kept = [
        F.when(F.substring(f"_d{i // 16}", i % 16 * 4 + 1, 4) < f"{rate:04x}", F.lit(f"{i:02d}"))
        for i, rate in enumerate(RATES)
    ]
    return materialize(
        drawn.select("term", F.array_compact(F.array(*kept)).alias("member")), "lexicon"
    )


def following(docs: DataFrame) -> DataFrame:
    """`docs` (_key, doc_id, text) with `_next`, the row after each by id; after the last the first.

    Rows are sorted within slices of neighbouring ids. The first rows of the slices, one in a
    slice, go to the slices before.
    """
    sliced = docs.withColumn("_part", F.coalesce(F.shiftright("doc_id", 6), F.lit(-(1 << 62))))
    order = Window.partitionBy("_part").orderBy(F.col("doc_id").asc_nulls_first(), "_key")
    row = F.struct("_key", "text")
    marked = sliced.withColumn("_next", F.lead(row).over(order))
    place = ranked(sliced.select("_part").distinct(), [], [F.col("_part")]).drop("_before")
    place = materialize(place, "slices")
    count = place.count()
    first = sliced.groupBy("_part").agg(
        F.min(F.struct(F.col("doc_id").isNotNull().alias("a"), "doc_id", "_key", "text")).alias("r")
    )
    before = place.select(
        F.col("_rank").alias("_after"), F.col("_part").alias("_from")
    )
    edges = (
        first.join(place, "_part")
        .select(
            F.when(F.col("_rank") == 1, F.lit(count)).otherwise(F.col("_rank") - 1).alias("_after"),
            F.struct("r._key", "r.text").alias("_edge"),
        )
        .join(before, "_after")
        .select(F.col("_from").alias("_part"), "_edge")
    )
    return marked.join(edges, "_part", "left").select(
        *docs.columns, "_part", F.coalesce("_next", "_edge").alias("_next")
    )


def segments(pairs: Column) -> Column:
    """Lines of the terms of one side and lexicon, from sorted (side, lexicon, term)."""

    def piece(pair: Column, i: Column) -> Column:
        last = F.get(pairs, i - 1)
        same = (last["side"] == pair["side"]) & (last["lexicon"] == pair["lexicon"])
        head = F.concat(F.lit("\n"), pair["side"].cast("string"), pair["lexicon"])
        return F.concat(F.when(same, F.lit("")).otherwise(head), F.lit(" "), pair["term"])

    return F.split(F.array_join(F.transform(pairs, piece), ""), "\n")


def hashes(lines: Column, side: int, whole: Column) -> Column:
    """lexicon=hash of each lexicon that has terms of the side, and a hash of all terms."""
    own = F.filter(lines, lambda line: F.startswith(line, F.lit(str(side))))
    each = F.transform(
        own,
        lambda line: F.concat(
            F.substring(line, 2, 2), F.lit("="), F.substring(F.md5(F.substr(line, F.lit(5))), 1, 8)
        ),
    )
    return F.array_join(F.concat(each, F.array(F.concat(F.lit("**="), whole))), ":")


def likeness(a: Column, b: Column) -> Column:
    """The share of lexicons with equal hashes among those in which either text has terms."""
    one, other = F.split(a, ":"), F.split(b, ":")
    name = lambda entry: F.substring(entry, 1, 2)
    told = F.array_union(F.transform(one, name), F.transform(other, name))
    return F.size(F.array_intersect(one, other)) / F.size(told)


def whole_hash(found: Column) -> Column:
    return F.substring(F.md5(F.array_join(F.array_sort(found), " ")), 1, 16)


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of texts and of texts whose second half is the beginning of the next text.

    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)
    """
    docs = docs.select(
        F.monotonically_increasing_id().alias("_key"),
        F.col(id).cast("long").alias("doc_id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    known = lexicon(docs)
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = (
        following(docs)
        .withColumn("n_chars", F.length("text").cast("long"))
        .withColumn(
            "_edited",
            F.concat(
                F.expr("left(text, int(n_chars - floor(n_chars / 2)))"),
                F.substring(F.col("_next.text"), F.lit(1), half),
            ),
        )
        .withColumn("_own", terms(F.col("text")))
        .withColumn("_other", terms(F.col("_edited")))
    )
    edited = edited.withColumn(
        "_facts",
        F.struct(
            "doc_id",
            "n_chars",
            F.col("_next._key").alias("_next"),
            F.sha2(F.encode("_edited", "utf-8"), 256).alias("edited_sha256"),
            whole_hash(F.col("_own")).alias("own"),
            whole_hash(F.col("_other")).alias("other"),
        ),
    )
    # The blank stands for the row itself: it keeps texts without terms and carries the facts.
    sides = edited.select(
        "_part",
        "_key",
        "_facts",
        F.inline(
            F.array(
                F.struct(F.lit(0).alias("side"), F.array(F.lit(" ")).alias("list")),
                F.struct(F.lit(1).alias("side"), F.col("_own").alias("list")),
                F.struct(F.lit(2).alias("side"), F.col("_other").alias("list")),
            )
        ),
    ).select(
        "_part",
        "_key",
        "side",
        F.when(F.col("side") == 0, F.col("_facts")).alias("_facts"),
        F.explode("list").alias("term"),
    )
    blank = known.sparkSession.range(1).select(
        F.lit(" ").alias("term"), F.array().cast("array<string>").alias("member")
    )
    held = sides.join(F.broadcast(known.unionByName(blank)), "term")
    # The rows of a text are where its slice is: this grouping needs no shuffle.
    grouped = held.groupBy("_part", "_key").agg(
        F.max("_facts").alias("f"),
        F.collect_list(F.when(F.size("member") > 0, F.struct("side", "term", "member"))).alias("found"),
    )
    pairs = F.flatten(
        F.transform(
            "found",
            lambda t: F.transform(
                t["member"],
                lambda m: F.struct(
                    t["side"].alias("side"), m.alias("lexicon"), t["term"].alias("term")
                ),
            ),
        )
    )
    lined = grouped.select("_key", "f", F.sort_array(pairs).alias("pairs")).select(
        "_key", "f", segments(F.col("pairs")).alias("lines")
    )
    marked = materialize(
        lined.select(
            "_key",
            "f.*",
            hashes(F.col("lines"), 1, F.col("f.own")).alias("fingerprint"),
            hashes(F.col("lines"), 2, F.col("f.other")).alias("edited_fingerprint"),
        ).drop("own", "other"),
        "fingerprints",
    )
    after = marked.select(F.col("_key").alias("_next"), F.col("fingerprint").alias("_after"))
    return marked.join(after, "_next").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("_after")).alias("near_next"),
    )
