"""Audit of a refined corpus against its raw sources."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from winnow.functions.limits import (
    BLOCK_SECONDS,
    DAY_SECONDS,
    ENGLISH_STOP_WORDS,
    EVAL_METRIC,
    EVAL_ROW,
    LOW_SHARE,
    LOW_SIMILARITY,
    QUALITY_SHARE,
    SAMPLE_ROWS,
)
from winnow.functions.text import folded_words
from winnow.operators.sampling import sample_key, sample_rows
from winnow.operators.skew import lookup
from winnow.session import materialize

WORD_LIKE = r"[\p{L}\p{N}-]+"
LETTERS = r"^\p{L}+$"
SAMPLE_SLICES = 64  # tasks over which a submission's ids are sampled


def lookup_sources(sample: DataFrame, raw: DataFrame, id: str = "id") -> DataFrame:
    """Raw rows of the sampled ids; ids without a raw row are skipped.

    The limit of the sample is known to the optimizer, which broadcasts the ids when they are
    few, so the raw table is read once and not shuffled.
    """
    return raw.join(sample.select(id), id, "left_semi")


def content_words(text: Column) -> Column:
    """Lower-case words made of letters, without stop words, duplicates kept."""
    return F.filter(
        F.regexp_extract_all(F.lower(text), F.lit(WORD_LIKE), F.lit(0)), _is_content
    )


def _is_content(word: Column) -> Column:
    return word.rlike(LETTERS) & ~word.isin(*ENGLISH_STOP_WORDS)


def word_overlap(
    pairs: DataFrame, original: str = "original", refined: str = "refined", id: str = "id"
) -> DataFrame:
    """(id, similarity): share of refined words found in the original, as multisets, in percent.

    Both texts are counted in one grouped pass, word counts being combined before the shuffle;
    the empty row per id keeps ids without any word.
    """

    def found(text: str) -> Column:
        return F.regexp_extract_all(F.lower(F.col(text)), F.lit(WORD_LIKE), F.lit(0))

    def side(words: Column, in_original: int, in_refined: int) -> Column:
        return F.struct(
            words.alias("words"), F.lit(in_original).alias("o"), F.lit(in_refined).alias("r")
        )

    nothing = F.array(F.lit(None).cast("string"))
    sides = F.array(side(found(original), 1, 0), side(found(refined), 0, 1), side(nothing, 0, 0))
    words = (
        pairs.select(id, F.inline(sides))
        .select(id, F.explode("words").alias("word"), "o", "r")
        .where(F.col("word").isNull() | _is_content(F.col("word")))
    )
    counts = words.groupBy(id, "word").agg(F.sum("o").alias("o"), F.sum("r").alias("r"))
    matched, total = F.sum(F.least("o", "r")), F.sum("r")
    return counts.groupBy(id).agg(
        F.when(total > 0, matched / total * 100).otherwise(F.lit(0.0)).alias("similarity")
    )


def audit_corpus(
    refined: DataFrame, raw: DataFrame, n: int = SAMPLE_ROWS, seed: int = 0, id: str = "id"
) -> DataFrame:
    """(id, similarity) of n sampled rows, paired with their raw text by id, to 2 decimals.

    Both inputs are (id, text).
    """
    sample = sample_rows(refined.select(id, "text"), n, seed, id)
    sources = raw.join(
        sample.select(id, F.col("text").alias("refined")), id
    ).withColumnRenamed("text", "original")
    scored = word_overlap(sources, id=id)
    return scored.withColumn("similarity", F.round("similarity", 2))


def sampled_ids(
    submitted: DataFrame,
    by: list[str],
    n: int = SAMPLE_ROWS,
    seed: int = 0,
    id: str = "id",
    slices: int = SAMPLE_SLICES,
) -> DataFrame:
    """(*by, id): n random distinct ids of every submission, all of a smaller one.

    Rows without an id or a submission are left out. The n smallest hashes of a submission are
    those among the n smallest of its slices, so a submission of any size is many tasks, and
    each hands on at most n rows. Only ids are read; the result is written, so that a join with
    it knows its size.
    """
    order = [sample_key(F.col(id), seed), F.col(id)]
    ids = submitted.select(*by, id).dropna().distinct()
    sliced = ids.withColumn("_slice", F.pmod(F.xxhash64(id), F.lit(slices)))
    for group in ([*by, "_slice"], by):
        place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
        sliced = sliced.withColumn("_k", place).where(F.col("_k") <= n).drop("_k")
    return materialize(sliced.drop("_slice"), "sampled-ids")


def audit_samples(
    picked: DataFrame, refined: DataFrame, raw: DataFrame, by: list[str], id: str = "id"
) -> DataFrame:
    """(*by, id, similarity) of the sampled ids of every submission, to 2 decimals.

    `refined` is (*by, id, text), `raw` is (id, text). Ids without a raw row are skipped; of
    several texts of one id the smallest counts; a null text has no words.
    """
    key = [*by, id]
    texts = refined.join(picked, key, "left_semi").groupBy(*key).agg(F.min("text").alias("refined"))
    sources = lookup_sources(picked.select(id).distinct(), raw, id)
    originals = sources.groupBy(id).agg(F.min("text").alias("original"))
    pairs = texts.join(originals, id).select(F.struct(*key).alias("_pair"), "original", "refined")
    scored = word_overlap(pairs, id="_pair")
    return scored.select("_pair.*", F.round("similarity", 2).alias("similarity"))


def similarity_gate(
    similarities: DataFrame,
    tasks: DataFrame,
    on: list[str],
    threshold: float = LOW_SIMILARITY,
    share: float = LOW_SHARE,
) -> DataFrame:
    """(*on, gate): 0 when at least `share` of the samples are at most `threshold`, else 1.

    A task without samples gets 0.
    """
    counted = similarities.groupBy(*on).agg(
        F.count_if(F.col("similarity") <= threshold).alias("_low"),
        F.count(F.lit(1)).alias("_all"),
    )
    zero = F.lit(0)
    low, every = F.coalesce("_low", zero), F.coalesce("_all", zero)
    gate = F.when(low.cast("double") >= F.lit(share) * every, 0).otherwise(1)
    return tasks.select(*on).join(counted, on, "left").select(*on, gate.alias("gate"))


def parse_eval_log(
    lines: DataFrame, line: str = "line", metric: str = EVAL_METRIC
) -> DataFrame:
    """One row (metric, value, stderr) per result row found in the text, other columns kept."""
    pattern = F.lit(EVAL_ROW.format(metric=metric))

    def part(k: int) -> Column:
        return F.regexp_extract_all(F.col(line), pattern, F.lit(k))

    rows = F.arrays_zip(part(1).alias("metric"), part(2).alias("value"), part(3).alias("stderr"))
    keep = [c for c in lines.columns if c != line]
    return lines.select(*keep, F.explode(rows).alias("_row")).select(
        *keep,
        F.col("_row.metric").alias("metric"),
        F.col("_row.value").cast("double").alias("value"),
        F.col("_row.stderr").cast("double").alias("stderr"),
    )


def eval_summary(rows: DataFrame, by: str = "run_id", metric: str = EVAL_METRIC) -> DataFrame:
    """(by, value, stderr): means of one metric, 0 for a run without it."""

    def mean(column: str) -> Column:
        wanted = F.when(F.col("metric") == metric, F.col(column))
        return F.coalesce(F.avg(wanted), F.lit(0.0)).alias(column)

    return rows.groupBy(by).agg(mean("value"), mean("stderr"))


def corpus_quality_eval(
    labelled: DataFrame,
    id: str = "id",
    text: str = "text",
    label: str = "label",
    eval_share: float = 0.2,
    seed: int = 0,
) -> DataFrame:
    """(value, stderr): accuracy, on held-out rows, of a small model trained on the corpus.

    The model is naive Bayes over word counts with add-one smoothing, for labels 0 and 1. Rows
    are split by a hash of their id, so the split does not depend on partitioning. Counts are
    combined before every shuffle; only totals come to the driver.
    """
    bucket = F.conv(F.substring(sample_key(F.col(id), seed), 1, 4), 16, 10).cast("int")
    rows = labelled.select(
        F.col(id).alias("id"),
        (F.col(label) == 1).alias("good"),
        folded_words(F.col(text)).alias("words"),
        (bucket < int(eval_share * 65536)).alias("held_out"),
    )
    known = rows.where("not held_out")
    counts = materialize(
        known.select("good", F.explode("words").alias("word"))
        .groupBy("word")
        .agg(F.count_if("good").alias("yes"), F.count_if(~F.col("good")).alias("no")),
        "word-counts",
    )
    # Two rows of sums, whatever the corpus.
    words = counts.agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"), F.count("*").alias("n")).first()
    texts = known.agg(F.count_if("good").alias("yes"), F.count_if(~F.col("good")).alias("no")).first()
    size = words["n"] or 0
    shift = F.lit(float((words["no"] or 0) + size + 1) / ((words["yes"] or 0) + size + 1))
    prior = math.log((texts["yes"] + 1) / (texts["no"] + 1))
    seen = (
        rows.where("held_out")
        .select("id", "good", F.explode_outer("words").alias("word"))
        .groupBy("id", "good", "word")
        .agg(F.count("word").alias("n"))
    )
    zero = F.lit(0)
    odds = F.ln((F.coalesce("yes", zero) + 1) / (F.coalesce("no", zero) + 1) * shift)
    judged = (
        seen.join(counts, "word", "left")
        .groupBy("id", "good")
        .agg((F.sum(F.col("n") * odds) + F.lit(prior) > 0).alias("guess"))
    )
    correct = judged.select((F.col("guess") == F.col("good")).cast("double").alias("correct"))
    scored = correct.agg(F.avg("correct").alias("value"), F.count(F.lit(1)).alias("n"))
    return scored.select(
        "value", F.sqrt(F.col("value") * (1 - F.col("value")) / F.col("n")).alias("stderr")
    )


def elapsed_time(commits: DataFrame, tasks: DataFrame) -> DataFrame:
    """Adds the task of the uid and the seconds from request to commit; no task, no row."""
    joined = lookup(commits, tasks, ["uid"])
    blocks = F.col("commit_block") - F.col("request_block")
    return joined.withColumn("elapsed", blocks * BLOCK_SECONDS)


def score_column(
    gate: Column, value: Column, stderr: Column, elapsed: Column, x: float = QUALITY_SHARE
) -> Column:
    """Quality and speed blended; 0 for a submission that fails the gate."""
    late = F.greatest(F.least(elapsed, F.lit(DAY_SECONDS)), F.lit(0)) / F.lit(float(DAY_SECONDS))
    blend = F.lit(x) * value * (1 - stderr) + F.lit(1 - x) * (1 - late)
    return F.when(gate == 0, F.lit(0.0)).otherwise(blend)


def submission_score(df: DataFrame, x: float = QUALITY_SHARE) -> DataFrame:
    columns = [F.col(c) for c in ("gate", "value", "stderr", "elapsed")]
    return df.withColumn("score", score_column(*columns, x=x))
