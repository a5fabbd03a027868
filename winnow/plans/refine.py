"""The refining chain: URL, main text, language, repetition, quality, C4, line rules."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from winnow.functions.limits import C4Quality, FineWebQuality, GopherQuality, GopherRepetition
from winnow.functions.text import computed, let
from winnow.operators import extract, language, quality, url
from winnow.session import small_batches

STAGES = (
    "1_url", "2_non_english", "3_gopher_rep", "4_gopher_qual", "5_c4", "6_fineweb_qual",
)


@dataclass(frozen=True)
class RefineSettings:
    domains: list[str] | DataFrame = field(default_factory=list)  # a table may be of any size
    words: list[str] = field(default_factory=list)
    target: str = "en"
    min_score: float = language.MIN_SCORE
    repetition: GopherRepetition = GopherRepetition()
    quality: GopherQuality = GopherQuality()
    c4: C4Quality = C4Quality()
    fineweb: FineWebQuality = FineWebQuality()


def _stage(drop: Column, stage: str, reason: Column) -> Column:
    """Judge a row that is still in; the first failing stage owns the drop.

    COALESCE does not evaluate the reason for a row that is already out.
    """
    failed = let(
        reason,
        lambda r: F.when(r.isNotNull(), F.struct(F.lit(stage).alias("stage"), r.alias("reason"))),
    )
    return F.coalesce(drop, failed)


def refine(
    pages: DataFrame, profiles: language.Profiles, settings: RefineSettings = RefineSettings()
) -> DataFrame:
    """(id, url, html, ...) in; every row out with its text and, if dropped, stage and reason.

    One pass without a shuffle. Work on rows that are already out is skipped: later stages see
    a NULL text for them.
    """
    s = settings
    small_batches(pages.sparkSession)
    drop, text = F.col("_drop"), F.col("text")
    inside = F.when(drop.isNull(), text)
    nothing = F.lit(None).cast("struct<stage:string,reason:string>")
    if isinstance(s.domains, DataFrame):
        pages = url.url_filter(pages, s.domains, s.words).drop("keep")
        blocked = F.col("drop_reason")
    else:
        blocked = url.url_reason(F.col("url"), s.domains, s.words)
    url_verdict = _stage(nothing, STAGES[0], blocked)
    df = computed(pages, "_drop", url_verdict)
    # A page that is out is no text, hence no work.
    page = F.when(drop.isNull(), F.col("html"))
    df = computed(df, "text", extract.main_text(page)).drop("html")

    df = language.with_language(df, profiles)
    target = language.language_reason(s.target, s.min_score)
    df = computed(df, "_drop", _stage(drop, STAGES[1], target))

    df = computed(df, "_repeated", quality.repeated_word_chars(inside, s.repetition))
    repetition = quality.repetition_reason(text, F.col("_repeated"), s.repetition)
    general = quality.quality_reason(text, s.quality)
    df = computed(df, "_drop", _stage(drop, STAGES[2], repetition)).drop("_repeated")
    df = computed(df, "_drop", _stage(drop, STAGES[3], general))

    cleaned = F.col("_cleaned")
    df = computed(df, "_cleaned", F.when(drop.isNull(), quality.c4_text(text, s.c4)))
    df = computed(df, "_drop", _stage(drop, STAGES[4], quality.c4_reason(text, cleaned, s.c4)))
    by_lines = _stage(drop, STAGES[5], quality.fineweb_reason(cleaned, s.fineweb))
    df = computed(df, "_drop", by_lines).withColumn("text", F.coalesce(cleaned, text))
    return df.withColumns(
        {"drop_stage": F.col("_drop.stage"), "drop_reason": F.col("_drop.reason")}
    ).drop("_drop", "_cleaned")


def kept(refined: DataFrame) -> DataFrame:
    return refined.where("drop_stage is null").drop("drop_stage", "drop_reason")


def removed(refined: DataFrame) -> DataFrame:
    return refined.where("drop_stage is not null")


def stage_stats(refined: DataFrame) -> DataFrame:
    """Documents entering, dropped and left per stage, and characters dropped.

    A stage that drops nothing has a row too.
    """
    found = refined.groupBy(F.coalesce("drop_stage", F.lit("kept")).alias("stage")).agg(
        F.count(F.lit(1)).alias("documents"), F.sum(F.length("text")).alias("chars")
    )
    every = refined.sparkSession.createDataFrame([(s,) for s in (*STAGES, "kept")], "stage string")
    zero = F.lit(0).cast("long")
    dropped = every.join(found, "stage", "left").select(
        "stage",
        F.coalesce("documents", zero).alias("documents"),
        F.coalesce("chars", zero).alias("chars"),
    )
    # The window runs over one row per stage.
    later = Window.partitionBy(F.lit(1)).orderBy("stage").rowsBetween(
        Window.currentRow, Window.unboundedFollowing
    )
    return dropped.withColumn("documents_in", F.sum("documents").over(later)).withColumn(
        "documents_left", F.col("documents_in") - F.when(F.col("stage") != "kept", F.col("documents")).otherwise(0)
    )
