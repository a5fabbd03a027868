"""From pages to a published corpus, with a report of every stage."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, functions as F

from winnow.operators import dedup, language, pii
from winnow.plans.refine import STAGES, RefineSettings, kept, refine
from winnow.session import materialize, scratch_owned
from winnow.sources.files import publish_dataset, write_removed

DUPLICATES = "7_duplicates"
STATS_SCHEMA = (
    "stage string, documents bigint, chars bigint, documents_in bigint, documents_left bigint"
)


@dataclass(frozen=True)
class Published:
    path: str  # the corpus
    removed: str  # dropped documents, a folder per stage or language
    stats: DataFrame  # as of `stage_stats`, with a row for duplicates


def _measures(name: str, rows: Column) -> list[Column]:
    """Number and characters of the texts that are one of `rows`."""
    return [
        F.count_if(rows).alias(f"{name}_documents"),
        F.coalesce(F.sum(F.when(rows, F.length("text"))), F.lit(0).cast("long")).alias(
            f"{name}_chars"
        ),
    ]


def publish_corpus(
    pages: DataFrame, profiles: language.Profiles, folder: str, name: str, at: datetime,
    settings: RefineSettings = RefineSettings(),
) -> Published:
    """Refine, write removed documents, drop duplicates, count tokens, mask, publish.

    Pages are judged once, while they are written. Numbers of each stage are observed in that
    write and in the last one: both are the last stage of their job, where a repeated task counts
    once. Documents without text count with 0 characters. A page without an id takes no part in
    the search for duplicates and stays. An empty table gives a corpus without rows.
    """
    spark = pages.sparkSession
    by_stage, at_end = Observation("stages"), Observation("published")
    removed = f"{folder}/{name}_{at:%Y_%m_%d_%H}_removed"
    stage = F.coalesce("drop_stage", F.lit("kept"))
    with scratch_owned(spark):
        judged = refine(pages, profiles, settings).observe(
            by_stage, *(m for s in (*STAGES, "kept") for m in _measures(s, stage == s))
        )
        judged = materialize(judged, "refined")
        write_removed(judged, removed)
        fresh = kept(judged)
        unique = dedup.drop_duplicates(fresh, dedup.text_clusters(fresh))
        unique = unique.observe(at_end, *_measures("kept", F.lit(True)))
        corpus = pii.pii_mask(pii.token_count(unique))
        path = publish_dataset([corpus], folder, name, at)
    return Published(path, removed, _stats(spark, by_stage.get, at_end.get))


def _stats(spark, by_stage: dict[str, int], at_end: dict[str, int]) -> DataFrame:
    """A row for each of the eight stages, from the observed numbers."""
    found = {s: (by_stage[f"{s}_documents"], by_stage[f"{s}_chars"]) for s in STAGES}
    last = (at_end["kept_documents"], at_end["kept_chars"])
    refined = (by_stage["kept_documents"], by_stage["kept_chars"])
    found[DUPLICATES] = (refined[0] - last[0], refined[1] - last[1])
    inside = sum(documents for documents, _ in found.values()) + last[0]
    rows = []
    for stage, (documents, chars) in found.items():
        rows.append((stage, documents, chars, inside, inside - documents))
        inside -= documents
    rows.append(("kept", *last, inside, inside))
    return spark.createDataFrame(rows, STATS_SCHEMA)
