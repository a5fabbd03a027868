"""The plan from pages to a published corpus, and who owns intermediate tables."""

import os
import subprocess
import sys
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from winnow.operators import dedup
from winnow.plans import publish, queries as q, refine
from winnow.session import materialize, scratch_owned, scratch_root

SF = "/root/testdata/sf0.001"
AT = datetime(2024, 10, 9, 21)


def tables(spark):
    folder = f"{scratch_root(spark).removeprefix('file:')}/winnow"
    return set(os.listdir(folder)) if os.path.exists(folder) else set()


def test_observed_numbers_are_those_of_the_grouped_form(spark, tmp_path):
    profiles = q.profiles(spark, SF)
    pages = q.pages(spark, SF)
    copies = pages.select((F.col("id") + 100_000).alias("id"), "url", "html")
    awkward = spark.createDataFrame(
        [(None, None, None), (200_000, "http://x.org", None), (200_001, None, "")],
        "id bigint, url string, html string",
    )
    both = pages.select("id", "url", "html").unionByName(copies).unionByName(awkward)
    before = tables(spark)
    done = publish.publish_corpus(both, profiles, str(tmp_path), "corpus", AT)
    assert tables(spark) == before
    stats = {r.stage: r for r in done.stats.collect()}
    refined = refine.refine(both, profiles)
    for row in refine.stage_stats(refined).collect():
        if row.stage != "kept":
            assert stats[row.stage] == row
    kept = refine.kept(refined)
    expected = dedup.minhash_dedup(kept)
    ids = {r.id for r in expected.select("id").collect()}
    corpus = spark.read.parquet(done.path)
    assert {r.id for r in corpus.select("id").collect()} == ids
    assert stats["kept"].documents == len(ids) == corpus.count()
    assert stats["7_duplicates"].documents == kept.count() - len(ids) > 0
    assert stats["1_url"].documents_in == both.count()
    assert corpus.columns.count("split") == 1 and "token_count" in corpus.columns
    dropped = spark.read.schema("id bigint").json(f"{done.removed}/removed").count()
    foreign = spark.read.schema("id bigint").json(f"{done.removed}/2_non_english").count()
    assert dropped + foreign == both.count() - kept.count()


def test_no_pages(spark, tmp_path):
    profiles = q.profiles(spark, SF)
    none = q.pages(spark, SF).where("id < -1")
    done = publish.publish_corpus(none, profiles, str(tmp_path), "corpus", AT)
    assert [(r.documents, r.chars, r.documents_in) for r in done.stats.collect()] == [(0, 0, 0)] * 8


def test_owned_tables_go_also_after_a_failure(spark):
    before = tables(spark)
    try:
        with scratch_owned(spark):
            assert materialize(spark.range(5), "owned").count() == 5
            assert len(tables(spark) - before) == 1
            raise ValueError("stop")
    except ValueError:
        pass
    assert tables(spark) == before
    kept = materialize(spark.range(5), "kept")
    assert kept.count() == 5 and len(tables(spark) - before) == 1


@pytest.mark.parametrize("missing", ["winnow.llm.queries", "public_tokenizers", "corpus_pipeline"])
def test_entry_without_the_removable_part(missing):
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; print(*e.queries())"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shown = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True)
    assert set(shown.stdout.split()) == set(q.QUERIES)
    if missing != "public_tokenizers":  # the part itself may be gone, which is no fault
        assert "without the training-data" not in shown.stderr
