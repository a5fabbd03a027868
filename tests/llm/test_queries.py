"""The numbered queries on the smallest tables: SQL where there is some, else their contract."""

import hashlib

import __spark_entry__ as entry
import pytest
from compare import differences, duck

from winnow.llm.queries import LLM_ORACLE, LLM_QUERIES

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert {int(n[2:].split("_")[0]) for n in LLM_QUERIES} == set(range(1, 14))
    assert set(LLM_QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(LLM_ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_against_sql(spark, name):
    assert differences(LLM_QUERIES[name](spark, SF), duck(SF), LLM_ORACLE[name]) == ""


CONTRACTS = {
    "op1_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op7_imatch": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                   "near_edited", "near_next"],
    "op8_quality": ["doc_id", "held_out", "score", "predicted"],
}


@pytest.mark.parametrize("name", sorted(CONTRACTS))
def test_one_row_for_each_document(spark, name):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = LLM_QUERIES[name](spark, SF)
    assert found.columns[: len(CONTRACTS[name])] == CONTRACTS[name]
    rows = {r.doc_id: r for r in found.collect()}
    assert set(rows) == set(texts) and found.count() == len(texts)
    for doc, text in texts.items():
        if name == "op1_bpe":
            assert rows[doc].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        if name == "op7_imatch":
            assert rows[doc].n_chars == len(text)


def test_pages_have_one_text_each(spark):
    found = LLM_QUERIES["op10_html_crf"](spark, SF)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    rows = found.collect()
    assert len(rows) == spark.read.parquet(f"{SF}/pages.parquet").count()
    assert all(r.n_chars == len(r.text) and "<" not in r.text[:1] for r in rows)
    assert sum(r.n_chars > 0 for r in rows) == len(rows)
