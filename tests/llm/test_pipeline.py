import re
from pathlib import Path

import pytest

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    from winnow.llm import ngram_join
    from winnow.session import materialize

    documents = spark.read.parquet(f"{SF}/documents.parquet")
    frames = [documents]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(materialize(stage(spark, frames[-1], SF), "stage"))
    assert all(f.schema.names == documents.columns for f in frames[:-1])
    ids = [{r.doc_id for r in f.select("doc_id").collect()} for f in frames]
    assert ids[0] > ids[1] > ids[2] >= ids[3] == ids[4]
    # One document of each group of the third frame's input stays, and no group goes.
    groups = {r.doc_id: r.component_id for r in ngram_join.join(frames[1], 5, 80).collect()}
    assert ids[2] == set(groups.values())
    windows = set()
    for r in frames[3].orderBy("doc_id").collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text)
        assert r.n_chars == len(r.text) and words
        own = {tuple(words[i : i + 20]) for i in range(len(words) - 19)}
        windows |= own
    pieces = frames[4].collect()
    assert sum(r.length for r in pieces if r.start == 0) > 0
    assert {r.doc_id for r in pieces} == ids[3]
    ran = corpus_pipeline.run(spark, SF)
    columns = ("doc_id", "start", "length", "ids_crc32", "doc_tokens")
    assert sorted(ran.select(*columns).collect()) == sorted(frames[4].select(*columns).collect())


def test_awkward_documents(spark, docs):
    import corpus_pipeline

    rows = docs.drop("spans", "kept", "slot", "_slice")
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, rows, SF)
        assert rows.count() > 0
    rows = docs.drop("spans", "kept", "slot", "_slice").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, rows, SF)
        assert rows.count() == 0


def test_rows_are_told_apart_without_ids(spark):
    """Of rows with one id, or with none, each keeps or loses its own text."""
    import corpus_pipeline

    passage, others = " ".join(f"p{i}" for i in range(30)), [" ".join(f"{c}{i}" for i in range(40)) for c in "abcde"]
    texts = [f"{passage} {t}" for t in others]
    rows = [(i, t, "en", "src", len(t)) for i, t in zip((3, 7, 7, None, None), texts, strict=True)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    cut = [(r.doc_id, r.text, r.n_chars) for r in corpus_pipeline.cut_passages(spark, frame, SF).collect()]
    wanted = [(i, t, len(t)) for i, t in zip((3, 7, 7, None, None), [texts[0], *others[1:]], strict=True)]
    assert sorted(cut, key=str) == sorted(wanted, key=str)
    twice = frame.unionByName(frame.selectExpr("CAST(NULL AS long) doc_id", "text || ' end' text", "lang", "source", "n_chars"))
    left = corpus_pipeline.one_of_each(spark, twice, SF).collect()
    assert sorted((str(r.doc_id), r.text.split()[30][0]) for r in left if r.doc_id is not None) == [("3", "a"), ("7", "b"), ("7", "c")]
    assert sorted(r.text.split()[30][0] for r in left) == list("abcde")


def test_packing_leaves_one_copy_of_its_pieces(spark):
    """The rows of the stage before and the unordered pieces go before the result is written."""
    import corpus_pipeline
    from winnow.session import materialize, scratch_root

    folder = Path(re.sub("^file:(//)?", "", scratch_root(spark))) / "winnow"
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    before = {p.name for p in folder.glob("*")}
    cut = materialize(corpus_pipeline.cut_passages(spark, docs, SF), "stage")
    pieces = corpus_pipeline.pack_sequences(spark, cut, SF)
    left = [p.name.rpartition("-")[0] for p in folder.iterdir() if p.name not in before]
    assert "ranked" in left and not {"passage-rows", "tokenised"} & set(left)
    assert {r.doc_id for r in pieces.collect()} == {r.doc_id for r in cut.collect()}


def test_texts_are_cut_before_they_are_joined_again(spark, docs):
    """The result reads two written tables; what finds the passages is done with, and goes next."""
    import corpus_pipeline

    cut = corpus_pipeline.cut_passages(spark, docs.drop("spans", "kept", "slot", "_slice"), SF)
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and "MapInArrow" not in plan
    own = [Path(re.sub("^file:(//)?", "", p)) for p in corpus_pipeline._rows_of_last]
    assert [p.name.rpartition("-")[0] for p in own] == ["passage-rows", "cut-texts"]
    corpus_pipeline.pack_sequences(spark, cut, SF)
    assert corpus_pipeline._rows_of_last == [] and not any(p.exists() for p in own)


def test_sequences_can_be_built_from_the_result(spark):
    import zlib

    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    windows = {}
    for r in corpus_pipeline.pack_sequences(spark, docs, SF).collect():
        assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32
        windows.setdefault(r.sequence_id, []).append((r.offset, r.ids))
    for parts in windows.values():
        filled = 0
        for offset, ids in sorted(parts):
            assert offset == filled
            filled += len(ids) // 4
        assert filled <= 1024
