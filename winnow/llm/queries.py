"""The numbered queries: each applies its operator to the whole table it is meant for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import public_tokenizers

from winnow.llm import (
    bpe,
    fingerprint,
    html_crf,
    lemp,
    minhash_bayes,
    mtree,
    ngram_join,
    packing,
    periodic_runs,
    quality,
    sharding,
    substring_dedup,
    suffix_dedup,
)
from winnow.functions.text import let
from winnow.llm.oracle import LLM_ORACLE
from winnow.sources.tables import read_table

__all__ = ["LLM_ORACLE", "LLM_QUERIES", "packed", "taught"]

RANKS = "byte_bpe_50k.tiktoken"
VOCABULARY = "byte_bpe_50k.json"


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path(RANKS)
    docs = read_table(spark, sf_dir, "documents")
    short, long = bpe.encode_parts(docs, ranks, public_tokenizers.PATTERN)
    return bpe.digests(bpe.decode(short, ranks), bpe.decode(long, ranks))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "utf-8"), 256).alias("kept_sha256")
    )


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(read_table(spark, sf_dir, "documents"))


def op5_mtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [f"shard-{i:03d}" for i in range(sharding.SHARDS)]
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    return sharding.place(docs, "doc_id", sharding.lookup_table(spark, names))


def op7_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(read_table(spark, sf_dir, "documents"))


def taught(labels: DataFrame) -> DataFrame:
    """(doc_id, label) of the rows that teach: held-out ones do not."""
    return labels.where(~quality.held_out()).select("doc_id", F.col("quality").alias("label"))


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted); held-out rows of `labels` teach nothing."""
    return quality.classify(docs, taught(labels)).select(
        "doc_id",
        quality.held_out().alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def packed(
    docs: DataFrame, keep_ids: bool = False, after_read: Callable[[], None] | None = None
) -> DataFrame:
    cut = packing.tokenised(
        docs,
        public_tokenizers.path(RANKS),
        public_tokenizers.path(VOCABULARY),
        public_tokenizers.PATTERN,
        keep_ids=keep_ids,
    )
    pieces = packing.pack(cut, after_read=after_read)
    return pieces if keep_ids else pieces.drop("ids")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(read_table(spark, sf_dir, "documents"))


def op10_html_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    texts = html_crf.extract(pages, html_crf.train(pages))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


def op11_lemp_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return lemp.hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


def op12_minhash_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_bayes.near_duplicates(read_table(spark, sf_dir, "documents"))


def planted(docs: DataFrame) -> DataFrame:
    """`docs` in which a tenth of the texts, by their ids, end in a period of their own words."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))

    def repeated(w):
        n = F.size(w).cast("long")
        cut = F.struct((g % n).alias("a"), (1 + F.floor((n - g % n) / (3 + g % 8))).alias("p"))
        source = lambda c, i: F.when(i < c["a"], i).otherwise(c["a"] + (i - c["a"]) % c["p"])
        return let(cut, lambda c: F.transform(w, lambda _, i: F.get(w, source(c, i).cast("int"))))

    chosen = (h % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]")
    edited = F.when(chosen, F.array_join(let(words, repeated), " "))
    return docs.select("doc_id", F.coalesce(edited, "text").alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.collapse_runs(planted(read_table(spark, sf_dir, "documents")))
    # Greatest length, then smallest start and period.
    key = lambda r: F.struct((-r["length"]).alias("a"), r["start"].alias("b"), r["period"].alias("c"))
    best = F.array_min(F.transform("runs", key))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return (
        found.withColumn("_best", best)
        .withColumn("length", -F.col("_best.a"))
        .withColumn("period", F.col("_best.c"))
        .select(
            "doc_id",
            F.size("runs").cast("long").alias("n_runs"),
            F.col("_best.b").alias("start"),
            "length",
            "period",
            F.expr("length * 1000 div period").alias("exponent_milli"),
            F.sha2(F.encode(lines, "utf-8"), 256).alias("runs_sha256"),
            F.sha2(F.encode("kept", "utf-8"), 256).alias("collapsed_sha256"),
        )
    )


LLM_QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_ngram_join": op4_ngram_join,
    "op5_mtree": op5_mtree,
    "op6_sharding": op6_sharding,
    "op7_imatch": op7_imatch,
    "op8_quality": op8_quality,
    "op9_packing": op9_packing,
    "op10_html_crf": op10_html_crf,
    "op11_lemp_negatives": op11_lemp_negatives,
    "op12_minhash_bayes": op12_minhash_bayes,
    "op13_periodic_runs": op13_periodic_runs,
}
