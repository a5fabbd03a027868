"""Every operator bound to the driver's tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from winnow.operators import (
    audit,
    commits,
    dedup,
    extract,
    language,
    pii,
    quality,
    scores,
    sequences,
    url,
)
from winnow.operators.skew import lookup
from winnow.plans import publish, refine
from winnow.session import materialize, read_back, scratch_path
from winnow.sources import files, warc
from winnow.sources.tables import read_table, spread
from winnow.streaming import chunks, commits as commit_streams, refine as refine_streams, runner


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spread(read_table(spark, sf, "documents").select("doc_id", "text"), "doc_id")


def gopher_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.gopher_quality(documents(spark, sf)).select("doc_id", "keep", "drop_reason")


def gopher_repetition(spark: SparkSession, sf: str) -> DataFrame:
    return quality.gopher_repetition(documents(spark, sf)).select("doc_id", "keep", "drop_reason")


def c4_quality(spark: SparkSession, sf: str) -> DataFrame:
    judged = quality.c4_quality(documents(spark, sf))
    return judged.select("doc_id", F.md5("text").alias("text_md5"), "keep", "drop_reason")


def fineweb_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.fineweb_quality(documents(spark, sf)).select("doc_id", "keep", "drop_reason")


# The two spam hosts of the page table and two words that name such sites.
BLOCKED_DOMAINS = ["cheap-pills.example.com", "casino-win.example.org"]
BLOCKED_WORDS = ["casino", "pills"]


def pages(spark: SparkSession, sf: str) -> DataFrame:
    table = read_table(spark, sf, "pages")
    return spread(table.select(F.col("page_id").alias("id"), "url", "html"), "id")


def profiles(spark: SparkSession, sf: str) -> language.Profiles:
    docs = spread(read_table(spark, sf, "documents").select("doc_id", "text", "lang"), "doc_id")
    return language.Profiles(language.train_profiles(docs))


def url_filter(spark: SparkSession, sf: str) -> DataFrame:
    table = read_table(spark, sf, "pages").select("page_id", "url")
    judged = url.url_filter(table, BLOCKED_DOMAINS, BLOCKED_WORDS)
    return judged.select("page_id", "keep", "drop_reason")


def url_filter_table(spark: SparkSession, sf: str) -> DataFrame:
    """The same with the blocklist as a table, as long ones come."""
    blocklist = spark.createDataFrame([(d,) for d in BLOCKED_DOMAINS], "domain string")
    table = read_table(spark, sf, "pages").select("page_id", "url")
    judged = url.url_filter(table, blocklist, BLOCKED_WORDS)
    return judged.select("page_id", "keep", "drop_reason")


def extract_main_text(spark: SparkSession, sf: str) -> DataFrame:
    return extract.extract_main_text(pages(spark, sf)).select(F.col("id").alias("page_id"), "text")


def language_filter(spark: SparkSession, sf: str) -> DataFrame:
    judged = language.language_filter(documents(spark, sf), profiles(spark, sf))
    score = F.round("language_score", 4).alias("language_score")
    return judged.select("doc_id", "language", score, "keep", "drop_reason")


def language_filter_joined(spark: SparkSession, sf: str) -> DataFrame:
    """The same with a table too large for every task."""
    large = language.Profiles(profiles(spark, sf).counts, local_bytes=0)
    judged = language.language_filter(documents(spark, sf), large)
    score = F.round("language_score", 4).alias("language_score")
    return judged.select("doc_id", "language", score, "keep", "drop_reason")


def refined_pages(spark: SparkSession, sf: str) -> DataFrame:
    settings = refine.RefineSettings(domains=BLOCKED_DOMAINS, words=BLOCKED_WORDS)
    return refine.refine(pages(spark, sf), profiles(spark, sf), settings)


def refine_corpus(spark: SparkSession, sf: str) -> DataFrame:
    return refined_pages(spark, sf).select(
        F.col("id").alias("page_id"), F.md5("text").alias("text_md5"), "language", "drop_stage",
        "drop_reason",
    )


def stage_stats(spark: SparkSession, sf: str) -> DataFrame:
    return refine.stage_stats(refined_pages(spark, sf))


def pii_mask(spark: SparkSession, sf: str) -> DataFrame:
    return pii.pii_mask(documents(spark, sf)).select("doc_id", "text")


def token_count(spark: SparkSession, sf: str) -> DataFrame:
    return pii.token_count(documents(spark, sf)).select("doc_id", "token_count")


def token_totals(spark: SparkSession, sf: str) -> DataFrame:
    return pii.token_totals(pii.token_count(documents(spark, sf)))


def shingles(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.shingles(documents(spark, sf), "doc_id")


def signatures(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.minhash_signature(documents(spark, sf), "doc_id")


def minhash_signature(spark: SparkSession, sf: str) -> DataFrame:
    return signatures(spark, sf).select("doc_id", F.concat_ws(",", "sig").alias("sig"))


def lsh_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.lsh_candidates(signatures(spark, sf), "doc_id")


def dedup_clusters(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.text_clusters(documents(spark, sf), "doc_id")


def dedup_cluster_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.dedup_cluster_sizes(dedup_clusters(spark, sf))


def minhash_dedup(spark: SparkSession, sf: str) -> DataFrame:
    kept = dedup.minhash_dedup(documents(spark, sf), "doc_id")
    return kept.select("doc_id", F.md5("text").alias("text_md5"))


# --- audit -----------------------------------------------------------------


def html_text(spark: SparkSession, sf: str) -> DataFrame:
    return pages(spark, sf).select("id", F.col("html").alias("text"))


def extracted_text(spark: SparkSession, sf: str) -> DataFrame:
    return extract.extract_main_text(pages(spark, sf)).select("id", "text")


def sample_rows(spark: SparkSession, sf: str) -> DataFrame:
    return audit.sample_rows(documents(spark, sf), 30, 7, "doc_id").select("doc_id")


def sample_rows_by_source(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select("doc_id", "source")
    return audit.sample_rows(docs, 5, 7, "doc_id", by="source")


def lookup_sources(spark: SparkSession, sf: str) -> DataFrame:
    raw = html_text(spark, sf)
    found = audit.lookup_sources(audit.sample_rows(raw, 30, 7), raw)
    return found.select(F.col("id").alias("page_id"), F.md5("text").alias("text_md5"))


def content_words(spark: SparkSession, sf: str) -> DataFrame:
    words = audit.content_words(F.col("text"))
    return documents(spark, sf).select("doc_id", F.array_join(words, " ").alias("words"))


def word_overlap(spark: SparkSession, sf: str) -> DataFrame:
    pairs = pages(spark, sf).select(
        "id", F.col("html").alias("original"), extract.main_text(F.col("html")).alias("refined")
    )
    scored = audit.word_overlap(pairs)
    return scored.select(F.col("id").alias("page_id"), F.round("similarity", 6).alias("similarity"))


def audit_corpus(spark: SparkSession, sf: str) -> DataFrame:
    # The main text of the sampled pages alone is extracted.
    sampled = audit.sample_rows(pages(spark, sf), 30, 7)
    refined = extract.extract_main_text(sampled).select("id", "text")
    scored = audit.audit_corpus(refined, html_text(spark, sf), 30, 7)
    return scored.withColumnRenamed("id", "page_id")


def submitted_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Each page as submitted by one or two of 20 uids."""
    uids = F.array_distinct(F.array(F.col("id") % 20, (F.col("id") * 7 + 3) % 20))
    return pages(spark, sf).select(F.explode(uids).alias("uid"), "id", "html")


def audit_samples(spark: SparkSession, sf: str) -> DataFrame:
    """Samples of all submissions; every third uid handed in its texts backwards."""
    submitted = submitted_pages(spark, sf)
    picked = audit.sampled_ids(submitted, ["uid"], 30, 7)
    sampled = submitted.join(picked, ["uid", "id"], "left_semi")
    refined = extract.extract_main_text(sampled).select(
        "uid", "id", F.when(F.col("uid") % 3 == 0, F.reverse("text")).otherwise(F.col("text")).alias("text")
    )
    scored = audit.audit_samples(picked, refined, html_text(spark, sf), ["uid"])
    return scored.withColumnRenamed("id", "page_id")


def audit_submissions(spark: SparkSession, sf: str) -> DataFrame:
    """From samples to gates; a uid that has a task, here each nation, and no samples gets 0."""
    tasks = read_table(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("uid"))
    return audit.similarity_gate(audit_samples(spark, sf), tasks, ["uid"])


def events(spark: SparkSession, sf: str) -> DataFrame:
    """Events as submissions: uid, block of 12 seconds, commit, score in 0..1."""
    return event_columns(read_table(spark, sf, "events"))


def event_columns(table: DataFrame) -> DataFrame:
    seconds = F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts"))
    cents = F.round(F.col("value") * 100).cast("long")
    return table.select(
        "event_id",
        F.col("user_id").alias("uid"),
        "event_type",
        F.floor(seconds / 12).alias("block"),
        cents.alias("cents"),
        F.concat(F.lit("c"), F.get_json_object("props", "$.k")).alias("commit"),
        (cents % 1000 / 1000).alias("score"),
    )


def members(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "customer").select(
        F.col("c_nationkey").alias("netuid"),
        F.col("c_custkey").alias("uid"),
        F.col("c_acctbal").alias("stake"),
    )


def similarities(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).select("uid", (F.col("cents") % 4000 / 100 + 60).alias("similarity"))


def similarity_gate(spark: SparkSession, sf: str) -> DataFrame:
    return audit.similarity_gate(similarities(spark, sf), members(spark, sf), ["uid"])


def eval_lines(spark: SparkSession, sf: str) -> DataFrame:
    """A log text per event: mostly the wanted metric, some lines of other shapes."""
    value, stderr = F.col("cents") % 10000, F.col("cents") % 1000
    metric = F.when(F.col("event_type") == "click", "other_metric").otherwise("truthfulqa_mc2")
    short = F.when(F.col("event_type") == "error", F.lit("|0.41|")).otherwise(
        F.concat(F.lit("|0."), F.lpad(value.cast("string"), 4, "0"), F.lit("|"))
    )
    row = F.concat(
        F.lit("|   "), metric, F.lit("  "), short, F.lit(" ± |0.0"),
        F.lpad(stderr.cast("string"), 3, "0"), F.lit("|"),
    )
    return events(spark, sf).select(
        F.col("uid").alias("run_id"), "event_id",
        F.concat(F.lit("|Task|Value|\n"), row, F.lit("\n"), row).alias("line"),
    )


def parse_eval_log(spark: SparkSession, sf: str) -> DataFrame:
    return audit.parse_eval_log(eval_lines(spark, sf))


def eval_summary(spark: SparkSession, sf: str) -> DataFrame:
    other = events(spark, sf).where("event_type = 'click'").select(
        F.col("uid").alias("run_id"), F.lit("other_metric").alias("metric"),
        F.lit(1.0).alias("value"), F.lit(0.5).alias("stderr"),
    )
    rows = audit.parse_eval_log(eval_lines(spark, sf).drop("event_id")).unionByName(other)
    means = audit.eval_summary(rows)
    return means.select(
        "run_id", F.round("value", 12).alias("value"), F.round("stderr", 12).alias("stderr")
    )


def corpus_quality_eval(spark: SparkSession, sf: str) -> DataFrame:
    labels = read_table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    labelled = documents(spark, sf).join(labels, "doc_id")
    scored = audit.corpus_quality_eval(labelled, id="doc_id")
    return scored.select(F.round("value", 8).alias("value"), F.round("stderr", 8).alias("stderr"))


def tasks(spark: SparkSession, sf: str) -> DataFrame:
    """The first block at which a uid shows a purchase, as its task request."""
    return (
        events(spark, sf)
        .where("event_type = 'purchase'")
        .groupBy("uid")
        .agg(F.min("event_id").alias("task_id"), F.min("block").alias("request_block"))
    )


def submissions(spark: SparkSession, sf: str) -> DataFrame:
    commits = events(spark, sf).withColumnRenamed("block", "commit_block")
    return audit.elapsed_time(commits, tasks(spark, sf))


def elapsed_time(spark: SparkSession, sf: str) -> DataFrame:
    return submissions(spark, sf).select("event_id", "uid", "task_id", "elapsed")


def submission_score(spark: SparkSession, sf: str) -> DataFrame:
    gates = audit.similarity_gate(similarities(spark, sf), members(spark, sf), ["uid"])
    judged = lookup(submissions(spark, sf), gates, ["uid"]).select(
        "event_id", "uid", "gate", F.col("score").alias("value"),
        (F.col("cents") % 100 / 1000).alias("stderr"), "elapsed",
    )
    scored = audit.submission_score(judged)
    return scored.select("event_id", "uid", F.round("score", 8).alias("score"))


# --- commits and scores ----------------------------------------------------


def commit_key(spark: SparkSession, sf: str) -> DataFrame:
    key = F.concat(
        F.lit("u/r"), F.col("uid").cast("string"), F.lit(":"), F.md5(F.col("commit")),
        F.when(F.col("event_type") == "error", F.lit(":x")).otherwise(F.lit("")),
    )
    parsed = events(spark, sf).select("event_id", commits.commit_key(key).alias("k"))
    return parsed.select("event_id", "k.url", "k.hash")


def pair_hash(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "events").select(
        "event_id", commits.pair_hash(F.col("event_type"), F.col("props")).alias("hash")
    )


def eligible_submitters(spark: SparkSession, sf: str) -> DataFrame:
    kept = commits.eligible_submitters(events(spark, sf), members(spark, sf))
    return kept.select("event_id", "uid")


def observations(spark: SparkSession, sf: str) -> DataFrame:
    """Events as polls of the current commit, committed up to 9000 blocks before."""
    return observed_columns(events(spark, sf))


def observed_columns(table: DataFrame) -> DataFrame:
    return table.select(
        "event_id", "uid", "commit", F.col("block").alias("seen_block"),
        (F.col("block") - F.col("event_id") * 37 % 9000).alias("commit_block"),
    )


def late_commits(spark: SparkSession, sf: str) -> DataFrame:
    return commits.late_commits(observations(spark, sf)).select("event_id", "late")


def recent_commits(spark: SparkSession, sf: str) -> DataFrame:
    """The age rule on a stream, with a watermark on the time at which a commit is seen."""
    polled = observed_columns(event_stream(spark, sf))
    timed = polled.withColumn("ts", F.timestamp_seconds(F.col("seen_block") * 12))
    path = runner.run_available(commit_streams.recent_commits(timed), scratch_path(spark, "recent"))
    return read_back(spark, f"{path}/rows", timed.schema).select("event_id", "uid", "commit")


def new_commits(spark: SparkSession, sf: str) -> DataFrame:
    return commits.new_commits(observations(spark, sf))


def stale_decay(spark: SparkSession, sf: str) -> DataFrame:
    return commits.stale_decay(observations(spark, sf))


def score_events(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).select(
        "uid", F.col("block").alias("step"), F.col("event_id").alias("tie"), "score"
    )


def ema_score(spark: SparkSession, sf: str) -> DataFrame:
    scored = scores.ema_score(score_events(spark, sf))
    return scored.select("uid", F.round("score", 8).alias("score"))


def latest_score(spark: SparkSession, sf: str) -> DataFrame:
    log = score_events(spark, sf).withColumn(
        "score", F.when(F.col("tie") % 3 != 0, F.col("score"))
    )
    return scores.latest_score(log, "tie")


def dense_scores(spark: SparkSession, sf: str) -> DataFrame:
    latest = scores.latest_score(score_events(spark, sf), "tie")
    return scores.dense_scores(members(spark, sf), latest).select("netuid", "uid", "score")


GROUP = ["netuid", "epoch"]


def yearly_scores(spark: SparkSession, sf: str) -> DataFrame:
    """A skewed score per customer and year, grouped by nation and year."""
    orders = read_table(spark, sf, "orders").select(
        F.col("o_custkey").alias("uid"), F.year("o_orderdate").alias("epoch"), "o_totalprice"
    )
    best = orders.groupBy("uid", "epoch").agg(F.max("o_totalprice").alias("price"))
    score = F.round(F.pow(F.greatest(F.col("price") - 100000, F.lit(0.0)) / 100000, F.lit(4)), 4)
    joined = best.join(members(spark, sf).drop("stake"), "uid")
    return joined.select("netuid", "epoch", "uid", score.alias("score"))


def yearly_weights(spark: SparkSession, sf: str) -> tuple[DataFrame, int]:
    """Weights, written down, and their number."""
    weights = scores.l1_weights(yearly_scores(spark, sf), GROUP).drop("score")
    weights = materialize(weights, "weights")
    return weights, weights.count()


def _rounded(df: DataFrame) -> DataFrame:
    return df.select("netuid", "epoch", "uid", F.round("weight", 8).alias("weight"))


def l1_weights(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(scores.l1_weights(yearly_scores(spark, sf), GROUP))


def capped_weights(spark: SparkSession, sf: str) -> DataFrame:
    weights, size = yearly_weights(spark, sf)
    return _rounded(scores.capped_weights(weights, 0.05, GROUP, size))


def process_weights(spark: SparkSession, sf: str) -> DataFrame:
    weights, size = yearly_weights(spark, sf)
    return _rounded(scores.process_weights(weights, 8, 0.05, GROUP, 6553, size))


def process_weights_all(spark: SparkSession, sf: str) -> DataFrame:
    """The default: no quantile is left out; here with many members required."""
    weights, size = yearly_weights(spark, sf)
    return _rounded(scores.process_weights(weights, 25, 0.1, GROUP, at_most=size))


def emit_weights(spark: SparkSession, sf: str) -> DataFrame:
    weights, size = yearly_weights(spark, sf)
    return scores.emit_weights(weights, GROUP, size)


def weight_epochs(spark: SparkSession, sf: str) -> DataFrame:
    return scores.weight_epochs(score_events(spark, sf))


def weight_intervals(spark: SparkSession, sf: str) -> DataFrame:
    return scores.weight_intervals(score_events(spark, sf))


def epoch_norms(spark: SparkSession, sf: str) -> DataFrame:
    norms = scores.epoch_norms(scores.weight_intervals(score_events(spark, sf)))
    return norms.withColumn("norm", F.round("norm", 6))


# --- training sequences ----------------------------------------------------


def packed(spark: SparkSession, sf: str) -> DataFrame:
    return sequences.pack_sequences(documents(spark, sf), id="doc_id")


def pack_sequences(spark: SparkSession, sf: str) -> DataFrame:
    return packed(spark, sf).select(
        "block", F.size("tokens").alias("n"), F.md5(F.array_join("tokens", " ")).alias("tokens_md5")
    )


def token_budget(spark: SparkSession, sf: str) -> DataFrame:
    return sequences.token_budget(sequences.block_count(documents(spark, sf)))


def weighted_mix(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select(F.col("doc_id").alias("id"))
    turns = read_table(spark, sf, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id")
    )
    mixed = sequences.weighted_mix(
        {"documents": docs, "conversations": turns},
        {"documents": 0.3, "conversations": 0.7},
        docs.count(),
        seed=7,
    )
    return mixed.select("source", "id", "copy")


def batch_plan(spark: SparkSession, sf: str) -> DataFrame:
    return sequences.batch_plan(sequences.block_count(documents(spark, sf)))


def data_stages(spark: SparkSession, sf: str) -> DataFrame:
    plan = sequences.batch_plan(sequences.block_count(documents(spark, sf)))
    return sequences.data_stages(plan, done=4)


# --- sources and sinks -----------------------------------------------------


def read_warc(spark: SparkSession, sf: str) -> DataFrame:
    """The page table as gzip crawl archives, written by Spark and read back."""
    crlf = "\r\n"
    payload = F.concat(
        F.lit(f"HTTP/1.1 200 OK{crlf}Content-Type: text/html{crlf}{crlf}"), F.col("html")
    )
    record = F.concat(
        F.lit(f"WARC/1.0{crlf}WARC-Type: response{crlf}WARC-Record-ID: <urn:page:"),
        F.col("id").cast("string"),
        F.lit(f">{crlf}WARC-Date: 2024-10-09T21:13:35Z{crlf}WARC-Target-URI: "),
        F.col("url"),
        F.lit(f"{crlf}Content-Length: "),
        F.octet_length(payload).cast("string"),
        F.lit(f"{crlf}{crlf}"),
        payload,
        F.lit(f"{crlf}"),
    )
    path = scratch_path(spark, "archives")
    pages(spark, sf).select(record).write.option("compression", "gzip").option(
        "lineSep", crlf
    ).text(path)
    archives = spark.read.text(path).inputFiles()
    return warc.read_warc(spark, archives).select(
        "id", "url", F.unix_seconds("date").alias("date_seconds"), F.md5("html").alias("html_md5")
    )


def read_jsonl(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "jsonl")
    files.write_jsonl(read_table(spark, sf, "conversations"), path)
    return files.read_jsonl(spark, path, "conv_id bigint, turn bigint, role string, text string")


def write_jsonl(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "jsonl")
    docs = read_table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("id"), "text", F.col("lang").alias("language"),
        F.create_map(F.lit("source"), F.col("source")).alias("metadata"),
    )
    files.write_jsonl(docs, path)
    back = files.read_jsonl(spark, path)
    return back.select(
        "id", "language", F.md5("text").alias("text_md5"), F.col("metadata")["source"].alias("source")
    )


def write_removed(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "removed")
    files.write_removed(materialize(refined_pages(spark, sf), "refined"), path)
    schema = "id bigint, drop_reason string"
    by_stage = spark.read.schema(f"{schema}, drop_stage string").json(f"{path}/removed")
    by_language = spark.read.schema(f"{schema}, language string").json(f"{path}/2_non_english")
    nothing = F.lit(None).cast("string")
    merged = by_stage.withColumn("language", nothing).unionByName(
        by_language.withColumn("drop_stage", nothing)
    )
    return merged.withColumnRenamed("id", "page_id")


def publish_dataset(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select("doc_id", "text", "source")
    extra = read_table(spark, sf, "benchmark").select((-F.col("item_id") - 1).alias("doc_id"), "text")
    path = files.publish_dataset(
        [docs, extra], scratch_path(spark, "published"), "corpus", datetime(2024, 10, 9, 21)
    )
    published = spark.read.parquet(path)
    return published.select("doc_id", F.md5("text").alias("text_md5"), "source", "split")


def published_corpus(spark: SparkSession, sf: str) -> publish.Published:
    settings = refine.RefineSettings(domains=BLOCKED_DOMAINS, words=BLOCKED_WORDS)
    return publish.publish_corpus(
        pages(spark, sf), profiles(spark, sf), scratch_path(spark, "published"), "corpus",
        datetime(2024, 10, 9, 21), settings,
    )


def publish_corpus(spark: SparkSession, sf: str) -> DataFrame:
    """From pages to the published corpus, read back."""
    return spark.read.parquet(published_corpus(spark, sf).path).select(
        F.col("id").alias("page_id"), "language", "token_count", F.md5("text").alias("text_md5"),
        "split",
    )


def publish_stats(spark: SparkSession, sf: str) -> DataFrame:
    """What each stage dropped, as observed while publishing."""
    return published_corpus(spark, sf).stats


def report_scores(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "reports")
    rows = score_events(spark, sf).select(F.col("tie").alias("task_id"), "uid", "score")
    for batch_id, part in enumerate((rows.where("uid < 50"), rows.where("uid >= 50"))):
        files.report_scores(part, path, batch_id)
        files.report_scores(part, path, batch_id)  # a repeated batch adds nothing
    return spark.read.parquet(f"{path}/reports").select("task_id", "score")


# --- streaming -------------------------------------------------------------


def table_stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table as it arrives, whether it is one file or a folder of files."""
    schema = read_table(spark, sf, name).schema
    return runner.file_stream(spark, f"{sf}/{name}.parque[t]", schema, "*")


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    return event_columns(table_stream(spark, sf, "events"))


def commit_stream(spark: SparkSession, sf: str) -> DataFrame:
    polled = observed_columns(event_stream(spark, sf))
    path = runner.run_available(commit_streams.commit_stream(polled), scratch_path(spark, "commits"))
    return spark.read.parquet(f"{path}/rows").select("uid", "kind", "commit", "block")


def evaluations(spark: SparkSession, sf: str) -> DataFrame:
    """(uid, commit, value, stderr): what the evaluation of each uploaded corpus found."""
    return events(spark, sf).groupBy("uid", "commit").agg(
        F.max("score").alias("value"), F.max(F.col("cents") % 100 / 1000).alias("stderr")
    )


def gated_tasks(spark: SparkSession, sf: str) -> DataFrame:
    gates = audit.similarity_gate(similarities(spark, sf), members(spark, sf), ["uid"])
    return materialize(tasks(spark, sf).join(gates, "uid"), "tasks")


def score_log(spark: SparkSession, sf: str, path: str) -> None:
    """The score loop over all polls: log and reports under `path`."""
    looped = commit_streams.score_stream(
        observed_columns(event_stream(spark, sf)),
        gated_tasks(spark, sf),
        materialize(evaluations(spark, sf), "evaluations"),
    )
    runner.run_available(looped, path, commit_streams.report_batches(path))


def score_stream(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "scores")
    score_log(spark, sf, path)
    log = spark.read.parquet(f"{path}/totals")
    return log.select(
        "uid", "seq", "block", "kind", "task_id",
        F.round("score", 8).alias("score"), F.round("total", 8).alias("total"),
    )


def score_restart(spark: SparkSession, sf: str) -> DataFrame:
    """What a new loop starts from: the last total of every uid in the log of an earlier one."""
    path = scratch_path(spark, "scores")
    score_log(spark, sf, path)
    log = spark.read.parquet(f"{path}/totals")
    last = scores.latest_score(log.select("uid", F.col("seq").alias("step"), F.col("total").alias("score")))
    return last.select("uid", F.round("score", 8).alias("score"))


def weight_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Weights of all members, the suppliers, from the log of the score loop."""
    path = scratch_path(spark, "weights")
    score_log(spark, sf, path)
    blocks = events(spark, sf).agg(F.min("block").alias("low"), F.max("block").alias("high")).first()
    width = commit_streams.WEIGHT_EPOCH_BLOCKS
    first, last = (-(-(blocks[c] or 0) // width) * width for c in ("low", "high"))
    spark.range(1).select(F.lit(last + width).cast("bigint").alias("block")).write.parquet(f"{path}/ticks")
    logged = spark.read.parquet(f"{path}/totals").schema
    arriving = runner.file_stream(spark, f"{path}/totals", logged)
    clock = runner.file_stream(spark, f"{path}/ticks", "block bigint")
    uids = read_table(spark, sf, "supplier").select(F.col("s_suppkey").alias("uid"))
    closed = commit_streams.member_epochs(arriving, uids, first, clock)
    runner.run_available(closed, f"{path}/epochs", commit_streams.weight_batches(path, 8, 0.1))
    found = spark.read.schema("epoch bigint, uid bigint, w_u16 int").parquet(f"{path}/weights")
    return found.where(F.col("epoch") <= last).select("epoch", "uid", "w_u16")


def conversation_chunks(table: DataFrame) -> DataFrame:
    return table.select("conv_id", F.col("turn").alias("seq"), F.col("text").alias("chunk"))


def chunk_reassembly(spark: SparkSession, sf: str) -> DataFrame:
    whole = chunks.chunk_reassembly(conversation_chunks(read_table(spark, sf, "conversations")))
    return whole.select("conv_id", F.md5("completion").alias("completion_md5"))


def chunk_stream(spark: SparkSession, sf: str) -> DataFrame:
    arriving = conversation_chunks(table_stream(spark, sf, "conversations"))
    path = runner.run_available(chunks.chunk_stream(arriving), scratch_path(spark, "chunks"))
    # A conversation that lies in files of several batches has a piece from each.
    pieces = read_back(spark, f"{path}/rows", chunks.PIECE_SCHEMA)
    in_order = F.array_sort(F.collect_list(F.struct("at", "text")))
    whole = F.array_join(F.transform(in_order, lambda p: p.getField("text")), "")
    return pieces.groupBy("conv_id").agg(F.min("at").alias("at"), F.md5(whole).alias("text_md5"))


def refine_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The pages arrive in three parts; the job takes up where it stopped after each."""
    path, folder = scratch_path(spark, "corpus"), scratch_path(spark, "arrivals")
    settings = refine.RefineSettings(domains=BLOCKED_DOMAINS, words=BLOCKED_WORDS)
    table = read_table(spark, sf, "pages")
    thirds = table.agg(F.percentile_approx("page_id", [1 / 3, 2 / 3])).first()[0] or [0, 0]
    first, second = F.lit(thirds[0]), F.lit(thirds[1])
    page = F.col("page_id")
    step = refine_streams.refine_batches(profiles(spark, sf), path, settings)
    for part in (page <= first, (page > first) & (page <= second), page > second):
        table.where(part).write.mode("append").parquet(folder)
        arriving = runner.file_stream(spark, folder, table.schema).select(
            F.col("page_id").alias("id"), "url", "html"
        )
        runner.run_available(arriving, path, step)
    return spark.read.parquet(f"{path}/corpus").select(
        F.col("id").alias("page_id"), "token_count", F.md5("text").alias("text_md5")
    )


QUERIES = {
    f.__name__: f
    for f in (
        url_filter, url_filter_table, extract_main_text, language_filter, language_filter_joined, gopher_repetition, gopher_quality,
        c4_quality, fineweb_quality, refine_corpus, stage_stats, pii_mask, token_count,
        token_totals, shingles, minhash_signature, lsh_candidates, dedup_clusters,
        dedup_cluster_sizes, minhash_dedup, sample_rows, sample_rows_by_source, lookup_sources,
        content_words, word_overlap, audit_corpus, audit_samples, audit_submissions, similarity_gate, parse_eval_log, eval_summary,
        corpus_quality_eval, elapsed_time, submission_score, commit_key, pair_hash,
        eligible_submitters, late_commits, recent_commits, new_commits, stale_decay, ema_score, latest_score,
        dense_scores, l1_weights, capped_weights, process_weights, process_weights_all,
        emit_weights, weight_epochs, weight_intervals, epoch_norms, pack_sequences, token_budget, weighted_mix, batch_plan,
        data_stages, read_warc, read_jsonl, write_jsonl, write_removed, publish_dataset,
        publish_corpus, publish_stats, report_scores, commit_stream, score_stream, score_restart, weight_stream, chunk_reassembly, chunk_stream,
        refine_stream,
    )
}
