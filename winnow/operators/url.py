"""URL filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from winnow.functions.urls import host, host_suffixes
from winnow.operators.skew import lookup


def _word_rule(url: Column, words: list[str]) -> Column:
    if not words:
        return F.lit(False)
    # A banned word counts when it stands alone between separators.
    body = "|".join(f"\\Q{word}\\E" for word in words)
    return F.coalesce(
        F.lower(url).rlike(rf"(^|[^a-z0-9])(?:{body})([^a-z0-9]|$)"), F.lit(False)
    )


def domain_rule(url: Column, domains: list[str]) -> Column:
    if not domains:
        return F.lit(False)
    listed = F.array(*[F.lit(d.lower()) for d in domains])
    return F.coalesce(F.arrays_overlap(host_suffixes(host(url)), listed), F.lit(False))


def url_reason(url: Column, domains: list[str], words: list[str]) -> Column:
    return F.when(domain_rule(url, domains), "domain").when(_word_rule(url, words), "word")


def url_filter(
    df: DataFrame,
    domains: list[str] | DataFrame,
    words: list[str] = (),
    url: str = "url",
) -> DataFrame:
    """Mark rows with a blocked host, or parent domain of it, or a banned word in the URL.

    A list becomes a literal set, tested where the row is. A DataFrame with a `domain` column
    may be of any size: only the distinct hosts meet it, and only the blocked hosts come back
    to the rows.
    """
    if isinstance(domains, DataFrame):
        marked = df.withColumn("_host", host(F.col(url)))
        hosts = marked.where("_host is not null").select("_host").distinct()
        listed = domains.select(F.lower("domain").alias("_suffix")).distinct()
        blocked = (
            hosts.withColumn("_suffix", F.explode(host_suffixes(F.col("_host"))))
            .join(listed, "_suffix", "left_semi")
            .select("_host")
            .distinct()
            .withColumn("_blocked", F.lit(True))
        )
        joined = lookup(marked, blocked, ["_host"], how="left")
        reason = F.when(F.col("_blocked"), "domain").when(
            _word_rule(F.col(url), list(words)), "word"
        )
        judged = joined.withColumn("drop_reason", reason).drop("_host", "_blocked")
    else:
        judged = df.withColumn("drop_reason", url_reason(F.col(url), list(domains), list(words)))
    return judged.withColumn("keep", F.col("drop_reason").isNull())
