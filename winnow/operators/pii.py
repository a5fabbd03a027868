"""Masking of e-mail addresses and public IP addresses, and token counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from winnow.functions.text import count_tokens

# The look-behind and the possessive run keep a long run without @ linear.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"

# Address ranges that are not globally routable (RFC 6890).
PRIVATE = (
    r"(?:0|10|127)\.",
    r"100\.(?:6[4-9]|[7-9][0-9]|1[01][0-9]|12[0-7])\.",
    r"169\.254\.",
    r"172\.(?:1[6-9]|2[0-9]|3[01])\.",
    r"192\.168\.",
    r"192\.0\.[02]\.",
    r"198\.1[89]\.",
    r"198\.51\.100\.",
    r"203\.0\.113\.",
    r"(?:24[0-9]|25[0-5])\.",
)
IP = rf"\b(?:{OCTET}\.){{3}}{OCTET}\b"
PUBLIC_IP = rf"\b(?!{'|'.join(PRIVATE)})(?:{OCTET}\.){{3}}{OCTET}\b"
MASK_EMAIL = "email@example.com"
MASK_IP = "22.214.171.124"


def masked(text: Column) -> Column:
    return F.regexp_replace(
        F.regexp_replace(text, EMAIL, MASK_EMAIL), PUBLIC_IP, MASK_IP
    )


def pii_mask(df: DataFrame, text: str = "text") -> DataFrame:
    return df.withColumn(text, masked(F.col(text)))


def token_count(df: DataFrame, text: str = "text") -> DataFrame:
    return df.withColumn("token_count", count_tokens(F.col(text)))


def token_totals(df: DataFrame) -> DataFrame:
    """Totals over a frame with `token_count`."""
    return df.agg(
        F.count(F.lit(1)).alias("documents"), F.sum("token_count").alias("tokens")
    )
