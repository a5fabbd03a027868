"""Main text of an HTML page, favouring precision."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from winnow.functions.html import page_text
from winnow.functions.text import computed


@F.arrow_udf(StringType())
def _page_texts(pages: pa.Array) -> pa.Array:
    found = (None if page is None else page_text(page) for page in pages.to_pylist())
    return pa.array(found, pa.string())


def main_text(html: Column) -> Column:
    """Blocks with enough text and few links, one per line; NULL for NULL."""
    return _page_texts(html)


def extract_main_text(df: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    return computed(df, text, main_text(F.col(html)))
