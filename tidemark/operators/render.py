"""Documents from articles: Markdown body, header, slug, hash.

Four renderers give the body:

`flat`  regular-expression columns (`functions.html`), all inside the JVM;
`nested`  columns for nested lists, quotes and hinted elements as well
        (`functions.nested`), all inside the JVM;
`full`  an Arrow UDF that reads the markup element by element and so handles
        nesting. Only the HTML column goes to Python;
`auto`  `flat`, but `full` for the documents whose markup needs it. The others
        go to Python as nulls.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.functions import html as flat
from tidemark.functions import text as tx
from tidemark.functions.markdown import MarkdownReader
from tidemark.functions.nested import nested_markdown
from tidemark.operators.chunking import MAX_TOKENS, OVERLAP_TOKENS

RENDERER_VERSION = {"flat": "flat-3", "nested": "nested-1", "full": "full-2", "auto": "auto-3"}


@F.pandas_udf(StringType())
def full_markdown(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Clean and render HTML. One reader serves all rows of a task."""
    reader = MarkdownReader()
    for html in batches:
        yield html.map(lambda text: None if text is None else reader.render(text))


def with_body(articles: DataFrame, renderer: str) -> DataFrame:
    """`articles` with `_body`, the rendered `body_html`."""
    html = F.col("body_html")
    if renderer == "full":
        return articles.withColumn("_body", full_markdown(F.coalesce(html, F.lit(""))))
    if renderer == "flat":
        return articles.withColumn("_body", flat.flat_markdown(flat.clean_html(html)))
    if renderer == "nested":
        return articles.withColumn("_body", nested_markdown(html))
    if renderer == "auto":
        # a column of its own, which is computed once for all its uses
        read = articles.withColumn("_read", flat.plain_or_needed(html))
        needed = F.col("_read.needed")
        # a UDF inside `when` runs for all rows, so it is given only what it is for
        body = F.when(needed, full_markdown(F.when(needed, html))).otherwise(F.col("_read.plain"))
        return read.withColumn("_body", body)
    raise ValueError(f"unknown renderer: {renderer}")


def render_documents(
    articles: DataFrame,
    renderer: str = "auto",
    max_tokens: int = MAX_TOKENS,
    overlap: int = OVERLAP_TOKENS,
) -> DataFrame:
    """One document per article, with what the later steps need of it."""
    articles, body = with_body(articles, renderer), tx.tidy_body(F.col("_body"))
    rendered = articles.select(
        "id",
        "page_no",
        "pos",
        "updated_at",
        F.col("html_url").alias("url"),
        tx.document_key(F.col("id"), F.col("title")).alias("slug"),
        tx.compose_document(F.col("title"), F.col("html_url"), F.col("id"), body).alias("md_text"),
    )
    units = tx.u16_length(F.col("md_text"))
    return rendered.select(
        "*",
        tx.filename(F.col("slug")).alias("filename"),
        tx.content_hash(F.col("md_text")).alias("hash"),
        tx.chunk_estimate(units, max_tokens, overlap).alias("est_chunks"),
        F.lit(RENDERER_VERSION[renderer]).alias("renderer_version"),
    )
