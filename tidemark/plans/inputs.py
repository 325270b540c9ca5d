"""Inputs of the registered queries, derived from the given tables.

The tables hold no drafts, leaked keys, earlier snapshots or repeated ids, so
those are planted by rule. Every derivation keeps the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import js_trim
from tidemark.operators.render import render_documents
from tidemark.operators.skew import last_by
from tidemark.session import staged
from tidemark.sources.pages import PER_PAGE

# Markup planted into pages.
ORDERED = "<ol><li>first of <b>two</b></li><li>second</li></ol>"
TABLE = "<table><tr><td>R&amp;D</td><td><b>3</b></td></tr></table>"
REFERENCES = "<p>caf&eacute; it&#8217;s &#x2014; &copy; &#150; &nope; &amp;lt; &#0; &#128512;</p>"
HINTED = "<li class=nav-item>go</li><section class='share'>gone</section>"

CRAWL_TIME = "2024-01-01T00:00:00Z"
STORED = ["id", "page_no", "pos", "slug", "filename", "hash", "updated_at", "est_chunks",
          "renderer_version"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def every(n: int, column: str) -> Column:
    return F.col(column) % n == 0


def _page_place() -> list[Column]:
    return [
        F.floor(F.col("page_id") / PER_PAGE).alias("page_no"),
        F.pmod("page_id", F.lit(PER_PAGE)).cast("int").alias("pos"),
    ]


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.regexp_extract("html", "<title>(.*?)</title>", 1)
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("id"),
        js_trim(title).alias("title"),
        F.col("html").alias("body_html"),
        F.col("url").alias("html_url"),
        F.lit("").alias("updated_at"),
        F.regexp_extract("html", '<html lang="([a-z]+)"', 1).alias("locale"),
        *_page_place(),
    )


def raw_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles as an API sends them: fields missing here and there, blanks
    around titles, some drafts."""
    source = articles(spark, sf_dir)

    def missing(n: int, value: Column) -> Column:
        return F.when(~every(n, "id"), value)

    padded = F.concat(F.lit("\u00a0 "), F.col("title"), F.lit(" \t"))
    return source.select(
        "id",
        missing(8, padded).alias("title"),
        missing(6, F.col("body_html")).alias("body"),
        missing(12, F.col("html_url")).alias("html_url"),
        missing(5, F.lit(CRAWL_TIME)).alias("updated_at"),
        F.when(F.col("locale") != "fr", F.col("locale")).alias("locale"),
        missing(5, every(11, "id")).alias("draft"),
        "page_no",
        "pos",
    )


def page_dumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page responses of a hundred articles, numbered from 1: odd pages are one
    crawl, even ones another. The first goes on with an empty page and ends with
    one that has no list; a page beyond its end is no part of it."""
    raw = raw_articles(spark, sf_dir)
    fields = [c for c in raw.columns if c not in ("page_no", "pos")]
    number, top = F.col("page_no"), raw.agg((F.max("page_no") + 1).alias("top"))
    in_order = F.array_sort(F.collect_list(F.struct("pos", *fields)))
    listed = F.transform(in_order, lambda a: F.struct(*[a[f].alias(f) for f in fields]))
    full = raw.groupBy((number + 1).alias("page_no")).agg(listed.alias("articles"))
    kind = full.schema["articles"].dataType
    after = top.select(F.explode(F.array(*map(F.lit, (1, 2, 3)))).alias("step"), "top").select(
        (F.col("top") + F.col("step")).alias("page_no"),
        F.when(F.col("step") != 2, F.array().cast(kind)).alias("articles"),
        F.when(F.col("step") == 1, F.lit("/articles?after=end")).alias("next_page"),
        F.lit("odd").alias("crawl"),
    )
    # the last even page ends the other crawl
    last = top.select(F.col("top") - F.col("top") % 2).scalar()
    crawl = F.when(number % 2 == 1, "odd").otherwise("even")
    following = F.concat(F.lit("/articles?after="), number.cast("string"))
    linked = full.select(
        "page_no", "articles", F.when(number != last, following).alias("next_page"), crawl.alias("crawl")
    )
    return linked.unionByName(after)


def unnumbered_dumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page responses of ten articles in three crawls whose numbers tell no order: the
    first crawl has none, the second counts down, the third starts at 1 like the
    second. Links lead from page to page; each crawl ends with a page that was
    captured but belongs to no chain, which holds its articles again."""
    raw = raw_articles(spark, sf_dir).withColumn("n", F.floor(F.col("id") / 10))
    fields = [c for c in raw.columns if c not in ("page_no", "pos", "n")]
    in_order = F.array_sort(F.collect_list(F.struct("id", *[f for f in fields if f != "id"])))
    listed = F.transform(in_order, lambda a: F.struct(*[a[f].alias(f) for f in fields]))
    pages = raw.groupBy("n").agg(listed.alias("articles"))
    top = pages.agg(F.max("n")).scalar()
    place, crawl = F.floor(F.col("n") / 3), F.col("n") % 3
    address = F.concat(F.lit("/articles?after="), F.col("n").cast("string"))
    after = F.concat(F.lit("/articles?after="), (F.col("n") + 3).cast("string"))
    chain = pages.select(
        "articles",
        F.when(F.col("n") + 3 <= top, after).alias("next_page"),
        F.when(crawl == 1, 1000000 - place).when(crawl == 2, place + 1).alias("page_no"),
        F.concat(F.lit("crawl-"), crawl.cast("string")).alias("crawl"),
        address.alias("address"),
    )
    stray = chain.where(F.col("address").isin(*[f"/articles?after={n}" for n in range(3)])).select(
        "articles", F.lit("/articles?after=none").alias("next_page"), F.lit(2000000).cast("long").alias("page_no"),
        "crawl", F.lit("/stray").alias("address"),
    )
    return chain.unionByName(stray)


def hinted_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with hinted elements in several quotings, and ordered lists, tables
    and entities added to some."""
    slot = F.when(every(2, "page_id"), F.lit("class='ad-slot'")).otherwise('class="x ad-slot"')
    added = F.concat(
        F.when(every(3, "page_id"), F.lit(ORDERED)).otherwise(""),
        F.when(every(4, "page_id"), F.lit(TABLE)).otherwise(""),
        F.when(every(5, "page_id"), F.lit(HINTED)).otherwise(""),
        F.when(every(2, "page_id"), F.lit(REFERENCES)).otherwise(""),
        F.lit("</article>"),
    )
    html = F.replace(F.col("html"), F.lit('class="ad"'), slot)
    return table(spark, sf_dir, "pages").select(
        "page_id", F.replace(html, F.lit("</article>"), added).alias("html")
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render_documents(articles(spark, sf_dir), "flat")


def stored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents without their text, rendered once."""
    return staged(documents(spark, sf_dir).select(STORED), "documents")


def baseline(stored: DataFrame) -> DataFrame:
    """Snapshot of an earlier run, one row per id: some documents are unknown to
    it, some had other text, some were never uploaded."""
    name = F.col("id").cast("string")
    known = stored.filter(~every(10, "id")).select("id", "slug", "hash", "renderer_version")
    return last_by(known, "id", F.col("hash")).select(
        "id",
        F.when(every(7, "id"), F.sha2(F.concat(F.lit("old"), name), 256))
        .otherwise(F.col("hash"))
        .alias("hash"),
        "slug",
        F.lit("").alias("updated_at"),
        F.when(~every(13, "id"), F.concat(F.lit("file_"), name)).alias("file_id"),
        "renderer_version",
        F.col("hash").alias("embedded_hash"),
    )


def repeated_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles and, on later pages, some of them again, half of those changed."""
    first = articles(spark, sf_dir)
    title = F.when(every(18, "id"), F.concat("title", F.lit(" (again)"))).otherwise(F.col("title"))
    again = (
        first.filter(every(9, "id"))
        .withColumn("title", title)
        .withColumn("page_no", F.col("page_no") + 1_000_000)
    )
    return first.unionByName(again)


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The `documents` table in the shape of a rendered corpus."""
    name = F.col("doc_id").cast("string")
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        F.concat(F.lit("file_"), name).alias("file_id"),
        F.concat(F.lit("doc-"), name, F.lit(".md")).alias("filename"),
        F.concat(F.lit("https://example.com/docs/"), name).alias("url"),
        F.col("text").alias("md_text"),
    )


def files_with_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with leaked keys and with dummy keys added to some texts."""
    tail = F.substring(F.sha2("md_text", 256), 1, 24)
    text = F.concat(
        F.col("md_text"),
        F.when(every(50, "id"), F.concat(F.lit(" sk-proj-"), tail)).otherwise(""),
        F.when(every(70, "id"), F.concat(F.lit(" sk-your-"), tail)).otherwise(""),
    )
    return files(spark, sf_dir).select("filename", text.alias("text"))


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assistant turns; some cite an address, some list bullets."""
    tail = F.when(
        every(4, "conv_id"),
        F.concat(F.lit("\nArticle URL: https://example.com/"), F.col("conv_id").cast("string")),
    ).when(every(4, "turn") | every(7, "conv_id"), F.lit(" [1]")).otherwise("")
    bullets = F.repeat(F.lit("\n* step"), F.pmod("conv_id", F.lit(9)).cast("int"))
    return table(spark, sf_dir, "conversations").filter(F.col("role") == "assistant").select(
        "conv_id", "turn", F.concat("text", bullets, tail).alias("text")
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers as retrieval responses: three notes, one repeated, one unnamed. Some
    responses have no notes, some are missing, some are cut off."""

    def note(name: Column) -> Column:
        return F.struct(name.alias("filename"))

    own = F.concat(F.lit("doc-"), F.col("conv_id").cast("string"), F.lit(".md"))
    turn = F.concat(F.lit("turn-"), F.col("turn").cast("string"), F.lit(".md"))
    notes = F.array(note(own), note(turn), note(own), note(F.lit("")))
    notes = F.when(~every(5, "conv_id"), notes)
    content = F.struct(notes.alias("annotations"))
    response = F.struct(
        F.when(~every(6, "conv_id"), F.col("text")).alias("output_text"),
        F.array(F.struct(F.array(content).alias("content"))).alias("output"),
    )
    return answers(spark, sf_dir).select(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias(
            "response_id"
        ),
        F.when(every(11, "conv_id"), F.substring(F.to_json(response), 1, 20))
        .when(~every(8, "conv_id"), F.to_json(response))
        .alias("response"),
    )


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("question_id"), "text"
    )


# Markup whose lists, quotes and hinted elements nest, around the text of a page.
NESTED = (
    '<div class="social-share">a<div>{text}</div>b</div><h2>Page {id}</h2>',
    '<ul><li>one {text}<ol start="3"><li>x<ul><li>deep</li></ul></li><li>y</li></ol></li>',
    "<li>two<li>three</ul><blockquote><p>{text}</p><ul><li>q</ul></blockquote>",
    '<ul><li class="nav-item">gone<ul><li>gone too</li></ul><li>kept</ul><p>end</p>',
)


def nested_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's text, without its own markup, in nested markup."""
    text = F.trim(F.regexp_replace("html", r"(<[^>]*>|&|[ \t\r\n])+", " "))
    pages = table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit("t "), text).alias("text"))
    html = F.lit("".join(NESTED))
    for mark, value in (("{id}", F.col("page_id").cast("string")), ("{text}", F.col("text"))):
        html = F.replace(html, F.lit(mark), value)
    return pages.select("page_id", html.alias("html"))
