"""Captured API pages: read, follow, flatten and normalise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.text import js_trim
from tidemark.schemas import PAGE
from tidemark.session import Scratch

# What the article API serves per page, and how many pages one
# crawl follows unless told otherwise. Only a caller that wants that limit
# passes it; nothing here applies it on its own.
PER_PAGE = 100
API_MAX_PAGES = 100

DEFAULT_LOCALE = "en-us"


def with_page_number(pages: DataFrame) -> DataFrame:
    """Fill a missing `page_no` from the dump's file name (`page-17.json`), and a
    missing `crawl` from its folder: one folder holds one crawl."""
    from_name = F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)\D*$", 1)
    folder = F.regexp_extract(F.col("_metadata.file_path"), "([^/]*)/[^/]*$", 1)
    return pages.withColumns(
        {
            "page_no": F.coalesce("page_no", from_name.try_cast("bigint")),
            "crawl": F.coalesce("crawl", folder),
        }
    )


def read_page_dumps(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """One row per captured page.

    The default is one page per line, which Spark can split; `multi_line`
    reads one indented page per file. Pages that share a file must carry their
    number themselves.
    """
    pages = spark.read.schema(PAGE).option("multiLine", multi_line).json(path)
    return with_page_number(pages)


def _columns(pages: DataFrame) -> DataFrame:
    """`pages` with all columns of a page; those it lacks are null."""
    kinds = {field.name: field.dataType for field in PAGE.fields}
    missing = {n: F.lit(None).cast(k) for n, k in kinds.items() if n not in pages.columns}
    return pages.withColumns(missing)


def page_chain(pages: DataFrame) -> DataFrame:
    """(crawl, address, place): the pages that each crawl reaches by its links, `place`
    counting from 0. Needs the address of every page.

    A crawl starts at the page that no other one leads to, of several at the one of
    the lowest number, then address; if there is none, at the lowest of all. Links
    that lead back end the chain, as do links to pages that were not captured.

    Pointer jumping: each round doubles both the pages with a known place and the
    length of the jumps, so rounds grow with the logarithm of the chain. Only
    narrow rows, one per page, are joined.
    """
    narrow = _columns(pages).select(
        F.coalesce("crawl", F.lit("")).alias("crawl"), "address", "next_page", "page_no"
    )
    scratch = Scratch(pages.sparkSession)
    narrow = scratch.staged(narrow.dropDuplicates(["crawl", "address"]), "chain-pages")
    led = narrow.where("next_page <> address").select("crawl", F.col("next_page").alias("address"))
    rank = F.struct(F.col("page_no").isNull(), "page_no", "address")
    heads = narrow.join(led.distinct(), ["crawl", "address"], "left_anti")
    heads = heads.groupBy("crawl").agg(F.min_by("address", rank).alias("head"))
    lowest = narrow.groupBy("crawl").agg(F.min_by("address", rank).alias("lowest"))
    starts = lowest.join(heads, "crawl", "left").select(
        "crawl", F.coalesce("head", "lowest").alias("address"), F.lit(0).cast("long").alias("place")
    )
    known = narrow.select("crawl", F.col("address").alias("to"))
    jumps = narrow.select("crawl", "address", F.col("next_page").alias("to"))
    jumps = scratch.staged(jumps.join(known, ["crawl", "to"], "left_semi"), "chain-jumps")
    reached, step = scratch.staged(starts, "chain"), 1
    while True:
        ahead = reached.join(jumps, ["crawl", "address"]).select(
            "crawl", F.col("to").alias("address"), (F.col("place") + step).alias("place")
        )
        places = reached.unionByName(ahead).groupBy("crawl", "address").agg(F.min("place").alias("place"))
        longer = Scratch(pages.sparkSession)
        places = longer.staged(places, "chain")
        grown = places.count() > reached.count()
        onward = jumps.select("crawl", F.col("address").alias("to"), F.col("to").alias("end"))
        doubled = jumps.join(onward, ["crawl", "to"]).select("crawl", "address", F.col("end").alias("to"))
        reached, step = places, 2 * step
        if not grown:
            scratch.close()
            return reached
        jumps = longer.staged(doubled, "chain-jumps")
        scratch.close()
        scratch = longer


def ordered_pages(pages: DataFrame) -> DataFrame:
    """`pages` with a `page_no` that puts all of them in one order, by which the last of
    a repeated id wins.

    Numbers that are there and differ stay. Where several crawls have the same ones,
    each as often as once, crawls follow one another by name. Where a crawl lacks
    numbers or repeats one, its pages' addresses must be there, and all crawls are
    ordered by name, then by their links. What is left without an order is refused.
    The numbers are looked at first, which reads the dump once more.
    """
    pages = _columns(pages)
    crawl = F.coalesce("crawl", F.lit(""))
    row = pages.agg(
        F.count(F.lit(1)).alias("n"),
        F.count("page_no").alias("numbered"),
        F.count_distinct("page_no").alias("different"),
        F.count_distinct(crawl, "page_no").alias("in_crawls"),
        F.max("page_no").alias("top"),
        F.count("address").alias("addressed"),
        F.count_distinct(crawl, "address").alias("addresses"),
    ).first()
    if row.numbered == row.n == row.different:
        return pages
    in_crawls = row.numbered == row.n == row.in_crawls
    if not in_crawls and not row.n == row.addressed == row.addresses:
        if row.numbered < row.n:
            raise ValueError(f"{row.n - row.numbered} pages have no number, and not all an address")
        raise ValueError("pages of a crawl share a number, and not all have an address")
    pages = pages.withColumn("_crawl", crawl)
    width = row.top + 1 if in_crawls else row.n + 1
    # a row per crawl, which is a run of the capture: they are sent to the pages, as by
    # crawl all pages of one, which are rendered next, would meet in one task
    rank = F.row_number().over(Window.orderBy("_crawl")) - 1
    crawls = pages.select("_crawl").distinct().withColumn("_first", rank * F.lit(width))
    crawls = F.broadcast(crawls)
    if in_crawls:
        placed = pages.join(crawls, "_crawl").withColumn("_place", F.col("page_no"))
    else:
        chain = page_chain(pages).withColumnsRenamed({"crawl": "_crawl", "place": "_place"})
        placed = pages.join(chain, ["_crawl", "address"], "left").join(crawls, "_crawl")
        lost = placed.where("_place IS NULL").count()
        if lost:
            raise ValueError(f"{lost} pages have no order: no links lead to them")
    return placed.withColumn("page_no", F.col("_first") + F.col("_place")).select(pages.columns).drop("_crawl")


def followed_pages(pages: DataFrame, max_pages: int | None = None) -> DataFrame:
    """The pages each crawl reaches by its links, and the first `max_pages` of them.

    Where all pages have an address, their links are followed, whatever the numbers
    are. Else pages follow one another by number up to the first without `next_page`.
    Only the narrow columns are grouped; the pages meet one row per crawl or page.
    """
    pages = _columns(pages)
    crawl = F.coalesce("crawl", F.lit(""))
    if pages.where("address IS NULL").isEmpty():
        chain = page_chain(pages)
        if max_pages is not None:
            chain = chain.where(F.col("place") < max_pages)
        chain = chain.select(F.col("crawl").alias("_crawl"), "address")
        return pages.withColumn("_crawl", crawl).join(chain, ["_crawl", "address"], "left_semi").drop("_crawl")
    places = pages.select(crawl.alias("_crawl"), "page_no", F.col("next_page").isNull().alias("ends"))
    limits = places.groupBy("_crawl").agg(F.min(F.when(F.col("ends"), F.col("page_no"))).alias("_last"))
    if max_pages is not None:
        place = F.row_number().over(Window.partitionBy("_crawl").orderBy("page_no"))
        reached = places.withColumn("place", place).filter(F.col("place") <= max_pages)
        counted = reached.groupBy("_crawl").agg(F.max("page_no").alias("_stop"))
        limits = limits.join(counted, "_crawl").select(
            "_crawl", F.least("_last", "_stop").alias("_last")
        )
    joined = pages.withColumn("_crawl", crawl).join(F.broadcast(limits), "_crawl")
    within = F.col("_last").isNull() | (F.col("page_no") <= F.col("_last"))
    return joined.filter(within).select(pages.columns)


def flatten_pages(pages: DataFrame) -> DataFrame:
    """One row per article, `pos` being its place in the page. A page without
    articles gives no row."""
    flat = pages.select("page_no", F.posexplode("articles").alias("pos", "article"))
    return flat.select("page_no", "pos", "article.*")


def drop_drafts(raw: DataFrame) -> DataFrame:
    """A missing draft flag means published."""
    return raw.filter(~F.coalesce(F.col("draft"), F.lit(False)))


def _or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def normalise(raw: DataFrame, locale: str = DEFAULT_LOCALE) -> DataFrame:
    """Replace nulls by defaults and trim the title. An empty locale is kept."""
    return raw.select(
        "id",
        js_trim(_or_empty("title")).alias("title"),
        _or_empty("body").alias("body_html"),
        _or_empty("html_url").alias("html_url"),
        _or_empty("updated_at").alias("updated_at"),
        F.coalesce(F.col("locale"), F.lit(locale)).alias("locale"),
        "page_no",
        "pos",
    )


def articles_of(
    pages: DataFrame,
    locale: str = DEFAULT_LOCALE,
    max_pages: int | None = None,
    follow: bool = False,
) -> DataFrame:
    """Published, normalised articles of all pages.

    With `follow` or `max_pages` only those that a crawl reaches by its links.
    `page_no` is that of `ordered_pages`.

    Drafts go before anything is rendered: the renderer is opaque to the
    optimizer, so no later filter would move below it.
    """
    if follow or max_pages is not None:
        pages = followed_pages(pages, max_pages)
    pages = ordered_pages(pages)
    return normalise(drop_drafts(flatten_pages(pages)), locale)
