import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark.functions import text as tx
from tidemark.functions.words import distinct_words, word_counts


def values(spark, expression, *texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.v for r in rows.orderBy("i").select(expression(F.col("t")).alias("v")).collect()]


def test_js_trim_takes_unicode_blanks(spark):
    assert values(spark, tx.js_trim, "﻿  a b  \t\r\n", " 　 ", "") == [
        "a b",
        "",
        "",
    ]


def test_u16_length_counts_astral_characters_twice(spark):
    texts = ["abc", "é€", "a😀b", ""]
    assert values(spark, tx.u16_length, *texts) == [
        len(t.encode("utf-16-le")) // 2 for t in texts
    ]


@pytest.mark.parametrize(
    "title, slug",
    [
        ("Add a YouTube Video", "add-a-youtube-video"),
        ("  --Hello,   World!--  ", "hello-world"),
        ("ÄÖÜ", "untitled"),
        ("", "untitled"),
        ("a" * 70, "a" * 60),
    ],
)
def test_slugify(spark, title, slug):
    assert values(spark, tx.slugify, title) == [slug]


def test_cut_slug_may_end_in_a_hyphen(spark):
    [slug] = values(spark, tx.slugify, "a" * 59 + " b")
    assert slug == "a" * 59 + "-"


def test_document_key_and_header_round_trip(spark):
    rows = spark.createDataFrame(
        [(123, "Add a YouTube Video", "https://example.com/a/123", "body\n\nArticle ID: 9")],
        "id long, title string, url string, body string",
    )
    document = tx.compose_document(F.col("title"), F.col("url"), F.col("id"), F.col("body"))
    row = rows.select(
        document.alias("md"), tx.document_key(F.col("id"), F.col("title")).alias("key")
    ).first()
    assert row.key == "123-add-a-youtube-video"
    assert row.md == (
        "# Add a YouTube Video\n\nArticle URL: https://example.com/a/123\n"
        "Article ID: 123\n\nbody\n\nArticle ID: 9\n"
    )
    parsed = rows.select(document.alias("md")).select(
        tx.header_title(F.col("md")), tx.header_url(F.col("md")), tx.header_id(F.col("md"))
    )
    assert tuple(parsed.first()) == ("Add a YouTube Video", "https://example.com/a/123", 123)


def test_header_of_other_text_is_empty(spark):
    assert values(spark, tx.header_id, "no header") == [None]
    assert values(spark, tx.header_url, "no header") == [""]


def test_content_hash(spark):
    hello, other = values(spark, tx.content_hash, "hello", "hellp")
    assert hello == hashlib.sha256(b"hello").hexdigest() != other


def test_tidy_body(spark):
    assert values(spark, tx.tidy_body, "\n\n a\n\n\n\nb\n\nc  \n") == ["a\n\nb\n\nc"]


def test_base_url(spark):
    assert values(spark, tx.base_url, "help.example.com//", "http://a.b/", "httpbin.org") == [
        "https://help.example.com",
        "http://a.b",
        "httpbin.org",
    ]


@pytest.mark.parametrize(
    "units, max_tokens, overlap, expected",
    [
        (5, 800, 400, 1),
        (0, 800, 400, 1),
        (8000, 800, 400, 4),
        (8000, 1000, 0, 2),
        (3200, 800, 400, 1),
        (3204, 800, 400, 2),
        (412, 100, 100, 3),
        (412, 100, 200, 1),
    ],
)
def test_chunk_estimate(spark, units, max_tokens, overlap, expected):
    row = spark.range(1).select(
        tx.chunk_estimate(F.lit(units).cast("long"), max_tokens, overlap).alias("n")
    )
    assert row.first().n == expected


def test_word_counts(spark):
    [counts] = values(spark, word_counts, "B a, b! Ä1 ä1 a_b")
    assert {c.term: c.tf for c in counts} == {"a": 2, "b": 3, "ä1": 2}
    assert values(spark, word_counts, " .. ", "") == [None, None]
    assert values(spark, distinct_words, "B a b") == [["b", "a"]]
