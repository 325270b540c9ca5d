"""Text expressions. All are built-in column expressions that stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters JavaScript's trim() removes. Spark's trim()
# removes only the space, which would leave the no-break spaces that editors
# put at the ends of titles and bodies.
JS_WHITESPACE = (
    "\t\n\x0b\f\r \u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000\ufeff"
)

# The header of a document.
URL_LABEL = "Article URL: "
ID_LABEL = "Article ID: "

SLUG_LENGTH = 60
EMPTY_SLUG = "untitled"


def js_trim(text: Column) -> Column:
    return F.btrim(text, F.lit(JS_WHITESPACE))


def u16_length(text: Column) -> Column:
    """Length in UTF-16 units (an astral character counts two)."""
    return F.shiftright(F.octet_length(F.encode(text, "UTF-16LE")), 1).cast("long")


def slugify(text: Column, max_len: int = SLUG_LENGTH) -> Column:
    """URL-safe form of a title.

    The cut comes after the edge hyphens are dropped, so a cut slug may end in
    a hyphen; file names depend on that.
    """
    hyphenated = F.btrim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), F.lit("-"))
    cut = F.substring(hyphenated, 1, max_len)
    return F.when(cut == "", F.lit(EMPTY_SLUG)).otherwise(cut)


def document_key(doc_id: Column, title: Column) -> Column:
    return F.concat_ws("-", doc_id.cast("string"), slugify(title))


def filename(slug: Column) -> Column:
    return F.concat(slug, F.lit(".md"))


def tidy_body(markdown: Column) -> Column:
    """Trim, then allow at most one blank line in a row."""
    return F.regexp_replace(js_trim(markdown), "\n{3,}", "\n\n")


def compose_document(title: Column, url: Column, doc_id: Column, body: Column) -> Column:
    return F.concat(
        F.lit("# "),
        title,
        F.lit("\n\n" + URL_LABEL),
        url,
        F.lit("\n" + ID_LABEL),
        doc_id.cast("string"),
        F.lit("\n\n"),
        body,
        F.lit("\n"),
    )


def header_title(document: Column) -> Column:
    return F.regexp_extract(document, r"^# ([^\n]*)", 1)


def header_url(document: Column) -> Column:
    return F.regexp_extract(document, URL_LABEL + r"(\S*)", 1)


def header_id(document: Column) -> Column:
    """Document id from the header; null where the text has none."""
    return F.regexp_extract(document, r"\n" + ID_LABEL + r"(\d+)\n", 1).try_cast("bigint")


def content_hash(document: Column) -> Column:
    return F.sha2(document, 256)


def base_url(host: Column) -> Column:
    with_scheme = F.when(host.startswith("http"), host).otherwise(
        F.concat(F.lit("https://"), host)
    )
    return F.rtrim(with_scheme, F.lit("/"))


def token_estimate(n_units: Column) -> Column:
    """Four characters make about one token; never less than one."""
    return F.greatest(F.lit(1).cast("long"), F.floor(n_units / F.lit(4)))


def chunk_estimate(n_units: Column, max_tokens: int = 800, overlap: int = 400) -> Column:
    """Number of fixed-size chunks a text of `n_units` characters makes."""
    tokens = token_estimate(n_units)
    stride = max(1, max_tokens - overlap)
    strides = F.ceil((tokens - F.lit(overlap)) / F.lit(stride))
    return F.when(tokens <= max_tokens, F.lit(1).cast("long")).otherwise(
        F.greatest(F.lit(1).cast("long"), strides)
    )
