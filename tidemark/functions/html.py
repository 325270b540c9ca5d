"""HTML cleaning and flat Markdown as regular-expression columns.

These run inside the JVM and are right for markup in which elements of one
name do not nest. Nested markup (lists in lists, quoted blocks, tags left open)
goes through `operators.render`, which reads the markup element by element;
`needs_element_renderer` tells which.
"""

from __future__ import annotations

import functools
import itertools
import json
import operator
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.words import bind

# Elements dropped with all they hold.
STRIP_TAGS = ("nav", "script", "style", "noscript", "iframe", "form", "header", "footer")

# An element is dropped when its class contains one of these.
# They are substring tests: `ad-` also meets `download-button`.
CLASS_HINTS = ("nav", "breadcrumb", "share", "social", "advert", "ad-", "cookie", "subscribe")

_HINT = "(?:" + "|".join(CLASS_HINTS) + ")"
# An opening tag whose class holds a hint, in any quoting or none.
_HINTED_OPEN = (
    r"<([a-z][a-z0-9]*)\b[^>]*\sclass\s*=\s*"
    rf"(?:\"[^\">]*{_HINT}[^\">]*\"|'[^'>]*{_HINT}[^'>]*'|[^\s\"'>]*{_HINT}[^\s\"'>]*)[^>]*>"
)
HINTED_OPEN = "(?is)" + _HINTED_OPEN
HINTED_ELEMENT = HINTED_OPEN + r".*?</\1\s*>"

TABLE = r"(?is)<table\b[^>]*>.*?</table\s*>"
ORDERED_LIST = r"(?is)<ol\b[^>]*>.*?</ol\s*>"
LIST_ITEM = r"(?is)<li\b[^>]*>(.*?)</li\s*>"


def _element(tag: str) -> str:
    return rf"<{tag}\b[^>]*>.*?</{tag}\s*>"


def strip_elements(html: Column, tags=STRIP_TAGS) -> Column:
    """Drop whole elements, all names in one pass over the text."""
    pattern = "(?is)" + "|".join(_element(tag) for tag in tags)
    return F.regexp_replace(F.coalesce(html, F.lit("")), pattern, "")


def strip_class_hints(html: Column) -> Column:
    """Drop elements of any name whose class holds a hint."""
    return F.regexp_replace(html, HINTED_ELEMENT, "")


def clean_html(html: Column) -> Column:
    return strip_class_hints(strip_elements(html))


# (pattern, replacement), applied from first to last.
FLAT_RULES = (
    (r"(?is)<!--.*?-->", ""),
    (r"(?is)<h1\b[^>]*>(.*?)</h1>", "\n\n# $1\n\n"),
    (r"(?is)<h2\b[^>]*>(.*?)</h2>", "\n\n## $1\n\n"),
    (r"(?is)<h3\b[^>]*>(.*?)</h3>", "\n\n### $1\n\n"),
    (r"(?is)<h4\b[^>]*>(.*?)</h4>", "\n\n#### $1\n\n"),
    (r"(?is)<h5\b[^>]*>(.*?)</h5>", "\n\n##### $1\n\n"),
    (r"(?is)<h6\b[^>]*>(.*?)</h6>", "\n\n###### $1\n\n"),
    (r"(?is)<pre\b[^>]*>\s*<code\b[^>]*>(.*?)</code>\s*</pre>", "\n\n```\n$1\n```\n\n"),
    (r"(?is)<code\b[^>]*>([^<]*)</code>", "`$1`"),
    (r'(?is)<img\b[^>]*\balt="([^"]*)"[^>]*\bsrc="([^"]*)"[^>]*>', "![$1]($2)"),
    (r'(?is)<img\b[^>]*\bsrc="([^"]*)"[^>]*\balt="([^"]*)"[^>]*>', "![$2]($1)"),
    (r'(?is)<a\b[^>]*\bhref="([^"]*)"[^>]*>(.*?)</a>', "[$2]($1)"),
    (r"(?is)<(?:b|strong)(?:\s[^>]*)?>([^<]*)</(?:b|strong)>", "**$1**"),
    (r"(?is)<(?:i|em)(?:\s[^>]*)?>([^<]*)</(?:i|em)>", "_$1_"),
    (r"(?i)<hr\b[^>]*>", "\n\n* * *\n\n"),
    (r"(?i)<br\s*/?>", "  \n"),
    (r"(?is)<li\b[^>]*>(.*?)</li>", "\n*   $1"),
    (r"(?i)</?(?:p|ul)\b[^>]*>", "\n\n"),
    (r"<[^>]+>", ""),
)

# What a text must hold, in some letters' case, for the rule at the same place to find
# anything in it. Looking for it is cheaper than the rule, which mostly finds nothing.
FLAT_MARKS = (
    ("<!--",),
    ("<h1",),
    ("<h2",),
    ("<h3",),
    ("<h4",),
    ("<h5",),
    ("<h6",),
    ("<pr",),
    ("<co",),
    ("<im",),
    ("<im",),
    ("<a",),
    ("<b", "<s"),
    ("<i", "<e"),
    ("<hr",),
    ("<br",),
    ("<li",),
    ("<p", "</p", "<u", "</u"),
    ("<",),
)

# References to characters by number or by name. Decoded last, in one pass, so that
# what they make is not read as a reference again.
REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"

# What HTML reads numbers from 128 to 159 as: Windows-1252, where it has a character.
_WINDOWS = {
    f"&#{n};": bytes([n]).decode("cp1252") for n in range(128, 160) if n not in (129, 141, 143, 144, 157)
}
_NAMED = {f"&{name}": text for name, text in html5.items() if name.endswith(";")}
_FREQUENT = {f"&{name};": _NAMED[f"&{name};"] for name in ("amp", "nbsp", "quot", "lt", "gt")}
_UNKNOWN = "\ufffd"


def _holds(text: Column, marks: tuple[str, ...]) -> Column:
    """Whether the text holds one of the marks, each letter in either case."""
    spelled = [
        "".join(letters)
        for mark in marks
        for letters in itertools.product(*(sorted({c.lower(), c.upper()}, reverse=True) for c in mark))
    ]
    return functools.reduce(operator.or_, [text.contains(own) for own in spelled])


def _segments(html: Column, pattern: str, outside, inside, marks: tuple[str, ...] = ()) -> Column:
    """`outside` of the texts between matches and `inside` of the matches, in turn. Only a
    text that holds one of the `marks`, if there are some, has matches."""
    between = F.split(html, pattern)
    found = F.concat(F.regexp_extract_all(html, F.lit(pattern), F.lit(0)), F.array(F.lit("")))
    if marks:
        matched = _holds(html, marks)
        # a null text has neither
        between = F.when(matched, between).when(~matched, F.array(html))
        found = F.when(matched, found).when(~matched, F.array(F.lit("")))

    def both(text: Column, match: Column) -> Column:
        return F.concat(outside(text), F.when(match == "", "").otherwise(inside(match)))

    return F.array_join(F.zip_with(between, found, both), "")


def _numbered(ordered: Column) -> Column:
    items = F.regexp_extract_all(ordered, F.lit(LIST_ITEM), F.lit(1))
    lines = F.transform(
        items, lambda item, i: F.concat(F.lit("\n"), (i + 1).cast("string"), F.lit(".  "), item)
    )
    return F.concat(F.lit("\n\n"), F.array_join(lines, ""), F.lit("\n\n"))


def _numbered_character(reference: Column) -> Column:
    """The character of `&#...;`, the replacement character where there is none."""
    digits = F.substring(reference, 3, 7)
    code = F.when(
        F.lower(F.substring(reference, 3, 1)) == "x",
        F.conv(F.regexp_extract(reference, "^&#[xX]([0-9a-fA-F]+)", 1), 16, 10),
    ).otherwise(F.regexp_extract(digits, "^([0-9]+)", 1)).cast("long")

    def character(n: Column) -> Column:
        valid = ((n > 0) & (n < 0xD800)) | ((n > 0xDFFF) & (n < 0x110000))
        known = F.element_at(_table(_WINDOWS), F.concat(F.lit("&#"), n.cast("string"), F.lit(";")))
        decoded = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
        return F.when(n.between(128, 159) & known.isNotNull(), known).when(valid, decoded).otherwise(_UNKNOWN)

    return bind(code, character)


def _table(texts: dict[str, str]) -> Column:
    """A map from one literal, which the planner reads once."""
    return F.from_json(F.lit(json.dumps(texts)), "map<string,string>")


def decode_references(text: Column) -> Column:
    """All numbered and named character references; unknown names stay as they are."""

    def character(reference: Column) -> Column:
        # a map is searched from its start: the frequent names have one of their own
        tables = (F.element_at(_table(names), reference) for names in (_FREQUENT, _NAMED))
        named = F.coalesce(*tables, reference)
        return F.when(reference.startswith("&#"), _numbered_character(reference)).otherwise(named)

    def decoded(own: Column) -> Column:
        return F.when(own.contains("&"), _segments(own, REFERENCE, lambda t: t, character)).otherwise(own)

    return bind(text, decoded)


def _flat_text(html: Column) -> Column:
    def ruled(pattern: str, replacement: str, marks: tuple[str, ...]):
        return lambda text: F.when(
            _holds(text, marks), F.regexp_replace(text, pattern, replacement)
        ).otherwise(text)

    html = bind(html, lambda own: _segments(own, ORDERED_LIST, lambda text: text, _numbered, ("<ol",)))
    for rule, marks in zip(FLAT_RULES, FLAT_MARKS, strict=True):
        html = bind(html, ruled(*rule, marks))
    return decode_references(html)


def flat_markdown(html: Column) -> Column:
    """Markdown of clean, flat HTML, not yet trimmed. Tables stay as they are."""

    def kept(table: Column) -> Column:
        return F.concat(F.lit("\n\n"), table, F.lit("\n\n"))

    return bind(html, lambda own: _segments(own, TABLE, _flat_text, kept, ("<ta",)))


def plain_or_needed(html: Column) -> Column:
    """Struct of `needed`, whether the element renderer is, and else `plain`, the flat
    Markdown. The markup is stripped once, whatever is asked of it."""

    def struct(stripped: Column) -> Column:
        def chosen(needed: Column) -> Column:
            plain = F.when(~needed, flat_markdown(strip_class_hints(stripped)))
            return F.struct(needed.alias("needed"), plain.alias("plain"))

        return bind(needs_element_renderer(stripped), chosen)

    return bind(strip_elements(html), struct)


def needs_element_renderer(html: Column) -> Column:
    """True where the flat rules do not hold: quotes, lists in lists, tables in
    tables, items without end tag, or a hinted element that holds another of its
    name or has no end tag."""

    def count(pattern: str) -> Column:
        return F.regexp_count(html, F.lit(pattern))

    def found(pattern: str) -> Column:
        return F.regexp_extract_all(html, F.lit(pattern), F.lit(0))

    nested_list = F.exists(found(LIST_ITEM), lambda item: item.rlike(r"(?i)<[uo]l\b"))
    open_items = count(r"(?i)<li\b") != count(r"(?i)</li\s*>")
    tables = count(r"(?i)<table\b") != F.size(found(TABLE))
    hinted = found(HINTED_ELEMENT)
    open_hint = count(HINTED_OPEN) != F.size(hinted)

    def holds_its_name(element: Column) -> Column:
        name = F.lower(F.regexp_extract(element, "^<([A-Za-z0-9]+)", 1))
        opening = F.concat(F.lit("<"), name, F.lit(r"\b"))
        return F.regexp_count(F.lower(element), opening) > 1

    return (
        html.rlike(r"(?i)<blockquote\b")
        | nested_list
        | open_items
        | tables
        | open_hint
        | F.exists(hinted, holds_its_name)
    )
