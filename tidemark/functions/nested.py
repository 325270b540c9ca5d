"""Markdown of nested HTML as columns: no Python worker reads the markup.

Two steps that regular expressions alone cannot take are folds over arrays:

`drop_hinted`     walks over the tags of a text with the name and depth of the
                  element it is leaving out, and notes where to cut.
`nested_markdown` renders lists and quotes from the inside outwards: each round
                  rewrites those that hold no other, as often as they are nested.

Defined results: a hinted element without end reaches to the end of the text, but
an item or a paragraph only to where HTML ends it; lists and quotes without end are
closed by the end of the text; items outside of lists and holders that overlap are
read by the flat rules; tables stay as they are; null is empty.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.html import (
    _HINTED_OPEN,
    FLAT_RULES,
    TABLE,
    _flat_text,
    _segments,
    strip_elements,
)
from tidemark.functions.words import bind

_TOKEN = r"(?s)<!--.*?-->|</?[A-Za-z][^>]*>|[^<]+|<"
_NAME = "^</?([A-Za-z][A-Za-z0-9]*)"
_VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "wbr")
# What ends an open paragraph, at its start or end tag.
_ENDS_PARAGRAPH = (
    "address", "article", "aside", "blockquote", "div", "dl", "fieldset", "figure", "form", "h1",
    "h2", "h3", "h4", "h5", "h6", "hr", "li", "main", "ol", "pre", "section", "table", "ul",
)

# Elements that need no end tag: (names, what holds them, start tags that end them,
# end tags that end them beside those of what holds them).
_ITEMS = (
    (("li",), ("ul", "ol"), ("li",), ()),
    (("dt", "dd"), ("dl",), ("dt", "dd"), ()),
    (("td", "th"), ("table",), ("td", "th", "tr", "tbody", "tfoot"), ("tr", "tbody", "tfoot", "thead")),
    (("tr",), ("table",), ("tr", "tbody", "tfoot"), ("tbody", "tfoot", "thead")),
    (("option",), ("select",), ("option", "optgroup"), ("optgroup",)),
)

_HOLDER = "ul|ol|blockquote"
# A list or quote that holds no other. Possessive, so that long texts need no stack.
_INNERMOST = (
    rf"(?is)<({_HOLDER})\b[^>]*+>[^<]*+(?:<(?!/?(?:{_HOLDER})\b)[^<]*+)*+</\1\s*>"
)
# Stands for a table while the text around it is rendered.
_MARK = ""


def _tag(token: Column) -> Column:
    """Name, empty for text; whether it is an end tag; whether it opens a hinted element."""
    is_tag = token.rlike("^</?[A-Za-z]")
    name = F.when(is_tag, F.lower(F.regexp_extract(token, _NAME, 1))).otherwise("")
    opens = is_tag & token.rlike("(?is)^" + _HINTED_OPEN) & ~name.isin(*_VOID) & ~token.endswith("/>")
    return F.struct(name.alias("name"), token.startswith("</").alias("end"), opens.alias("hinted"))


def _walk(state: Column, tag: Column) -> Column:
    """One tag further. `name` is the element that is left out, empty outside of one;
    `depth` counts its name, `inner` what holds items of its kind inside of it; `cuts`
    holds by turns the token where an element starts and the one after its end."""
    here, name, inner = state["at"], state["name"], state["inner"]
    same = (name != "") & (tag["name"] == name)
    item, holder, ends = F.lit(False), F.lit(False), F.lit(False)
    for names, holders, starts, stops in _ITEMS:
        of_kind = name.isin(*names)
        item = item | of_kind
        holder = holder | (of_kind & tag["name"].isin(*holders))
        stop = F.when(tag["end"], tag["name"].isin(*holders, *stops)).otherwise(tag["name"].isin(*starts))
        ends = ends | (of_kind & stop)
    item_ends = ends & (inner == 0)
    paragraph_ends = (name == "p") & (
        tag["name"].isin(*_ENDS_PARAGRAPH) | ((tag["name"] == "p") & ~tag["end"])
    )
    implied = item_ends | paragraph_ends
    closed = same & tag["end"] & (state["depth"] == 1) & (inner == 0)
    opening = ((name == "") | implied) & tag["hinted"]
    step = F.when(tag["end"], -1).otherwise(1)
    new_cuts = F.concat(
        state["cuts"],
        F.when(implied, F.array(here)).otherwise(F.array().cast("array<int>")),
        F.when(opening, F.array(here)).otherwise(F.array().cast("array<int>")),
        F.when(closed, F.array(here + 1)).otherwise(F.array().cast("array<int>")),
    )
    further = F.struct(
        (here + 1).alias("at"),
        F.when(opening, tag["name"]).when(implied | closed, "").otherwise(name).alias("name"),
        F.when(opening, 1)
        .when(same & ~item, state["depth"] + step)
        .otherwise(state["depth"])
        .alias("depth"),
        F.when(opening | implied | closed, 0)
        .when(holder, inner + step)
        .otherwise(inner)
        .alias("inner"),
        F.when(implied | opening | closed, new_cuts).otherwise(state["cuts"]).alias("cuts"),
    )
    # Most of a text is kept, or is text: nothing to decide.
    same_state = [state[field].alias(field) for field in ("name", "depth", "inner", "cuts")]
    quiet = F.when(name == "", ~tag["hinted"]).otherwise(tag["name"] == "")
    return F.when(quiet, F.struct((here + 1).alias("at"), *same_state)).otherwise(further)


def drop_hinted(html: Column) -> Column:
    """Drop elements whose class holds a hint, with all they hold, also others of
    their own name."""
    start = F.struct(
        F.lit(0).alias("at"),
        F.lit("").alias("name"),
        F.lit(0).alias("depth"),
        F.lit(0).alias("inner"),
        F.array().cast("array<int>").alias("cuts"),
    )

    def without(tokens: Column) -> Column:
        def kept(end: Column) -> Column:
            last = F.when(end["name"] == "", F.array(F.size(tokens))).otherwise(F.array().cast("array<int>"))
            return F.concat(F.array(F.lit(0)), end["cuts"], last)

        def joined(bounds: Column) -> Column:
            stretches = F.sequence(F.lit(0), (F.size(bounds) / 2).cast("int") - 1)

            def text(k: Column) -> Column:
                first, after = F.get(bounds, k * 2), F.get(bounds, k * 2 + 1)
                return F.array_join(F.slice(tokens, first + 1, after - first), "")

            return F.array_join(F.transform(stretches, text), "")

        return bind(F.aggregate(F.transform(tokens, _tag), start, _walk, kept), joined)

    def cleaned(own: Column) -> Column:
        tokens = F.regexp_extract_all(own, F.lit(_TOKEN), F.lit(0))
        return F.when(own.rlike("(?is)" + _HINTED_OPEN), bind(tokens, without)).otherwise(own)

    return bind(html, cleaned)


def _inline(html: Column) -> Column:
    """The flat rules on what a list item or quote holds; references stay."""
    for pattern, replacement in FLAT_RULES:
        html = F.regexp_replace(html, pattern, replacement)
    return F.regexp_replace(F.regexp_replace(html, r"\A[ \t\r\n]+|[ \t\r\n]+\z", ""), r"\n{3,}", "\n\n")


def _list(element: Column, body: Column) -> Column:
    """Items start where `<li>` does, so that they need no end tag. What goes on in
    a further line is indented, a list in an item follows it without a blank line."""
    first = F.regexp_extract(element, r"(?i)^<ol\b[^>]*\bstart\s*=\s*[\"']?([0-9]{1,8})\b", 1)
    first = F.when(first == "", 1).otherwise(F.try_to_number(first, F.lit("99999999")).cast("int"))
    ordered = F.lower(F.substring(element, 1, 3)) == "<ol"

    def line(item: Column, i: Column) -> Column:
        mark = F.when(ordered, F.concat((first + i).cast("string"), F.lit(".  "))).otherwise("*   ")
        text = F.regexp_replace(_inline(item), r"\n{2,}(?=(?:\*| *[0-9]+\.) {2,3}\S)", "\n")
        return F.concat(mark, F.regexp_replace(text, r"\n(?=[^\n])", "\n    "), F.lit("\n"))

    def joined(pieces: Column) -> Column:
        items = F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0)))
        lines = F.array_join(F.transform(items, line), "")
        before = _inline(F.get(pieces, F.lit(0)))
        lead = bind(before, lambda own: F.when(own == "", "").otherwise(F.concat(own, F.lit("\n\n"))))
        return F.concat(lead, lines)

    return bind(F.split(body, r"(?i)<li\b[^>]*>"), joined)


def _holder(element: Column) -> Column:
    """Markdown of a list or quote that holds no other."""
    body = F.regexp_replace(element, r"(?s)\A<[^>]*>|</[A-Za-z]+\s*>\z", "")
    quote = F.lower(F.substring(element, 1, 3)) == "<bl"
    quoted = bind(_inline(body), lambda text: F.when(text == "", "").otherwise(F.regexp_replace(text, "(?m)^", "> ")))
    return F.concat(F.lit("\n\n"), F.when(quote, quoted).otherwise(_list(element, body)), F.lit("\n\n"))


def _closed(html: Column) -> Column:
    """Struct of `text`, in which the end of the text closes the lists and quotes still
    open, and `most`, how many of them are open at once at most."""
    tags = F.regexp_extract_all(html, F.lit(rf"(?i)</?(?:{_HOLDER})\b"), F.lit(0))
    names = F.transform(tags, lambda tag: F.lower(F.regexp_replace(tag, "<", "")))
    start = F.struct(F.array().cast("array<string>").alias("open"), F.lit(0).alias("most"))

    def step(state: Column, name: Column) -> Column:
        opened = state["open"]
        # innermost first: an end tag closes what was opened within, too
        place = F.array_position(opened, F.substring(name, 2, 20)).cast("int")
        closed = F.when(place > 0, F.slice(opened, place + 1, F.size(opened) - place)).otherwise(opened)
        now = F.when(name.startswith("/"), closed).otherwise(F.concat(F.array(name), opened))
        return F.struct(now.alias("open"), F.greatest(state["most"], F.size(now)).alias("most"))

    def finish(state: Column) -> Column:
        ends = F.transform(state["open"], lambda name: F.concat(F.lit("</"), name, F.lit(">")))
        text = F.concat(html, F.array_join(ends, ""))
        return F.struct(text.alias("text"), state["most"].alias("most"))

    return F.aggregate(names, start, step, finish)


def _rendered(html: Column) -> Column:
    def rewritten(text: Column) -> Column:
        return _segments(text, _INNERMOST, lambda t: t, lambda element: bind(element, _holder))

    def inside_out(closed: Column) -> Column:
        rounds = F.filter(F.sequence(F.lit(0), closed["most"]), lambda n: n > 0)
        return F.aggregate(rounds, closed["text"], lambda text, _: bind(text, rewritten))

    return bind(bind(bind(html, _closed), inside_out), _flat_text)


def nested_markdown(html: Column) -> Column:
    """Clean and render HTML whose lists, quotes and hinted elements may nest. Not yet
    trimmed."""

    def around_tables(own: Column) -> Column:
        tables = F.concat(F.regexp_extract_all(own, F.lit(TABLE), F.lit(0)), F.array(F.lit("")))
        texts = F.split(bind(F.array_join(F.split(own, TABLE), _MARK), _rendered), _MARK)
        kept = F.transform(
            tables, lambda t: F.when(t == "", "").otherwise(F.concat(F.lit("\n\n"), t, F.lit("\n\n")))
        )
        return F.array_join(F.zip_with(texts, kept, lambda text, table: F.concat(text, table)), "")

    own = F.translate(F.coalesce(html, F.lit("")), _MARK, "�")
    return bind(drop_hinted(strip_elements(own)), around_tables)
