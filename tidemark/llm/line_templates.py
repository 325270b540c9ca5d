"""Operator 8. Line dedup with a fixed-depth tree of line templates.

A line's fields are what spaces part. A field with a digit or @ is variable and
generalised to `<*>`. The tree is parsed to a fixed depth: first by the number
of fields, then by the two leading fields; its leaves are the templates. A
template met in two or more documents recurs: its lines stay in the document
with the smallest id and are dropped from all others.

That is the plain rule, in which the tree path follows from the masked line and
lines of few fields are left alone. With `whole`, as operator 8's query and the
pipeline ask, all lines that are not blank take part, fields are what any white
space parts, and

    letter fields   the lines of a tree node (number of fields, two leading
                    fields) are counted by place and word. Places where one word
                    has less than `CONSTANT` of the node's distinct lines are
                    generalised too. What is left is a template if at least
                    `SIMILAR` of its fields are constant words and lines that
                    agree with them are in `GUARDED_DOCS` documents or more.
    short lines     of fewer than `MIN_FIELDS` fields and `MIN_CHARS` characters
                    recur from `GUARDED_DOCS` documents on. Those that are in
                    fewer, but two at least, only go with a document of which
                    nothing else would be left.
    data lines      without a constant field are compared as they are. Templates
                    with fewer constant fields than variable ones recur from
                    `GUARDED_DOCS` documents on.

Only functions of Spark SQL are used. Per template the smallest and the largest
document id are kept, which each task aggregates before the shuffle, so a line
that a third of all documents share is one row per task. Lines meet the templates
and nodes of a `HOT`-th of all lines or more, which cannot be more than `HOT`, where
they are read; only the others are shuffled by their key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.words import bind
from tidemark.session import staged

#: Lines of fewer fields than this are left alone, or guarded.
MIN_FIELDS = 4
#: A line of this many characters is not short, whatever its fields.
MIN_CHARS = 20
#: Documents that hold a template which says little by itself.
GUARDED_DOCS = 10
CONSTANT, SIMILAR = 0.9, 0.6
VARIABLE = r"(?<![^ \t\r])[^ \t\r0-9@]*+[0-9@][^ \t\r]*+"
WHITE = r"\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LEADING = 2
#: Templates or nodes with a larger part of the lines than one in this many are sent
#: to the lines.
HOT = 1000
PATH = ["fields", "lead", "leaf"]


def template(line: Column) -> Column:
    return F.when(line.rlike("[0-9@]"), F.regexp_replace(line, VARIABLE, "<*>")).otherwise(line)


def parsed_lines(docs: DataFrame) -> DataFrame:
    """`doc_id`, `text_hash`, `pos` and tree path (`fields`, `lead`, `leaf`) of every
    line with enough fields."""
    lines = docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        F.posexplode(F.split("text", "\n")).alias("pos", "line"),
    )
    templates = lines.withColumn("line", template(F.col("line")))
    return templates.select(
        "doc_id",
        "text_hash",
        "pos",
        F.size(F.split("line", " ")).alias("fields"),
        F.xxhash64(F.substring_index("line", " ", LEADING)).alias("lead"),
        F.xxhash64("line").alias("leaf"),
    ).where(F.col("fields") >= MIN_FIELDS)


def meet(lines: DataFrame, keyed: DataFrame, keys: list[str], n_lines: int) -> DataFrame:
    """Inner join of `lines` with `keyed`, a written table that has one row and `n_rows`,
    the number of its lines, for each key; no more than `n_lines` in all.

    Lines are told apart by hashes of the hot keys, `HOT` at most: a key with the hash
    of a hot one is sent to the lines as well.
    """
    name = F.xxhash64(*keys)
    hashes = [r[0] for r in keyed.where(F.col("n_rows") * HOT >= n_lines).select(name).distinct().collect()]
    is_hot = name.isin(hashes) if hashes else F.lit(False)
    hot, cold = keyed.where(is_hot).drop("n_rows"), keyed.where(~is_hot).drop("n_rows")
    rest = lines.where(~is_hot).join(cold, keys)
    return lines.where(is_hot).join(F.broadcast(hot), keys).unionByName(rest)


def recurring(parsed: DataFrame) -> DataFrame:
    """Tree path, `first_doc` and `n_rows` of every template met in two documents or more."""
    return (
        parsed.groupBy("fields", "lead", "leaf")
        .agg(
            F.min("doc_id").alias("first_doc"),
            F.max("doc_id").alias("last_doc"),
            F.count("*").alias("n_rows"),
        )
        .where(F.col("first_doc") < F.col("last_doc"))
        .drop("last_doc")
    )


def guarded_lines(docs: DataFrame) -> DataFrame:
    """`parsed_lines` of all lines that are not blank, with `guarded` and the
    `template`, which is null for lines without a constant field."""

    def single(line: Column) -> Column:
        # most lines have no other white space than single spaces
        odd = line.rlike("[^!-~ ]|  ")
        return F.trim(F.when(odd, F.regexp_replace(line, f"[{WHITE}]+", " ")).otherwise(line))

    def path(words: Column, variable: Column, key: Column) -> Column:
        fields = F.size(words)
        short = (fields < MIN_FIELDS) & (F.length(key) < MIN_CHARS)
        few = (variable < fields) & (2 * variable > fields)
        return F.struct(
            fields.alias("fields"),
            F.xxhash64(F.substring_index(key, " ", LEADING)).alias("lead"),
            F.xxhash64(key).alias("leaf"),
            (short | few).alias("guarded"),
            # data lines are never generalised
            F.when(variable < fields, key).alias("template"),
        )

    def parsed(one: Column, masked: Column, words: Column) -> Column:
        def counted(variable: Column) -> Column:
            key = F.when(variable == F.size(words), one).otherwise(masked)
            return bind(key, lambda own: path(words, variable, own))

        return bind(F.size(F.filter(words, lambda word: word == "<*>")), counted)

    def read(line: Column) -> Column:
        def masked(one: Column, own: Column) -> Column:
            return bind(F.split(own, " "), lambda words: parsed(one, own, words))

        def known(one: Column) -> Column:
            return F.when(one != "", bind(template(one), lambda own: masked(one, own)))

        return bind(single(line), known)

    # text is read once a document, not once for each column of its lines
    lines = docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        F.transform(F.split("text", "\n"), read).alias("lines"),
    )
    lines = lines.select("doc_id", "text_hash", F.posexplode_outer("lines").alias("pos", "line"))
    return lines.where(F.col("line").isNotNull()).select("doc_id", "text_hash", "pos", "line.*")


def recurring_guarded(parsed: DataFrame) -> DataFrame:
    """`recurring` of guarded lines; `strong` if in documents enough."""
    return (
        parsed.groupBy(*PATH)
        .agg(
            F.min("doc_id").alias("first_doc"),
            F.count_distinct("doc_id").alias("n_docs"),
            F.count("*").alias("n_rows"),
        )
        .where(F.col("n_docs") > 1)
        .select(*PATH, "first_doc", "n_rows", (F.col("n_docs") >= GUARDED_DOCS).alias("strong"))
    )


def generalised(parsed: DataFrame) -> DataFrame:
    """`doc_id`, `text_hash`, `pos` of lines to drop by templates with variable words."""
    node = PATH[:2]
    lines = parsed.where((F.col("fields") >= MIN_FIELDS) & F.col("template").isNotNull())
    open_nodes = (
        lines.groupBy(*node)
        .agg(
            F.min("leaf").alias("low"),
            F.max("leaf").alias("high"),
            F.count_distinct("doc_id").alias("n_docs"),
            F.count("*").alias("n_rows"),
        )
        .where((F.col("low") < F.col("high")) & (F.col("n_docs") >= GUARDED_DOCS))
        .select(*node, "n_rows")
    )
    open_nodes = staged(open_nodes, "line-open-nodes")
    lines = staged(meet(lines, open_nodes, node, parsed.count()), "line-nodes")
    n_lines = lines.count()
    leaves = lines.groupBy(*PATH).agg(F.any_value("template").alias("template"))
    constant = (
        leaves.select(*node, F.posexplode(F.split("template", " ")).alias("place", "word"))
        .groupBy(*node, "place", "word")
        .count()
        .groupBy(*node, "place")
        .agg(
            F.max_by("word", "count").alias("word"),
            F.max("count").alias("most"),
            F.sum("count").alias("all"),
        )
        .where((F.col("most") >= CONSTANT * F.col("all")) & (F.col("word") != "<*>"))
    )
    templates = (
        constant.groupBy(*node)
        .agg(F.collect_list(F.struct("place", "word")).alias("constant"))
        .where(F.size("constant") >= SIMILAR * F.col("fields"))
    )
    templates = staged(templates.join(open_nodes, node), "line-node-templates")
    words = F.split("template", " ")
    agrees = F.forall("constant", lambda c: F.get(words, c["place"]) == c["word"])
    matched = meet(lines, templates, node, n_lines).where(agrees)
    matched = staged(matched.select("doc_id", "text_hash", "pos", *node), "line-matches")
    first = (
        matched.groupBy(*node)
        .agg(
            F.min("doc_id").alias("first_doc"),
            F.count_distinct("doc_id").alias("n_docs"),
            F.count("*").alias("n_rows"),
        )
        .where(F.col("n_docs") >= GUARDED_DOCS)
        .drop("n_docs")
    )
    return (
        meet(matched, staged(first, "line-first"), node, matched.count())
        .where(F.col("doc_id") > F.col("first_doc"))
        .select("doc_id", "text_hash", "pos")
    )


def drop_recurring_lines(docs: DataFrame, counts: bool = False, whole: bool = False) -> DataFrame:
    """`docs` with recurring lines cut from `text`, by the rules above with `whole`.

    With `counts`, also `n_lines` and `n_dropped`. A null text stays null and has
    no lines; a text whose lines are all dropped becomes empty. Rows without a
    `doc_id` are left as they are and count for no template. Rows that repeat an
    id are one document: none of them is first, and a template that only they
    hold does not recur. All other columns stay, but
    for those named like the counts asked for. An empty
    table stays empty.
    """
    read = guarded_lines if whole else parsed_lines
    parsed = staged(read(docs.select("doc_id", "text")), "line-templates")
    if whole:
        known = recurring(parsed.where(~F.col("guarded"))).withColumn("strong", F.lit(True))
        known = known.unionByName(recurring_guarded(parsed.where("guarded")))
    else:
        known = recurring(parsed).withColumn("strong", F.lit(True))
    known = staged(known, "line-recurring")
    places = (
        meet(parsed, known, PATH, parsed.count())
        .where(F.col("doc_id") > F.col("first_doc"))
        .select("doc_id", "text_hash", "pos", "strong")
    )
    if whole:
        places = places.unionByName(generalised(parsed).withColumn("strong", F.lit(True)))
    found = (
        # repeated rows hold the same place more than once
        places.groupBy("doc_id", "text_hash")
        .agg(
            F.collect_set(F.when(F.col("strong"), F.col("pos"))).alias("__dropped"),
            F.collect_set("pos").alias("__all"),
        )
        .select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), "__dropped", "__all")
    )
    # the lines cross the join as they are, so they are split once a document
    split = docs.select(
        *[c for c in docs.columns if c != "text"],
        F.xxhash64("text").alias("__text_hash"),
        F.split("text", "\n").alias("__lines"),
    )
    joined = split.join(
        found,
        (F.col("doc_id") == F.col("__id")) & (F.col("__text_hash") == F.col("__hash")),
        "left",
    )
    places = F.sequence(F.lit(0), F.size("__lines") - 1)
    if whole:
        others = F.array_except(places, "__all")
        blank = F.forall(others, lambda i: ~F.element_at("__lines", i + 1).rlike(f"[^{WHITE}]"))
        husk = (F.size("__dropped") > 0) & blank
        joined = joined.withColumn(
            "__dropped", F.when(husk, F.col("__all")).otherwise(F.col("__dropped"))
        )
    kept = F.transform(
        F.array_except(places, "__dropped"), lambda i: F.element_at("__lines", i + 1)
    )
    text = F.array_join(F.when(F.col("__dropped").isNull(), F.col("__lines")).otherwise(kept), "\n")
    added = []
    if counts:
        added = [
            F.greatest(F.size("__lines"), F.lit(0)).cast("long").alias("n_lines"),
            F.greatest(F.size("__dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        ]
        docs = docs.drop("n_lines", "n_dropped")
    return joined.select(*[text.alias("text") if c == "text" else c for c in docs.columns], *added)
