"""Corpus and answer checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import u16_length

# What a leaked key looks like, and what marks a dummy one.
SECRET_PATTERN = r"sk-(proj-)?[A-Za-z0-9_-]{20,}"
PLACEHOLDERS = ("your", "xxx", "example", "changeme", "placeholder")
SHOWN_CHARS = 12

# Corpus size below which the gate fails, answer length from
# which a page counts as answered, bullets an answer may have.
MIN_DOCUMENTS = 30
ANSWER_LENGTH = 1500
MAX_BULLETS = 5

# The names reports know the checks by.
CORPUS_CHECK = "articles>={}"
SECRETS_CHECK = "no-hardcoded-secrets"
SNAPSHOT_CHECK = "snapshot-valid"

_BULLET = r"^\s*([-*•]|\d+\.)\s"


def secret_matches(texts: DataFrame, path: str, text: str, strict: bool = False) -> DataFrame:
    """One row per match, dummies included. `strict` wants the match to start
    a word, which drops hits inside hyphenated words such as `kiosk-...`."""
    pattern = (r"(?<![A-Za-z0-9])" if strict else "") + SECRET_PATTERN
    matches = F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))
    return texts.select(F.col(path).alias("path"), F.explode(matches).alias("secret"))


def without_placeholders(matches: DataFrame) -> DataFrame:
    return matches.filter(~F.lower("secret").rlike("|".join(PLACEHOLDERS)))


def redacted(matches: DataFrame) -> DataFrame:
    """Hits fit for a report: where, and only the first characters."""
    shown = F.concat(
        F.col("path").cast("string"),
        F.lit(": "),
        F.substring("secret", 1, SHOWN_CHARS),
        F.lit("..."),
    )
    return matches.select("path", shown.alias("hit"))


def hits_by_path(hits: DataFrame) -> DataFrame:
    """Hits of each document joined into one text. A document's hits are
    bounded by its length, so no group outgrows its source row."""
    joined = F.concat_ws("; ", F.array_sort(F.collect_list("hit")))
    return hits.groupBy("path").agg(F.count("*").alias("n_hits"), joined.alias("hits"))


def corpus_count(documents: DataFrame) -> DataFrame:
    return documents.agg(F.count("*").alias("n_documents"))


def _check(name: str, required: bool | Column, ok: Column, message: Column) -> list[Column]:
    required = required if isinstance(required, Column) else F.lit(required)
    return [
        F.lit(name).alias("name"),
        required.alias("required"),
        ok.alias("ok"),
        message.alias("message"),
    ]


def minimum_corpus_check(documents: DataFrame, minimum: int = MIN_DOCUMENTS) -> DataFrame:
    n = F.col("n_documents")
    message = F.concat(n.cast("string"), F.lit(f" documents, {minimum} at least"))
    return corpus_count(documents).select(
        *_check(CORPUS_CHECK.format(minimum), True, n >= minimum, message)
    )


def secrets_check(hits: DataFrame) -> DataFrame:
    """Passes without hits. The message counts hits and documents with any; the
    hits themselves are in the hit table, all of them."""
    by_path = hits.groupBy("path").agg(F.count("*").alias("n"))
    totals = by_path.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("n_documents")
    )
    n = F.col("n")
    message = F.when(n == 0, "no leaked keys").otherwise(
        F.concat(n.cast("string"), F.lit(" leaked keys in "), "n_documents", F.lit(" documents"))
    )
    return totals.select(*_check(SECRETS_CHECK, True, n == 0, message))


def snapshot_check(raw: DataFrame, text: str = "raw") -> DataFrame:
    """Over the snapshot's raw JSON parts: none is a skip, a broken one a
    required failure."""
    broken = F.count_if(F.try_parse_json(F.col(text)).isNull())
    totals = raw.agg(F.count("*").alias("n"), broken.alias("broken"))
    message = (
        F.when(F.col("n") == 0, "no snapshot so far, not checked")
        .when(F.col("broken") == 0, "all parts parse")
        .otherwise("some parts do not parse")
    )
    return totals.select(
        *_check(SNAPSHOT_CHECK, F.col("broken") > 0, F.col("broken") == 0, message)
    )


def combine_checks(*checks: DataFrame) -> DataFrame:
    """Checks of a gate, numbered in the order given."""
    numbered = [check.withColumn("position", F.lit(i)) for i, check in enumerate(checks)]
    return reduce(DataFrame.unionByName, numbered)


def gate_verdict(checks: DataFrame) -> DataFrame:
    unmet = F.col("required") & ~F.col("ok")
    return checks.agg(
        F.count("*").alias("n_checks"),
        F.count_if(unmet).alias("n_unmet"),
        (F.count_if(unmet) == 0).alias("passed"),
    )


def _in_order(item: Column) -> Column:
    """List of `item` over the checks, by position. Checks are a fixed few."""
    listed = F.array_sort(F.collect_list(F.struct("position", item.alias("item"))))
    return F.transform(listed, lambda entry: entry["item"])


def gate_summary(checks: DataFrame, documents: DataFrame) -> DataFrame:
    """One status line: verdict, corpus size, and `name=ok` or `name=x` of each
    required check."""
    unmet = F.count_if(F.col("required") & ~F.col("ok"))
    verdict = F.when(unmet == 0, "PASS").otherwise(
        F.concat(F.lit("FAIL ("), unmet.cast("string"), F.lit(" unmet)"))
    )
    flag = F.concat(F.col("name"), F.lit("="), F.when(F.col("ok"), "ok").otherwise("x"))
    flags = F.array_compact(_in_order(F.when(F.col("required"), flag)))
    size = F.concat(F.lit("articles="), corpus_count(documents).scalar().cast("string"))
    parts = F.concat_ws(" | ", verdict, size, F.concat_ws(", ", flags))
    return checks.agg(F.concat(F.lit("[gate] "), parts).alias("line"))


def gate_json(checks: DataFrame) -> DataFrame:
    passed = F.count_if(F.col("required") & ~F.col("ok")) == 0
    listed = _in_order(F.struct("name", "required", "ok", "message"))
    return checks.agg(
        F.to_json(F.struct(passed.alias("passed"), listed.alias("checks"))).alias("report")
    )


def is_cited(text: Column) -> Column:
    return text.contains("Article URL:") | text.rlike(r"\[\d+\]")


def is_answered(text: Column, terms: tuple[str, ...], min_length: int = ANSWER_LENGTH) -> Column:
    """Longer than `min_length` UTF-16 units and naming every topic term."""
    named = [text.contains(term) for term in terms]
    return reduce(Column.__and__, named, u16_length(text) > min_length)


def bullet_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, "\n"), lambda line: line.rlike(_BULLET)))


def over_bullet_cap(text: Column, cap: int = MAX_BULLETS) -> Column:
    return bullet_count(text) > cap
