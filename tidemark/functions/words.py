"""Words of a text, counted without leaving its row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD_BREAK = r"[^\p{L}\p{N}]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), WORD_BREAK), "")


def distinct_words(text: Column) -> Column:
    return F.array_distinct(words(text))


def bind(value: Column, use) -> Column:
    """`use(value)` with `value` computed once however often it is named."""
    return F.element_at(F.transform(F.array(value), use), 1)


def word_counts(text: Column) -> Column:
    """Array of (term, tf), one entry per distinct word.

    The words are sorted and each run of equal words is measured by where it
    and the next run start, so counting needs no shuffle.
    """

    def runs(sorted_words: Column) -> Column:
        n = F.size(sorted_words)
        places = F.sequence(F.lit(1), n)
        starts = F.filter(
            places,
            lambda i: (i == 1)
            | (F.get(sorted_words, i - 1) != F.get(sorted_words, i - F.lit(2))),
        )

        def measure(starts_: Column) -> Column:
            return F.transform(
                starts_,
                lambda start, i: F.struct(
                    F.get(sorted_words, start - 1).alias("term"),
                    (F.coalesce(F.get(starts_, i + 1), n + 1) - start).alias("tf"),
                ),
            )

        return F.when(n > 0, bind(starts, measure))

    return bind(F.sort_array(words(text)), runs)
