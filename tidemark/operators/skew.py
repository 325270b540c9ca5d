"""Joins and order-dependent lookups that hold when one key has a third of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT_SHARE = 0.01
SALTS = 64

# Order steps (pages of a crawl) one task looks at for one key.
SEGMENT = 1_000


def hot_keys(rows: DataFrame, key: str, share: float = HOT_SHARE) -> list:
    """Every key with more than `share` of the rows.

    A sketch of at most `1/share` values holds them all; counting those drops
    its false alarms. Both lists are that short, so they are safe on the driver.
    """
    keys = rows.select(key).filter(F.col(key).isNotNull())
    found = keys.freqItems([key], share).first()
    if not found or not found[0]:
        return []
    least = keys.count() * share
    counted = keys.filter(F.col(key).isin(found[0])).groupBy(key).count()
    return [row[key] for row in counted.filter(F.col("count") > least).collect()]


def salted_left_join(
    left: DataFrame, right: DataFrame, key: str, hot: list, spread: list[str]
) -> DataFrame:
    """`left` LEFT JOIN `right`, with `right` unique by `key`.

    Rows of hot keys are spread over `SALTS` tasks by the `spread` columns, and
    only the matching right rows (one per hot key) are copied that often.
    """
    if not hot:
        return left.join(right, key, "left")
    is_hot = F.col(key).isin(hot)
    one, salts = F.array(F.lit(0)), F.sequence(F.lit(0), F.lit(SALTS - 1))
    salt = F.pmod(F.hash(*spread), F.lit(SALTS))
    salted = left.withColumn("_salt", F.when(is_hot, salt).otherwise(0))
    copied = right.withColumn("_salt", F.explode(F.when(is_hot, salts).otherwise(one)))
    return salted.join(copied, [key, "_salt"], "left").drop("_salt")


def with_previous(
    rows: DataFrame, key: str, step: str, within: str, value: str, name: str
) -> DataFrame:
    """Add `name`: the `value` of the row before this one with the same key, in
    the order of (`step`, `within`).

    A plain `lag` would bring all rows of a key into one task. Here each
    segment of steps looks back on its own, and a first row takes the last
    value of the nearest earlier segment, of which there is one row each.
    """
    rows = rows.withColumn("_segment", F.floor(F.col(step) / F.lit(SEGMENT)))
    place = F.struct(step, within)
    by_segment = Window.partitionBy(key, "_segment").orderBy(step, within)
    local = rows.withColumn("_local", F.lag(value).over(by_segment))
    ends = rows.groupBy(key, "_segment").agg(F.max_by(value, place).alias("_end"))
    by_key = Window.partitionBy(key).orderBy("_segment")
    starts = ends.select(key, "_segment", F.lag("_end").over(by_key).alias("_before"))
    return (
        local.join(starts, [key, "_segment"], "left")
        .withColumn(name, F.coalesce("_local", "_before"))
        .drop("_segment", "_local", "_before")
    )


def last_by(rows: DataFrame, key: str, place: Column) -> DataFrame:
    """The last row of each key. It is an aggregate, so each task first reduces
    its own rows and a frequent key is never gathered."""
    columns = [c for c in rows.columns if c != key]
    last = F.max_by(F.struct(*columns), place).alias("_last")
    return rows.groupBy(key).agg(last).select(key, "_last.*")


def rows_with_keys(wide: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """The rows of `wide` whose key is in `keys`, which must be a written table.

    `wide` carries document text. As the size of the narrow list is known, Spark
    sends it to the tasks while it is small and shuffles both sides beyond that.
    A null in a key meets a null.
    """
    same = [wide[c].eqNullSafe(keys[c]) for c in on]
    return wide.join(keys.select(on), same, "left_semi")
