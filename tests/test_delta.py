import pytest
from pyspark.sql import Row, Window
from pyspark.sql import functions as F

from tidemark.operators import skew
from tidemark.operators.delta import (
    align_results,
    changed,
    classify,
    removed_documents,
    replaced_file_id,
    upsert_snapshot,
)
from tidemark.schemas import SNAPSHOT

DOCUMENT = "id long, hash string, page_no long, pos int"


def documents(spark, *rows):
    return spark.createDataFrame([(i, h, p, 0) for i, h, p in rows], DOCUMENT)


def snapshot(spark, *rows):
    return spark.createDataFrame([(i, h, "s", "t", f, None, h) for i, h, f in rows], SNAPSHOT)


def statuses(df):
    return [r.status for r in df.orderBy("page_no").collect()]


def test_added_then_skipped_then_updated(spark):
    empty, known = snapshot(spark), snapshot(spark, (1, "v1", "file_1"))
    assert statuses(classify(documents(spark, (1, "v1", 0)), empty, upload=False)) == ["ADDED"]
    assert statuses(classify(documents(spark, (1, "v1", 0)), known, upload=False)) == ["SKIPPED"]
    updated = classify(documents(spark, (1, "v2", 0)), known, upload=False)
    assert statuses(updated) == ["UPDATED"]
    assert updated.select(replaced_file_id().alias("f")).first().f == "file_1"
    assert changed(updated).count() == 1


def test_never_uploaded_counts_as_added_in_upload_mode_only(spark):
    known = snapshot(spark, (1, "v1", None), (2, "v1", None))
    rows = documents(spark, (1, "v1", 0), (2, "v2", 1))
    assert statuses(classify(rows, known, upload=True)) == ["ADDED", "UPDATED"]
    assert statuses(classify(rows, known, upload=False)) == ["SKIPPED", "UPDATED"]


def test_entry_without_hash_is_updated(spark):
    known = snapshot(spark, (1, None, "file_1"))
    assert statuses(classify(documents(spark, (1, "v1", 0)), known, upload=True)) == ["UPDATED"]


def test_repeats_compare_with_the_previous_one_when_sequential(spark):
    known = snapshot(spark, (1, "a", "file_1"))
    rows = documents(spark, (1, "a", 0), (1, "b", 1), (1, "b", 2), (1, "a", 5000), (2, "x", 5001), (2, "x", 5002))
    assert statuses(classify(rows, known, upload=False, sequential=True)) == [
        "SKIPPED", "UPDATED", "SKIPPED", "UPDATED", "ADDED", "SKIPPED",
    ]
    assert statuses(classify(rows, known, upload=False)) == [
        "SKIPPED", "UPDATED", "UPDATED", "SKIPPED", "ADDED", "ADDED",
    ]


def test_upsert_keeps_unmentioned_and_takes_the_last(spark):
    before = snapshot(spark, (1, "a", "f1"), (2, "b", None))
    recorded = spark.createDataFrame(
        [(2, "c", "s", "t", "f2", None, "c", 0, 0), (2, "d", "s", "t", "f3", None, "d", 1, 0)]
        + [(3, "e", "s", "t", None, None, "e", 0, 0)],
        "id long, hash string, slug string, updated_at string, file_id string,"
        "renderer_version string, embedded_hash string, page_no long, pos int",
    )
    after = upsert_snapshot(before, recorded).select("id", "hash", "file_id").orderBy("id")
    assert after.collect() == [(1, "a", "f1"), (2, "d", "f3"), (3, "e", None)]


def test_results_are_joined_by_place(spark):
    items = documents(spark, (1, "a", 0), (2, "b", 1)).withColumn("slug", F.lit("s"))
    results = spark.createDataFrame(
        [(2, 1, 0, "f2"), (1, 0, 0, "f1")], "id long, page_no long, pos int, file_id string"
    )
    found = {r.id: r.file_id for r in align_results(items, results).collect()}
    assert found == {1: "f1", 2: "f2"}


def test_removed_documents(spark):
    gone = removed_documents(snapshot(spark, (1, "a", "f"), (2, "b", "f")), documents(spark, (2, "b", 0)))
    assert [r.id for r in gone.collect()] == [1]


@pytest.fixture
def skewed(spark):
    """One id has a third of the rows."""
    return spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 100).cast("long").alias("id"),
        F.sha2((F.col("id") % 11).cast("string"), 256).alias("hash"),
        F.floor(F.col("id") / 10).alias("page_no"),
        (F.col("id") % 10).cast("int").alias("pos"),
    )


def test_hot_keys(spark, skewed):
    assert skew.hot_keys(skewed, "id") == [7]
    assert skew.hot_keys(skewed.filter("id <> 7"), "id") == []
    assert skew.hot_keys(skewed.limit(0), "id") == []


def test_salted_join_equals_plain_join(spark, skewed):
    right = skewed.select("id").distinct().filter(F.col("id") % 2 == 1).withColumn("x", F.col("id") * 2)
    salted = skew.salted_left_join(skewed, right, "id", [7], ["page_no", "pos"])
    plain = skewed.join(right, "id", "left")
    columns = plain.columns
    assert salted.select(columns).exceptAll(plain).isEmpty()
    assert plain.exceptAll(salted.select(columns)).isEmpty()


def test_salting_spreads_the_hot_key(spark, skewed):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        right = skewed.select("id").distinct()
        joined = skew.salted_left_join(skewed, right, "id", [7], ["page_no", "pos"])
        sizes = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert max(s["count"] for s in sizes) < 30_000 / 4 * 1.4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_previous_equals_lag(spark, skewed):
    by_id = Window.partitionBy("id").orderBy("page_no", "pos")
    expected = skewed.withColumn("before", F.lag("hash").over(by_id))
    found = skew.with_previous(skewed, "id", "page_no", "pos", "hash", "before")
    assert found.columns == expected.columns
    assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()


def test_previous_never_gathers_a_key(spark, skewed):
    found = skew.with_previous(skewed, "id", "page_no", "pos", "hash", "before")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "+- Window" in line or "Window [" in line]
    assert any("_segment" in w and "lag(hash" in w for w in windows)
    assert not any("lag(hash" in w and "_segment" not in w for w in windows)


def test_classify_is_the_same_with_and_without_salting(spark, skewed):
    known = spark.createDataFrame(
        [Row(id=7, hash=None, slug="s", updated_at="t", file_id="f", renderer_version=None, embedded_hash=None)],
        SNAPSHOT,
    )
    plain = classify(skewed, known, upload=True)
    salted = classify(skewed, known, upload=True, hot_ids=[7])
    assert plain.exceptAll(salted.select(plain.columns)).isEmpty()
    assert plain.count() == salted.count() == 30_000


def test_rows_with_keys_meets_nulls(spark):
    schema = "id long, page_no long, text string"
    wide = spark.createDataFrame([(1, None, "a"), (1, 2, "b"), (2, None, "c")], schema)
    keys = spark.createDataFrame([(1, None), (9, 9)], "id long, page_no long")
    rows = skew.rows_with_keys(wide, keys, ["id", "page_no"])
    assert [tuple(r) for r in rows.collect()] == [(1, None, "a")]
