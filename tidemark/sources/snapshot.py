"""The snapshot: what the last run knew of every document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import SNAPSHOT, SNAPSHOT_JSON
from tidemark.storage import commit, path_exists, read_latest, state, write_version


def read_snapshot(spark: SparkSession, root: str, before: int | None = None) -> DataFrame:
    return read_latest(spark, root, SNAPSHOT, before)


def draft_snapshot(snapshot: DataFrame, root: str, version: int, replace: bool = False) -> str:
    """Full rewrite into a folder of its own, which `commit` makes the newest state."""
    return write_version(snapshot.select(SNAPSHOT.fieldNames()), root, version, replace)


def write_snapshot(snapshot: DataFrame, root: str, version: int, replace: bool = False) -> str:
    """Write a snapshot and make it the newest state, whatever that was before."""
    spark = snapshot.sparkSession
    path = draft_snapshot(snapshot, root, version, replace)
    while not commit(spark, root, version, state(spark, root)):
        pass
    return path


def read_snapshot_json(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Snapshot from its JSON form. A missing or unreadable file is empty.

    Each line holds a part of the map, the form `write_snapshot_json` writes;
    `multi_line` reads one indented file, which one task has to hold.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], SNAPSHOT)
    files = spark.read.schema(SNAPSHOT_JSON).option("multiLine", multi_line).json(path)
    entries = files.select(F.explode("articles").alias("key", "entry"))
    return entries.select(
        F.col("key").try_cast("bigint").alias("id"),
        F.col("entry.hash").alias("hash"),
        F.col("entry.slug").alias("slug"),
        F.col("entry.updatedAt").alias("updated_at"),
        F.col("entry.fileId").alias("file_id"),
        F.lit(None).cast("string").alias("renderer_version"),
        F.when(F.col("entry.fileId").isNotNull(), F.col("entry.hash")).alias("embedded_hash"),
    )


def snapshot_json(snapshot: DataFrame) -> DataFrame:
    """One JSON line per entry, so that no task has to hold the whole map."""
    entry = F.struct(
        "hash",
        "slug",
        F.col("updated_at").alias("updatedAt"),
        F.col("file_id").alias("fileId"),
    )
    line = F.struct(F.create_map(F.col("id").cast("string"), entry).alias("articles"))
    return snapshot.select(F.to_json(line, {"ignoreNullFields": "false"}).alias("value"))


def write_snapshot_json(snapshot: DataFrame, path: str) -> None:
    snapshot_json(snapshot).write.mode("overwrite").text(path)


def is_valid_json(raw: Column) -> Column:
    """Strict JSON; `from_json` would also take single-quoted text."""
    return F.try_parse_json(raw).isNotNull()
