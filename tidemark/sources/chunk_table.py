"""The chunk table as an upload target."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.chunking import MAX_TOKENS, OVERLAP_TOKENS, chunk_rows, live_chunks
from tidemark.schemas import CHUNK
from tidemark.storage import read_all, versions, write_version

# A sink takes the changed documents, one per id, and the (id, file_id) they
# replace. It returns (id, page_no, pos, file_id) of those it really stored.
Sink = Callable[[DataFrame, DataFrame], DataFrame]


def table_sink(
    root: str,
    version: int,
    max_tokens: int = MAX_TOKENS,
    overlap: int = OVERLAP_TOKENS,
    replace: bool = False,
) -> Sink:
    """Write the documents' chunks as a version of the table below `root`.

    Old chunks are not touched: they stop being live when the snapshot names
    the new file. A failed run therefore takes nothing away.
    """

    def store(documents: DataFrame, replaced: DataFrame) -> DataFrame:
        file_id = F.concat_ws("_", F.lit("file"), F.lit(version), F.col("id").cast("string"))
        named = documents.withColumn("file_id", file_id)
        write_version(chunk_rows(named, max_tokens, overlap), root, version, replace)
        return named.select("id", "page_no", "pos", "file_id")

    return store


def read_chunks(spark: SparkSession, root: str, snapshot: DataFrame) -> DataFrame:
    """The live chunks."""
    return live_chunks(read_all(spark, root, CHUNK).drop("version"), snapshot)


def compact(spark: SparkSession, root: str, target: str, snapshot: DataFrame) -> str:
    """Copy the live chunks to a table below `target`, leaving replaced ones behind."""
    newest = versions(spark, root)[-1]
    return write_version(read_chunks(spark, root, snapshot), target, newest)
