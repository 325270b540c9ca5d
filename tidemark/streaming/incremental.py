"""Run-once incremental sync as a stream of page dumps."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.sync import RunOptions, Workspace, run
from tidemark.schemas import PAGE
from tidemark.sources.pages import articles_of, with_page_number


def page_dump_stream(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    pages = spark.readStream.schema(PAGE).option("multiLine", multi_line).json(path)
    return with_page_number(pages)


def batch_run(checkpoint: str, batch_id: int) -> str:
    """Name of the run of a stream's batch, the same whenever the batch is replayed."""
    return f"{hashlib.sha256(checkpoint.encode()).hexdigest()[:16]}-{batch_id}"


def sync_new_pages(
    pages: DataFrame,
    workspace: Workspace,
    checkpoint: str,
    options: RunOptions = RunOptions(),
    to_articles: Callable[[DataFrame], DataFrame] = articles_of,
) -> StreamingQuery:
    """Sync every page that arrived since the last call, then stop.

    Each batch is one run, which claims its version like any other run of the
    workspace. The checkpoint holds which pages were seen; if a batch is replayed
    after a loss, its run has the same name, goes on from the newest snapshot and
    replaces its own output only.
    """

    def sync_batch(batch: DataFrame, batch_id: int) -> None:
        name = batch_run(checkpoint, batch_id)
        run(batch.sparkSession, to_articles(batch), workspace, options, run_id=name)

    return (
        pages.writeStream.foreachBatch(sync_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
