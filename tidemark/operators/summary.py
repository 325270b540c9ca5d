"""Run totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.delta import ADDED, SKIPPED, UPDATED, is_changed


def run_mode(dry_run: Column, scrape_only: Column) -> Column:
    """Label of a run; a dry run stays one whatever else is set."""
    return F.when(dry_run, "dry_run").when(scrape_only, "scrape_only").otherwise("upload")


def status_counts() -> list[Column]:
    return [
        F.count_if(F.col("status") == status).alias(status.lower())
        for status in (ADDED, UPDATED, SKIPPED)
    ]


def estimated_chunks() -> Column:
    """Chunks the changed documents will make, whether or not they are written."""
    total = F.sum(F.when(is_changed(), F.col("est_chunks")))
    return F.coalesce(total, F.lit(0)).cast("long").alias("estimated_chunks")


def delta_totals(classified: DataFrame) -> DataFrame:
    """One row; zeros for an empty input."""
    return classified.agg(*status_counts(), estimated_chunks())


def files_embedded(results: DataFrame) -> DataFrame:
    return results.agg(F.count("file_id").alias("files_embedded"))


def run_summary(
    totals: DataFrame,
    dry_run: bool = False,
    scrape_only: bool = False,
    files_embedded: int | Column = 0,
    error: str | Column | None = None,
    store_id: str = "",
) -> DataFrame:
    """Totals, uploads, failures, mode and store of a run as one row.

    A run is failed when `failures` is not empty.
    """
    embedded = files_embedded if isinstance(files_embedded, Column) else F.lit(files_embedded)
    message = error if isinstance(error, Column) else F.lit(error).cast("string")
    failures = F.filter(
        F.array(F.create_map(F.lit("error"), message)), lambda f: f["error"].isNotNull()
    )
    return totals.select(
        "added",
        "updated",
        "skipped",
        embedded.cast("long").alias("files_embedded"),
        "estimated_chunks",
        failures.alias("failures"),
        run_mode(F.lit(dry_run), F.lit(scrape_only)).alias("mode"),
        F.lit(store_id).alias("store_id"),
    )


def is_failed() -> Column:
    return F.size("failures") > 0
