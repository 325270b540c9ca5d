"""What changed since the last snapshot, and the next snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.skew import last_by, salted_left_join, with_previous

# The statuses of a document in a run.
ADDED = "ADDED"
UPDATED = "UPDATED"
SKIPPED = "SKIPPED"


def classify(
    documents: DataFrame,
    snapshot: DataFrame,
    *,
    upload: bool,
    sequential: bool = False,
    track_embedded: bool = False,
    hot_ids: list | None = None,
) -> DataFrame:
    """Add `status` and the snapshot's `prior_file_id`, `prior_embedded_hash`.

    `documents` needs `id, hash, page_no, pos`, `snapshot` one row per id. Pass
    only narrow columns: the rows are shuffled by id.

    `upload`: an unchanged document that was never uploaded counts as added.
    `sequential`: a repeated id is compared with its previous occurrence in
    this run, otherwise every occurrence with the snapshot.
    `track_embedded`: an unchanged document whose upload holds older text counts
    as updated. Otherwise a scrape-only run hides a change from later uploads.
    """
    known = snapshot.select(
        "id",
        F.col("hash").alias("_known_hash"),
        F.col("file_id").alias("prior_file_id"),
        F.lit(True).alias("_known"),
        F.col("embedded_hash").alias("prior_embedded_hash"),
    )
    if sequential:
        documents = with_previous(documents, "id", "page_no", "pos", "hash", "_previous")
    else:
        documents = documents.withColumn("_previous", F.lit(None).cast("string"))
    joined = salted_left_join(documents, known, "id", hot_ids or [], ["page_no", "pos"])

    before = F.coalesce("_previous", "_known_hash")
    seen = F.col("_previous").isNotNull() | F.coalesce("_known", F.lit(False))
    unchanged = before.eqNullSafe(F.col("hash"))
    status = F.when(~seen, ADDED).when(~unchanged, UPDATED)
    if upload:
        status = status.when(F.col("prior_file_id").isNull(), ADDED)
    if upload and track_embedded:
        status = status.when(~F.col("prior_embedded_hash").eqNullSafe(F.col("hash")), UPDATED)
    return joined.withColumn("status", status.otherwise(SKIPPED)).drop(
        "_previous", "_known_hash", "_known"
    )


def is_changed():
    return F.col("status").isin(ADDED, UPDATED)


def changed(classified: DataFrame) -> DataFrame:
    return classified.filter(is_changed())


def replaced_file_id():
    """The stored file an updated document replaces."""
    return F.when(F.col("status") == UPDATED, F.col("prior_file_id"))


def upsert_snapshot(snapshot: DataFrame, recorded: DataFrame) -> DataFrame:
    """The next snapshot: `recorded` entries replace those of the same id, the
    last of several wins, and ids not mentioned stay.

    One last-wins aggregate over old and new rows; no join, and a repeated id
    is reduced before the shuffle. `recorded` has the snapshot's columns and
    `page_no, pos`.
    """
    columns = [c for c in snapshot.columns if c != "id"]
    old = snapshot.select(
        "id", *columns, F.lit(-1).cast("long").alias("page_no"), F.lit(0).alias("pos")
    )
    new = recorded.select("id", *columns, F.col("page_no").cast("long"), F.col("pos"))
    last = last_by(old.unionByName(new), "id", F.struct("page_no", "pos"))
    return last.select("id", *columns)


def align_results(items: DataFrame, results: DataFrame) -> DataFrame:
    """Attach the file ids a sink returned, by document place, never by row order."""
    return items.join(results.select("id", "page_no", "pos", "file_id"), ["id", "page_no", "pos"])


def removed_documents(snapshot: DataFrame, documents: DataFrame) -> DataFrame:
    """Snapshot entries whose document is gone from the source. They stay in
    the snapshot; this only lists them."""
    return snapshot.join(documents.select("id"), "id", "left_anti")
