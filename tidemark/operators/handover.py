"""Handing documents to a sink outside the workspace, none of them twice.

A run cuts its documents into parts by id and gives the sink one part after the
other. Before a part is given away its documents are noted as intents; what the
sink says it stored is written down after. Both are tables of a folder of the run:

    intents/part=<p>/   id, hash, the file replaced, and the key of the intent
    stored/part=<p>/    (id, page_no, pos, file_id) as the sink returned them

A part is closed once its `stored` table is committed. A run that is done again,
after a loss or another run's commit, takes up what its closed parts say and gives
the sink the other documents only.

No log can tell what a sink did with a part that was open when the run was lost.
Its documents are given again, marked as `tried`, with the same `intent`: a sink
that keeps this key beside its files can look up just those.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.storage import delete_path, folder_names, written_folders

PLACE = ["id", "page_no", "pos"]
INTENT = "id long, page_no long, pos int, hash string, replaced string, intent string, part string"
STORED = "id long, page_no long, pos int, file_id string, part string"


def intent_key():
    """The same for a document and the file it replaces, whichever run asks for it."""
    known = F.coalesce("replaced", F.lit(""))
    return F.sha2(F.concat_ws("\n", F.col("id").cast("string"), "hash", known), 256)


def _table(spark: SparkSession, folder: str, schema: str, parts: list[str]) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], schema)
    paths = [f"{folder}/{part}" for part in parts]
    return spark.read.schema(schema).option("basePath", folder).parquet(*paths)


def receipts(spark: SparkSession, folder: str) -> DataFrame:
    """(id, hash, replaced, file_id) of all that closed parts stored."""
    closed = written_folders(spark, f"{folder}/stored")
    intents = _table(spark, f"{folder}/intents", INTENT, closed)
    stored = _table(spark, f"{folder}/stored", STORED, closed)
    joined = intents.join(stored.select(*PLACE, "part", "file_id"), [*PLACE, "part"])
    return joined.select("id", "hash", "replaced", "file_id")


def open_intents(spark: SparkSession, root: str) -> DataFrame:
    """Keys of the parts that no run below `root` has closed."""
    found = None
    for name in folder_names(spark, root):
        folder = f"{root}/{name}"
        closed = set(written_folders(spark, f"{folder}/stored"))
        left = [p for p in written_folders(spark, f"{folder}/intents") if p not in closed]
        if left:
            table = _table(spark, f"{folder}/intents", INTENT, left).select("intent")
            found = table if found is None else found.unionByName(table)
    return spark.createDataFrame([], "intent string") if found is None else found.distinct()


def forget(spark: SparkSession, folder: str) -> None:
    """Drop the notes of a committed run, unless one of its parts is still open."""
    closed = set(written_folders(spark, f"{folder}/stored"))
    if closed.issuperset(written_folders(spark, f"{folder}/intents")):
        delete_path(spark, folder)


def hand_over(scratch, staged, pending, sink, root, run, parts) -> tuple[DataFrame, str | None]:
    """Give the sink what `pending` lists and this run has not stored before; gives
    (id, page_no, pos, file_id) of all that is stored, and the error that ended it.

    `pending` has one row per id with its place, hash and `replaced` file; `staged`
    the documents. All joins but the one that picks the texts see narrow rows only.
    A sink that fails ends the hand-over; the parts closed before stand.
    """
    spark, folder = staged.sparkSession, f"{root}/{run}"
    done = scratch.staged(receipts(spark, folder), "receipts")
    todo = (
        pending.select(*PLACE, "hash", "replaced", intent_key().alias("intent"))
        .join(done.select("id", "hash"), ["id", "hash"], "left_anti")
        .join(open_intents(spark, root).withColumn("tried", F.lit(True)), "intent", "left")
        .withColumn("tried", F.coalesce("tried", F.lit(False)))
        .withColumn("slice", F.pmod(F.xxhash64("id"), F.lit(parts)))
    )
    todo = scratch.staged(todo, "intents")
    # One pass over the texts, whatever the number of parts.
    texts = staged.join(todo.select(*PLACE, "intent", "tried", "slice"), PLACE)
    texts = scratch.staged(texts, "handed", by="slice")
    error = None
    for number in range(parts):
        mine = todo.filter(F.col("slice") == number)
        if mine.isEmpty():
            continue
        part = f"part=p{uuid.uuid4().hex}"
        mine.select(*PLACE, "hash", "replaced", "intent").write.parquet(f"{folder}/intents/{part}")
        # Files that this run replaced in an earlier try are gone already.
        old = mine.filter(F.col("replaced").isNotNull()).select("id", F.col("replaced").alias("file_id"))
        gone = done.select("id", F.col("replaced").alias("file_id"))
        old = old.join(gone, ["id", "file_id"], "left_anti")
        try:
            stored = sink(texts.filter(F.col("slice") == number).drop("slice"), old)
            stored.select(*PLACE, "file_id").write.parquet(f"{folder}/stored/{part}")
        except Exception as failure:  # noqa: BLE001 - a sink may fail in any way
            error = str(failure)
            break
    stored = receipts(spark, folder).select("id", "hash", "file_id")
    stored = pending.select(*PLACE, "hash").join(stored, ["id", "hash"])
    return scratch.staged(stored.select(*PLACE, "file_id"), "stored"), error
