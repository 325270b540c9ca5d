"""One sync run: render, classify, store what changed, keep the new state."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.chunking import MAX_TOKENS, OVERLAP_TOKENS
from tidemark.operators.delta import (
    align_results,
    changed,
    classify,
    replaced_file_id,
    upsert_snapshot,
)
from tidemark.operators.handover import forget, hand_over
from tidemark.operators.render import render_documents
from tidemark.operators.skew import hot_keys, last_by, rows_with_keys
from tidemark.operators.summary import delta_totals, run_summary
from tidemark.schemas import SNAPSHOT, SUMMARY
from tidemark.session import Scratch
from tidemark.sources.chunk_table import Sink, table_sink
from tidemark.sources.corpus import corpus_delta, corpus_hashes, write_corpus
from tidemark.sources.runlog import read_run_summary, write_run_log
from tidemark.sources.snapshot import draft_snapshot, read_snapshot
from tidemark.storage import claim, commit, committed, read_version, state

PLACE = ["id", "page_no", "pos"]
TOTALS = "added long, updated long, skipped long, estimated_chunks long"
NARROW = PLACE + ["slug", "filename", "hash", "updated_at", "est_chunks", "renderer_version"]


@dataclass(frozen=True)
class Workspace:
    """Where a corpus keeps its tables."""

    corpus: str
    snapshot: str
    chunks: str
    log: str
    store_id: str = "local"

    @property
    def tables(self) -> tuple[str, str, str, str]:
        return self.corpus, self.snapshot, self.chunks, self.log

    @property
    def claims(self) -> str:
        """Where all writers of the workspace claim their versions."""
        return f"{self.log}-claims"

    @property
    def hand_overs(self) -> str:
        """Where runs note what they give to a sink of the caller's own."""
        return f"{self.log}-hand-overs"

    @classmethod
    def under(cls, root: str) -> Workspace:
        root = root.rstrip("/")
        return cls(f"{root}/corpus", f"{root}/snapshot", f"{root}/chunks", f"{root}/log")


@dataclass(frozen=True)
class RunOptions:
    dry_run: bool = False
    scrape_only: bool = False
    renderer: str = "auto"
    max_tokens: int = MAX_TOKENS
    overlap: int = OVERLAP_TOKENS
    # Off by default: a scrape-only run then hides its changes from later uploads.
    track_embedded: bool = False
    # In how many parts a sink of the caller's own gets the documents. Each part it
    # has confirmed is noted, and none of its documents is handed over again. With 0
    # nothing is noted, and every try of a run hands over all.
    hand_overs: int = 0

    @property
    def upload(self) -> bool:
        return not (self.dry_run or self.scrape_only)


def _rendered(articles: DataFrame, options: RunOptions) -> DataFrame:
    return render_documents(articles, options.renderer, options.max_tokens, options.overlap)


def preview(articles: DataFrame, snapshot: DataFrame, options: RunOptions) -> DataFrame:
    """The summary row of a run without writing anything."""
    documents = _rendered(articles, options)
    classified = classify(
        documents.select(NARROW),
        snapshot,
        upload=options.upload,
        sequential=options.scrape_only,
        hot_ids=hot_keys(articles, "id"),
    )
    return run_summary(delta_totals(classified), options.dry_run, options.scrape_only)


def run(
    spark: SparkSession,
    articles: DataFrame,
    workspace: Workspace,
    options: RunOptions = RunOptions(),
    sink: Sink | None = None,
    run_id: str | None = None,
) -> DataFrame:
    """Sync `articles` into `workspace`; gives the summary row.

    A run claims a version of the workspace for its name, `run_id`. Run again
    under the same name after a loss, it has its version again and replaces what
    it left, and nothing if it had been committed: then it gives the row it left.

    The snapshot is written last, and committing it ends the run. If another run
    has committed in the meantime, this one compares its documents with the new
    snapshot and stores them anew, so that both results stand. `sink` stores the
    changed documents and is called once for each such try, or for each part that
    is still open if `options.hand_overs` asks for parts; unless given, their chunks
    go to the workspace's chunk table.
    """
    if options.dry_run:
        return preview(articles, read_snapshot(spark, workspace.snapshot), options)
    own = claim(spark, workspace.claims, run_id or uuid.uuid4().hex, *workspace.tables)
    if own.again and committed(spark, workspace.snapshot, own.version):
        return read_run_summary(spark, workspace.log, own.version)

    with Scratch(spark) as scratch:
        # The only pass over the HTML. What follows reads back the columns it
        # needs, which leaves document text out of every shuffle but the writes'.
        staged = scratch.staged(_rendered(articles, options), "documents")
        hot = hot_keys(staged, "id")
        replace = own.again
        while True:
            base = state(spark, workspace.snapshot)
            summary = _written(
                scratch, staged, hot, base.version, workspace, options, own.version, sink, replace
            )
            if commit(spark, workspace.snapshot, own.version, base):
                forget(spark, f"{workspace.hand_overs}/{own.version}")
                return summary
            replace = True


def _written(
    scratch, staged, hot, base, workspace, options, version, sink, replace
) -> DataFrame:
    """Write all that a run leaves but the commit of its snapshot, which goes on from
    version `base`; gives the summary row."""
    spark = staged.sparkSession
    snapshot = read_version(spark, workspace.snapshot, SNAPSHOT, base)
    classified = classify(
        staged.select(NARROW),
        snapshot,
        upload=options.upload,
        sequential=options.scrape_only,
        track_embedded=options.track_embedded,
        hot_ids=hot,
    ).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        totals = delta_totals(classified).first()
        n_changed = totals.added + totals.updated
        current = corpus_hashes(spark, workspace.corpus, without=version)
        keys = scratch.staged(corpus_delta(classified, current), "corpus-keys")
        write_corpus(rows_with_keys(staged, keys, PLACE), workspace.corpus, version, replace)

        stored, error = 0, None
        recorded = None
        if options.scrape_only:
            recorded = classified.withColumnsRenamed(
                {"prior_file_id": "file_id", "prior_embedded_hash": "embedded_hash"}
            )
        elif options.upload and n_changed:
            store = sink or table_sink(
                workspace.chunks, version, options.max_tokens, options.overlap, replace
            )
            try:
                if sink and options.hand_overs:
                    pending = scratch.staged(_last_changed(classified, "hash"), "changed-keys")
                    results, error = hand_over(
                        scratch, staged, pending, sink, workspace.hand_overs, version, options.hand_overs
                    )
                else:
                    results = _store_changed(scratch, staged, classified, store)
                recorded = align_results(changed(classified), results)
                recorded = recorded.withColumn("embedded_hash", F.col("hash"))
                stored = results.agg(F.count("file_id")).first()[0]
            except Exception as failure:  # noqa: BLE001 - a sink may fail in any way
                # Nothing of a failed batch is recorded; the run reports it.
                recorded, error = None, str(failure)
        totals_row = spark.createDataFrame([totals], TOTALS)
        summary = run_summary(
            totals_row, options.dry_run, options.scrape_only, stored, error, workspace.store_id
        )
        write_run_log(summary, workspace.log, version)
        if recorded is not None:
            recorded = recorded.select(*snapshot.columns, "page_no", "pos")
            snapshot = upsert_snapshot(snapshot, recorded)
        draft_snapshot(snapshot, workspace.snapshot, version, replace)
        return spark.createDataFrame(summary.collect(), SUMMARY)
    finally:
        classified.unpersist()


def _last_changed(classified, *columns) -> DataFrame:
    """Places of the changed documents and the files they replace. Of a repeated id
    the last change wins."""
    pending = changed(classified).withColumn("replaced", replaced_file_id())
    return last_by(pending.select(*PLACE, *columns, "replaced"), "id", F.struct("page_no", "pos"))


def _store_changed(scratch, staged, classified, store) -> DataFrame:
    """Hand the changed documents to the sink; gives what it stored.

    The sink's result is written down at once, so that reading it again never
    uploads again.
    """
    last = scratch.staged(_last_changed(classified), "changed-keys")
    documents = rows_with_keys(staged, last, PLACE)
    replaced = last.filter(F.col("replaced").isNotNull())
    stored = store(documents, replaced.select("id", F.col("replaced").alias("file_id")))
    return scratch.staged(stored, "stored")
