"""Registered queries: one per operator, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import html as hx
from tidemark.functions import text as tx
from tidemark.functions.nested import nested_markdown
from tidemark.operators import audit, chunking, delta, retrieval, summary
from tidemark.operators.render import full_markdown, render_documents
from tidemark.operators.skew import hot_keys
from tidemark.plans import gate, inputs
from tidemark.plans.sync import RunOptions, Workspace, preview, run
from tidemark.session import scratch_path, ship_package, staged
from tidemark.sources import chunk_table, corpus, pages, runlog, snapshot
from tidemark.storage import claim, write_version
from tidemark.streaming.incremental import batch_run, page_dump_stream, sync_new_pages

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return build(spark, sf_dir)

    QUERIES[build.__name__] = prepared
    return prepared


def _text_key(text: str) -> list:
    """A text as hash and length, which compare like the text."""
    return [F.sha2(text, 256).alias("text_hash"), F.char_length(text).alias("n_chars")]


# Sources and sinks


@query
def page_source(spark, sf_dir):
    path = scratch_path(spark, "pages")
    inputs.page_dumps(spark, sf_dir).write.json(path)
    followed = pages.followed_pages(pages.read_page_dumps(spark, path))
    n_articles = F.size(F.coalesce("articles", F.array())).cast("long")
    return followed.select("crawl", "page_no", n_articles.alias("n_articles"), "next_page")


@query
def page_flatten(spark, sf_dir):
    flat = pages.flatten_pages(inputs.page_dumps(spark, sf_dir))
    return flat.select("page_no", "pos", "id", "title", "html_url", "locale", "draft")


@query
def page_articles(spark, sf_dir):
    """From captured pages to normalised articles."""
    path = scratch_path(spark, "pages")
    inputs.page_dumps(spark, sf_dir).write.json(path)
    found = pages.articles_of(pages.read_page_dumps(spark, path))
    return found.select(
        "id", "title", "html_url", "updated_at", "locale", "page_no", *_text_key("body_html")
    )


@query
def page_chain(spark, sf_dir):
    """Articles in the order of their crawls' links, where numbers tell none."""
    path = scratch_path(spark, "pages")
    inputs.unnumbered_dumps(spark, sf_dir).write.json(path)
    found = pages.articles_of(pages.read_page_dumps(spark, path), follow=True)
    return found.select("id", "title", "page_no", "pos")


@query
def chain_limit(spark, sf_dir):
    """The first three pages that each crawl reaches by its links."""
    path = scratch_path(spark, "pages")
    inputs.unnumbered_dumps(spark, sf_dir).write.json(path)
    found = pages.followed_pages(pages.read_page_dumps(spark, path), 3)
    n_articles = F.size(F.coalesce("articles", F.array())).cast("long")
    return found.select("crawl", "address", n_articles.alias("n_articles"))


@query
def corpus_sink(spark, sf_dir):
    root = scratch_path(spark, "corpus")
    corpus.write_corpus(inputs.documents(spark, sf_dir), root, 0)
    return corpus.read_corpus(spark, root).select("filename", "id", "hash")


@query
def corpus_source(spark, sf_dir):
    """Documents written many to a file and read back."""
    path = scratch_path(spark, "documents")
    corpus.write_document_lines(inputs.documents(spark, sf_dir), path)
    read = corpus.parse_headers(corpus.read_document_lines(spark, path))
    return read.select("id", "title", "url", tx.content_hash(F.col("md_text")).alias("hash"))


@query
def snapshot_source(spark, sf_dir):
    path = scratch_path(spark, "snapshot")
    snapshot.write_snapshot_json(inputs.baseline(inputs.stored_documents(spark, sf_dir)), path)
    read = snapshot.read_snapshot_json(spark, path, multi_line=False)
    return read.select("id", "hash", "slug", "updated_at", "file_id")


@query
def snapshot_sink(spark, sf_dir):
    stored = inputs.stored_documents(spark, sf_dir)
    root = scratch_path(spark, "snapshot")
    before = inputs.baseline(stored)
    snapshot.write_snapshot(before, root, 0)
    recorded = _uploaded(delta.classify(stored, before, upload=True), before)
    snapshot.write_snapshot(delta.upsert_snapshot(before, recorded), root, 1)
    return snapshot.read_snapshot(spark, root).select("id", "hash", "slug", "file_id")


def _page_totals(spark, sf_dir) -> DataFrame:
    """Each dump page taken as a run of its own: totals per page."""
    stored = inputs.stored_documents(spark, sf_dir)
    classified = delta.classify(stored, inputs.baseline(stored), upload=True)
    return classified.groupBy("page_no").agg(
        *summary.status_counts(), summary.estimated_chunks()
    )


@query
def run_log_sink(spark, sf_dir):
    path = scratch_path(spark, "log")
    totals = _page_totals(spark, sf_dir).select("page_no", "added", "updated", "skipped")
    runlog.append_log(totals, path, runlog.RUN_COMPLETE)
    return spark.read.text(path)


@query
def run_log_source(spark, sf_dir):
    path = scratch_path(spark, "log")
    totals = _page_totals(spark, sf_dir)
    runlog.append_log(totals.select("added"), path, "page done")
    runlog.append_log(totals.drop("page_no"), path, runlog.RUN_COMPLETE)
    history = runlog.run_history(runlog.read_log(spark, path))
    return history.select("level", "message", "added", "updated", "skipped", "estimated_chunks")


def _chunk_versions(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """An old chunk table, the changed documents, and their new chunks."""
    new = inputs.files(spark, sf_dir)
    old = new.filter(~inputs.every(10, "id")).withColumn(
        "md_text",
        F.when(inputs.every(7, "id"), F.concat(F.lit("old "), "md_text")).otherwise(
            F.col("md_text")
        ),
    )
    is_changed = inputs.every(10, "id") | inputs.every(7, "id")
    changed = new.filter(is_changed).withColumn("file_id", F.concat("file_id", F.lit("_new")))
    return chunking.chunk_rows(old), changed, chunking.chunk_rows(changed)


@query
def chunk_replace(spark, sf_dir):
    old, changed, new = _chunk_versions(spark, sf_dir)
    replaced = changed.select(F.col("id").alias("doc_id"))
    table = chunking.replace_on_update(old, new, replaced)
    return table.select("chunk_id", "file_id", "doc_id", "chunk_no", *_text_key("text"))


@query
def deleted_chunks(spark, sf_dir):
    old, changed, _ = _chunk_versions(spark, sf_dir)
    replaced = changed.select(F.col("id").alias("doc_id"))
    return chunking.deleted_rows(old, replaced).select("chunk_id", "doc_id", "chunk_no")


@query
def live_chunk_table(spark, sf_dir):
    """Append-only chunk versions, read through the snapshot."""
    root = scratch_path(spark, "chunks")
    old, changed, new = _chunk_versions(spark, sf_dir)
    write_version(old, root, 0)
    write_version(new, root, 1)
    all_files = inputs.files(spark, sf_dir)
    renamed = F.when(
        inputs.every(10, "id") | inputs.every(7, "id"), F.concat("file_id", F.lit("_new"))
    ).otherwise(F.col("file_id"))
    current = all_files.select(renamed.alias("file_id"))
    live = chunk_table.read_chunks(spark, root, current)
    return live.select("chunk_id", "file_id", "doc_id", "chunk_no", *_text_key("text"))


# Text


@query
def normalise_articles(spark, sf_dir):
    normal = pages.normalise(inputs.raw_articles(spark, sf_dir))
    return normal.select(
        "id", "title", "html_url", "updated_at", "locale", *_text_key("body_html")
    )


@query
def locale_default(spark, sf_dir):
    normal = pages.normalise(inputs.raw_articles(spark, sf_dir), locale="de-at")
    return normal.groupBy("locale").agg(F.count("*").alias("n"))


@query
def slugify(spark, sf_dir):
    return inputs.articles(spark, sf_dir).select("id", tx.slugify(F.col("title")).alias("slug"))


@query
def document_key(spark, sf_dir):
    key = tx.document_key(F.col("id"), F.col("title"))
    return inputs.articles(spark, sf_dir).select(
        "id", key.alias("slug"), tx.filename(key).alias("filename")
    )


@query
def strip_elements(spark, sf_dir):
    source = inputs.table(spark, sf_dir, "pages")
    stripped = source.select("page_id", hx.strip_elements(F.col("html")).alias("text"))
    return stripped.select("page_id", *_text_key("text"))


@query
def strip_class_hints(spark, sf_dir):
    source = inputs.hinted_pages(spark, sf_dir)
    stripped = source.select("page_id", hx.strip_class_hints(F.col("html")).alias("text"))
    return stripped.select("page_id", *_text_key("text"))


@query
def markdown_flat(spark, sf_dir):
    source = inputs.hinted_pages(spark, sf_dir)
    html = hx.clean_html(F.col("html"))
    text = hx.flat_markdown(html)
    return source.select("page_id", text.alias("text")).select("page_id", *_text_key("text"))


@query
def nested_markup(spark, sf_dir):
    """Nested lists, quotes, open items and hinted elements, read in columns."""
    source = inputs.nested_pages(spark, sf_dir)
    text = tx.tidy_body(nested_markdown(F.col("html")))
    return source.select("page_id", text.alias("text")).select("page_id", *_text_key("text"))


@query
def markdown_links(spark, sf_dir):
    """The flat rules on the link lists that cleaning would drop."""
    source = inputs.table(spark, sf_dir, "pages")
    text = tx.tidy_body(hx.flat_markdown(F.col("html")))
    return source.select("page_id", text.alias("text")).select("page_id", *_text_key("text"))


@query
def trim_body(spark, sf_dir):
    padded = F.concat(F.lit("\ufeff\n \u00a0\t"), F.col("text"), F.lit("\u3000 \r\n"))
    trimmed = inputs.table(spark, sf_dir, "documents").select(
        "doc_id", tx.js_trim(padded).alias("text")
    )
    return trimmed.select("doc_id", *_text_key("text"))


@query
def collapse_blank_lines(spark, sf_dir):
    spaced = F.regexp_replace("text", "\n", "\n\n\n\n")
    tidy = inputs.table(spark, sf_dir, "documents").select(
        "doc_id", tx.tidy_body(spaced).alias("text")
    )
    return tidy.select("doc_id", *_text_key("text"))


@query
def compose_document(spark, sf_dir):
    return inputs.documents(spark, sf_dir).select("id", *_text_key("md_text"))


@query
def parse_header(spark, sf_dir):
    documents = inputs.documents(spark, sf_dir).select("md_text")
    return corpus.parse_headers(documents).select("title", "url", "id")


@query
def content_hash(spark, sf_dir):
    return inputs.table(spark, sf_dir, "documents").select(
        "doc_id", tx.content_hash(F.col("text")).alias("hash")
    )


@query
def token_estimate(spark, sf_dir):
    units = tx.u16_length(F.col("text"))
    return inputs.table(spark, sf_dir, "documents").select(
        "doc_id", units.alias("units"), tx.token_estimate(units).alias("tokens")
    )


@query
def chunk_estimate(spark, sf_dir):
    units = tx.u16_length(F.col("text"))
    return inputs.table(spark, sf_dir, "documents").select(
        "doc_id",
        tx.chunk_estimate(units).alias("n_default"),
        tx.chunk_estimate(units, 1000, 0).alias("n_no_overlap"),
        tx.chunk_estimate(units, 100, 100).alias("n_stride_one"),
    )


@query
def base_url(spark, sf_dir):
    host = F.regexp_extract("url", "^https?://([^/?#]+)", 1)
    given = F.when(inputs.every(2, "page_id"), F.concat(host, F.lit("//"))).otherwise(F.col("url"))
    return inputs.table(spark, sf_dir, "pages").select("page_id", tx.base_url(given).alias("url"))


@query
def run_mode(spark, sf_dir):
    """Labels for every combination of the two flags, over the articles."""
    flagged = inputs.articles(spark, sf_dir).select(
        "id", inputs.every(2, "id").alias("dry_run"), inputs.every(3, "id").alias("scrape_only")
    )
    mode = summary.run_mode(F.col("dry_run"), F.col("scrape_only"))
    return flagged.groupBy("dry_run", "scrape_only", mode.alias("mode")).agg(
        F.count("*").alias("n")
    )


# Filters


@query
def drop_drafts(spark, sf_dir):
    return pages.drop_drafts(inputs.raw_articles(spark, sf_dir)).select("id", "draft")


def _classified(spark, sf_dir, upload: bool = True) -> DataFrame:
    stored = inputs.stored_documents(spark, sf_dir)
    hot = hot_keys(stored, "id")
    return delta.classify(stored, inputs.baseline(stored), upload=upload, hot_ids=hot)


@query
def changed_set(spark, sf_dir):
    return delta.changed(_classified(spark, sf_dir)).select("id", "status", "filename")


@query
def needs_embedding(spark, sf_dir):
    """Documents that count as added only because they were never uploaded."""
    with_override = _classified(spark, sf_dir).select("id", F.col("status").alias("upload_status"))
    plain = _classified(spark, sf_dir, upload=False).select("id", "status")
    return plain.join(with_override, "id").filter(F.col("status") != F.col("upload_status"))


@query
def secret_matches(spark, sf_dir):
    return audit.secret_matches(inputs.files_with_keys(spark, sf_dir), "filename", "text")


@query
def placeholder_exclusion(spark, sf_dir):
    found = audit.secret_matches(inputs.files_with_keys(spark, sf_dir), "filename", "text")
    return audit.without_placeholders(found)


@query
def redacted_secrets(spark, sf_dir):
    return gate.secret_hits(inputs.files_with_keys(spark, sf_dir), "filename", "text")


@query
def strict_secret_matches(spark, sf_dir):
    """Keys that start a word; the texts also hold keys glued to a word."""
    glued = F.concat("text", F.lit(" kio"), F.regexp_extract("text", audit.SECRET_PATTERN, 0))
    texts = inputs.files_with_keys(spark, sf_dir).select("filename", glued.alias("text"))
    return audit.secret_matches(texts, "filename", "text", strict=True)


@query
def cited_answers(spark, sf_dir):
    turns = inputs.answers(spark, sf_dir)
    return turns.filter(audit.is_cited(F.col("text"))).select("conv_id", "turn")


@query
def answered_turns(spark, sf_dir):
    """Length counts UTF-16 units; some texts end with signs of two units each."""
    turns = inputs.table(spark, sf_dir, "conversations")
    signs = F.repeat(F.lit("\U0001f600"), F.pmod("conv_id", F.lit(5)).cast("int") * 60)
    answered = audit.is_answered(F.concat("text", signs), ("die", "der"), 500)
    return turns.select("conv_id", "turn", answered.alias("answered"))


@query
def bullet_cap(spark, sf_dir):
    text = F.col("text")
    return inputs.answers(spark, sf_dir).select(
        "conv_id",
        "turn",
        audit.bullet_count(text).alias("n_bullets"),
        audit.over_bullet_cap(text).alias("over_cap"),
    )


@query
def page_limit(spark, sf_dir):
    """Articles of the first page that each crawl follows."""
    found = pages.flatten_pages(pages.followed_pages(inputs.page_dumps(spark, sf_dir), 1))
    return found.groupBy("page_no").agg(
        F.count("*").alias("n_articles"), F.max("id").alias("last_id")
    )


# Delta


@query
def delta_classify(spark, sf_dir):
    return _classified(spark, sf_dir).select("id", "status")


@query
def delta_classify_hot(spark, sf_dir):
    """A third of all rows has one id."""
    stored = inputs.stored_documents(spark, sf_dir)
    hot_id = F.when(inputs.every(3, "id"), F.lit(1).cast("long")).otherwise(F.col("id"))
    rows = stored.withColumn("id", hot_id)
    found = delta.classify(
        rows, inputs.baseline(stored), upload=True, hot_ids=hot_keys(rows, "id")
    )
    return found.select("id", "page_no", "pos", "status", "prior_file_id")


@query
def prior_file_id(spark, sf_dir):
    return _classified(spark, sf_dir).select(
        "id", "prior_file_id", delta.replaced_file_id().alias("old_file_id")
    )


def _uploaded(classified: DataFrame, before: DataFrame) -> DataFrame:
    """Changed documents as an upload records them."""
    changed = delta.changed(classified)
    new_id = F.concat(F.lit("new_"), F.col("id").cast("string"))
    recorded = changed.withColumn("file_id", new_id).withColumn("embedded_hash", F.col("hash"))
    return recorded.select(*before.columns, "page_no", "pos")


@query
def snapshot_upsert(spark, sf_dir):
    stored = inputs.stored_documents(spark, sf_dir)
    before = inputs.baseline(stored)
    recorded = _uploaded(delta.classify(stored, before, upload=True), before)
    after = delta.upsert_snapshot(before, recorded)
    return after.select("id", "hash", "slug", "updated_at", "file_id")


@query
def align_results(spark, sf_dir):
    items = delta.changed(_classified(spark, sf_dir))
    results = items.select(
        "id", "page_no", "pos", F.concat(F.lit("new_"), F.reverse("filename")).alias("file_id")
    )
    return delta.align_results(items, results).select("id", "slug", "file_id")


def _repeated(spark, sf_dir) -> DataFrame:
    documents = render_documents(inputs.repeated_articles(spark, sf_dir), "flat")
    return staged(documents.select(inputs.STORED), "documents")


@query
def repeated_ids_sequential(spark, sf_dir):
    stored = _repeated(spark, sf_dir)
    first = stored.filter(F.col("page_no") < 1_000_000)
    before = inputs.baseline(first)
    classified = delta.classify(stored, before, upload=False, sequential=True)
    return classified.select("id", "page_no", "pos", "status", "prior_file_id")


@query
def repeated_ids_upload(spark, sf_dir):
    """All occurrences meet the snapshot; the last one is recorded."""
    stored = _repeated(spark, sf_dir)
    before = inputs.baseline(stored.filter(F.col("page_no") < 1_000_000))
    recorded = _uploaded(delta.classify(stored, before, upload=True), before)
    return delta.upsert_snapshot(before, recorded).select("id", "hash", "slug", "file_id")


@query
def removed_documents(spark, sf_dir):
    """Snapshot entries whose document left the source."""
    stored = inputs.stored_documents(spark, sf_dir)
    gone = delta.removed_documents(inputs.baseline(stored), stored.filter(~inputs.every(3, "id")))
    return gone.select("id", "file_id")


# Totals


@query
def status_counts(spark, sf_dir):
    return _classified(spark, sf_dir).agg(*summary.status_counts())


@query
def estimated_chunks(spark, sf_dir):
    return _classified(spark, sf_dir, upload=False).agg(summary.estimated_chunks())


@query
def delta_summary(spark, sf_dir):
    """The flagship: render, hash, compare with the snapshot, count."""
    return summary.delta_totals(_classified(spark, sf_dir))


@query
def files_embedded(spark, sf_dir):
    changed = delta.changed(_classified(spark, sf_dir))
    stored = changed.withColumn("file_id", F.when(~inputs.every(4, "id"), F.col("slug")))
    return summary.files_embedded(stored)


def _page_summaries(spark, sf_dir) -> DataFrame:
    """Summaries of page-sized runs, of which every second one failed."""
    totals = _page_totals(spark, sf_dir)
    error = F.when(
        inputs.every(2, "page_no"),
        F.concat(F.lit("Error: page "), F.col("page_no").cast("string")),
    )
    changed = F.col("added") + F.col("updated")
    return summary.run_summary(
        totals,
        files_embedded=F.when(error.isNull(), changed).otherwise(0),
        error=error,
        store_id="vs_test",
    )


@query
def failure_collection(spark, sf_dir):
    return _page_summaries(spark, sf_dir).select(
        "added",
        F.concat_ws("; ", F.transform("failures", lambda f: f["error"])).alias("errors"),
        summary.is_failed().alias("failed"),
    )


@query
def run_summary(spark, sf_dir):
    return _page_summaries(spark, sf_dir).select(
        "added",
        "updated",
        "skipped",
        "files_embedded",
        "estimated_chunks",
        F.size("failures").cast("long").alias("n_failures"),
        "mode",
        "store_id",
    )


@query
def corpus_count(spark, sf_dir):
    return audit.corpus_count(inputs.files(spark, sf_dir))


@query
def secret_rollup(spark, sf_dir):
    return audit.hits_by_path(gate.secret_hits(inputs.files_with_keys(spark, sf_dir), "filename", "text"))


def _raw_snapshot(spark, sf_dir) -> DataFrame:
    """Snapshot lines as raw JSON; some are cut off."""
    lines = snapshot.snapshot_json(inputs.baseline(inputs.stored_documents(spark, sf_dir)))
    cut = F.expr("substring(value, 1, char_length(value) - 1)")
    broken = F.conv(F.substring(F.sha2("value", 256), 1, 1), 16, 10).cast("int") == 0
    return lines.select("value", F.when(broken, cut).otherwise(F.col("value")).alias("raw"))


@query
def snapshot_validity(spark, sf_dir):
    raw = _raw_snapshot(spark, sf_dir)
    return raw.groupBy(snapshot.is_valid_json(F.col("raw")).alias("valid")).agg(
        F.count("*").alias("n")
    )


@query
def minimum_corpus(spark, sf_dir):
    return audit.minimum_corpus_check(inputs.files(spark, sf_dir))


def _checks(spark, sf_dir) -> DataFrame:
    documents = inputs.files_with_keys(spark, sf_dir)
    raw = snapshot.snapshot_json(inputs.baseline(inputs.stored_documents(spark, sf_dir)))
    return gate.gate_checks(documents, "filename", "text", raw.withColumnRenamed("value", "raw"))


@query
def gate_checks(spark, sf_dir):
    return _checks(spark, sf_dir).drop("position")


@query
def gate_verdict(spark, sf_dir):
    return audit.gate_verdict(_checks(spark, sf_dir))


@query
def gate_summary(spark, sf_dir):
    return audit.gate_summary(_checks(spark, sf_dir), inputs.files(spark, sf_dir))


@query
def gate_json(spark, sf_dir):
    return audit.gate_json(_checks(spark, sf_dir))


# Chunks and search


@query
def split_chunks(spark, sf_dir):
    chunks = chunking.split_chunks(inputs.files(spark, sf_dir).select("id", "md_text"))
    return chunks.select("id", "chunk_no", *_text_key("text"))


@query
def split_chunks_small(spark, sf_dir):
    """An overlap that does not divide the chunk size."""
    source = inputs.files(spark, sf_dir).select("id", "md_text")
    chunks = chunking.split_chunks(source, max_tokens=100, overlap=30)
    return chunks.select("id", "chunk_no", *_text_key("text"))


@query
def chunk_metadata(spark, sf_dir):
    return chunking.chunk_rows(inputs.files(spark, sf_dir)).drop("text")


@query
def vector_top_k(spark, sf_dir):
    """The nearest vectors to the mean of each label."""
    vectors = inputs.table(spark, sf_dir, "embeddings")
    topics = retrieval.mean_vectors(vectors, "label")
    return retrieval.vector_top_k(vectors, topics, 5)


@query
def vector_top_k_many(spark, sf_dir):
    """The nearest vectors to every vector of one label, itself among them."""
    vectors = inputs.table(spark, sf_dir, "embeddings")
    asked = vectors.filter(F.col("label") == 0).select(F.col("vec_id").alias("query_id"), "embedding")
    return retrieval.vector_top_k(vectors, asked, 5)


def _items(spark, sf_dir) -> DataFrame:
    return inputs.table(spark, sf_dir, "documents").select(
        "doc_id", F.col("doc_id").alias("item_id"), "text"
    )


@query
def lexical_top_k(spark, sf_dir):
    found = retrieval.lexical_top_k(_items(spark, sf_dir), inputs.questions(spark, sf_dir), 3)
    return found.select("question_id", "doc_id", "score", "rank")


def _chunk_items(spark, sf_dir) -> DataFrame:
    chunks = chunking.split_chunks(inputs.files(spark, sf_dir).select("id", "md_text"))
    return chunks.select(F.col("id").alias("doc_id"), F.col("chunk_no").alias("item_id"), "text")


@query
def best_sources(spark, sf_dir):
    found = retrieval.best_sources(_chunk_items(spark, sf_dir), inputs.questions(spark, sf_dir))
    return found.select(
        "question_id", "doc_id", F.col("item_id").alias("chunk_no"), "score", "rank"
    )


@query
def cited_context(spark, sf_dir):
    found = retrieval.best_sources(_chunk_items(spark, sf_dir), inputs.questions(spark, sf_dir))
    urls = inputs.files(spark, sf_dir).select(F.col("id").alias("doc_id"), "url")
    context = retrieval.cited_context(found, urls, inputs.questions(spark, sf_dir))
    return context.select("question_id", F.concat_ws(" ", "urls").alias("urls"))


@query
def citation_log(spark, sf_dir):
    log = retrieval.citation_log(inputs.responses(spark, sf_dir), "response_id")
    return log.select(
        "response_id", "filename", F.sha2("answer", 256).alias("answer_hash")
    )


@query
def cited_files(spark, sf_dir):
    """How many responses cite each file."""
    log = retrieval.citation_log(inputs.responses(spark, sf_dir), "response_id")
    return log.filter(F.col("filename").isNotNull()).groupBy("filename").agg(F.count("*").alias("n_responses"))


# Whole runs


@query
def render_full(spark, sf_dir):
    """Element-by-element Markdown of every page."""
    source = inputs.hinted_pages(spark, sf_dir)
    body = tx.tidy_body(full_markdown(F.col("html")))
    return source.select("page_id", body.alias("text")).select("page_id", *_text_key("text"))


class RunLost(BaseException):
    """Stands for the loss of a run, which no run can catch."""


def _workspace(spark, sf_dir) -> Workspace:
    """A workspace whose last run left the baseline snapshot."""
    workspace = Workspace.under(scratch_path(spark, "sync"))
    before = inputs.baseline(inputs.stored_documents(spark, sf_dir))
    snapshot.write_snapshot(before, workspace.snapshot, 0)
    return workspace


SUMMARY_COLUMNS = ["added", "updated", "skipped", "files_embedded", "estimated_chunks", "mode"]


@query
def sync_dry_run(spark, sf_dir):
    before = inputs.baseline(inputs.stored_documents(spark, sf_dir))
    options = RunOptions(dry_run=True)
    return preview(inputs.articles(spark, sf_dir), before, options).select(SUMMARY_COLUMNS)


@query
def sync_upload(spark, sf_dir):
    workspace = _workspace(spark, sf_dir)
    options = RunOptions()
    done = run(spark, inputs.articles(spark, sf_dir), workspace, options)
    return done.select(SUMMARY_COLUMNS)


@query
def sync_upload_chunks(spark, sf_dir):
    """The live chunk table an upload run leaves."""
    workspace = _workspace(spark, sf_dir)
    run(spark, inputs.articles(spark, sf_dir), workspace)
    after = snapshot.read_snapshot(spark, workspace.snapshot)
    live = chunk_table.read_chunks(spark, workspace.chunks, after)
    return live.select("file_id", "doc_id", "chunk_no", *_text_key("text"))


@query
def sync_scrape_only(spark, sf_dir):
    """The snapshot a scrape-only run leaves over repeated ids."""
    workspace = _workspace(spark, sf_dir)
    options = RunOptions(scrape_only=True, renderer="flat")
    run(spark, inputs.repeated_articles(spark, sf_dir), workspace, options)
    return snapshot.read_snapshot(spark, workspace.snapshot).select(
        "id", "hash", "slug", "file_id"
    )


@query
def sync_custom_sink(spark, sf_dir):
    """An upload run whose sink is the caller's own."""
    workspace = _workspace(spark, sf_dir)

    def sink(documents: DataFrame, replaced: DataFrame) -> DataFrame:
        return documents.select("id", "page_no", "pos", F.concat(F.lit("ext_"), "slug").alias("file_id"))

    run(spark, inputs.articles(spark, sf_dir), workspace, RunOptions(renderer="flat"), sink=sink)
    return snapshot.read_snapshot(spark, workspace.snapshot).select("id", "file_id")


@query
def sync_lost_hand_over(spark, sf_dir):
    """An upload run lost after its sink stored two of four parts, and done again:
    how often the sink stored each document, and the file that the snapshot names."""
    workspace, calls = _workspace(spark, sf_dir), []
    outside = scratch_path(spark, "outside")

    def sink(documents: DataFrame, replaced: DataFrame) -> DataFrame:
        calls.append(None)
        if len(calls) == 3:
            raise RunLost("before the third part is stored")
        stored = documents.select("id", "page_no", "pos", F.concat(F.lit("ext_"), "slug").alias("file_id"))
        stored.write.mode("append").parquet(outside)
        return stored

    articles = inputs.articles(spark, sf_dir)
    options = RunOptions(renderer="flat", hand_overs=4)
    try:
        run(spark, articles, workspace, options, sink=sink, run_id="lost")
    except RunLost:
        run(spark, articles, workspace, options, sink=sink, run_id="lost")
    times = spark.read.parquet(outside).groupBy("id").agg(F.count("*").alias("n_stored"))
    named = snapshot.read_snapshot(spark, workspace.snapshot).select("id", "file_id")
    return named.join(times, "id", "left")


@query
def incremental_over_snapshot(spark, sf_dir):
    """A batch run, a stream of changed pages, a batch run: snapshot and live chunks.

    The first run meets older texts of every second and third article; the
    stream brings every third up to date, the last run the others.
    """
    root = scratch_path(spark, "mixed")
    workspace = Workspace.under(f"{root}/sync")
    options = RunOptions(renderer="flat")
    now = inputs.articles(spark, sf_dir)
    title = F.concat(F.lit("old "), "title")
    older = inputs.every(2, "id") | inputs.every(3, "id")
    run(spark, now.withColumn("title", F.when(older, title).otherwise(F.col("title"))), workspace, options)
    fresh = now.filter(inputs.every(3, "id"))
    _as_pages(fresh).write.json(f"{root}/pages")
    sync_new_pages(
        page_dump_stream(spark, f"{root}/pages"), workspace, f"{root}/checkpoint", options
    ).awaitTermination()
    run(spark, now, workspace, options)
    after = snapshot.read_snapshot(spark, workspace.snapshot)
    live = chunk_table.read_chunks(spark, workspace.chunks, after)
    counts = live.groupBy("file_id").agg(F.count("*").alias("n_chunks"))
    return after.join(counts, "file_id").select("id", "hash", "file_id", "n_chunks")


def _as_pages(articles: DataFrame) -> DataFrame:
    """A page for each article."""
    body = F.struct("id", "title", F.col("body_html").alias("body"), "html_url", "updated_at", "locale")
    return articles.select((F.col("id") + 1).alias("page_no"), F.array(body).alias("articles"))


@query
def incremental_after_lost_batch(spark, sf_dir):
    """A stream's batch is lost right after its claim, a batch run commits, and the
    batch is replayed: both results stand."""
    root = scratch_path(spark, "lost")
    workspace, checkpoint = Workspace.under(f"{root}/sync"), f"{root}/checkpoint"
    options = RunOptions(renderer="flat")
    now = inputs.articles(spark, sf_dir)
    _as_pages(now.filter(~inputs.every(3, "id"))).write.json(f"{root}/pages")
    claim(spark, workspace.claims, batch_run(checkpoint, 0), *workspace.tables)
    run(spark, now.filter(inputs.every(2, "id")), workspace, options)
    stream = page_dump_stream(spark, f"{root}/pages")
    sync_new_pages(stream, workspace, checkpoint, options).awaitTermination()
    after = snapshot.read_snapshot(spark, workspace.snapshot)
    live = chunk_table.read_chunks(spark, workspace.chunks, after)
    counts = live.groupBy("file_id").agg(F.count("*").alias("n_chunks"))
    return after.join(counts, "file_id").select("id", "hash", "file_id", "n_chunks")


@query
def incremental_two_crawls(spark, sf_dir):
    """Two crawls that both number from 1 arrive in one batch of a stream; of an
    article in both, the later crawl's form stays."""
    root = scratch_path(spark, "crawls")
    now = inputs.articles(spark, sf_dir)
    again = now.filter(inputs.every(2, "id")).withColumn("title", F.concat("title", F.lit(" (later)")))
    for crawl, rows in (("2024-06-02", again), ("2024-06-01", now)):
        _as_pages(rows).withColumn("crawl", F.lit(crawl)).write.json(f"{root}/pages/{crawl}")
    workspace = Workspace.under(f"{root}/sync")
    stream = page_dump_stream(spark, f"{root}/pages/*")
    sync_new_pages(stream, workspace, f"{root}/checkpoint", RunOptions(renderer="flat")).awaitTermination()
    return snapshot.read_snapshot(spark, workspace.snapshot).select("id", "hash", "slug", "file_id")


@query
def incremental_sync(spark, sf_dir):
    """The snapshot after streaming page dumps in, twice over one checkpoint."""
    root = scratch_path(spark, "stream")
    inputs.page_dumps(spark, sf_dir).write.json(f"{root}/pages")
    workspace = Workspace.under(f"{root}/sync")
    for _ in range(2):
        stream = page_dump_stream(spark, f"{root}/pages")
        sync_new_pages(
            stream, workspace, f"{root}/checkpoint", RunOptions(renderer="flat")
        ).awaitTermination()
    return snapshot.read_snapshot(spark, workspace.snapshot).select("id", "hash", "slug", "file_id")
