from concurrent.futures import ThreadPoolExecutor
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tidemark.operators.delta import classify
from tidemark.operators.skew import rows_with_keys
from tidemark.plans.sync import RunOptions, Workspace, run
from tidemark.session import scratch_root, staged
from tidemark.sources.chunk_table import compact, read_chunks
from tidemark.sources.corpus import compact as compact_corpus
from tidemark.sources.corpus import read_corpus
from tidemark.sources.pages import articles_of
from tidemark.sources.runlog import read_log, run_history
from tidemark.sources.snapshot import read_snapshot
from tidemark import storage
from tidemark.storage import claim, create_once, versions, write_version
from tidemark.streaming.incremental import batch_run, page_dump_stream, sync_new_pages
from tests.test_sources import dump, raw

SCHEMA = (
    "id long, title string, body_html string, html_url string, updated_at string,"
    "locale string, page_no long, pos int"
)
SCRAPE, DRY = RunOptions(scrape_only=True), RunOptions(dry_run=True)


def articles(spark, *bodies, updated="t1"):
    """(id, body) pairs in source order."""
    rows = [
        (i, f"Article {i}", f"<p>{body}</p>", f"https://e.com/{i}", updated, "en-us", place, 0)
        for place, (i, body) in enumerate(bodies)
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def workspace(tmp_path):
    return Workspace.under(str(tmp_path / "work"))


def counts(summary):
    row = summary.first()
    return row.added, row.updated, row.skipped, row.files_embedded


def state(spark, workspace):
    return {r.id: r for r in read_snapshot(spark, workspace.snapshot).collect()}


def chunk_texts(spark, workspace):
    snapshot = read_snapshot(spark, workspace.snapshot)
    return sorted(r.text.split("\n")[-2] for r in read_chunks(spark, workspace.chunks, snapshot).collect())


def test_scrape_only_twice(spark, workspace):
    three = articles(spark, (1, "a"), (2, "b"), (3, "c"))
    first = run(spark, three, workspace, SCRAPE)
    assert counts(first) == (3, 0, 0, 0)
    assert first.first().mode == "scrape_only"
    assert read_corpus(spark, workspace.corpus).count() == 3
    assert len(state(spark, workspace)) == 3
    assert versions(spark, workspace.chunks) == []
    assert counts(run(spark, three, workspace, SCRAPE)) == (0, 0, 3, 0)
    stored = spark.read.parquet(workspace.corpus)
    assert stored.count() == 3 and stored.select("version").distinct().count() == 1


def test_upload_replaces_updated_documents(spark, workspace):
    assert counts(run(spark, articles(spark, (1, "a"), (2, "b")), workspace)) == (2, 0, 0, 2)
    second = run(spark, articles(spark, (1, "a2"), (2, "b"), (3, "c")), workspace)
    assert counts(second) == (1, 1, 1, 2)
    assert second.first().estimated_chunks == 2
    assert chunk_texts(spark, workspace) == ["a2", "b", "c"]
    assert {i: r.file_id for i, r in state(spark, workspace).items()} == {
        1: "file_1_1", 2: "file_0_2", 3: "file_1_3",
    }
    names = {r.filename: r.md_text for r in read_corpus(spark, workspace.corpus).collect()}
    assert len(names) == 3 and "\na2\n" in names["1-article-1.md"]
    history = run_history(read_log(spark, workspace.log))
    assert sorted((r.added, r.updated, r.skipped) for r in history.collect()) == [(1, 1, 1), (2, 0, 0)]


def test_removed_documents_stay(spark, workspace):
    run(spark, articles(spark, (1, "a"), (2, "b")), workspace)
    assert counts(run(spark, articles(spark, (2, "b")), workspace)) == (0, 0, 1, 0)
    assert set(state(spark, workspace)) == {1, 2}
    assert read_corpus(spark, workspace.corpus).count() == 2
    assert chunk_texts(spark, workspace) == ["a", "b"]


def test_dry_run_writes_nothing(spark, workspace, tmp_path):
    summary = run(spark, articles(spark, (1, "a")), workspace, DRY)
    assert counts(summary) == (1, 0, 0, 0) and summary.first().mode == "dry_run"
    assert not (tmp_path / "work").exists()


def test_dry_run_wins_but_repeats_follow_scrape_only(spark, workspace, tmp_path):
    repeated = articles(spark, (1, "a"), (1, "a"))
    both = run(spark, repeated, workspace, RunOptions(dry_run=True, scrape_only=True))
    assert counts(both) == (1, 0, 1, 0) and both.first().mode == "dry_run"
    assert counts(run(spark, repeated, workspace, DRY)) == (2, 0, 0, 0)
    assert not (tmp_path / "work").exists()


def test_scrape_then_upload_embeds(spark, workspace):
    two = articles(spark, (1, "a"), (2, "b"))
    run(spark, two, workspace, SCRAPE)
    assert counts(run(spark, two, workspace)) == (2, 0, 0, 2)
    assert chunk_texts(spark, workspace) == ["a", "b"]


def test_scrape_only_hides_an_update_unless_tracked(spark, workspace):
    run(spark, articles(spark, (1, "a")), workspace)
    changed = articles(spark, (1, "b"))
    run(spark, changed, workspace, SCRAPE)
    assert state(spark, workspace)[1].file_id == "file_0_1"
    assert counts(run(spark, changed, workspace)) == (0, 0, 1, 0)
    assert chunk_texts(spark, workspace) == ["a"]
    assert counts(run(spark, changed, workspace, RunOptions(track_embedded=True))) == (0, 1, 0, 1)
    assert chunk_texts(spark, workspace) == ["b"]


def test_update_time_alone_is_no_change(spark, workspace):
    run(spark, articles(spark, (1, "a"), updated="t1"), workspace)
    later = articles(spark, (1, "a"), updated="t2")
    assert counts(run(spark, later, workspace)) == (0, 0, 1, 0)
    assert state(spark, workspace)[1].updated_at == "t1"
    run(spark, later, workspace, SCRAPE)
    assert state(spark, workspace)[1].updated_at == "t2"


def test_repeated_id_in_one_upload(spark, workspace):
    repeated = articles(spark, (1, "a"), (2, "x"), (1, "b"))
    summary = run(spark, repeated, workspace)
    assert counts(summary) == (3, 0, 0, 2)
    assert chunk_texts(spark, workspace) == ["b", "x"]
    assert read_corpus(spark, workspace.corpus).count() == 2
    assert counts(run(spark, repeated, workspace, DRY)) == (0, 1, 2, 0)


def test_injected_sink(spark, workspace):
    seen = {}

    def sink(documents, replaced):
        seen["files"] = sorted(r.filename for r in documents.collect())
        seen["replaced"] = [tuple(r) for r in replaced.collect()]
        return documents.select("id", "page_no", "pos", F.concat(F.lit("ext_"), "filename").alias("file_id"))

    two = articles(spark, (1, "a"), (2, "b"))
    first = run(spark, two, workspace, sink=sink)
    assert counts(first) == (2, 0, 0, 2) and first.first().estimated_chunks >= 2
    assert seen == {"files": ["1-article-1.md", "2-article-2.md"], "replaced": []}
    run(spark, articles(spark, (1, "c"), (2, "b")), workspace, sink=sink)
    assert seen == {"files": ["1-article-1.md"], "replaced": [(1, "ext_1-article-1.md")]}


def test_failed_sink_records_nothing(spark, workspace):
    run(spark, articles(spark, (1, "a")), workspace)

    def sink(documents, replaced):
        raise OSError("store is away")

    changed = articles(spark, (1, "b"), (2, "c"))
    row = run(spark, changed, workspace, sink=sink).first()
    assert (row.added, row.updated, row.files_embedded) == (1, 1, 0)
    assert row.failures == [{"error": "store is away"}]
    assert chunk_texts(spark, workspace) == ["a"]
    assert set(state(spark, workspace)) == {1}
    assert counts(run(spark, changed, workspace)) == (1, 1, 0, 2)
    assert chunk_texts(spark, workspace) == ["b", "c"]


def test_partly_stored_batch_records_what_was_stored(spark, workspace):
    def sink(documents, replaced):
        return documents.filter("id = 1").select("id", "page_no", "pos", F.lit("f").alias("file_id"))

    summary = run(spark, articles(spark, (1, "a"), (2, "b")), workspace, sink=sink)
    assert counts(summary) == (2, 0, 0, 1)
    assert set(state(spark, workspace)) == {1}


def test_a_run_done_again_is_harmless(spark, workspace):
    run(spark, articles(spark, (1, "a")), workspace)
    rows = articles(spark, (1, "b"), (2, "c"))
    for _ in range(2):
        assert counts(run(spark, rows, workspace, run_id="two")) == (1, 1, 0, 2)
    assert chunk_texts(spark, workspace) == ["b", "c"]
    assert read_log(spark, workspace.log).count() == 2
    # what a later run has committed stays when an earlier one is done again
    run(spark, articles(spark, (1, "d")), workspace)
    assert counts(run(spark, rows, workspace, run_id="two")) == (1, 1, 0, 2)
    assert chunk_texts(spark, workspace) == ["c", "d"]
    with pytest.raises(ValueError, match="already written"):
        write_version(spark.range(1), workspace.chunks, 1)


def test_a_run_lost_before_its_commit_goes_on_from_the_newest_state(spark, workspace, monkeypatch):
    """Everything is written but the commit; another run commits; the first is done again."""

    def lost(*_):
        raise OSError("the driver is gone")

    rows = articles(spark, (1, "a"), (2, "b"))
    with monkeypatch.context() as m, pytest.raises(OSError, match="driver"):
        m.setattr("tidemark.plans.sync.commit", lost)
        run(spark, rows, workspace, run_id="first")
    assert state(spark, workspace) == {} and chunk_texts(spark, workspace) == []
    assert counts(run(spark, articles(spark, (2, "b"), (3, "c")), workspace)) == (2, 0, 0, 2)
    assert counts(run(spark, rows, workspace, run_id="first")) == (1, 0, 1, 1)
    assert set(state(spark, workspace)) == {1, 2, 3}
    assert chunk_texts(spark, workspace) == ["a", "b", "c"]
    assert versions(spark, workspace.snapshot) == [0, 1]


def test_two_writers_at_one_time_leave_both_results(spark, workspace):
    """The second run starts and commits while the first one stores its documents."""
    run(spark, articles(spark, (1, "a"), (2, "b")), workspace)
    calls = []

    def sink(documents, replaced):
        if not calls:
            run(spark, articles(spark, (2, "second"), (3, "c")), workspace)
        calls.append(sorted(r.id for r in documents.select("id").collect()))
        return documents.select("id", "page_no", "pos", F.concat(F.lit("x_"), "slug").alias("file_id"))

    first = articles(spark, (1, "new"), (2, "b"), (4, "d"))
    assert counts(run(spark, first, workspace, sink=sink)) == (1, 2, 0, 3)
    # the second try sees what the other run has made of document 2
    assert calls == [[1, 4], [1, 2, 4]]
    assert {i: r.file_id.split("_")[0] for i, r in state(spark, workspace).items()} == {
        1: "x", 2: "x", 3: "file", 4: "x"
    }


def test_confirmed_parts_are_not_handed_over_again(spark, workspace, monkeypatch):
    """Lost in a part, the run goes on with the open parts; lost before its commit,
    it hands over nothing at all."""
    bodies = [(i, f"b{i}") for i in range(40)]
    options = RunOptions(hand_overs=3)
    run(spark, articles(spark, (1, "old")), workspace)
    handed, old, fail = [], [], [2]

    def sink(documents, replaced):
        rows = documents.select("id", "tried", "intent").collect()
        handed.append({r.id: (r.tried, r.intent) for r in rows})
        old.extend(tuple(r) for r in replaced.collect())
        if len(handed) in fail:
            raise KeyboardInterrupt
        return documents.select("id", "page_no", "pos", F.concat(F.lit("x_"), "slug").alias("file_id"))

    with pytest.raises(KeyboardInterrupt):
        run(spark, articles(spark, *bodies), workspace, options, sink=sink, run_id="r")
    assert state(spark, workspace)[1].file_id == "file_0_1"
    with monkeypatch.context() as m, pytest.raises(KeyboardInterrupt):
        m.setattr("tidemark.plans.sync.commit", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt()))
        run(spark, articles(spark, *bodies), workspace, options, sink=sink, run_id="r")
    closed, lost, again, last = handed
    assert not set(closed) & (set(again) | set(last))
    assert len(closed) + len(again) + len(last) == 40
    # the part that was open comes again, under the same keys, and is told apart
    assert {i: key for i, (_, key) in lost.items()} == {
        i: key for i, (tried, key) in (again | last).items() if tried
    }
    done = run(spark, articles(spark, *bodies), workspace, options, sink=sink, run_id="r")
    assert counts(done) == (39, 1, 0, 40) and len(handed) == 4
    assert {r.file_id[:2] for r in state(spark, workspace).values()} == {"x_"}
    assert set(old) == {(1, "file_0_1")}


def test_a_failed_part_leaves_the_parts_before_it(spark, workspace):
    bodies, calls = [(i, f"b{i}") for i in range(40)], []

    def sink(documents, replaced):
        calls.append([r.id for r in documents.select("id").collect()])
        if len(calls) == 2:
            raise OSError("store is away")
        return documents.select("id", "page_no", "pos", F.lit("f").alias("file_id"))

    options = RunOptions(hand_overs=3)
    row = run(spark, articles(spark, *bodies), workspace, options, sink=sink).first()
    assert (row.added, row.files_embedded) == (40, len(calls[0]))
    assert row.failures == [{"error": "store is away"}]
    assert set(state(spark, workspace)) == set(calls[0])
    # the next run tries the rest, and tells what was tried before
    run(spark, articles(spark, *bodies), workspace, options, sink=sink)
    assert sorted(i for call in [calls[0], *calls[2:]] for i in call) == list(range(40))


def test_compact_drops_replaced_chunks(spark, workspace, tmp_path):
    run(spark, articles(spark, (1, "a"), (2, "b")), workspace)
    run(spark, articles(spark, (1, "c"), (2, "b")), workspace)
    snapshot = read_snapshot(spark, workspace.snapshot)
    target = compact(spark, workspace.chunks, str(tmp_path / "compact"), snapshot)
    assert spark.read.parquet(target).count() == 2
    whole = compact_corpus(spark, workspace.corpus, str(tmp_path / "corpus"))
    assert spark.read.parquet(whole).count() == 2
    before = {tuple(r) for r in read_corpus(spark, workspace.corpus).collect()}
    assert {tuple(r) for r in read_corpus(spark, str(tmp_path / "corpus")).collect()} == before


def test_one_id_with_a_third_of_all_rows(spark, workspace):
    bodies = [(7 if i % 3 == 0 else 1000 + i, f"b{i % 50}") for i in range(600)]
    summary = run(spark, articles(spark, *bodies), workspace, RunOptions(renderer="flat"))
    assert counts(summary) == (600, 0, 0, 401)
    assert len(state(spark, workspace)) == 401
    rows = articles(spark, *bodies)
    snapshot = read_snapshot(spark, workspace.snapshot)
    assert counts(run(spark, rows, workspace, RunOptions(renderer="flat", dry_run=True)))[2] >= 400
    assert classify(
        rows.select("id", F.lit("x").alias("hash"), "page_no", "pos"), snapshot, upload=True
    ).filter("status = 'UPDATED'").count() == 600


def test_renderer_version_is_recorded(spark, workspace):
    run(spark, articles(spark, (1, "a")), workspace)
    assert state(spark, workspace)[1].renderer_version == "auto-3"


def stream(spark, path, workspace, tmp_path):
    query = sync_new_pages(page_dump_stream(spark, path), workspace, str(tmp_path / "check"))
    assert query.awaitTermination(120)


def test_stream_equals_batch_and_sees_each_page_once(spark, workspace, tmp_path):
    first = [{"articles": [raw(1), raw(2, draft=True)], "next_page": "x"}]
    path = dump(tmp_path / "dump", *first, {"articles": [raw(3)], "next_page": None})
    stream(spark, path, workspace, tmp_path)
    batch = Workspace.under(str(tmp_path / "batch"))
    read = spark.read.schema(page_dump_stream(spark, path).schema).json(path)
    run(spark, articles_of(read.withColumn("page_no", F.expr("articles[0].id"))), batch)
    assert {i: r.hash for i, r in state(spark, workspace).items()} == {
        i: r.hash for i, r in state(spark, batch).items()
    }
    assert chunk_texts(spark, workspace) == ["body 1", "body 3"]
    stream(spark, path, workspace, tmp_path)
    assert versions(spark, workspace.snapshot) == [0]
    (tmp_path / "dump" / "page-9.json").write_text(
        '{"articles": [{"id": 3, "title": "Article 3", "body": "<p>new</p>"}], "next_page": null}'
    )
    stream(spark, path, workspace, tmp_path)
    assert versions(spark, workspace.snapshot) == [0, 1]
    assert chunk_texts(spark, workspace) == ["body 1", "new"]


def test_stream_and_batch_share_one_sequence(spark, workspace, tmp_path):
    run(spark, articles(spark, (1, "a"), (2, "b")), workspace)
    run(spark, articles(spark, (1, "a"), (2, "b2")), workspace)
    path = dump(tmp_path / "dump", {"articles": [raw(3)], "next_page": None})
    stream(spark, path, workspace, tmp_path)
    assert chunk_texts(spark, workspace) == ["a", "b2", "body 3"]
    run(spark, articles(spark, (1, "a2")), workspace)
    assert versions(spark, workspace.snapshot) == [0, 1, 2, 3]
    assert chunk_texts(spark, workspace) == ["a2", "b2", "body 3"]


def test_a_claim_belongs_to_one_run(spark, workspace):
    def own(run_id):
        found = claim(spark, workspace.claims, run_id, *workspace.tables)
        return found.version, found.again

    assert [own(r) for r in ("x", "y", "x")] == [(0, False), (1, False), (0, True)]
    write_version(spark.range(1), workspace.corpus, 5)
    assert own(batch_run("check", 1)) == (6, False)
    assert own(batch_run("check", 1)) == (6, True)


@pytest.mark.parametrize("scheme", ["file", "other"])
def test_one_of_many_writers_makes_a_file(spark, tmp_path, monkeypatch, scheme):
    if scheme == "other":

        def link(draft, target):
            paths = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (draft, target))
            storage._rename_once(spark, *paths)

        monkeypatch.setattr(storage.os, "link", link)
    path = str(tmp_path / "made" / "7")
    with ThreadPoolExecutor(1 if scheme == "other" else 8) as pool:
        made = list(pool.map(lambda n: create_once(spark, path, f"writer {n}"), range(16)))
    assert sum(made) == 1
    assert storage.read_small(spark, path) == f"writer {made.index(True)}"
    assert {p.name for p in (tmp_path / "made").iterdir()} <= {"7", ".7.crc"}


def test_claims_at_one_time_differ(spark, workspace):
    with ThreadPoolExecutor(8) as pool:
        found = list(pool.map(lambda n: claim(spark, workspace.claims, f"run {n}"), range(24)))
    assert sorted(c.version for c in found) == list(range(24))


def test_keeping_states_goes_by_their_commits(spark, workspace):
    for body in "abcd":
        run(spark, articles(spark, (1, body)), workspace)
    write_version(spark.range(1), workspace.snapshot, 9)  # of a run under way
    assert storage.keep_newest(spark, workspace.snapshot, 2) == [0, 1]
    assert versions(spark, workspace.snapshot) == [2, 3, 9]
    run(spark, articles(spark, (2, "e")), workspace)
    assert set(state(spark, workspace)) == {1, 2}


@pytest.mark.parametrize("n", [1, 40])
def test_few_changes_leave_text_out_of_every_shuffle(spark, n):
    wide = spark.range(4000).selectExpr("id", "1L AS page_no", "0 AS pos", "repeat('x', 500) AS md_text")
    keys = staged(wide.select("id", "page_no", "pos").limit(n), "keys")
    found = rows_with_keys(wide, keys, ["id", "page_no", "pos"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastExchange" in plan
    assert found.count() == n


def test_scratch_folder_is_the_one_the_cluster_names():
    def session(master, **settings):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda key, default: settings.get(key, default)),
            sparkContext=SimpleNamespace(master=master, applicationId="app"),
        )

    named = {"spark.checkpoint.dir": "hdfs://shared/scratch/"}
    assert scratch_root(session("yarn", **named)) == "hdfs://shared/scratch"
    assert scratch_root(session("local[2]", **named)) == "hdfs://shared/scratch"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(session("yarn"))
