import json

import pytest
from pyspark.sql import functions as F

from tidemark import storage
from tidemark.operators.summary import delta_totals, is_failed, run_summary
from tidemark.schemas import PAGE, SNAPSHOT
from tidemark.sources import corpus, pages, runlog, snapshot


def raw(i, **extra):
    return {
        "id": i, "title": f"Article {i}", "body": f"<p>body {i}</p>",
        "html_url": f"https://e.com/articles/{i}", "updated_at": "2024-01-01T00:00:00Z",
        "locale": "en-us", "draft": False, **extra,
    }


def dump(path, *page_list, indent=None):
    path.mkdir(parents=True, exist_ok=True)
    for i, page in enumerate(page_list):
        (path / f"page-{i}.json").write_text(json.dumps(page, indent=indent))
    return str(path)


@pytest.mark.parametrize("multi_line", [False, True])
def test_pages_are_followed_in_order(spark, tmp_path, multi_line):
    path = dump(
        tmp_path / "dump",
        {"articles": [raw(1), raw(2)], "next_page": "p2"},
        {"articles": [raw(3)], "next_page": None},
        {"articles": [raw(4)], "next_page": None},
        indent=2 if multi_line else None,
    )
    read = pages.read_page_dumps(spark, path, multi_line)
    found = pages.articles_of(read, follow=True)
    assert [r.id for r in found.orderBy("page_no", "pos").collect()] == [1, 2, 3]
    assert pages.articles_of(read).count() == 4


def test_page_limit_counts_pages_followed(spark, tmp_path):
    (tmp_path / "d").mkdir()
    for i in range(12):
        page = {"articles": [raw(i)], "next_page": "x"}
        (tmp_path / "d" / f"page-{i + 5}.json").write_text(json.dumps(page))
    read = pages.read_page_dumps(spark, str(tmp_path / "d"))
    assert pages.articles_of(read).count() == 12
    assert sorted(r.id for r in pages.articles_of(read, max_pages=3).collect()) == [0, 1, 2]


def test_crawls_end_on_their_own(spark, tmp_path):
    for crawl, numbers in (("a", (1, 3)), ("b", (2, 4, 6))):
        (tmp_path / crawl).mkdir()
        for n in numbers:
            page = {"articles": [raw(n)], "next_page": None if n in (1, 4) else "x"}
            (tmp_path / crawl / f"page-{n}.json").write_text(json.dumps(page))
    read = pages.read_page_dumps(spark, str(tmp_path / "*"))
    followed = pages.followed_pages(read)
    assert sorted((r.crawl, r.page_no) for r in followed.collect()) == [("a", 1), ("b", 2), ("b", 4)]
    assert pages.articles_of(read).count() == 5


@pytest.mark.parametrize("lines,name,problem", [
    ([{"articles": [raw(1)]}, {"articles": [raw(2)]}], "page-1.json", "share a number"),
    ([{"articles": [raw(1)]}], "dump.json", "no number"),
])
def test_pages_of_open_order_are_refused(spark, tmp_path, lines, name, problem):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / name).write_text("\n".join(map(json.dumps, lines)))
    with pytest.raises(ValueError, match=problem):
        pages.articles_of(pages.read_page_dumps(spark, str(tmp_path / "d")))


def test_drafts_defaults_and_missing_articles(spark, tmp_path):
    sparse = {"id": 2, "title": "  T ", "body": None, "locale": ""}
    path = dump(
        tmp_path / "d",
        {"articles": [raw(1, draft=True), sparse, {"id": 3}, raw(4, draft=None)], "next_page": "x"},
        {"next_page": "y"},
        {"articles": [], "next_page": None},
    )
    rows = pages.articles_of(pages.read_page_dumps(spark, path), "de-at").orderBy("id").collect()
    assert [r.id for r in rows] == [2, 3, 4]
    assert rows[0][1:6] == ("T", "", "", "", "")
    assert rows[1][1:6] == ("", "", "", "", "de-at")


def test_page_schema_is_read_as_given(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "page-0.json").write_text('{"articles": [{"id": 10259143299219}]}')
    read = pages.read_page_dumps(spark, str(tmp_path / "d"))
    assert sorted((f.name, f.dataType.simpleString()) for f in read.schema) == sorted(
        (f.name, f.dataType.simpleString()) for f in PAGE
    )
    assert read.first().articles[0].id == 10259143299219


ENTRIES = [
    (42, "h", "42-foo", "t", "file_42", None, None),
    (7, "i", "7-b", "t", None, None, None),
]


@pytest.mark.parametrize("multi_line", [False, True])
def test_snapshot_json_round_trip(spark, tmp_path, multi_line):
    path = str(tmp_path / "s")
    entries = spark.createDataFrame(ENTRIES, SNAPSHOT)
    if multi_line:
        body = {
            str(i): {"hash": h, "slug": s, "updatedAt": t, "fileId": f}
            for i, h, s, t, f, *_ in ENTRIES
        }
        (tmp_path / "s").write_text(json.dumps({"articles": body}, indent=2))
    else:
        snapshot.write_snapshot_json(entries, path)
    read = snapshot.read_snapshot_json(spark, path, multi_line)
    columns = ["id", "hash", "slug", "updated_at", "file_id"]
    assert sorted(read.select(columns).collect()) == sorted(entries.select(columns).collect())


def test_missing_and_broken_snapshots_are_empty(spark, tmp_path):
    assert snapshot.read_snapshot_json(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "broken.json").write_text('{"articles": {"1": ')
    broken = snapshot.read_snapshot_json(spark, str(tmp_path / "broken.json"), multi_line=True)
    assert broken.count() == 0
    assert snapshot.read_snapshot(spark, str(tmp_path / "none")).count() == 0


def test_only_committed_versions_count(spark, tmp_path):
    root = str(tmp_path / "t")
    entries = spark.createDataFrame(ENTRIES, SNAPSHOT)
    snapshot.write_snapshot(entries, root, 0)
    snapshot.write_snapshot(entries.limit(1), root, 10)
    (tmp_path / "t" / "version=11").mkdir()
    assert storage.versions(spark, root) == [0, 10]
    assert snapshot.read_snapshot(spark, root).count() == 1
    assert snapshot.read_snapshot(spark, root, before=10).count() == 2
    assert storage.next_version(spark, root) == 12
    with pytest.raises(ValueError, match="already written"):
        snapshot.write_snapshot(entries, root, 10)
    assert storage.keep_newest(spark, root, 1) == [0]
    assert storage.versions(spark, root) == [10]


def test_markdown_files(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    text = "# T\n\nArticle URL: https://e.com/5\nArticle ID: 5\n\nbody\n\nmore\n"
    (tmp_path / "a" / "5-t.md").write_text(text)
    (tmp_path / "a" / "b" / "x.md").write_text("no header")
    (tmp_path / "a" / "skip.txt").write_text("no")
    read = corpus.read_markdown_files(spark, str(tmp_path / "a"))
    rows = {r.filename: r for r in corpus.parse_headers(read).collect()}
    assert set(rows) == {"5-t.md", "x.md"}
    assert rows["5-t.md"].md_text == text
    assert rows["5-t.md"][2:] == ("T", "https://e.com/5", 5)
    assert rows["x.md"].id is None
    assert corpus.read_markdown_files(spark, str(tmp_path / "none")).count() == 0


def test_corpus_delta_takes_the_last_of_a_name(spark):
    documents = spark.createDataFrame(
        [("a.md", 1, "h1", 0, 0), ("a.md", 1, "h2", 3, 0), ("b.md", 2, "h3", 1, 0), ("c.md", 3, "h4", 1, 1)],
        "filename string, id long, hash string, page_no long, pos int",
    )
    current = spark.createDataFrame([("b.md", "h3"), ("c.md", "x"), ("d.md", "y")], "filename string, hash string")
    keys = corpus.corpus_delta(documents, current)
    assert sorted(tuple(r) for r in keys.collect()) == [(1, 3, 0), (3, 1, 1)]


def test_run_log(spark, tmp_path):
    path = str(tmp_path / "log")
    classified = spark.createDataFrame(
        [("ADDED", 2), ("UPDATED", 3), ("SKIPPED", 9)], "status string, est_chunks long"
    )
    done = run_summary(delta_totals(classified), files_embedded=2, store_id="vs")
    failed = run_summary(delta_totals(classified.limit(0)), scrape_only=True, error="boom")
    runlog.append_log(done, path, runlog.RUN_COMPLETE)
    runlog.append_log(failed, path, runlog.RUN_COMPLETE)
    runlog.append_log(failed.select("added"), path, "other", "ERROR")
    history = runlog.run_history(runlog.read_log(spark, path))
    rows = history.select("*", is_failed().alias("failed")).orderBy("added").collect()
    assert [(r.added, r.updated, r.skipped, r.files_embedded, r.estimated_chunks) for r in rows] == [
        (0, 0, 0, 0, 0), (1, 1, 1, 2, 5),
    ]
    assert [(r.mode, r.failures, r.failed) for r in rows] == [
        ("scrape_only", [{"error": "boom"}], True), ("upload", [], False),
    ]


def test_log_fields_may_not_replace_base_keys():
    with pytest.raises(ValueError, match="level"):
        runlog.log_line("m", fields=["level", "added"])


def linked(spark, *rows):
    """Pages (crawl, address, next_page, page_no), each with an article of its own."""
    pages_ = [([(i, f"A{i}", "b", "u", "t", "en", False)], *row) for i, row in enumerate(rows)]
    kind = "array<struct<id:long,title:string,body:string,html_url:string,updated_at:string,locale:string,draft:boolean>>"
    return spark.createDataFrame(
        pages_, f"articles {kind}, crawl string, address string, next_page string, page_no long"
    )


def test_a_chain_follows_links_and_not_numbers(spark):
    found = linked(
        spark,
        ("a", "a2", "a3", None),
        ("a", "a1", "a2", None),
        ("a", "a3", "a1", None),  # back to the start: no page without a link to it
        ("b", "b9", None, 1),
        ("b", "b1", "b5", 9),
        ("b", "b5", "b9", 4),
        ("b", "gone", "b9", 30),  # leads into the chain, but starts later
        ("c", "c1", "c2", 1),
        ("c", "c2", "c3", 2),
        ("c", "c3", "c2", 3),  # a loop behind the start
        ("d", "d1", "not captured", None),
        ("d", "d1", "not captured", None),  # captured twice
    )
    chain = pages.page_chain(found).collect()
    assert sorted((r.address, r.place) for r in chain) == [
        ("a1", 0), ("a2", 1), ("a3", 2),
        ("b1", 0), ("b5", 1), ("b9", 2),
        ("c1", 0), ("c2", 1), ("c3", 2),
        ("d1", 0),
    ]
    assert pages.page_chain(found.limit(0)).count() == 0
    first = pages.followed_pages(found.where("crawl <> 'd'"), 2)
    assert {r.address for r in first.collect()} == {"a1", "a2", "b1", "b5", "c1", "c2"}


def test_long_chains_need_few_rounds(spark):
    rows = [("x", f"p{i}", f"p{i + 1}", None) for i in range(37)]
    chain = pages.page_chain(linked(spark, *reversed(rows)))
    assert sorted((r.place, r.address) for r in chain.collect()) == [(i, f"p{i}") for i in range(37)]


def test_crawls_with_the_same_numbers_follow_one_another(spark):
    both = linked(spark, ("b", None, None, 1), ("a", None, "x", 1), ("a", None, None, 2), ("b", None, "x", 0))
    found = pages.ordered_pages(both).orderBy("page_no").collect()
    assert [r.articles[0].id for r in found] == [1, 2, 3, 0]
    assert pages.articles_of(both).count() == 4
    lost = linked(spark, ("a", "a1", None, None), ("a", "zz", None, None))
    with pytest.raises(ValueError, match="1 pages have no order"):
        pages.articles_of(lost)
    assert pages.articles_of(lost, follow=True).count() == 1


def test_pages_of_a_crawl_are_not_gathered(spark):
    """A row per crawl is sent to the pages; dealt by crawl, two crawls would be two tasks."""
    found = spark.range(8, numPartitions=4).select(
        F.when(F.col("id") < 4, "a").otherwise("b").alias("crawl"),
        (F.col("id") % 4 + 1).alias("page_no"),
        F.array().cast("array<struct<id:bigint>>").alias("articles"),
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        ordered, followed = pages.ordered_pages(found), pages.followed_pages(found)
        plans = [rows._jdf.queryExecution().executedPlan().toString() for rows in (ordered, followed)]
        assert sorted(r.page_no for r in ordered.collect()) == [1, 2, 3, 4, 6, 7, 8, 9]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert all("BroadcastHashJoin" in plan and "SortMergeJoin" not in plan for plan in plans)
