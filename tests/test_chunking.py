import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import chunking


def expected_chunks(text, max_tokens, overlap):
    size, step = max_tokens * 4, (max_tokens - overlap) * 4
    # UTF-16 units: a character of two units stands for its first
    units = [u for c in text for u in ([c, ""] if ord(c) > 0xFFFF else [c])]
    tokens = max(1, len(units) // 4)
    n = 1 if tokens <= max_tokens else max(1, -(-(tokens - overlap) // (max_tokens - overlap)))
    starts = [i * step for i in range(n)]
    cut = [units[s : s + size] for s in starts[:-1]] + [units[starts[-1] :]]
    return ["".join(c) for c in cut]


def split(spark, texts, max_tokens, overlap):
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, md_text string")
    chunks = chunking.split_chunks(rows, max_tokens=max_tokens, overlap=overlap)
    found = {}
    for row in chunks.orderBy("id", "chunk_no").collect():
        found.setdefault(row.id, []).append(row.text)
    return [found[i] for i in range(len(texts))]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.text(st.sampled_from("ab \n😀é"), max_size=300), min_size=1, max_size=8),
    st.sampled_from([(5, 0), (5, 2), (6, 3), (7, 6), (40, 1)]),
)
def test_chunks_equal_brute_force(spark, texts, shape):
    assert split(spark, texts, *shape) == [expected_chunks(t, *shape) for t in texts]


@pytest.mark.parametrize("length", [3200, 3203, 3204, 4803, 8000, 8001])
def test_default_chunks_cover_the_text(spark, length):
    text = "".join(chr(97 + i % 26) for i in range(length))
    [chunks] = split(spark, [text], 800, 400)
    rebuilt = chunks[0] + "".join(c[1600:] for c in chunks[1:])
    assert rebuilt == text


@pytest.mark.parametrize("overlap", [800, 900, -1])
def test_impossible_overlap_is_refused(spark, overlap):
    with pytest.raises(ValueError, match="overlap"):
        chunking.chunk_texts(F.lit("x"), 800, overlap)


def files(spark, *rows):
    return spark.createDataFrame(
        [(i, f, f"{i}.md", "u", t) for i, f, t in rows],
        "id long, file_id string, filename string, url string, md_text string",
    )


def test_replace_on_update_leaves_one_version(spark):
    old = chunking.chunk_rows(files(spark, (1, "f1", "a"), (2, "f2", "b")))
    changed = files(spark, (2, "f2b", "c"), (3, "f3", "d"))
    replaced = changed.select(F.col("id").alias("doc_id"))
    table = chunking.replace_on_update(old, chunking.chunk_rows(changed), replaced)
    found = sorted((r.chunk_id, r.doc_id, r.text) for r in table.collect())
    assert found == [("f1#0", 1, "a"), ("f2b#0", 2, "c"), ("f3#0", 3, "d")]
    assert [r.chunk_id for r in chunking.deleted_rows(old, replaced).collect()] == ["f2#0"]


def test_live_chunks_follow_the_snapshot(spark):
    chunks = chunking.chunk_rows(files(spark, (1, "old", "a"), (1, "new", "b"), (2, "x", "c")))
    snapshot = spark.createDataFrame([("new",), (None,)], "file_id string")
    assert [r.text for r in chunking.live_chunks(chunks, snapshot).collect()] == ["b"]
