"""Pruned search against plain scores, and what it leaves unread."""

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.operators import postings
from tidemark.operators.postings import Postings, best_in_block, first_of_block, index_parts
from tidemark.session import staged


def block_of(rows, monkeypatch=None):
    columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(2)]
    words = pa.array([r[2] for r in rows], pa.list_(pa.int64()))
    batch = pa.RecordBatch.from_arrays([*columns, words], names=["doc_id", "item_id", "terms"])
    [(_, data)] = index_parts([batch])
    return Postings(data)


def zipf_rows(n, seed=0, vocabulary=3000):
    rng = np.random.default_rng(seed)
    return [
        (i // 3, i, np.minimum(rng.zipf(1.3, rng.integers(0, 60)), vocabulary).tolist())
        for i in range(n)
    ]


def weights_of(rows, terms):
    df = np.array([sum(t in set(r[2]) for r in rows) for t in terms])
    return np.log((len(rows) + 1) / (df + 1))


def plain(rows, terms, weights, k, per_doc):
    scored = []
    for doc, item, words in rows:
        score = sum(words.count(t) * w for t, w in zip(terms, weights, strict=True))
        if score > 0:
            scored.append((-round(score, 6), doc if per_doc else item, item, doc))
    scored.sort()
    if per_doc:
        best = {}
        for row in scored:
            best.setdefault(row[3], row)
        scored = list(best.values())
    return [(doc, item, -s) for s, _, item, doc in scored[:k]]


@pytest.mark.parametrize("per_doc", [False, True])
@pytest.mark.parametrize("k", [1, 3, 20])
def test_pruned_search_equals_plain_scores(k, per_doc):
    rows = zipf_rows(900)
    block, score = block_of(rows), np.zeros(900)
    rng = np.random.default_rng(1)
    for _ in range(25):
        terms = np.unique(np.r_[rng.zipf(1.3, 8), 10**9])
        weights = weights_of(rows, terms.tolist())
        terms, weights = terms[weights > 0], weights[weights > 0]
        kept, points, read, total = best_in_block(block, terms, weights, k, per_doc, score)
        first = first_of_block(block, kept, points, k, per_doc)
        found = [
            (int(block.docs[i]), int(block.ids[i]), float(s))
            for i, s in zip(kept[first], points[first], strict=True)
        ]
        expected = plain(rows, terms.tolist(), weights, k, per_doc)
        assert [f[:2] for f in found] == [e[:2] for e in expected]
        assert [f[2] for f in found] == pytest.approx([e[2] for e in expected], abs=1e-5)
        assert read <= total + postings.STRETCH and not score.any()


def test_postings_of_frequent_words_are_skipped():
    """A seldom word that weighs much, and words of nearly all items that weigh little."""
    rng = np.random.default_rng(2)
    rows = [
        (i, i, [*rng.choice(6, 5).tolist(), *([99] * 3 if i % 1000 == 7 else [])])
        for i in range(20_000)
    ]
    block = block_of(rows)
    terms = np.array([0, 1, 2, 3, 4, 5, 99])
    weights = np.array([0.4, 0.4, 0.4, 0.4, 0.4, 0.4, 7.0])
    kept, points, read, total = best_in_block(block, terms, weights, 3, False, np.zeros(20_000))
    assert read < total / 4
    first = first_of_block(block, kept, points, 3, False)
    assert [int(block.ids[i]) for i in kept[first]] == [
        item for _, item, _ in plain(rows, terms.tolist(), weights, 3, False)
    ]


def test_blocks_are_bounded_and_hold_every_word(monkeypatch):
    monkeypatch.setattr(postings, "CELLS", 50)
    rows = [(i, i, list(range(i))) for i in (0, 10, 20, 30, 120, 5)]
    columns = [pa.array([r[i] for r in rows], pa.int64()) for i in range(2)]
    words = pa.array([r[2] for r in rows], pa.list_(pa.int64()))
    batch = pa.RecordBatch.from_arrays([*columns, words], names=["doc_id", "item_id", "terms"])
    blocks = [Postings(data) for _, data in index_parts([batch])]
    assert [b.docs.tolist() for b in blocks] == [[0, 10, 20], [30], [120], [5]]
    assert [int(b.counts.sum()) for b in blocks] == [30, 30, 120, 5]
    terms, df = blocks[0].vocabulary()
    assert terms.tolist() == list(range(20)) and df.tolist() == [2] * 10 + [1] * 10


def test_blocks_stay_small_whatever_the_batch():
    """A batch of four million words is cut; block and rows are of some megabytes."""
    n, words = 8_000, 500
    rng = np.random.default_rng(3)
    ids = pa.array(np.arange(n), pa.int64())
    terms = pa.ListArray.from_arrays(
        np.arange(0, n * words + 1, words, dtype=np.int32), pa.array(rng.integers(0, 50_000, n * words))
    )
    batch = pa.RecordBatch.from_arrays([ids, ids, terms], names=["doc_id", "item_id", "terms"])
    found = [data for _, data in index_parts([batch])]
    assert max(map(len, found)) < 16 << 20
    assert np.concatenate([Postings(data).docs for data in found]).tolist() == list(range(n))
    assert sum(int(Postings(data).counts.sum()) for data in found) == n * words


def test_large_rows_are_written_in_small_row_groups(spark):
    """A task that writes twelve rows of 6 MB holds no more than a few of them."""
    digits = "transform(sequence(1, 50000), i -> sha2(cast(id * 100000 + i as string), 512))"
    packed = F.expr(f"cast(array_join({digits}, '') as binary)").alias("packed")
    table = staged(spark.range(12, numPartitions=1).select(packed), "large", large_rows=True)
    [path] = table.inputFiles()
    groups = pq.ParquetFile(path.removeprefix("file://")).metadata
    rows = [groups.row_group(i).num_rows for i in range(groups.num_row_groups)]
    assert sum(rows) == 12 and max(rows) <= 6
    assert table.agg(F.sum(F.length("packed"))).first()[0] == 12 * 6_400_000
