"""Hard negatives against brute force, and what a search may skip."""

import math

import numpy as np
import pytest

from tidemark.llm import multi_index

SCHEMA = "vec_id long, vector array<float>, label int, rank int, score string, cell long, slot long"


def table(spark, rows):
    return spark.createDataFrame([(i, v, c, 1, "c", 2, 3) for i, v, c in rows], SCHEMA)


def clustered(n, dim, seed=0, spread=0.5):
    rng = np.random.default_rng(seed)
    own = rng.integers(0, 10, n)
    centres = rng.standard_normal((10, dim))
    made = centres[own] + spread * rng.standard_normal((n, dim))
    made /= np.linalg.norm(made, axis=1, keepdims=True)
    labels = np.where(rng.random(n) < 0.7, own, rng.integers(0, 10, n))
    return made.astype(np.float32), labels


def brute(rows, anchors, n_positives=5, n_negatives=3):
    whole = [
        (i, np.floor(256 * np.array(v, dtype=np.float32).astype(np.float64)).astype(int), c)
        for i, v, c in rows
    ]
    out = []
    for own, vector, label in whole:
        if own not in anchors:
            continue
        scored = sorted(
            (-int(v @ vector), i, c) for i, v, c in whole if i != own and len(v) == len(vector)
        )
        positives = [(i, -s) for s, i, c in scored if c == label][:n_positives]
        for positive, score in positives:
            fits = [
                (i, -s) for s, i, c in scored if c != label and 50 * score <= -100 * s <= 95 * score
            ]
            for rank, (i, s) in enumerate(fits[:n_negatives], 1):
                out.append((own, positive, rank, i, score, s))
    return sorted(out)


def found(vectors, anchors, **options):
    return sorted(map(tuple, multi_index.hard_negatives(vectors, anchors, **options).collect()))


@pytest.mark.parametrize("rows_a_block", [64, 32_768])
def test_equals_brute_force(spark, monkeypatch, rows_a_block):
    monkeypatch.setattr(multi_index, "BLOCK_ROWS", rows_a_block)
    monkeypatch.setattr(multi_index, "CHUNK_ROWS", 7)
    vectors, labels = clustered(700, 17)
    vectors[200:230] = vectors[200]  # ties at every boundary
    rows = [(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(vectors, labels, strict=True))]
    df = table(spark, rows).repartition(3)
    expected = brute(rows, set(range(0, 700, 50)))
    assert len(expected) > 100
    assert found(df, df.where("vec_id % 50 = 0")) == expected


def test_other_numbers_and_windows(spark):
    vectors, labels = clustered(300, 6, seed=2)
    rows = [(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(vectors, labels, strict=True))]
    df = table(spark, rows)
    expected = brute(rows, {0, 100}, n_positives=2, n_negatives=7)
    assert found(df, df.where("vec_id in (0, 100)"), n_positives=2, n_negatives=7) == expected


ODD = [
    (0, [1.0, 0.5, 0.25], 1),
    (1, [1.0, 0.5, 0.25], 1),
    (1, [1.0, 0.5, 0.25], 1),
    (2, None, 1),
    (3, [1.0, None, 0.0], 1),
    (4, [math.nan, 0.0, 0.0], 2),
    (5, [math.inf, 0.0, 0.0], 2),
    (6, [0.7, 0.5, 0.25], 2),
    (6, [0.7, 0.5, 0.25], 2),
    (7, [0.8, 0.4, 0.2], None),
    (8, [-1.0, -0.5, -0.25], 1),
    (9, [0.5], 1),
    (10, [0.5], 2),
    (None, [1.0, 1.0, 1.0], 2),
    (11, [], 1),
]


def test_odd_rows(spark):
    df = table(spark, ODD)
    rows = found(df, df.where("vec_id in (0, 2, 7, 9) or vec_id is null"))
    # the repeated id is a candidate twice; row 8's score is negative: no window
    own = 256 * 256 + 128 * 128 + 64 * 64
    other = 179 * 256 + 128 * 128 + 64 * 64
    assert rows == sorted((0, 1, rank, 6, own, other) for rank in (1, 2) for _ in range(2))
    assert found(df.limit(0), df) == [] and found(df, df.limit(0)) == []


def test_a_repeated_anchor_counts_once(spark):
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, [1.0, 0.1], 1), (2, [0.8, 0.0], 2)]
    df = table(spark, rows)
    assert len(found(df, df.where("vec_id = 0"))) == 1


def test_cells_fall_and_bounds_hold():
    vectors, labels = clustered(2000, 16, seed=5, spread=0.2)
    whole = multi_index.quantised(vectors.astype(np.float64))
    books = {16: (multi_index.codebook(whole[:300, :8]), multi_index.codebook(whole[:300, 8:]))}
    matrix = np.c_[vectors.astype(np.float64), labels]
    block = multi_index.Block(multi_index.index_block(np.arange(2000), matrix, books))
    skipped = 0
    for own in range(0, 2000, 97):
        seen, last = [], np.inf
        for rows, scores, top in multi_index.visited(block, whole[own]):
            assert top <= last
            seen += block.ids[rows].tolist()
            assert scores.tolist() == (whole[block.ids[rows]] @ whole[own]).astype(int).tolist()
            rest = np.setdiff1d(np.arange(2000), seen)
            assert not len(rest) or (whole[rest] @ whole[own]).max() <= top
            last = top
        assert sorted(seen) == list(range(2000))
        wanted = multi_index.Wanted(5)
        for rows, scores, top in multi_index.visited(block, whole[own]):
            skipped += 1
            wanted.meet(block.ids[rows], scores)
            if wanted.certified(top):
                skipped -= 1
                break
    assert skipped < 21 * 6  # most searches stop before the last step
