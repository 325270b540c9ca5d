"""Exact and approximate search against brute force."""

import math

import numpy as np
import pytest

from tidemark.llm import bit_sliced, one_bit

SCHEMA = "vec_id long, vector array<float>, rank int, score string, block long"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "c", 2) for i, v in rows], SCHEMA)


def clustered(n, dim, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, dim))
    made = centres[rng.integers(0, 12, n)] + 0.6 * rng.standard_normal((n, dim))
    return (made / np.linalg.norm(made, axis=1, keepdims=True)).astype(np.float32)


def brute(ids, scores, own, k):
    order = sorted((-s, i) for i, s in zip(ids, scores, strict=True) if i != own)[:k]
    return [(i, -s) for s, i in order]


@pytest.mark.parametrize("k", [1, 10])
def test_bit_sliced_equals_brute_force(spark, k):
    vectors = clustered(700, 24)
    vectors[100:160] = vectors[100]  # ties at every boundary
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    df = table(spark, rows).repartition(3)
    found = bit_sliced.exact_top_k(df, df.where("vec_id % 50 = 0"), k).collect()
    whole = np.floor(1024 * vectors.astype(np.float64)).astype(int)
    for own in range(0, 700, 50):
        mine = sorted((r.rank, r.vec_id, r.score) for r in found if r.query_id == own)
        expected = brute(range(700), (whole @ whole[own]).tolist(), own, k)
        assert mine == [(n, i, s) for n, (i, s) in enumerate(expected, 1)]


def test_added_bitmaps_count_their_bits():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 7, 20):
        bits = rng.integers(0, 2, (2, n, 64)).astype(np.uint8)
        maps = np.packbits(bits, axis=-1, bitorder="little").view(np.uint64)
        total, carries = bit_sliced.added(maps)
        low = np.unpackbits(total.view(np.uint8), axis=-1, bitorder="little")
        high = sum(
            np.unpackbits(c.view(np.uint8), axis=-1, bitorder="little").astype(int).sum(axis=1)
            for c in carries
        )
        assert (low + 2 * high == bits.sum(axis=1)).all()


ODD_VECTORS = [
    (0, [1.0, 0.5, -0.25]),
    (1, [1.0, 0.5, -0.25]),
    (1, [1.0, 0.5, -0.25]),
    (2, None),
    (3, [1.0, None, 0.0]),
    (4, [math.nan, 0.0, 0.0]),
    (5, [math.inf, 0.0, 0.0]),
    (6, [0.0, 0.0, 0.0]),
    (7, [-1.0, -0.5, 0.25]),
    (8, [1.0, 2.0]),
    (None, [1.0, 1.0, 1.0]),
]


def test_odd_vectors(spark):
    df = table(spark, ODD_VECTORS)
    exact = bit_sliced.exact_top_k(df, df.where("vec_id in (0, 2, 4, 8)"), 10).collect()
    assert {r.query_id for r in exact} == {0}
    assert [r.vec_id for r in sorted(exact, key=lambda r: r.rank)] == [1, 1, 6, 7]
    near = one_bit.nearest(df, df.where("vec_id in (0, 6)"), 10).collect()
    found = [(r.query_id, r.vec_id) for r in sorted(near, key=lambda r: r.rank)]
    assert found == [(0, 1), (0, 1), (0, 7)]
    for search in (bit_sliced.exact_top_k, one_bit.nearest):
        assert search(df.limit(0), df.where("vec_id = 0"), 3).count() == 0
        assert search(df, df.limit(0), 3).count() == 0


def test_one_bit_recall_and_exact_scores(spark):
    vectors = clustered(3000, 64, seed=4)
    vectors[500:540] = vectors[500]
    df = table(spark, [(i, v.tolist()) for i, v in enumerate(vectors)]).repartition(2)
    found = one_bit.nearest(df, df.where("vec_id % 100 = 0"), 20).collect()
    whole, hits = vectors.astype(np.float64), 0
    for own in range(0, 3000, 100):
        mine = sorted((r.rank, r.vec_id, r.score) for r in found if r.query_id == own)
        assert [m[0] for m in mine] == list(range(1, 21))
        assert mine == sorted(mine, key=lambda m: (-m[2], m[1]))
        assert all(abs(s - whole[own] @ whole[i]) < 1e-12 for _, i, s in mine)
        expected = brute(range(3000), (whole * whole[own]).sum(axis=1).tolist(), own, 20)
        hits += len({i for _, i, _ in mine} & {i for i, _ in expected})
    assert hits / 600 >= 0.95
