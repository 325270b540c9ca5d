"""The min-max join against all pairs, and its estimates against the sets."""

import itertools
import random

import numpy as np
import pytest

from tests.llm.conftest import ODD, SAME
from tidemark.llm import links, minmax_join, parity_join
from tidemark.llm.shingles import linked, shared, shingle_sets


def made(n, kept, total, rng):
    """Two sets of random hashes with `kept` of `total` members in common."""
    whole = rng.integers(0, 1 << 63, total).astype(np.uint64) * np.uint64(2)
    own = (total - kept) // 2
    return np.unique(whole[: kept + own]), np.unique(np.r_[whole[:kept], whole[kept + own :]])


def plain(rows, percent=85):
    """(doc_id, n_shingles, component_id) by all pairs."""
    sets = shingle_sets([t for _, t in rows])
    label = {i: i for i, _ in rows if i is not None}
    edges = [
        (rows[x][0], rows[y][0])
        for x, y in itertools.combinations(range(len(rows)), 2)
        if None not in (rows[x][0], rows[y][0]) and linked(sets[x], sets[y], percent)
    ]
    for _ in rows:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    return {(i, len(s), label.get(i)) for (i, _), s in zip(rows, sets, strict=True)}


def family(seed):
    """Texts in families: copies, near copies around the threshold, chains, others."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(4000)]
    rows, at = [], 0
    for _ in range(14):
        base = [rng.choice(words) for _ in range(rng.choice((3, 30, 80, 200)))]
        for _ in range(rng.randint(1, 9)):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 60))):
                text[rng.randrange(len(text))] = rng.choice(words)
            if rng.random() < 0.3:
                base = text
            rows.append((at, " ".join(text)))
            at += rng.randint(1, 3)
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [0, 1])
def test_components_equal_all_pairs(spark, seed, monkeypatch):
    monkeypatch.setattr(links, "BLOCK", 8)
    monkeypatch.setattr(links, "CHECKED", 4)
    rows = family(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = minmax_join.near_copies(df).collect()
    assert {tuple(r) for r in found} == plain(rows)


def test_links_that_the_pivot_does_not_have_are_found(spark):
    """All share a passage, and so keys; only some of the others link."""
    rng = random.Random(4)
    common = [f"c{i}" for i in range(120)]
    rows = []
    for group in range(12):
        own = [f"g{group}x{i}" for i in range(60)]
        for copy in range(3):
            rows.append((100 * group + copy, " ".join([*common, *own, f"z{rng.random()}"])))
    found = minmax_join.near_copies(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {tuple(r) for r in found.collect()} == plain(rows)


def test_texts_just_below_the_threshold_are_hardly_read():
    """Sketches rule out pairs that are alike but do not link."""
    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 63, 300).astype(np.uint64) * np.uint64(2)
    sets = []
    for _ in range(200):
        kept = rng.permutation(base)[:268]
        sets.append(np.unique(np.r_[kept, rng.integers(0, 1 << 63, 32).astype(np.uint64)]))
    sizes = np.array([len(s) for s in sets])
    found = parity_join.near(
        np.arange(200), np.zeros(200), sizes, [parity_join.bit_sketch(s) for s in sets], True, 85
    )
    linking = sum(linked(a, b, 85) for a, b in itertools.combinations(sets, 2))
    assert linking <= len(found[0]) <= linking + 100


def test_signatures_estimate_similarity_without_bias():
    rng = np.random.default_rng(1)
    for kept, total in ((85, 100), (30, 100), (450, 500)):
        errors = []
        for _ in range(60):
            a, b = made(2, kept, total, rng)
            x, y = minmax_join.signatures([a, b])
            true = shared(a, b) / (len(a) + len(b) - shared(a, b))
            errors.append((x == y).mean() - true)
        assert abs(np.mean(errors)) < 0.01
        # the variance of as many independent values, or less
        s = kept / total
        assert np.var(errors) < 1.5 * s * (1 - s) / minmax_join.VALUES


def test_pairs_at_the_threshold_share_a_band_and_pass():
    rng = np.random.default_rng(2)
    for _ in range(150):
        size = int(rng.integers(20, 400)) * 20
        a, b = made(2, size * 85 // 100, size, rng)
        x, y = minmax_join.signatures([a, b])
        keys = minmax_join.band_keys(np.stack([x, y]))
        assert (keys[0] == keys[1]).any()
        if linked(a, b, 85):
            sketch = parity_join.bit_sketch(a), parity_join.bit_sketch(b)
            assert parity_join.may_link(*sketch, len(a), len(b), 85)


def test_unrelated_sets_share_no_band():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 1 << 63, 60).astype(np.uint64)) for _ in range(3000)]
    keys = minmax_join.band_keys(minmax_join.signatures(sets))
    assert len(np.unique(keys)) == keys.size


def test_odd_rows(odd, none):
    rows = {tuple(r) for r in minmax_join.near_copies(odd).collect()}
    empty = {(1, 0, 1), (2, 0, 2), (6, 0, 6)}
    assert empty | {(4, 6, 4), (5, 6, 4), (7, 1, 7), (8, 1, 7), (None, 7, None)} <= rows
    assert minmax_join.near_copies(odd).count() == len(ODD)
    assert minmax_join.near_copies(none).count() == 0


def test_an_id_with_two_texts_has_the_links_of_both(spark):
    other = "a second text of seven words here"
    rows = [(3, SAME), (9, SAME), (9, other), (12, other), (20, "something else of five words")]
    found = minmax_join.near_copies(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {(r.doc_id, r.component_id) for r in found.collect()} == {(3, 3), (9, 3), (12, 3), (20, 20)}
