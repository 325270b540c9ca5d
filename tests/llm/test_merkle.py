"""The manifest against a plain recursion, and its layout against the rule."""

import hashlib
import zlib

import numpy as np
import pytest

from tidemark.llm import merkle
from tidemark.session import Scratch, scratch_path


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, text):
    out = []
    for value in (row.doc_id, row.source, row.lang, row.n_chars, text):
        own = None if value is None else str(value)
        out.append("-" if own is None else f"{len(own.encode())}:{own}")
    return sha(*out)


def lower(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def plain_path(levels, at):
    steps = []
    for level in levels[:-1]:
        run = level[at - at % 8 : at - at % 8 + 8]
        steps.append((at % 8, run))
        at //= 8
    return steps


def plain_proofs(rows):
    by_lang = {}
    for row in rows:
        by_lang.setdefault(row.lang, []).append(row)
    names = sorted(by_lang, key=lambda name: (name is not None, (name or "").encode()))
    trees = {}
    for name in names:
        own = [(r.doc_id is not None, r.doc_id or 0, plain_leaf(r, r.text), r) for r in by_lang[name]]
        own.sort(key=lambda x: x[:3])
        trees[name] = own, levels_of([x[2] for x in own])
    top = levels_of([trees[name][1][-1][0] for name in names])
    found = []
    for n, name in enumerate(names):
        own, levels = trees[name]
        for at, (_, _, leaf, row) in enumerate(own):
            steps = plain_path(levels, at) + plain_path(top, n)
            proof = sha(*(h for place, run in steps for i, h in enumerate(run) if i != place))
            node = leaf
            if row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 3 == 0:
                node = plain_leaf(row, lower(row.text))
            for place, run in steps:
                node = sha(*run[:place], node, *run[place + 1 :])
            root = top[-1][0]
            found.append((row.doc_id, leaf, levels[-1][0], root, proof, node, node == root))
    return found


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def same(found, rows):
    ours = [tuple(r[c] for c in COLUMNS) for r in found.collect()]
    assert sorted(ours, key=repr) == sorted(plain_proofs(rows), key=repr)


def test_proofs_of_odd_rows(odd, none):
    same(merkle.manifest_proofs(odd), odd.collect())
    assert merkle.manifest_proofs(none).count() == 0
    one = odd.where("doc_id = 7")
    found = merkle.manifest_proofs(one).collect()
    assert found[0].leaf == found[0].root and found[0].proof_sha256 == sha()


def test_proofs_across_blocks(spark, monkeypatch):
    """Trees of one leaf, of whole blocks, of several stages, with ragged ends."""
    monkeypatch.setattr(merkle, "BLOCK_NODES", merkle.FANOUT**merkle.HEIGHT)
    sizes = {None: 1, "aa": 512, "é": 513, "b": 9, "c": 4609}
    rows, number = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            rows.append((number, f"Text {number % 50}", lang, "s", number))
            number += 7
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.repartition(5)
    same(merkle.manifest_proofs(docs), docs.collect())


def test_a_changed_row_fails_and_others_hold(spark):
    rows = [(i, f"UPPER {i}", "en", "s", i) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for r in merkle.manifest_proofs(docs).collect():
        assert r.verified == (zlib.crc32(str(r.doc_id).encode()) % 3 != 0)


def test_manifest_tables_hold_the_root(spark):
    rows = [(i, "t", "en" if i % 2 else None, "s", i) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    folder = scratch_path(spark, "manifest")
    manifest = merkle.write_manifest(docs, folder)
    with Scratch(spark) as scratch:
        proved = merkle.proofs(manifest, scratch).first()
    assert manifest.root.first().root.hex() == proved.root
    assert spark.read.parquet(f"{folder}/leaves").count() == 30


@pytest.mark.parametrize("levels", [1, 2, 3, 4, 5])
def test_layout_is_a_recursive_split(levels):
    """Places are all different, and every split keeps its trees in one piece each."""
    where = {}
    for depth in range(levels):
        at = merkle.addresses(levels, depth, np.arange(merkle.FANOUT**depth))
        where |= {(depth, i): int(p) for i, p in enumerate(at)}
    assert sorted(where.values()) == list(range(merkle.size(levels)))

    def tree(depth, index, height):
        return [
            where[depth + d, index * 8**d + i] for d in range(height) for i in range(8**d)
        ]

    def split(depth, index, height):
        own = sorted(tree(depth, index, height))
        assert own == list(range(own[0], own[0] + merkle.size(height)))
        if height > 1:
            top = height // 2
            split(depth, index, top)
            if depth == 0 or index == 0:
                for i in range(8**top):
                    split(depth + top, index * 8**top + i, height - top)

    split(0, 0, levels)


def test_paths_survive_packing():
    nodes = [sha(str(i)) for i in range(100)]
    block = merkle.built(nodes, 3)
    for leaf in (0, 7, 63, 99):
        steps = merkle.siblings(block, 3, 100, leaf)
        assert merkle.unpacked_path(merkle.packed_path(steps)) == steps
        assert merkle.folded(nodes[leaf], steps) == block[: merkle.DIGEST].hex()
