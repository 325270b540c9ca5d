"""Token counts, byte-level BPE, packing and token files against the libraries."""

import base64
import hashlib
import random
import zlib

import numpy as np
import pytest

from tests.llm.conftest import ODD
from tidemark.llm import byte_bpe, packing, pieces, rans, token_counts
from tidemark.llm.common import vocabulary
from tidemark.llm.pieces import LibraryEncoder

WORDS = vocabulary("word_bpe_49k.json")
BYTES = vocabulary("byte_bpe_50k.json")
RANKS = vocabulary("byte_bpe_multi_50k.tiktoken")


def texts():
    """Texts of many scripts, odd spacing, special strings and long runs."""
    draw = random.Random(7)
    near = "abcdeéßÀ '.,!?\n\t<|>0123456789-_ "
    scripts = ((32, 0x2FF), (0x370, 0x5FF), (0x3040, 0x30FF), (0x1F600, 0x1F640))
    far = [c for low, high in scripts for c in range(low, high)]
    out = [t or "" for _, t in ODD]
    out += ["".join(draw.choice(near) for _ in range(400)) for _ in range(60)]
    out += ["".join(chr(draw.choice(far)) for _ in range(200)) for _ in range(60)]
    out += ["a" * 700, "ab " * 300, "  \n\n\t x", "don't I'LL it's"]
    out += ["<|startoftext|>a<|endoftext|>"]
    return out


def library(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def library_ids(path, found):
    return [e.ids for e in library(path).encode_batch(found, add_special_tokens=False)]


def reference_bpe():
    import public_tokenizers
    import tiktoken

    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def unpacked(ids, kind="<u2"):
    return np.frombuffer(ids, kind).tolist()


def test_merged_counts_equal_the_library():
    found = texts()
    counts = token_counts.MergeTable(WORDS).count_texts(found)
    assert counts == [len(i) for i in library_ids(WORDS, found)]


def test_merge_of_nothing():
    table = token_counts.MergeTable(WORDS)
    assert table.count([b"", b"a"]).tolist() == [0, 1]
    assert table.ids([]) == []


def test_token_counts_of_odd_rows(odd, none):
    rows = token_counts.token_counts(odd, WORDS).collect()
    expected = [len(i) for i in library_ids(WORDS, [t or "" for _, t in ODD])]
    assert [r.n_tokens for r in rows] == expected
    assert [r.n_bytes for r in rows] == [len((t or "").encode()) for _, t in ODD]
    assert rows[0].ids == "c" and "text" not in rows[0]
    assert token_counts.token_counts(none, WORDS).count() == 0


def test_segment_trees_equal_tiktoken():
    found, coder, reference = texts(), byte_bpe.ByteBpe(RANKS), reference_bpe()
    packed = coder.encode(found)
    assert [unpacked(p, "<u4") for p in packed] == [reference.encode_ordinary(t) for t in found]
    assert [coder.decode(p) for p in packed] == [t.encode() for t in found]


def test_round_trip_of_odd_rows(odd, none):
    rows = byte_bpe.round_trip(odd, RANKS).collect()
    whole = [(t or "").encode() for _, t in ODD]
    assert [r.decoded_sha256 for r in rows] == [hashlib.sha256(t).hexdigest() for t in whole]
    encoded = byte_bpe.encode_documents(odd, RANKS)
    decoded = byte_bpe.decode_documents(encoded, RANKS).collect()
    assert [bytes(r.decoded) for r in decoded] == whole
    assert byte_bpe.round_trip(none, RANKS).count() == 0


@pytest.mark.parametrize("kind,path", [(LibraryEncoder, BYTES), (packing.WordEncoder, WORDS)])
def test_piecewise_ids_equal_the_library(kind, path):
    found = texts()
    assert [unpacked(p) for p in kind(path).packed(found)] == library_ids(path, found)


@pytest.mark.parametrize(
    "bounds,pattern",
    [(pieces.byte_pieces, pieces.BYTE_PIECES), (pieces.word_pieces, pieces.WORD_PIECES)],
)
def test_numpy_cuts_like_the_patterns(bounds, pattern):
    draw = random.Random(2)
    found = ["".join(draw.choices("ab  \n\t.,1é²ß!\r Z", k=draw.randint(0, 25))) for _ in range(3000)]
    data = [pieces.simple_bytes(t) for t in found]
    ends = np.cumsum([len(d) for d in data])
    joined = b"".join(data)
    low, high = bounds(np.frombuffer(joined, np.uint8), np.r_[0, ends[:-1]])
    cut = [joined[a:b].decode("latin-1") for a, b in zip(low, high, strict=True)]
    assert cut == [p for t in found for p in pattern.findall(t)]
    assert pieces.simple_bytes("it's") is None and pieces.simple_bytes("Ā") is None


def test_memory_that_fills_up(monkeypatch):
    monkeypatch.setattr(pieces, "RECENT", 30)
    monkeypatch.setattr(pieces, "REMEMBERED", 200)
    draw = random.Random(4)
    found = [" ".join("".join(draw.choices("abcdé", k=4)) for _ in range(30)) for _ in range(60)]
    encoder, sizes = LibraryEncoder(BYTES), []
    for i in range(0, len(found), 5):
        part = found[i : i + 5]
        assert [unpacked(p) for p in encoder.packed(part)] == library_ids(BYTES, part)
        sizes.append(len(encoder.memory.hashes))
    assert any(b < a for a, b in zip(sizes[:-1], sizes[1:], strict=True))


@pytest.mark.parametrize("dimensions,bits", [(2, 4), (3, 3), (4, 2)])
def test_hilbert_curve_visits_neighbours(dimensions, bits):
    side = 1 << bits
    points = np.stack(np.meshgrid(*[np.arange(side)] * dimensions), -1).reshape(-1, dimensions)
    keys = packing.hilbert_keys(points, bits)
    assert sorted(keys.tolist()) == list(range(side**dimensions))
    steps = np.abs(np.diff(points[np.argsort(keys)], axis=0)).sum(axis=1)
    assert steps.max() == 1


def test_packing_puts_each_id_in_one_place(odd, none):
    rows = packing.pack(odd, WORDS, digest=True).collect()
    ids = [i + [packing.END_ID] for i in library_ids(WORDS, [t or "" for _, t in ODD])]
    pieces = {}
    for r in rows:
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    assert {(i, len(x)) for (i, _), x in zip(ODD, ids, strict=True)} == set(pieces)
    sizes = [(i, len(x)) for (i, _), x in zip(ODD, ids, strict=True)]
    for (doc_id, size), x in zip(sizes, ids, strict=True):
        copies = sizes.count((doc_id, size))
        assert sum(r.length for r in pieces[doc_id, size]) == size * copies
        if copies == 1:
            for r in pieces[doc_id, size]:
                own = np.array(x[r.start : r.start + r.length], dtype="<u4")
                assert r.ids_crc32 == zlib.crc32(own.tobytes())
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == packing.SEQUENCE or at & (at - 1) == 0
    assert packing.pack(none, WORDS).count() == 0


def test_like_documents_are_packed_together(spark):
    draw = random.Random(1)
    words = [[f"{c}{draw.choice('aeiou')}{i}" for i in range(30)] for c in "bkz"]
    rows = [(i, " ".join(draw.choices(words[i % 3], k=60))) for i in range(90)]
    pieces = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), WORDS)
    order = [r.doc_id % 3 for r in pieces.orderBy("sequence_id", "offset").collect()]
    changes = sum(a != b for a, b in zip(order[:-1], order[1:], strict=True))
    assert changes < 45  # 60 in an order without regard to likeness


@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, 1000, 32_768, 32_769, 100_000])
def test_rans_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.2, n), 65_535).astype(np.uint16)
    assert (rans.decode_file(rans.encode_file(ids)) == ids).all()


def test_rans_is_near_entropy_and_handles_every_symbol():
    rng = np.random.default_rng(3)
    ids = rng.geometric(0.05, 10 * rans.LANES * rans.STEPS).astype(np.uint16)
    share = np.unique(ids, return_counts=True)[1] / len(ids)
    bits = 8 * len(rans.encode_file(ids)) / len(ids)
    # states of 32 lanes and the checkpoint are 2,144 bits a block
    assert bits < -(share * np.log2(share)).sum() * 1.01 + 10 * 2_144 / len(ids) + 0.05
    every = np.arange(1 << 16, dtype=np.uint16)
    assert (rans.decode_file(rans.encode_file(every)) == every).all()


def test_rans_blocks_decode_alone_and_damage_shows():
    ids = np.random.default_rng(5).integers(0, 900, 150_000).astype(np.uint16)
    data = rans.encode_file(ids)
    block = rans.LANES * rans.STEPS
    assert (rans.decode_file(data, slice(2, 4)) == ids[2 * block : 4 * block]).all()
    broken = bytearray(data)
    broken[-len(ids) // 2] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        rans.decode_file(bytes(broken))


def test_token_files_of_odd_rows(odd, none, monkeypatch):
    monkeypatch.setattr(rans, "FILE_IDS", 5_000)
    rows = rans.through_files(odd, BYTES).collect()
    whole = library_ids(BYTES, [t or "" for _, t in ODD])
    ids = {i: x + [rans.END_ID] for (i, _), x in zip(ODD, whole, strict=True)}
    assert len(rows) == len(ODD)
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at and unpacked(r.ids) == ids[r.doc_id]
        at += r.n_tokens
    order = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
    assert order == [None, *sorted(i for i in order if i is not None)]
    assert rans.through_files(none, BYTES).count() == 0
