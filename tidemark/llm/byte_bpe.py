"""Operator 5. Byte-level BPE with a segment tree over byte positions.

A piece of up to W = 2**k bytes has a tree of W leaves. Leaf i holds the rank of
the pair that starts at live position i, with i itself in the low bits; an inner
node holds the lower of its children, so the root is the leftmost lowest pair. A
merge changes three leaves (the merged pair, its left neighbour, the absorbed
position) and the log W nodes above each. Pieces of one width are worked on side
by side: one row of the arrays each, one merge of every unfinished row a step.

Ranks are a tiktoken vocabulary's: a pair's rank is the id of its joined bytes,
whichever way they are split, and a piece that is itself in the vocabulary is
its own id.
"""

from __future__ import annotations

import base64
import hashlib
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_slices
from tidemark.llm.pieces import BYTE_PIECES, is_plain, look_up

NO_PAIR = np.int64(1) << 62
#: Cells of the arrays that one group of pieces may fill.
GROUP_CELLS = 1 << 21


class ByteBpe:
    """Encoder and decoder for a file of base64 tokens and their ranks."""

    def __init__(self, path: str):
        import public_tokenizers
        import regex

        with open(path, "rb") as file:
            lines = [line.split() for line in file if line.strip()]
        self.ids = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.bytes_of = {rank: token for token, rank in self.ids.items()}
        self.single = np.array([self.ids[bytes([b])] for b in range(256)], dtype=np.int64)
        # `\s` in the file's pattern is Unicode's White_Space
        self.pattern = regex.compile(
            public_tokenizers.PATTERN.replace(r"\s", r"\p{White_Space}").replace(
                r"\S", r"\P{White_Space}"
            )
        )
        pairs = [
            (self.ids[token[:cut]] << 32 | self.ids[token[cut:]], rank)
            for token, rank in self.ids.items()
            for cut in range(1, len(token))
            if token[:cut] in self.ids and token[cut:] in self.ids
        ]
        table = np.array(sorted(pairs), dtype=np.int64).reshape(-1, 2)
        self.pair_keys, self.pair_ranks = table[:, 0].copy(), table[:, 1].copy()
        self.known: dict[str, bytes] = {}

    def _leaf(self, left: np.ndarray, right: np.ndarray, position, bits: int) -> np.ndarray:
        """Leaf values of pairs; `NO_PAIR` where a side is missing (-1) or no token joins them."""
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair_keys, wanted), len(self.pair_keys) - 1)
        fits = (self.pair_keys[at] == wanted) & (left >= 0) & (right >= 0)
        return np.where(fits, self.pair_ranks[at] << bits | position, NO_PAIR)

    def merge(self, pieces: list[bytes], bits: int) -> list[np.ndarray]:
        """Ids of pieces of at most 2**bits bytes."""
        width, n = 1 << bits, len(pieces)
        lengths = np.array([len(p) for p in pieces])
        cells = np.arange(width)
        symbols = np.full((n, width + 1), -1, dtype=np.int64)
        inside = cells < lengths[:, None]
        data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        symbols[:, :width][inside] = self.single[data]
        after = np.tile(np.arange(1, width + 2), (n, 1))
        before = np.tile(np.arange(-1, width), (n, 1))
        tree = np.full((n, 2 * width), NO_PAIR)
        tree[:, width:] = self._leaf(symbols[:, :width], symbols[:, 1:], cells, bits)
        for level in range(bits - 1, -1, -1):
            low = 1 << level
            tree[:, low : 2 * low] = np.minimum(
                tree[:, 2 * low : 4 * low : 2], tree[:, 2 * low + 1 : 4 * low : 2]
            )
        rows = np.flatnonzero(tree[:, 1] < NO_PAIR)
        while len(rows):
            root = tree[rows, 1]
            at = root & (width - 1)
            gone = after[rows, at]
            following = np.minimum(after[rows, gone], width)
            symbols[rows, at] = root >> bits
            symbols[rows, gone] = -1
            after[rows, at] = following
            before[rows, following] = at
            self._set(tree, rows, gone, np.full(len(rows), NO_PAIR), bits)
            pair = self._leaf(symbols[rows, at], symbols[rows, following], at, bits)
            self._set(tree, rows, at, pair, bits)
            led = np.flatnonzero(before[rows, at] >= 0)
            r, a = rows[led], at[led]
            b = before[r, a]
            self._set(tree, r, b, self._leaf(symbols[r, b], symbols[r, a], b, bits), bits)
            rows = rows[tree[rows, 1] < NO_PAIR]
        live = symbols[:, :width] >= 0
        flat = symbols[:, :width][live]
        return np.split(flat, np.cumsum(live.sum(axis=1))[:-1])

    @staticmethod
    def _set(tree: np.ndarray, rows, position, value, bits: int) -> None:
        """Point update: a leaf of each row and the nodes above it."""
        node = position + (1 << bits)
        tree[rows, node] = value
        for _ in range(bits):
            node = node >> 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece as packed little-endian 32-bit integers."""
        out: list[bytes] = [b""] * len(pieces)
        groups: dict[int, list[tuple[int, bytes]]] = {}
        for i, piece in enumerate(pieces):
            data = piece.encode()
            whole = self.ids.get(data)
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            else:
                groups.setdefault(max(1, (len(data) - 1).bit_length()), []).append((i, data))
        for bits, members in groups.items():
            step = max(1, GROUP_CELLS >> bits)
            for start in range(0, len(members), step):
                part = members[start : start + step]
                for (i, _), found in zip(part, self.merge([d for _, d in part], bits), strict=True):
                    out[i] = found.astype("<u4").tobytes()
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of whole texts."""
        cut = [(BYTE_PIECES if is_plain(t) else self.pattern).findall(t) for t in texts]
        return [b"".join(x) for x in look_up(cut, self.known, self.encode_pieces)]

    def decode(self, packed: bytes) -> bytes:
        ids = np.frombuffer(packed, dtype="<u4").tolist()
        return b"".join(map(self.bytes_of.__getitem__, ids))


_encoders: dict[str, ByteBpe] = {}


def byte_bpe(path: str) -> ByteBpe:
    if path not in _encoders:
        _encoders[path] = ByteBpe(path)
    return _encoders[path]


def _mapped(docs: DataFrame, column: str, added: dict, work) -> DataFrame:
    """`docs` without `column`, with `added` columns that `work` makes from its values."""
    kept = [c for c in docs.columns if c != column and c not in added]
    narrow = docs.select(*kept, F.col(column).alias("__in"))
    schema = narrow.select(*kept).schema
    for name, (spark_type, _) in added.items():
        schema = schema.add(name, spark_type)

    def run(batches):
        for piece, values in text_slices(batches, "__in"):
            columns = [piece.column(n) for n in range(len(kept))]
            made = work(values)
            arrays = [pa.array(v, t) for v, (_, t) in zip(made, added.values(), strict=True)]
            yield pa.RecordBatch.from_arrays([*columns, *arrays], names=[*kept, *added])

    return narrow.mapInArrow(run, schema)


def encode_documents(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """`docs` with `ids` (packed 32-bit little-endian) and `n_tokens` in place of the text.

    A null text is empty: no ids. Rows are encoded one by one, so repeated rows
    stay; columns named like a result are replaced; an empty table stays empty.
    """

    def work(texts):
        packed = byte_bpe(path).encode([t or "" for t in texts])
        return packed, [len(p) // 4 for p in packed]

    added = {"ids": ("binary", pa.binary()), "n_tokens": ("long", pa.int64())}
    return _mapped(docs, text, added, work)


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """The texts' bytes as `decoded` in place of `ids`. Null ids give empty bytes."""

    def work(packed):
        return ([byte_bpe(path).decode(p or b"") for p in packed],)

    return _mapped(encoded, "ids", {"decoded": ("binary", pa.binary())}, work)


def round_trip(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """`n_tokens` and digests of each text's ids and of what they decode to."""

    def work(texts):
        coder = byte_bpe(path)
        packed = coder.encode([t or "" for t in texts])
        decoded = map(coder.decode, packed)
        return (
            [len(p) // 4 for p in packed],
            [hashlib.sha256(p).hexdigest() for p in packed],
            [hashlib.sha256(d).hexdigest() for d in decoded],
        )

    added = dict(
        zip(
            ("n_tokens", "ids_sha256", "decoded_sha256"),
            (("long", pa.int64()), *repeat(("string", pa.string()), 2)),
            strict=True,
        )
    )
    return _mapped(docs, text, added, work)
