"""Operator 6. Exact top-k by inner product on a bit-sliced index.

A block keeps, for each component, one bitmap over its rows for each bit of the
component's integer value above the block's lowest. A query's score is a sum of
such bitmaps with weights 2**(bit of the component + bit of the query): they are
added weight by weight with carry-save adders, three bitmaps to one and a carry
of twice the weight, which leaves the scores of all rows as bit slices. The best
rows are then found from the highest slice down: a slice either holds enough
candidates to drop all others, or all of it is taken and the search goes on
below it. Rows that tie at the boundary are taken in order of id.

Negative query components count the complement of a component's bitmaps, so
that all addends are positive; the constant this adds is taken off at the end.
"""

from __future__ import annotations

import struct

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.blocks import best_of_blocks, usable

SCALE = 1024
#: Queries that are added up side by side.
SIDE_BY_SIDE = 16
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def quantised(matrix: np.ndarray) -> np.ndarray:
    return np.floor(matrix * SCALE).astype(np.int64)


def index(ids: np.ndarray, matrix: np.ndarray) -> bytes:
    """Packed: rows, components, bits, words; ids, lowest values, then the bitmaps."""
    values = quantised(matrix)
    n, dim = values.shape
    lowest = values.min(axis=0) if n else np.zeros(dim, dtype=np.int64)
    above = (values - lowest).astype(np.uint64)
    bits = int(above.max(initial=0)).bit_length()
    words = -(-n // 64)
    slices = np.zeros((dim, bits, words * 64), dtype=np.uint8)
    for b in range(bits):
        slices[:, b, :n] = (above.T >> np.uint64(b)) & np.uint64(1)
    bitmaps = np.packbits(slices, axis=-1, bitorder="little")
    head = struct.pack("<IIII", n, dim, bits, words)
    return head + ids.astype("<i8").tobytes() + lowest.astype("<i8").tobytes() + bitmaps.tobytes()


def added(bitmaps: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The bitmap of the sum's own weight, and the carries of twice that weight.

    `bitmaps` is queries x addends x words.
    """
    carries = []
    while bitmaps.shape[1] > 2:
        third = bitmaps.shape[1] // 3
        a, b, c = (bitmaps[:, i * third : (i + 1) * third] for i in range(3))
        half = a ^ b
        carries.append((a & b) | (half & c))
        bitmaps = np.concatenate([half ^ c, bitmaps[:, 3 * third :]], axis=1)
    if bitmaps.shape[1] == 2:
        carries.append(bitmaps[:, :1] & bitmaps[:, 1:])
        return bitmaps[:, 0] ^ bitmaps[:, 1], carries
    return bitmaps[:, 0], carries


def score_slices(bitmaps: np.ndarray, size: np.ndarray, negative: np.ndarray) -> list[np.ndarray]:
    """Slices (queries x words, lowest weight first) of sum(|q| * component or complement).

    `bitmaps` holds components x bits x words, then their complements, then an
    empty bitmap that fills up queries with fewer addends.
    """
    n_queries, dim = size.shape
    bits = bitmaps.shape[1] if bitmaps.ndim == 3 else 0
    flat = bitmaps.reshape(-1, bitmaps.shape[-1])
    empty = len(flat) - bits
    query_bits = int(size.max(initial=0)).bit_length()
    has = (size[:, :, None] >> np.arange(query_bits)) & 1 == 1
    first = (np.arange(dim) + np.where(negative, dim, 0)) * bits
    out: list[np.ndarray] = []
    carries: list[np.ndarray] = []
    weight = 0
    while weight < bits + query_bits - 1 or carries:
        wanted = []
        for b in range(max(0, weight - query_bits + 1), min(bits, weight + 1)):
            wanted.append(np.where(has[:, :, weight - b], first + b, empty))
        parts = carries
        if wanted:
            at = np.concatenate(wanted, axis=1)
            at = np.sort(np.where(at == empty, np.iinfo(np.int64).max, at), axis=1)
            most = int((at != np.iinfo(np.int64).max).sum(axis=1).max(initial=0))
            at = np.minimum(at[:, :most], empty)
            parts = [flat[at], *carries]
        parts = [p for p in parts if p.shape[1]]
        if parts:
            total, carries = added(np.concatenate(parts, axis=1))
            out.append(total)
        else:
            out.append(np.zeros((n_queries, flat.shape[-1]), dtype=np.uint64))
            carries = []
        weight += 1
    return out


def search(block: bytes, query_ids: np.ndarray, queries: np.ndarray, k: int):
    """Exact best `k` rows of a block for each query."""
    n, dim, bits, words = struct.unpack_from("<IIII", block)
    ids = np.frombuffer(block, "<i8", n, 16)
    lowest = np.frombuffer(block, "<i8", dim, 16 + 8 * n)
    stored = np.frombuffer(block, "<u8", dim * bits * words, 16 + 8 * (n + dim))
    stored = stored.reshape(dim, bits, words)
    rows = np.zeros(words * 64, dtype=np.uint8)
    rows[:n] = 1
    present = np.packbits(rows, bitorder="little").view("<u8")
    empty = np.zeros((1, bits, words), dtype=np.uint64)
    bitmaps = np.concatenate([stored, ~stored & present, empty])
    weights = quantised(queries)
    found_query, found_row, found_score = [], [], []
    for low in range(0, len(query_ids), SIDE_BY_SIDE):
        own, q = query_ids[low : low + SIDE_BY_SIDE], weights[low : low + SIDE_BY_SIDE]
        negative = q < 0
        base = q @ lowest - np.where(negative, -q, 0).sum(axis=1) * ((1 << bits) - 1)
        slices = score_slices(bitmaps, np.abs(q), negative)
        left = np.tile(present, (len(own), 1))
        at = np.minimum(np.searchsorted(ids, own), n - 1)
        # a query's own row, or rows if its id is repeated, take no part
        for i in np.flatnonzero(ids[at] == own):
            last = int(np.searchsorted(ids, own[i], side="right"))
            for row in range(int(at[i]), last):
                left[i, row >> 6] &= ALL ^ (np.uint64(1) << np.uint64(row & 63))
        sure = np.zeros_like(left)
        for plane in reversed(slices):
            both = sure | (left & plane)
            enough = np.bitwise_count(both).sum(axis=1, keepdims=True)
            sure = np.where(enough <= k, both, sure)
            left = np.where(enough <= k, left & ~plane, left & plane)
        for i in range(len(own)):
            taken = _rows(sure[i])
            taken = np.concatenate([taken, _rows(left[i])[: k - len(taken)]])
            score = np.full(len(taken), base[i], dtype=np.int64)
            word, bit = taken >> 6, (taken & 63).astype(np.uint64)
            for weight, plane in enumerate(slices):
                score += ((plane[i, word] >> bit) & np.uint64(1)).astype(np.int64) << weight
            found_query.append(np.full(len(taken), own[i]))
            found_row.append(ids[taken])
            found_score.append(score)
    return tuple(np.concatenate(x) for x in (found_query, found_row, found_score))


def _rows(bitmap: np.ndarray) -> np.ndarray:
    """Places of the set bits, rising."""
    filled = np.flatnonzero(bitmap)
    bits = np.unpackbits(bitmap[filled].view(np.uint8), bitorder="little").reshape(-1, 64)
    word, bit = np.nonzero(bits)
    return filled[word] * 64 + bit


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """`query_id, rank, vec_id, score`: the `k` largest integer inner products per query.

    Both tables hold `vec_id` and `vector`; components count as floor(1024 * x),
    and scores must fit a long. A row with the query's id is no candidate. Null
    ids, null vectors and vectors with null or non-finite components take no
    part; a query meets only vectors of its length. Other columns are not read.
    Repeated rows each count. Empty tables give no rows.
    """
    fit = usable(F.col("vector")) & F.col("vec_id").isNotNull()
    return best_of_blocks(vectors.where(fit), queries.where(fit), k, index, search, "long")
