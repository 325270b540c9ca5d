"""Operator 7. Nearest neighbours from randomly rotated one-bit codes.

A vector less the centre is rotated at random and kept as the signs of its
components: 64 to a word. With it go its length and the share of it that the
signs point to, the correction. From the packed signs and a query in 4-bit
steps, popcounts give an estimate of the inner product, and the correction the
width within which it lies. The rows of the best estimates are reranked with
their original vectors first; then every other row whose upper bound reaches the
k-th best of those. So more rows are reranked where codes tell less, and none is
cut by number.
"""

from __future__ import annotations

import struct

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import seeded
from tidemark.operators.blocks import best_of_blocks, usable

#: Width of the error bound in standard deviations of the estimate.
BOUND = 1.5
QUERY_BITS = 4
#: The rows of the best estimates, this many times k, are reranked first.
FIRST = 4


def rotation(dim: int) -> np.ndarray:
    """A fixed random orthogonal matrix over `dim` rounded up to whole words."""
    size = -(-max(dim, 1) // 64) * 64
    rng = np.random.default_rng(seeded(f"rotation {size}", 2).astype(np.uint32))
    q, r = np.linalg.qr(rng.standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def rotated(matrix: np.ndarray) -> np.ndarray:
    turn = rotation(matrix.shape[1])
    return matrix @ turn[: matrix.shape[1]]


def index(ids: np.ndarray, matrix: np.ndarray) -> bytes:
    """Packed: rows, components, words; ids, centre, lengths, corrections, codes, vectors."""
    n, dim = matrix.shape
    centre = matrix.mean(axis=0)
    turned = rotated(matrix - centre)
    length = np.linalg.norm(turned, axis=1)
    signs = turned > 0
    # inner product of the unit vector with its code
    share = np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1])
    share = np.where(length > 0, share / np.where(length > 0, length, 1), 1.0)
    codes = np.packbits(signs, axis=1, bitorder="little")
    return b"".join(
        [
            struct.pack("<III", n, dim, turned.shape[1] // 64),
            ids.astype("<i8").tobytes(),
            centre.astype("<f8").tobytes(),
            length.astype("<f8").tobytes(),
            share.astype("<f8").tobytes(),
            codes.tobytes(),
            matrix.astype("<f8").tobytes(),
        ]
    )


class Block:
    """The arrays of a packed block."""

    def __init__(self, data: bytes):
        n, dim, words = struct.unpack_from("<III", data)
        at = 12

        def take(kind, *shape):
            nonlocal at
            out = np.frombuffer(data, kind, int(np.prod(shape)), at).reshape(shape)
            at += out.nbytes
            return out

        self.ids, self.centre = take("<i8", n), take("<f8", dim)
        self.length, self.share = take("<f8", n), take("<f8", n)
        self.codes, self.vectors = take("<u8", n, words), take("<f8", n, dim)

    def estimates(self, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimated inner product with each row, and the width of its error bound."""
        turned = rotated_query(query)
        size = len(turned)
        low = turned.min()
        step = (turned.max() - low) / ((1 << QUERY_BITS) - 1) or 1.0
        levels = np.rint((turned - low) / step).astype(np.uint64)
        hits = np.zeros(len(self.ids), dtype=np.int64)
        for bit in range(QUERY_BITS):
            plane = np.packbits(
                ((levels >> np.uint64(bit)) & np.uint64(1)).astype(np.uint8), bitorder="little"
            ).view("<u8")
            hits += np.bitwise_count(self.codes & plane).sum(axis=1, dtype=np.int64) << bit
        # sum of +-(low + step * level), the sign from the code
        signed = 2 * (low * self.ones + step * hits) - (low * size + step * float(levels.sum()))
        norm = np.linalg.norm(query)
        estimate = self.scale * signed + self.centre @ query
        rounding = self.scale * step / 2 * np.sqrt(size)
        return estimate, self.spread * norm + rounding

    def products(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Exact inner products, summed row by row so that equal vectors score alike."""
        return (self.vectors[rows] * query).sum(axis=1)

    def prepare(self) -> None:
        size = 64 * self.codes.shape[1]
        self.ones = np.bitwise_count(self.codes).sum(axis=1, dtype=np.int64)
        self.scale = self.length / (self.share * np.sqrt(size))
        lost = np.sqrt(np.maximum(0, 1 - self.share**2)) / self.share
        self.spread = BOUND * self.length * lost / np.sqrt(max(1, size - 1))


_turn: dict[int, np.ndarray] = {}


def rotated_query(query: np.ndarray) -> np.ndarray:
    if len(query) not in _turn:
        _turn[len(query)] = rotation(len(query))
    return query @ _turn[len(query)][: len(query)]


def _largest(values: np.ndarray, n: int) -> np.ndarray:
    return np.argpartition(values, -n)[-n:] if len(values) > n else np.arange(len(values))


def search(data: bytes, query_ids: np.ndarray, queries: np.ndarray, k: int):
    """The best `k` of a block's rows whose bounds say they may be among them."""
    block = Block(data)
    block.prepare()
    out_query, out_row, out_score = [], [], []
    for own, query in zip(query_ids, queries, strict=True):
        if not query.any():
            continue
        estimate, width = block.estimates(query)
        other = block.ids != own
        estimate = np.where(other, estimate, -np.inf)
        first = _largest(estimate, FIRST * k)
        exact = block.products(first, query)
        reach = np.partition(exact, -k)[-k] if len(first) > k else -np.inf
        reached = (estimate + width >= reach) & other
        reached[first] = False
        more = np.flatnonzero(reached)
        at = np.concatenate([first, more])
        score = np.concatenate([exact, block.products(more, query)])
        kept = other[at]
        at, score = at[kept], score[kept]
        order = np.lexsort((block.ids[at], -score))[:k]
        out_query.append(np.full(len(order), own))
        out_row.append(block.ids[at][order])
        out_score.append(score[order])
    if not out_query:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    return tuple(np.concatenate(x) for x in (out_query, out_row, out_score))


def nearest(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """`query_id, rank, vec_id, score`: the `k` nearest found by inner product, exact scores.

    Both tables hold `vec_id` and `vector`. A row with the query's id is no
    candidate. Null ids, null or zero vectors and vectors with null or
    non-finite components take no part; a query meets only vectors of its
    length. Other columns are not read. Repeated rows each count. Empty tables
    give no rows.
    """
    fit = (
        usable(F.col("vector"))
        & F.col("vec_id").isNotNull()
        & F.exists("vector", lambda x: x != 0)
    )
    return best_of_blocks(vectors.where(fit), queries.where(fit), k, index, search, "double")
