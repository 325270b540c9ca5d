"""Operator 13. Hard negatives through an inverted multi-index.

A vector is cut into two halves, and each half has a codebook of its own, learned
from a bounded sample (`SAMPLE` rows by a hash of their id). A row lies in the
cell of its two nearest words. Rows are ordered by cell and packed into blocks, so
a block holds few cells; for each of its words it keeps the radius, the largest
distance of a half in this block from the word.

A half q of an anchor scores at most q.w + |q| * radius against the rows of word w,
and a cell at most the sum of its two words. The words of both halves are sorted
by that bound, and a multi-sequence heap visits the cells by falling sums. What is
not visited yet scores no more than the heap's top, so a search stops where the
rows it holds are certified:

    positives   the n-th best row of the anchor's label scores more than the top;
    negatives   a positive's window of scores, from `low` to `high` percent of the
                positive's, holds n rows of other labels of which the last scores
                more than the top, or lies above the top as a whole.

Scores are sums over integers and exact. Every block meets every chunk of anchors
and hands on a few rows per anchor; the best over all blocks are the result.
"""

from __future__ import annotations

import heapq
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.blocks import (
    BLOCK_ROWS,
    CHUNK_ROWS,
    every_pair,
    in_chunks,
    matrices,
    packed,
    usable,
)
from tidemark.session import Scratch, staged

SCALE = 256
#: Words of each codebook, rows it is learned from at most, and rounds of learning.
WORDS, SAMPLE, ROUNDS = 16, 20_000, 8
#: Rows that a search scores at once, at first; each further step takes twice as many.
FIRST_STEP = 64

Books = dict[int, tuple[np.ndarray, np.ndarray]]


def quantised(matrix: np.ndarray) -> np.ndarray:
    return np.floor(matrix * SCALE)


def nearest_words(half: np.ndarray, words: np.ndarray) -> np.ndarray:
    apart = (words * words).sum(axis=1) - 2.0 * (half @ words.T)
    return apart.argmin(axis=1)


def codebook(half: np.ndarray) -> np.ndarray:
    """Up to `WORDS` centres of the rows, by Lloyd's rounds from evenly spread rows."""
    distinct = np.unique(half, axis=0)
    words = distinct[np.linspace(0, len(distinct) - 1, min(WORDS, len(distinct))).astype(int)]
    for _ in range(ROUNDS):
        own = nearest_words(half, words)
        for w in range(len(words)):
            if (own == w).any():
                words[w] = half[own == w].mean(axis=0)
    return words


def codebooks(vectors: DataFrame) -> Books:
    """Two codebooks for each length of vector that the sample holds."""
    drawn = vectors.select("vec_id", "vector").orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE)
    by_length: dict[int, list] = {}
    for row in drawn.collect():
        by_length.setdefault(len(row.vector), []).append(row.vector)
    books = {}
    for dim, rows in by_length.items():
        whole = quantised(np.array(rows, dtype=np.float64).reshape(len(rows), dim))
        books[dim] = (codebook(whole[:, : dim // 2]), codebook(whole[:, dim // 2 :]))
    return books


def books_of(books: Books, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """A length that the sample lacks has one word of zeros in each half."""
    known = books.get(dim)
    return known or (np.zeros((1, dim // 2)), np.zeros((1, dim - dim // 2)))


def words_of(whole: np.ndarray, books: Books) -> tuple[np.ndarray, np.ndarray]:
    dim = whole.shape[1]
    first, second = books_of(books, dim)
    return nearest_words(whole[:, : dim // 2], first), nearest_words(whole[:, dim // 2 :], second)


def by_cell(vectors: DataFrame, books: Books) -> DataFrame:
    """`vec_id` and `vector` (the label as its last component), ordered by cell.

    The id is part of the order, so that a cell of very many rows is dealt to
    several tasks.
    """

    def work(batches):
        for batch in batches:
            rows = batch.to_pydict()
            cells = np.zeros(batch.num_rows, dtype=np.int64)
            sizes = np.array([len(v) for v in rows["vector"]], dtype=np.int64)
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                whole = np.array([rows["vector"][i][:-1] for i in at], dtype=np.float64)
                one, two = words_of(quantised(whole.reshape(len(at), size - 1)), books)
                cells[at] = one * WORDS + two
            arrays = [batch.column(0), batch.column(1), pa.array(cells)]
            yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "vector", "cell"])

    marked = vectors.mapInArrow(work, "vec_id long, vector array<double>, cell long")
    dealt = marked.withColumn("dim", F.size("vector"))
    return dealt.repartitionByRange("dim", "cell", "vec_id").select("vec_id", "vector")


def index_block(ids: np.ndarray, matrix: np.ndarray, books: Books) -> bytes:
    """Rows of one length in order of cell, with the cells' ends and the words' radii."""
    whole, labels = quantised(matrix[:, :-1]), matrix[:, -1].astype(np.int64)
    dim = whole.shape[1]
    first, second = books_of(books, dim)
    one, two = words_of(whole, books)
    cell = one * len(second) + two
    order = np.argsort(cell, kind="stable")
    ends = np.searchsorted(cell[order], np.arange(len(first) * len(second)), side="right")

    def radii(half, words, own):
        apart = np.sqrt(((half - words[own]) ** 2).sum(axis=1))
        out = np.full(len(words), -1.0)
        np.maximum.at(out, own, apart)
        return out

    parts = (
        ids[order].astype("<i8"),
        labels[order].astype("<i8"),
        whole[order].astype("<f8"),
        ends.astype("<i8"),
        first.astype("<f8"),
        second.astype("<f8"),
        radii(whole[:, : dim // 2], first, one).astype("<f8"),
        radii(whole[:, dim // 2 :], second, two).astype("<f8"),
    )
    head = struct.pack("<qqqq", len(ids), dim, len(first), len(second))
    return head + b"".join(np.ascontiguousarray(p).tobytes() for p in parts)


class Block:
    """An indexed block as arrays."""

    def __init__(self, data: bytes):
        n, dim, a, b = struct.unpack_from("<qqqq", data)
        at = 32
        half = dim // 2

        def take(kind, *shape):
            nonlocal at
            size = int(np.prod(shape))
            found = np.frombuffer(data, kind, size, at).reshape(shape)
            at += 8 * size
            return found

        self.ids, self.labels = take("<i8", n), take("<i8", n)
        self.rows = take("<f8", n, dim)
        self.ends = take("<i8", a * b)
        self.words = take("<f8", a, half), take("<f8", b, dim - half)
        self.radii = take("<f8", a), take("<f8", b)
        self.largest = float(np.abs(self.rows).max(initial=0.0))

    def bounds(self, anchor: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each half, the words that the block uses by falling bound, and the bounds."""
        out, half = [], len(anchor) // 2
        for part, words, radii in zip((anchor[:half], anchor[half:]), self.words, self.radii, strict=True):
            bound = words @ part + np.sqrt(part @ part) * radii
            bound += 1e-9 * (np.abs(bound) + 1.0)  # rounding never lowers a bound
            used = np.flatnonzero(radii >= 0)
            order = used[np.argsort(-bound[used], kind="stable")]
            out.append((order, bound[order]))
        return out

    def scores(self, rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        """Inner products as whole numbers; in doubles only where those hold them exactly."""
        most = self.largest * float(np.abs(anchor).max(initial=0.0)) * max(1, len(anchor))
        if most < 2.0**53:
            return (self.rows[rows] @ anchor).astype(np.int64)
        return self.rows[rows].astype(np.int64) @ anchor.astype(np.int64)


def cells_by_bound(bounds) -> Iterator[tuple[float, int, int]]:
    """Multi-sequence: (bound, word, word) of all cells by falling sum of the halves' bounds."""
    (first, one), (second, two) = bounds
    heap = [(-(one[0] + two[0]), 0, 0)] if len(one) and len(two) else []
    while heap:
        below, i, j = heapq.heappop(heap)
        yield -below, int(first[i]), int(second[j])
        if j + 1 < len(two):
            heapq.heappush(heap, (-(one[i] + two[j + 1]), i, j + 1))
        if not j and i + 1 < len(one):
            heapq.heappush(heap, (-(one[i + 1] + two[0]), i + 1, 0))


def visited(block: Block, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """Rows and scores step by step, and what the rows still to come score at most."""
    width = len(block.words[1])
    cells = cells_by_bound(block.bounds(anchor))
    step, held, rows = FIRST_STEP, 0, []
    for bound, one, two in cells:
        if held >= step:
            at = np.concatenate(rows)
            yield at, block.scores(at, anchor), bound
            step, held, rows = 2 * step, 0, []
        cell = one * width + two
        low = int(block.ends[cell - 1]) if cell else 0
        if low < block.ends[cell]:
            rows.append(np.arange(low, block.ends[cell]))
            held += len(rows[-1])
    if rows:
        at = np.concatenate(rows)
        yield at, block.scores(at, anchor), -np.inf


def _first(ids: np.ndarray, scores: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:n]
    return ids[order], scores[order]


class Wanted:
    """The first `n` rows with a score from `low` to `high` that a search has met."""

    def __init__(self, n: int, low: float = -np.inf, high: float = np.inf):
        self.n, self.low, self.high = n, low, high
        self.ids = self.scores = np.empty(0, dtype=np.int64)

    def meet(self, ids: np.ndarray, scores: np.ndarray) -> None:
        fits = (scores >= self.low) & (scores <= self.high)
        if fits.any():
            self.ids, self.scores = _first(
                np.r_[self.ids, ids[fits]], np.r_[self.scores, scores[fits]], self.n
            )

    def certified(self, top: float) -> bool:
        full = len(self.ids) == self.n and self.scores[-1] > top
        return full or top < self.low or self.low > self.high


def positives_of(block: Block, own: int, label: int, anchor: np.ndarray, n: int) -> Wanted:
    """The best `n` rows of the block with the anchor's label, but not its id."""
    wanted = Wanted(n)
    for rows, scores, top in visited(block, anchor):
        fits = (block.labels[rows] == label) & (block.ids[rows] != own)
        wanted.meet(block.ids[rows][fits], scores[fits])
        if wanted.certified(top):
            break
    return wanted


def negatives_of(block: Block, label: int, anchor: np.ndarray, windows: list[Wanted]) -> None:
    """Fill each window with the block's best rows of other labels."""
    for rows, scores, top in visited(block, anchor):
        fits = block.labels[rows] != label
        for window in windows:
            window.meet(block.ids[rows][fits], scores[fits])
        if all(window.certified(top) for window in windows):
            break


def window_of(positive: int, n: int, low: int, high: int) -> Wanted:
    """Scores s with low * positive <= 100 * s <= high * positive."""
    return Wanted(n, -(-low * positive // 100), high * positive // 100)


def _chunks(rows: DataFrame, extra: int) -> DataFrame:
    """Anchors in chunks; their vectors end in the label and `extra` more numbers."""

    def parts(batches):
        for ids, matrix in matrices(batches, CHUNK_ROWS):
            size = np.array(matrix.shape, dtype="<i8").tobytes()
            body = ids.astype("<i8").tobytes() + matrix.astype("<f8").tobytes()
            yield matrix.shape[1] - extra, size + body

    return packed(in_chunks(rows), parts)


def _anchors(chunk: bytes):
    n, dim = np.frombuffer(chunk, "<i8", 2).tolist()
    ids = np.frombuffer(chunk, "<i8", n, 16).tolist()
    return zip(ids, np.frombuffer(chunk, "<f8", n * dim, 16 + 8 * n).reshape(n, dim), strict=True)


def _record(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def hard_negatives(
    vectors: DataFrame,
    anchors: DataFrame,
    n_positives: int = 5,
    n_negatives: int = 3,
    low: int = 50,
    high: int = 95,
) -> DataFrame:
    """`anchor_id, positive_id, rank, negative_id, positive_score, negative_score`.

    Both tables hold `vec_id`, `vector` and `label`. An anchor's positives are its
    `n_positives` best other rows of the same label; for each, the `n_negatives`
    best rows of other labels whose score is `low` to `high` percent of the
    positive's, `rank` counting from 1. Components count as floor(256 * x), scores
    are inner products and must fit a long; ties go to the smaller id. A positive
    whose window is empty (a negative score has none) gives no row.

    Rows with a null id, label or vector, or a null or non-finite component take
    no part. An anchor meets only vectors of its length, and no row of its own id.
    Rows that repeat an id each count as candidates; an anchor's id counts once,
    with its smallest label and vector. Other columns are not read. Empty tables
    give no rows.
    """
    fit = usable(F.col("vector")) & F.col("vec_id").isNotNull() & F.col("label").isNotNull()
    label = F.array(F.col("label").cast("double"))
    numbers = F.transform("vector", lambda x: x.cast("double"))
    own = F.col("vec_id").cast("long").alias("vec_id")

    usable_rows = vectors.where(fit).select(own, numbers.alias("vector"), label.alias("label"))
    books = codebooks(usable_rows)
    labelled = usable_rows.select("vec_id", F.concat("vector", "label").alias("vector"))
    asked = anchors.where(fit).select(own, numbers.alias("vector"), label.alias("label"))
    asked = asked.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("first"))
    asked = asked.select("vec_id", F.concat("first.vector", "first.label").alias("vector"))

    def parts(batches):
        for ids, matrix in matrices(batches, BLOCK_ROWS):
            yield matrix.shape[1], index_block(ids, matrix, books)

    def best(block, chunk):
        own_block, rows = Block(block), []
        for anchor_id, vector in _anchors(chunk):
            found = positives_of(
                own_block, anchor_id, int(vector[-1]), quantised(vector[:-1]), n_positives
            )
            pairs = zip(found.ids.tolist(), found.scores.tolist(), strict=True)
            rows += [(anchor_id, i, s) for i, s in pairs]
        return _record(rows, ["anchor_id", "positive_id", "positive_score"])

    def mined(block, chunk):
        own_block, rows = Block(block), []
        for anchor_id, vector in _anchors(chunk):
            body = len(vector) - n_positives - 1
            positive = vector[body + 1 :]
            windows = [
                window_of(int(s), n_negatives, low, high) for s in positive[~np.isnan(positive)]
            ]
            negatives_of(own_block, int(vector[body]), quantised(vector[:body]), windows)
            for slot, window in enumerate(windows, 1):
                pairs = zip(window.ids.tolist(), window.scores.tolist(), strict=True)
                rows += [(anchor_id, slot, i, s) for i, s in pairs]
        return _record(rows, ["anchor_id", "slot", "negative_id", "negative_score"])

    with Scratch(vectors.sparkSession) as scratch:
        made = packed(by_cell(labelled, books), parts)
        blocks = scratch.staged(made, "multi-index", large_rows=True)
        asked = scratch.staged(asked, "multi-anchors")
        found = every_pair(
            blocks, _chunks(asked, 0), best, "anchor_id long, positive_id long, positive_score long"
        )
        order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
        positives = found.withColumn("slot", F.row_number().over(order))
        positives = scratch.staged(
            positives.where(F.col("slot") <= n_positives).withColumn("slot", F.col("slot").cast("long")),
            "multi-positives",
        )
        listed = F.array_sort(F.collect_list(F.struct("slot", "positive_score")))
        scores = F.transform(listed, lambda s: s["positive_score"].cast("double"))
        none = F.array_repeat(F.lit(float("nan")), n_positives)
        padded = F.slice(F.concat(scores, none), 1, n_positives)
        wanted = positives.groupBy(F.col("anchor_id").alias("vec_id")).agg(padded.alias("scores"))
        second = asked.join(wanted, "vec_id").select("vec_id", F.concat("vector", "scores").alias("vector"))
        second = scratch.staged(second, "multi-windows")
        found = every_pair(
            blocks,
            _chunks(second, n_positives),
            mined,
            "anchor_id long, slot long, negative_id long, negative_score long",
        )
        order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("negative_score"), "negative_id")
        ranked = found.withColumn("rank", F.row_number().over(order).cast("int"))
        rows = ranked.where(F.col("rank") <= n_negatives).join(positives, ["anchor_id", "slot"])
        return staged(
            rows.select(
                "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
            ),
            "hard-negatives",
        )
