"""Operator 9. Packing documents along a space-filling curve.

A document's tokens are hashed into a vector of counts, which a fixed random
projection brings down to few dimensions. The Hilbert key of that point orders
the documents, so that neighbours on the curve, which are alike, share training
sequences. Documents are laid end to end in that order and cut every 4096
tokens; what is left at the end is cut into powers of two, which need no padding.

Only the narrow columns (key, id, length) are range-sorted. A document's place
is the tokens before it in its partition plus those of the partitions before.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.common import mix64, seeded, text_slices
from tidemark.llm.pieces import WORD_PIECES, LibraryEncoder, encoder, word_pieces
from tidemark.llm.token_counts import merge_table
from tidemark.session import scratch_path

SEQUENCE = 4096
END_ID = 2
BUCKETS, DIMENSIONS, BITS = 256, 4, 12


def projection() -> np.ndarray:
    """A fixed random BUCKETS x DIMENSIONS matrix with orthonormal columns."""
    rng = np.random.default_rng(seeded("packing", 2).astype(np.uint32))
    q, _ = np.linalg.qr(rng.standard_normal((BUCKETS, DIMENSIONS)))
    return q


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of integer points (n x d, each below 2**bits), as int64."""
    x = points.astype(np.int64).T.copy()
    d = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(d):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, d):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], dtype=np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        turn = np.where((x[d - 1] & q) != 0, turn ^ (q - 1), turn)
        q >>= 1
    x ^= turn
    key = np.zeros(x.shape[1], dtype=np.int64)
    for bit in range(bits - 1, -1, -1):
        for i in range(d):
            key = key << 1 | (x[i] >> bit & 1)
    return key


def document_keys(packed: list[bytes], matrix: np.ndarray) -> np.ndarray:
    """Hilbert keys of documents given as packed two-byte ids."""
    bucket = (mix64(np.arange(1 << 16, dtype=np.uint64)) % np.uint64(BUCKETS)).astype(np.int64)
    vectors = np.empty((len(packed), BUCKETS))
    for i, ids in enumerate(packed):
        vectors[i] = np.bincount(bucket[np.frombuffer(ids, dtype="<u2")], minlength=BUCKETS)
    vectors = np.sqrt(vectors)
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    points = (vectors / np.where(length == 0, 1, length)) @ matrix
    cells = (np.tanh(2 * points) + 1) / 2 * ((1 << BITS) - 1)
    return hilbert_keys(cells.astype(np.int64))


class WordEncoder(LibraryEncoder):
    """The library's ids; plain pieces are merged in batches by operator 4's table."""

    def load(self, path: str):
        self.table = merge_table(path)
        return self.table.library

    def normal(self, text: str) -> str:
        return text.lower()

    def bounds(self, data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return word_pieces(data, begins)

    def cut(self, text: str) -> list[str]:
        return WORD_PIECES.findall(text.lower())

    def ask_pieces(self, pieces: list[str]) -> list[bytes]:
        return self.table.ids([p.encode() for p in pieces])


def tokenised(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """`doc_id`, `doc_tokens` (the end id included), packed `ids` and Hilbert `key`."""

    def work(batches):
        matrix = projection()
        end = END_ID.to_bytes(2, "little")
        for piece, texts in text_slices(batches):
            packed = encoder(WordEncoder, path).packed([t or "" for t in texts])
            keys = document_keys(packed, matrix)
            packed = [p + end for p in packed]
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column(0),
                    pa.array([len(p) // 2 for p in packed], pa.int64()),
                    pa.array(packed, pa.binary()),
                    pa.array(keys, pa.int64()),
                ],
                names=["doc_id", "doc_tokens", "ids", "key"],
            )

    narrow = docs.select(F.col("doc_id").cast("long"), F.col(text).alias("text"))
    return narrow.mapInArrow(work, "doc_id long, doc_tokens long, ids binary, key long")


def places(tokens: DataFrame) -> tuple[DataFrame, int]:
    """`row` and `place` (tokens before it on the curve) of each document, and all tokens.

    Equal keys are ordered by document id, then row, so that a key shared by
    very many documents is dealt to several partitions.
    """
    spark = tokens.sparkSession
    order = ["key", "doc_id", "row"]

    def running(batches):
        before = 0
        for batch in batches:
            sizes = batch.column(1).to_numpy()
            ends = before + np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ends - sizes), batch.column(1), batch.column(2)],
                names=["row", "inside", "doc_tokens", "part"],
            )
            before = int(ends[-1]) if len(ends) else before

    ordered = (
        tokens.select("key", "doc_id", "row", "doc_tokens")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("row", "doc_tokens", F.spark_partition_id().alias("part"))
        .mapInArrow(running, "row long, inside long, doc_tokens long, part int")
    )
    path = scratch_path(spark, "packing-order")
    ordered.write.parquet(path)
    ordered = spark.read.schema(ordered.schema).parquet(path)
    parts = ordered.groupBy("part").agg(F.sum("doc_tokens").alias("tokens"))
    total = parts.agg(F.sum("tokens")).first()[0] or 0
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("part", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("base"))
    place = (F.col("base") + F.col("inside")).alias("place")
    placed = ordered.join(bases, "part").select("row", place)
    return placed, int(total)


def cuts(total: int) -> np.ndarray:
    """Where the sequences after the last full one begin and end: powers of two."""
    at, out = total - total % SEQUENCE, []
    rest = total - at
    while rest:
        out.append(at)
        size = 1 << (rest.bit_length() - 1)
        at, rest = at + size, rest - size
    return np.array([*out, total], dtype=np.int64)


def piece_crc(packed: bytes) -> int:
    """crc32 of two-byte ids written as four bytes each."""
    return zlib.crc32(np.frombuffer(packed, dtype="<u2").astype("<u4").tobytes())


def pack(docs: DataFrame, path: str, text: str = "text", digest: bool = False) -> DataFrame:
    """One row per piece of a document: where it lies in which sequence, and its ids.

    `doc_id, start, length, ids, doc_tokens, sequence_id, offset`; `ids` are
    packed two-byte ids. With `digest`, `ids_crc32` stands for them. A null or empty text is its end id alone. Repeated rows
    are packed each; columns other than `doc_id` and the text are not read; an
    empty table gives no pieces.
    """
    spark = docs.sparkSession
    made = tokenised(docs, path, text)
    made = made.withColumn("row", F.monotonically_increasing_id())
    folder = scratch_path(spark, "packing-tokens")
    made.write.option("compression", "zstd").parquet(folder)
    tokens = spark.read.schema(made.schema).parquet(folder)
    placed, total = places(tokens)
    tail = cuts(total)
    shown, last = (piece_crc, "ids_crc32 long") if digest else (bytes, "ids binary")
    schema = (
        f"doc_id long, start long, length long, {last}, doc_tokens long,"
        " sequence_id long, offset long"
    )

    def cut(batches):
        for batch in batches:
            rows = []
            for doc_id, place, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                n = len(ids) // 2
                first = place - place % SEQUENCE + SEQUENCE
                inner = np.arange(first, place + n, SEQUENCE)
                bounds = np.r_[place, inner, tail[(tail > place) & (tail < place + n)], place + n]
                bounds = np.unique(bounds).tolist()
                for low, high in zip(bounds[:-1], bounds[1:], strict=True):
                    if low < tail[0]:
                        sequence, offset = divmod(low, SEQUENCE)
                    else:
                        nth = int(np.searchsorted(tail, low, side="right")) - 1
                        sequence = int(tail[0]) // SEQUENCE + nth
                        offset = low - int(tail[nth])
                    piece = ids[2 * (low - place) : 2 * (high - place)]
                    own = shown(piece)
                    rows.append((doc_id, low - place, high - low, own, n, sequence, offset))
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, target, strict=True)], schema=target
            )

    target = to_arrow_schema(spark.createDataFrame([], schema).schema)
    joined = tokens.select("row", "doc_id", "ids").join(placed, "row")
    return joined.select("doc_id", "place", "ids").mapInArrow(cut, schema)
