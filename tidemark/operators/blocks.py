"""A stated set of query vectors against all rows, block by block.

Rows are indexed where they are read, in blocks of bounded size, and written
once. Queries are packed in chunks; every block gets every chunk, joined on the
block's bucket, so work and shuffle are spread over as many keys as there are
blocks. A task sees one block and one chunk at a time and hands on `k` rows per
query, of which the best `k` are kept in the end.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import staged

#: Rows of a block and queries of a chunk, at most, and numbers in either.
BLOCK_ROWS, CHUNK_ROWS, CELLS = 32_768, 1_024, 1 << 22
PACKED = "block long, dim int, packed binary"


def usable(vector: Column) -> Column:
    """Not null, and without null, NaN or infinite components."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def matrices(batches, rows: int):
    """`(vec_ids, matrix)` of up to `rows` vectors of one length, in order of id."""
    held: dict[int, list] = {}

    def closed(dim):
        parts = held.pop(dim)
        ids = np.concatenate([i for i, _ in parts])
        matrix = np.concatenate([m for _, m in parts])
        order = np.argsort(ids, kind="stable")
        return ids[order], matrix[order]

    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        vectors = batch.column(1)
        sizes = np.diff(vectors.offsets.to_numpy())
        flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        starts = np.cumsum(sizes) - sizes
        for dim in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == dim)
            matrix = flat[starts[at][:, None] + np.arange(dim)]
            most = max(1, min(rows, CELLS // max(dim, 1)))
            for low in range(0, len(at), most):
                part = slice(low, low + most)
                room = most - sum(len(i) for i, _ in held.get(dim, []))
                if len(at[part]) > room:
                    yield closed(dim)
                held.setdefault(dim, []).append((ids[at[part]], matrix[part]))
    for dim in list(held):
        yield closed(dim)


def packed(
    rows: DataFrame,
    parts: Callable[[Iterator], Iterator[tuple[int, bytes]]],
    described: Callable[[bytes], dict[str, pa.Array]] | None = None,
    columns: str = "",
) -> DataFrame:
    """Rows of `PACKED`: what `parts` makes of a task's Arrow batches, numbered.

    `described` gives more `columns` of a block, which can be read without it.
    """

    def work(batches):
        task = TaskContext.get().partitionId()
        for n, (dim, data) in enumerate(parts(batches)):
            more = described(data) if described else {}
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([task << 32 | n], pa.int64()),
                    pa.array([dim], pa.int32()),
                    pa.array([data], pa.binary()),
                    *more.values(),
                ],
                names=["block", "dim", "packed", *more],
            )

    return rows.mapInArrow(work, f"{PACKED}, {columns}" if columns else PACKED)


def packed_vectors(
    vectors: DataFrame, rows: int, pack: Callable[[np.ndarray, np.ndarray], bytes]
) -> DataFrame:
    """Blocks of up to `rows` of the vectors (`vec_id`, `vector`), each of one length."""

    def parts(batches):
        for ids, matrix in matrices(batches, rows):
            yield matrix.shape[1], pack(ids, matrix)

    return packed(vectors.select("vec_id", "vector"), parts)


def every_pair(blocks: DataFrame, chunks: DataFrame, search: Callable, schema: str) -> DataFrame:
    """What `search(block, chunk)` finds, for every block and chunk of the same `dim`.

    `blocks` must be a written table, as it is counted. Chunks are copied to each
    bucket of blocks; there are as many buckets as blocks.
    """
    buckets = max(1, blocks.count())
    copies = F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket")
    chunks = chunks.select("dim", F.col("packed").alias("chunk"), copies)
    bucket = F.pmod(F.xxhash64("block"), F.lit(buckets)).cast("int")
    bucketed = blocks.select("dim", "packed", bucket.alias("bucket"))
    pairs = (
        bucketed.repartition(2 * buckets, "bucket")
        .join(chunks.repartition(2 * buckets, "bucket"), ["bucket", "dim"])
        .select("packed", "chunk")
    )

    def work(batches):
        for batch in batches:
            for block, chunk in zip(*batch.columns, strict=True):
                yield search(block.as_py(), chunk.as_py())

    return pairs.mapInArrow(work, schema)


def in_chunks(queries: DataFrame) -> DataFrame:
    """Queries dealt to as many tasks as they fill chunks."""
    return queries.repartition(max(1, -(-queries.count() // CHUNK_ROWS)))


def best_of_blocks(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    index: Callable[[np.ndarray, np.ndarray], bytes],
    search: Callable[[bytes, np.ndarray, np.ndarray, int], tuple],
    score_type: str,
) -> DataFrame:
    """`query_id, rank, vec_id, score` of the `k` best rows `search` finds for each query.

    `index(ids, matrix)` packs a block; `search(block, query_ids, queries, k)`
    returns arrays of query ids, vector ids and scores, at most `k` per query.
    A query meets only vectors of its own length. Ties go to the smaller id.
    """
    blocks = staged(packed_vectors(vectors, BLOCK_ROWS, index), "vector-blocks", large_rows=True)

    def as_chunk(ids, matrix):
        size = np.array(matrix.shape, dtype="<i8").tobytes()
        return size + ids.astype("<i8").tobytes() + matrix.astype("<f8").tobytes()

    arrow_score = pa.int64() if score_type == "long" else pa.float64()

    def pair(block, chunk):
        n, dim = np.frombuffer(chunk, "<i8", 2).tolist()
        query_ids = np.frombuffer(chunk, "<i8", n, 16)
        wanted = np.frombuffer(chunk, "<f8", n * dim, 16 + 8 * n).reshape(n, dim)
        found = search(block, query_ids, wanted, k)
        types = (pa.int64(), pa.int64(), arrow_score)
        return pa.RecordBatch.from_arrays(
            [pa.array(x, t) for x, t in zip(found, types, strict=True)],
            names=["query_id", "vec_id", "score"],
        )

    chunks = packed_vectors(in_chunks(queries), CHUNK_ROWS, as_chunk)
    found = every_pair(blocks, chunks, pair, f"query_id long, vec_id long, score {score_type}")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
