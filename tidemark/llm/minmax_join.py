"""Operator 11. Near copies by min-max hashing.

A permutation of the 64-bit shingle hashes gives a set two values, the smallest
and the largest. Two sets agree on either with a chance equal to their similarity,
so the share of equal values is an unbiased estimate of it, of a lower variance
than from as many smallest values alone, and half as many hashes are evaluated:
`PERMUTATIONS` = 96 for 192 values.

Banding. `BANDS` = 32 bands take the values of three permutations each, six
values, and (band, values) is a key. Sets of similarity s share a key of one band
with a chance of about s**6, so a pair at the threshold of 0.85 shares none of the
32 with a chance of about 3e-7, one of similarity 0.9 with 1e-11. This is the only
place where the join can miss a link; all that follows is exact.

Pairs are first held to their parity sketches, whose Hamming distance is at most
the symmetric difference (`parity_join.bit_sketch`): among thousands of texts that
are alike but below the threshold, hardly a pair is left to read again.

Pairs with a key's smallest document are checked first, then what is still in
different components, all on the full sets (`links`). Equal sets are one node from
the start, whose document is the smallest.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SLICE_CHARS, mix64, seeded, text_slices
from tidemark.llm.links import copies_of_sets, linked_components
from tidemark.llm.parity_join import bit_sketch, may_link, near
from tidemark.llm.shingles import digest, shingle_sets
from tidemark.session import Scratch, scratch_path

#: Similarity in percent from which documents link.
PERCENT = 85
PERMUTATIONS, BANDS = 96, 32
VALUES = 2 * PERMUTATIONS
_FLIP, _ODD = seeded("min-max flip", PERMUTATIONS), seeded("min-max odd", PERMUTATIONS) | np.uint64(1)
_BAND = seeded("min-max band", BANDS)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Smallest and largest value of each set under each permutation: sets x `VALUES`.

    Neighbouring columns are the two values of one permutation. Sets must not be
    empty.
    """
    whole = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), VALUES), dtype=np.uint64)
    for p in range(PERMUTATIONS):
        values = (whole ^ _FLIP[p]) * _ODD[p]
        values ^= values >> np.uint64(32)
        out[:, 2 * p] = np.minimum.reduceat(values, starts)
        out[:, 2 * p + 1] = np.maximum.reduceat(values, starts)
    return out


def band_keys(made: np.ndarray) -> np.ndarray:
    """The join keys of signatures: sets x `BANDS`."""
    parts = made.reshape(len(made), BANDS, -1)
    key = np.broadcast_to(_BAND, parts.shape[:2]).copy()
    for i in range(parts.shape[2]):
        key = mix64(key ^ parts[:, :, i])
    return key


def described(docs: DataFrame) -> DataFrame:
    """`doc_id`, `n_shingles`, digests `da`, `db`, `sketch` and `keys` of every row."""

    def work(batches):
        for piece, texts in text_slices(batches, chars=SLICE_CHARS // 2):
            sets = shingle_sets(texts)
            full = np.flatnonzero([len(s) > 0 for s in sets])
            digests = [digest(s) if len(s) else (0, 0) for s in sets]
            held: list[bytes | None] = [None] * len(sets)
            keys: list[np.ndarray | None] = [None] * len(sets)
            if len(full):
                made = signatures([sets[i] for i in full])
                for i, key in zip(full.tolist(), band_keys(made).view(np.int64), strict=True):
                    held[i], keys[i] = bit_sketch(sets[i]), key
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([a for a, _ in digests], pa.int64()),
                    pa.array([b for _, b in digests], pa.int64()),
                    pa.array(held, pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "da", "db", "sketch", "keys"],
            )

    return docs.mapInArrow(
        work,
        "doc_id long, n_shingles long, da long, db long, sketch binary, keys array<long>",
    )


def candidate_rows(keys: DataFrame, scratch: Scratch) -> DataFrame:
    """`key`, `pivot`, `doc` for all documents that share a key with its smallest.

    The smallest document is an aggregate, which tasks start on their own rows;
    keys of one document go before anything is joined.
    """
    shared = keys.groupBy("key").agg(F.min("doc").alias("pivot"), F.max("doc").alias("last"))
    shared = scratch.staged(shared.where("pivot < last").select("key", "pivot"), "minmax-shared")
    return keys.join(shared, "key").where("doc <> pivot").select("key", "pivot", "doc")


def near_copies(docs: DataFrame, text: str = "text", percent: int = PERCENT) -> DataFrame:
    """`doc_id`, `n_shingles`, `component_id` of every row.

    Documents link when 100 * intersection >= `percent` * union of their sets;
    `component_id` is the smallest id reachable by links. A null or wordless text
    has an empty set and links with nothing. Rows that repeat an id are one
    document that has the links of each; rows without an id link with nothing and
    have no component. Other columns are not read. An empty table stays empty.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    path = scratch_path(spark, "near-copies")
    with Scratch(spark) as scratch:
        rows = scratch.staged(described(docs), "minmax-sets")
        usable = rows.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
        reps = scratch.staged(copies_of_sets(usable), "minmax-copies")
        # of equal sets only the first document has keys
        own = usable.select("doc_id", "keys").join(
            reps.where("doc_id = rep").select("doc_id"), "doc_id", "left_semi"
        )
        keys = own.select(F.explode("keys").alias("key"), F.col("doc_id").alias("doc")).distinct()
        shared = scratch.staged(candidate_rows(keys, scratch), "minmax-candidates")
        whole = linked_components(
            docs,
            rows.drop("keys"),
            reps,
            shared,
            lambda a, b, x, y: may_link(a, b, x, y, percent),
            lambda *args: near(*args, percent),
            percent,
            scratch,
        )
        found = rows.select("doc_id", "n_shingles").join(whole, "doc_id", "left").select(
            "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
        )
        found.write.parquet(path)
    return spark.read.schema(found.schema).parquet(path)
