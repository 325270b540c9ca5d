"""Operator 1. N-gram Jaccard join with parity sketches.

Two sets link when 100 * intersection >= 80 * union. Then their sizes a, b are
within a factor of 0.8, and their symmetric difference is at most D = (a + b) / 9.

Pigeonhole. A size band covers the pairs whose D lies between two grid values;
d is the higher. Shingle hashes are cut into P ranges, the parts. The XOR of the
hashes in each part is the set's parity there. A difference of at most d shingles
leaves at least one part untouched, so linked sets of a band agree on the parity
of a part, and (band, part, parity) is the join key. A set is in every band that
its possible partners lead to, mostly two.

Empty parts. Any two sets may share an empty part, so such a part would be a key
that joins unrelated sets. P is therefore larger than d + 1: P - d parts are
untouched, about a third of d + 1. If one set of a linked pair has fewer empty
parts than that, one of the untouched parts has a member in it, and so in both.
Only sets with P - d empty parts or more have keys for empty parts as well.

Odds. Of a larger P, the first `MOST_PARTS` = 96 are used. Up to d = 95 (sets of
about 430 shingles) at least 96 - d of those are untouched, and the pigeonhole is
exact. Beyond that, a part is touched by a pair at the very threshold with a
chance of about 1 - exp(-1/1.3) = 0.54, or empty, so all 96 are with one of 2**-82.

Candidates. A key's smallest document is paired with each of the others, first
within a task, so that a key that very many documents share leaves a task as one
row, then among tasks. Pairs are checked against one-bit parity sketches, whose
Hamming distance is at most the symmetric difference, then exactly on the sets.

Equal sets are one node from the start, whose document is the smallest. From the
candidates on, the work is that of `links`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SLICE_CHARS, mix64, seeded, text_slices
from tidemark.llm.links import copies_of_sets, linked_components
from tidemark.llm.shingles import digest, shingle_sets
from tidemark.session import Scratch, scratch_path

PERCENT = 80
MOST_PARTS = 96
#: Keys that a task gathers before it pairs them and hands them on.
GATHERED = 500_000
#: A sketch has 2**11 cells or more.
LEAST_BITS = 11


def _grid() -> np.ndarray:
    values = [0]
    while values[-1] < 1 << 40:
        values.append(max(values[-1] + 1, int(values[-1] * 1.25)))
    return np.array(values, dtype=np.int64)


GRID = _grid()


def bands(size: int) -> range:
    """Bands that a set of `size` shares with its possible partners."""
    smallest, largest = -(-4 * size // 5), 5 * size // 4
    low, high = np.searchsorted(GRID, [(size + smallest) // 9, (size + largest) // 9])
    return range(int(low), int(high) + 1)


def parts_of(d: int) -> tuple[int, int, int]:
    """Parts for a difference of `d`, those used, and how many of these it leaves
    untouched at least."""
    parts = d + 1 + max(2, -(-3 * (d + 1) // 10))
    used = min(parts, MOST_PARTS)
    return parts, used, used - d


def part_keys(hashes: np.ndarray) -> np.ndarray:
    """The join keys of a set's parts in all its bands."""
    out = []
    for band in bands(len(hashes)):
        parts, used, untouched = parts_of(int(GRID[band]))
        part = (((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)
        part = part[: np.searchsorted(part, used)]
        if len(part):
            first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            parity, part = np.bitwise_xor.reduceat(hashes[: len(part)], first), part[first]
        else:
            parity = np.empty(0, dtype=np.uint64)
        if 0 < untouched <= used - len(part):
            full = np.zeros(used, dtype=np.uint64)
            full[part] = parity
            part, parity = np.arange(used), full
        out.append(mix64(mix64(parity) ^ (_BAND[band] + part.astype(np.uint64) * _STEP)))
    return np.concatenate(out)


_BAND, _STEP = seeded("band", len(GRID)), np.uint64(0x9E3779B97F4A7C15)


def bit_sketch(hashes: np.ndarray) -> bytes:
    """Parity of the members in 2**k one-bit cells: two to four a member, 2048 at least."""
    bits = max(LEAST_BITS, (2 * len(hashes) - 1).bit_length())
    cells = mix64(hashes ^ np.uint64(0x5DEECE66D)) >> np.uint64(64 - bits)
    odd = np.bincount(cells.astype(np.int64), minlength=1 << bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="big").tobytes()


def folded(sketch: np.ndarray, words: int) -> np.ndarray:
    """A sketch with fewer cells: neighbouring cells are added modulo two."""
    while len(sketch) > words:
        # cells 2i and 2i+1 fall together when a hash loses its last bit
        bits = np.unpackbits(sketch.view(np.uint8))
        sketch = np.packbits(bits[0::2] ^ bits[1::2]).view(np.uint64)
    return sketch


def most_apart(sizes, percent: int):
    """The symmetric difference that two linked sets of `sizes` members have at most."""
    return sizes * (100 - percent) // (100 + percent)


def may_link(a: bytes, b: bytes, size_a: int, size_b: int, percent: int = PERCENT) -> bool:
    """False only if the sizes or the sketches rule a link out."""
    if 100 * min(size_a, size_b) < percent * max(size_a, size_b):
        return False
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    words = min(len(x), len(y))
    apart = int(np.bitwise_count(folded(x, words) ^ folded(y, words)).sum())
    return apart <= most_apart(size_a + size_b, percent)


def described(docs: DataFrame) -> DataFrame:
    """`doc_id`, `n_shingles`, digests `da`, `db` and `sketch` of every row."""

    def work(batches):
        for piece, texts in text_slices(batches, chars=SLICE_CHARS // 2):
            sets = shingle_sets(texts)
            digests = [digest(s) if len(s) else (0, 0) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([a for a, _ in digests], pa.int64()),
                    pa.array([b for _, b in digests], pa.int64()),
                    pa.array([bit_sketch(s) if len(s) else None for s in sets], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "da", "db", "sketch"],
            )

    return docs.mapInArrow(
        work, "doc_id long, n_shingles long, da long, db long, sketch binary"
    )


def keyed(docs: DataFrame) -> DataFrame:
    """`key`, `pivot`, `doc`: part keys, paired within the task.

    `pivot` is null for a key's smallest document in the task, else that one.
    A set met before in the task is left out, as its digest names it already.
    """

    def work(batches):
        seen: set[tuple[int, int]] = set()
        keys, owners, held = [], [], 0

        def paired():
            key, doc = np.concatenate(keys), np.concatenate(owners)
            order = np.lexsort((doc, key))
            key, doc = key[order], doc[order]
            first = np.r_[True, key[1:] != key[:-1]]
            pivot = doc[np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(key.view(np.int64)),
                    pa.array(pivot, pa.int64(), mask=first),
                    pa.array(doc, pa.int64()),
                ],
                names=["key", "pivot", "doc"],
            )

        for piece, texts in text_slices(batches, chars=SLICE_CHARS // 2):
            for doc_id, hashes in zip(
                piece.column(0).to_pylist(), shingle_sets(texts), strict=True
            ):
                if not len(hashes) or (own := digest(hashes)) in seen:
                    continue
                seen.add(own)
                made = part_keys(hashes)
                keys.append(made)
                owners.append(np.full(len(made), doc_id, dtype=np.int64))
                held += len(made)
                if held >= GATHERED:
                    yield paired()
                    keys, owners, held = [], [], 0
        if held:
            yield paired()

    return docs.mapInArrow(work, "key long, pivot long, doc long")


def candidate_rows(keys: DataFrame) -> DataFrame:
    """`key`, `pivot`, `doc` for all documents that share a key with its smallest."""
    # rows paired in their task need no other row and are dealt out by themselves
    dealt = keys.withColumn(
        "deal", F.when(F.col("pivot").isNull(), F.col("key")).otherwise(F.xxhash64("key", "doc"))
    )
    smallest = F.min("doc").over(Window.partitionBy("deal"))
    return (
        dealt.withColumn("pivot", F.coalesce("pivot", smallest))
        .where(F.col("doc") != F.col("pivot"))
        .select("key", "pivot", "doc")
    )


def near(
    labels, blocks, sizes, sketches, inner, percent: int = PERCENT
) -> tuple[np.ndarray, np.ndarray]:
    """Places of pairs from two components (and blocks, if there are two) that may link."""
    out_x, out_y = [], []
    lengths = np.array([len(s) // 8 for s in sketches])
    # the sizes of partners, and so the widths of their sketches, differ little:
    # each two meet at the lower width of the two
    for words in np.unique(lengths).tolist():
        fits = np.flatnonzero((lengths == words) | (lengths == 2 * words))
        matrix = np.stack([folded(np.frombuffer(sketches[i], np.uint64), words) for i in fits])
        lab, size, wide = labels[fits], sizes[fits], lengths[fits]
        for at in range(len(fits) - 1):
            rest = slice(at + 1, None)
            open_ = lab[rest] != lab[at]
            open_ &= (wide[rest] == words) | (wide[at] == words)
            if not inner:
                open_ &= blocks[fits[rest]] != blocks[fits[at]]
            small, large = np.minimum(size[rest], size[at]), np.maximum(size[rest], size[at])
            open_ &= 100 * small >= percent * large
            to = at + 1 + np.flatnonzero(open_)
            if len(to):
                apart = np.bitwise_count(matrix[to] ^ matrix[at]).sum(axis=1)
                to = to[apart <= most_apart(size[to] + size[at], percent)]
                out_x.append(np.full(len(to), fits[at]))
                out_y.append(fits[to])
    if not out_x:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return np.concatenate(out_x), np.concatenate(out_y)


def linked_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """`doc_id`, `n_shingles`, `component_id` of every row.

    `component_id` is the smallest id reachable by links. A null or wordless text
    has an empty set and links with nothing. Rows that repeat an id are one
    document that has the links of each; rows without an id link with nothing and
    have no component. Other columns are not read. An empty table stays empty.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    path = scratch_path(spark, "parity-components")
    with Scratch(spark) as scratch:
        rows = scratch.staged(described(docs), "parity-sets")
        usable = rows.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
        reps = scratch.staged(copies_of_sets(usable), "parity-copies")
        keys = keyed(docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()))
        shared = scratch.staged(candidate_rows(keys), "parity-candidates")
        whole = linked_components(docs, rows, reps, shared, may_link, near, PERCENT, scratch)
        found = rows.join(whole, "doc_id", "left").select(
            "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
        )
        found.write.parquet(path)
    return spark.read.schema(found.schema).parquet(path)
