"""What several operators share: reading tables, slicing batches, hashing words."""

from __future__ import annotations

import ctypes
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from tidemark.session import ship_package

#: Characters of text that one step inside a task holds as Python objects.
SLICE_CHARS = 1_000_000


#: Rows of an Arrow batch, at most: a batch of texts is held several times over.
BATCH_ROWS = 1_000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def prepare(spark: SparkSession) -> None:
    """Send the package to the workers, which need it to unpickle, and bound Arrow
    batches: the default of 10,000 rows suits numbers, not texts."""
    ship_package(spark)
    if not 0 < int(spark.conf.get(_BATCH_SETTING)) <= BATCH_ROWS:
        spark.conf.set(_BATCH_SETTING, BATCH_ROWS)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, for work in Python workers."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Path of an installed public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return freed memory to the system: workers live on, and executors have to hold
    them beside the JVM."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def text_slices(
    batches: Iterable[pa.RecordBatch], text: str = "text", chars: int = SLICE_CHARS
) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Each batch in slices of about `chars` bytes of text, with the texts as strings.

    A text longer than that is a slice of its own; none is cut. After the last
    slice, memory that the task has freed goes back to the system.
    """
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        sizes = np.nan_to_num(
            np.asarray(pc.binary_length(column).to_numpy(zero_copy_only=False), dtype=float)
        )
        ends = np.cumsum(sizes)
        start = 0
        while start < len(sizes):
            before = ends[start - 1] if start else 0.0
            stop = max(start + 1, int(np.searchsorted(ends, before + chars, side="right")))
            piece = batch.slice(start, stop - start)
            yield piece, piece.column(piece.schema.get_field_index(text)).to_pylist()
            start = stop
    give_back()


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser over uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeded(name: str, n: int) -> np.ndarray:
    """`n` fixed 64-bit values that follow from `name`."""
    start = np.uint64(zlib.crc32(name.encode()))
    steps = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix64(steps + (start << np.uint64(32)))


_BYTE_VALUES = seeded("byte", 256)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


_powers: dict[int, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1), modulo 2**64."""
    known = _powers.get(int(base))
    if known is None or len(known) < n:
        known = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        known[0] = 1
        known = np.cumprod(known, dtype=np.uint64)
        if len(known) <= 2 * SLICE_CHARS:
            _powers[int(base)] = known
    return known[:n]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges [start, end), by one prefix sum over all bytes."""
    n = len(data)
    terms = _BYTE_VALUES[data] * powers(_BASE, n)
    prefix = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(terms, out=prefix[1:], dtype=np.uint64)
    unscaled = (prefix[ends] - prefix[starts]) * powers(_BASE_INVERSE, n + 1)[starts]
    return mix64(unscaled + (ends - starts).astype(np.uint64))
