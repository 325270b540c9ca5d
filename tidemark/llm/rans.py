"""Operator 10. Token ids in files of interleaved range asymmetric numeral systems.

A file holds the ids of neighbouring documents. One frequency table, scaled to
2**18, serves all its blocks. A block of up to 32 x 1024 ids is coded by 32
interleaved states that share one stream of 32-bit words. The checkpoint of a
block is its place in the stream and its 32 states, so any block can be decoded
alone, and a checksum of its ids tells whether it was decoded right. Numpy works
on all states of a file at once.

Layout, little-endian:
    magic "TMR1", u64 ids, u32 steps, u32 blocks, u32 table bytes
    table: zlib of symbol gaps and frequencies (u32 each)
    for each block: u64 first word, u32 crc32 of its ids (two bytes each)
    states: blocks x 32 u64
    words: u32
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import text_slices
from tidemark.llm.packing import piece_crc
from tidemark.llm.pieces import LibraryEncoder, encoder
from tidemark.session import scratch_path

MAGIC = b"TMR1"
LANES, STEPS, SCALE_BITS = 32, 1024, 18
LOW = np.uint64(1 << 31)
WORD = np.uint64(32)
SCALE = np.uint64(SCALE_BITS)
#: Ids after which a file is closed, once its last document is complete.
FILE_IDS = 1_000_000
END_ID = 0


def scaled(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to 2**18, none of a used symbol below one."""
    total = 1 << SCALE_BITS
    out = np.maximum(1, np.floor(counts * (total / counts.sum())).astype(np.int64))
    left = total - int(out.sum())
    if left > 0:
        out[np.argmax(out)] += left
    while left < 0:
        # take from the largest, each in proportion to what it has to give
        room = out - 1
        take = np.minimum(room, np.ceil(room * (-left / room.sum())).astype(np.int64))
        order = np.argsort(-room, kind="stable")
        given = np.minimum(np.cumsum(take[order]), -left)
        out[order] -= np.diff(given, prepend=0)
        left = total - int(out.sum())
    return out


def encode_file(ids: np.ndarray) -> bytes:
    """The file of an array of uint16 ids."""
    n = len(ids)
    if not n:
        return struct.pack("<4sQIII", MAGIC, 0, 0, 0, 0)
    counts = np.bincount(ids, minlength=1 << 16)
    symbols = np.flatnonzero(counts)
    code_of = np.zeros(1 << 16, dtype=np.int64)
    code_of[symbols] = np.arange(len(symbols))
    freq = scaled(counts[symbols])
    start = np.cumsum(freq) - freq
    steps = min(STEPS, -(-n // LANES))
    blocks = -(-n // (LANES * steps))
    filled = np.full(blocks * LANES * steps, int(np.argmax(freq)), dtype=np.int64)
    filled[:n] = code_of[ids]
    # step t of a block codes ids t*LANES .. t*LANES+LANES-1
    by_step = filled.reshape(blocks, steps, LANES).transpose(1, 0, 2).reshape(steps, -1)
    f64, c64 = freq.astype(np.uint64), start.astype(np.uint64)
    top = f64 << np.uint64(31 - SCALE_BITS + 32)
    state = np.full(blocks * LANES, LOW, dtype=np.uint64)
    words = np.zeros(by_step.shape, dtype=np.uint32)
    sent = np.zeros(by_step.shape, dtype=bool)
    for t in range(steps - 1, -1, -1):
        code = by_step[t]
        f = f64[code]
        full = state >= top[code]
        sent[t] = full
        words[t] = state.astype(np.uint32)
        state = np.where(full, state >> WORD, state)
        whole = state // f
        state = (whole << SCALE) + (state - whole * f) + c64[code]
    sent = sent.reshape(steps, blocks, LANES).transpose(1, 0, 2)
    words = words.reshape(steps, blocks, LANES).transpose(1, 0, 2)
    stream = words[sent]
    sizes = sent.reshape(blocks, -1).sum(axis=1)
    table = zlib.compress(
        np.concatenate([np.diff(symbols, prepend=0), freq]).astype("<u4").tobytes(), 6
    )
    size = LANES * steps
    index = b"".join(
        struct.pack("<QI", at, zlib.crc32(ids[b * size : (b + 1) * size].astype("<u2").tobytes()))
        for b, at in enumerate((np.cumsum(sizes) - sizes).tolist())
    )
    return b"".join(
        [
            struct.pack("<4sQIII", MAGIC, n, steps, blocks, len(table)),
            table,
            index,
            state.astype("<u8").tobytes(),
            stream.astype("<u4").tobytes(),
        ]
    )


def decode_file(data: bytes, only: slice = slice(None)) -> np.ndarray:
    """The ids of a file, or of the blocks that `only` selects, checked block by block."""
    magic, n, steps, blocks, table_size = struct.unpack_from("<4sQIII", data)
    if magic != MAGIC:
        raise ValueError("not a file of token ids")
    if not n:
        return np.empty(0, dtype=np.uint16)
    at = struct.calcsize("<4sQIII")
    table = np.frombuffer(zlib.decompress(data[at : at + table_size]), dtype="<u4").astype(np.int64)
    symbols, freq = np.cumsum(table[: len(table) // 2]), table[len(table) // 2 :]
    at += table_size
    index = np.frombuffer(data, dtype=[("first", "<u8"), ("crc", "<u4")], count=blocks, offset=at)
    at += index.nbytes
    states = np.frombuffer(data, dtype="<u8", count=blocks * LANES, offset=at)
    stream = np.frombuffer(data, dtype="<u4", offset=at + states.nbytes)
    chosen = np.arange(blocks)[only]
    slots = np.repeat(np.arange(len(freq), dtype=np.int32), freq)
    f64 = freq.astype(np.uint64)
    shift = (np.cumsum(freq) - freq).astype(np.uint64)
    state = states.reshape(blocks, LANES)[chosen].astype(np.uint64).ravel()
    place = index["first"][chosen].astype(np.int64)
    padded = np.r_[stream, np.uint32(0)]
    mask = np.uint64((1 << SCALE_BITS) - 1)
    out = np.empty((steps, len(chosen), LANES), dtype=np.uint16)
    names = symbols.astype(np.uint16)
    for t in range(steps):
        slot = state & mask
        code = slots[slot]
        out[t] = names[code].reshape(len(chosen), LANES)
        state = f64[code] * (state >> SCALE) + slot - shift[code]
        need = (state < LOW).reshape(len(chosen), LANES)
        taken = np.cumsum(need, axis=1)
        at_word = np.minimum(place[:, None] + taken - 1, len(stream))
        state = np.where(
            need.ravel(), state << WORD | padded[at_word.ravel()].astype(np.uint64), state
        )
        place += taken[:, -1]
    by_block = out.transpose(1, 0, 2).reshape(len(chosen), -1)
    size = LANES * steps
    parts = []
    for b, ids in zip(chosen.tolist(), by_block, strict=True):
        ids = ids[: max(0, min(size, n - b * size))]
        if zlib.crc32(ids.astype("<u2").tobytes()) != index["crc"][b]:
            raise ValueError(f"block {b} is damaged")
        parts.append(ids)
    return np.concatenate(parts)


FILES = (
    "part int, file int, start long, ids long, doc_ids array<long>, sizes array<long>,"
    " data binary"
)


def write_files(docs: DataFrame, path: str, folder: str, text: str = "text") -> None:
    """Encode documents in ascending `doc_id` order and write the files' table.

    A row of the table is a file; `part` and `file` put them in order, `start`
    counts the ids before it in its part. A null text is empty, and each document
    ends with id 0. Repeated ids are neighbours, in an order that their
    texts decide; null ids come first. Other columns are not read. An empty table gives no file.
    """
    ends = END_ID.to_bytes(2, "little")

    def work(batches):
        part = TaskContext.get().partitionId()
        file = start = held = 0
        doc_ids, packed = [], []

        def closed():
            ids = np.frombuffer(b"".join(packed), dtype="<u2")
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([file], pa.int32()),
                    pa.array([start], pa.int64()),
                    pa.array([len(ids)], pa.int64()),
                    pa.array([doc_ids], pa.list_(pa.int64())),
                    pa.array([[len(p) // 2 for p in packed]], pa.list_(pa.int64())),
                    pa.array([encode_file(ids)], pa.binary()),
                ],
                names=["part", "file", "start", "ids", "doc_ids", "sizes", "data"],
            )

        for piece, texts in text_slices(batches):
            made = encoder(LibraryEncoder, path).packed([t or "" for t in texts])
            for doc_id, ids in zip(piece.column(0).to_pylist(), made, strict=True):
                doc_ids.append(doc_id)
                packed.append(ids + ends)
                held += len(ids) // 2 + 1
                if held >= FILE_IDS:
                    yield closed()
                    file, start, held = file + 1, start + held, 0
                    doc_ids, packed = [], []
        if packed:
            yield closed()

    narrow = docs.select(F.col("doc_id").cast("long"), F.col(text).alias("text"))
    (
        narrow.withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie", "text")
        .select("doc_id", "text")
        .mapInArrow(work, FILES)
        .write.option("compression", "uncompressed")
        .parquet(folder)
    )


def read_files(spark: SparkSession, folder: str, digest: bool = False) -> DataFrame:
    """`doc_id`, `start`, `n_tokens`, packed `ids` of every document in a folder of files.

    With `digest`, `ids_crc32` (of the ids as four bytes each) stands for the ids.
    """
    kind, name = (pa.int64(), "ids_crc32") if digest else (pa.binary(), "ids")
    shown = piece_crc if digest else bytes
    files = spark.read.schema(FILES).parquet(folder)
    parts = files.groupBy("part").agg(F.sum("ids").alias("held"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("part", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("base"))
    placed = files.join(bases, "part").select(
        (F.col("base") + F.col("start")).alias("first"), "doc_ids", "sizes", "data"
    )

    def work(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                first, doc_ids, sizes, data = (c[i].as_py() for c in batch.columns)
                ids = decode_file(data)
                stops = np.cumsum(np.array(sizes, dtype=np.int64))
                if stops[-1] != len(ids):
                    raise ValueError("a file's documents and ids differ")
                starts = stops - sizes
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids, pa.int64()),
                        pa.array(starts + first, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(
                            [shown(ids[a:b].tobytes()) for a, b in zip(starts, stops, strict=True)],
                            kind,
                        ),
                    ],
                    names=["doc_id", "start", "n_tokens", name],
                )

    last = "ids_crc32 long" if digest else "ids binary"
    return placed.mapInArrow(work, f"doc_id long, start long, n_tokens long, {last}")


def through_files(
    docs: DataFrame, path: str, text: str = "text", digest: bool = False
) -> DataFrame:
    """Write the files of `docs` to the shared scratch folder and read them back."""
    folder = scratch_path(docs.sparkSession, "token-files")
    write_files(docs, path, folder, text)
    return read_files(docs.sparkSession, folder, digest)
