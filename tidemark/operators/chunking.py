"""Fixed-size chunks with overlap, and the keyed chunk table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import chunk_estimate, u16_length

CHARS_PER_TOKEN = 4

# U+FFFF is no character of any text.
FILLER = "\uffff"

# Default chunk size and overlap, in tokens.
MAX_TOKENS = 800
OVERLAP_TOKENS = 400


def chunk_texts(text: Column, max_tokens: int, overlap: int) -> Column:
    """Array of chunk texts. The last one runs to the end of the text, so the
    chunks cover it whole. Sizes count UTF-16 units, as the estimate does; a
    character of two units is never cut.

    The text is cut once into pieces of one stride, and each chunk is put
    together from neighbouring pieces. Taking a substring per chunk would scan
    the text from its start every time.
    """
    stride = max_tokens - overlap
    if overlap < 0 or stride < 1:
        raise ValueError("overlap must be from 0 to less than the chunk size")
    size, step = max_tokens * CHARS_PER_TOKEN, stride * CHARS_PER_TOKEN
    per_chunk = -(-size // step)
    units = u16_length(text)
    n_chunks = chunk_estimate(units, max_tokens, overlap).cast("int")
    # a filler after each character of two units makes characters count as units
    filled = F.when(units == F.char_length(text), text).otherwise(
        F.regexp_replace(text, r"[\x{10000}-\x{10FFFF}]", "$0" + FILLER)
    )
    pieces = F.regexp_extract_all(filled, F.lit("(?s).{1,%d}" % step), F.lit(0))

    def build(pieces_: Column) -> Column:
        last = n_chunks - 1

        def chunk(i: Column) -> Column:
            inner = F.array_join(F.slice(pieces_, i + 1, F.lit(per_chunk)), "")
            tail = F.array_join(F.slice(pieces_, i + 1, F.greatest(F.size(pieces_), F.lit(1))), "")
            chosen = F.when(i < last, F.substring(inner, 1, size)).otherwise(tail)
            return F.replace(chosen, F.lit(FILLER), F.lit(""))

        return F.transform(F.sequence(F.lit(0), last), chunk)

    # A one-element transform binds the pieces, so they are cut once per text.
    return F.element_at(F.transform(F.array(pieces), build), 1)


def split_chunks(
    documents: DataFrame,
    text: str = "md_text",
    max_tokens: int = MAX_TOKENS,
    overlap: int = OVERLAP_TOKENS,
) -> DataFrame:
    """One row per chunk: the document's other columns, `chunk_no` and `text`.

    The rows are made by one generator whose input is already an array of
    small texts, so the document is not copied into each chunk row.
    """
    others = [c for c in documents.columns if c != text]
    chunks = chunk_texts(F.col(text), max_tokens, overlap)
    return documents.select(*others, F.posexplode(chunks).alias("chunk_no", "text"))


def chunk_rows(
    documents: DataFrame, max_tokens: int = MAX_TOKENS, overlap: int = OVERLAP_TOKENS
) -> DataFrame:
    """The chunk table's rows of `documents` (id, file_id, filename, url, md_text)."""
    chunks = split_chunks(
        documents.select("id", "file_id", "filename", "url", "md_text"),
        max_tokens=max_tokens,
        overlap=overlap,
    )
    return chunks.select(
        F.concat_ws("#", F.col("file_id"), F.col("chunk_no").cast("string")).alias("chunk_id"),
        "file_id",
        F.col("id").alias("doc_id"),
        "filename",
        "url",
        "chunk_no",
        "text",
    )


def replace_on_update(existing: DataFrame, new: DataFrame, replaced: DataFrame) -> DataFrame:
    """`existing` without the documents in `replaced`, plus the `new` rows."""
    kept = existing.join(replaced.select("doc_id"), "doc_id", "left_anti")
    return kept.unionByName(new)


def deleted_rows(existing: DataFrame, replaced: DataFrame) -> DataFrame:
    """Audit of what `replace_on_update` takes away."""
    return existing.join(replaced.select("doc_id"), "doc_id", "left_semi")


def live_chunks(chunks: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Chunks of the file each document's snapshot entry names.

    Runs only ever append chunk versions; what is live is decided by the
    snapshot, so writing a snapshot swaps all documents of a run at once.
    """
    files = snapshot.filter(F.col("file_id").isNotNull()).select("file_id")
    return chunks.join(files, "file_id", "left_semi")
