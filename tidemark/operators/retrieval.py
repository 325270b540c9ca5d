"""Top-k search for batches of questions, and citations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.words import distinct_words, words
from tidemark.operators.blocks import (
    CHUNK_ROWS,
    best_of_blocks,
    every_pair,
    in_chunks,
    packed,
    usable,
)
from tidemark.operators.postings import (
    SCORE_DIGITS,
    Postings,
    best_in_block,
    first_of_block,
    index_parts,
    ragged_slices,
)
from tidemark.schemas import RESPONSE
from tidemark.session import staged

# Fixed value: sources a reply may cite.
MAX_CITATIONS = 3

# Queries that are multiplied with a block at once.
SIDE_BY_SIDE = 64

NO_TEXT = "(no text)"


def top_k(rows: DataFrame, by: str, order: list[Column], k: int) -> DataFrame:
    """First `k` rows of each group with their `rank`.

    Spark cuts each task's rows to `k` per group before the shuffle.
    """
    rank = F.row_number().over(Window.partitionBy(by).orderBy(*order))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= k)


def _index(items: DataFrame) -> DataFrame:
    """Items as blocks of an inverted index; each text is read once, in its row."""
    hashed = items.select(
        F.col("doc_id").cast("long"),
        F.col("item_id").cast("long"),
        F.transform(words(F.coalesce("text", F.lit(""))), lambda w: F.xxhash64(w)).alias("terms"),
    )
    columns = "items long, terms array<long>, df array<int>"
    return staged(packed(hashed, index_parts, _vocabulary, columns), "postings", large_rows=True)


def _vocabulary(data: bytes) -> dict[str, pa.Array]:
    """Number of items of a block, its terms, and in how many items each is."""
    block = Postings(data)
    terms, df = block.vocabulary()
    return {
        "items": pa.array([len(block.docs)], pa.int64()),
        "terms": pa.ListArray.from_arrays(np.array([0, len(terms)], np.int32), pa.array(terms)),
        "df": pa.ListArray.from_arrays(np.array([0, len(df)], np.int32), pa.array(df.astype(np.int32))),
    }


def _weights(blocks: DataFrame, questions: DataFrame) -> DataFrame:
    """Words of each question with their weight. Words that all items hold weigh
    nothing and are left out.

    Blocks name their words in columns of their own, so the postings are not read.
    Only words that are asked for are counted.
    """
    asked = questions.select(
        F.col("question_id").cast("long"), F.explode(distinct_words(F.col("text"))).alias("word")
    ).select("question_id", F.xxhash64("word").alias("term"))
    asked = staged(asked, "asked-words")
    n_items = blocks.agg(F.sum("items")).first()[0] or 0
    vocabulary = blocks.select(F.inline(F.arrays_zip("terms", "df"))).toDF("term", "df")
    found = vocabulary.join(asked.select("term"), "term", "left_semi")
    frequency = staged(found.groupBy("term").agg(F.sum("df").alias("df")), "block-words")
    idf = F.ln((F.lit(n_items) + 1) / (F.col("df") + 1))
    weighed = asked.join(frequency, "term").withColumn("idf", idf).filter(F.col("idf") > 0)
    listed = F.array_sort(F.collect_list(F.struct("term", "idf")))
    return weighed.groupBy("question_id").agg(listed.alias("words")).select(
        "question_id",
        F.transform("words", lambda w: w["term"]).alias("terms"),
        F.transform("words", lambda w: w["idf"]).alias("weights"),
    )


def _question_chunks(batches) -> Iterator[tuple[int, bytes]]:
    """Packed ids, numbers of words, words and weights of up to `CHUNK_ROWS` questions."""
    for part, sizes in ragged_slices(batches, CHUNK_ROWS, 1):
        terms, weights = (part.column(i).flatten().to_numpy() for i in (1, 2))
        head = np.array([part.num_rows, len(terms)], dtype="<i8")
        numbers = [head, part.column(0).to_numpy(), sizes, terms]
        packed_ = b"".join(a.astype("<i8").tobytes() for a in numbers)
        yield 0, packed_ + weights.astype("<f8").tobytes()


def _questions(data: bytes) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    n, n_terms = np.frombuffer(data, "<i8", 2).tolist()
    ids, sizes = np.frombuffer(data, "<i8", 2 * n, 16).reshape(2, n)
    terms = np.frombuffer(data, "<i8", n_terms, 16 + 16 * n)
    weights = np.frombuffer(data, "<f8", n_terms, 16 + 16 * n + 8 * n_terms)
    ends = np.cumsum(sizes)
    for question, low, high in zip(ids.tolist(), ends - sizes, ends, strict=True):
        yield question, terms[low:high], weights[low:high]


def _best_items(items: DataFrame, questions: DataFrame, k: int, per_doc: bool) -> DataFrame:
    """The `k` best items of every block for each question, by tf-idf; with
    `per_doc` the best item of each of the `k` best documents.

    Neither words nor scores are shuffled: items are indexed in blocks where they
    are read, and a task searches one block for one chunk of questions.
    """
    blocks = _index(items)
    weights = staged(_weights(blocks, questions), "question-words")
    chunks = packed(in_chunks(weights), _question_chunks)

    def search(data: bytes, chunk: bytes) -> pa.RecordBatch:
        block, rows = Postings(data), []
        score = np.zeros(len(block.docs))
        for question, wanted, idf in _questions(chunk):
            kept, points, _, _ = best_in_block(block, wanted, idf, k, per_doc, score)
            first = first_of_block(block, kept, points, k, per_doc)
            kept, points = kept[first], points[first]
            rows.append((np.full(len(kept), question), block.docs[kept], block.ids[kept], points))
        columns = [np.concatenate(c) for c in zip(*rows, strict=True)] or [[]] * 4
        types = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
            names=["question_id", "doc_id", "item_id", "score"],
        )

    found = every_pair(
        blocks, chunks, search, "question_id long, doc_id long, item_id long, score double"
    )
    return found.withColumn("item_id", F.col("item_id").cast(items.schema["item_id"].dataType))


def lexical_top_k(items: DataFrame, questions: DataFrame, k: int) -> DataFrame:
    """The `k` items of highest tf-idf for each question, ties by item.

    `items` has `doc_id, item_id, text` (an item is a document or one of its
    chunks; ids are whole numbers), `questions` has `question_id, text`.
    """
    found = _best_items(items, questions, k, per_doc=False)
    return top_k(found, "question_id", [F.col("score").desc(), F.col("item_id")], k)


def best_sources(chunks: DataFrame, questions: DataFrame, k: int = MAX_CITATIONS) -> DataFrame:
    """The `k` best documents per question, each with its best chunk.

    `chunks` has `doc_id, item_id, text`. The cut comes after each document is
    reduced to one chunk, so one long document cannot take all places.
    """
    found = _best_items(chunks, questions, k, per_doc=True)
    best = F.min_by(F.struct("item_id", "score"), F.struct(-F.col("score"), F.col("item_id")))
    per_doc = found.groupBy("question_id", "doc_id").agg(best.alias("best"))
    flat = per_doc.select("question_id", "doc_id", "best.*")
    return top_k(flat, "question_id", [F.col("score").desc(), F.col("doc_id")], k)


def cited_context(sources: DataFrame, urls: DataFrame, questions: DataFrame) -> DataFrame:
    """One row per question: its sources' addresses in rank order, none if it
    has no source. A source without address is left out of the list.

    `sources` holds at most `k` rows per question, so each list is that short.
    """
    listed = F.array_sort(F.collect_list(F.struct("rank", "url")))
    addressed = F.filter(F.transform(listed, lambda s: s["url"]), lambda url: url.isNotNull())
    found = sources.join(urls, "doc_id", "left").groupBy("question_id").agg(addressed.alias("urls"))
    empty = F.array().cast("array<string>")
    return questions.select("question_id").join(found, "question_id", "left").select(
        "question_id", F.coalesce("urls", empty).alias("urls")
    )


def _unit_rows(matrix: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(norms == 0, 1.0, norms)


def _unit_block(ids: np.ndarray, matrix: np.ndarray) -> bytes:
    size = np.array(matrix.shape, dtype="<i8")
    return size.tobytes() + ids.astype("<i8").tobytes() + _unit_rows(matrix).astype("<f8").tobytes()


def _nearest(block: bytes, query_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple:
    """The `k` vectors of a block with the highest cosine, ties by id, for each query."""
    n, dim = np.frombuffer(block, "<i8", 2).tolist()
    ids = np.frombuffer(block, "<i8", n, 16)
    vectors = np.frombuffer(block, "<f8", n * dim, 16 + 8 * n).reshape(n, dim)
    unit = _unit_rows(queries)
    rows: list[tuple] = []
    for low in range(0, len(unit), SIDE_BY_SIDE):
        scores = np.round(unit[low : low + SIDE_BY_SIDE] @ vectors.T, SCORE_DIGITS)
        for query, row in zip(query_ids[low:], scores, strict=False):
            least = np.partition(row, -k)[-k] if n > k else -np.inf
            hits = np.flatnonzero(row >= least)
            hits = hits[np.lexsort((ids[hits], -row[hits]))][:k]
            rows.append((np.full(len(hits), query), ids[hits], row[hits]))
    return tuple(np.concatenate(x) for x in zip(*rows, strict=True))


def vector_top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Exact cosine top-k of `queries` (query_id, embedding) over `vectors`
    (vec_id, embedding).

    Vectors are packed in blocks where they are read; each block meets each chunk
    of queries and hands on `k` vectors per query. Rows whose vector is null or
    has null or non-finite components take no part, and a query meets only
    vectors of its length.
    """
    rows = vectors.select("vec_id", F.col("embedding").alias("vector"))
    asked = queries.select(
        F.col("query_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector")
    )
    fit = usable(F.col("vector")) & F.col("vec_id").isNotNull()
    found = best_of_blocks(rows.where(fit), asked.where(fit), k, _unit_block, _nearest, "double")
    return found.select("query_id", "vec_id", "score", "rank")


def mean_vectors(vectors: DataFrame, by: str) -> DataFrame:
    """Mean vector per group as (query_id, embedding): a topic as a query.

    Sums are formed per coordinate, so a large group is added up in parts.
    """
    flat = vectors.select(by, F.posexplode("embedding").alias("i", "x"))
    means = flat.groupBy(by, "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    listed = F.array_sort(F.collect_list(F.struct("i", "x")))
    return means.groupBy(by).agg(F.transform(listed, lambda c: c["x"]).alias("embedding")).select(
        F.col(by).cast("long").alias("query_id"), "embedding"
    )


def parse_responses(responses: DataFrame, raw: str = "response") -> DataFrame:
    """Answer text and distinct cited files out of response JSON.

    A response's annotations are gathered inside its row; nothing is shuffled.
    """
    parsed = responses.withColumn("_r", F.from_json(raw, RESPONSE))
    contents = F.flatten(F.transform("_r.output", lambda item: _list(item["content"])))
    annotations = F.flatten(F.transform(contents, lambda part: _list(part["annotations"])))
    names = F.transform(annotations, lambda note: note["filename"])
    named = F.filter(names, lambda name: name.isNotNull() & (name != ""))
    return parsed.select(
        *responses.columns,
        F.coalesce("_r.output_text", F.lit(NO_TEXT)).alias("answer"),
        F.coalesce(F.array_distinct(named), F.array().cast("array<string>")).alias("cited"),
    )


def _list(items: Column) -> Column:
    return F.coalesce(items, F.array())


def citation_log(responses: DataFrame, key: str, raw: str = "response") -> DataFrame:
    """One row per response and file it cites; a response that cites none has one
    row without file, so that no answer is lost."""
    parsed = parse_responses(responses.select(key, raw), raw)
    return parsed.select(key, "answer", F.explode_outer("cited").alias("filename"))
