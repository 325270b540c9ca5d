"""One registered query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bit_sliced,
    byte_bpe,
    languages,
    line_templates,
    merkle,
    minmax_join,
    multi_index,
    one_bit,
    packing,
    parity_join,
    pii,
    rans,
    token_counts,
)
from tidemark.llm.common import read_table, vocabulary

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


#: Documents of more tokens than this are over the limit.
TOKEN_LIMIT = 2048


@query
def op1_parity_sketch_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.linked_documents(read_table(spark, sf_dir, "documents"))


@query
def op2_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", languages.held_out().alias("held_out")
    )
    models = languages.fit(docs.where(~F.col("held_out") & F.col("doc_id").isNotNull()))
    return languages.predict(docs.select("doc_id", "held_out", "text"), models)


@query
def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find_personal_data(docs)


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.token_counts(docs, vocabulary("word_bpe_49k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return byte_bpe.round_trip(docs, vocabulary("byte_bpe_multi_50k.tiktoken"))


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read_table(spark, sf_dir, "embeddings")
    return table.select("vec_id", F.col("embedding").alias("vector"))


@query
def op6_bit_sliced_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _vectors(spark, sf_dir)
    return bit_sliced.exact_top_k(vectors, vectors.where("vec_id % 100 = 0"), k=10)


@query
def op7_one_bit_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _vectors(spark, sf_dir)
    return one_bit.nearest(vectors, vectors.where("vec_id % 20 = 0"), k=20)


@query
def op8_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_templates.drop_recurring_lines(docs, counts=True, whole=True)
    text = F.coalesce("text", F.lit(""))
    return kept.select(
        "doc_id",
        "n_lines",
        "n_dropped",
        F.length(text).cast("long").alias("n_chars"),
        F.md5(text.cast("binary")).alias("text_md5"),
    )


@query
def op9_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, vocabulary("word_bpe_49k.json"), digest=True)


@query
def op10_rans_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return rans.through_files(docs, vocabulary("byte_bpe_50k.json"), digest=True)


@query
def op11_minmax_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minmax_join.near_copies(read_table(spark, sf_dir, "documents"))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_proofs(read_table(spark, sf_dir, "documents"))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = read_table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").alias("vector"), label.alias("label")
    )
    return multi_index.hard_negatives(vectors, vectors.where("vec_id % 50 = 0"))
