"""A training corpus from `documents`: stages that each write a table for the next.

    languages   texts without letters or that no languages explain go
    lines       lines whose template recurs in another document go
    copies      one document of each group of near copies stays
    personal    personal data is masked
    packing     documents become pieces of training sequences

Each stage takes (spark, docs, sf_dir) and works on all rows of `docs`. All but
the last return the columns of `docs`, whatever they are beside `doc_id` and
`text`; `lang` is needed by the first. Null texts have no letters and go first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import languages, line_templates, packing, parity_join, pii
from tidemark.llm.common import prepare, vocabulary
from tidemark.session import scratch_path, staged

#: A text whose chosen languages have a smaller share than this together is rejected.
LEAST_SHARE = 0.4

#: Language models and fields are no SQL: the stages are tested against plain versions.
ORACLE_SQL = None


def _counted(docs: DataFrame) -> DataFrame:
    """`n_chars` brought in line with the text, where there is such a column."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind)).select(docs.columns)


def stage_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents with letters that languages explain; their columns are unchanged."""
    prepare(spark)
    models = languages.fit(docs.where(~languages.held_out() & F.col("doc_id").isNotNull()))
    read = docs.withColumn("__read", F.col("text"))
    predicted = languages.predict(read, models, "__read", explained=True)
    accepted = (F.col("lang_pred") != languages.UNKNOWN) & (F.col("explained") >= LEAST_SHARE)
    return predicted.where(accepted).select(docs.columns)


def stage_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut recurring lines; a document that consisted of them goes."""
    marked = docs.withColumn("__before", F.length("text"))
    kept = line_templates.drop_recurring_lines(marked, whole=True)
    whole = F.length("text").eqNullSafe(F.col("__before"))
    return _counted(kept.where(whole | F.col("text").rlike(f"[^{line_templates.WHITE}]")).select(docs.columns))


def stage_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, keep the document with the smallest id.

    Documents with an empty set or without an id stay. Rows that repeat an id are
    one document and stay together. The ids that go are written first, so that Spark
    knows how few they are and shuffles no texts to leave them out.
    """
    prepare(spark)
    found = parity_join.linked_documents(docs)
    others = found.where(F.col("component_id") != F.col("doc_id")).select("doc_id").distinct()
    others = staged(others, "pipeline-others")
    return docs.join(others, "doc_id", "left_anti").select(docs.columns)


def stage_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask personal data; no document goes."""
    prepare(spark)
    return _counted(pii.mask_personal_data(docs))


def stage_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences, as operator 9's query returns them."""
    prepare(spark)
    return packing.pack(docs, vocabulary("word_bpe_49k.json"), digest=True)


STAGES = [
    ("languages", stage_languages),
    ("lines", stage_lines),
    ("copies", stage_copies),
    ("personal", stage_personal),
    ("packing", stage_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared scratch folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        folder = scratch_path(spark, f"pipeline-{name}")
        made = stage(spark, docs, sf_dir)
        made.write.parquet(folder)
        docs = spark.read.schema(made.schema).parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
