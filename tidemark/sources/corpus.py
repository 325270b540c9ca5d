"""The document corpus: Markdown files as input, a versioned table as output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text as tx
from tidemark.operators.skew import last_by
from tidemark.schemas import CORPUS
from tidemark.session import staged
from tidemark.storage import path_exists, read_all, versions, write_version


def read_markdown_files(spark: SparkSession, path: str, extension: str = "md") -> DataFrame:
    """One row per file below `path`; a missing folder has none."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], "filename string, md_text string")
    files = spark.read.text(
        path, wholetext=True, recursiveFileLookup=True, pathGlobFilter=f"*.{extension}"
    )
    return files.select(
        F.col("_metadata.file_name").alias("filename"), F.col("value").alias("md_text")
    )


def write_document_lines(documents: DataFrame, path: str) -> None:
    """Documents as JSON lines of `filename` and `md_text`: many to a file, which a
    large corpus needs."""
    documents.select("filename", "md_text").write.mode("overwrite").json(path)


def read_document_lines(spark: SparkSession, path: str) -> DataFrame:
    """The same rows as `read_markdown_files`, from JSON lines."""
    return spark.read.schema("filename string, md_text string").json(path)


def parse_headers(documents: DataFrame, text: str = "md_text") -> DataFrame:
    """Title, address and id out of each document's header."""
    return documents.select(
        "*",
        tx.header_title(F.col(text)).alias("title"),
        tx.header_url(F.col(text)).alias("url"),
        tx.header_id(F.col(text)).alias("id"),
    )


def corpus_hashes(spark: SparkSession, root: str, without: int | None = None) -> DataFrame:
    """(filename, hash) of the current corpus; document text is not read. `without`:
    a version that is written anew."""
    stored = read_all(spark, root, CORPUS, without).select("filename", "hash", "version")
    return last_by(stored, "filename", F.col("version")).select("filename", "hash")


def corpus_delta(documents: DataFrame, current: DataFrame) -> DataFrame:
    """Places of the documents to write: of each file name the last one of the
    run, where it differs from the stored one. `documents` may be narrow."""
    last = last_by(
        documents.select("filename", "id", "hash", "page_no", "pos"),
        "filename",
        F.struct("page_no", "pos"),
    )
    stored = current.select("filename", F.col("hash").alias("_stored"))
    differs = ~F.col("_stored").eqNullSafe(F.col("hash"))
    return last.join(stored, "filename", "left").filter(differs).select("id", "page_no", "pos")


def write_corpus(documents: DataFrame, root: str, version: int, replace: bool = False) -> str:
    return write_version(documents.select(CORPUS.fieldNames()), root, version, replace)


def read_corpus(spark: SparkSession, root: str) -> DataFrame:
    """The current corpus: of each file name the newest version.

    Texts meet the list of replaced (file name, version) pairs, which is as long
    as what runs have changed since, not as the corpus.
    """
    stored = read_all(spark, root, CORPUS)
    places = stored.select("filename", "version")
    newest = places.groupBy("filename").agg(F.max("version").alias("newest"))
    replaced = places.join(newest, "filename").filter("version < newest").drop("newest")
    replaced = staged(replaced, "replaced")
    return stored.join(replaced, ["filename", "version"], "left_anti").drop("version")


def compact(spark: SparkSession, root: str, target: str) -> str:
    """Copy the current corpus to one version of a corpus below `target`, leaving
    replaced versions of documents behind. Point the workspace to it afterwards."""
    newest = versions(spark, root)[-1]
    return write_corpus(read_corpus(spark, root), target, newest)
