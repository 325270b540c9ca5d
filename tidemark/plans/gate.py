"""Quality gate over a corpus: a few checks, one row each, and their verdict."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.operators import audit


def secret_hits(texts: DataFrame, path: str, text: str) -> DataFrame:
    """Table of leaked keys: one redacted row per hit."""
    matches = audit.secret_matches(texts, path, text)
    return audit.redacted(audit.without_placeholders(matches))


def gate_checks(documents: DataFrame, path: str, text: str, raw_snapshot: DataFrame) -> DataFrame:
    return audit.combine_checks(
        audit.minimum_corpus_check(documents),
        audit.secrets_check(secret_hits(documents, path, text)),
        audit.snapshot_check(raw_snapshot),
    )
