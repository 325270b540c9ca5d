import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import audit
from tidemark.plans import gate

KEY = "sk-proj-" + "a1B2" * 6


def texts(spark, *rows):
    return spark.createDataFrame(list(rows), "path string, text string")


def test_secret_matches_placeholders_and_redaction(spark):
    rows = texts(
        spark,
        ("a.md", f"x {KEY} y sk-{'z' * 20}"),
        ("b.md", f"sk-YOUR-{'q' * 20} and sk-short"),
        ("c.md", "kiosk-apps-using-kiosk-designer-pro"),
    )
    matches = audit.secret_matches(rows, "path", "text")
    assert matches.count() == 4
    hits = audit.redacted(audit.without_placeholders(matches))
    assert sorted(r.hit for r in hits.collect()) == [
        "a.md: sk-proj-a1B2...",
        "a.md: sk-zzzzzzzzz...",
        "c.md: sk-apps-usin...",
    ]
    strict = audit.secret_matches(rows, "path", "text", strict=True)
    assert {r.path for r in strict.collect()} == {"a.md", "b.md"}
    rolled = {r.path: r.hits for r in audit.hits_by_path(hits).collect()}
    assert rolled["a.md"] == "a.md: sk-proj-a1B2...; a.md: sk-zzzzzzzzz..."


def test_secrets_check_counts_hits_and_documents(spark):
    hits = spark.createDataFrame([(p, f"{p}: h") for p in "ppq"], "path string, hit string")
    row = audit.secrets_check(hits).first()
    assert (row.ok, row.message) == (False, "3 leaked keys in 2 documents")
    empty = audit.secrets_check(hits.limit(0)).first()
    assert (empty.ok, empty.message) == (True, "no leaked keys")


@pytest.mark.parametrize(
    "lines, expected",
    [
        ([], (False, True, "no snapshot so far, not checked")),
        (['{"articles":{}}'], (False, True, "all parts parse")),
        (['{"articles":{}}', '{"articles":'], (True, False, "some parts do not parse")),
        (["{'articles':{}}"], (True, False, "some parts do not parse")),
    ],
)
def test_snapshot_check(spark, lines, expected):
    raw = spark.createDataFrame([(line,) for line in lines], "raw string")
    row = audit.snapshot_check(raw).first()
    assert (row.required, row.ok, row.message) == expected


def test_gate(spark):
    documents = texts(spark, *[(f"{i}.md", "fine") for i in range(29)], ("k.md", KEY))
    raw = spark.createDataFrame([], "raw string")
    checks = gate.gate_checks(documents, "path", "text", raw)
    assert tuple(audit.gate_verdict(checks).first()) == (3, 1, False)
    assert audit.gate_summary(checks, documents).first().line == (
        "[gate] FAIL (1 unmet) | articles=30 | articles>=30=ok, no-hardcoded-secrets=x"
    )
    report = json.loads(audit.gate_json(checks).first().report)
    assert report["passed"] is False
    assert [c["name"] for c in report["checks"]] == [
        "articles>=30", "no-hardcoded-secrets", "snapshot-valid",
    ]
    assert report["checks"][1]["message"] == "1 leaked keys in 1 documents"


def test_gate_passes(spark):
    documents = texts(spark, *[(f"{i}.md", "fine") for i in range(30)])
    checks = gate.gate_checks(documents, "path", "text", spark.createDataFrame([], "raw string"))
    assert audit.gate_summary(checks, documents).first().line.startswith("[gate] PASS")


def test_empty_corpus_fails_the_minimum(spark):
    row = audit.minimum_corpus_check(texts(spark)).first()
    assert (row.ok, row.message) == (False, "0 documents, 30 at least")


@pytest.mark.parametrize(
    "text, cited, bullets",
    [
        ("see\nArticle URL: https://e.com", True, 0),
        ("so [12] it", True, 0),
        ("so [x] it - no", False, 0),
        ("- a\n * b\n•\tc\n1. d\n2.e\nf - g", False, 4),
    ],
)
def test_answer_predicates(spark, text, cited, bullets):
    row = spark.createDataFrame([(text,)], "t string").select(
        audit.is_cited(F.col("t")), audit.bullet_count(F.col("t")), audit.over_bullet_cap(F.col("t"), 3)
    )
    assert tuple(row.first()) == (cited, bullets, bullets > 3)


def test_is_answered(spark):
    wide = "a b" + "\U0001f600" * 749  # 1,501 UTF-16 units in 752 characters
    rows = spark.createDataFrame([("a b " * 400,), ("a b",), ("a " * 900,), (wide,)], "t string")
    found = rows.select(audit.is_answered(F.col("t"), ("a", "b")).alias("v")).collect()
    assert [r.v for r in found] == [True, False, False, True]
