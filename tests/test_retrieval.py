import json
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import blocks, postings, retrieval

TEXTS = [
    "how to add a video to a screen",
    "add a screen. Add another screen!",
    "billing and plans",
    "a video about billing a plan",
    "nothing here",
    "how how how",
]
QUESTIONS = ["How do I add a YouTube video?", "billing plan", "zzz", ""]


def words(text):
    return [w for w in re.split(r"[\W_]+", text.lower()) if w]


def brute_force(texts, questions):
    bags = [Counter(words(t)) for t in texts]
    df = Counter(w for bag in bags for w in bag)
    scores = {}
    for q, question in enumerate(questions):
        for d, bag in enumerate(bags):
            shared = [w for w in set(words(question)) & set(bag) if df[w] < len(texts)]
            if shared:
                total = sum(bag[w] * math.log((len(texts) + 1) / (df[w] + 1)) for w in shared)
                scores[q, d] = round(total, 6)
    return scores


@pytest.fixture
def items(spark):
    return spark.createDataFrame(
        [(d, d, t) for d, t in enumerate(TEXTS)], "doc_id long, item_id long, text string"
    )


@pytest.fixture
def questions(spark):
    return spark.createDataFrame(list(enumerate(QUESTIONS)), "question_id long, text string")


def test_lexical_scores_equal_brute_force(items, questions, monkeypatch):
    monkeypatch.setattr(postings, "BLOCK_ROWS", 2)
    monkeypatch.setattr(retrieval, "CHUNK_ROWS", 1)
    rows = retrieval.lexical_top_k(items, questions, 100).collect()
    assert {(r.question_id, r.doc_id): r.score for r in rows} == brute_force(TEXTS, QUESTIONS)


def test_lexical_top_k(items, questions):
    rows = retrieval.lexical_top_k(items, questions, 2).collect()
    expected = {}
    for (q, d), score in brute_force(TEXTS, QUESTIONS).items():
        expected.setdefault(q, []).append((-score, d))
    expected = {(q, i + 1): d for q, hits in expected.items() for i, (_, d) in enumerate(sorted(hits)[:2])}
    assert {(r.question_id, r.rank): r.doc_id for r in rows} == expected


def test_best_sources_take_distinct_documents(spark):
    chunks = spark.createDataFrame(
        [(1, 0, "video video video"), (1, 1, "video video"), (2, 0, "video"), (3, 0, "other")],
        "doc_id long, item_id int, text string",
    )
    asked = spark.createDataFrame([(0, "video")], "question_id long, text string")
    found = retrieval.best_sources(chunks, asked, 2)
    assert sorted((r["rank"], r.doc_id, r.item_id) for r in found.collect()) == [(1, 1, 0), (2, 2, 0)]
    urls = spark.createDataFrame([(1, "u1"), (2, "u2")], "doc_id long, url string")
    more = asked.union(spark.createDataFrame([(5, "zzz")], asked.schema))
    context = retrieval.cited_context(found, urls.filter("doc_id = 2"), more).collect()
    assert {r.question_id: r.urls for r in context} == {0: ["u2"], 5: []}


def test_scores_are_cut_before_the_shuffle(items, questions):
    plan = retrieval.lexical_top_k(items, questions, 2)._jdf.queryExecution().executedPlan()
    assert "WindowGroupLimit" in plan.toString()


@pytest.mark.parametrize("rows", [32_768, 40])
def test_vector_top_k_equals_brute_force(spark, rows, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_ROWS", rows)
    monkeypatch.setattr(blocks, "CHUNK_ROWS", 3)
    rng = np.random.default_rng(1)
    vectors, queries = rng.normal(size=(300, 8)), rng.normal(size=(7, 8))
    vectors[40] = vectors[3]
    vectors[50] = 0
    frame = spark.createDataFrame(
        [(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>"
    ).repartition(5)
    asked = spark.createDataFrame(
        [(i, v.tolist()) for i, v in enumerate(queries)], "query_id long, embedding array<double>"
    )
    found = retrieval.vector_top_k(frame, asked, 4).collect()
    exact = vectors.astype(np.float32).astype(float)
    norms = np.linalg.norm(exact, axis=1)
    norms[norms == 0] = 1
    expected = set()
    for q, query in enumerate(queries):
        scores = np.round(exact @ query / norms / np.linalg.norm(query), 6)
        order = sorted(range(300), key=lambda i: (-scores[i], i))[:4]
        expected |= {(q, i, rank + 1) for rank, i in enumerate(order)}
    assert {(r.query_id, r.vec_id, r["rank"]) for r in found} == expected


def test_vectors_without_use_are_left_out(spark):
    schema = "vec_id long, embedding array<float>"
    odd = [(1, [1.0, 0.0]), (2, None), (3, [1.0]), (4, [None, 1.0]), (5, [float("nan"), 1.0])]
    asked = spark.createDataFrame([(9, [1.0, 0.5]), (8, None)], "query_id long, embedding array<float>")
    found = retrieval.vector_top_k(spark.createDataFrame(odd, schema), asked, 3).collect()
    assert [(r.query_id, r.vec_id) for r in found] == [(9, 1)]


def test_vector_search_of_nothing(spark):
    vectors = spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<float>")
    none = spark.createDataFrame([], "query_id long, embedding array<double>")
    assert retrieval.vector_top_k(vectors, none, 3).count() == 0
    asked = spark.createDataFrame([(1, [1.0])], "query_id long, embedding array<double>")
    assert retrieval.vector_top_k(vectors.limit(0), asked, 3).count() == 0


def test_mean_vectors(spark):
    vectors = spark.createDataFrame(
        [(1, [1.0, 2.0], 5), (2, [3.0, 4.0], 5), (3, [7.0, 8.0], 6)],
        "vec_id long, embedding array<float>, label int",
    )
    means = {r.query_id: r.embedding for r in retrieval.mean_vectors(vectors, "label").collect()}
    assert means == {5: [2.0, 3.0], 6: [7.0, 8.0]}


def test_responses(spark):
    def note(name):
        return {"filename": name}

    full = {
        "output_text": "hi",
        "output": [
            {"content": [{"annotations": [note("a.md"), note(""), note("a.md"), {}]}, {}]},
            {"content": None},
            {"content": [{"annotations": [note("b.md")]}]},
        ],
    }
    rows = spark.createDataFrame(
        [(1, json.dumps(full)), (2, "{}"), (3, "broken")], "id long, response string"
    )
    parsed = {r.id: r for r in retrieval.parse_responses(rows).collect()}
    assert (parsed[1].answer, parsed[1].cited) == ("hi", ["a.md", "b.md"])
    assert (parsed[2].answer, parsed[2].cited) == ("(no text)", [])
    assert (parsed[3].answer, parsed[3].cited) == ("(no text)", [])
    log = retrieval.citation_log(rows, "id")
    assert sorted((r.id, r.filename or "") for r in log.collect()) == [
        (1, "a.md"), (1, "b.md"), (2, ""), (3, ""),
    ]
    assert "Exchange" not in log._jdf.queryExecution().executedPlan().toString()
    assert log.select(F.max("id")).first()[0] == 3
