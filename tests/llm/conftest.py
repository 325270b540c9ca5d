import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, n_tokens string,"
    " n_bytes int, ids string, key string, row string, pos int, label string, part int,"
    " spans string, n_lines int, component_id string, score string, first_doc string"
)

LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))
SAME = "one two three four five six seven eight nine ten"

ODD = [
    (1, ""),
    (2, None),
    (3, LONG),
    (4, SAME),
    (5, SAME),
    (5, SAME),
    (6, " \t\n "),
    (7, "short text"),
    (8, "SHORT text"),
    (9, "x" * 5000),
    (10, "Grüße aus Köln, 日本語 и <|endoftext|> 😀 a\x1cb"),
    (None, SAME + " eleven"),
]


@pytest.fixture
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and columns with clashing names."""
    rows = [
        (i, t, None if i == 7 else "en", "s", len(t) if t else None)
        + ("c", 1, "c", "c", "c", 1, "c", 1, "c", 1, "c", "c", "c")
        for i, t in ODD
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def none(odd):
    """The same columns without rows."""
    return odd.limit(0)
