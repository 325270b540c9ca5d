"""Explicit schemas. Nothing in this package infers a schema from data."""

from pyspark.sql import types as T


def _struct(**fields):
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields.items()])


_LONG, _INT, _STR, _BOOL = T.LongType(), T.IntegerType(), T.StringType(), T.BooleanType()

RAW_ARTICLE = _struct(
    id=_LONG, title=_STR, body=_STR, html_url=_STR, updated_at=_STR, locale=_STR, draft=_BOOL
)

# One captured page response. `page_no`, `crawl` and `address` are written by the
# capture; dumps without them get the number from their file name, the crawl from its
# folder. `address` is the page's own, which another one's `next_page` names.
PAGE = _struct(
    articles=T.ArrayType(RAW_ARTICLE), next_page=_STR, page_no=_LONG, crawl=_STR, address=_STR
)

# `(page_no, pos)` is the source order: it decides which of several rows with
# one id is the earlier one.
ARTICLE = _struct(
    id=_LONG,
    title=_STR,
    body_html=_STR,
    html_url=_STR,
    updated_at=_STR,
    locale=_STR,
    page_no=_LONG,
    pos=_INT,
)

# `embedded_hash` is the hash of what was last uploaded under `file_id`.
SNAPSHOT = _struct(
    id=_LONG,
    hash=_STR,
    slug=_STR,
    updated_at=_STR,
    file_id=_STR,
    renderer_version=_STR,
    embedded_hash=_STR,
)

# Interchange form of the snapshot: `{"articles": {"<id>": {...}}}`.
SNAPSHOT_JSON = _struct(
    articles=T.MapType(_STR, _struct(hash=_STR, slug=_STR, updatedAt=_STR, fileId=_STR))
)

CORPUS = _struct(filename=_STR, id=_LONG, hash=_STR, md_text=_STR)

CHUNK = _struct(
    chunk_id=_STR, file_id=_STR, doc_id=_LONG, filename=_STR, url=_STR, chunk_no=_INT, text=_STR
)

SUMMARY = _struct(
    added=_LONG,
    updated=_LONG,
    skipped=_LONG,
    files_embedded=_LONG,
    estimated_chunks=_LONG,
    failures=T.ArrayType(T.MapType(_STR, _STR)),
    mode=_STR,
    store_id=_STR,
)

# Run-log line: the base keys, then the summary's.
LOG = T.StructType(
    [T.StructField(n, _STR, True) for n in ("level", "logger", "message")] + SUMMARY.fields
)

RESPONSE = _struct(
    output_text=_STR,
    output=T.ArrayType(
        _struct(content=T.ArrayType(_struct(annotations=T.ArrayType(_struct(filename=_STR)))))
    ),
)

CHECK = _struct(name=_STR, required=_BOOL, ok=_BOOL, message=_STR)
