"""The registered queries as SQL for another engine, to check results against.

Common inputs are views written as CTEs; each query lists those it needs.
"""

from __future__ import annotations

from tidemark.functions.text import JS_WHITESPACE
from tidemark.plans.inputs import HINTED, ORDERED, REFERENCES, TABLE


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _replace_all(text: str, pattern: str, replacement: str) -> str:
    target = replacement.replace("$", "\\")
    return f"regexp_replace({text}, {_literal(pattern)}, {_literal(target)}, 'g')"


def _trim(text: str) -> str:
    return f"trim({text}, {_literal(JS_WHITESPACE)})"


# The dialect's rules, written for this engine on their own.
_DROPPED = "nav script style noscript iframe form header footer".split()
_HINTS = "nav|breadcrumb|share|social|advert|ad-|cookie|subscribe"
#: Elements that carry a class in the given and planted markup.
_CLASSED = "div section li".split()
_ENTITIES = (
    ("&eacute;", "é"), ("&#8217;", "’"), ("&#x2014;", "—"), ("&copy;", "©"), ("&#150;", "–"),
    ("&middot;", "·"), ("&#0;", "�"), ("&#128512;", "😀"),
    ("&nbsp;", " "), ("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"),
)


def _strip(text: str) -> str:
    pattern = "(?is)" + "|".join(rf"<{t}\b[^>]*>.*?</{t}\s*>" for t in _DROPPED)
    return _replace_all(f"coalesce({text}, '')", pattern, "")


def _strip_hints(text: str) -> str:
    for tag in _CLASSED:
        for quote in ('"', "'", ""):
            inner = f"[^{quote}>]*" if quote else "[^ \"'>]*"
            value = f"{quote}{inner}(?:{_HINTS}){inner}{quote}"
            text = _replace_all(text, rf"(?is)<{tag}(?: [^>]*)? class={value}[^>]*>.*?</{tag}>", "")
    return text


def _flat(text: str) -> str:
    """Markdown of the markup that the pages hold; the planted blocks by name."""
    ordered = "\n\n\n1.  first of **two**\n2.  second\n\n"
    text = f"replace({text}, {_literal(ORDERED)}, {_literal(ordered)})"
    text = f"replace({text}, {_literal(TABLE)}, chr(10) || chr(10) || chr(1) || chr(10) || chr(10))"
    text = _replace_all(text, "(?s)<!--.*?-->", "")
    for level in range(1, 7):
        mark = "\n\n" + "#" * level + " $1\n\n"
        text = _replace_all(text, rf"(?is)<h{level}\b[^>]*>(.*?)</h{level}>", mark)
    text = _replace_all(text, '(?is)<a\\b[^>]* href="([^"]*)"[^>]*>(.*?)</a>', "[$2]($1)")
    text = _replace_all(text, "(?is)<b>([^<]*)</b>", "**$1**")
    text = _replace_all(text, "(?i)<br */?>", "  \n")
    text = _replace_all(text, "(?is)<li\\b[^>]*>(.*?)</li>", "\n*   $1")
    text = _replace_all(text, r"(?i)</?(?:p|ul)\b[^>]*>", "\n\n")
    text = _replace_all(text, "<[^>]+>", "")
    for entity, char in _ENTITIES:
        text = f"replace({text}, {_literal(entity)}, {_literal(char)})"
    return f"replace({text}, chr(1), {_literal(TABLE)})"


def _tidy(text: str) -> str:
    return _replace_all(_trim(text), "\n{3,}", "\n\n")


def _slug(title: str) -> str:
    cut = f"substr(trim({_replace_all(f'lower({title})', '[^a-z0-9]+', '-')}, '-'), 1, 60)"
    return f"coalesce(nullif({cut}, ''), 'untitled')"


def _estimate(units: str, max_tokens: int = 800, overlap: int = 400) -> str:
    tokens, stride = f"greatest(1, {units} // 4)", max(1, max_tokens - overlap)
    return (
        f"CAST(CASE WHEN {tokens} <= {max_tokens} THEN 1 "
        f"ELSE greatest(1, ceil(({tokens} - {overlap}) / {stride}.0)) END AS BIGINT)"
    )


def _documents(source: str) -> str:
    """Rendered documents of a relation of articles."""
    body = _tidy(_flat(_strip_hints(_strip("body_html"))))
    return f"""
    SELECT id, page_no, pos, slug, slug || '.md' AS filename, updated_at, html_url AS url, md_text,
           sha256(md_text) AS hash, {_estimate("length(md_text)")} AS est_chunks
    FROM (SELECT *, '# ' || title || E'\\n\\nArticle URL: ' || html_url || E'\\nArticle ID: ' || id
                    || E'\\n\\n' || body || E'\\n' AS md_text
          FROM (SELECT *, id || '-' || {_slug("title")} AS slug, {body} AS body FROM {source}))"""


_TEXT_KEY = "sha256(text) AS text_hash, CAST(length(text) AS INTEGER) AS n_chars"
_SECRET = "sk-(proj-)?[A-Za-z0-9_-]{20,}"
_PLACEHOLDER = "your|xxx|example|changeme|placeholder"
_WORDS = r"regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+')"


def _chunks(source: str, key: str, max_tokens: int = 800, overlap: int = 400) -> str:
    """Chunks (key, chunk_no, text) of a relation with `key, md_text`."""
    size, step = max_tokens * 4, (max_tokens - overlap) * 4
    return f"""
    SELECT {key}, CAST(i AS INTEGER) AS chunk_no,
           CASE WHEN i < n - 1 THEN substr(md_text, i * {step} + 1, {size})
                ELSE substr(md_text, i * {step} + 1) END AS text
    FROM (SELECT *, unnest(range(n)) AS i
          FROM (SELECT *, {_estimate("length(md_text)", max_tokens, overlap)} AS n FROM {source}))"""


def _chunk_rows(source: str) -> str:
    return f"""
    SELECT file_id || '#' || chunk_no AS chunk_id, file_id, id AS doc_id, filename, url, chunk_no, text
    FROM ({_chunks(source, "id, file_id, filename, url")})"""


def _scores(items: str) -> str:
    """tf-idf scores of a relation with `doc_id, item_id, text`."""
    return f"""
    bags AS (SELECT doc_id, item_id, term, count(*) AS tf
             FROM (SELECT doc_id, item_id, unnest({_WORDS}) AS term FROM {items})
             WHERE term <> '' GROUP BY ALL),
    asked AS (SELECT DISTINCT question_id, term
              FROM (SELECT item_id AS question_id, unnest({_WORDS}) AS term FROM benchmark)
              WHERE term <> ''),
    weights AS (SELECT term, ln(((SELECT count(*) FROM {items}) + 1) / CAST(count(*) + 1 AS DOUBLE)) AS idf
                FROM bags GROUP BY term),
    scores AS (SELECT question_id, doc_id, item_id, round(sum(tf * idf), 6) AS score
               FROM bags JOIN weights USING (term) JOIN asked USING (term)
               WHERE idf > 0 GROUP BY ALL)"""


# name -> (inputs it reads, text)
_VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "articles": (
        (),
        f"""SELECT page_id AS id, {_trim("regexp_extract(html, '<title>(.*?)</title>', 1)")} AS title,
                   html AS body_html, url AS html_url, '' AS updated_at,
                   regexp_extract(html, '<html lang="([a-z]+)"', 1) AS locale,
                   page_id // 100 AS page_no, CAST(page_id % 100 AS INTEGER) AS pos
            FROM pages""",
    ),
    "raw_articles": (
        ("articles",),
        """SELECT id, CASE WHEN id % 8 <> 0 THEN chr(160) || ' ' || title || ' ' || chr(9) END AS title,
                  CASE WHEN id % 6 <> 0 THEN body_html END AS body,
                  CASE WHEN id % 12 <> 0 THEN html_url END AS html_url,
                  CASE WHEN id % 5 <> 0 THEN '2024-01-01T00:00:00Z' END AS updated_at,
                  CASE WHEN locale <> 'fr' THEN locale END AS locale,
                  CASE WHEN id % 5 <> 0 THEN id % 11 = 0 END AS draft, page_no, pos
           FROM articles""",
    ),
    "normal": (
        ("raw_articles",),
        f"""SELECT id, {_trim("coalesce(title, '')")} AS title, coalesce(body, '') AS body_html,
                   coalesce(html_url, '') AS html_url, coalesce(updated_at, '') AS updated_at,
                   coalesce(locale, 'en-us') AS locale, draft, page_no + 1 AS page_no, pos
            FROM raw_articles""",
    ),
    "hinted": (
        (),
        f"""SELECT page_id, replace(
                     replace(html, 'class="ad"', CASE WHEN page_id % 2 = 0 THEN {_literal("class='ad-slot'")}
                                                      ELSE 'class="x ad-slot"' END),
                     '</article>',
                     CASE WHEN page_id % 3 = 0 THEN {_literal(ORDERED)} ELSE '' END
                     || CASE WHEN page_id % 4 = 0 THEN {_literal(TABLE)} ELSE '' END
                     || CASE WHEN page_id % 5 = 0 THEN {_literal(HINTED)} ELSE '' END
                     || CASE WHEN page_id % 2 = 0 THEN {_literal(REFERENCES)} ELSE '' END
                     || '</article>') AS html
            FROM pages""",
    ),
    "docs": (("articles",), _documents("articles")),
    # pages of unnumbered dumps that are in a chain
    "numbered": ((), "SELECT count(DISTINCT page_id // 10) AS n FROM pages"),
    "later_articles": (
        ("articles",),
        """SELECT * REPLACE (CASE WHEN id % 2 = 0 THEN title || ' (later)' ELSE title END AS title)
           FROM articles""",
    ),
    "repeated_articles": (
        ("articles",),
        """SELECT * FROM articles
           UNION ALL
           SELECT id, CASE WHEN id % 18 = 0 THEN title || ' (again)' ELSE title END, body_html,
                  html_url, updated_at, locale, page_no + 1000000, pos
           FROM articles WHERE id % 9 = 0""",
    ),
    "repeated": (("repeated_articles",), _documents("repeated_articles")),
    "base": (
        ("docs",),
        """SELECT id, CASE WHEN id % 7 = 0 THEN sha256('old' || id) ELSE hash END AS hash, slug,
                  '' AS updated_at, CASE WHEN id % 13 <> 0 THEN 'file_' || id END AS file_id
           FROM (SELECT id, max_by(slug, docs.hash) AS slug, max(hash) AS hash FROM docs
                 WHERE id % 10 <> 0 GROUP BY id)""",
    ),
    "plain": (
        ("docs", "base"),
        """SELECT d.*, b.file_id AS prior_file_id,
                  CASE WHEN b.id IS NULL THEN 'ADDED' WHEN b.hash <> d.hash THEN 'UPDATED'
                       ELSE 'SKIPPED' END AS status
           FROM docs d LEFT JOIN base b ON d.id = b.id""",
    ),
    "classified": (
        ("plain",),
        """SELECT * REPLACE (CASE WHEN status = 'SKIPPED' AND prior_file_id IS NULL THEN 'ADDED'
                                  ELSE status END AS status)
           FROM plain""",
    ),
    "upserted": (
        ("classified", "base"),
        """SELECT id, hash, slug, updated_at, 'new_' || id AS file_id FROM classified
           WHERE status <> 'SKIPPED'
           UNION ALL
           SELECT * FROM base
           WHERE id NOT IN (SELECT id FROM classified WHERE status <> 'SKIPPED')""",
    ),
    "totals": (
        ("classified",),
        """SELECT page_no, count(*) FILTER (status = 'ADDED') AS added,
                  count(*) FILTER (status = 'UPDATED') AS updated,
                  count(*) FILTER (status = 'SKIPPED') AS skipped,
                  CAST(coalesce(sum(est_chunks) FILTER (status <> 'SKIPPED'), 0) AS BIGINT)
                      AS estimated_chunks
           FROM classified GROUP BY page_no""",
    ),
    "files": (
        (),
        """SELECT doc_id AS id, 'file_' || doc_id AS file_id, 'doc-' || doc_id || '.md' AS filename,
                  'https://example.com/docs/' || doc_id AS url, text AS md_text
           FROM documents""",
    ),
    "old_chunks": (
        ("files",),
        _chunk_rows(
            """(SELECT * REPLACE (CASE WHEN id % 7 = 0 THEN 'old ' || md_text ELSE md_text END
                                  AS md_text)
                FROM files WHERE id % 10 <> 0)"""
        ),
    ),
    "new_chunks": (
        ("files",),
        _chunk_rows(
            """(SELECT * REPLACE (file_id || '_new' AS file_id) FROM files
                WHERE id % 10 = 0 OR id % 7 = 0)"""
        ),
    ),
    "keyed": (
        ("files",),
        """SELECT filename, md_text
                  || CASE WHEN id % 50 = 0 THEN ' sk-proj-' || substr(sha256(md_text), 1, 24) ELSE '' END
                  || CASE WHEN id % 70 = 0 THEN ' sk-your-' || substr(sha256(md_text), 1, 24) ELSE '' END
                  AS text
           FROM files""",
    ),
    "matches": (
        ("keyed",),
        f"SELECT filename AS path, unnest(regexp_extract_all(text, '{_SECRET}')) AS secret FROM keyed",
    ),
    "hits": (
        ("matches",),
        f"""SELECT path, path || ': ' || substr(secret, 1, 12) || '...' AS hit FROM matches
            WHERE NOT regexp_matches(lower(secret), '{_PLACEHOLDER}')""",
    ),
    "answers": (
        (),
        """SELECT conv_id, turn, text || repeat(E'\\n* step', CAST(conv_id % 9 AS INTEGER))
                  || CASE WHEN conv_id % 4 = 0 THEN E'\\nArticle URL: https://example.com/' || conv_id
                          WHEN turn % 4 = 0 OR conv_id % 7 = 0 THEN ' [1]' ELSE '' END AS text
           FROM conversations WHERE role = 'assistant'""",
    ),
    "cited": (
        ("answers",),
        """SELECT conv_id || '-' || turn AS response_id,
                  CASE WHEN conv_id % 6 <> 0 AND conv_id % 8 <> 0 AND conv_id % 11 <> 0 THEN text
                       ELSE '(no text)' END AS answer,
                  unnest(CASE WHEN conv_id % 5 = 0 OR conv_id % 8 = 0 OR conv_id % 11 = 0 THEN [NULL]
                              ELSE ['doc-' || conv_id || '.md', 'turn-' || turn || '.md'] END) AS filename
           FROM answers""",
    ),
    "checks": (
        ("files", "hits", "base"),
        """SELECT 0 AS position, 'articles>=30' AS name, true AS required, count(*) >= 30 AS ok,
                  count(*) || ' documents, 30 at least' AS message
           FROM files
           UNION ALL
           SELECT 1, 'no-hardcoded-secrets', true, count(*) = 0,
                  CASE WHEN count(*) = 0 THEN 'no leaked keys'
                       ELSE count(*) || ' leaked keys in ' || count(DISTINCT path) || ' documents' END
           FROM hits
           UNION ALL
           SELECT 2, 'snapshot-valid', false, true,
                  CASE WHEN count(*) = 0 THEN 'no snapshot so far, not checked'
                       ELSE 'all parts parse' END
           FROM base""",
    ),
    "json_lines": (
        ("base",),
        """SELECT '{"articles":{"' || id || '":{"hash":"' || hash || '","slug":"' || slug
                  || '","updatedAt":"' || updated_at || '","fileId":'
                  || coalesce('"' || file_id || '"', 'null') || '}}}' AS value
           FROM base""",
    ),
    "bags_of_docs": (
        (),
        "SELECT doc_id, doc_id AS item_id, text FROM documents",
    ),
    "bags_of_chunks": (
        (),
        f"""SELECT doc_id, chunk_no AS item_id, text
            FROM ({_chunks("(SELECT doc_id, text AS md_text FROM documents)", "doc_id")})""",
    ),
    "topics": (
        (),
        """SELECT label, list(x ORDER BY i) AS mean
           FROM (SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS x
                 FROM (SELECT label, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)
                 GROUP BY label, i)
           GROUP BY label""",
    ),
}


def _sql(views: str, body: str, extra: str = "") -> str:
    """`body` below the CTEs it names and those they are built from."""
    ordered: list[str] = []

    def need(name: str) -> None:
        for other in _VIEWS[name][0]:
            need(other)
        if name not in ordered:
            ordered.append(name)

    for name in views.split():
        need(name)
    ctes = [f"{name} AS ({_VIEWS[name][1]})" for name in ordered] + ([extra] if extra else [])
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + body


def _keyed(source: str, key: str, text: str) -> str:
    return f"SELECT {key}, {_TEXT_KEY} FROM (SELECT {key}, {text} AS text FROM {source})"


_COUNTS = """count(*) FILTER (status = 'ADDED') AS added,
             count(*) FILTER (status = 'UPDATED') AS updated,
             count(*) FILTER (status = 'SKIPPED') AS skipped"""
_CHUNK_SUM = """CAST(coalesce(sum(est_chunks) FILTER (status <> 'SKIPPED'), 0) AS BIGINT)
                AS estimated_chunks"""
_RUN = f"{_COUNTS}, %s AS files_embedded, {_CHUNK_SUM}, '%s' AS mode"
_CITED_PATTERN = r"\[\d+\]"
_BULLET = r"^[ \t\n\v\f\r]*([-*•]|\d+\.)[ \t\n\v\f\r]"
_N_BULLETS = (
    "CAST(len(list_filter(string_split(text, chr(10)), "
    f"lambda line: regexp_matches(line, '{_BULLET}'))) AS INTEGER)"
)
_REPEATED_STATUS = """
    seen AS (SELECT r.*, b.file_id AS prior_file_id, b.id IS NOT NULL AS known, b.hash AS base_hash,
                    lag(r.hash) OVER (PARTITION BY r.id ORDER BY r.page_no, r.pos) AS previous
             FROM repeated r LEFT JOIN base b ON r.id = b.id),
    judged AS (SELECT *, CASE WHEN previous IS NULL AND NOT known THEN 'ADDED'
                              WHEN coalesce(previous, base_hash) <> hash THEN 'UPDATED'
                              ELSE 'SKIPPED' END AS status
               FROM seen)"""
_GLUED = f"""(SELECT filename, text || ' kio' || regexp_extract(text, '{_SECRET}', 0) AS text
              FROM keyed)"""

ORACLES: dict[str, str] = {
    "page_source": _sql(
        "articles",
        """SELECT CASE WHEN n % 2 = 1 THEN 'odd' ELSE 'even' END AS crawl, n AS page_no, n_articles,
                  CASE WHEN n <> top - top % 2 THEN '/articles?after=' || n END AS next_page
           FROM numbers
           UNION ALL SELECT 'odd', max(top) + 1, 0, '/articles?after=end' FROM numbers
           UNION ALL SELECT 'odd', max(top) + 2, 0, NULL FROM numbers""",
        """numbers AS (SELECT page_no + 1 AS n, count(*) AS n_articles, max(page_no + 1) OVER () AS top
                       FROM articles GROUP BY page_no)""",
    ),
    "page_flatten": _sql(
        "raw_articles",
        "SELECT page_no + 1 AS page_no, pos, id, title, html_url, locale, draft FROM raw_articles",
    ),
    "page_articles": _sql(
        "normal",
        f"""SELECT id, title, html_url, updated_at, locale, page_no, {_TEXT_KEY}
            FROM (SELECT *, body_html AS text FROM normal WHERE NOT coalesce(draft, false))""",
    ),
    "page_chain": _sql(
        "normal numbered",
        """SELECT id, title, id // 10 % 3 * (SELECT max(n) + 1 FROM numbered) + id // 30 AS page_no,
                  CAST(row_number() OVER (PARTITION BY id // 10 ORDER BY id) - 1 AS INTEGER) AS pos
           FROM normal QUALIFY NOT coalesce(any_value(draft) OVER (PARTITION BY id), false)""",
    ),
    "chain_limit": """SELECT 'crawl-' || (page_id // 10 % 3) AS crawl, '/articles?after=' || (page_id // 10) AS address,
                             count(*) AS n_articles
                      FROM pages WHERE page_id // 30 < 3 GROUP BY page_id // 10""",
    "corpus_sink": _sql("docs", "SELECT filename, id, hash FROM docs"),
    "corpus_source": _sql(
        "docs articles", "SELECT id, title, html_url AS url, hash FROM docs JOIN articles USING (id)"
    ),
    "snapshot_source": _sql("base", "SELECT id, hash, slug, updated_at, file_id FROM base"),
    "snapshot_sink": _sql("upserted", "SELECT id, hash, slug, file_id FROM upserted"),
    "run_log_sink": _sql(
        "totals",
        """SELECT '{"level":"INFO","logger":"tidemark","message":"pipeline complete","page_no":'
                  || page_no || ',"added":' || added || ',"updated":' || updated
                  || ',"skipped":' || skipped || '}' AS value
           FROM totals""",
    ),
    "run_log_source": _sql(
        "totals",
        """SELECT 'INFO' AS level, 'pipeline complete' AS message, added, updated, skipped,
                  estimated_chunks
           FROM totals""",
    ),
    "chunk_replace": _sql(
        "old_chunks new_chunks",
        f"""SELECT chunk_id, file_id, doc_id, chunk_no, {_TEXT_KEY} FROM (
              SELECT * FROM old_chunks WHERE doc_id NOT IN (SELECT doc_id FROM new_chunks)
              UNION ALL SELECT * FROM new_chunks)""",
    ),
    "deleted_chunks": _sql(
        "old_chunks new_chunks",
        """SELECT chunk_id, doc_id, chunk_no FROM old_chunks
           WHERE doc_id IN (SELECT doc_id FROM new_chunks)""",
    ),
    "live_chunk_table": _sql(
        "old_chunks new_chunks",
        f"""SELECT chunk_id, file_id, doc_id, chunk_no, {_TEXT_KEY} FROM (
              SELECT * FROM old_chunks WHERE doc_id NOT IN (SELECT doc_id FROM new_chunks)
              UNION ALL SELECT * FROM new_chunks)""",
    ),
    "normalise_articles": _sql(
        "normal",
        f"""SELECT id, title, html_url, updated_at, locale, {_TEXT_KEY}
            FROM (SELECT *, body_html AS text FROM normal)""",
    ),
    "locale_default": _sql(
        "raw_articles",
        "SELECT coalesce(locale, 'de-at') AS locale, count(*) AS n FROM raw_articles GROUP BY 1",
    ),
    "slugify": _sql("articles", f"SELECT id, {_slug('title')} AS slug FROM articles"),
    "document_key": _sql("docs", "SELECT id, slug, filename FROM docs"),
    "strip_elements": _keyed("pages", "page_id", _strip("html")),
    "strip_class_hints": _sql("hinted", _keyed("hinted", "page_id", _strip_hints("html"))),
    "markdown_flat": _sql(
        "hinted", _keyed("hinted", "page_id", _flat(_strip_hints(_strip("html"))))
    ),
    "nested_markup": f"""
        WITH plain AS (
            SELECT page_id, 't ' || trim(regexp_replace(html, '(<[^>]*>|&|[ \\t\\r\\n])+', ' ', 'g')) AS own
            FROM pages),
        lines AS (
            SELECT page_id, [
                '## Page ' || page_id, '', '*   one ' || own, '    3.  x', '        *   deep', '    4.  y',
                '*   two', '*   three', '', '> ' || own, '> ', '> *   q', '', '*   kept', '', 'end'
            ] AS line FROM plain)
        SELECT page_id, {_TEXT_KEY} FROM (SELECT page_id, array_to_string(line, chr(10)) AS text FROM lines)""",
    "markdown_links": _keyed("pages", "page_id", _tidy(_flat("html"))),
    "trim_body": _keyed(
        "documents",
        "doc_id",
        _trim(
            "chr(65279) || chr(10) || ' ' || chr(160) || chr(9) || text"
            " || chr(12288) || ' ' || chr(13) || chr(10)"
        ),
    ),
    "collapse_blank_lines": _keyed(
        "documents", "doc_id", _tidy("replace(text, chr(10), repeat(chr(10), 4))")
    ),
    "compose_document": _sql("docs", _keyed("docs", "id", "md_text")),
    "parse_header": _sql("articles", "SELECT title, html_url AS url, id FROM articles"),
    "content_hash": "SELECT doc_id, sha256(text) AS hash FROM documents",
    "token_estimate": """SELECT doc_id, length(text) AS units, greatest(1, length(text) // 4) AS tokens
                         FROM documents""",
    "chunk_estimate": f"""SELECT doc_id, {_estimate("length(text)")} AS n_default,
                                 {_estimate("length(text)", 1000, 0)} AS n_no_overlap,
                                 {_estimate("length(text)", 100, 100)} AS n_stride_one
                          FROM documents""",
    "base_url": """SELECT page_id, rtrim(CASE WHEN starts_with(given, 'http') THEN given
                                              ELSE 'https://' || given END, '/') AS url
                   FROM (SELECT page_id, CASE WHEN page_id % 2 = 0
                                              THEN regexp_extract(url, '^https?://([^/?#]+)', 1) || '//'
                                              ELSE url END AS given
                         FROM pages)""",
    "run_mode": """SELECT dry_run, scrape_only, CASE WHEN dry_run THEN 'dry_run'
                          WHEN scrape_only THEN 'scrape_only' ELSE 'upload' END AS mode, count(*) AS n
                   FROM (SELECT page_id % 2 = 0 AS dry_run, page_id % 3 = 0 AS scrape_only FROM pages)
                   GROUP BY ALL""",
    "drop_drafts": _sql(
        "raw_articles", "SELECT id, draft FROM raw_articles WHERE draft IS NULL OR NOT draft"
    ),
    "changed_set": _sql(
        "classified", "SELECT id, status, filename FROM classified WHERE status <> 'SKIPPED'"
    ),
    "needs_embedding": _sql(
        "plain",
        """SELECT id, status, 'ADDED' AS upload_status FROM plain
           WHERE status = 'SKIPPED' AND prior_file_id IS NULL""",
    ),
    "secret_matches": _sql("matches", "SELECT * FROM matches"),
    "placeholder_exclusion": _sql(
        "matches",
        f"SELECT * FROM matches WHERE NOT regexp_matches(lower(secret), '{_PLACEHOLDER}')",
    ),
    "redacted_secrets": _sql("hits", "SELECT * FROM hits"),
    "strict_secret_matches": _sql(
        "keyed",
        f"""SELECT filename AS path, substr(found, strpos(found, 'sk-')) AS secret
            FROM (SELECT filename,
                         unnest(regexp_extract_all(text, '(?:^|[^A-Za-z0-9]){_SECRET}')) AS found
                  FROM {_GLUED})""",
    ),
    "cited_answers": _sql(
        "answers",
        f"""SELECT conv_id, turn FROM answers
            WHERE contains(text, 'Article URL:') OR regexp_matches(text, '{_CITED_PATTERN}')""",
    ),
    "answered_turns": """SELECT conv_id, turn, contains(text, 'die') AND contains(text, 'der')
                                AND length(text) + 2 * 60 * (conv_id % 5) > 500 AS answered
                         FROM conversations""",
    "bullet_cap": _sql(
        "answers",
        f"""SELECT conv_id, turn, {_N_BULLETS} AS n_bullets, {_N_BULLETS} > 5 AS over_cap
            FROM answers""",
    ),
    "page_limit": """SELECT page_id // 100 + 1 AS page_no, count(*) AS n_articles, max(page_id) AS last_id
                     FROM pages WHERE page_id // 100 < 2 GROUP BY 1""",
    "delta_classify": _sql("classified", "SELECT id, status FROM classified"),
    "delta_classify_hot": _sql(
        "docs base",
        """SELECT d.id, page_no, pos, b.file_id AS prior_file_id,
                  CASE WHEN b.id IS NULL THEN 'ADDED' WHEN b.hash <> d.hash THEN 'UPDATED'
                       WHEN b.file_id IS NULL THEN 'ADDED' ELSE 'SKIPPED' END AS status
           FROM (SELECT * REPLACE (CASE WHEN id % 3 = 0 THEN 1 ELSE id END AS id) FROM docs) d
           LEFT JOIN base b ON d.id = b.id""",
    ),
    "prior_file_id": _sql(
        "classified",
        """SELECT id, prior_file_id, CASE WHEN status = 'UPDATED' THEN prior_file_id END AS old_file_id
           FROM classified""",
    ),
    "snapshot_upsert": _sql("upserted", "SELECT * FROM upserted"),
    "align_results": _sql(
        "classified",
        """SELECT id, slug, 'new_' || reverse(filename) AS file_id FROM classified
           WHERE status <> 'SKIPPED'""",
    ),
    "repeated_ids_sequential": _sql(
        "repeated base",
        "SELECT id, page_no, pos, status, prior_file_id FROM judged",
        _REPEATED_STATUS,
    ),
    "repeated_ids_upload": _sql(
        "repeated base",
        """SELECT id, hash, slug, file_id FROM base WHERE id NOT IN (SELECT id FROM last)
           UNION ALL SELECT id, hash, slug, 'new_' || id FROM last""",
        """last AS (SELECT r.* FROM repeated r LEFT JOIN base b ON r.id = b.id
                    WHERE b.id IS NULL OR b.hash <> r.hash OR b.file_id IS NULL
                    QUALIFY row_number() OVER (PARTITION BY r.id ORDER BY page_no DESC, pos DESC) = 1)""",
    ),
    "removed_documents": _sql("base", "SELECT id, file_id FROM base WHERE id % 3 = 0"),
    "status_counts": _sql("classified", f"SELECT {_COUNTS} FROM classified"),
    "estimated_chunks": _sql("plain", f"SELECT {_CHUNK_SUM} FROM plain"),
    "delta_summary": _sql("classified", f"SELECT {_COUNTS}, {_CHUNK_SUM} FROM classified"),
    "files_embedded": _sql(
        "classified",
        """SELECT count(*) FILTER (id % 4 <> 0) AS files_embedded FROM classified
           WHERE status <> 'SKIPPED'""",
    ),
    "failure_collection": _sql(
        "totals",
        """SELECT added, CASE WHEN page_no % 2 = 0 THEN 'Error: page ' || page_no ELSE '' END AS errors,
                  page_no % 2 = 0 AS failed
           FROM totals""",
    ),
    "run_summary": _sql(
        "totals",
        """SELECT added, updated, skipped,
                  CASE WHEN page_no % 2 = 0 THEN 0 ELSE added + updated END AS files_embedded,
                  estimated_chunks, CAST(page_no % 2 = 0 AS BIGINT) AS n_failures, 'upload' AS mode,
                  'vs_test' AS store_id
           FROM totals""",
    ),
    "corpus_count": "SELECT count(*) AS n_documents FROM documents",
    "secret_rollup": _sql(
        "hits",
        """SELECT path, count(*) AS n_hits, string_agg(hit, '; ' ORDER BY hit) AS hits
           FROM hits GROUP BY path""",
    ),
    "snapshot_validity": _sql(
        "json_lines",
        """SELECT json_valid(CASE WHEN substr(sha256(value), 1, 1) = '0'
                                  THEN substr(value, 1, length(value) - 1) ELSE value END) AS valid,
                  count(*) AS n
           FROM json_lines GROUP BY 1""",
    ),
    "minimum_corpus": """SELECT 'articles>=30' AS name, true AS required, count(*) >= 30 AS ok,
                                count(*) || ' documents, 30 at least' AS message
                         FROM documents""",
    "gate_checks": _sql("checks", "SELECT name, required, ok, message FROM checks"),
    "gate_verdict": _sql(
        "checks",
        """SELECT count(*) AS n_checks, count(*) FILTER (required AND NOT ok) AS n_unmet,
                  count(*) FILTER (required AND NOT ok) = 0 AS passed
           FROM checks""",
    ),
    "gate_summary": _sql(
        "checks files",
        """SELECT '[gate] ' || CASE WHEN count(*) FILTER (required AND NOT ok) = 0 THEN 'PASS'
                    ELSE 'FAIL (' || count(*) FILTER (required AND NOT ok) || ' unmet)' END
                  || ' | articles=' || (SELECT count(*) FROM files) || ' | '
                  || string_agg(name || '=' || CASE WHEN ok THEN 'ok' ELSE 'x' END, ', '
                                ORDER BY position) FILTER (required) AS line
           FROM checks""",
    ),
    "gate_json": _sql(
        "checks",
        """SELECT '{"passed":' || (count(*) FILTER (required AND NOT ok) = 0) || ',"checks":['
                  || string_agg('{"name":"' || name || '","required":' || required || ',"ok":' || ok
                                || ',"message":"' || message || '"}', ',' ORDER BY position)
                  || ']}' AS report
           FROM checks""",
    ),
    "split_chunks": _sql(
        "files",
        f"SELECT id, chunk_no, {_TEXT_KEY} FROM ({_chunks('files', 'id')})",
    ),
    "split_chunks_small": _sql(
        "files",
        f"SELECT id, chunk_no, {_TEXT_KEY} FROM ({_chunks('files', 'id', 100, 30)})",
    ),
    "chunk_metadata": _sql(
        "files",
        f"SELECT chunk_id, file_id, doc_id, filename, url, chunk_no FROM ({_chunk_rows('files')})",
    ),
    "vector_top_k": _sql(
        "topics",
        """SELECT query_id, vec_id, score, CAST(rank AS INTEGER) AS rank FROM (
             SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
             FROM (SELECT CAST(label AS BIGINT) AS query_id, vec_id,
                          round(list_cosine_similarity(vector, mean), 6) AS score
                   FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS vector FROM embeddings), topics))
           WHERE rank <= 5""",
    ),
    "vector_top_k_many": """
        SELECT query_id, vec_id, score, CAST(rank AS INTEGER) AS rank FROM (
          SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
          FROM (SELECT q.vec_id AS query_id, v.vec_id,
                       round(list_cosine_similarity(CAST(v.embedding AS DOUBLE[]),
                                                    CAST(q.embedding AS DOUBLE[])), 6) AS score
                FROM embeddings v, (SELECT * FROM embeddings WHERE label = 0) q))
        WHERE rank <= 5""",
    "lexical_top_k": _sql(
        "bags_of_docs",
        """SELECT question_id, doc_id, score, CAST(rank AS INTEGER) AS rank FROM (
             SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, item_id) AS rank
             FROM scores)
           WHERE rank <= 3""",
        _scores("bags_of_docs"),
    ),
    "best_sources": _sql(
        "bags_of_chunks",
        "SELECT question_id, doc_id, chunk_no, score, CAST(rank AS INTEGER) AS rank FROM sources",
        _scores("bags_of_chunks")
        + """,
    sources AS (
      SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, doc_id) AS rank
        FROM (SELECT question_id, doc_id, item_id AS chunk_no, score FROM scores
              QUALIFY row_number() OVER (PARTITION BY question_id, doc_id
                                         ORDER BY score DESC, item_id) = 1))
      WHERE rank <= 3)""",
    ),
    "cited_context": _sql(
        "bags_of_chunks",
        """SELECT b.item_id AS question_id, coalesce(urls, '') AS urls
           FROM benchmark b LEFT JOIN (
             SELECT question_id, string_agg('https://example.com/docs/' || doc_id, ' ' ORDER BY rank) AS urls
             FROM (SELECT *, row_number() OVER (PARTITION BY question_id
                                                ORDER BY score DESC, doc_id) AS rank
                   FROM (SELECT question_id, doc_id, max(score) AS score FROM scores GROUP BY 1, 2))
             WHERE rank <= 3 GROUP BY question_id) s ON b.item_id = s.question_id""",
        _scores("bags_of_chunks"),
    ),
    "citation_log": _sql(
        "cited", "SELECT response_id, filename, sha256(answer) AS answer_hash FROM cited"
    ),
    "cited_files": _sql(
        "cited", "SELECT filename, count(*) AS n_responses FROM cited WHERE filename IS NOT NULL GROUP BY filename"
    ),
    "sync_dry_run": _sql(
        "plain", f"SELECT {_RUN % ('CAST(0 AS BIGINT)', 'dry_run')} FROM plain"
    ),
    "sync_upload": _sql(
        "classified",
        "SELECT " + _RUN % ("count(*) FILTER (status <> 'SKIPPED')", "upload") + " FROM classified",
    ),
    "sync_upload_chunks": _sql(
        "classified",
        f"""SELECT file_id, id AS doc_id, chunk_no, {_TEXT_KEY} FROM ({_chunks(
            "(SELECT *, 'file_1_' || id AS file_id FROM classified WHERE status <> 'SKIPPED')",
            "id, file_id",
        )})""",
    ),
    "sync_scrape_only": _sql(
        "repeated base",
        """SELECT l.id, l.hash, l.slug, b.file_id FROM last l LEFT JOIN base b ON l.id = b.id""",
        """last AS (SELECT * FROM repeated
                    QUALIFY row_number() OVER (PARTITION BY id ORDER BY page_no DESC, pos DESC) = 1)""",
    ),
    "sync_custom_sink": _sql(
        "classified base",
        """SELECT id, 'ext_' || slug AS file_id FROM classified WHERE status <> 'SKIPPED'
           UNION ALL
           SELECT id, file_id FROM base
           WHERE id NOT IN (SELECT id FROM classified WHERE status <> 'SKIPPED')""",
    ),
    "sync_lost_hand_over": _sql(
        "classified base",
        """SELECT id, 'ext_' || slug AS file_id, count(*) AS n_stored
           FROM classified WHERE status <> 'SKIPPED' GROUP BY id, slug
           UNION ALL
           SELECT id, file_id, NULL FROM base
           WHERE id NOT IN (SELECT id FROM classified WHERE status <> 'SKIPPED')""",
    ),
    "incremental_over_snapshot": _sql(
        "docs",
        """SELECT id, hash, 'file_' || CASE WHEN id % 3 = 0 THEN 1 WHEN id % 2 = 0 THEN 2 ELSE 0 END
                             || '_' || id AS file_id, n_chunks
           FROM docs JOIN pieces USING (id)""",
        f"pieces AS (SELECT id, count(*) AS n_chunks FROM ({_chunks('docs', 'id')}) GROUP BY id)",
    ),
    "incremental_after_lost_batch": _sql(
        "docs",
        """SELECT id, hash, 'file_' || CASE WHEN id % 2 = 0 THEN 1 ELSE 0 END || '_' || id AS file_id,
                  n_chunks
           FROM docs JOIN pieces USING (id) WHERE id % 2 = 0 OR id % 3 <> 0""",
        f"pieces AS (SELECT id, count(*) AS n_chunks FROM ({_chunks('docs', 'id')}) GROUP BY id)",
    ),
    "incremental_two_crawls": _sql(
        "later_articles",
        "SELECT id, hash, slug, 'file_0_' || id AS file_id FROM crawled",
        f"crawled AS ({_documents('later_articles')})",
    ),
    "incremental_sync": _sql(
        "normal",
        "SELECT id, hash, slug, 'file_0_' || id AS file_id FROM streamed",
        f"streamed AS ({_documents('(SELECT * FROM normal WHERE NOT coalesce(draft, false))')})",
    ),
}
