"""DuckDB SQL with the same result, for the operators that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

#: Operator 8 over `source` (a table with doc_id and text), as CTEs: recurring lines,
#: plain and guarded, then the template of each node (number of fields, two leading fields).
LINE_TEMPLATES = r"""
lines AS (
  SELECT doc_id, text, generate_subscripts(string_split(text, chr(10)), 1) AS pos,
         unnest(string_split(text, chr(10))) AS line
  FROM {source}
),
single AS (
  SELECT *, trim(regexp_replace(line, '[\t-\r\x1c- \x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]+', ' ', 'g')) AS one
  FROM lines
),
masked AS (
  SELECT *, regexp_replace(one, '[^ ]*[0-9@][^ ]*', '<*>', 'g') AS template FROM single WHERE one <> ''
),
measured AS (
  SELECT *, len(string_split(template, ' ')) AS fields,
         len(list_filter(string_split(template, ' '), lambda w: w = '<*>')) AS variable
  FROM masked
),
keyed AS (
  SELECT *, CASE WHEN variable = fields THEN one ELSE template END AS key FROM measured
),
parsed AS (
  SELECT *, array_to_string(string_split(key, ' ')[1:2], ' ') AS lead,
         (fields < 4 AND length(key) < 20) OR (variable < fields AND 2 * variable > fields) AS guarded
  FROM keyed
),
recurring AS (
  SELECT fields, lead, key, min(doc_id) AS first_doc,
         NOT guarded OR count(DISTINCT doc_id) >= 10 AS strong
  FROM parsed GROUP BY fields, lead, key, guarded HAVING count(DISTINCT doc_id) >= 2
),
inner_lines AS (
  SELECT * FROM parsed WHERE fields >= 4 AND variable < fields
),
open_nodes AS (
  SELECT fields, lead FROM inner_lines
  GROUP BY fields, lead HAVING count(DISTINCT key) >= 2 AND count(DISTINCT doc_id) >= 10
),
leaves AS (
  SELECT DISTINCT fields, lead, key FROM inner_lines SEMI JOIN open_nodes USING (fields, lead)
),
words AS (
  SELECT fields, lead, generate_subscripts(string_split(key, ' '), 1) AS place,
         unnest(string_split(key, ' ')) AS word
  FROM leaves
),
counted AS (
  SELECT fields, lead, place, word, count(*) AS n,
         sum(count(*)) OVER (PARTITION BY fields, lead, place) AS of_all
  FROM words GROUP BY fields, lead, place, word
),
constant AS (
  SELECT fields, lead, place, word FROM counted WHERE n >= 0.9::DOUBLE * of_all AND word <> '<*>'
),
node_templates AS (
  SELECT fields, lead, list({{'place': place, 'word': word}}) AS constant
  FROM constant GROUP BY fields, lead HAVING count(*) >= 0.6::DOUBLE * fields
),
matched AS (
  SELECT DISTINCT l.doc_id, l.text, l.pos, fields, lead
  FROM inner_lines l JOIN node_templates t USING (fields, lead)
  WHERE len(list_filter(t.constant, lambda c: string_split(l.key, ' ')[c.place] = c.word)) = len(t.constant)
),
node_first AS (
  SELECT fields, lead, min(doc_id) AS first_doc FROM matched
  GROUP BY fields, lead HAVING count(DISTINCT doc_id) >= 10
),
places AS (
  SELECT p.doc_id, p.text, p.pos, r.strong FROM parsed p JOIN recurring r USING (fields, lead, key)
  WHERE p.doc_id > r.first_doc
  UNION ALL
  SELECT m.doc_id, m.text, m.pos, true FROM matched m JOIN node_first f USING (fields, lead)
  WHERE m.doc_id > f.first_doc
),
marked AS (
  SELECT doc_id, text, pos, bool_or(strong) AS strong FROM places GROUP BY doc_id, text, pos
),
judged AS (
  SELECT DISTINCT s.doc_id, s.text, s.pos, s.line, m.pos IS NOT NULL AS found,
         coalesce(m.strong, false) AS strong, s.one = '' AS blank
  FROM single s LEFT JOIN marked m ON m.doc_id = s.doc_id AND m.text = s.text AND m.pos = s.pos
),
husks AS (
  SELECT doc_id, text, bool_or(strong) AND bool_and(found OR blank) AS husk
  FROM judged GROUP BY doc_id, text
),
kept AS (
  SELECT doc_id, j.text AS whole, count(*) AS n_lines,
         count(*) FILTER (strong OR (husk AND found)) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY pos)
                  FILTER (NOT (strong OR (husk AND found))), '') AS text
  FROM judged j JOIN husks h USING (doc_id, text) GROUP BY doc_id, j.text
)
"""

ORACLES["op8_line_templates"] = f"""
WITH {LINE_TEMPLATES.format(source="documents")}
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped,
       coalesce(length(k.text), 0)::BIGINT AS n_chars, md5(coalesce(k.text, '')) AS text_md5
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id AND k.whole = d.text
"""

#: Levels of a manifest's tree that the SQL below spells out: enough for 8**8 leaves.
MERKLE_LEVELS = 8


def _merkle(name: str, lowest: str) -> str:
    """CTEs of a tree over `lowest` (tree, pos, h): at each level k the nodes, with the
    digests of their run; `{name}_root` (tree, h); `{name}_path` with, for each lowest
    node, its runs and places level by level. A level with one node is left alone."""
    ctes = [f"{name}0 AS (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM ({lowest}))"]
    for k in range(MERKLE_LEVELS):
        ctes.append(f"""
{name}_runs{k} AS (
  SELECT tree, pos // 8 AS pos, n, list(h ORDER BY pos) AS run FROM {name}{k} GROUP BY tree, pos // 8, n
),
{name}{k + 1} AS (
  SELECT tree, pos, CASE WHEN n = 1 THEN run[1] ELSE sha256(array_to_string(run, '')) END AS h,
         (n + 7) // 8 AS n
  FROM {name}_runs{k}
)""")
    runs = " ".join(
        f"JOIN {name}_runs{k} r{k} ON r{k}.tree = l.tree AND r{k}.pos = l.pos // {8 ** (k + 1)}"
        for k in range(MERKLE_LEVELS)
    )
    steps = ", ".join(
        f"{{'at': l.pos // {8**k} % 8, 'run': CASE WHEN r{k}.n = 1 THEN NULL ELSE r{k}.run END}}"
        for k in range(MERKLE_LEVELS)
    )
    ctes.append(f"{name}_root AS (SELECT tree, h FROM {name}{MERKLE_LEVELS})")
    ctes.append(
        f"{name}_path AS (SELECT l.tree, l.pos, [{steps}] AS steps FROM {name}0 l {runs})"
    )
    return ",\n".join(ctes)


def _crc32(text: str) -> str:
    """Unsigned crc32 of an ASCII text, byte by byte and bit by bit."""
    bit = "list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, o: xor(x >> 1, (x & 1) * 3988292384))"
    data = f"list_transform(string_split({text}, ''), lambda s: ascii(s)::BIGINT)"
    whole = f"list_reduce(list_prepend(4294967295::BIGINT, {data}), lambda c, b: {bit})"
    return f"xor({whole}, 4294967295::BIGINT)"


def _leaf(text: str) -> str:
    fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(
        f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields
    ) + ")"


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLD = """list_reduce(
    list_prepend({'at': 0::BIGINT, 'run': [coalesce(tampered, leaf)]}, steps),
    lambda x, s: {'at': 0::BIGINT, 'run': [CASE WHEN s.run IS NULL THEN x.run[1] ELSE sha256(array_to_string(
      list_transform(s.run, lambda h, i: CASE WHEN i - 1 = s.at THEN x.run[1] ELSE h END), '')) END]}).run[1]"""

ORACLES["op12_merkle_manifest"] = f"""
WITH rows_ AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS tree, {_leaf("text")} AS leaf,
         CASE WHEN {_crc32("doc_id::VARCHAR")} % 3 = 0
              THEN {_leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} END AS tampered
  FROM documents
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM rows_
),
{_merkle("low", "SELECT tree, pos, leaf AS h FROM placed")},
subroots AS (
  SELECT tree AS name, h, row_number() OVER (ORDER BY tree::BLOB) - 1 AS pos FROM low_root
),
{_merkle("top", "SELECT '' AS tree, pos, h FROM subroots")},
whole AS (
  SELECT p.doc_id, p.leaf, p.tampered, s.h AS subroot, (SELECT h FROM top_root) AS root,
         list_concat(l.steps, t.steps) AS steps
  FROM placed p JOIN low_path l USING (tree, pos) JOIN subroots s ON s.name = p.tree
       JOIN top_path t ON t.pos = s.pos
),
folded AS (
  SELECT doc_id, leaf, subroot, root,
         sha256(array_to_string(flatten(list_transform(steps, lambda s: coalesce(
           list_filter(s.run, lambda h, i: i - 1 <> s.at), []))), '')) AS proof_sha256,
         {_FOLD} AS folded_root
  FROM whole
)
SELECT *, folded_root = root AS verified FROM folded
"""

ORACLES["op13_hard_negatives"] = """
WITH rows_ AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         list_inner_product(a.v, b.v)::BIGINT AS score
  FROM rows_ a JOIN rows_ b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE a.vec_id % 50 = 0
),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score
  FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
       (row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id))::INTEGER AS rank
FROM positives p JOIN scores s
  ON s.anchor_id = p.anchor_id AND NOT s.same
     AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""
