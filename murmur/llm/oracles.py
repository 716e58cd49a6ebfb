"""DuckDB SQL for the rows of the queries, where SQL can express them."""

from murmur.llm.lexical import TERM
from murmur.llm.secrets import BASE, RULES

ORACLES: dict[str, str] = {}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLES["op3_decontaminate"] = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT item_id, least(len(w), 10) AS n, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1),
    lambda i: array_to_string(w[i : i + 9], ' '))) AS win
  FROM b WHERE len(w) > 0),
lengths AS (SELECT DISTINCT n FROM bw),
pos AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
dw AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM pos, lengths WHERE i + n - 1 <= len(w)),
hit AS (SELECT doc_id, item_id, i, dw.n FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
    string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM hit GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLES["op1_line_dedup"] = r"""
WITH l AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
n AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS t FROM l WHERE trim(line, ' ') <> ''),
w AS (
  SELECT doc_id, t, lead(trim(line, ' '), 2) OVER o AS c, trim(line, ' ') AS a,
    lead(trim(line, ' '), 1) OVER o AS b FROM n WINDOW o AS (PARTITION BY doc_id ORDER BY t)),
r AS (
  SELECT doc_id, t, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, t) AS place
  FROM w WHERE c IS NOT NULL),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(t, t + 3)) AS t FROM r WHERE place > 1),
lost AS (SELECT doc_id, i FROM gone JOIN n USING (doc_id, t)),
kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY l.i) AS text, count(*) AS n
  FROM l ANTI JOIN lost USING (doc_id, i) GROUP BY doc_id),
total AS (SELECT doc_id, count(*) AS n_lines FROM l GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_lines - coalesce(n, 0), 0) AS n_removed,
  CASE WHEN d.text IS NOT NULL THEN coalesce(kept.text, '') END AS text
FROM documents d LEFT JOIN total USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

ORACLES["op7_nearest"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_sum(list_transform(
    list_zip(q.e, c.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank
  FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

ORACLES["op12_lexical"] = rf"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, unnest(regexp_extract_all(
    translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term FROM documents),
q AS (
  SELECT item_id, term, count(*) AS q FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term
    FROM benchmark WHERE item_id IS NOT NULL) GROUP BY item_id, term),
tf AS (SELECT r, term, count(*) AS tf FROM t GROUP BY r, term),
size AS (SELECT r, any_value(doc_id) AS doc_id, count(*) AS n FROM t GROUP BY r),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM size),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, total GROUP BY term),
s AS (
  SELECT item_id, r, CAST(sum(q * w * ((1000000000 * tf)
    // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // length)))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN size USING (r), total GROUP BY item_id, r),
ranked AS (
  SELECT item_id, doc_id, score, CAST(row_number() OVER (
    PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
  FROM s JOIN size USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""


def rule_sql(number: int) -> str:
    """Spans of one rule: lengths of what lies between the matches and of the matches."""
    rule = RULES[number]
    pattern = rule.pattern.replace("'", "''")
    return f"""
SELECT doc_id, {number} AS number, unnest(list_transform(range(1, len(m) + 1), lambda i: {{
    'start': list_sum(list_transform(p[1 : i], lambda x: len(x)))
      + coalesce(list_sum(list_transform(m[1 : i - 1], lambda x: len(x))), 0),
    'size': len(m[i]), 'checked': len(g[i])}})) AS s
FROM (SELECT doc_id, regexp_split_to_array(text, '{pattern}') AS p,
    regexp_extract_all(text, '{pattern}', 0) AS m,
    regexp_extract_all(text, '{pattern}', {rule.group}) AS g FROM t)"""


KINDS = ", ".join(f"'{r.kind}'" for r in RULES)
LEAST = ", ".join(str(r.least) for r in RULES)
ORACLES["op10_secrets"] = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
raw AS ({" UNION ALL ".join(rule_sql(i) for i in range(len(RULES)))}),
found AS (
  SELECT doc_id, number, ([{KINDS}])[number + 1] AS kind, s.start AS start,
    ([{KINDS}])[number + 1] || ':' || CAST(s.start AS BIGINT) || ':'
      || CAST(s.start + s.size AS BIGINT) AS span
  FROM raw WHERE s.checked >= ([{LEAST}])[number + 1]),
per AS (
  SELECT doc_id, string_agg(span, ',' ORDER BY start, number) AS spans,
    string_agg(span, ',' ORDER BY start, number) FILTER (number < {len(BASE)}) AS base,
    {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in BASE)}
  FROM found GROUP BY doc_id)
SELECT t.doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in BASE)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN per USING (doc_id)
"""
