"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

OP2 = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS s
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY s) AS group_size,
       row_number() OVER w = 1 AS kept, s AS text_sha256
FROM t
WINDOW w AS (PARTITION BY s ORDER BY n DESC, doc_id NULLS LAST
             ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
"""



# Removal of windows that a smaller doc_id holds: windows, the least doc_id of each, covered words, kept words.
OP4 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, s, array_to_string(w[s:s + 12], ' ') AS g
  FROM d, unnest(range(1, len(w) - 11)) AS t(s)),
hit AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY g) AS least FROM win) WHERE least < doc_id),
gone AS (SELECT DISTINCT doc_id, p FROM hit, unnest(range(s, s + 13)) AS t(p)),
places AS (
  SELECT d.doc_id, q.p, d.w[q.p] AS word, gone.p IS NOT NULL AS removed
  FROM d, unnest(range(1, len(d.w) + 1)) AS q(p) LEFT JOIN gone ON gone.doc_id = d.doc_id AND gone.p = q.p),
sums AS (
  SELECT doc_id, count(*) FILTER (WHERE removed) AS n, string_agg(word, ' ' ORDER BY p) FILTER (WHERE NOT removed) AS kept
  FROM places GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(sums.n, 0) AS n_removed,
       sha256(coalesce(sums.kept, '')) AS kept_sha256
FROM d LEFT JOIN sums USING (doc_id)
"""

# The items' windows, their places in the documents, the words inside them.
OP5 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
tests AS (
  SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(w[s:s + least(len(w), 13) - 1], ' ') AS g
  FROM b, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS t(s) WHERE len(w) > 0),
win AS (
  SELECT doc_id, s, k.n, array_to_string(w[s:s + k.n - 1], ' ') AS g
  FROM d, (SELECT DISTINCT n FROM tests) AS k, unnest(range(1, len(w) - k.n + 2)) AS t(s)),
hit AS (SELECT win.doc_id, win.s, win.n, tests.item FROM win JOIN tests USING (n, g)),
words AS (SELECT doc_id, count(DISTINCT p) AS n FROM hit, unnest(range(s, s + n)) AS t(p) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(item) AS n, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
       sha256(coalesce(items.ids, '')) AS items_sha256,
       coalesce(words.n, 0) > 0 AND 20 * coalesce(words.n, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

# Units, hash numbers, cuts; each part is a stretch of the list of units.
OP11 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
c AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS a,
         ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                OR ('0x' || h[17:24])::BIGINT % 100 >= 90 THEN 'plain'
              WHEN ('0x' || h[25:32])::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
p AS (
  SELECT *, array_to_string(u[1:least(a, b)], '') AS prefix, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS middle,
         array_to_string(u[greatest(a, b) + 1:], '') AS suffix FROM c)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_exact_dedup": OP2, "op4_substring_dedup": OP4, "op5_decontamination": OP5,
            "op11_fill_in_middle": OP11}
