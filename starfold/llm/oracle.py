"""DuckDB SQL for those queries that SQL can express."""

from __future__ import annotations

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP1 = f"""
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM docs),
keyed AS (SELECT *, translate(trim(line, {BLANKS}), '{UPPER}', '{UPPER.lower()}') AS k FROM lines),
common AS (SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT keyed.*, common.k IS NOT NULL AND doc_id <> keeper AS dropped FROM keyed LEFT JOIN common USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP4 = f"""
WITH items AS (SELECT item_id, {WORDS} AS w FROM benchmark),
ws AS (SELECT DISTINCT item_id, list_slice(w, i, i + 9) AS win
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(win) AS n FROM ws),
texts AS (SELECT text, {WORDS} AS w FROM (SELECT DISTINCT coalesce(text, '') AS text FROM documents)),
places AS (SELECT text, n, i, list_slice(w, i, i + n - 1) AS win
           FROM (SELECT text, w, n, unnest(range(1, greatest(len(w) - n + 2, 1))) AS i FROM texts, sizes)),
found AS (SELECT text, n, i, item_id FROM places JOIN ws USING (win)),
hit AS (SELECT text, count(DISTINCT p) AS n_hit FROM (SELECT text, unnest(range(i, i + n)) AS p FROM found) GROUP BY text),
named AS (SELECT text, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT text, item_id::VARCHAR AS item_id FROM found) GROUP BY text)
SELECT doc_id, len(texts.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM documents JOIN texts ON coalesce(documents.text, '') = texts.text
LEFT JOIN hit ON hit.text = texts.text LEFT JOIN named ON named.text = texts.text
"""

ORACLE = {"op1_line_dedup": OP1, "op4_decontamination": OP4}
