"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op7_line_dedup"] = r"""
WITH split AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS place
    FROM documents
), keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM split
), repeats AS (
    SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10
    GROUP BY key HAVING min(doc_id) <> max(doc_id)
), marked AS (
    SELECT k.*, r.key IS NOT NULL AND k.doc_id <> r.first AS lost
    FROM keyed k LEFT JOIN repeats r USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

ORACLE["op5_chat"] = r"""
WITH turns AS (
    SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
), whole AS (
    SELECT conv_id, count(*) AS n, list(struct_pack(r := role, t := text) ORDER BY turn NULLS FIRST) AS said,
           string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY turn NULLS FIRST) AS text
    FROM turns GROUP BY conv_id
), gone AS (
    SELECT DISTINCT a.conv_id FROM whole a JOIN whole b
    ON a.said[1] = b.said[1] AND a.conv_id <> b.conv_id
    AND (b.n > a.n AND list_slice(b.said, 1, a.n) = a.said OR b.said = a.said AND b.conv_id < a.conv_id)
)
SELECT conv_id, 0 AS part, n AS n_turns, text FROM whole WHERE conv_id NOT IN (SELECT conv_id FROM gone)
"""
