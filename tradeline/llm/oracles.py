"""SQL equivalents for DuckDB of the operators that SQL can express."""

from __future__ import annotations

from tradeline.llm import decontaminate

#: All pairs that share a shingle, links by size of intersection, smallest id reachable.
NEAR_DUPLICATES = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS common FROM s a JOIN s b USING (shingle)
  WHERE a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * common >= 75 * (x.n + y.n - common)),
e AS (SELECT u, v FROM l UNION SELECT v, u FROM l),
r(doc_id, reached) AS (SELECT doc_id, doc_id FROM w UNION SELECT e.v, r.reached FROM r JOIN e ON e.u = r.doc_id)
SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(reached) AS component_id, doc_id = min(reached) AS kept
FROM r LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""

#: A control string costs one backslash; in roles a colon or line end too.
CHAT = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
f AS (SELECT *, 4 + length(role) + len(regexp_extract_all(role, '\\|###|</turn>|<(?:image|audio|document):|:|\n')) + 2
    + length(text) + len(regexp_extract_all(text, '\\|###|</turn>|<(?:image|audio|document):')) + 8 AS written FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(written)::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
"""

ORACLES: dict[str, str] = {
    "op2_minhash_dedup": NEAR_DUPLICATES,
    "op6_decontamination": decontaminate.SQL,
    "op8_chat_format": CHAT,
}
