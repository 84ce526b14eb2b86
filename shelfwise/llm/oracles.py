"""DuckDB SQL for the queries whose whole result SQL can express, written from
the contracts of the results over the registered tables."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    """A-Z lower-cased, then runs of digits, letters and all from U+0080 on."""
    return rf"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')"


#: Windows of ten words (of shorter items: all their words), and where they stand.
DECONTAMINATION = rf"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_words('text')} AS w FROM documents),
items AS (SELECT item_id, {_words('text')} AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS words
  FROM (SELECT item_id, w, least(len(w), 10) AS k, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i
        FROM items WHERE len(w) > 0)),
places AS (
  SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS words
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM d, (SELECT DISTINCT k FROM item_windows) WHERE len(w) >= k)),
found AS (SELECT r, k, i, words FROM places SEMI JOIN item_windows USING (k, words)),
hits AS (SELECT r, count(DISTINCT spot) AS n FROM (SELECT r, unnest(range(i, i + k)) AS spot FROM found) GROUP BY r),
named AS (
  SELECT r, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM found JOIN item_windows USING (k, words)) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(hits.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(hits.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN named USING (r)"""

#: Characters that the template's escapes add to a text: one for each backslash,
#: each place where "###" stands, each "</turn>".
_ADDED = r"""(length({0}) - length(replace({0}, '\', ''))
  + coalesce(list_sum(list_transform(regexp_extract_all({0}, '#{{3,}}'), lambda x: length(x) - 2)), 0)
  + len(regexp_extract_all({0}, '</turn>')))"""

CHAT = rf"""
WITH rows_ AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
turns AS (SELECT *, coalesce(role, '') AS r, coalesce(text, '') AS t FROM rows_),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS n FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY n)) AS turns_sha256,
  CAST(coalesce(sum(length(t)) FILTER (r = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(t, '' ORDER BY n) FILTER (r = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('### : </turn>') + 1 + length(r) + {_ADDED.format('r')} + length(r) - length(replace(r, ':', ''))
           + length(t) + {_ADDED.format('t')}) AS BIGINT) AS formatted_chars
FROM placed GROUP BY conv_id"""

ORACLES = {"op1_chat": CHAT, "op10_decontamination": DECONTAMINATION}
