"""DuckDB SQL of the operators that SQL can express, over the whole `documents` table."""

from __future__ import annotations

from costframe.llm.common import LOWER, UPPER

_WORDS = r"[^\x20\x09-\x0D]+"
_LOW = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"
_ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""


def _secret_kind(number: int, kind: str, pattern: str, group: int, least: int) -> str:
    return f"""
  SELECT doc_id, row, {number} AS kind_no, '{kind}' AS kind, nth, len(g) AS gap, len(w) AS whole, len(v) AS value, {least} AS least
  FROM (SELECT doc_id, row, unnest(whole) AS w, unnest(gaps[1:len(whole)]) AS g, unnest(value) AS v, generate_subscripts(whole, 1) AS nth
        FROM (SELECT doc_id, row, string_split_regex(text, '{pattern}') AS gaps, regexp_extract_all(text, '{pattern}', 0) AS whole,
                     regexp_extract_all(text, '{pattern}', {group}) AS value FROM texts))"""


SECRETS = f"""
WITH texts AS (SELECT doc_id, row_number() OVER () AS row, coalesce(text, '') AS text FROM documents),
matches AS ({_secret_kind(0, 'assign', _ASSIGN, 2, 8)}
  UNION ALL {_secret_kind(1, 'access', '(AKIA[A-Z0-9]+)', 1, 16)}
  UNION ALL {_secret_kind(2, 'hex', '([0-9a-f]+)', 1, 32)}),
placed AS (
  SELECT *, sum(gap + whole) OVER (PARTITION BY row, kind_no ORDER BY nth) AS stop FROM matches),
found AS (
  SELECT row, kind_no, kind, CAST(stop - whole AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop FROM placed WHERE value >= least),
spans AS (
  SELECT row, count(*) FILTER (kind_no = 0) AS n_assign, count(*) FILTER (kind_no = 1) AS n_access, count(*) FILTER (kind_no = 2) AS n_hex,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, kind_no) AS spans
  FROM found GROUP BY row)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN spans USING (row)"""

WINDOWS = f"""
WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS words FROM documents),
starts AS (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM texts),
windows AS (SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS w FROM starts),
firsts AS (SELECT w, min(doc_id) AS first FROM windows GROUP BY w),
marked AS (SELECT DISTINCT doc_id, i + j AS place FROM windows JOIN firsts USING (w) CROSS JOIN range(13) t(j) WHERE first < doc_id),
placed AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM texts),
kept AS (SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY place) AS kept FROM placed ANTI JOIN marked USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)"""

COPIES = f"""
WITH texts AS (SELECT doc_id, {_LOW} AS text FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept, sha256(text) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY text)"""

LINKED = f"""
WITH RECURSIVE texts AS (SELECT doc_id, regexp_extract_all({_LOW}, '{_WORDS}') AS words FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 2], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 1, 2))) AS i FROM texts WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM shingles a JOIN shingles b USING (shingle) WHERE a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * common >= 90 * (a.n + b.n - common)),
ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM texts UNION SELECT reached.doc_id, y FROM reached JOIN ways ON x = other),
least AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM least LEFT JOIN sizes USING (doc_id)"""

SQL = {"op3_secret_scan": SECRETS, "op6_window_dedup": WINDOWS, "op7_exact_dedup": COPIES, "op9_jaccard_join": LINKED}
