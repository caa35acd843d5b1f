"""DuckDB SQL for the queries that SQL can express. It follows the contract of
each query, not the Spark plan."""

from __future__ import annotations

import re
import string

from fleetplan.llm.rules import RULES, STOP_WORDS

_WORDS = r"list_filter(regexp_split_to_array({0}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

OP5 = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, length(text) + len(regexp_extract_all(text, '\\|</s>|<s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|<<ROLE>>|<</ROLE>>|<</TURN>>'))
    + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 6 WHEN 'system' THEN 18
      ELSE 28 + length(role) + len(regexp_extract_all(role, '\\|</s>|<s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|<<ROLE>>|<</ROLE>>|<</TURN>>')) END AS formatted
  FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
  CAST(sum(formatted) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

OP6 = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, q.r, c.vec_id,
    CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.r <> c.r AND len(q.v) = len(c.v)
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

OP7 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_WORDS.format(_LOWER)} AS ws FROM documents
), shingles AS (
  SELECT doc_id, unnest(list_distinct(CASE
      WHEN len(ws) = 0 THEN CAST([] AS VARCHAR[])
      WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
      ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')) END)) AS g
  FROM w
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared >= 85 * (x.n + y.n - shared)
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT doc_id, doc_id AS other FROM w
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN both_ways l ON l.a = r.other
), least AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT w.doc_id, coalesce(s.n, 0) AS n_shingles, l.component_id, w.doc_id = l.component_id AS kept
FROM w JOIN least l USING (doc_id) LEFT JOIN sizes s USING (doc_id)
"""


def _tests() -> str:
    """The ratio rules as SQL conditions that a kept row meets."""
    out = []
    for r in RULES:
        measure = r.measure.replace("try_divide(", "ratio(")
        if r.low is not None:
            out.append(f"coalesce({measure} >= {r.low}, true)")
        if r.high is not None:
            out.append(f"coalesce({measure} <= {r.high}, true)")
    return " AND ".join(out)


def _without_ratio(sql: str) -> str:
    """``ratio(a, b)`` as a division that gives NULL for a zero divisor."""
    return re.sub(r"ratio\((\w+), (greatest\(\w+, 1\)|\w+)\)", r"(CAST(\1 AS DOUBLE) / nullif(\2, 0))", sql)


def _op9() -> str:
    stop = sorted({v for group in STOP_WORDS.values() for w in group for v in (w, w.title())})
    listed = ", ".join(f"'{w}'" for w in stop)
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT *, {_WORDS.format("t")} AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d
), grams AS (
  SELECT r, unnest(range(1, len(ws) - 1)) AS i, ws FROM w WHERE len(ws) >= 3
), again AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, ws[i], ws[i + 1], ws[i + 2]) AS n FROM grams
), repeated AS (
  SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM again, range(3) AS x(k) WHERE n > 1 GROUP BY r
), c AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, len(ls) AS n_lines,
    len(list_filter(ws, lambda x: x IN ({listed}))) AS n_stop_words,
    len(list_filter(ws, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_letter_words,
    len(regexp_extract_all(t, '\p{{Lu}}{{2,}}')) AS n_capital_runs
  FROM w LEFT JOIN repeated USING (r)
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {_without_ratio(_tests())} AS kept
FROM b
"""


OP12 = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), drawn AS (
  SELECT doc_id, t, length(t) AS n, CAST('0x' || h[1:8] AS BIGINT) % (length(t) + 1) AS x, CAST('0x' || h[9:16] AS BIGINT) % (length(t) + 1) AS y,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 90 THEN 'plain'
         WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM d
), parts AS (
  SELECT *, least(x, y) AS a, greatest(x, y) - least(x, y) AS b,
    substring(t, 1, least(x, y)) AS p, substring(t, least(x, y) + 1, greatest(x, y) - least(x, y)) AS m, substring(t, greatest(x, y) + 1) AS s
  FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
"""


ORACLE = {"op5_chat": OP5, "op6_topk": OP6, "op7_near_dedup": OP7, "op9_quality_rules": _op9(), "op12_infill": OP12}
