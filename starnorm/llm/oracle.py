"""DuckDB SQL for the queries it can express, over whole tables."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"
PLAIN_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_WORDS = f"""
words AS (
  SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS word,
         generate_subscripts(regexp_extract_all(coalesce(text, ''), '{WORD}'), 1) AS pos
  FROM documents
)"""

OP2 = rf"""
WITH {_WORDS},
windows AS (
  SELECT doc_id, pos, word,
         lead(word, 1) OVER w AS second, lead(word, 2) OVER w AS third
  FROM words WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
),
marked AS (
  SELECT doc_id, pos, word,
         third IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, word, second, third) > 1 AS again
  FROM windows
),
spread AS (
  SELECT doc_id, word, max(CAST(again AS INT)) OVER (
    PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS repeated
  FROM marked
),
counted AS (
  SELECT doc_id, count(*) AS n_words, sum(length(word))::BIGINT AS word_chars,
         sum(repeated)::BIGINT AS n_repeat_words
  FROM spread GROUP BY doc_id
),
lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents
),
line_counts AS (
  SELECT doc_id, count(*) AS n_lines, (count(*) - count(DISTINCT line))::BIGINT AS n_dup_lines
  FROM lines WHERE regexp_matches(line, '{WORD}') GROUP BY doc_id
),
measured AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
         length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(n_lines, 0) AS n_lines
  FROM documents LEFT JOIN counted USING (doc_id) LEFT JOIN line_counts USING (doc_id)
),
judged AS (
  SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words THEN 4 ELSE 0 END
    + CASE WHEN word_chars > 20 * n_words THEN 8 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words THEN 16 ELSE 0 END
    + CASE WHEN n_dup_lines >= 3 AND 100 * n_dup_lines > 30 * n_lines THEN 32 ELSE 0 END
    + CASE WHEN n_words > 100000 THEN 64 ELSE 0 END)::BIGINT AS failed_bits
  FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       failed_bits & 3 <> 0 AS base_failed, failed_bits & 63 = 0 AS kept, failed_bits
FROM judged
"""

OP5 = rf"""
WITH {_WORDS},
sized AS (SELECT doc_id, pos, word, count(*) OVER (PARTITION BY doc_id) AS n FROM words),
windows AS (
  SELECT doc_id, pos, word, n, string_agg(word, ' ') OVER (
    PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS seq
  FROM sized
),
marked AS (
  SELECT doc_id, pos, word,
         pos + 19 <= n AND row_number() OVER (
           PARTITION BY seq, pos + 19 <= n ORDER BY doc_id, pos) > 1 AS again
  FROM windows
),
spread AS (
  SELECT doc_id, pos, word, max(CAST(again AS INT)) OVER (
    PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS removed
  FROM marked
),
cleaned AS (
  SELECT doc_id, count(*) AS n_words, sum(removed)::BIGINT AS n_removed,
         coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (removed = 0), '') AS kept
  FROM spread GROUP BY doc_id
)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN cleaned USING (doc_id)
"""

OP4 = """
WITH codes AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x > 0 AS INT)) AS code FROM embeddings
),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.code, c.code),
              lambda z: CAST(z[1] <> z[2] AS INT))) AS INT) AS distance
  FROM codes q, codes c WHERE q.vec_id % 50 = 0
),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS INT) AS rank
  FROM pairs
)
SELECT query_id, rank, vec_id, distance FROM ranked WHERE rank <= 10
"""

OP11 = rf"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{WORD}') AS words
  FROM documents
),
failing AS (
  SELECT doc_id, part,
         CASE WHEN len(words) < 100 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text)
                 THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN coalesce(doc_id > min(doc_id) OVER (PARTITION BY text),
                               doc_id IS NULL AND min(doc_id) OVER (PARTITION BY text) IS NOT NULL)
                 THEN 'E' ELSE '' END AS failed
  FROM texts
),
judged AS (
  SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
),
counted AS (
  SELECT part, string_split(failed, '') AS failed, count(*) AS n,
         sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM failing LEFT JOIN judged USING (doc_id) GROUP BY ALL
),
letters AS (SELECT unnest(string_split('ABCDE', '')) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
),
places AS (
  SELECT filter_order, CAST(step AS INT) AS step, substr(filter_order, step, 1) AS letter,
         string_split(substr(filter_order, 1, step - 1), '') AS earlier
  FROM orders, range(1, 6) AS r(step)
),
effects AS (
  SELECT part, filter_order, step, letter, n, good, toxic,
         list_contains(failed, letter) AS fails,
         list_has_any(failed, list_filter(earlier, lambda x: x <> '')) AS gone,
         list_contains(failed, letter)
           AND len(list_filter(failed, lambda x: x <> '')) = 1 AS sole
  FROM counted, places
),
summed AS (
  SELECT part, filter_order, step, letter,
         sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN NOT gone AND fails THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN gone AND fails THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN sole THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN NOT gone AND fails THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN NOT gone AND fails THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM effects GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, letter)::BIGINT AS shapley
FROM summed
"""

OP12 = rf"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '{PLAIN_WORD}') AS words
  FROM benchmark
),
starts AS (
  SELECT item_id, words, least(10, len(words)) AS size,
         unnest(range(1, len(words) - least(10, len(words)) + 2)) AS pos
  FROM item_words WHERE len(words) > 0
),
item_windows AS (
  SELECT DISTINCT item_id, size, array_to_string(words[pos : pos + size - 1], ' ') AS seq FROM starts
),
doc_words AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '{PLAIN_WORD}') AS words
  FROM documents
),
doc_windows AS (
  SELECT row, size, pos, array_to_string(words[pos : pos + size - 1], ' ') AS seq
  FROM (
    SELECT row, words, size, unnest(range(1, len(words) - size + 2)) AS pos
    FROM doc_words, (SELECT DISTINCT size FROM item_windows)
    WHERE len(words) >= size
  )
),
found AS (
  SELECT DISTINCT row, pos, size, item_id FROM doc_windows JOIN item_windows USING (size, seq)
),
hits AS (
  SELECT row, count(DISTINCT place) AS n_hit
  FROM (SELECT row, unnest(range(pos, pos + size)) AS place FROM found) GROUP BY row
),
items AS (
  SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY row
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       n_hit IS NOT NULL AS contaminated
FROM doc_words LEFT JOIN hits USING (row) LEFT JOIN items USING (row)
"""

# The rules of the current policy, by their bits.
_RULES = ("few_words", "repeated_words", "short_words", "long_words", "symbols", "repeated_lines")

ABLATIONS = f"WITH ledger AS ({OP2}) " + " UNION ALL ".join(
    f"""
SELECT '{rule}' AS rule, count(*) FILTER (failed_bits & {1 << k} <> 0) AS n_failed,
       count(*) FILTER (failed_bits & 63 = {1 << k}) AS n_only,
       count(*) FILTER (failed_bits & {63 - (1 << k)} = 0) AS n_kept_without
FROM ledger"""
    for k, rule in enumerate(_RULES)
)

ORACLE: dict[str, str] = {
    "op2_quality_rules": OP2,
    "op4_hamming_topk": OP4,
    "op5_substring_dedup": OP5,
    "op11_filter_audit": OP11,
    "op12_decontamination": OP12,
    "quality_ablations": ABLATIONS,
}
