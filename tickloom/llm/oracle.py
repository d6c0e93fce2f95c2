"""The same results as plain SQL, where SQL can say them."""

from __future__ import annotations

_WORDS = r"""list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"""

CHAT = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(nullif(trim(role), ''), 'unknown') AS speaker,
         replace(coalesce(text, ''), '<|', '< |') AS text
  FROM conversations),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, speaker, text) - 1 AS place FROM turns),
sides AS (SELECT DISTINCT conv_id, speaker AS side FROM turns WHERE speaker <> 'system'),
written AS (
  SELECT n.*, s.side, CASE WHEN speaker = 'system' THEN '<|system|>' || chr(10)
                           WHEN speaker = side THEN '<|assistant|>' || chr(10)
                           ELSE '<|user ' || replace(speaker, '<|', '< |') || '|>' || chr(10) END AS head
  FROM numbered n JOIN sides s ON n.conv_id IS NOT DISTINCT FROM s.conv_id),
rendered AS (SELECT *, head || text || '<|end|>' || chr(10) AS rendered FROM written),
placed AS (
  SELECT *, CAST(sum(length(rendered)) OVER (PARTITION BY conv_id, side ORDER BY place) AS BIGINT) AS upto FROM rendered)
SELECT conv_id, side, place, speaker, rendered, upto - length(rendered) AS "start", upto AS "end",
       CASE WHEN speaker = side THEN upto - length(rendered) + length(head) END AS train_start,
       CASE WHEN speaker = side THEN upto END AS train_end
FROM placed
"""

NEIGHBOURS = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL)) = 0
    AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e) WHERE q.vec_id % 20 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM scored)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM ranked WHERE n <= 20
"""

QUALITY = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS ws FROM documents),
w AS (
  SELECT doc_id, t, ws, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM d),
wins AS (
  SELECT doc_id, unnest(range(1, len(ws) - 3)) AS i,
         unnest(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) AS k
  FROM w WHERE len(ws) >= 5),
twice AS (SELECT doc_id, i FROM wins QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
gaps AS (SELECT doc_id, least(5, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 5)) AS n FROM twice),
again AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS n FROM gaps GROUP BY doc_id),
m AS (
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(again.n, 0) AS n_repeat_words,
         CAST(len(ls) AS BIGINT) AS n_lines,
         CAST(length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS BIGINT) AS n_capitals
  FROM w LEFT JOIN again USING (doc_id)),
b AS (
  SELECT *, CAST(CASE WHEN n_words < 10 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 100 * n_symbols > 5 * word_chars THEN 4 ELSE 0 END
    + CASE WHEN n_lines >= 5 AND 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN n_words >= 10 AND 100 * n_capitals > 50 * word_chars THEN 16 ELSE 0 END
    + CASE WHEN n_words >= 10 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words) THEN 32 ELSE 0 END AS BIGINT) AS fail_bits
  FROM m)
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, fail_bits = 0 AS kept FROM b
"""

POLICIES = f"""
WITH entries AS ({QUALITY}),
policies(policy, mask) AS (VALUES ('base', 3), ('1', 15), ('2', 63)),
rules(rule, bit) AS (
  VALUES ('few_words', 1), ('repeated_windows', 2), ('symbols', 4), ('duplicate_lines', 8), ('capitals', 16), ('word_length', 32))
SELECT policy, rule, count(*) AS n_docs, count(*) FILTER (WHERE fail_bits & bit <> 0) AS n_failed,
       count(*) FILTER (WHERE fail_bits & mask = bit) AS n_only, count(*) FILTER (WHERE fail_bits & mask = 0) AS n_kept
FROM entries, policies, rules WHERE mask & bit <> 0 GROUP BY policy, rule
"""

PHRASES = rf"""
WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
wins AS (
  SELECT doc_id, unnest(range(1, len(ws) - 11)) AS i,
         unnest(list_transform(range(1, len(ws) - 11), lambda i: array_to_string(ws[i:i + 12], ' '))) AS k
  FROM w WHERE len(ws) >= 13),
firsts AS (SELECT k, min(doc_id) AS d FROM wins GROUP BY k),
hits AS (SELECT wins.doc_id, wins.i FROM wins JOIN firsts USING (k) WHERE d < wins.doc_id),
words AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS p, unnest(ws) AS x FROM w),
latest AS (
  SELECT words.doc_id, p, x, max(hits.i) OVER (PARTITION BY words.doc_id ORDER BY p) AS i
  FROM words LEFT JOIN hits ON hits.doc_id = words.doc_id AND hits.i = words.p),
kept AS (
  SELECT doc_id, count(*) FILTER (WHERE p - i <= 12) AS n_removed,
         string_agg(x, ' ' ORDER BY p) FILTER (WHERE coalesce(p - i > 12, true)) AS t
  FROM latest GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

#: CRC-32 of an ASCII string, byte by byte: the table of its 256 steps, made from the polynomial.
_CRC_TABLE = """
crc AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS v FROM range(256) r(i)))
"""


def _crc(text: str) -> str:
    data = f"list_transform(range(1, length({text}) + 1), lambda z: CAST(ord(({text})[z]) AS BIGINT))"
    return f"xor(list_reduce({data}, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"


EXACT = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept,
       sha256(t) AS text_sha256
FROM d WINDOW same AS (PARTITION BY t)
"""


def _way(way: str, cost: int | str, letter: str) -> str:
    """A way is its cost in nine digits and its letters, so the least string is the best way."""
    return f"lpad(CAST(CAST({way}[1:9] AS INTEGER) + {cost} AS VARCHAR), 9, '0') || {way}[10:] || '{letter}'"


_NO_WAY = "'900000000'"
_IN_USER = f"least(u, {_way('n', 2, 'I')}, {_way('s', 2, 'I')}, {_way('a', 2, 'I')})"
_IN_ASSISTANT = f"least(a, {_way('u', 2, 'I')}, {_way('n', 4, 'II')}, {_way('s', 4, 'II')})"


def _row_ways(before: str, initial: str, same: str) -> str:
    """Best way to a state by a row: kept or renamed from ``before``, or deleted in ``same``."""
    kept = f"CASE WHEN fixed OR ini <> '{initial}' THEN {_NO_WAY} ELSE {_way(before, 'late', 'K')} END"
    renamed = f"CASE WHEN fixed THEN {_NO_WAY} ELSE {_way(before, '2 + late', 'R')} END" if initial != "s" else _NO_WAY
    return f"least({kept}, {renamed}, {_way(same, 3, 'D')})"


REPAIR = rf"""
WITH RECURSIVE {_CRC_TABLE},
keyed AS (
  SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
hit AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc('k')} % 20 AS h FROM keyed, crc),
hurt AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
         CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN h = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM hit WHERE h <> 0),
shown AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS seen,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS ending FROM hurt),
faulty AS (
  SELECT *, role[1:1] AS ini, CASE WHEN ending = '' THEN 'blank' WHEN seen THEN 'duplicate'
              WHEN ending NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
         lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY i) AS ini_before FROM shown),
r AS (
  SELECT *, coalesce(fault IN ('blank', 'duplicate'), false) AS fixed, CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END AS late FROM faulty),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
         count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE ini_before IS NOT NULL AND ini_before || ini NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n_rows
  FROM r GROUP BY conv_id),
dp AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, '000000000' AS n, {_NO_WAY} AS s, {_NO_WAY} AS u, {_NO_WAY} AS a FROM counted
  UNION ALL
  SELECT conv_id, i, {_way('n', 3, 'D')}, {_row_ways('n', 's', 's')},
         least({_row_ways('n', 'u', 'iu')}, {_row_ways('s', 'u', 'iu')}, {_row_ways('ia', 'u', 'iu')}), {_row_ways('iu', 'a', 'ia')}
  FROM (SELECT dp.conv_id, r.i, r.ini, r.fixed, r.late, n, s, u, a, {_IN_USER} AS iu, {_IN_ASSISTANT} AS ia
        FROM dp JOIN r ON r.conv_id IS NOT DISTINCT FROM dp.conv_id AND r.i = dp.i + 1)),
best AS (
  SELECT c.*, least(n, {_IN_ASSISTANT}) AS way FROM counted c JOIN dp ON dp.conv_id IS NOT DISTINCT FROM c.conv_id AND dp.i = c.n_rows),
letters AS (SELECT conv_id, unnest(range(1, length(way) - 8)) AS place, way[10:] AS audit FROM best WHERE length(way) > 9),
placed AS (
  SELECT conv_id, place, audit[place:place] AS letter,
         count(*) FILTER (WHERE audit[place:place] <> 'I') OVER (PARTITION BY conv_id ORDER BY place) AS i FROM letters),
written AS (
  SELECT p.conv_id, p.place, p.letter, r.role, r.text, row_number() OVER line AS j,
         first_value(CASE WHEN p.letter = 'K' AND r.ini = 's' THEN 1 ELSE 0 END) OVER line AS begun
  FROM placed p LEFT JOIN r ON p.letter <> 'I' AND r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i
  WHERE p.letter <> 'D' WINDOW line AS (PARTITION BY p.conv_id ORDER BY p.place)),
lines AS (
  SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (j - begun) % 2 = 1 THEN 'user' ELSE 'assistant' END
                             || ':' || coalesce(text, ''), chr(10) ORDER BY place) AS t
  FROM written GROUP BY conv_id),
every AS (SELECT DISTINCT conv_id FROM conversations)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(CAST(way[1:9] AS BIGINT), 0) AS cost,
       coalesce(way[10:], '') AS audit, sha256(coalesce(t, '')) AS repaired_sha256
FROM every e LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN lines l ON l.conv_id IS NOT DISTINCT FROM e.conv_id
"""

PERIODS = rf"""
WITH {_CRC_TABLE},
split AS (SELECT doc_id, CAST(doc_id AS VARCHAR) AS k, {_WORDS} AS ws FROM documents),
chosen AS (SELECT doc_id, ws, CAST(len(ws) AS BIGINT) AS n, CASE WHEN k IS NULL THEN 1 ELSE {_crc("coalesce(k, '')")} END AS h FROM split, crc),
placed AS (SELECT *, (h // 10) % n AS a, 1 + (n - (h // 10) % n) // (3 + (h // 10) % 8) AS p FROM chosen WHERE n > 0),
words AS (
  SELECT doc_id, n, i, ws[1 + CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % p ELSE i END] AS w
  FROM (SELECT *, unnest(range(n)) AS i FROM placed)),
met AS (
  SELECT x.doc_id, y.i - x.i AS d, x.i AS i FROM words x JOIN words y
  ON x.doc_id = y.doc_id AND x.w = y.w AND y.i > x.i AND 2 * (y.i - x.i) <= x.n),
numbered AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, d ORDER BY i) AS g FROM met),
stretches AS (
  SELECT doc_id, d, min(i) AS s, min(i) + count(*) + d AS e FROM numbered GROUP BY doc_id, d, g
  HAVING count(*) + d >= greatest(12, 2 * d)),
runs AS (
  SELECT * FROM stretches x WHERE NOT EXISTS (
    SELECT 1 FROM stretches y WHERE y.doc_id = x.doc_id AND y.d < x.d AND x.d % y.d = 0 AND y.s <= x.s AND y.e >= x.e)),
summed AS (
  SELECT doc_id, count(*) AS n_runs, arg_min({{'s': s, 'e': e, 'd': d}}, {{'l': s - e, 's': s, 'd': d}}) AS best,
         string_agg(s || ',' || (e - s) || ',' || d || chr(10), '' ORDER BY s, d) AS listed
  FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + d, e)) AS i FROM runs),
kept AS (
  SELECT words.doc_id, string_agg(w, ' ' ORDER BY words.i) AS t FROM words LEFT JOIN gone ON gone.doc_id = words.doc_id AND gone.i = words.i
  WHERE gone.i IS NULL GROUP BY words.doc_id)
SELECT c.doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS "start", best.e - best.s AS length, best.d AS period,
       1000 * (best.e - best.s) // best.d AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM chosen c LEFT JOIN summed ON summed.doc_id = c.doc_id LEFT JOIN kept ON kept.doc_id = c.doc_id
"""

ORACLE = {
    "op2_chat_perspectives": CHAT,
    "op5_block_neighbours": NEIGHBOURS,
    "op6_quality_ledger": QUALITY,
    "quality_policies": POLICIES,
    "op10_phrase_automata": PHRASES,
    "op11_exact_stream": EXACT,
    "op12_conversation_repair": REPAIR,
    "op13_periodic_runs": PERIODS,
}
