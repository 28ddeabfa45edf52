"""DuckDB SQL of the corpus queries that SQL can express.

The others are fitted models, hash placements and searches by edit distance; tests/llm
holds them against brute force.
"""

from __future__ import annotations


def crc32(text: str) -> str:
    """Unsigned CRC-32 of ASCII text: eight shifts for each character."""
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda ch: ord(ch)::BIGINT)),
  lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [1, 1, 1, 1, 1, 1, 1, 1]::BIGINT[]), lambda x, one: xor(x >> 1, (x & one) * 3988292384))), 4294967295)"""


BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
UPPER, LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"

LINE_DEDUP = r"""
WITH lines AS (
  SELECT doc_id, i, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
repeated AS (
  SELECT k, max(doc_id) AS holder FROM lines WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT l.*, r.k IS NOT NULL AND l.doc_id <> r.holder AS gone FROM lines l LEFT JOIN repeated r ON l.k = r.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""

# Words, their shingles, pairs that share one, and whatever is linked to whatever.
NEAR_DUPLICATES = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {UPPER}, {LOWER}), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM words),
classes AS (SELECT min(doc_id) AS class, s, len(s) AS n FROM (SELECT doc_id, list_sort(s) AS s FROM sets WHERE len(s) > 0) GROUP BY s),
shingles AS (SELECT class, n, unnest(s) AS shingle FROM classes),
links AS (
  SELECT a.class AS one, b.class AS two FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.class < b.class
  WHERE 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.class, b.class, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reached AS (
  SELECT class AS node, class AS least FROM classes
  UNION
  SELECT l.two, r.least FROM reached r JOIN (SELECT one, two FROM links UNION ALL SELECT two, one FROM links) l ON l.one = r.node),
components AS (SELECT node, min(least) AS component_id FROM reached GROUP BY node)
SELECT d.doc_id, len(d.s) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id, coalesce(c.component_id, d.doc_id) = d.doc_id AS kept
FROM sets d LEFT JOIN classes k ON len(d.s) > 0 AND k.s = list_sort(d.s) LEFT JOIN components c ON c.node = k.class"""

# Leaves, a level of each tree by recursion, the runs of three, and each leaf's walk to the root.
MANIFEST = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, source, text, doc_id::VARCHAR AS id, coalesce(octet_length(encode(source)) || ':' || source, '-') || coalesce(octet_length(encode(lang)) || ':' || lang, '-')
         || coalesce(length(n_chars::VARCHAR) || ':' || n_chars, '-') AS mid FROM documents),
leaf AS (
  SELECT *, sha256(coalesce(length(id) || ':' || id, '-') || mid || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
         sha256(coalesce(length(id) || ':' || id, '-') || mid || coalesce(octet_length(encode(replace(text, chr(10), ''))) || ':' || replace(text, chr(10), ''), '-')) AS other,
         ({crc32("id")}) % 2 = 0 AS tampered FROM leaves),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM leaf),
lower_tree AS (
  SELECT 0 AS level, source, pos, n, leaf AS h FROM placed
  UNION ALL
  SELECT any_value(level) + 1, source, pos // 3, any_value((n + 2) // 3), sha256(string_agg(h, '' ORDER BY pos)) FROM lower_tree WHERE n > 1 GROUP BY source, pos // 3),
subroots AS (
  SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM lower_tree WHERE n = 1),
upper_tree AS (
  SELECT 0 AS level, pos, n, subroot AS h FROM subroots
  UNION ALL
  SELECT any_value(level) + 1, pos // 3, any_value((n + 2) // 3), sha256(string_agg(h, '' ORDER BY pos)) FROM upper_tree WHERE n > 1 GROUP BY pos // 3),
lower_runs AS (
  SELECT level, source, pos // 3 AS parent, coalesce(max(h) FILTER (WHERE pos % 3 = 0), '') AS s0, coalesce(max(h) FILTER (WHERE pos % 3 = 1), '') AS s1,
         coalesce(max(h) FILTER (WHERE pos % 3 = 2), '') AS s2 FROM lower_tree WHERE n > 1 GROUP BY level, source, pos // 3),
upper_runs AS (
  SELECT level, pos // 3 AS parent, coalesce(max(h) FILTER (WHERE pos % 3 = 0), '') AS s0, coalesce(max(h) FILTER (WHERE pos % 3 = 1), '') AS s1,
         coalesce(max(h) FILTER (WHERE pos % 3 = 2), '') AS s2 FROM upper_tree WHERE n > 1 GROUP BY level, pos // 3),
walk AS (
  SELECT 0 AS level, false AS upper, p.doc_id, p.source, p.leaf, p.pos, p.n, s.subroot, s.pos AS top_pos, s.n AS top_n, '' AS proof,
         CASE WHEN tampered AND text IS NOT NULL THEN other ELSE leaf END AS folded
  FROM placed p JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source
  UNION ALL
  SELECT CASE WHEN w.n = 1 THEN 0 ELSE w.level + 1 END, w.upper OR w.n = 1, w.doc_id, w.source, w.leaf,
         CASE WHEN w.n = 1 THEN w.top_pos ELSE w.pos // 3 END, CASE WHEN w.n = 1 THEN w.top_n ELSE (w.n + 2) // 3 END, w.subroot, w.top_pos, w.top_n,
         w.proof || CASE WHEN w.n = 1 THEN '' ELSE CASE w.pos % 3 WHEN 0 THEN r.s1 || r.s2 WHEN 1 THEN r.s0 || r.s2 ELSE r.s0 || r.s1 END END,
         CASE WHEN w.n = 1 THEN w.folded ELSE sha256(CASE w.pos % 3 WHEN 0 THEN w.folded || r.s1 || r.s2 WHEN 1 THEN r.s0 || w.folded || r.s2 ELSE r.s0 || r.s1 || w.folded END) END
  FROM walk w LEFT JOIN (SELECT false AS upper, * FROM lower_runs UNION ALL SELECT true, level, NULL, parent, s0, s1, s2 FROM upper_runs) r
    ON w.n > 1 AND r.upper = w.upper AND r.level = w.level AND r.parent = w.pos // 3 AND (w.upper OR r.source IS NOT DISTINCT FROM w.source)
  WHERE NOT (w.upper AND w.n = 1))
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM walk, (SELECT h AS root FROM upper_tree WHERE n = 1) WHERE upper AND n = 1"""


def _least(*ways: str) -> str:
    return f"list_sort([{', '.join(ways)}])[1]"


def _edit(letter: str, cost: str, then: str, row: str = "''") -> str:
    return f"{{'c': {then}.c + {cost}, 'a': '{letter}' || {then}.a, 'r': {row} || {then}.r}}"


def _insert(role: str, then: str) -> str:
    return _edit("I", "2", then, f"chr(10) || '{role}:'")


def _row(state: int) -> str:
    """Cheapest edits from a row on, if it is edited at once. States: 0 none yet, 1 after system, 2 after user, 3 after assistant."""
    to, role = ("v3", "assistant") if state == 2 else ("v2", "user")
    keeps = {0: "CASE initial WHEN 's' THEN v1 WHEN 'u' THEN v2 END", 1: "CASE initial WHEN 'u' THEN v2 END", 2: "CASE initial WHEN 'a' THEN v3 END", 3: "CASE initial WHEN 'u' THEN v2 END"}
    keep = _edit("K", "extra", f"({keeps[state]})", "chr(10) || role || ':' || text")
    keep = f"CASE WHEN goes OR ({keeps[state]}) IS NULL THEN never ELSE {keep} END"
    rerole = f"CASE WHEN goes THEN never ELSE {_edit('R', '2 + extra', to, f"chr(10) || '{role}:' || text")} END"
    return _least(_edit("D", "3", f"v{state}"), keep, rerole)


# Cost, edits and repaired rows from each row on, for each state, from the last row backwards.
CONVERSATIONS = f"""
WITH RECURSIVE hit AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS damage FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE damage WHEN 4 THEN 'user' ELSE role END AS role,
         CASE damage WHEN 1 THEN '' WHEN 2 THEN replace(replace(replace(text, '.', ''), '!', ''), '?', '') ELSE text END AS text,
         unnest(CASE damage WHEN 3 THEN [0, 1] ELSE [0] END) AS copy FROM hit WHERE damage <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(octet_length(encode(role)) || ':' || role || text), copy) AS i,
         rtrim(text, {BLANKS}) AS bare, left(role, 1) AS initial FROM damaged),
judged AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM placed),
steps AS (SELECT *, fault IN ('blank', 'duplicate') AS goes, (fault = 'truncated')::INTEGER AS extra, {{'c': 1000000000, 'a': '', 'r': ''}} AS never FROM judged),
walk AS (
  SELECT conv_id, max(i) AS i, {{'c': 0, 'a': '', 'r': ''}} AS v0, {{'c': 4, 'a': 'II', 'r': chr(10) || 'user:' || chr(10) || 'assistant:'}} AS v1,
         {{'c': 2, 'a': 'I', 'r': chr(10) || 'assistant:'}} AS v2, {{'c': 0, 'a': '', 'r': ''}} AS v3 FROM steps GROUP BY conv_id
  UNION ALL
  SELECT conv_id, i - 1, {_least("w0", _insert("user", "x2"))}, {_least("w1", _insert("user", "x2"))}, x2, x3
  FROM (SELECT *, {_least("w2", _insert("assistant", "w3"))} AS x2, {_least("w3", _insert("user", "w2"))} AS x3
        FROM (SELECT k.conv_id, k.i, {_row(0)} AS w0, {_row(1)} AS w1, {_row(2)} AS w2, {_row(3)} AS w3
              FROM walk k JOIN steps s ON s.i = k.i AND s.conv_id IS NOT DISTINCT FROM k.conv_id))),
sums AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
         count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(w.v0.c, 0)::BIGINT AS cost, coalesce(w.v0.a, '') AS audit,
       sha256(coalesce(substr(w.v0.r, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN walk w ON w.i = 0 AND w.conv_id IS NOT DISTINCT FROM c.conv_id"""

ORACLE_SQL = {
    "op2_perfect_hash_line_dedup": LINE_DEDUP,
    "op6_circulant_minhash_dedup": NEAR_DUPLICATES,
    "op11_slot_pivot_manifest": MANIFEST,
    "op13_rank_convergence_repair": CONVERSATIONS,
}
