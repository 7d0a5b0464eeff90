"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

#: Words of a text, and the text itself with null as empty.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

QUALITY_RULES = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS w, string_split(coalesce(text, ''), chr(10)) AS l
  FROM documents
), m AS (
  SELECT doc_id,
    len(w)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    list_filter(l, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
    list_transform(range(1, len(w) - 1), lambda i: concat_ws(chr(32), w[i], w[i + 1], w[i + 2])) AS three,
    len(list_filter(w, lambda x: regexp_matches(x, '[A-Z].*[A-Z]') AND NOT regexp_matches(x, '[a-z]')))::BIGINT AS n_shout,
    w
  FROM d
), win AS (
  SELECT doc_id, n, unnest(three) AS win, unnest(range(1, len(three) + 1)) AS i
  FROM (SELECT *, row_number() OVER () AS n FROM m)
), twice AS (
  SELECT n, i FROM (SELECT n, i, count(*) OVER (PARTITION BY n, win) AS c FROM win) WHERE c >= 2
), hit AS (
  SELECT n, count(DISTINCT i + k)::BIGINT AS n_repeat_words
  FROM twice, (VALUES (0), (1), (2)) AS o(k) GROUP BY n
), a AS (
  SELECT doc_id, n_words, word_chars, n_symbols, len(lines)::BIGINT AS n_lines,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, n_shout
  FROM (SELECT *, row_number() OVER () AS n FROM m) LEFT JOIN hit USING (n)
), f AS (
  SELECT *,
    ((n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT
     + 4 * (10 * n_symbols > n_words)::BIGINT + 8 * (100 * n_dup_lines > 30 * n_lines)::BIGINT
     + 16 * (word_chars < 2 * n_words)::BIGINT + 32 * (word_chars > 20 * n_words)::BIGINT
     + 64 * (2 * n_shout > n_words)::BIGINT)::BIGINT AS failed
  FROM a
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  failed = 0 AS kept, failed
FROM f
"""


#: The CRC-32 table by its polynomial, and the checksum of a short ASCII text.
_CRC_TABLE = """
crc_step(i, k, v) AS (
  SELECT i, 0, i FROM range(256) AS r(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(3988292384, v >> 1) ELSE v >> 1 END FROM crc_step WHERE k < 8
), crc_table AS (SELECT list(v ORDER BY i) AS crc FROM crc_step WHERE k = 8)
"""


def _crc32(text: str) -> str:
    """SQL for the CRC-32 of the ASCII ``text``, beside a column ``crc``."""
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    step = "lambda h, x: xor(crc[(xor(h, x) & 255) + 1], h >> 8)"
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), {step}), 4294967295)"


PERIODIC_RUNS = rf"""
WITH RECURSIVE {_CRC_TABLE}, d AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w, {_crc32("doc_id::VARCHAR")} AS h FROM documents, crc_table
), e AS (
  SELECT *, len(w) AS n, h // 10 AS g FROM d
), f AS (
  SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n ELSE n END AS a FROM e
), words AS (
  SELECT r, doc_id, n, a, 1 + (n - a) // (3 + g % 8) AS p, w, unnest(range(0, n)) AS i FROM f
), word AS (
  SELECT r, n, i, w[(CASE WHEN i < a THEN i ELSE a + (i - a) % p END) + 1] AS word FROM words
), same AS (
  SELECT x.r, x.i, y.i - x.i AS q
  FROM word x JOIN word y ON x.r = y.r AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
), island AS (
  SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS k FROM same
), stretch AS (
  SELECT r, q, min(i) AS start, count(*) + q AS length FROM island GROUP BY r, q, k
), run AS (
  SELECT r, start, length, min(q) AS period FROM stretch
  WHERE length >= 6 AND length >= 4 * q GROUP BY r, start, length
), top AS (
  SELECT r, start, length, period FROM run
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY length::DOUBLE / period DESC, start, period) = 1
), listed AS (
  SELECT r, count(*) AS n_runs,
    string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs
  FROM run GROUP BY r
), gone AS (
  SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM run
), kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY i) AS words FROM word ANTI JOIN gone USING (r, i) GROUP BY r
)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length,
  period::BIGINT AS period, (1000 * length // period)::BIGINT AS exponent_milli,
  sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(words, '')) AS collapsed_sha256
FROM d LEFT JOIN top USING (r) LEFT JOIN listed USING (r) LEFT JOIN kept USING (r)
"""


def _leaf(text: str) -> str:
    fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({f})) || ':' || {f}, '-')" for f in fields) + ")"


MERKLE_MANIFEST = rf"""
WITH RECURSIVE {_CRC_TABLE}, d AS (
  SELECT doc_id, lang, {_leaf("text")} AS leaf,
    CASE WHEN {_crc32("doc_id::VARCHAR")} % 3 = 0
      THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS new_leaf
  FROM documents, crc_table
), rows AS (
  SELECT *, row_number() OVER () AS r, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM d
), tree(g, level, pos, node, n) AS (
  SELECT g, 0::BIGINT, pos, leaf, count(*) OVER (PARTITION BY g) FROM rows
  UNION ALL
  SELECT g, any_value(level) + 1, pos // 8, sha256(string_agg(node, '' ORDER BY pos)), any_value((n + 7) // 8)
  FROM tree WHERE n > 1 GROUP BY g, pos // 8
), sub AS (
  SELECT g, node AS subroot FROM tree WHERE n = 1
), over_tree(level, pos, node, n) AS (
  SELECT 0::BIGINT, g, subroot, count(*) OVER () FROM sub
  UNION ALL
  SELECT any_value(level) + 1, pos // 8, sha256(string_agg(node, '' ORDER BY pos)), any_value((n + 7) // 8)
  FROM over_tree WHERE n > 1 GROUP BY pos // 8
), root AS (
  SELECT node AS root FROM over_tree WHERE n = 1
), nodes AS (
  SELECT g, level, pos, node, n FROM tree UNION ALL SELECT NULL, level, pos, node, n FROM over_tree
), beside AS (
  SELECT g, level, pos, n,
    coalesce(string_agg(node, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
    coalesce(string_agg(node, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM nodes WHERE n > 1 WINDOW run AS (PARTITION BY g, level, pos // 8 ORDER BY pos)
), low(r, g, level, pos, node, proof) AS (
  SELECT r, g, 0::BIGINT, pos, coalesce(new_leaf, leaf), '' FROM rows
  UNION ALL
  SELECT r, low.g, low.level + 1, low.pos // 8, sha256(before || node || after), proof || before || after
  FROM low JOIN beside b ON low.g = b.g AND low.level = b.level AND low.pos = b.pos
), high(r, level, pos, node, proof) AS (
  SELECT r, 0::BIGINT, g, node, proof FROM low QUALIFY row_number() OVER (PARTITION BY r ORDER BY level DESC) = 1
  UNION ALL
  SELECT r, high.level + 1, high.pos // 8, sha256(before || node || after), proof || before || after
  FROM high JOIN beside b ON b.g IS NULL AND high.level = b.level AND high.pos = b.pos
), top AS (
  SELECT * FROM high QUALIFY row_number() OVER (PARTITION BY r ORDER BY level DESC) = 1
)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, node AS folded_root, node = root AS verified
FROM rows JOIN sub USING (g) JOIN top USING (r) CROSS JOIN root
"""


def build() -> dict[str, str]:
    return {
        "op8_quality_rules": QUALITY_RULES,
        "op11_periodic_runs": PERIODIC_RUNS,
        "op12_merkle_manifest": MERKLE_MANIFEST,
    }
