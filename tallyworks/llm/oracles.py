"""SQL that gives the rows of a query, where SQL can."""

from __future__ import annotations

#: Lower-casing of A-Z alone, and the words of a text.
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

NEAR_DUPLICATES = f"""
WITH RECURSIVE split AS (SELECT doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] END AS g
  FROM split, unnest(range(1, greatest(len(w) - 1, 2))) AS t(i) WHERE len(w) > 0
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (
  SELECT s.a, s.b FROM shared s JOIN sizes x ON x.doc_id = s.a JOIN sizes y ON y.doc_id = s.b WHERE 100 * s.n >= 85 * (x.n + y.n - s.n)
),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
lowest AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, least(d.doc_id, coalesce(l.low, d.doc_id)) AS component_id,
  least(d.doc_id, coalesce(l.low, d.doc_id)) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN lowest l ON l.a = d.doc_id
"""

REPETITION = rf"""
WITH split AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM split),
windows AS (
  SELECT doc_id, i, i + 3 <= len(w) + 1 AS fits3, i + 5 <= len(w) + 1 AS fits5, i + 101 <= len(w) + 1 AS fits101,
    array_to_string(w[i:i + 2], ' ') AS g3, array_to_string(w[i:i + 4], ' ') AS g5, md5(array_to_string(w[i:i + 100], ' ')) AS g101
  FROM places
),
counted AS (
  SELECT doc_id, i,
    fits3 AND count(*) FILTER (fits3) OVER (PARTITION BY doc_id, g3) > 1 AS r3,
    fits5 AND count(*) FILTER (fits5) OVER (PARTITION BY doc_id, g5) > 1 AS r5,
    fits101 AND count(*) FILTER (fits101) OVER (PARTITION BY doc_id, g101) > 1 AS r101
  FROM windows
),
covered AS (
  SELECT doc_id, bool_or(r3) OVER (PARTITION BY doc_id ORDER BY i ROWS 2 PRECEDING) AS c3,
    bool_or(r5) OVER (PARTITION BY doc_id ORDER BY i ROWS 4 PRECEDING) AS c5, r101
  FROM counted
),
repeats AS (
  SELECT doc_id, count(*) FILTER (c3) AS n_repeat_words, count(*) FILTER (c5) AS n_covered_words, bool_or(r101) AS long_repeat
  FROM covered GROUP BY doc_id
),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM split)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
),
base AS (
  SELECT s.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_covered_words, 0) AS n_covered_words, coalesce(long_repeat, false) AS long_repeat
  FROM split s LEFT JOIN lines USING (doc_id) LEFT JOIN repeats USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_covered_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * n_covered_words <= 30 * n_words AND NOT long_repeat AS kept
FROM base
"""

#: Unsigned crc32 of a text of ASCII characters, bit by bit.
_CRC32 = (
    "xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({}, ''), lambda x: ord(x)::BIGINT)), "
    "lambda s, b: list_reduce(list_concat([xor(s, b)], range(8)), lambda a, i: xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END))))"
)

PREFIX_TRIE = rf"""
WITH turns AS (
  SELECT conv_id AS c, {{'r': coalesce(role, ''), 't': coalesce(text, '')}} AS u,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (SELECT c, list(u ORDER BY k) AS us, {_CRC32.format("c::VARCHAR")} % 4 AS h FROM turns GROUP BY c),
built AS (
  SELECT a.c, list_concat(coalesce(b.us[1:a.h], []), a.us[a.h + 1:]) AS p FROM convs a LEFT JOIN convs b ON b.c = a.c - a.c % 20
),
beginnings AS (SELECT c, len(p) AS n, d, p[1:d] AS p FROM built, unnest(range(0, len(p) + 1)) AS t(d)),
grouped AS (
  SELECT d, p, min(c) AS c, count(*) AS n_convs, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = d), '') AS ends
  FROM beginnings GROUP BY d, p
),
nodes AS (
  SELECT row_number() OVER () AS id, *, (n_convs - 1) * CASE WHEN d = 0 THEN 0 ELSE len({_WORDS.format("p[d].t")}) END AS saved FROM grouped
),
above AS (SELECT id, d AS depth, saved, e, p[1:e] AS q FROM nodes, unnest(range(0, d + 1)) AS t(e)),
children AS (SELECT e AS d, q AS p, count(*) AS n FROM above WHERE depth = e + 1 GROUP BY ALL),
leaves AS (SELECT n.id FROM nodes n ANTI JOIN children c ON c.d = n.d AND c.p = n.p),
below AS (SELECT e AS d, q AS p, sum(saved) AS saved, count(l.id) AS n FROM above LEFT JOIN leaves l USING (id) GROUP BY e, q)
SELECT n.c AS conv_id, n.d AS depth, up.c AS parent_conv_id, n.n_convs, coalesce(ch.n, 0) AS n_children, b.n AS n_leaves,
  b.saved AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n JOIN below b ON b.d = n.d AND b.p = n.p LEFT JOIN children ch ON ch.d = n.d AND ch.p = n.p
LEFT JOIN nodes up ON up.d = n.d - 1 AND up.p = n.p[1:n.d - 1]
"""

COLLOCATIONS = rf"""
WITH texts AS (SELECT coalesce(lang, 'und') AS lang, {_LOWER.format("coalesce(text, '')")} AS text FROM documents),
cut AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?
-
]')) AS piece FROM texts),
pieces AS (SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w FROM cut),
totals AS (SELECT lang, sum(len(w)) AS n FROM pieces GROUP BY lang),
counts AS (
  SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS p, k, count(*) AS f
  FROM pieces, unnest(range(1, 5)) AS s(k), unnest(range(1, len(w) - k + 2)) AS t(i) GROUP BY ALL
),
phrases AS (SELECT lang, p, k, f AS a, string_split(p, ' ') AS w FROM counts WHERE k > 1 AND f >= 30),
cuts AS (
  SELECT o.lang, o.p, o.k, o.a, o.j, x.f AS l, y.f AS r, (2000000::HUGEINT * o.a) // (x.f::HUGEINT + y.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM phrases) o
  JOIN counts x ON x.lang = o.lang AND x.p = array_to_string(o.w[1:o.j], ' ')
  JOIN counts y ON y.lang = o.lang AND y.p = array_to_string(o.w[o.j + 1:], ' ')
),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, j) = 1),
inside AS (
  SELECT DISTINCT b.lang, b.p FROM phrases b JOIN phrases o
  ON o.lang = b.lang AND o.k > b.k AND 100::HUGEINT * o.a >= 80::HUGEINT * b.a AND contains(' ' || o.p || ' ', ' ' || b.p || ' ')
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS place FROM best ANTI JOIN inside USING (lang, p)
)
SELECT lang, place AS rank, p AS phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE place <= 2000
"""

ORACLES = {
    "op3_minhash_dedup": NEAR_DUPLICATES,
    "op6_repetition_rules": REPETITION,
    "op12_prefix_trie": PREFIX_TRIE,
    "op13_collocations": COLLOCATIONS,
}
