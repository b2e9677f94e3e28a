"""The queries that SQL can express, written for DuckDB over the same tables."""

from __future__ import annotations

from namepulse.llm.licenses import LEAST, LOWER, TEMPLATES, UPPER, share

_P, _Q = share(LEAST)
_SPACES = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _low(text: str) -> str:
    return f"translate({text}, '{UPPER}', '{LOWER}')"


_LINE_DEDUP = f"""
WITH cut AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM cut),
keyed AS (SELECT *, {_low(f"trim(line, {_SPACES})")} AS key FROM lines),
frequent AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (f.key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN frequent f ON k.key = f.key GROUP BY doc_id
"""

# A turn costs its two marks and a line feed, and each thing escaped one or two characters more.
_CHAT = r"""
WITH said AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
),
turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS place
  FROM said
),
read AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY place) AS turns,
    coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '') AS learned,
    sum(length('<|im_start|><|im_end|>') + 2 + length(role) + 2 * len(regexp_extract_all(role, '[%\n|]'))
      + length(text) + len(regexp_extract_all(text, '<\\*\|')))::BIGINT AS formatted_chars
  FROM turns GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(learned) AS loss_chars, sha256(learned) AS loss_sha256, formatted_chars FROM read
"""

_JACCARD = rf"""
WITH RECURSIVE cut AS (
  SELECT doc_id, regexp_extract_all({_low("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS words FROM documents
),
sets AS (
  SELECT doc_id, CASE
    WHEN len(words) = 0 THEN []
    WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' '))) END AS shingles
  FROM cut
),
rows AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS common
  FROM rows a JOIN rows b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
),
links AS (SELECT a, b FROM shared WHERE 100 * common >= 85 * (n + m - common)),
reach AS (
  SELECT doc_id AS id, doc_id AS seen FROM documents
  UNION SELECT r.id, l.b FROM reach r JOIN links l ON r.seen = l.a
),
least AS (SELECT id, min(seen) AS component_id FROM reach GROUP BY id)
SELECT doc_id, len(shingles) AS n_shingles, component_id FROM sets JOIN least ON doc_id = id
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_GIVEN = ", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in sorted(set(TEMPLATES)))
_WORDS = "list_filter(string_split(regexp_replace({}, '[^a-z0-9]+', ' ', 'g'), ' '), lambda w: w <> '')"


def _bigrams(text: str) -> str:
    return f"SELECT *, list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS bigrams FROM (SELECT *, {_WORDS.format(_low(text))} AS words FROM {{}})"


_LICENSES = f"""
WITH given(license, template) AS (VALUES {_GIVEN}),
cut AS (SELECT doc_id, string_split(text, chr(10)) AS lines, text FROM documents WHERE text IS NOT NULL),
units AS (
  SELECT doc_id, 0 AS line_no, text AS unit FROM cut
  UNION ALL SELECT doc_id, generate_subscripts(lines, 1), unnest(lines) FROM cut
),
ours AS ({_bigrams("unit").format("units")}),
theirs AS ({_bigrams("template").format("given")}),
scored AS (
  SELECT doc_id, line_no, license, len(list_intersect(o.bigrams, t.bigrams)) AS shared, len(o.bigrams) + len(t.bigrams) AS sizes, 2 * shared / sizes AS dice
  FROM ours o JOIN theirs t ON len(o.bigrams) > 0
    AND {2 * _Q} * least(len(o.bigrams), len(t.bigrams)) >= {_P} * (len(o.bigrams) + len(t.bigrams))
)
SELECT doc_id, line_no::BIGINT AS line_no, arg_min(license, (-dice, license)) AS license, round(max(dice), 6) AS dice
FROM scored WHERE {2 * _Q} * shared >= {_P} * sizes GROUP BY doc_id, line_no
"""

_COLLOCATIONS = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_low("text")}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
),
cut AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
sizes AS (SELECT lang, sum(len(words))::BIGINT AS n FROM cut GROUP BY lang),
grams AS (
  SELECT lang, size, array_to_string(words[place:place + size - 1], ' ') AS phrase
  FROM (SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS place FROM cut, range(1, 6) sizes(size))
),
counted AS (SELECT lang, size, phrase, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 100),
candidates AS (SELECT *, string_split(phrase, ' ') AS words FROM counted WHERE size > 1),
cuts AS (
  SELECT lang, phrase, a, k, array_to_string(words[1:k], ' ') AS head, array_to_string(words[k + 1:], ' ') AS tail
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates)
),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, h.a AS l, t.a AS r, n, ((1000::HUGEINT * c.a * n) // (h.a::HUGEINT * t.a))::BIGINT AS score
  FROM cuts c JOIN counted h ON h.lang = c.lang AND h.phrase = c.head JOIN counted t ON t.lang = c.lang AND t.phrase = c.tail
    JOIN sizes s ON s.lang = c.lang
),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT DISTINCT lang, a, array_to_string(words[place:place + part - 1], ' ') AS phrase
  FROM (
    SELECT *, unnest(range(1, size - part + 2)) AS place FROM (SELECT *, unnest(range(2, size)) AS part FROM candidates)
  )
),
held AS (SELECT DISTINCT b.lang, b.phrase FROM best b JOIN inside i ON b.lang = i.lang AND b.phrase = i.phrase AND 100 * i.a >= 100 * b.a),
ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
  FROM best b ANTI JOIN held h ON b.lang = h.lang AND b.phrase = h.phrase
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""

_TERMS = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"

_SEARCH = rf"""
WITH cut AS (SELECT doc_id, regexp_extract_all({_low("coalesce(text, '')")}, {_TERMS}) AS terms FROM documents),
sizes AS (SELECT count(*) FILTER (len(terms) > 0) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM cut),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all({_low("coalesce(text, '')")}, {_TERMS})) AS term FROM benchmark
),
rows AS (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM cut),
held AS (SELECT doc_id, n, term, count(*) AS tf FROM rows SEMI JOIN asked USING (term) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM held, sizes GROUP BY term
),
worth AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms))) AS impact
  FROM held JOIN weights USING (term), sizes
),
scored AS (SELECT item_id, doc_id, sum(impact)::BIGINT AS score FROM asked JOIN worth USING (term) GROUP BY item_id, doc_id),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM scored WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 50
"""

ORACLE_SQL: dict[str, str] = {
    "op3_license_scan": _LICENSES,
    "op4_chat_formatting": _CHAT,
    "op6_line_dedup": _LINE_DEDUP,
    "op7_jaccard_join": _JACCARD,
    "op12_lexical_search": _SEARCH,
    "op13_collocations": _COLLOCATIONS,
}
