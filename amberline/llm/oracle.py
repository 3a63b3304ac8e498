"""The queries in DuckDB SQL, where SQL expresses them over whole tables."""

from __future__ import annotations

from amberline.llm.licences import BASE_PHRASES, FREEDOM, NOTICE_PHRASES
from amberline.llm.quality_lines import BOILERPLATE, MAX_LOST, SENTENCE_MARK, WORDS_PER_SEPARATOR
from amberline.llm.turn_repair import END_MARKS, INSERT, UNDELETED_TRUNCATED

WHITE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = f"list_filter(string_split_regex({{}}, '{WHITE}'), lambda w: w <> '')"
_SQ = SENTENCE_MARK.replace("'", "''")
_BIT = "(ascii(bits[5 * i + {}]) - 48)"
_FIVE = " + ".join(f"{_BIT.format(k)} * {1 << (5 - k)}" for k in range(1, 6))

# Components of links (x, y): the smallest id reachable.
_COMPONENTS = """
ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach(x, y) AS (SELECT x, y FROM ways UNION SELECT r.x, b.y FROM reach r JOIN ways b ON r.y = b.x),
component AS (SELECT x, least(x, min(y)) AS c FROM reach GROUP BY x)
"""

_LABELS = {**BASE_PHRASES, **NOTICE_PHRASES}
_HAS = "list_filter([{}], lambda l: l <> '')".format(", ".join(f"CASE WHEN contains(line, ' {p} ') THEN '{label}' ELSE '' END" for p, label in _LABELS.items()))
_HAS_BASE = "list_filter([{}], lambda l: l <> '')".format(", ".join(f"CASE WHEN contains(line, ' {p} ') THEN '{label}' ELSE '' END" for p, label in BASE_PHRASES.items()))
_STARTS = " OR ".join(f"array_to_string(words[i + 1 : i + {len(p.split())}], ' ') = '{p}'" for p in BASE_PHRASES)
_FREE = "CASE l " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in FREEDOM.items()) + " END"

ORACLE = {
    "op1_warc": f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS m, from_hex(h)::BIT::VARCHAR AS bits FROM p)
SELECT page_id, n AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + {_FIVE} AS BIGINT), 1)), '') AS payload_digest,
  CASE WHEN page_id = m THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> m THEN m END AS refers_to
FROM f""",
    "op2_quality": f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS i FROM d),
j AS (SELECT *, regexp_matches(line, '[^\\x20\\x09-\\x0D]') AS has,
    len(regexp_replace(line, '[^|»›•·]+', '', 'g')) AS marks, len(string_split_regex(trim(line), '{WHITE}')) AS n FROM l),
k AS (SELECT *, has AND (marks > 0 AND marks * {WORDS_PER_SEPARATOR} >= n
    OR regexp_matches(lower(line), '{BOILERPLATE}') AND n <= 25 OR NOT regexp_matches(line, '{_SQ}')) AS fails FROM j),
g AS (SELECT doc_id, count(*) FILTER (WHERE fails) AS n_lines_removed,
    coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT fails), '') AS clean,
    count(*) FILTER (WHERE has) - count(DISTINCT line) FILTER (WHERE has) AS n_dup_lines FROM k GROUP BY doc_id),
v AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) AS win,
    unnest(range(1, len(w) - 3)) AS i FROM d),
x AS (SELECT doc_id, i FROM v QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
y AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM x, (SELECT unnest(range(5)) AS o) GROUP BY doc_id),
b AS (SELECT d.doc_id, len(w) AS n_words, len(array_to_string(w, '')) AS word_chars,
    len(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, n_dup_lines, coalesce(y.n, 0) AS n_repeat_words, n_lines_removed,
    CASE WHEN len(array_to_string(w, '')) = 0 THEN 0.0::DOUBLE
      ELSE 1 - len(regexp_replace(clean, '{WHITE}', '', 'g'))::DOUBLE / len(array_to_string(w, ''))::DOUBLE END AS lost
  FROM d JOIN g USING (doc_id) LEFT JOIN y USING (doc_id)),
e AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND lost <= {MAX_LOST} AS kept, n_lines_removed, lost
FROM e""",
    "op5_jaccard": f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')")} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i : i + 2], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM i JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 90 * (p.n + q.n - c)),
{_COMPONENTS}
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(component.c, d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN component ON component.x = d.doc_id""",
    # The given tables hold no identifier tag; expressions are tested against a brute-force version.
    "op9_licences": f"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS words FROM documents),
e AS (SELECT *, ' ' || array_to_string(words, ' ') || ' ' AS line,
    list_filter(range(len(words)), lambda i: {_STARTS}) AS starts FROM d),
f AS (SELECT *, {_HAS} AS found, {_HAS_BASE} AS base FROM e)
SELECT doc_id, len(words) AS n_words, len(starts) AS n_base, list_min(starts) AS first_word, list_max(starts) AS last_word,
  array_to_string(list_sort(list_distinct(base)), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(found)), ',') AS labels,
  coalesce(list_min(list_transform(found, lambda l: CAST({_FREE} AS DOUBLE))), 0.5::DOUBLE) AS score
FROM f""",
    "op10_embeddings": f"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
u AS (SELECT vec_id, e FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b ON a.vec_id < b.vec_id AND len(a.e) = len(b.e)
    WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
{_COMPONENTS},
n AS (SELECT x, count(*) AS n FROM ways GROUP BY x)
SELECT vec_id, coalesce(n.n, 0) AS n_links, coalesce(component.c, vec_id) AS component_id, coalesce(component.c, vec_id) = vec_id AS kept
FROM v LEFT JOIN component ON component.x = vec_id LEFT JOIN n ON n.x = vec_id""",
    "op11_turn_repair": f"""
WITH RECURSIVE base AS (SELECT coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text FROM conversations),
crc AS (SELECT list_transform(range(256), lambda i: list_reduce([i] || range(8), lambda c, _: xor(c >> 1, (c & 1) * 3988292384))) AS tab),
ids AS (SELECT conv_id, row_number() OVER () AS c FROM (SELECT DISTINCT conv_id FROM conversations)),
h AS (SELECT *, xor(list_reduce([4294967295] || list_transform(range(1, length(k) + 1), lambda i: CAST(ascii(k[i]) AS BIGINT)),
    lambda c, b: xor(c >> 8, tab[1 + (xor(c, b) & 255)])), 4294967295) % 20 AS kind FROM base, crc),
v AS (SELECT c, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '{END_MARKS}', '') ELSE text END AS text, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM h JOIN ids ON h.conv_id IS NOT DISTINCT FROM ids.conv_id WHERE kind <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, md5(text)) AS i, regexp_replace(text, '{WHITE}$', '') AS bare FROM v),
f AS (SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN NOT contains('{END_MARKS}', right(bare, 1)) THEN 'truncated' ELSE '' END AS fault, left(role, 1) AS letter,
    lag(left(role, 1)) OVER (PARTITION BY c ORDER BY i) || left(role, 1) AS pair FROM o),
n AS (SELECT c, max(i) AS n, count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal,
    coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps FROM f GROUP BY c),
back(c, i, e, s, u, a) AS (
  SELECT c, n, {{'c': 0, 't': ''}}, {{'c': {2 * INSERT}, 't': 'II'}}, {{'c': {INSERT}, 't': 'I'}}, {{'c': 0, 't': ''}} FROM n
  UNION ALL
  SELECT c, i - 1, list_min([e1, {{'c': u2.c + {INSERT}, 't': 'I' || u2.t}}]), list_min([s1, {{'c': u2.c + {INSERT}, 't': 'I' || u2.t}}]), u2, a2
  FROM (SELECT *, list_min([u1, {{'c': a1.c + {INSERT}, 't': 'I' || a1.t}}]) AS u2, list_min([a1, {{'c': u1.c + {INSERT}, 't': 'I' || u1.t}}]) AS a2
    FROM (SELECT c, i, list_min([d.e, CASE WHEN may THEN ru END, CASE WHEN may AND letter = 's' THEN ks WHEN may AND letter = 'u' THEN ku END]) AS e1,
        list_min([d.s, CASE WHEN may THEN ru END, CASE WHEN may AND letter = 'u' THEN ku END]) AS s1,
        list_min([d.u, CASE WHEN may THEN ra END, CASE WHEN may AND letter = 'a' THEN ka END]) AS u1,
        list_min([d.a, CASE WHEN may THEN ru END, CASE WHEN may AND letter = 'u' THEN ku END]) AS a1
      FROM (SELECT b.c, b.i, letter, fault NOT IN ('blank', 'duplicate') AS may, CASE WHEN fault = 'truncated' THEN {UNDELETED_TRUNCATED} ELSE 0 END AS extra,
          {{'e': {{'c': e.c + 2, 't': 'D' || e.t}}, 's': {{'c': s.c + 2, 't': 'D' || s.t}}, 'u': {{'c': u.c + 2, 't': 'D' || u.t}}, 'a': {{'c': a.c + 2, 't': 'D' || a.t}}}} AS d,
          {{'c': s.c + extra, 't': 'K' || s.t}} AS ks, {{'c': u.c + extra, 't': 'K' || u.t}} AS ku, {{'c': a.c + extra, 't': 'K' || a.t}} AS ka,
          {{'c': u.c + extra + 1, 't': 'R' || u.t}} AS ru, {{'c': a.c + extra + 1, 't': 'R' || a.t}} AS ra
        FROM back b JOIN f ON f.c = b.c AND f.i = b.i)))),
best AS (SELECT c, e.c AS cost, e.t AS audit FROM back WHERE i = 0),
x AS (SELECT c, unnest(string_split(audit, '')) AS edit, generate_subscripts(string_split(audit, ''), 1) AS p FROM best WHERE audit <> ''),
y AS (SELECT *, count(*) FILTER (WHERE edit <> 'I') OVER q AS i, count(*) FILTER (WHERE edit <> 'D') OVER q AS j,
    count(*) FILTER (WHERE edit <> 'D') OVER (PARTITION BY c) AS all_out FROM x WINDOW q AS (PARTITION BY c ORDER BY p)),
z AS (SELECT y.c, string_agg(CASE WHEN edit = 'K' THEN role ELSE CASE WHEN (j + all_out) % 2 = 1 THEN 'user' ELSE 'assistant' END END
    || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY p) AS line FROM y LEFT JOIN f ON f.c = y.c AND f.i = y.i WHERE edit <> 'D' GROUP BY y.c)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(line, '')) AS repaired_sha256
FROM ids LEFT JOIN n USING (c) LEFT JOIN best USING (c) LEFT JOIN z USING (c)""",
    "op12_top_k": f"""
WITH v AS (SELECT row_number() OVER () AS line, vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.line, q.vec_id AS query_id, c.vec_id, CAST(coalesce(list_sum(list_transform(range(1, least(len(q.e), len(c.e)) + 1), lambda i: q.e[i] * c.e[i])), 0) AS BIGINT) AS score
  FROM v q JOIN v c ON q.line <> c.line WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY line ORDER BY score DESC, vec_id NULLS LAST) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op13_collocations": f"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
g AS (SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i : i + size - 1], ' '))) AS phrase
  FROM w, (SELECT unnest(range(1, 5)) AS size)),
f AS (SELECT lang, phrase, size, count(*) AS n FROM g GROUP BY ALL),
t AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
c AS (SELECT lang, phrase, size, n AS a, string_split(phrase, ' ') AS words FROM f WHERE size > 1 AND n >= 30),
k AS (SELECT lang, phrase, a, size, words, unnest(range(1, size)) AS k FROM c),
l AS (SELECT k.lang, k.phrase, a, k, x.n AS l, y.n AS r, CAST(CAST(2000000 AS HUGEINT) * a // (CAST(x.n AS HUGEINT) + y.n) AS BIGINT) AS score
  FROM k JOIN f x ON x.lang = k.lang AND x.phrase = array_to_string(words[1 : k], ' ') JOIN f y ON y.lang = k.lang AND y.phrase = array_to_string(words[k + 1 : k.size], ' ')),
b AS (SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
i AS (SELECT lang, a AS longer, unnest(flatten(list_transform(range(2, size), lambda s: list_transform(range(1, size - s + 2), lambda j: array_to_string(words[j : j + s - 1], ' '))))) AS phrase FROM c WHERE size > 2),
m AS (SELECT lang, phrase, max(longer) AS longer FROM i GROUP BY ALL),
o AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
  FROM b LEFT JOIN m ON m.lang = b.lang AND m.phrase = b.phrase WHERE longer IS NULL OR CAST(100 AS HUGEINT) * longer < CAST(80 AS HUGEINT) * a)
SELECT o.lang, rank, phrase, a, l, r, t.n, score FROM o JOIN t ON t.lang = o.lang WHERE rank <= 2000""",
}
