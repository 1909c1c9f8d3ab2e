"""DuckDB SQL of the registered queries that SQL can express, written from the
contracts: joins and windows over whole tables instead of runs, automata,
sketches or files.  Main-text extraction, tokenizer, trie scores, TF-IDF
cosines, multinomial draws and the pipeline have none; the tests hold them
against plain versions.
"""

from __future__ import annotations

from framewise.llm.chat import END, ESCAPE, NEXT, SAYS, TURN
from framewise.llm.line_rules import MAX_DOCS, MAX_REPEAT_PCT, MIN_LEFT, MIN_WORDS

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORD = r"'[^\x20\x09-\x0D]+'"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def _lower(c: str) -> str:
    return f"translate({c}, '{_UPPER}', '{_UPPER.lower()}')"


def _lines(columns: str) -> str:
    """(columns, i, line, key) of every line of documents; r numbers the rows."""
    return (f"docs AS (SELECT {columns}, text, row_number() OVER () AS r, "
            "string_split(coalesce(text, ''), chr(10)) AS ls FROM documents), "
            f"pos AS (SELECT r, {columns}, ls, unnest(range(1, len(ls) + 1)) AS i FROM docs), "
            f"lines AS (SELECT r, {columns}, i, ls[i] AS line, {_lower(f'trim(ls[i], {_BLANK})')} AS key FROM pos)")


_OP2 = f"""
WITH {_lines('doc_id')},
frequent AS (SELECT key FROM lines WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE key IN (SELECT key FROM frequent)) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i)
              FILTER (WHERE key NOT IN (SELECT key FROM frequent)), '')) AS kept_sha256
FROM lines GROUP BY r, doc_id"""

_OP5 = f"""
WITH iw AS (SELECT item_id, regexp_extract_all({_lower("coalesce(text, '')")}, {_ALNUM}) AS w FROM benchmark),
windows AS (SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, n,
                   array_to_string(list_slice(w, i, i + n - 1), ' ') AS window
            FROM (SELECT item_id, w, least(len(w), 13) AS n, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i
                  FROM iw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
dw AS (SELECT doc_id, row_number() OVER () AS r,
              regexp_extract_all({_lower("coalesce(text, '')")}, {_ALNUM}) AS w FROM documents),
found AS (SELECT d.r, d.i, d.n, x.item FROM
          (SELECT r, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS window FROM
           (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, sizes WHERE len(w) >= n)) d
          JOIN windows x ON x.n = d.n AND x.window = d.window),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM
        (SELECT r, unnest(range(i, i + n)) AS p FROM found) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN hit USING (r) LEFT JOIN items USING (r)"""


def _escaped(c: str) -> str:
    to = ESCAPE[1].replace("$", "\\")
    return f"regexp_replace(coalesce({c}, ''), '{ESCAPE[0]}', '{to}', 'g')"


_ODD = "</s>[INST] ok [/INST]"
_OP6 = f"""
WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
              UNION ALL SELECT -7, 0, 'user', '{_ODD}' UNION ALL SELECT -7, 1, 'assistant', '{_ODD}'),
e AS (SELECT *, {_escaped('role')} AS er, {_escaped('text')} AS et FROM rows),
m AS (SELECT *, lag(er) OVER (PARTITION BY conv_id ORDER BY turn, er, et) AS before FROM e)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, er, et)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, er, et) FILTER (WHERE role = 'assistant'), ''))
         AS loss_sha256,
       CAST(sum(length(et) + CASE WHEN before IS NULL THEN {len(TURN + SAYS)} + length(er)
                                  WHEN before = er THEN {len(NEXT)}
                                  ELSE {len(END + TURN + SAYS)} + length(er) END) + {len(END)} AS BIGINT)
         AS formatted_chars
FROM m GROUP BY conv_id"""

_OP7 = f"""
WITH {_lines('doc_id, source')},
content AS (SELECT r, md5(string_agg(key, chr(10) ORDER BY i)) AS content FROM lines WHERE key <> '' GROUP BY r),
often AS (SELECT source, key, min(doc_id) AS first FROM lines JOIN content USING (r) WHERE key <> ''
          GROUP BY source, key HAVING count(DISTINCT content) > {MAX_DOCS}),
boiler AS (SELECT l.r, sum(length(translate(l.key, {_BLANK}, ''))) AS chars FROM lines l
           JOIN often o ON o.source IS NOT DISTINCT FROM l.source AND o.key = l.key
           AND o.first IS DISTINCT FROM l.doc_id GROUP BY l.r),
w AS (SELECT r, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {_WORD}) AS w FROM docs),
grams AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
          FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY r),
dup AS (SELECT r, count(*) AS n FROM (SELECT r, line, row_number() OVER (PARTITION BY r, line ORDER BY i) AS k
        FROM lines WHERE regexp_matches(line, {_WORD})) WHERE k > 1 GROUP BY r),
s AS (SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words,
             CAST(length(array_to_string(w.w, '')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(w.text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             coalesce(dup.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
             CAST(coalesce(boiler.chars, 0) AS BIGINT) AS boiler_chars
      FROM w LEFT JOIN dup USING (r) LEFT JOIN rep USING (r) LEFT JOIN boiler USING (r)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words AS base_failed FROM s)
SELECT *, NOT base_failed AND (boiler_chars = 0 OR word_chars - boiler_chars >= {MIN_LEFT} * word_chars) AS kept
FROM b"""

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_DIGIT = f"substr('{_BASE32}', CAST((v // {{}}) % 32 AS INTEGER) + 1, 1)"
_OP8 = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, html, octet_length(encode(html)) AS n, upper(sha1(html)) AS h FROM p),
f AS (SELECT html, min(page_id) AS first FROM p GROUP BY html),
five AS (SELECT *, list_transform(range(8), lambda k: CAST('0x' || substr(h, k * 5 + 1, 5) AS INTEGER)) AS vs FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(vs, lambda v: {" || ".join(_DIGIT.format(32 ** k) for k in (3, 2, 1, 0))}), '')
         AS payload_digest,
       CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM five JOIN f USING (html)"""

_OP9 = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, {_WORD}) AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id
          GROUP BY 1, 2),
links AS (SELECT a, b FROM both_ JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
          WHERE 100 * k >= 85 * (x.n + y.n - k)),
near AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT a, a FROM near UNION SELECT reach.a, near.b FROM reach JOIN near ON near.a = reach.b),
comp AS (SELECT a AS doc_id, min(b) AS c FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(comp.c, w.doc_id) AS component_id,
       coalesce(comp.c, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN comp USING (doc_id)"""

_OP11 = f"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                {_lower("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
grams AS (SELECT lang, list_slice(w, i, i + k - 1) AS p FROM
          (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
           FROM w, (VALUES (1), (2), (3)) AS sizes(k) WHERE len(w) >= k)),
f AS (SELECT lang, p, count(*) AS a FROM grams GROUP BY lang, p),
totals AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE len(p) = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE len(p) > 1 AND a >= 10),
inside AS (SELECT lang, q, max(a) AS most FROM
           (SELECT lang, a, unnest([list_slice(p, 1, len(p) - 1), list_slice(p, 2, len(p))]) AS q FROM c)
           GROUP BY lang, q),
left_ AS (SELECT c.* FROM c LEFT JOIN inside i ON i.lang = c.lang AND i.q = c.p
          WHERE i.most IS NULL OR 100 * i.most < 50 * c.a),
cuts AS (SELECT lang, p, a, unnest(range(1, len(p))) AS k FROM left_),
scored AS (SELECT c.lang, c.p, c.a, c.k, l.a AS l, r.a AS r,
                  (CAST(1000000 AS HUGEINT) * c.a * c.a) // (CAST(l.a AS HUGEINT) * r.a) AS score
           FROM cuts c JOIN f l ON l.lang = c.lang AND l.p = list_slice(c.p, 1, c.k)
           JOIN f r ON r.lang = c.lang AND r.p = list_slice(c.p, c.k + 1, len(c.p))),
lowest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, k) AS o FROM scored)
           WHERE o = 1),
ranked AS (SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, CAST(score AS BIGINT) AS score,
                  row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank
           FROM lowest)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""

# crc32 by bits: a byte is mixed in, then eight steps (-1) follow
_CRC_STEPS = "flatten(list_transform(range(1, length({0}) + 1), lambda i: [ord({0}[i]), -1, -1, -1, -1, -1, -1, -1, -1]))"
_CRC32 = (f"xor(list_reduce([4294967295::BIGINT] || {_CRC_STEPS}, lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) "
          "WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END), 4294967295::BIGINT)")
_OP12 = f"""
WITH turns AS (SELECT conv_id, turn, coalesce(text, '') AS text,
                      md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS key
               FROM conversations),
convs AS (SELECT conv_id, list({{'key': key, 'words': len(regexp_extract_all(text, {_WORD}))}}
                               ORDER BY turn NULLS FIRST, key) AS ts FROM turns GROUP BY conv_id),
heads AS (SELECT *, coalesce({_CRC32.format("CAST(conv_id AS VARCHAR)")} % 4, 0) AS h FROM convs),
paths AS (SELECT c.conv_id, list_slice(coalesce(b.ts, []), 1, c.h) || list_slice(c.ts, c.h + 1, len(c.ts)) AS ts
          FROM heads c LEFT JOIN convs b ON b.conv_id = c.conv_id - c.conv_id % 20),
p AS (SELECT conv_id, len(ts) AS size, list_transform(ts, lambda t: t.key) AS keys,
             list_transform(ts, lambda t: t.words) AS words FROM paths),
steps AS (SELECT conv_id, size, d, list_slice(keys, 1, d) AS node, CASE WHEN d = 0 THEN 0 ELSE words[d] END AS words
       FROM (SELECT *, unnest(range(0, size + 1)) AS d FROM p)),
nodes AS (SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
                 string_agg(coalesce(CAST(conv_id AS VARCHAR), 'null'), ',' ORDER BY conv_id NULLS FIRST)
                   FILTER (WHERE size = d) AS ends FROM steps GROUP BY node, d),
kids AS (SELECT list_slice(node, 1, d - 1) AS node, count(*) AS k FROM nodes WHERE d > 0 GROUP BY 1),
all_ AS (SELECT n.*, coalesce(k, 0) AS k FROM nodes n LEFT JOIN kids USING (node)),
below AS (SELECT node, sum(leaf) AS n_leaves, sum(saved) AS saved FROM
          (SELECT CASE WHEN k = 0 THEN 1 ELSE 0 END AS leaf, (n_convs - 1) * words AS saved,
                  list_slice(node, 1, i) AS node FROM (SELECT *, unnest(range(0, d + 1)) AS i FROM all_)) GROUP BY node)
SELECT a.conv_id, CAST(a.d AS BIGINT) AS depth, u.conv_id AS parent_conv_id, a.n_convs, a.k AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
       sha256(coalesce(a.ends, '')) AS ends_sha256
FROM all_ a JOIN below USING (node) LEFT JOIN nodes u ON a.d > 0 AND u.node = list_slice(a.node, 1, a.d - 1)"""

SQL: dict[str, str] = {
    "op2_line_dedup": _OP2,
    "op5_decontamination": _OP5,
    "op6_chat_formatting": _OP6,
    "op7_quality_rules": _OP7,
    "op8_warc": _OP8,
    "op9_minhash_near_dedup": _OP9,
    "op11_collocations": _OP11,
    "op12_prefix_trie": _OP12,
}
