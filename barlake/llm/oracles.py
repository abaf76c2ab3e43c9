"""DuckDB SQL of the operators that SQL can express.

Not here, and tested against brute force instead: op2 (its split is a CRC-32, which DuckDB
lacks), op3 (weighted sampling and connected components), op9 (BPE merges), the pipeline.
"""

from __future__ import annotations

from barlake.llm import chat, decontaminate, lexical, licenses, repetition
from barlake.llm.queries import TRIAL, license_trial

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _windows(column: str, size: int) -> str:
    return f"unnest(list_transform(range(1, len({column}) - {size - 2}), lambda i: {{'i': i, 'k': array_to_string({column}[i:i + {size - 1}], ' ')}}))"


def _repeated(column: str, size: int) -> str:
    return f"""
    SELECT rid, w.i AS i FROM (SELECT rid, w, count(*) OVER (PARTITION BY rid, w.k) AS c
      FROM (SELECT rid, {_windows(column, size)} AS w FROM base WHERE len({column}) >= {size})) WHERE c > 1"""


OP1 = rf"""
WITH words AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, {_WORDS} AS ws FROM documents),
base AS (SELECT *, ws AS ts FROM words),
r3 AS ({_repeated("ws", 3)}),
c3 AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 3)) AS p FROM r3) GROUP BY rid),
rm AS ({_repeated("ts", repetition.MIN_REPEAT)}),
cm AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + {repetition.MIN_REPEAT})) AS p FROM rm) GROUP BY rid),
rx AS (SELECT DISTINCT rid FROM ({_repeated("ts", repetition.MAX_LONGEST + 1)})),
m AS (
  SELECT base.rid, doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
    coalesce(c3.n, 0) AS n_repeat_words, len(ts) AS n_tokens, coalesce(cm.n, 0) AS covered_tokens, rx.rid IS NOT NULL AS too_long
  FROM base LEFT JOIN c3 USING (rid) LEFT JOIN cm USING (rid) LEFT JOIN rx USING (rid)),
j AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, n_repeat_words, n_tokens,
  covered_tokens, base_failed, NOT base_failed AND NOT too_long AND 100 * covered_tokens <= {repetition.MAX_COVERED_PERCENT} * n_tokens AS kept
FROM j
"""

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_DEC_WORDS = rf"regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP4 = rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, {_DEC_WORDS} AS ws FROM documents),
items AS (SELECT row_number() OVER () AS iid, coalesce(CAST(item_id AS VARCHAR), 'null') AS item, {_DEC_WORDS} AS ws FROM benchmark),
iw AS (SELECT iid, item, n, w.i AS i, w.k AS k FROM (
  SELECT iid, item, least(len(ws), {decontaminate.WINDOW}) AS n,
    unnest(list_transform(range(1, len(ws) - least(len(ws), {decontaminate.WINDOW}) + 2), lambda i: {{'i': i, 'k': array_to_string(ws[i:i + least(len(ws), {decontaminate.WINDOW}) - 1], ' ')}})) AS w
  FROM items WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT rid, n, w.i AS p, w.k AS k FROM (
  SELECT rid, n, unnest(list_transform(range(1, len(ws) - n + 2), lambda i: {{'i': i, 'k': array_to_string(ws[i:i + n - 1], ' ')}})) AS w
  FROM docs, sizes WHERE len(ws) >= n)),
hits AS (SELECT rid, p, iid, item, i, n FROM dw JOIN iw USING (n, k)),
covered AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT rid, p, n FROM hits)) GROUP BY rid),
runs AS (SELECT rid, max(p) - min(p) + any_value(n) AS run FROM (
  SELECT *, p - row_number() OVER (PARTITION BY rid, iid, p - i ORDER BY p) AS island FROM hits) GROUP BY rid, iid, p - i, island),
longest AS (SELECT rid, max(run) AS longest_match FROM runs GROUP BY rid),
found AS (SELECT rid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM hits GROUP BY rid)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(longest_match, 0) AS longest_match,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM docs LEFT JOIN covered USING (rid) LEFT JOIN found USING (rid) LEFT JOIN longest USING (rid)
"""


def _canonical(text: str) -> str:
    out = f"regexp_replace(lower({text}), '{licenses.OWN_NOTICES}', ' ', 'g')"
    out = f"regexp_replace({out}, '(?m){licenses.COPYRIGHT_LINE}', ' ', 'g')"
    out = rf"' ' || trim(regexp_replace({out}, '[^\p{{L}}\p{{N}}]+', ' ', 'g')) || ' '"
    for old, new in licenses.SPELLINGS:
        out = f"replace({out}, ' {old} ', ' {new} ')"
    return f"sha256(trim({out}))"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_KNOWN = ", ".join(f"({_quoted(i)}, {_quoted(t)})" for i, t in licenses.known_texts())
OP6 = rf"""
WITH known AS (SELECT {_canonical("t")} AS digest, min(i) AS license_id FROM (VALUES {_KNOWN}) AS v(i, t) GROUP BY 1),
rows AS (SELECT doc_id, text FROM documents UNION ALL SELECT -1, {_quoted(license_trial())}),
docs AS (SELECT row_number() OVER () AS rid, doc_id, text, {_canonical("text")} AS digest FROM rows),
lines AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM docs),
notices AS (SELECT rid, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notices
  FROM (SELECT rid, {_canonical("line")} AS digest FROM lines) JOIN known USING (digest) GROUP BY rid)
SELECT doc_id, docs.digest, license_id, coalesce(notices, '') AS notices
FROM docs LEFT JOIN known USING (digest) LEFT JOIN notices USING (rid)
"""

OP7 = r"""
WITH d AS (SELECT DISTINCT doc_id, text FROM documents),
k AS (SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST, md5(text)) AS rid, doc_id, text, string_split(text, chr(10)) AS ls FROM d),
l AS (SELECT rid, x.i AS i, x.t AS t FROM (SELECT rid, unnest(list_transform(range(1, len(ls) + 1), lambda i: {'i': i, 't': ls[i]})) AS x FROM k)),
c AS (SELECT rid, i, t, row_number() OVER (PARTITION BY rid ORDER BY i) AS pos FROM l WHERE regexp_matches(t, '[^\x00-\x20]')),
w AS (SELECT rid, pos, t, lead(t) OVER o AS t2, lead(t, 2) OVER o AS t3 FROM c WINDOW o AS (PARTITION BY rid ORDER BY pos)),
later AS (SELECT rid, pos FROM (SELECT rid, pos, row_number() OVER (PARTITION BY t, t2, t3 ORDER BY rid, pos) AS r FROM w WHERE t3 IS NOT NULL) WHERE r > 1),
gone AS (SELECT DISTINCT rid, pos FROM (SELECT rid, unnest(range(pos, pos + 3)) AS pos FROM later)),
g AS (SELECT rid, list(i) AS lines FROM gone JOIN c USING (rid, pos) GROUP BY rid),
n AS (SELECT rid, count(*) AS n_lines FROM c GROUP BY rid),
clean AS (SELECT rid, doc_id, text AS old, coalesce(n_lines, 0) AS n_lines, coalesce(len(lines), 0) AS n_removed,
  CASE WHEN lines IS NULL THEN text WHEN len(lines) = n_lines THEN ''
    ELSE array_to_string(list_filter(list_transform(range(1, len(ls) + 1), lambda i: CASE WHEN list_contains(lines, i) THEN NULL ELSE ls[i] END), lambda x: x IS NOT NULL), chr(10)) END AS text
  FROM k LEFT JOIN g USING (rid) LEFT JOIN n USING (rid))
SELECT documents.doc_id, clean.text, n_lines, n_removed FROM documents
JOIN clean ON documents.doc_id IS NOT DISTINCT FROM clean.doc_id AND documents.text IS NOT DISTINCT FROM clean.old
"""

_FIXED = len(chat.OPEN + chat.MIDDLE + chat.CLOSE + chat.END)
OP8 = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{TRIAL}'), (-1, 1, 'assistant', '{TRIAL}')),
c AS (SELECT *, len(regexp_split_to_array(trim(text), '[ \t-\r]+')) + {chat.TURN_TOKENS} AS tokens,
  length(role) + length(text) + {_FIXED} + length(regexp_replace(role || text, '[^\\<\[]', '', 'g')) AS chars,
  row_number() OVER o AS pos, first(role) OVER o = '{chat.SYSTEM}' AS has_system FROM t WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
s AS (SELECT *, coalesce(sum(tokens) OVER (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
  coalesce(sum(chars) OVER (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chars_before,
  greatest(1, floor(({chat.BUDGET - chat.HISTORY} - CASE WHEN has_system THEN first(tokens) OVER (PARTITION BY conv_id ORDER BY pos) ELSE 0 END) / 2)) AS stride FROM c),
a AS (SELECT *, tokens > stride AND NOT (has_system AND pos = 1) AS alone FROM s),
b AS (SELECT *, {{'a': floor(before / stride), 'b': coalesce(sum(CAST(alone AS INT)) OVER (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 'c': alone}} AS slot FROM a),
w AS (SELECT *, pos > 1 AND lag(slot) OVER (PARTITION BY conv_id ORDER BY pos) IS DISTINCT FROM slot AS starts,
  count(*) OVER (PARTITION BY conv_id ORDER BY before RANGE BETWEEN {chat.HISTORY} PRECEDING AND 1 PRECEDING) AS repeats FROM b),
again AS (SELECT w.conv_id, w.chars_before - coalesce(min(f.chars_before), w.chars_before) + CASE WHEN w.has_system THEN min(y.chars) ELSE 0 END AS chars
  FROM w LEFT JOIN c AS y ON y.conv_id IS NOT DISTINCT FROM w.conv_id AND y.pos = 1
  LEFT JOIN s AS f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.pos = greatest(w.pos - w.repeats, CASE WHEN w.has_system THEN 2 ELSE 1 END) AND f.pos < w.pos
  WHERE w.starts GROUP BY w.conv_id, w.pos, w.chars_before, w.has_system),
r AS (SELECT conv_id, sum(chars) AS chars FROM again GROUP BY conv_id),
d AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos) AS all_turns,
  coalesce(string_agg(CASE WHEN role = '{chat.TARGET}' THEN text END, '' ORDER BY pos), '') AS loss, sum(chars) AS chars FROM c GROUP BY conv_id)
SELECT d.conv_id, n_turns, sha256(all_turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
  CAST(d.chars + coalesce(r.chars, 0) AS BIGINT) AS formatted_chars
FROM d LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM d.conv_id
"""


def _md5_number(text: str, modulus: int) -> str:
    return f"(CAST('0x' || substr(md5({text}), 1, 6) AS INT) % {modulus})"


_HOST = r"nullif(regexp_replace(lower(regexp_extract(url, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)', 1)), '^www\.|\.$', '', 'g'), '')"
_DAY = "TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST({} AS INT))"
OP10 = rf"""
WITH cap AS (SELECT row_number() OVER () AS rid, page_id, {_HOST} AS host,
  regexp_extract(url, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//[^/?#]*(/[^?#]*)', 1) AS path,
  TIMESTAMP '2024-01-01 00:00:00' + to_seconds(page_id * 7919 % 31536000) AS fetched FROM pages),
hosts AS (SELECT DISTINCT host AS entry FROM cap WHERE host IS NOT NULL),
listed AS (SELECT entry, {_md5_number("entry", 200)} AS d, {_md5_number("entry || '/r'", 3)} AS r FROM hosts WHERE {_md5_number("entry || '/l'", 2)} = 0),
parents AS (SELECT DISTINCT regexp_replace(entry, '^[^.]*\.', '') AS entry FROM hosts WHERE entry LIKE '%.%'),
spans AS (
  SELECT entry, 'block' AS action, {_DAY.format("d")} AS since, CASE WHEN r > 0 THEN {_DAY.format("d + 60")} END AS until FROM listed
  UNION ALL SELECT entry, 'block', {_DAY.format("d + 90")}, NULL FROM listed WHERE r = 2
  UNION ALL SELECT entry, 'allow', {_DAY.format(_md5_number("entry", 100))}, NULL FROM parents WHERE {_md5_number("entry", 2)} = 0),
parts AS (SELECT rid, fetched, host, string_split(host, '.') AS ls, list_filter(string_split(path, '/'), lambda x: x <> '') AS ps FROM cap WHERE host IS NOT NULL),
keys AS (
  SELECT rid, fetched, unnest(list_transform(range(1, greatest(len(ls) - 1, 1) + 1), lambda i: array_to_string(ls[i:], '.'))) AS entry FROM parts
  UNION SELECT rid, fetched, unnest(list_transform(range(1, len(ps) + 1), lambda i: host || '/' || array_to_string(ps[1:i], '/'))) FROM parts),
best AS (SELECT rid, entry, action, since FROM keys JOIN spans USING (entry) WHERE since <= fetched AND (until IS NULL OR fetched < until)
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY length(entry) DESC, action = 'block' DESC, since DESC, entry DESC) = 1)
SELECT page_id, coalesce(action = 'block', false) AS blocked, entry, action, strftime(since, '%Y-%m-%d') AS listed_since
FROM cap LEFT JOIN best USING (rid)
"""

_TERMS = rf"regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
OP12 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS ts FROM documents),
t AS (SELECT rid, doc_id, len(ts) AS n, ts FROM d WHERE len(ts) > 0),
c AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM t),
tf AS (SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(ts) AS term FROM t) GROUP BY rid, term),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, c GROUP BY term, n_docs),
i AS (SELECT row_number() OVER () AS iid, item_id, {_TERMS} AS ts FROM benchmark),
q AS (SELECT iid, item_id, term, count(*) AS r FROM (SELECT iid, item_id, unnest(ts) AS term FROM i) GROUP BY iid, item_id, term),
s AS (SELECT iid, item_id, doc_id, rid, CAST(sum(r * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN tf USING (term) JOIN t USING (rid), c GROUP BY iid, item_id, doc_id, rid)
SELECT item_id, CAST(row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS FIRST) AS INT) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= {lexical.TOP}
"""

ORACLES = {
    "op1_repetition_rules": OP1,
    "op4_suffix_decontamination": OP4,
    "op6_license_lookup": OP6,
    "op7_line_windows": OP7,
    "op8_chat_windows": OP8,
    "op10_url_lists": OP10,
    "op12_fp_tree_search": OP12,
}
