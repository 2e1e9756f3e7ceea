"""DuckDB SQL for the queries it can express, written from their contracts."""

from __future__ import annotations

from plumbline.llm import licenses, mixing

_WORDS = "string_split(trim(regexp_replace(translate(coalesce(text, ''), " \
    "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), " \
    "'[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', ' ', 'g')), ' ')"

# Op 4: the digests follow from the turns alone; the markers' lengths give the formatted length.
_ESCAPED = "length(regexp_replace({0}, '<(~*)\\|', '<~\\1|', 'g'))"
OP4 = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'),
                   (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  sum(12 + {_ESCAPED.format("role")} + 1 + {_ESCAPED.format("text")} + 11)::BIGINT AS formatted_chars
FROM c GROUP BY conv_id"""

OP9 = """
WITH p AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0
    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
r(rule, rule_host, rule_path, verdict) AS (VALUES
  ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
  ('www.example.com/en/', 'www.example.com', '/en/', 'allow'),
  ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')),
best AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM h JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host))
    AND starts_with(path, rule_path) GROUP BY page_id),
own AS (
  SELECT h.*, CASE
      WHEN host = '' AND path = '' THEN NULL
      WHEN regexp_matches(host, '(^|[.-])spam([.-]|$)') THEN 'spam host'
      WHEN regexp_matches(host, '(^|[.-])casino([.-]|$)') THEN 'casino host'
      WHEN regexp_matches(host, '^ads\\..') THEN 'ad host'
      WHEN regexp_matches(host, '(^|\\.)tracker\\..') THEN 'tracker host'
      WHEN regexp_matches(path, '/login([^0-9A-Za-z_].*)?$') THEN 'login page'
      WHEN regexp_matches(path, '/feed/?$') THEN 'feed page' END AS name FROM h)
SELECT page_id, host, path, rule, CASE WHEN rule IS NULL THEN name END AS pattern_name,
  coalesce(verdict, CASE WHEN name IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM own LEFT JOIN best USING (page_id)"""

_PHRASES = ", ".join(f"('{p}', '{label}', {len(p.split())})" for p, label in licenses.PHRASES.items())
_NOTICES = ", ".join(
    f"({i}, '{label}', {sorted(set(n.split()))}, {len(set(n.split()))})"
    for i, (label, n) in enumerate(licenses.NOTICES))
OP10 = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS row_no, {_WORDS} AS w0 FROM documents),
t AS (SELECT doc_id, row_no, CASE WHEN w0 = [''] THEN []::VARCHAR[] ELSE w0 END AS w FROM d),
p(phrase, label, n) AS (VALUES {_PHRASES}),
places AS (
  SELECT row_no, label, i - 1 AS place FROM (
    SELECT row_no, w, unnest(range(1, len(w) + 1)) AS i FROM t) JOIN p
  ON array_to_string(w[i:i + n - 1], ' ') = phrase),
base AS (SELECT row_no, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
  list(DISTINCT label) AS labels FROM places GROUP BY row_no),
b AS (SELECT row_no, w[k * {licenses.STEP} + 1:k * {licenses.STEP} + {licenses.BLOCK}] AS ws FROM (
  SELECT row_no, w, unnest(range(0, (len(w) + {licenses.STEP} - 1) // {licenses.STEP})) AS k FROM t)),
n(no, label, words, size) AS (VALUES {_NOTICES}),
links AS (SELECT row_no, label, len(list_intersect(ws, words)) / size AS c, size,
    len(list_intersect(ws, words)) AS common FROM b, n),
found AS (SELECT row_no, list(DISTINCT label) AS labels, max(c) AS best FROM links
  WHERE common >= ceil({licenses.THRESHOLD} * size - 1e-9) GROUP BY row_no)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word,
  coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []),
    coalesce(found.labels, [])))), ','), '') AS labels,
  greatest(coalesce(best, 0.0), CASE WHEN n_base > 0 THEN 1.0 ELSE 0.0 END)::DOUBLE AS score
FROM t LEFT JOIN base USING (row_no) LEFT JOIN found USING (row_no)"""

# Op 1: every quotient and every block listed one by one.
OP1 = f"""
WITH d AS (
  SELECT doc_id, source, length(regexp_replace(regexp_replace(coalesce(text, ''),
      '[^\\x20\\x09-\\x0D]+', 'x', 'g'), '[^x]', '', 'g'))::BIGINT AS size,
    md5('{{seed}}|' || coalesce(doc_id::VARCHAR, '')) AS ident FROM documents),
s AS (
  SELECT source, coalesce('s' || source, 'n') AS party, sum(size)::BIGINT AS source_size,
    row_number() OVER (ORDER BY source ASC NULLS LAST) AS source_no FROM d GROUP BY source),
k AS (
  SELECT sum(source_size)::BIGINT AS words, count(*) AS sources,
    greatest(1, least({mixing.BLOCK_WORDS}, sum(source_size) // ({mixing.BLOCKS_PER_SOURCE} * count(*))))
      ::BIGINT AS block,
    greatest({mixing.LEAST_SHARDS}, ((SELECT count(*) FROM d) + {mixing.SHARD_ROWS} - 1) // {mixing.SHARD_ROWS}) AS shards
  FROM s),
w AS (SELECT s.*, [5, 2, 1][((source_no - 1) % 3 + 1)::INT] AS weight FROM s),
bite AS (SELECT *, (3 * source_size)::DOUBLE / weight AS bite FROM w),
lvl AS (
  SELECT *, ((SELECT words FROM k) - coalesce(sum(3 * source_size) OVER (ORDER BY bite, source_no
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / (sum(weight) OVER (ORDER BY bite, source_no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
      ::DOUBLE AS level FROM bite),
settled AS (SELECT level FROM lvl WHERE level <= bite ORDER BY bite, source_no LIMIT 1),
t AS (
  SELECT lvl.*, CASE WHEN (SELECT level FROM settled) IS NULL
      OR weight * (SELECT level FROM settled) > 3 * source_size THEN (3 * source_size)::DOUBLE
    ELSE weight * (SELECT level FROM settled) END AS target,
    CASE WHEN source_size > 0 THEN greatest(1, round(source_size / (SELECT block FROM k)))
      ELSE 0 END::BIGINT AS blocks FROM lvl),
q AS (
  SELECT source_no, row_number() OVER (ORDER BY target / (2 * i - 1) DESC, source_no, i) AS place
  FROM (SELECT source_no, target, unnest(range(1, (SELECT words // block + 2 FROM k))) AS i
        FROM t WHERE target > 0)),
seats AS (
  SELECT source_no, count(*) AS quota FROM q
  WHERE place <= (SELECT (words + block // 2) // block FROM k) GROUP BY source_no),
src AS (
  SELECT t.*, CASE WHEN source_size > 0 THEN least(3 * blocks, round(coalesce(quota, 0)::DOUBLE
      * (SELECT block FROM k) * blocks / source_size)) ELSE 0 END::BIGINT AS source_quota
  FROM t LEFT JOIN seats USING (source_no)),
dd AS (
  SELECT d.*, coalesce('s' || d.source, 'n') AS party,
    ('0x' || substr(ident, 1, 8))::BIGINT % (SELECT shards FROM k) AS shard FROM d),
sh AS (
  SELECT party, shard, sum(size)::BIGINT AS shard_size, any_value(source_size) AS source_size,
    any_value(blocks) AS blocks, any_value(source_quota) AS source_quota
  FROM dd JOIN src USING (party) GROUP BY party, shard),
off AS (
  SELECT *, (sum(shard_size) OVER (PARTITION BY party ORDER BY shard) - shard_size)::BIGINT AS begin
  FROM sh WHERE source_size > 0),
blk AS (
  SELECT party, i, (i * source_size) // blocks AS lo, ((i + 1) * source_size) // blocks AS hi
  FROM (SELECT DISTINCT party, source_size, blocks FROM off), unnest(range(0, blocks)) AS u(i)),
owned AS (
  SELECT blk.*, shard, row_number() OVER (PARTITION BY party, shard ORDER BY i) - 1 AS nr,
    count(*) OVER (PARTITION BY party, shard) AS n, source_quota
  FROM blk JOIN off USING (party) WHERE lo >= begin AND lo < begin + shard_size),
shards AS (SELECT DISTINCT party, shard, n, source_quota FROM owned),
sq AS (
  SELECT party, shard, source_quota, row_number() OVER (
    PARTITION BY party ORDER BY n::DOUBLE / (2 * j - 1) DESC, shard, j) AS place
  FROM shards, unnest(range(1, 3 * n + 1)) AS u(j)),
won AS (
  SELECT party, shard, count(*) AS quota FROM sq WHERE place <= source_quota GROUP BY party, shard),
often AS (
  SELECT o.party, lo, hi, coalesce(quota, 0) // n
    + (((nr * (CASE WHEN n % 1000000007 <> 0 THEN 1000000007 WHEN n % 998244353 <> 0 THEN 998244353
          ELSE 1000000009 END % n)) % n
      + ('0x' || substr(md5('{{seed}}|' || o.party || '|' || o.shard), 1, 12))::BIGINT % n) % n
      < coalesce(quota, 0) % n)::BIGINT AS passes
  FROM owned o LEFT JOIN won USING (party, shard)),
laid AS (
  SELECT dd.*, row_number() OVER () AS row_no, off.begin + sum(size) OVER (
    PARTITION BY party, shard ORDER BY ident, size ROWS UNBOUNDED PRECEDING) - size AS a
  FROM dd LEFT JOIN off USING (party, shard)),
taken AS (
  SELECT row_no, sum((least(hi, a + size) - greatest(lo, a)) * passes)::BIGINT AS taken
  FROM laid JOIN often ON laid.party = often.party AND lo < a + size AND hi > a GROUP BY row_no)
SELECT doc_id, laid.source, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken
FROM laid JOIN src USING (party) LEFT JOIN taken USING (row_no)""".replace("{seed}", "1")

# Op 6: every window of the items against every window of the texts.
OP6 = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS row_no, {_WORDS} AS w0 FROM documents),
t AS (SELECT doc_id, row_no, CASE WHEN w0 = [''] THEN []::VARCHAR[] ELSE w0 END AS w FROM d),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
i AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[k:k + least(10, len(w)) - 1], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS k FROM b WHERE w <> [''])),
tw AS (
  SELECT row_no, k, n, array_to_string(w[k:k + n - 1], ' ') AS win
  FROM (SELECT row_no, w, n, unnest(range(1, len(w) - n + 2)) AS k
        FROM t, (SELECT DISTINCT n FROM i) WHERE len(w) >= n)),
hits AS (SELECT row_no, k, tw.n, item FROM tw JOIN i USING (n, win)),
places AS (SELECT row_no, count(DISTINCT p) AS n_hit FROM (
  SELECT row_no, unnest(range(k, k + n)) AS p FROM (SELECT DISTINCT row_no, k, n FROM hits)) GROUP BY row_no),
found AS (SELECT row_no, count(DISTINCT item) AS n_items,
  string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY row_no)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM t LEFT JOIN places USING (row_no) LEFT JOIN found USING (row_no)"""

# Op 8: every stretch of 100 bytes, in hexadecimal digits.
OP8 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
s AS (SELECT doc_id, k, substr(h, 2 * k + 1, 200) AS stretch
  FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99)) AS k FROM d WHERE len(h) >= 200)),
again AS (SELECT doc_id, k FROM (
  SELECT doc_id, k, row_number() OVER (PARTITION BY stretch ORDER BY doc_id, k) AS n FROM s) WHERE n > 1),
marked AS (SELECT *, CASE WHEN k <= lag(k) OVER w + 100 THEN 0 ELSE 1 END AS new FROM again
  WINDOW w AS (PARTITION BY doc_id ORDER BY k)),
runs AS (SELECT doc_id, min(k) AS a, max(k) + 100 AS b FROM (
  SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY k) AS run FROM marked) GROUP BY doc_id, run),
cut AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM runs),
kept AS (
  SELECT c.doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans,
    string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a)
      || substr(any_value(h), 2 * max(b) + 1) AS h
  FROM cut c JOIN d USING (doc_id) GROUP BY c.doc_id)
SELECT doc_id, len(d.h) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
  coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

# Op 11: crc32 bit by bit; every conversation lists its prefixes.
OP11 = """
WITH own AS (
  SELECT conv_id, list(sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) || ' '
      || len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::VARCHAR
      ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
crc AS (
  SELECT conv_id, xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
    lambda a, c: list_reduce([xor(a, c)] || range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 4 AS h
  FROM own),
rebuilt AS (
  SELECT o.conv_id, coalesce(b.turns[:c.h], []) || o.turns[c.h + 1:] AS turns
  FROM own o JOIN crc c USING (conv_id) LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20),
steps AS (
  SELECT conv_id, d, len(turns) AS size, array_to_string(turns[:d], ',') AS path, turns[d] AS step,
    array_to_string(turns[:d - 1], ',') AS above
  FROM rebuilt, unnest(range(0, len(turns) + 1)) AS r(d)),
nodes AS (
  SELECT d, path, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(above) AS above,
    bool_and(size = d) AS leaf, count(*) FILTER (size > d) AS more,
    CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * string_split(any_value(step), ' ')[2]::BIGINT END AS saved,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (size = d), '')) AS ends_sha256
  FROM steps GROUP BY d, path),
children AS (SELECT d - 1 AS d, above AS path, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
-- A node and what is above it meet in the node's smallest member.
sums AS (
  SELECT s.d, s.path, sum(n.leaf::BIGINT) AS n_leaves, sum(n.saved) AS saved
  FROM nodes n JOIN steps s ON s.conv_id = n.conv_id AND s.d <= n.d GROUP BY ALL)
SELECT n.conv_id, n.d::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children,
  s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s ON s.d = n.d AND s.path = n.path
LEFT JOIN children c ON c.d = n.d AND c.path = n.path
LEFT JOIN nodes p ON n.d > 0 AND p.d = n.d - 1 AND p.path = n.above
"""

# Op 13: every phrase of one to four words counted on its own.
OP13 = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS piece_no, lang, piece FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
words AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS ws FROM pieces),
phrases AS (
  SELECT lang, size, unnest(list_transform(range(1, len(ws) - size + 2), lambda i: array_to_string(ws[i:i + size - 1], ' '))) AS phrase
  FROM words, (VALUES (1), (2), (3), (4)) AS sizes(size) WHERE len(ws) >= size),
found AS (SELECT lang, size, phrase, count(*) AS f FROM phrases GROUP BY ALL HAVING count(*) >= 30),
totals AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM words GROUP BY lang),
longer AS (SELECT *, string_split(phrase, ' ') AS ws FROM found WHERE size > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, c.k, x.f AS l, y.f AS r,
    (2000000::HUGEINT * c.f) // (x.f + y.f) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM longer) c
  JOIN found x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[:c.k], ' ')
  JOIN found y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[c.k + 1:], ' ')),
scored AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
around AS (
  SELECT lang, phrase, max(f) AS f FROM (
    SELECT lang, f, array_to_string(ws[b:b + s - 1], ' ') AS phrase
    FROM longer, (VALUES (2), (3)) AS sizes(s), (VALUES (1), (2), (3)) AS begins(b)
    WHERE s < size AND b + s - 1 <= size) GROUP BY ALL),
ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, encode(s.phrase)) AS rank
  FROM scored s LEFT JOIN around o ON o.lang = s.lang AND o.phrase = s.phrase
  WHERE o.f IS NULL OR 100::HUGEINT * o.f < 80::HUGEINT * s.a)
SELECT r.lang, r.rank::BIGINT AS rank, r.phrase, r.a::BIGINT AS a, r.l::BIGINT AS l, r.r::BIGINT AS r,
  t.n, r.score::BIGINT AS score
FROM ranked r JOIN totals t ON t.lang = r.lang WHERE r.rank <= 2000
"""

ORACLE = {"op6_find_contamination": OP6, "op8_drop_repeats": OP8, "op1_mix_sources": OP1, "op4_format_chats": OP4, "op9_judge_urls": OP9,
          "op10_scan_licenses": OP10, "op11_prefix_trie": OP11,
          "op13_mine_collocations": OP13}
