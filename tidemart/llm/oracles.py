"""DuckDB SQL of the queries that SQL can express, written apart from the operators' own expressions."""

WORDS = r"regexp_extract_all(coalesce({}, ''), '[^\x20\x09-\x0D]+')"

OP2 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t, """ + WORDS.format("text") + r""" AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
tri AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT r, w, unnest(generate_series(1, len(w) - 2)) AS i FROM d WHERE len(w) > 2)),
rep AS (
  SELECT r, count(DISTINCT p) AS n FROM (
    SELECT r, unnest([i, i + 1, i + 2]) AS p
    FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM tri) WHERE c > 1) GROUP BY r),
ln AS (
  SELECT r, source, t, regexp_replace(lower(trim(regexp_replace(l, '[\x20\x09-\x0D]+', ' ', 'g'))), '[0-9]', '0', 'g') AS l,
         len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS n
  FROM (SELECT r, source, t, unnest(ls) AS l FROM d)),
host AS (SELECT source, count(DISTINCT t) AS docs FROM d GROUP BY source),
freq AS (
  SELECT source, l, count(DISTINCT t) AS c FROM ln GROUP BY source, l),
bad AS (
  SELECT f.source, f.l FROM freq f JOIN host h ON f.source IS NOT DISTINCT FROM h.source
  WHERE f.c > 50 AND f.c > 0.005 * h.docs),
gone AS (
  SELECT ln.r, sum(ln.n) AS n FROM ln JOIN bad ON ln.l = bad.l AND ln.source IS NOT DISTINCT FROM bad.source GROUP BY ln.r),
m AS (
  SELECT d.r, doc_id, len(w)::BIGINT AS n_words, length(list_reduce(list_concat([''], w), lambda a, b: a || b))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
         coalesce(gone.n, 0)::BIGINT AS removed_words
  FROM d LEFT JOIN rep USING (r) LEFT JOIN gone USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND removed_words <= 0.5 * n_words AS kept, removed_words
FROM m
"""

_ESCAPED = "replace(replace(replace(coalesce({}, ''), '&', '&amp;'), '<', '&lt;'), '[', '&#91;')"

OP6 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
         count(*) OVER (PARTITION BY conv_id) AS n,
         23 + length(""" + _ESCAPED.format("role") + ") + length(" + _ESCAPED.format("text") + r""") AS chars FROM c),
p AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY k) AS upto FROM o)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY k), '')) AS loss_sha256,
       sum(CASE WHEN role = 'assistant' OR k = n THEN upto END)::BIGINT AS formatted_chars,
       sum(CASE WHEN role = 'assistant' OR k = n THEN 1 END)::BIGINT AS n_examples
FROM p GROUP BY conv_id
"""

OP7 = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, len(""" + WORDS.format("text") + r""")::BIGINT AS size,
         length(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS solid,
         length(regexp_replace(coalesce(text, ''), '[^\p{L}]', '', 'g')) AS letters FROM documents),
k AS (
  SELECT doc_id, source, size,
         -ln((('0x' || substr(md5('mix-1|' || coalesce(doc_id::VARCHAR, 'null') || '|' || t), 1, 13))::BIGINT::DOUBLE + 1)
             / (power(16, 13) + 1)) / CASE WHEN solid > 0 THEN 0.1::DOUBLE + 0.9::DOUBLE * letters / solid ELSE 1 END AS key
  FROM d),
s AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w, sum(source_size) OVER () AS total
  FROM (SELECT source, sum(size) AS source_size FROM d GROUP BY source)),
l AS (
  SELECT *, (total - coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level, 3 * source_size / w::DOUBLE AS ratio
  FROM s WINDOW o AS (ORDER BY 3 * source_size / w::DOUBLE, source NULLS LAST)),
c AS (SELECT first(level ORDER BY ratio, level) AS common FROM l WHERE level * w <= 3 * source_size),
g AS (
  SELECT source, source_size::BIGINT AS source_size, least(common * w, 3 * source_size::DOUBLE) AS target,
         CASE WHEN source_size > 0 THEN least(floor(least(common * w, 3 * source_size::DOUBLE) / source_size), 3) ELSE 0 END AS epochs
  FROM l, c),
x AS (
  SELECT k.*, g.source_size, g.target, g.epochs, g.target - g.epochs * g.source_size AS budget,
         coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM k JOIN g ON k.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target, ((epochs + CASE WHEN 2 * before + size <= 2 * budget THEN 1 ELSE 0 END) * size)::BIGINT AS taken, source
FROM x
"""

OP8 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, """ + WORDS.format("text") + r""" AS w FROM documents),
v AS (
  SELECT r, i, array_to_string(w[i:i + 34], ' ') AS g
  FROM (SELECT r, w, unnest(generate_series(1, len(w) - 34)) AS i FROM d WHERE len(w) >= 35)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY g) AS c FROM v) WHERE c > 1),
gone AS (SELECT DISTINCT r, unnest(generate_series(i, i + 34)) AS p FROM twice),
kept AS (
  SELECT q.r, string_agg(q.x, ' ' ORDER BY q.p) AS t, count(*) AS n
  FROM (SELECT r, unnest(w) AS x, unnest(generate_series(1, len(w))) AS p FROM d) q
  LEFT JOIN gone ON gone.r = q.r AND gone.p = q.p WHERE gone.r IS NULL GROUP BY q.r)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, (len(d.w) - coalesce(kept.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

OP9 = r"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
b AS (
  SELECT *, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + ((('0x' || substr(h, (1 + 5 * (i // 4))::BIGINT, 5))::BIGINT >> (15 - 5 * (i % 4))::BIGINT) & 31)::BIGINT, 1)), '') AS payload_digest,
         max(page_id) OVER (PARTITION BY h) AS best FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id IS DISTINCT FROM best THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM best THEN best END AS refers_to
FROM b
"""

OP10 = r"""
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS e,
         label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
         AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS usable
  FROM embeddings),
l AS (
  SELECT a.r AS a, b.r AS b FROM v a JOIN v b ON a.label = b.label AND a.r <> b.r AND len(a.e) = len(b.e)
  WHERE a.usable AND b.usable AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (
  SELECT a AS r, b AS o FROM l UNION SELECT reach.r, l.b FROM reach JOIN l ON reach.o = l.a)
SELECT v.vec_id, (SELECT count(*) FROM l WHERE l.a = v.r)::BIGINT AS n_links,
       least(v.vec_id, coalesce((SELECT min(w.vec_id) FROM reach JOIN v w ON w.r = reach.o WHERE reach.r = v.r), v.vec_id)) AS component_id,
       v.vec_id IS NOT DISTINCT FROM least(v.vec_id, coalesce((SELECT min(w.vec_id) FROM reach JOIN v w ON w.r = reach.o WHERE reach.r = v.r), v.vec_id)) AS kept
FROM v
"""

_HEX = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
_RECORD = " || ".join(_HEX.format(c) for c in ("doc_id", "source", "lang", "n_chars"))

#: CRC-32 (unsigned) of an ASCII or Latin-1 list of byte values, by the usual table.
_CRC_TABLE = """crc AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
  lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab)"""
_CRC = """xor(4294967295::BIGINT, list_reduce(list_concat([4294967295::BIGINT], {}),
  lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])))"""

OP12 = """
WITH RECURSIVE """ + _CRC_TABLE + """,
d AS (
  SELECT doc_id, source, sha256(""" + _RECORD + " || " + _HEX.format("text") + """) AS leaf,
         CASE WHEN """ + _CRC.format("list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)") + """ % 5 = 0
              THEN sha256(""" + _RECORD + " || " + _HEX.format(
                  "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')") + """) END AS tampered
  FROM documents, crc),
leaves AS (
  SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g, count(*) OVER (PARTITION BY source) AS n,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d),
lower_tree(k, g, pos, n, node) AS (
  SELECT 0, g, pos, n, leaf FROM leaves
  UNION ALL
  SELECT any_value(k) + 1, g, pos // 16, (any_value(n) + 15) // 16, sha256(string_agg(node, '' ORDER BY pos))
  FROM lower_tree WHERE n > 1 GROUP BY g, pos // 16),
subroots AS (SELECT g, k, node FROM lower_tree WHERE n = 1),
upper_tree(k, g, pos, n, node) AS (
  SELECT 0, 0, g, (SELECT count(*) FROM subroots), node FROM subroots
  UNION ALL
  SELECT any_value(k) + 1, 0, pos // 16, (any_value(n) + 15) // 16, sha256(string_agg(node, '' ORDER BY pos))
  FROM upper_tree WHERE n > 1 GROUP BY pos // 16),
tree AS (
  SELECT 0 AS part, * FROM lower_tree WHERE n > 1 UNION ALL SELECT 1, * FROM upper_tree WHERE n > 1),
runs AS (
  SELECT part, k, g, pos // 16 AS run, list(node ORDER BY pos) AS nodes FROM tree GROUP BY part, k, g, pos // 16),
step AS (
  SELECT l.g AS doc_g, l.pos AS doc_pos, r.part, r.k, r.nodes, (l.pos // (16 ** r.k)::BIGINT) % 16 + 1 AS slot
  FROM leaves l JOIN runs r ON r.part = 0 AND r.g = l.g AND r.run = l.pos // (16 ** (r.k + 1))::BIGINT
  UNION ALL
  SELECT l.g, l.pos, r.part, r.k, r.nodes, (l.g // (16 ** r.k)::BIGINT) % 16 + 1
  FROM leaves l JOIN runs r ON r.part = 1 AND r.run = l.g // (16 ** (r.k + 1))::BIGINT),
path AS (
  SELECT doc_g, doc_pos, list({'l': array_to_string(nodes[:slot - 1], ''), 'r': array_to_string(nodes[slot + 1:], '')}
                              ORDER BY part, k) AS p FROM step GROUP BY doc_g, doc_pos),
fold(doc_g, doc_pos, i, node) AS (
  SELECT g, pos, 1, coalesce(tampered, leaf) FROM leaves
  UNION ALL
  SELECT f.doc_g, f.doc_pos, i + 1, sha256(p[i].l || node || p[i].r)
  FROM fold f JOIN path USING (doc_g, doc_pos) WHERE i <= len(p)),
folded AS (SELECT doc_g, doc_pos, arg_max(node, i) AS node FROM fold GROUP BY doc_g, doc_pos),
top AS (SELECT node AS root FROM upper_tree WHERE n = 1)
SELECT l.doc_id, l.leaf, s.node AS subroot, top.root,
       sha256(coalesce(array_to_string(list_transform(p, lambda x: x.l || x.r), ''), '')) AS proof_sha256,
       f.node AS folded_root, f.node = top.root AS verified
FROM leaves l JOIN subroots s ON s.g = l.g CROSS JOIN top
JOIN folded f ON f.doc_g = l.g AND f.doc_pos = l.pos LEFT JOIN path ON path.doc_g = l.g AND path.doc_pos = l.pos
"""

OP13 = r"""
WITH RECURSIVE """ + _CRC_TABLE + r""",
run AS (
  SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r, count(*) AS c
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS r FROM documents)
  WHERE length(r) >= 5 GROUP BY ALL),
hashed AS (
  SELECT r, c, """ + _CRC.format("""list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':', ''), lambda x: ascii(x)::BIGINT)
    || flatten(list_transform(string_split(r, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT]
       ELSE [(192 + (unicode(x) >> 6))::BIGINT, (128 + (unicode(x) & 63))::BIGINT] END))""") + r""" AS h FROM run, crc),
vocab AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS word,
         sum(c)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 5 AND sum(c) >= 3),
holes AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocab),
cuts AS (SELECT DISTINCT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS cut FROM holes),
masks AS (SELECT word, n, i, substr(word, 1, i - 1) || '?' || substr(word, i + 1) AS mask FROM holes),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM masks a JOIN masks b ON a.mask = b.mask AND a.word <> b.word
  UNION ALL SELECT c.word, v.word, v.n FROM cuts c JOIN vocab v ON c.cut = v.word
  UNION ALL SELECT v.word, c.word, c.n FROM cuts c JOIN vocab v ON c.cut = v.word),
best AS (
  SELECT word, count(*) AS n_near, min({'o': -other_n, 'w': other}) AS b FROM near GROUP BY word),
forms AS (
  SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN -b.o >= 2 * v.n THEN b.w END AS form,
         CASE WHEN -b.o >= 2 * v.n THEN -b.o END::BIGINT AS form_n
  FROM vocab v LEFT JOIN best ON best.word = v.word),
walk(word, spot, i) AS (
  SELECT word, word, 0 FROM vocab
  UNION ALL SELECT w.word, f.form, i + 1 FROM walk w JOIN forms f ON f.word = w.spot WHERE f.form IS NOT NULL)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n
FROM forms f JOIN (SELECT word, arg_max(spot, i) AS root FROM walk GROUP BY word) r ON r.word = f.word
"""
