"""DuckDB SQL for the queries that SQL can express."""

# words, source totals, water-filled targets and the weighted sample, with
# running sums over whole sources instead of buckets
OP3_SQL = r"""
WITH known AS (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id),
sized AS (
  SELECT d.doc_id, d.source, md5(coalesce(d.text, '')) AS body,
         coalesce(len(regexp_extract_all(d.text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         CASE k.quality WHEN 1 THEN 1.0::DOUBLE WHEN 0 THEN 0.25::DOUBLE ELSE 0.5::DOUBLE END AS quality
  FROM documents d LEFT JOIN known k ON d.doc_id = k.doc_id),
keyed AS (
  SELECT *, -ln(greatest(('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, 'null') || ':' || body), 1, 12))::BIGINT
                         / 281474976710656.0::DOUBLE, 1.7763568394002505e-15::DOUBLE)) / quality AS k
  FROM sized),
totals AS (
  SELECT source, sum(size)::BIGINT AS n,
         list_value(3, 1, 2)[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM sized GROUP BY source),
sums AS (
  SELECT *, 1.5::DOUBLE * sum(n) OVER () AS budget,
         coalesce(sum(2 * n) OVER lower, 0) AS full_before, sum(w) OVER () - coalesce(sum(w) OVER lower, 0) AS w_open
  FROM totals
  WINDOW lower AS (ORDER BY 2.0 * n / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
pick AS (
  SELECT s.source, s.n,
         CASE WHEN (s.budget - s.full_before) * s.w / s.w_open >= 2 * s.n THEN 2.0::DOUBLE * s.n
              ELSE (o.budget - o.full_before) * s.w / o.w_open END AS target
  FROM sums s, (SELECT budget, full_before, w_open FROM sums
                WHERE (budget - full_before) * w / w_open < 2 * n ORDER BY 2.0 * n / w, source LIMIT 1) o),
run AS (
  SELECT k.*, p.n AS source_size, p.target,
         CASE WHEN p.n > 0 THEN floor(p.target / p.n) ELSE 0 END AS epochs,
         coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.k, k.doc_id NULLS FIRST, k.body
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM keyed k JOIN pick p ON k.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       ((epochs + CASE WHEN before + size / 2.0::DOUBLE < target - epochs * source_size THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM run
"""

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

# 32 digits of 5 bits from the 160 bits of the SHA-1
OP10_SQL = f"""
WITH bits AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
digest AS (
  SELECT page_id, payload_bytes,
    list_aggregate(list_transform(range(0, 32), lambda i:
      substr('{_BASE32}', 1 + ((('0x' || substr(h || '0', 1 + (i * 5) // 4, 2))::BIGINT >> (3 - (i * 5) % 4)) & 31), 1)),
      'string_agg', '') AS payload_digest
  FROM bits)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN rn = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN rn > 1 THEN first_id END AS refers_to
FROM (SELECT *, row_number() OVER w AS rn, first_value(page_id) OVER w AS first_id FROM digest
      WINDOW w AS (PARTITION BY payload_digest ORDER BY page_id NULLS LAST))
"""

# windows of three as rows, counted by the whole text of the window
OP2_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
win AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s
        FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, s) AS c FROM win) WHERE c > 1),
rep AS (SELECT rid, count(DISTINCT i + o)::BIGINT AS n FROM twice, (VALUES (0), (1), (2)) v(o) GROUP BY rid),
f AS (
  SELECT d.doc_id, d.t, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN rep ON d.rid = rep.rid),
g AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
             length(regexp_replace(t, '[^\p{L}]+', '', 'g')) AS letters,
             length(regexp_replace(t, '[^\p{Lu}]+', '', 'g')) AS capitals,
             len(regexp_extract_all(t, '(?:\.\.\.|…)[ \t]*(?:\n|$)')) AS ellipsis,
             len(regexp_extract_all(t, '(?:^|\n)[ \t]*[•●‣–-][ \t]')) AS bullets
      FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR 2 * n_dup_lines > n_lines OR 10 * letters < 6 * word_chars OR 2 * capitals > letters
            OR 10 * ellipsis > 3 * n_lines OR 10 * bullets > 9 * n_lines) AS kept
FROM g
"""

# whole dialogues by one running sum, cut where a message starts 65536
# characters further; no two messages of a turn exist in the given tables
OP7_SQL = r"""
WITH m AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
p AS (SELECT DISTINCT conv_id, role AS participant FROM m),
s AS (SELECT m.*, p.participant, role = participant AS mine,
             '<|im_start|>' || CASE WHEN role = participant THEN 'assistant' ELSE 'user name=' || role END || chr(10)
               || text || '<|im_end|>' || chr(10) AS segment
      FROM m JOIN p ON m.conv_id IS NOT DISTINCT FROM p.conv_id),
r AS (SELECT *, coalesce(sum(length(segment)) OVER (PARTITION BY conv_id, participant ORDER BY turn NULLS FIRST, role, text
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM s),
q AS (SELECT *, (pos // 65536)::INTEGER AS part FROM r),
o AS (SELECT *, pos - min(pos) OVER (PARTITION BY conv_id, participant, part) AS place FROM q)
SELECT conv_id, participant, part, count(*)::INTEGER AS n_messages, string_agg(segment, '' ORDER BY pos) AS rendered,
       coalesce(string_agg((place + length(segment) - 11 - length(text))::BIGINT || ':' || (place + length(segment) - 11)::BIGINT, ','
                  ORDER BY pos) FILTER (WHERE mine), '') AS masks
FROM o GROUP BY conv_id, participant, part
"""

# all links by counting shared shingles, then everything that a link reaches
OP8_SQL = r"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3]) END) AS sh FROM d),
n AS MATERIALIZED (SELECT doc_id, len(sh)::BIGINT AS n FROM s),
x AS MATERIALIZED (SELECT doc_id, hash(sh) AS h FROM (SELECT doc_id, unnest(sh) AS sh FROM s)),
common AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM x a JOIN x b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
l AS MATERIALIZED (SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
both_ways AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a)
SELECT n.doc_id, n.n AS n_shingles, min(r.b) AS component_id, n.doc_id = min(r.b) AS kept
FROM n JOIN reach r ON r.a = n.doc_id GROUP BY n.doc_id, n.n
"""

# every string of 200 bytes by its hash, the repeated ones as islands, the
# rest joined (two hexadecimal digits a byte)
OP1_SQL = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, ''))::BIGINT AS n FROM documents),
w AS (SELECT rid, i, hash(substr(h, 2 * i + 1, 400)) AS m FROM (SELECT rid, h, unnest(range(0, n - 199)) AS i FROM d WHERE n >= 200)),
again AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY m) AS c FROM w) WHERE c > 1),
steps AS (SELECT rid, i, CASE WHEN i - lag(i) OVER (PARTITION BY rid ORDER BY i) <= 200 THEN 0 ELSE 1 END AS fresh FROM again),
spans AS (SELECT rid, min(i) AS a, max(i) + 200 AS b
          FROM (SELECT rid, i, sum(fresh) OVER (PARTITION BY rid ORDER BY i) AS g FROM steps) GROUP BY rid, g),
gaps AS (
  SELECT rid, coalesce(lag(b) OVER o, 0) AS a, a AS b FROM spans WINDOW o AS (PARTITION BY rid ORDER BY a)
  UNION ALL SELECT d.rid, coalesce((SELECT max(b) FROM spans s WHERE s.rid = d.rid), 0), d.n FROM d),
kept AS (SELECT g.rid, string_agg(substr(d.h, 2 * g.a + 1, 2 * (g.b - g.a)), '' ORDER BY g.a) AS k FROM gaps g JOIN d ON d.rid = g.rid GROUP BY g.rid)
SELECT d.doc_id, d.n AS n_bytes, coalesce((SELECT sum(b - a) FROM spans s WHERE s.rid = d.rid), 0)::BIGINT AS n_removed,
       (SELECT count(*) FROM spans s WHERE s.rid = d.rid) AS n_spans, sha256(unhex(kept.k)) AS kept_sha256
FROM d JOIN kept ON kept.rid = d.rid
"""

OP12_SQL = OP8_SQL.replace("len(w) < 4", "len(w) < 5").replace("range(1, len(w) - 2)", "range(1, len(w) - 3)").replace(
    "|| ' ' || w[i + 3])", "|| ' ' || w[i + 3] || ' ' || w[i + 4])").replace(", n.doc_id = min(r.b) AS kept", "")

# CRC-32 of the distinct features byte by byte, from a table of 256 values
OP11_SQL = r"""
WITH RECURSIVE crc AS MATERIALIZED (
  SELECT list_transform(range(0, 256), lambda v: list_reduce(list_prepend(v, range(0, 8)),
    lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t),
texts AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, * FROM (
    SELECT doc_id, true AS raw, text FROM documents UNION ALL SELECT NULL, false, text FROM benchmark)),
w AS MATERIALIZED (
  SELECT rid, doc_id, raw, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
f AS MATERIALIZED (
  SELECT rid, raw, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
    list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS f FROM w),
b AS MATERIALIZED (
  SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, strlen(f)), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
    lambda a, v: xor(a >> 8, t[1 + (xor(a, v) & 255)])), 4294967295) % 10000 AS b
  FROM (SELECT DISTINCT f, hex(encode(f)) AS h FROM f), crc),
fb AS MATERIALIZED (SELECT f.rid, f.raw, b.b FROM f JOIN b ON f.f = b.f),
n AS (SELECT b, count(*) FILTER (raw) AS s, count(*) FILTER (NOT raw) AS t FROM fb GROUP BY b),
total AS (SELECT sum(s)::DOUBLE AS s_all, sum(t)::DOUBLE AS t_all FROM n),
gain AS (SELECT b, floor(1000 * ln((t + 1)::DOUBLE * (s_all + 10000) / ((s + 1)::DOUBLE * (t_all + 10000))))::BIGINT AS g FROM n, total),
weight AS (SELECT rid, count(*) AS n_features, sum(g)::BIGINT AS weight FROM fb JOIN gain ON fb.b = gain.b WHERE raw GROUP BY rid),
scored AS (
  SELECT doc_id, len(w.w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT + 0.5::DOUBLE)
                                          / 4294967296.0::DOUBLE)))::BIGINT AS score
  FROM w LEFT JOIN weight ON w.rid = weight.rid WHERE w.raw),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS r,
    5 * count(*) FILTER (n_words >= 20) OVER () // 100 AS drawn FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND r <= drawn THEN r END AS rank FROM placed
"""

_OP13_ASSIGN = """
d{r} AS (
  SELECT rid, j, (list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c))::BIGINT AS d FROM v, c{r}),
a{r} AS MATERIALIZED (SELECT rid, min(d) AS d, arg_min(j, (d, j)) AS j FROM d{r} GROUP BY rid)"""

_OP13_MOVE = """
m{n} AS (
  SELECT j, i, floor(sum(y) / count(*)) AS y FROM (
    SELECT a.j, unnest(v.x) AS y, unnest(range(1, 65)) AS i FROM a{r} a JOIN v ON a.rid = v.rid) GROUP BY j, i),
c{n} AS MATERIALIZED (
  SELECT c.j, coalesce(m.c, c.c) AS c FROM c{r} c LEFT JOIN (SELECT j, list(y ORDER BY i) AS c FROM m{n} GROUP BY j) m ON c.j = m.j)"""

OP13_SQL = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS x FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY h, x) - 1)::INTEGER AS j, x AS c
  FROM (SELECT x, sha256('1:' || coalesce(vec_id::VARCHAR, 'null')) AS h FROM v ORDER BY h, x LIMIT 16)),
""" + ",".join(_OP13_ASSIGN.format(r=r) + ("," + _OP13_MOVE.format(r=r, n=r + 1) if r < 3 else "") for r in range(4)) + """
SELECT v.vec_id, a.j AS cluster, a.d AS distance, (sum(a.d) OVER (PARTITION BY a.j))::BIGINT AS cluster_inertia,
       (sum(a.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(list_transform(c.c, lambda y: y::BIGINT), ',')) AS centroid_sha256
FROM a3 a JOIN v ON a.rid = v.rid JOIN c3 c ON c.j = a.j
"""
