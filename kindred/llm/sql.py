"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

from kindred.llm import line_dedup as L
from kindred.llm import mixing as M

OP4 = rf"""
WITH sized AS (
  SELECT doc_id, coalesce('s' || source, 't') AS src,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('{M.SEED}:' || coalesce(doc_id::VARCHAR, md5(text), '')), 1, 15))::BIGINT AS u
  FROM documents),
sources AS (SELECT src, sum(size)::BIGINT AS source_size FROM sized GROUP BY src),
weighed AS (
  SELECT *, list_extract({[float(w) for w in M.WEIGHTS]}::DOUBLE[], ((row_number() OVER (ORDER BY src) - 1) % {len(M.WEIGHTS)} + 1)::INTEGER) AS w,
         source_size * {M.MOST}::DOUBLE AS cap FROM sources),
levels AS (
  SELECT *, row_number() OVER (ORDER BY cap / w, src) AS ord,
         (sum(source_size) OVER () * {M.SHARE}::DOUBLE
          - coalesce(sum(cap) OVER (ORDER BY cap / w, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap / w, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM weighed),
level AS (SELECT arg_min(level, ord) AS level FROM levels WHERE level * w <= cap),
targets AS (SELECT src, source_size, least(cap, level.level * w) AS target, ceil(source_size / {M.BLOCK_WORDS})::BIGINT AS n_blocks
            FROM levels, level),
seats AS (
  SELECT src, row_number() OVER (ORDER BY target / (2 * s - 1) DESC, src, s) AS place
  FROM (SELECT src, target, unnest(range(1, n_blocks * {M.MOST} + 1)) AS s FROM targets)),
quotas AS (
  SELECT t.*, coalesce(q.quota, 0) AS quota,
         CASE {" ".join(f"WHEN greatest(n_blocks, 1) % {p} <> 0 THEN {p}" for p in M.PRIMES)} END::BIGINT AS a,
         ('0x' || substr(md5('{M.SEED}:' || src), 1, 8))::BIGINT % greatest(n_blocks, 1) AS c
  FROM targets t LEFT JOIN (
    SELECT src, count(*) AS quota FROM seats
    WHERE place <= (SELECT floor(sum(target) / {M.BLOCK_WORDS}) FROM targets) GROUP BY src) q USING (src)),
placed AS (
  SELECT d.doc_id, d.size, q.*, sum(d.size) OVER (PARTITION BY d.src ORDER BY d.u, d.doc_id, d.size ROWS UNBOUNDED PRECEDING)::BIGINT AS stop
  FROM sized d JOIN quotas q USING (src))
SELECT doc_id, size, source_size, target,
       coalesce(list_sum(list_transform(range((stop - size) // {M.BLOCK_WORDS}, CASE WHEN size > 0 THEN (stop - 1) // {M.BLOCK_WORDS} + 1 ELSE 0 END),
         lambda b: (least((b + 1) * {M.BLOCK_WORDS}, stop) - greatest(b * {M.BLOCK_WORDS}, stop - size))
                   * (quota // n_blocks + CASE WHEN (a * b + c) % n_blocks < quota % n_blocks THEN 1 ELSE 0 END))), 0)::BIGINT AS taken
FROM placed"""

OP8 = rf"""
WITH lines AS (
  SELECT coalesce(doc_id, {L.LAST}) AS id, doc_id, text, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
hashed AS (SELECT *, list_transform(l, lambda x: ('0x' || substr(md5(x), 1, 8))::BIGINT) AS h FROM lines),
ended AS (
  SELECT *, list_filter(range(1, len(l) + 1), lambda i: i = len(l) OR
    (({" + ".join(f"coalesce(CASE WHEN i > {k} THEN h[i - {k}] END, 0) * {L.FACTOR**k}" for k in range(L.WINDOW))}) // 4096) % {L.DIVISOR} = 0) AS e
  FROM hashed),
chunks AS (
  SELECT id, doc_id, text, l, unnest(range(1, len(e) + 1)) AS o, e FROM ended),
pieces AS (
  SELECT id, doc_id, text, len(l) AS n_lines, o, list_slice(l, CASE WHEN o = 1 THEN 1 ELSE e[o - 1] + 1 END, e[o]) AS p FROM chunks),
told AS (
  SELECT *, array_to_string(p, chr(10)) AS c,
         len(list_filter(p, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) > 1 AS multi FROM pieces),
first AS (
  SELECT c, min(id) AS first_id, count(*) AS n FROM told WHERE multi GROUP BY c),
judged AS (
  SELECT t.*, multi AND n > 1 AND (id <> first_id OR row_number() OVER (PARTITION BY id, text, t.c, multi ORDER BY o) > 1) AS gone
  FROM told t LEFT JOIN first f ON t.c = f.c)
SELECT doc_id, CASE WHEN text IS NOT NULL THEN coalesce(string_agg(c, chr(10) ORDER BY o) FILTER (WHERE NOT coalesce(gone, FALSE)), '') END AS text,
       CASE WHEN text IS NULL THEN 0 ELSE max(n_lines) END::BIGINT AS n_lines,
       CASE WHEN text IS NULL THEN 0 ELSE count(*) END::BIGINT AS n_chunks,
       (count(*) FILTER (WHERE gone))::BIGINT AS n_removed_chunks,
       coalesce(sum(len(p)) FILTER (WHERE gone), 0)::BIGINT AS n_removed_lines
FROM judged j GROUP BY doc_id, id, text"""

OP7 = """
WITH told AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
first AS (SELECT d, min(page_id) AS first FROM told WHERE n >= 100 GROUP BY d)
SELECT page_id, n::BIGINT AS payload_bytes, d AS payload_digest,
       CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first THEN first END AS refers_to
FROM told LEFT JOIN first USING (d)"""

OP9 = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS h FROM documents),
starts AS (
  SELECT r, unnest(range(0, octet_length(h) - 199)) AS p,
         unnest(list_transform(range(0, octet_length(h) - 199), lambda p: md5_number_lower(array_slice(h, p + 1, p + 200)))) AS s FROM d),
hit AS (SELECT r, p FROM starts JOIN (SELECT s FROM starts GROUP BY s HAVING count(*) > 1) USING (s)),
edge AS (SELECT *, CASE WHEN p > lag(p, 1, -1000) OVER (PARTITION BY r ORDER BY p) + 200 THEN 1 ELSE 0 END AS begins FROM hit),
span AS (
  SELECT r, min(p) AS a, max(p) + 200 AS b FROM (SELECT *, sum(begins) OVER (PARTITION BY r ORDER BY p) AS k FROM edge) GROUP BY r, k),
gap AS (
  SELECT r, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS f, a AS t FROM span
  UNION ALL SELECT r, max(b), NULL FROM span GROUP BY r),
kept AS (SELECT r, string_agg(hex(array_slice(h, f + 1, coalesce(t, octet_length(h)))), '' ORDER BY f, t NULLS LAST) AS k
         FROM gap JOIN d USING (r) GROUP BY r),
gone AS (SELECT r, sum(b - a) AS n, count(*) AS spans FROM span GROUP BY r)
SELECT doc_id, octet_length(h)::BIGINT AS n_bytes, coalesce(n, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
       sha256(CASE WHEN k IS NULL THEN h ELSE unhex(k) END) AS kept_sha256
FROM d LEFT JOIN kept USING (r) LEFT JOIN gone USING (r)"""

# Rebuilt conversations as lists of turns; a node is a list, its ancestors are its slices.
OP13 = """
WITH convs AS (
  SELECT conv_id AS c, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST, role) AS t,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
                         lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, (v & 1) * 3988292384))),
             4294967295::BIGINT) % 6 AS h
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
rebuilt AS (
  SELECT a.c, list_concat(coalesce(b.t, [])[1:a.h], a.t[a.h + 1:]) AS t FROM convs a LEFT JOIN convs b ON b.c = a.c - a.c % 100),
prefixes AS (SELECT c, len(t) AS n, unnest(range(0, len(t) + 1)) AS d, t FROM rebuilt),
nodes AS (
  SELECT d AS depth, t[1:d] AS seq, min(c) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = d), '')) AS ends_sha256
  FROM prefixes GROUP BY d, t[1:d]),
children AS (SELECT seq[1:depth - 1] AS seq, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL),
full_nodes AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN children k ON k.seq = n.seq),
ways AS (
  SELECT unnest(range(0, depth + 1)) AS k, seq, (n_children = 0)::BIGINT AS leaf,
         CASE WHEN depth > 0 THEN (n_convs - 1) * length(seq[depth].t) ELSE 0 END AS saved FROM full_nodes),
sums AS (SELECT k AS depth, seq[1:k] AS seq, sum(leaf)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM ways GROUP BY k, seq[1:k])
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
FROM full_nodes n JOIN sums s ON s.depth = n.depth AND s.seq = n.seq
LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.seq = n.seq[1:n.depth - 1]"""
