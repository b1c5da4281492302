"""The SQL twins of the queries in ``queries`` that SQL can express, for DuckDB."""

from __future__ import annotations

ORACLE: dict[str, str] = {
    "op1_quality_rules": r"""
WITH crc_table AS MATERIALIZED (
  SELECT list_transform(range(256), lambda n: list_reduce(
    list_prepend(n, range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END)) AS t
), docs AS MATERIALIZED (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), placed AS MATERIALIZED (
  SELECT doc_id, unnest(words) AS a, unnest(words[2:]) AS b, unnest(words[3:]) AS c,
         unnest(words[4:]) AS d, unnest(words[5:]) AS e, unnest(range(len(words))) AS i
  FROM docs
), windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c, d, e) AS n
  FROM placed WHERE e IS NOT NULL
), repeats AS (
  SELECT doc_id, count(DISTINCT j) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + 5)) AS j FROM windows WHERE n > 1) GROUP BY doc_id
), grams AS MATERIALIZED (
  SELECT doc_id, 0 AS kind, a AS gram FROM placed WHERE a IS NOT NULL
  UNION ALL SELECT doc_id, 1, a || ' ' || b FROM placed WHERE b IS NOT NULL
), hexed AS (
  SELECT kind, gram, hex(encode(gram)) AS h FROM (SELECT DISTINCT kind, gram FROM grams)
), buckets AS MATERIALIZED (
  SELECT kind, gram, kind * 65536 + xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(len(h) // 2),
      lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
    lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1]))) % 65536 AS bucket
  FROM hexed, crc_table
), trusted AS MATERIALIZED (
  SELECT DISTINCT doc_id,
         ('0x' || substr(md5(doc_id::VARCHAR), 1, 7))::BIGINT % 5 = 1 AS held_out
  FROM labels WHERE quality = 1 AND toxic = 0 AND doc_id IS NOT NULL
), counts AS (
  SELECT bucket, kind, count(*) AS r, count(*) FILTER (l.doc_id IS NOT NULL) AS t
  FROM grams g JOIN buckets USING (kind, gram)
  LEFT JOIN (SELECT doc_id FROM trusted WHERE NOT held_out) l ON g.doc_id = l.doc_id
  GROUP BY bucket, kind
), weights AS (
  SELECT bucket, round(ln(((t + 1.0::DOUBLE) / (sum(t) OVER (PARTITION BY kind) + 65536))
    / ((r + 1.0::DOUBLE) / (sum(r) OVER (PARTITION BY kind) + 65536))) * 1000000)::BIGINT AS weight
  FROM counts
), scores AS (
  SELECT doc_id, count(*) AS n_grams, sum(weight)::BIGINT AS llr_sum
  FROM grams JOIN buckets USING (kind, gram) JOIN weights USING (bucket) GROUP BY doc_id
), measured AS (
  SELECT d.doc_id, len(words)::BIGINT AS n_words,
         length(array_to_string(words, ''))::BIGINT AS word_chars,
         (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(n_grams, 0) AS n_grams, coalesce(llr_sum, 0) AS llr_sum
  FROM docs d LEFT JOIN lines l ON d.doc_id = l.doc_id
  LEFT JOIN repeats r ON d.doc_id = r.doc_id LEFT JOIN scores s ON d.doc_id = s.doc_id
), judged AS MATERIALIZED (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         floor(llr_sum / (n_grams * 1000))::BIGINT AS step
  FROM measured
), held AS (
  SELECT step, row_number() OVER (ORDER BY step) AS place, count(*) OVER () AS n
  FROM judged JOIN trusted USING (doc_id) WHERE held_out AND NOT base_failed
), lowest AS (SELECT min(step) AS least FROM held WHERE place * 100 > n)
SELECT * EXCLUDE (step),
       NOT base_failed AND coalesce(step >= (SELECT least FROM lowest), true) AS kept
FROM judged
""",
    "op2_url_lists": r"""
WITH parsed AS (
  SELECT page_id, url,
    lower(regexp_extract(coalesce(url, ''),
      '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
    regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path,
    ('0x' || substr(md5(coalesce(url, '')), 1, 7))::BIGINT % 365 * 86400 + page_id % 86400
      AS fetched_at
  FROM pages
), labelled AS (SELECT *, string_split(host, '.') AS parts FROM parsed WHERE host <> ''
), covered AS (
  SELECT page_id, unnest(list_transform(range(1, len(parts) + 1),
                         lambda i: array_to_string(parts[i:], '.'))) AS entry FROM labelled
  UNION SELECT page_id, host || path FROM labelled WHERE length(path) > 1
), numbered AS (
  SELECT entry, ('0x' || substr(md5(entry), 1, 7))::BIGINT AS n
  FROM (SELECT DISTINCT entry FROM covered)
), log AS (
  SELECT 'block' AS list, entry, true AS added, n % 300 * 86400 AS since FROM numbered WHERE n % 3 = 0
  UNION ALL SELECT 'block', entry, false, (n % 300 + 20 + n % 90) * 86400
  FROM numbered WHERE n % 6 = 0
  UNION ALL SELECT 'block', entry, true, (n % 300 + 35 + n % 90) * 86400
  FROM numbered WHERE n % 30 = 0
  UNION ALL SELECT 'allow', entry, true, (n % 300 + 100) % 300 * 86400
  FROM numbered WHERE n % 7 = 0
), states AS (
  SELECT *, lead(since) OVER (PARTITION BY list, entry ORDER BY since) AS valid_to FROM log
), active AS (
  SELECT p.page_id, s.list, s.entry,
    row_number() OVER (PARTITION BY p.page_id
                       ORDER BY length(s.entry) DESC, s.list, s.entry DESC) AS rank,
    count(*) OVER (PARTITION BY p.page_id) AS n_active
  FROM parsed p JOIN covered c USING (page_id) JOIN states s USING (entry)
  WHERE s.added AND p.fetched_at >= s.since AND (s.valid_to IS NULL OR p.fetched_at < s.valid_to)
)
SELECT p.page_id, p.host, p.fetched_at, coalesce(a.n_active, 0) AS n_active, a.entry, a.list,
       coalesce(a.list = 'allow', true) AS kept
FROM parsed p LEFT JOIN active a ON p.page_id = a.page_id AND a.rank = 1
""",
    "op3_warc": r"""
WITH hashed AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha1(encode(coalesce(html, ''))) AS h
  FROM pages
), digits AS (
  SELECT page_id, list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + (('0x' || substr(h, 1 + 10 * (i // 8), 10))::BIGINT >> (35 - 5 * (i % 8))) % 32, 1)) AS d
  FROM hashed
), firsts AS (SELECT h, min(page_id) AS first FROM hashed GROUP BY h)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, array_to_string(d, '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM hashed JOIN digits USING (page_id) JOIN firsts USING (h)
""",
    "op4_line_dedup": r"""
WITH cut AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM cut
), shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT k.doc_id, k.pos, k.line, s.key IS NOT NULL AND k.doc_id <> s.keeper AS dropped
  FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), ''))
         AS kept_sha256
FROM marked GROUP BY doc_id
""",
    "op12_mixture": r"""
WITH RECURSIVE sized AS MATERIALIZED (
  SELECT row_number() OVER () AS row_id, doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(concat_ws('|', 'mix', doc_id, md5(coalesce(text, '')))), 1, 10))::BIGINT
           AS hash
  FROM documents
), sources AS MATERIALIZED (
  SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS most,
         row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS number,
         [5, 2, 1][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1] AS weight,
         (sum(sum(size)) OVER ())::BIGINT AS total
  FROM sized GROUP BY source
), shared AS (
  SELECT 0 AS round, number, weight, most, total, false AS topped, true AS changed FROM sources
  UNION ALL
  SELECT round + 1, number, weight, most, total, now_topped, bool_or(now_topped <> topped) OVER ()
  FROM (
    SELECT *, topped OR (total - coalesce(sum(most) FILTER (topped) OVER (), 0))::BIGINT
        / (sum(weight) FILTER (NOT topped) OVER ())::BIGINT * weight > most AS now_topped
    FROM shared WHERE changed)
), rests AS (
  SELECT *, (total - coalesce(sum(most) FILTER (topped) OVER (), 0))::BIGINT
      / (sum(weight) FILTER (NOT topped) OVER ())::BIGINT * weight AS share
  FROM (SELECT * FROM shared WHERE round = (SELECT max(round) FROM shared))
), targets AS MATERIALIZED (
  SELECT s.*, CASE WHEN r.topped OR s.total = 0 THEN s.most::DOUBLE ELSE r.share END AS target,
         (source_size + 63) // 64 AS n_blocks,
         ceil(sqrt((sum((source_size + 63) // 64) OVER ())::DOUBLE))::BIGINT AS per_shard,
         (s.total + 32) // 64 AS seats
  FROM sources s JOIN rests r USING (number)
), of_sources AS MATERIALIZED (
  SELECT number, count(*) AS seats FROM (
    SELECT number, seats, row_number() OVER (ORDER BY target / (2 * n + 1) DESC, number) AS place
    FROM (SELECT *, unnest(range(seats)) AS n FROM targets WHERE target > 0)
  ) WHERE place <= seats GROUP BY number
), shards AS MATERIALIZED (
  SELECT number, source, shard, least(per_shard, n_blocks - shard * per_shard) AS blocks,
         shard * per_shard AS first, least(coalesce(q.seats, 0), 3 * n_blocks) AS of_source
  FROM (SELECT *, unnest(range((n_blocks + per_shard - 1) // per_shard)) AS shard FROM targets
        WHERE n_blocks > 0) t LEFT JOIN of_sources q USING (number)
), of_shards AS MATERIALIZED (
  SELECT number, shard, count(*) AS quota FROM (
    SELECT number, shard, of_source, row_number() OVER (
      PARTITION BY number ORDER BY blocks / (2 * n + 1) DESC, shard) AS place
    FROM (SELECT *, unnest(range(of_source)) AS n FROM shards)
  ) WHERE place <= of_source GROUP BY number, shard
), blocks AS MATERIALIZED (
  SELECT number, block, quota // blocks + (row_number() OVER (
           PARTITION BY number, shard ORDER BY hash, block) <= quota % blocks)::BIGINT AS copies
  FROM (
    SELECT number, shard, blocks, block, coalesce(quota, 0) AS quota,
      ('0x' || substr(md5('mix|' || coalesce('s' || source, 'n') || '|' || block), 1, 10))::BIGINT
        AS hash
    FROM (SELECT *, unnest(range(first, first + blocks)) AS block FROM shards)
    LEFT JOIN of_shards USING (number, shard))
), placed AS MATERIALIZED (
  SELECT d.*, number, source_size, target, coalesce(sum(size) OVER (
      PARTITION BY number
      ORDER BY hash % greatest(1, (n_blocks + per_shard - 1) // per_shard), hash,
               doc_id NULLS FIRST, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begins
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), taken AS (
  SELECT row_id, sum((least(begins + size, 64 * block + 64) - greatest(begins, 64 * block)) * copies) AS taken
  FROM (SELECT *, unnest(range(begins // 64, (begins + size - 1) // 64 + 1)) AS block
        FROM placed WHERE size > 0)
  JOIN blocks USING (number, block) GROUP BY row_id
)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken
FROM placed LEFT JOIN taken USING (row_id)
""",
    "op13_prefix_trie": r"""
WITH crc_table AS MATERIALIZED (
  SELECT list_transform(range(256), lambda n: list_reduce(
    list_prepend(n, range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END)) AS t
), turns AS MATERIALIZED (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           sha256(octet_length(encode(coalesce(role, ''))) || ' ' || coalesce(role, '')
             || coalesce(text, ''))) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS MATERIALIZED (
  SELECT conv_id, conv_id - conv_id % 5 AS first, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(length(name)), lambda i: ascii(name[i + 1])::BIGINT)),
    lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1]))) % 9 AS h
  FROM (SELECT DISTINCT conv_id, conv_id::VARCHAR AS name FROM turns), crc_table
), remade AS (
  SELECT c.conv_id, 0 AS part, place, role, text
  FROM convs c JOIN turns t ON t.conv_id = c.first AND t.place < c.h
  UNION ALL
  SELECT c.conv_id, 1, place, role, text
  FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.place >= c.h
), prefixes AS MATERIALIZED (
  SELECT conv_id, 0 AS depth, []::VARCHAR[] AS prefix, 0 AS size FROM convs
  UNION ALL
  SELECT conv_id, row_number() OVER one, list(md5(role) || md5(text)) OVER one,
         octet_length(encode(text))
  FROM remade WINDOW one AS (PARTITION BY conv_id ORDER BY part, place
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), lasts AS (SELECT conv_id, max(depth) AS depth FROM prefixes GROUP BY conv_id
), nodes AS MATERIALIZED (
  SELECT p.depth, prefix, min(p.conv_id) AS conv_id, count(*) AS n_convs, max(size) AS size,
         sha256(coalesce(string_agg(l.conv_id::VARCHAR, ',' ORDER BY l.conv_id), '')) AS ends_sha256
  FROM prefixes p LEFT JOIN lasts l ON p.conv_id = l.conv_id AND p.depth = l.depth
  GROUP BY p.depth, prefix
), linked AS MATERIALIZED (
  SELECT n.*, up.conv_id AS parent_conv_id, coalesce(n_children, 0) AS n_children
  FROM nodes n LEFT JOIN nodes up ON up.depth = n.depth - 1 AND up.prefix = n.prefix[:n.depth - 1]
  LEFT JOIN (SELECT depth - 1 AS depth, prefix[:depth - 1] AS prefix, count(*) AS n_children
             FROM nodes WHERE depth > 0 GROUP BY 1, 2) c
    ON c.depth = n.depth AND c.prefix = n.prefix
), sums AS (
  SELECT p.depth, p.prefix, count(*) FILTER (n_children = 0) AS n_leaves,
         sum((n_convs - 1) * n.size)::BIGINT AS saved_tokens
  FROM linked n JOIN prefixes p ON p.conv_id = n.conv_id AND p.depth <= n.depth
  GROUP BY p.depth, p.prefix
)
SELECT conv_id, n.depth::BIGINT AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
       ends_sha256
FROM linked n JOIN sums s ON n.depth = s.depth AND n.prefix = s.prefix
""",
}
