"""SQL twins of the queries, for DuckDB on the same tables."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# The characters Unicode counts as white space, for trim().
SPACES = "||".join(f"chr({c})" for c in range(0x110000) if chr(c).isspace() and c < 0xD800)


def trim(x: str) -> str:
    return f"trim({x}, {SPACES})"


def ascii_(x: str) -> str:
    """Every letter the tables hold that strip_accents leaves alone is replaced."""
    for letter, group in (("ß", "ss"), ("æ", "ae"), ("œ", "oe"), ("Æ", "AE"), ("Œ", "OE"), ("—", "--"), ("–", "-"), ("…", "...")):
        x = f"replace({x}, '{letter}', '{group}')"
    return f"strip_accents({x})"


def whitelist(x: str) -> str:
    return rf"regexp_replace({x}, '[^a-z0-9_.\- ]', '', 'g')"


def name(x: str) -> str:
    return f"trim(regexp_replace({whitelist(ascii_(f'lower({trim(x)})'))}, ' +', ' ', 'g'))"


def priority(source: str = "source") -> str:
    return f"CAST(regexp_extract({source}, '[0-9]+$') AS INTEGER)"


def _exploded(pieces: str) -> str:
    return f"""SELECT source, doc_id AS file,
      CAST(generate_subscripts({pieces}, 1) - 1 AS BIGINT) AS line_no,
      unnest({pieces}) AS original FROM documents WHERE text <> ''"""


LINES = "lines AS (" + _exploded("string_split(text, chr(10))") + ")"
WORDS = "words AS (" + _exploded(r"string_split_regex(text, '\s+')") + ")"
SENTENCES = "sentences AS (" + _exploded("string_split(text, '.')") + ")"
REGISTRY = f"""registry AS (SELECT DISTINCT source AS slug, 'local' AS type,
    {priority()} % 5 = 4 AS is_email, {priority()} AS priority FROM documents)"""
PARTIAL = REGISTRY + ", partial AS (SELECT * FROM registry WHERE priority % 7 <> 3)"

NAMES = (
    LINES
    + f""", normalized AS (SELECT *, {name("original")} AS nick, {priority()} AS priority
    FROM lines), names AS (SELECT * FROM normalized WHERE nick <> '')"""
)
FIRST = """row_number() OVER (PARTITION BY nick ORDER BY priority, file, line_no) = 1"""
DEDUPED = (
    NAMES
    + f""", deduped AS (SELECT nick, priority, file, line_no, original FROM names
    QUALIFY {FIRST})"""
)
NUMBERED = (
    DEDUPED
    + """, numbered AS (SELECT nick, row_number() OVER (ORDER BY priority, file, line_no) - 1
    AS ord, count(*) OVER () AS n FROM deduped)"""
)


def _emails(words: str) -> str:
    value = f"lower({trim('original')})"
    return f"""split AS (SELECT *, {value} AS email, strpos({value}, '@') AS cut FROM {words}),
    parts AS (SELECT file, line_no, email, email[1:cut-1] AS raw_local, email[cut+1:] AS domain
      FROM split WHERE cut > 1 AND cut < length(email)),
    emails AS (SELECT file, line_no, email, {whitelist(ascii_("raw_local"))} AS local_part, domain
      FROM parts WHERE {whitelist(ascii_("raw_local"))} <> '')"""


EMAILS = WORDS + ", " + _emails("words")

BASE = "regexp_extract(path, '[^/]*$')"
SUFFIX = r"regexp_extract({0}, '^.+?(\.[^.]+)$', 1)"
PATH = """url || '/f' || page_id % 3 || '.'
    || ['csv', 'txt', 'pdf', 'html', 'zip', 'json', 'log'][page_id % 7 + 1]"""
MANIFEST = f"""paged AS (SELECT {PATH} AS path, CAST(sum(length(html)) AS BIGINT) AS length
    FROM pages GROUP BY 1),
  based AS (SELECT regexp_extract(path, '://([^/]*)', 1) AS source, path, {BASE} AS name, length,
    CAST(length(path) - length(replace(path, '/', '')) - 5 AS INTEGER) AS depth FROM paged),
  manifest AS (SELECT *, lower({SUFFIX.format("name")}) AS ext,
    name[1:length(name) - length({SUFFIX.format("name")})] AS stem FROM based)"""
PAGE_LINES = f"""page_lines AS (SELECT regexp_extract(url, '://([^/]*)', 1) AS source, {PATH} AS file,
    unnest(string_split(regexp_replace(html, '\\n$', ''), chr(10))) AS value
    FROM pages WHERE html <> '')"""

# Extensions of each category; characters and length of valid names.
CATEGORY = """CASE
    WHEN ltrim({0}, '.') IN ('txt','csv','tsv','list') THEN 'text'
    WHEN ltrim({0}, '.') IN ('zip','tar','gz','tgz','rar','7z') THEN 'archives'
    WHEN ltrim({0}, '.') IN ('jpg','jpeg','png','gif','bmp','svg') THEN 'images'
    WHEN ltrim({0}, '.') IN ('json','xml','yaml','yml') THEN 'structured'
    WHEN ltrim({0}, '.') IN ('md','rst','html','pdf','doc','docx') THEN 'documents'
    ELSE 'others' END"""
NAME_VALID = r"""(length({0}) <= 255 AND NOT regexp_matches({0}, '[<>:"/\\|?*]')
    AND NOT starts_with({0}, ' ') AND NOT ends_with({0}, ' ') AND NOT ends_with({0}, '.'))"""


def repair(x: str) -> str:
    clean = rf"""regexp_replace({x}, '[<>:"/\\|?*]', '_', 'g')"""
    ext = rf"regexp_extract({clean}, '^\.*[^.](?:.|\n)*?(\.[^.]*)$', 1)"
    cut = f"""CASE WHEN length({clean}) <= 255 THEN {clean} WHEN {ext} = '' THEN {clean}[1:255]
      ELSE {clean}[1:least(250, length({clean}) - length({ext}))] || {ext} END"""
    return f"coalesce(nullif(rtrim({trim(cut)}, '.'), ''), 'unnamed_file')"


# --- sources ---

ORACLE["source_registry"] = f"WITH {REGISTRY} SELECT slug, type, is_email, priority FROM registry"
ORACLE["registry_check"] = f"""WITH {REGISTRY} SELECT count(*) AS n_sources,
  count(DISTINCT slug) = count(*) AS slugs_unique,
  count(DISTINCT priority) = count(*) AS priorities_unique FROM registry"""
ORACLE["scan_lines"] = f"""WITH {LINES}, trimmed AS (SELECT source, {trim("original")} AS original
  FROM lines) SELECT source, original, count(*) AS n FROM trimmed WHERE original <> ''
  GROUP BY ALL"""
for _key in ("scan_csv", "scan_tsv", "scan_json", "scan_parquet"):
    ORACLE[_key] = """SELECT 'events' AS source, props AS original, count(*) AS n
      FROM events GROUP BY ALL"""

ORACLE["scan_csv_records"] = """SELECT 'documents' AS source, text AS original, count(*) AS n
  FROM documents GROUP BY ALL"""
ORACLE["scan_source"] = """SELECT 'all' AS source, ext_rank, original, count(*) AS n FROM (
    SELECT 1 AS ext_rank, props AS original FROM events UNION ALL SELECT 2, n_name FROM nation
    UNION ALL SELECT 4, c_name FROM customer UNION ALL SELECT 4, p_name FROM part
    UNION ALL SELECT 4, s_name FROM supplier UNION ALL SELECT 4, r_name FROM region
    UNION ALL SELECT 3, n_name FROM nation)
  GROUP BY ALL"""
ORACLE["scan_plain"] = """SELECT 'all' AS source, 0 AS ext_rank, c_name AS original
  FROM customer"""
ORACLE["validate_files"] = f"""WITH {MANIFEST} SELECT path, true AS valid FROM manifest
  UNION SELECT path || 'x', false FROM manifest
  UNION SELECT array_to_string(string_split(path, '/')[:4], '/'), true FROM manifest"""
ORACLE["binary_flags"] = """SELECT source, ext, is_binary, by_name, by_content, 1::BIGINT AS n
  FROM (SELECT DISTINCT source FROM documents), (VALUES ('.txt', false, false, false),
    ('.parquet', true, false, true), ('.gz', true, true, true), ('.gz', true, true, NULL))
    AS kinds(ext, is_binary, by_name, by_content)"""
ORACLE["listed_files"] = """SELECT 'source=' || source AS folder, 0 AS depth, '' AS name, ext, hidden,
    false AS empty, 1::BIGINT AS n FROM (SELECT DISTINCT source FROM documents),
    (VALUES ('.txt', false), ('.crc', true)) AS kinds(ext, hidden)
  UNION ALL VALUES ('', -1, '_SUCCESS', '', true, true, 1), ('', -1, '._SUCCESS.crc', '.crc', true, false, 1)"""

_QUARANTINE = f"""{MANIFEST}, {SENTENCES}, {EMAILS}, quarantine AS (
  SELECT source, path AS file, CAST(NULL AS BIGINT) AS line_no, 'read' AS phase,
    'unsupported format' AS reason, name AS raw FROM manifest
    WHERE ext NOT IN ('.csv', '.txt', '.json', '.parquet', '.tsv', '', '.md')
  UNION ALL SELECT source, CAST(file AS VARCHAR), line_no, 'normalize', 'empty name', original
    FROM sentences WHERE {name("original")} = ''
  UNION ALL SELECT source, CAST(file AS VARCHAR), line_no, 'emails', 'no email', original
    FROM words w WHERE contains(original, '@') AND NOT EXISTS (SELECT 1 FROM emails e
      WHERE e.file = w.file AND e.line_no = w.line_no))"""
ORACLE["quarantine"] = f"WITH {_QUARANTINE} SELECT * FROM quarantine"
ORACLE["error_summary"] = f"""WITH {_QUARANTINE} SELECT phase, reason, count(*) AS n_errors
  FROM quarantine GROUP BY ALL"""
ORACLE["quarantine_files"] = """SELECT 'events' AS source, 'read' AS phase, 'no JSON' AS reason,
    '{broken ' || event_id AS raw, count(*) AS n FROM events WHERE event_id % 10 = 0 GROUP BY ALL
  UNION ALL SELECT 'events', 'read', 'too many fields',
    event_type || chr(9) || event_type || chr(9) || event_type, count(*)
  FROM events WHERE event_id % 50 = 7 GROUP BY ALL
  UNION ALL SELECT 'events', 'read', 'file left out', NULL, 1"""
ORACLE["source_union"] = " UNION ALL ".join(
    f"""SELECT '{t}' AS source, '{t}' AS file, CAST({key} AS BIGINT) AS line_no,
    {value} AS original FROM {t}"""
    for t, value, key in (
        ("customer", "c_name", "c_custkey"),
        ("supplier", "s_name", "s_suppkey"),
        ("part", "p_name", "p_partkey"),
        ("nation", "n_name", "n_nationkey"),
        ("region", "r_name", "r_regionkey"),
    )
)
# Fixed value: what a strict name may be.
STRICT = "'^[a-z0-9_.-]{1,32}$'"
ORACLE["merge_lists"] = rf"""WITH spoken AS (SELECT role,
    unnest(string_split_regex(text, '\s+')) AS word FROM conversations
    WHERE role IN ('user', 'system', 'assistant')),
  named AS (SELECT CASE role WHEN 'user' THEN 0 WHEN 'system' THEN 1 ELSE 2 END AS list_no,
    {ascii_(f"lower({trim('word')})")} AS nick FROM spoken)
  SELECT nick, CAST(min(list_no) AS INTEGER) AS list_no FROM named
  WHERE regexp_matches(nick, {STRICT}) GROUP BY nick"""
ORACLE["link_titles"] = f"""WITH anchors AS (SELECT page_id, url,
    regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS targets,
    regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS titles FROM pages),
  flat AS (SELECT page_id, CAST(generate_subscripts(titles, 1) - 1 AS BIGINT) AS line_no,
    unnest(titles) AS title, unnest(targets) AS target,
    regexp_extract(url, '^https?://[^/]*') AS host FROM anchors),
  named AS (SELECT page_id, line_no, {ascii_(f"lower({trim('title')})")} AS nick FROM flat)
  SELECT * FROM named WHERE regexp_matches(nick, {STRICT})"""
ORACLE["email_tables"] = f"""WITH {EMAILS} SELECT email, local_part,
  CASE WHEN file % 3 = 0 THEN domain END AS domain FROM emails WHERE file % 3 < 2"""
ORACLE["manifest_valid"] = f"""WITH {MANIFEST} SELECT source, path, name, ext, length,
  ext = '.html' AND NOT starts_with(name, '.') AS valid FROM manifest"""
ORACLE["find_data_files"] = f"""WITH {MANIFEST}, ranked AS (SELECT source, path, depth,
    CAST(nullif(list_position(['.csv', '.txt', '.json', '.parquet', '.tsv'], ext), 0) AS INTEGER)
    AS ext_rank FROM manifest), judged AS (SELECT *, max(ext_rank) OVER (PARTITION BY source) AS best
    FROM ranked)
  SELECT source, path, ext_rank FROM judged
  WHERE ext_rank IS NOT NULL OR (best IS NULL AND depth = 0)"""

# --- projections, filters and string functions ---

ORACLE["pick_name_column"] = """SELECT 'customer' AS source, c_name AS nick FROM customer
  UNION ALL SELECT 'supplier', CAST(s_suppkey AS VARCHAR) FROM supplier"""
ORACLE["normalize_names"] = f"WITH {NAMES} SELECT file, line_no, nick FROM names"
ORACLE["cast_names"] = " UNION ALL ".join(
    f"""SELECT '{value}' AS source, CAST({key} AS BIGINT) AS line_no,
    CAST({value} AS VARCHAR) AS original FROM {t}"""
    for t, value, key in (
        ("part", "p_size", "p_partkey"),
        ("part", "p_retailprice", "p_partkey"),
        ("customer", "c_acctbal", "c_custkey"),
        ("orders", "o_custkey", "o_orderkey"),
    )
)
_STRICT_WORDS = f"""{WORDS}, strict AS (SELECT *, {ascii_(f"lower({trim('original')})")} AS nick
  FROM words), kept AS (SELECT * FROM strict WHERE regexp_matches(nick, {STRICT}))"""
ORACLE["strict_names"] = f"WITH {_STRICT_WORDS} SELECT file, line_no, nick FROM kept"
ORACLE["parse_emails"] = f"""WITH {EMAILS}
  SELECT file, line_no, email, local_part, domain FROM emails"""
ORACLE["kind_email"] = f"""WITH {WORDS} SELECT file, line_no, original FROM words
  WHERE contains(original, '@') AND contains(original, '.')"""
ORACLE["kind_name"] = f"""WITH {LINES} SELECT file, line_no, original FROM lines
  WHERE NOT contains(original, '@') AND {trim("original")} <> ''"""
ORACLE["kind_token"] = f"""WITH {WORDS} SELECT file, line_no, original FROM words
  WHERE NOT contains(original, '@') AND NOT contains(original, ' ')
  AND length({trim("original")}) > 6"""
ORACLE["registered_only"] = f"""WITH {LINES}, {PARTIAL} SELECT source, file, line_no, original
  FROM lines WHERE source IN (SELECT slug FROM partial)"""
ORACLE["registry_flags"] = f"""WITH {LINES}, {PARTIAL} SELECT source, priority, is_email,
  count(*) AS n FROM lines JOIN partial ON source = slug GROUP BY ALL"""
_FILE_NAMES = f"""{LINES}, file_names AS (SELECT url AS name FROM pages
  UNION SELECT original FROM lines)"""
ORACLE["name_valid"] = f"""WITH {_FILE_NAMES} SELECT name, {NAME_VALID.format("name")} AS valid
  FROM file_names"""
ORACLE["name_repair"] = f"""WITH {_FILE_NAMES} SELECT name, {repair("name")} AS repaired
  FROM file_names"""
for _key, _sql in (
    ("f_trim", trim("original")),
    ("f_lower", "lower(original)"),
    ("f_ascii", ascii_("original")),
    ("f_whitelist", whitelist("original")),
    ("f_collapse", trim(r"regexp_replace(original, '\s+', ' ', 'g')")),
):
    ORACLE[_key] = f"WITH {SENTENCES} SELECT file, line_no, {_sql} AS value FROM sentences"
ORACLE["path_parts"] = f"""WITH based AS (SELECT page_id, regexp_extract(url, '[^/]*$') AS name
  FROM pages) SELECT page_id, name, lower({SUFFIX.format("name")}) AS ext,
  name[1:length(name) - length({SUFFIX.format("name")})] AS stem FROM based"""
ORACLE["file_category"] = f"""WITH {MANIFEST} SELECT path, {CATEGORY.format("ext")} AS category
  FROM manifest"""

# --- duplicates ---

ORACLE["dedupe_per_file"] = f"""WITH {NAMES} SELECT source, file, nick, min(line_no) AS line_no
  FROM names GROUP BY ALL"""
ORACLE["dedupe_priority"] = f"WITH {DEDUPED} SELECT nick, priority, file, line_no FROM deduped"
ORACLE["dedupe_unordered"] = f"WITH {NAMES} SELECT DISTINCT nick FROM names"
ORACLE["dedupe_lines"] = f"""WITH {LINES} SELECT original AS value, file, line_no FROM lines
  QUALIFY row_number() OVER (PARTITION BY original ORDER BY file, line_no) = 1"""
ORACLE["dedupe_trimmed"] = f"""WITH {SENTENCES} SELECT DISTINCT {trim("original")} AS value
  FROM sentences WHERE {trim("original")} <> ''"""
_PARTS = """parts_of AS (SELECT 'email' AS part, email AS value FROM emails
  UNION SELECT 'local_part', local_part FROM emails UNION SELECT 'domain', domain FROM emails)"""
ORACLE["email_uniques"] = f"WITH {EMAILS}, {_PARTS} SELECT part, value FROM parts_of"
ORACLE["combined_names"] = f"""WITH {NAMES}, {EMAILS}
  SELECT nick FROM names UNION SELECT local_part FROM emails"""
ORACLE["incremental_new"] = f"""WITH {NAMES} SELECT DISTINCT nick FROM names WHERE priority >= 10
  AND nick NOT IN (SELECT nick FROM names WHERE priority < 10)"""

# --- counts ---

ORACLE["count_by_source"] = f"""WITH {LINES} SELECT source, count(*) AS n_rows FROM lines
  GROUP BY source"""
ORACLE["new_uniques"] = f"""WITH {DEDUPED}, {REGISTRY}, added AS (SELECT slug, r.priority,
    count(nick) AS n_new FROM registry r LEFT JOIN deduped d ON d.priority = r.priority GROUP BY ALL)
  SELECT *, CAST(sum(n_new) OVER (ORDER BY priority) AS BIGINT) AS n_total FROM added"""
ORACLE["raw_counts"] = f"""WITH {PAGE_LINES} SELECT source, file, count(*) AS n_lines
  FROM page_lines WHERE NOT ends_with(file, '.pdf') AND NOT ends_with(file, '.zip') GROUP BY ALL"""
ORACLE["dir_totals"] = f"""WITH {MANIFEST}, {PAGE_LINES}, counted AS (SELECT source,
    count(*) AS n_lines FROM page_lines GROUP BY source)
  SELECT m.source, count(*) AS n_files, CAST(sum(length) AS BIGINT) AS n_bytes,
    coalesce(any_value(n_lines), 0) AS n_lines
  FROM manifest m LEFT JOIN counted c ON c.source = m.source GROUP BY m.source"""
_PER_FILE = "per_file AS (SELECT DISTINCT source, file, nick FROM names)"
ORACLE["run_stats"] = f"""WITH {NAMES}, {_PER_FILE}, totals AS (SELECT count(*) AS n_normalized,
    count(DISTINCT nick) AS n_deduped FROM per_file)
  SELECT *, round((1 - n_deduped / n_normalized) * 100, 6) AS duplicate_rate FROM totals"""
ORACLE["stats_total"] = ORACLE["run_stats"]
ORACLE["stats_report"] = f"""WITH {NAMES}, {REGISTRY}, kept AS (SELECT * FROM names),
  first AS (SELECT * FROM kept QUALIFY {FIRST}),
  raw_n AS (SELECT source, count(*) AS n FROM lines GROUP BY source),
  norm_n AS (SELECT source, count(DISTINCT (file, nick)) AS n FROM kept GROUP BY source),
  new_n AS (SELECT priority, count(*) AS n FROM first GROUP BY priority),
  joined AS (SELECT slug AS source, p.priority, coalesce(r.n, 0) AS n_raw,
    coalesce(m.n, 0) AS n_normalized, coalesce(w.n, 0) AS n_new FROM registry p
    LEFT JOIN raw_n r ON r.source = slug LEFT JOIN norm_n m ON m.source = slug
    LEFT JOIN new_n w ON w.priority = p.priority)
  SELECT *, CAST(sum(n_new) OVER (ORDER BY priority) AS BIGINT) AS n_total FROM joined"""
ORACLE["has_valid_data"] = f"""WITH {MANIFEST}, listed AS (SELECT * FROM manifest)
  SELECT h.slug, coalesce(bool_or(ext = '.html' AND NOT starts_with(name, '.')), false) AS has_data
  FROM (SELECT DISTINCT regexp_extract(url, '://([^/]*)', 1) AS slug FROM pages) h
  LEFT JOIN listed ON source = slug GROUP BY h.slug"""
ORACLE["export_stats"] = f"""WITH {NAMES}, {EMAILS}, both_ AS (SELECT nick FROM names
    UNION SELECT local_part FROM emails)
  SELECT (SELECT count(DISTINCT email) FROM emails) AS n_emails,
    (SELECT count(DISTINCT local_part) FROM emails) AS n_local_parts,
    (SELECT count(DISTINCT nick) FROM names) AS n_names,
    (SELECT count(*) FROM both_) AS n_combined"""

ORACLE["export_estimates"] = f"""WITH {NAMES}, {EMAILS}
  SELECT 'email' AS part, count(DISTINCT email) AS n, true AS near FROM emails
  UNION ALL SELECT 'local_part', count(DISTINCT local_part), true FROM emails
  UNION ALL SELECT 'name', count(DISTINCT nick), true FROM names"""

# --- joins ---

ORACLE["with_original"] = f"""WITH {NAMES}, {PARTIAL},
  kept AS (SELECT * FROM names WHERE source IN (SELECT slug FROM partial)),
  first AS (SELECT nick, original FROM kept QUALIFY {FIRST})
  SELECT n.nick, coalesce(f.original, n.nick) AS original
  FROM (SELECT DISTINCT nick FROM names) n LEFT JOIN first f ON f.nick = n.nick"""
ORACLE["stale_sources"] = f"""WITH {PARTIAL} SELECT DISTINCT source FROM documents
  WHERE source NOT IN (SELECT slug FROM partial)"""
ORACLE["missing_sources"] = f"""WITH {LINES}, {REGISTRY} SELECT slug FROM registry
  WHERE slug NOT IN (SELECT source FROM lines
    WHERE contains(original, '@') AND contains(original, '.'))"""
ORACLE["files_by_source"] = """SELECT source, d.doc_id AS path FROM documents d
  JOIN labels l ON l.doc_id = d.doc_id WHERE quality = 1"""

# --- positions and outputs ---

ORACLE["global_ordinal"] = f"WITH {NUMBERED} SELECT nick, ord FROM numbered"
ORACLE["export_blocks"] = f"""WITH {NUMBERED} SELECT ord // 1000 AS block,
  string_agg(nick, ',' ORDER BY ord) || ',' AS line FROM numbered GROUP BY ord // 1000"""
ORACLE["export_kinds"] = f"""WITH {WORDS}, unique_ AS (SELECT DISTINCT {trim("original")} AS value
    FROM words WHERE {trim("original")} <> '')
  SELECT 'email' AS kind, value FROM unique_ WHERE contains(value, '@') AND contains(value, '.')
  UNION ALL SELECT 'name', value FROM unique_ WHERE NOT contains(value, '@')
  UNION ALL SELECT 'token', value FROM unique_ WHERE NOT contains(value, '@')
    AND NOT contains(value, ' ') AND length(value) > 6"""
ORACLE["write_lines"] = f"WITH {NUMBERED} SELECT nick, ord FROM numbered"
ORACLE["write_forced"] = f"""WITH {WORDS} SELECT false AS force, original, count(*) AS n FROM words
    WHERE contains(original, 'a') GROUP BY ALL
  UNION ALL SELECT true, original, count(*) FROM words WHERE contains(original, 'e') GROUP BY ALL"""
ORACLE["split_fixed"] = f"""WITH {LINES}, placed AS (SELECT original AS value,
    row_number() OVER (ORDER BY file, line_no) - 1 AS ord FROM lines)
  SELECT format('chunk_{{:03d}}.txt', ord // 1000 + 1) AS chunk_file, ord % 1000 AS line, value
  FROM placed"""
ORACLE["split_comma"] = f"""WITH {NUMBERED}
  SELECT format('chunk_{{:03d}}.txt', ord // 1000 + 1) AS chunk_file, ord,
    CASE WHEN ord < n - 1 THEN nick || ',' ELSE rtrim(nick, ',') END AS line FROM numbered"""
ORACLE["split_comma_perfile"] = f"""WITH {NUMBERED}
  SELECT format('split_{{:03d}}.txt', ord // 1000 + 1) AS chunk_file, ord,
    CASE WHEN ord = n - 1 OR ord % 1000 = 999 THEN nick ELSE nick || ',' END AS line FROM numbered"""
ORACLE["split_sample"] = f"""WITH {NUMBERED}
  SELECT format('chunk_{{:03d}}.txt', ord // 100 + 1) AS chunk_file, ord, nick
  FROM numbered WHERE ord < 200"""

# A target differs from the name by the rank among files of one name. Numbers that real
# names use up are passed over: the j-th file takes the j-th free number.
_TARGETS = """ranked AS (SELECT *, row_number() OVER (PARTITION BY category, label ORDER BY path) - 1
    AS rank FROM labelled),
  used AS (SELECT DISTINCT r.category, r.label, CAST(regexp_extract(o.label_stem, '_([1-9][0-9]{0,16})$', 1)
      AS BIGINT) AS number
    FROM (SELECT DISTINCT category, label, label_stem, label_ext FROM ranked WHERE rank > 0) r
    JOIN labelled o ON o.category = r.category AND o.label_ext = r.label_ext
      AND regexp_matches(o.label_stem, '_[1-9][0-9]{0,16}$')
      AND regexp_replace(o.label_stem, '_[1-9][0-9]{0,16}$', '') = r.label_stem),
  gaps AS (SELECT category, label, number - row_number() OVER (PARTITION BY category, label
    ORDER BY number) AS free_below FROM used),
  targeted AS (SELECT r.*, rank + (SELECT count(*) FROM gaps g WHERE g.category = r.category
      AND g.label = r.label AND g.free_below < rank) AS number FROM ranked r),
  final AS (SELECT *, CASE WHEN rank = 0 THEN label
    ELSE label_stem || '_' || number || label_ext END AS target FROM targeted)"""


def _labelled(label: str, where: str) -> str:
    suffix = SUFFIX.format("label")
    return f"""named AS (SELECT *, {label} AS label FROM manifest WHERE {where}),
  labelled AS (SELECT *, {CATEGORY.format(f"lower({suffix})")} AS category, {suffix} AS label_ext,
    label[1:length(label) - length({suffix})] AS label_stem FROM named)"""


ORACLE["conflict_suffix"] = f"""WITH {MANIFEST}, {_labelled("name", "true")}, {_TARGETS}
  SELECT path, category, name, target FROM final"""

# --- streams and whole jobs ---

ORACLE["stream_dedupe"] = f"WITH {LINES} SELECT DISTINCT original AS value FROM lines"
ORACLE["stream_normalize"] = ORACLE["normalize_names"]
ORACLE["stream_append_new"] = ORACLE["stream_dedupe"]
ORACLE["consolidate"] = f"""WITH {NAMES}
  SELECT nick, priority, file, line_no, original FROM names QUALIFY {FIRST}"""
ORACLE["consolidate_strict"] = f"""WITH {_STRICT_WORDS}, {REGISTRY},
  ranked AS (SELECT kept.*, priority FROM kept JOIN registry ON source = slug)
  SELECT nick, priority, file, line_no FROM ranked QUALIFY {FIRST}"""
ORACLE["consolidate_by_kind"] = f"""WITH {WORDS}, unique_ AS (SELECT original AS value, file, line_no
    FROM words QUALIFY row_number() OVER (PARTITION BY original ORDER BY file, line_no) = 1),
  placed AS (SELECT value, row_number() OVER (ORDER BY file, line_no) - 1 AS ord,
    count(*) OVER () AS n FROM unique_),
  split_ AS (SELECT value, CAST(ord // 1000 + 1 AS INTEGER) AS chunk,
    CASE WHEN ord < n - 1 THEN {trim("value")} || ',' ELSE rtrim({trim("value")}, ',') END AS line
    FROM placed)
  SELECT 'email' AS kind, * FROM split_ WHERE contains(value, '@') AND contains(value, '.')
  UNION ALL SELECT 'name', * FROM split_ WHERE NOT contains(value, '@') AND {trim("value")} <> ''
  UNION ALL SELECT 'token', * FROM split_ WHERE NOT contains(value, '@')
    AND NOT contains(value, ' ') AND length({trim("value")}) > 6"""
ORACLE["email_report"] = f"""WITH {NAMES}, {EMAILS}, {_PARTS}
  SELECT part, value FROM parts_of
  UNION ALL SELECT 'name', nick FROM (SELECT DISTINCT nick FROM names)
  UNION ALL SELECT 'combined', nick FROM (SELECT nick FROM names UNION SELECT local_part FROM emails)"""
# Extensions of binary files.
_BINARY = """'.zip', '.rar', '.gz', '.tar', '.7z', '.exe', '.bin', '.dat', '.pdf', '.png',
    '.jpg', '.jpeg', '.gif', '.mp3', '.mp4', '.avi', '.mov', '.mkv', '.iso', '.dll',
    '.so', '.dylib', '.jar', '.class', '.pyc', '.pyd', '.obj', '.o', '.lib', '.a'"""
ORACLE["manifest_plan"] = f"""WITH {MANIFEST},
  {_labelled(f"CASE WHEN {NAME_VALID.format('name')} THEN name ELSE {repair('name')} END", "true")},
  {_TARGETS}
  SELECT source, path, name,
    ext IN ('.txt', '.csv', '.parquet', '.json', '.tsv') AND NOT starts_with(name, '.') AS valid,
    ext IN ({_BINARY}) AS is_binary, {NAME_VALID.format("name")} AS name_ok, category, target
  FROM final"""
