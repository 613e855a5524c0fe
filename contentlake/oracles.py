"""Independent DuckDB statements for the named queries.

They take other routes than the Spark code where SQL allows: theta joins instead of prefix
equi joins, recursive unions instead of loops, row-wise windows instead of blocked sums.
"""

from __future__ import annotations

from .fixtures import ORIGIN, with_views

ORACLES: dict[str, str] = {}


def oracle(name: str, sql: str, *views: str) -> None:
    ORACLES[name] = with_views(sql.strip(), *views) if views else sql.strip()


# --- expression templates -------------------------------------------------------------------


def _no_query(x: str) -> str:
    return rf"regexp_replace(trim({x}), '[?#].*$', '')"


def _slashed(path: str) -> str:
    return rf"regexp_replace(concat('/', {path}, '/'), '/+', '/', 'g')"


def norm(x: str) -> str:
    """Normalised URL for the spellings the views contain (http/https or root-relative)."""
    q = _no_query(x)
    return rf"""CASE WHEN trim({x}) = '' OR {x} IS NULL THEN NULL
        WHEN regexp_matches({q}, '^https?://[^/]') THEN concat(regexp_extract({q}, '^https?://[^/]+'), {_slashed(f"regexp_replace({q}, '^https?://[^/]+', '')")})
        ELSE {_slashed(q)} END"""


def absolute(x: str) -> str:
    n = norm(x)
    return rf"(CASE WHEN ({n}) LIKE '/%' THEN concat('{ORIGIN}', ({n})) ELSE ({n}) END)"


def no_vars(x: str) -> str:
    return rf"regexp_replace(regexp_replace({x}, '\$is_args\$args', '', 'g'), '\$[A-Za-z0-9_]+', '', 'g')"


def stripped(x: str) -> str:
    return absolute(no_vars(x))


EMAIL = r"[\pL\pN_.\-]+@[\pL\pN_.\-]+\.[\pL\pN_]+"
WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def scrubbed(x: str) -> str:
    return (
        rf"CASE WHEN regexp_matches({x}, '{EMAIL}') THEN regexp_replace(regexp_replace(regexp_replace({x}, '{EMAIL}', '', 'g'),"
        rf" '{WS}{{2,}}', ' ', 'g'), '^{WS}+|{WS}+$', '', 'g') ELSE {x} END"
    )


# --- survey ---------------------------------------------------------------------------------

RATED = rf""", rated AS (
SELECT {norm('link_url')} AS canonical_url, q1, q2, row_id FROM v_survey
WHERE start_date <> 'n/a' AND q1 IS NOT NULL),
mapped AS (
SELECT r.*, coalesce((SELECT p.target FROM v_product p WHERE starts_with(r.canonical_url, p.prefix) ORDER BY p.ord LIMIT 1),
                     'Unknown') AS product FROM rated r)
"""

oracle("feedback_by_page", RATED + r"""
SELECT canonical_url, product, CAST(1 AS BIGINT) AS part, round(avg(q1), 2) AS avg_q1, count(q1) AS n,
       coalesce(string_agg(q2, '|||' ORDER BY row_id) FILTER (WHERE q2 IS NOT NULL), '') AS q2_comments
FROM mapped GROUP BY canonical_url, product""", "v_survey", "v_product")

# comments are numbered per page, whatever their rows are
oracle("feedback_parts", RATED + r""", stats AS (
SELECT canonical_url, product, round(avg(q1), 2) AS a, count(q1) AS n FROM mapped GROUP BY canonical_url, product),
said AS (
SELECT *, (row_number() OVER (PARTITION BY canonical_url, product ORDER BY row_id) - 1) // 500 + 1 AS part FROM mapped WHERE q2 IS NOT NULL),
parts AS (
SELECT canonical_url, product, part, string_agg(q2, '|||' ORDER BY row_id) AS text FROM said GROUP BY canonical_url, product, part)
SELECT s.canonical_url, s.product, CAST(coalesce(p.part, 1) AS BIGINT) AS part, CASE WHEN coalesce(p.part, 1) = 1 THEN a END AS avg_q1,
       CASE WHEN coalesce(p.part, 1) = 1 THEN n END AS n, coalesce(p.text, '') AS q2_comments
FROM stats s LEFT JOIN parts p ON p.canonical_url IS NOT DISTINCT FROM s.canonical_url AND p.product = s.product""", "v_survey", "v_product")

oracle("normalize_url", f"SELECT row_id, {norm('link_url')} AS url FROM v_survey", "v_survey")

oracle("resolve_url", rf"""
SELECT row_id, {absolute('current_url')} AS url,
       CASE WHEN link_url IS NULL THEN NULL
            WHEN trim(link_url) = '' OR link_url LIKE '/%' THEN current_url
            ELSE concat(regexp_extract(link_url, 'https?://[^/]+'), current_url) END AS resolved
FROM (SELECT row_id, current_url, CASE WHEN link_url LIKE ' %' THEN NULL ELSE link_url END AS link_url,
             link_url AS original FROM v_survey) s WHERE original IS NULL OR original NOT LIKE ' %'
UNION ALL
SELECT row_id, {absolute('current_url')} AS url, current_url AS resolved FROM v_survey WHERE link_url LIKE ' %'
""", "v_survey")

oracle("strip_vars", f"SELECT row_id, coalesce({stripped('link_url')}, CASE WHEN link_url IS NOT NULL THEN '' END) AS url FROM v_survey", "v_survey")

oracle("replace_literal", r"""
SELECT row_id, replace(link_url, '/en/', '/english/') AS url, coalesce(contains(link_url, '/en/'), false) AS was_changed
FROM v_survey""", "v_survey")

oracle("drop_missing_link", "SELECT row_id, link_url FROM v_survey WHERE link_url IS NOT NULL", "v_survey")
oracle("drop_keyword", "SELECT row_id, q2 FROM v_survey WHERE q2 IS NULL OR q2 NOT ILIKE '%testing%'", "v_survey")
oracle("keep_rated", r"""
SELECT v.row_id, strftime(e.ts, '%Y-%m-%d') AS day, v.q1 FROM v_survey v JOIN events e ON e.event_id = v.row_id
WHERE v.start_date <> 'n/a' AND v.q1 IS NOT NULL""", "v_survey")

oracle("survey_header_cleanup", "SELECT * FROM v_survey_raw WHERE ord <> 0", "v_survey_raw")
oracle("survey_metadata_row", "SELECT * FROM v_survey_raw WHERE ord <> 1", "v_survey_raw")
oracle("survey_export_cleanup", "SELECT * FROM v_survey_raw WHERE ord <> 1", "v_survey_raw")

oracle("exclude_ids", r"""
SELECT row_id, response_id FROM v_survey WHERE response_id NOT IN (SELECT trim(id) FROM v_exclude)""", "v_survey", "v_exclude")
oracle("excluded_report", r"""
SELECT response_id, count(*) AS n_rows FROM v_survey WHERE response_id IN (SELECT trim(id) FROM v_exclude)
GROUP BY response_id""", "v_survey", "v_exclude")

oracle("scrub_emails", rf"""
SELECT doc_id, {scrubbed('text')} AS text, CAST(len(regexp_extract_all(text, '{EMAIL}')) AS BIGINT) AS n_removed
FROM documents""")

oracle("stage_counts", r""", s AS (
SELECT link_url IS NOT NULL AS a, (q2 IS NULL OR q2 NOT ILIKE '%testing%') AS b,
       response_id NOT IN (SELECT trim(id) FROM v_exclude) AS c FROM v_survey)
SELECT CAST(0 AS BIGINT) AS stage_no, 'input' AS stage, count(*) AS rows FROM s
UNION ALL SELECT 1, 'with_link', count(*) FROM s WHERE a
UNION ALL SELECT 2, 'no_trials', count(*) FROM s WHERE a AND b
UNION ALL SELECT 3, 'not_excluded', count(*) FROM s WHERE a AND b AND c""", "v_survey", "v_exclude")

oracle("audit_changes", rf""", c AS (
SELECT CAST(row_id AS VARCHAR) AS row_key, 'normalize' AS rule, link_url AS before, {norm('link_url')} AS after FROM v_survey
UNION ALL SELECT CAST(row_id AS VARCHAR), 'scrub', q2, {scrubbed('q2')} FROM v_survey)
SELECT 'clean' AS stage, * FROM c WHERE before <> after""", "v_survey")

oracle("audit_removals", r"""
SELECT 'clean' AS stage, CAST(row_id AS VARCHAR) AS row_key,
       CASE WHEN link_url IS NULL THEN 'missing link' WHEN q2 ILIKE '%testing%' THEN 'trial answer' ELSE 'no date' END AS rule,
       CASE WHEN link_url IS NULL THEN NULL WHEN q2 ILIKE '%testing%' THEN q2 ELSE start_date END AS before,
       CAST(NULL AS VARCHAR) AS after FROM v_survey WHERE link_url IS NULL OR q2 ILIKE '%testing%' OR start_date = 'n/a'""", "v_survey")

# the redirect loop as a theta join: every URL against every rule, the longest match wins
FIRST_RULES = r"""rules AS (
SELECT prefix, arg_min(target, ord) AS target, min(ord) AS ord FROM v_redirect GROUP BY prefix)"""


def canonical(source: str) -> str:
    return rf"""matches AS (
SELECT u.link_url, arg_max(r.target, length(r.prefix)) AS target, max(length(r.prefix)) AS len
FROM (SELECT DISTINCT link_url FROM {source} WHERE link_url IS NOT NULL) u JOIN rules r ON starts_with(u.link_url, r.prefix)
GROUP BY u.link_url),
canon AS (
SELECT s.*, coalesce(m.target || substr(s.link_url, m.len + 1), s.link_url) AS canonical_url
FROM {source} s LEFT JOIN matches m ON m.link_url = s.link_url)"""


for _name in ("redirect_longest_prefix", "canonical_links"):
    oracle(_name, rf""", {FIRST_RULES},
urls AS (SELECT row_id, coalesce({stripped('link_url')}, CASE WHEN link_url IS NOT NULL AND trim(link_url) <> '' THEN '' END) AS link_url FROM v_survey),
{canonical('urls')}
SELECT row_id, link_url, canonical_url FROM canon""", "v_survey", "v_redirect")

oracle("clean_survey", rf""", {FIRST_RULES},
urls AS (
SELECT row_id, response_id, link_url AS original_link_url, {stripped('link_url')} AS link_url, {absolute('current_url')} AS current_url, q2, lat, lon
FROM v_survey WHERE link_url IS NOT NULL AND (q2 IS NULL OR q2 NOT ILIKE '%testing%')
  AND response_id NOT IN (SELECT trim(id) FROM v_exclude)),
{canonical('urls')}
SELECT c.row_id, c.response_id, c.original_link_url, c.canonical_url, c.current_url,
       replace(c.canonical_url, 'https://docs.example.com/h0/', 'https://docs.example.com/home/') AS link_url,
       {scrubbed('c.q2')} AS q2, g.country
FROM canon c LEFT JOIN v_geo_cache g ON g.lat_key = CAST(round(c.lat * 100000) AS BIGINT) AND g.lon_key = CAST(round(c.lon * 100000) AS BIGINT)
""", "v_survey", "v_redirect", "v_exclude", "v_geo_cache")

# the configuration rules name paths that no answer has
oracle("survey_file_pipeline", rf""", rated AS (
SELECT {stripped('link_url')} AS canonical_url, q1, {scrubbed('q2')} AS q2 FROM v_survey
WHERE link_url IS NOT NULL AND (q2 IS NULL OR q2 NOT ILIKE '%testing%') AND response_id NOT IN (SELECT trim(id) FROM v_exclude)
  AND start_date <> 'n/a' AND q1 IS NOT NULL),
mapped AS (
SELECT r.*, coalesce((SELECT p.target FROM v_product p WHERE starts_with(r.canonical_url, p.prefix) ORDER BY p.ord LIMIT 1), 'Unknown') AS product
FROM rated r)
SELECT canonical_url, product, round(avg(q1), 2) AS avg_q1, CAST(count(q1) AS BIGINT) AS n,
       CAST(coalesce(sum(length(q2)) + 3 * (count(q2) - 1), 0) AS BIGINT) AS comment_chars
FROM mapped GROUP BY canonical_url, product""", "v_survey", "v_exclude", "v_product")
oracle("survey_line_breaks", r"""
SELECT row_id, CASE row_id % 4 WHEN 0 THEN q2 || chr(10) || 'and "so", on' || chr(10) WHEN 1 THEN '"' || q2 || chr(13) || chr(10) || ','
                               WHEN 2 THEN chr(10) || q2 || '"' ELSE q2 END AS q2, q1 FROM v_survey""", "v_survey")
oracle("bad_coordinates", r"""
SELECT v.row_id, g.country FROM v_survey v LEFT JOIN v_geo_cache g
ON v.row_id % 4 = 3 AND g.lat_key = CAST(round(v.lat * 100000) AS BIGINT) AND g.lon_key = CAST(round(v.lon * 100000) AS BIGINT)""", "v_survey", "v_geo_cache")

# --- redirects and prefixes -----------------------------------------------------------------

oracle("redirect_dedup", f", {FIRST_RULES} SELECT ord, prefix, target FROM rules", "v_redirect")
oracle("top_redirects", f", {FIRST_RULES} SELECT ord, prefix, target FROM rules ORDER BY length(prefix) DESC, ord LIMIT 10", "v_redirect")

# row-wise windows: the segment of a line is the number of ending lines up to it
CONFIG = rf""", l AS (
SELECT file_id, line_no, trim(line) AS t FROM v_config_lines WHERE trim(line) <> ''),
m AS (
SELECT *, starts_with(t, 'location ') AS b,
       CASE WHEN t NOT LIKE '#%' THEN nullif(regexp_extract(t, '(?i)^location\b(?:\s+[^\s]+)?\s+(/[^\s{{]*)', 1), '') END AS loc,
       nullif(regexp_extract(t, '(?i)return\s+\d{{3}}\s+([^;]+);', 1), '') AS ret,
       nullif(regexp_extract(t, '^(/\S+)\s+/\S+', 1), '') AS o, nullif(regexp_extract(t, '^/\S+\s+(/\S+)', 1), '') AS w FROM l),
n AS (
SELECT *, sum(CASE WHEN b OR ret IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY file_id ORDER BY line_no) AS seg FROM m),
k AS (
SELECT *, min(CASE WHEN loc IS NOT NULL AND ret IS NULL THEN line_no END) OVER (PARTITION BY file_id, seg) AS opened,
       lead(line_no) OVER (PARTITION BY file_id ORDER BY line_no) AS nxt FROM n),
pairs AS (
SELECT k.file_id, k.line_no, k.loc AS old, (SELECT e.ret FROM n e WHERE e.file_id = k.file_id AND e.seg = k.seg + 1 AND e.ret IS NOT NULL AND NOT e.b) AS tgt
FROM k WHERE k.line_no = k.opened
UNION ALL SELECT file_id, line_no, loc, ret FROM k WHERE loc IS NOT NULL AND ret IS NOT NULL
UNION ALL SELECT file_id, line_no, o, w FROM k WHERE o IS NOT NULL AND (opened IS NULL OR line_no < opened)),
unquoted AS (SELECT file_id, line_no, old, regexp_replace({no_vars("trim(tgt, '\"')")}, '/+', '/', 'g') AS tgt FROM pairs WHERE tgt IS NOT NULL),
rules AS (
SELECT file_id, line_no, {absolute('old')} AS prefix,
       {absolute("regexp_replace(tgt, '^(https?:)/', chr(92) || '1//')")} AS target FROM unquoted)"""
CONFIG = CONFIG.replace("chr(92) || '1//'", r"'\1//'")

oracle("redirect_rules", CONFIG + " SELECT file_id, line_no, prefix, target FROM rules", "v_config_lines")
oracle("redirect_rules_table", CONFIG + r""" SELECT file_id, line_no, prefix, target FROM rules
QUALIFY row_number() OVER (PARTITION BY prefix ORDER BY file_id, line_no) = 1""", "v_config_lines")

PRODUCT = rf""", u AS (SELECT row_id, {norm('link_url')} AS url FROM v_survey)
SELECT row_id, url, coalesce((SELECT p.target FROM v_product p WHERE starts_with(u.url, p.prefix) ORDER BY p.ord LIMIT 1), 'Unknown') AS product
FROM u"""
oracle("product_map", PRODUCT, "v_survey", "v_product")
oracle("product_map_join", PRODUCT, "v_survey", "v_product")


# --- document scalars -----------------------------------------------------------------------


def _production(segments: bool) -> str:
    key = "l.prefix" if segments else "rtrim(l.prefix, '/')"
    return rf""", d AS (
SELECT doc_id, path, substr(path, instr(path, '/content/')) AS rest FROM v_md WHERE path NOT LIKE '%/content/includes%'),
h AS (
SELECT d.*, l.target, ltrim(substr(d.rest, length({key}) + 1), '/') AS leftover
FROM d LEFT JOIN v_lookup l ON starts_with(d.rest, {key})
QUALIFY row_number() OVER (PARTITION BY d.doc_id ORDER BY l.ord) = 1),
located AS (
SELECT doc_id, path, CASE WHEN target IS NULL THEN 'null'
  ELSE concat(target, '/', regexp_replace(regexp_replace(leftover, '\.md$', ''), '/_index$', ''), '/') END AS url FROM h)"""


oracle("production_url", _production(False) + " SELECT doc_id, url FROM located", "v_md", "v_lookup")
oracle("production_url_segments", _production(True) + " SELECT doc_id, url FROM located", "v_md", "v_lookup")

oracle("repo_path", r"""
SELECT doc_id, concat('/repo/content/../../../..', path) AS shifted, path AS file, substr(path, 15) AS rel_path FROM v_md""", "v_md")

# the only target folder is alpha; documents lie one folder below their doc set
RELINKED = r"""CASE WHEN doc_id % 5 = 0 THEN CASE WHEN doc_id = doc_id % 7 THEN 'page.md' ELSE concat('../s', doc_id % 7, '/page.md') END
                     ELSE concat('../alpha/s', doc_id % 7, '/page.md') END"""
oracle("relref_links", rf"""
SELECT doc_id, replace(content, concat('{{{{< relref "/alpha/s', doc_id % 7, '/page.md" >}}}}'), {RELINKED}) AS content FROM v_md""", "v_md")

ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "''"), ("&nbsp;", "\u00a0"), ("&copy;", "\u00a9"), ("&middot;", "\u00b7"), ("&amp;", "&")]


def decoded(x: str) -> str:
    for name, char in ENTITIES:
        x = f"replace({x}, '{name}', '{char}')"
    return x


def _cleaned(x: str) -> str:
    return decoded(rf"regexp_replace(regexp_replace({x}, '{WS}+', ' ', 'g'), '^ +| +$', '', 'g')")


oracle("clean_text", f"SELECT doc_id, {_cleaned('text')} AS text FROM documents")
oracle("clean_page_text", f"SELECT page_id, {_cleaned('html')} AS html FROM pages")

UNCLOSED = "(doc_id % 6 <> 0 AND doc_id % 29 <> 5 AND doc_id % 31 = 7)"
BODY = rf"CASE WHEN {UNCLOSED} THEN '' WHEN starts_with(content, '---') THEN regexp_replace(content, '(?s)^---\n.*?\n---\n', '') ELSE content END"
oracle("strip_front_matter", f"SELECT doc_id, {BODY} AS content FROM v_md", "v_md")
oracle("strip_comments", "SELECT page_id, regexp_replace(html, '(?s)<!--.*?-->', '', 'g') AS html FROM pages")
oracle("drop_shortcode_lines", r"""
SELECT doc_id, replace(content, concat('{{< versions "3.12" "latest" >}}', chr(10)), '') AS content FROM v_md""", "v_md")

BOLD = r"""replace(content, '<span style="font-weight:bold; white-space: nowrap">a-b c</span>', '**a&#8209;b&nbsp;c**')"""
oracle("spans_to_bold", f"SELECT doc_id, {BOLD} AS content FROM v_md", "v_md")
oracle("span_rewrite", f"SELECT path, {BOLD} AS new_content FROM v_md", "v_md")


def plain(x: str) -> str:
    steps = [
        (r"(?ms)^```.*?^```[^\n]*$", ""), (r"(?ms)^~~~.*?^~~~[^\n]*$", ""), (r"(?m)^(?: {4}|\t)[^\n]*$", ""),
        (r"(?s)<!--.*?-->", ""), (r"(?s)<pre\b.*?</pre>", ""), (r"!\[[^\]\n]*\]\([^)\n]*\)", ""),
        (r"\[([^\]\n]*)\]\([^)\n]*\)", r"\1"), (r"</?[A-Za-z][^<>]*>", ""), (r"(?m)^[ ]{0,3}#{1,6}[ \t]+", ""),
        (r"(?m)^[ ]{0,3}>[ ]?", ""), (r"(?m)^[ ]{0,3}(?:[-*+]|[0-9]+\.)[ \t]+", ""), (r"\*+|`+|__|~~", ""),
    ]
    for pattern, replacement in steps:
        x = f"regexp_replace({x}, '{pattern}', '{replacement}', 'g')"
    return x


oracle("markdown_to_text", f"SELECT doc_id, {plain('content')} AS plain FROM v_md", "v_md")


def counts(x: str) -> str:
    return rf"""CAST(len(regexp_extract_all({x}, '[\pL\pN_'']+')) AS BIGINT) AS words,
       CAST(len(regexp_extract_all({x}, '[.!?]+')) AS BIGINT) AS sentences,
       CAST(len(regexp_extract_all({x}, '(?i)[aeiouy]+')) AS BIGINT) AS syllables"""


GRADE = r"""CASE WHEN words > 0 THEN round(10 * (0.39::DOUBLE * words::DOUBLE / greatest(sentences, 1)::DOUBLE
       + 11.8::DOUBLE * syllables::DOUBLE / words::DOUBLE - 15.59::DOUBLE)) / 10 END AS reading_level,
       CASE WHEN words = 0 THEN 'no words' END AS error"""
oracle("reading_level", f"""WITH p AS (SELECT doc_id, {plain('text')} AS t FROM documents), c AS (SELECT doc_id, {counts('t')} FROM p)
SELECT doc_id, words, sentences, syllables, {GRADE} FROM c""")
oracle("reading_levels", f""", p AS (SELECT path, {plain('content')} AS t FROM v_md WHERE path NOT LIKE '%/_index.md'),
c AS (SELECT path, {counts('t')} FROM p) SELECT path, {GRADE} FROM c""", "v_md")

# asset types are compared in lower case only, so .JPG counts as a page
oracle("known_texts", r"""
SELECT doc_id,
       concat('Title ', source, chr(10), chr(10), 'Quote ', lang, chr(10), 'item ', doc_id, chr(10), 'See the link and code gone.', chr(10), chr(10), 'End') AS plain,
       concat('**a ', source, '** <span style="color:red">c-d</span> **e&#8209;f&nbsp;', lang, '**') AS bold,
       doc_id % 5 > 1 AS is_page, doc_id % 8 IN (1, 5, 6, 7) AS is_web FROM v_known""", "v_known")
SHOWN = r"""SELECT doc_id, CASE doc_id % 8
    WHEN 0 THEN concat('Title ', source, chr(10), 'Some soft and loud text', chr(10), 'Sub', chr(10), 'End ', doc_id)
    WHEN 1 THEN concat('one', chr(10), 'two ', source, chr(10), 'goes on', chr(10), 'three', chr(10), 'x')
    WHEN 2 THEN concat('See the ', source, ', two and [none].')
    WHEN 3 THEN concat('*not soft* # ', source, ' snake_case_', doc_id, ' and 2 * 3 * 4')
    WHEN 4 THEN concat('Run a *b* <i> or x ` y ', source, chr(10), 'Done.')
    WHEN 5 THEN concat('Name Value', chr(10), source, ' ', doc_id, ' | more', chr(10), 'After')
    WHEN 6 THEN concat('Quote ', source, chr(10), 'lazy & bold', chr(10), '*', doc_id, '*')
    ELSE concat('a ', source, ' https://e.org/', doc_id, chr(10), 'Last') END AS shown FROM v_marked"""
oracle("rendered_markdown", SHOWN, "v_marked")
oracle("rendered_reading_levels", f""", s AS ({SHOWN}) SELECT doc_id, CASE doc_id % 8
    WHEN 0 THEN 10 WHEN 1 THEN 7 WHEN 2 THEN 6 WHEN 3 THEN 8 WHEN 4 THEN 9 WHEN 5 THEN 6 WHEN 6 THEN 5 ELSE 7 END
    + len(string_split(replace(source, '-', ' '), ' ')) - 1 AS words,
    CAST(CASE doc_id % 8 WHEN 2 THEN 1 WHEN 4 THEN 1 WHEN 7 THEN 1 ELSE 0 END AS BIGINT) AS sentences FROM v_marked""", "v_marked")
oracle("known_reading_levels", r"""
SELECT doc_id, n + 1 AS words, CAST(1 AS BIGINT) AS sentences, n + 1 AS syllables,
       round(10 * (0.39::DOUBLE * (n + 1)::DOUBLE / 1::DOUBLE + 11.8::DOUBLE * (n + 1)::DOUBLE / (n + 1)::DOUBLE - 15.59::DOUBLE)) / 10 AS reading_level FROM v_known""", "v_known")

oracle("drop_timezone", r"""
SELECT event_id, CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS wall_clock FROM events""")
oracle("ensure_period", rf"""
SELECT conv_id, turn, concat(t, CASE WHEN t LIKE '%.' THEN '' ELSE '.' END) AS text
FROM (SELECT *, regexp_replace(text, '{WS}+$', '') AS t FROM conversations) c""")

# --- front matter ---------------------------------------------------------------------------

HAS_BLOCK = f"(doc_id % 6 <> 0 AND NOT {UNCLOSED})"
BLOCK = r"regexp_extract(content, '(?s)^---(\n.*?)---', 1)"
oracle("split_front_matter", rf"""
SELECT doc_id,
       CASE WHEN {HAS_BLOCK} THEN substr({BLOCK}, 2) WHEN {UNCLOSED} THEN substr(content, 5) END AS yaml_lines,
       CASE WHEN {HAS_BLOCK} THEN {BLOCK} END AS yaml_strict, CASE WHEN {HAS_BLOCK} THEN {BLOCK} END AS yaml_loose,
       CASE WHEN {HAS_BLOCK} THEN regexp_extract(content, '(?s)^---\n.*?---(.*)$', 1) END AS body FROM v_md""", "v_md")

# key/value lines of the blocks that parse; values as written
FIELDS = rf""", b AS (
SELECT doc_id, path, {BLOCK} AS y FROM v_md WHERE {HAS_BLOCK} AND doc_id % 29 <> 5),
lines AS (SELECT doc_id, path, unnest(string_split(y, chr(10))) AS line FROM b),
fields AS (
SELECT doc_id, path, regexp_extract(line, '^([^:]+): ', 1) AS key, regexp_extract(line, '^[^:]+: (.*)$', 1) AS value
FROM lines WHERE line LIKE '%: %')"""
ENCODED = r"""CASE WHEN key = 'weight' THEN value WHEN key = 'date' THEN '"2024-03-01 12:00:00"'
     WHEN value = '[concepts, misc]' THEN '["concepts", "misc"]' ELSE concat('"', value, '"') END"""
DECODED = r"""CASE WHEN key = 'date' THEN '2024-03-01 12:00:00' WHEN value = '[concepts, misc]' THEN '["concepts", "misc"]' ELSE value END"""
oracle("front_matter_map", FIELDS + f" SELECT doc_id, key, {ENCODED} AS value FROM fields", "v_md")
oracle("metadata_long", FIELDS + f" SELECT path AS file, key, {ENCODED} AS value FROM fields", "v_md")
oracle("front_matter_flat", rf""", b AS (SELECT doc_id, {BLOCK} AS y FROM v_md WHERE {HAS_BLOCK}),
lines AS (SELECT doc_id, unnest(string_split(y, chr(10))) AS line FROM b)
SELECT doc_id, regexp_extract(line, '^([^:]+): ', 1) AS key, regexp_extract(line, '^[^:]+: (.*)$', 1) AS value
FROM lines WHERE line LIKE '%: %'""", "v_md")

FULL = f"({HAS_BLOCK} AND doc_id % 29 <> 5 AND doc_id % 37 <> 8)"
MERGED = f"CASE WHEN {FULL} THEN CASE doc_id % 3 WHEN 0 THEN 'how-to,reference' WHEN 1 THEN 'concept,misc,reference' ELSE 'misc,reference' END END"
KEPT = f"CASE WHEN {FULL} THEN CASE doc_id % 3 WHEN 0 THEN 'how-to,reference' WHEN 1 THEN 'concept,reference' ELSE 'reference' END END"
INVALID = f"CASE WHEN {FULL} THEN CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'misc' END END"
REMOVED = f"CASE WHEN {FULL} THEN CASE WHEN doc_id % 8 = 1 THEN 'tags,date' ELSE 'tags' END END"
oracle("merge_types", f"SELECT doc_id, {MERGED} AS types FROM v_md", "v_md")
oracle("filter_types", f"SELECT doc_id, {KEPT} AS kept, {INVALID} AS removed FROM v_md", "v_md")
oracle("drop_keys", FIELDS + r"""
SELECT d.doc_id,
  (SELECT string_agg(key, ',' ORDER BY key) FROM fields f WHERE f.doc_id = d.doc_id AND key NOT IN ('tags', 'date')) AS kept,
  CASE WHEN d.doc_id IN (SELECT doc_id FROM fields) THEN coalesce(
    (SELECT string_agg(key, ',' ORDER BY CASE key WHEN 'tags' THEN 1 ELSE 2 END) FROM fields f WHERE f.doc_id = d.doc_id AND key IN ('tags', 'date')), '') END AS removed
FROM v_md d""", "v_md")

NEW_CONTENT = rf"""CASE WHEN {FULL} THEN concat('---', chr(10), 'title: ', source, chr(10),
  CASE WHEN doc_id % 4 = 0 THEN '' ELSE concat('docs: DOCS-', doc_id, chr(10)) END,
  'description: About ', lang, '.', chr(10), 'weight: 10', chr(10), 'type:', chr(10), '- ', replace({KEPT}, ',', concat(chr(10), '- ')), chr(10),
  '---', chr(10), chr(10), regexp_replace(content, '(?s)^---\n.*?\n---\n', '')) ELSE content END"""
oracle("rewrite_front_matter", rf"""
SELECT doc_id, {NEW_CONTENT} AS new_content, {FULL} AS changed, {FULL} AS description_fixed,
       coalesce({REMOVED}, '') AS removed_keys, coalesce({INVALID}, '') AS invalid_types
FROM (SELECT m.*, d.source, d.lang FROM v_md m JOIN documents d USING (doc_id)) v""", "v_md")
oracle("doc_tree_sink", rf"""
SELECT path, {NEW_CONTENT} AS content, {FULL} AS changed
FROM (SELECT m.*, d.source, d.lang FROM v_md m JOIN documents d USING (doc_id)) v""", "v_md")
oracle("metadata_cleanup", f"SELECT path, {REMOVED} AS removed_keys FROM v_md WHERE {FULL}", "v_md")

INVENTORY = _production(False) + rf"""
SELECT substr(path, 15) AS filename, url,
       CASE WHEN {FULL} AND doc_id % 4 <> 0 THEN concat('DOCS-', doc_id) ELSE 'null' END AS "docsID" FROM located"""
oracle("doc_inventory", INVENTORY, "v_md", "v_lookup")
oracle("report_sink", INVENTORY, "v_md", "v_lookup")

NONE = "doc_id % 6 = 0"
BROKEN = f"(NOT {NONE} AND (doc_id % 29 = 5 OR {UNCLOSED}))"
oracle("metadata_audit", FIELDS + rf""", wide AS (
SELECT doc_id, """ + ", ".join(
    f"max(CASE WHEN key = '{k}' THEN {DECODED} END) AS {k}" for k in ["title", "categories", "date", "description", "docs", "doctypes", "tags", "weight"]
) + rf""" FROM fields GROUP BY doc_id)
SELECT d.path AS file, w.title, CAST(NULL AS VARCHAR) AS "Title_", w.categories, w.date, w.description, w.docs, w.doctypes, w.tags, w.weight,
       CASE WHEN {NONE.replace('doc_id', 'd.doc_id')} THEN 'True' END AS "No metadata found",
       CASE WHEN {BROKEN.replace('doc_id', 'd.doc_id')} THEN 'True' END AS "Error in frontmatter"
FROM v_md d LEFT JOIN wide w ON w.doc_id = d.doc_id""", "v_md")
oracle("metadata_audit_long", FIELDS + rf""" SELECT path AS file, key, {DECODED} AS value FROM fields
UNION ALL SELECT path, 'No metadata found', 'True' FROM v_md WHERE {NONE}
UNION ALL SELECT path, 'Error in frontmatter', 'True' FROM v_md WHERE {BROKEN}""", "v_md")
oracle("metadata_summary", rf"""
SELECT count(*) AS total, count(*) FILTER (NOT ({NONE}) AND NOT {BROKEN}) AS valid, count(*) FILTER ({NONE}) AS no_metadata,
       count(*) FILTER ({BROKEN}) AS errors FROM v_md""", "v_md")
oracle("metadata_keys", FIELDS + " SELECT key, count(*) AS n_docs FROM fields GROUP BY key", "v_md")

oracle("bad_docs_audit", r"""
SELECT path AS file,
       CASE doc_id % 5 WHEN 1 THEN 'menu' WHEN 3 THEN 'type' WHEN 4 THEN 'No metadata found' ELSE 'Error in frontmatter' END AS key,
       CASE doc_id % 5 WHEN 0 THEN error WHEN 1 THEN '{"2024-01-01": "x"}' WHEN 2 THEN 'Circular reference detected' WHEN 3 THEN '[1, "tasks"]' ELSE 'True' END AS value
FROM v_bad""", "v_bad")
BAD_ARCHIVE = r"""
SELECT path, content IS NULL AS failed, CAST(CASE WHEN content IS NULL THEN 1 ELSE 0 END AS BIGINT) AS n_errors,
       CASE WHEN content IS NULL THEN concat('ERROR while reading ', path, ': ', error) END AS error FROM v_bad"""
oracle("bad_docs_archive", BAD_ARCHIVE, "v_bad")
oracle("bad_docs_stats", r"""
SELECT count(*) AS processed, count(content) AS success, count(*) - count(content) AS errors FROM v_bad""", "v_bad")
oracle("bad_docs_reading", "SELECT path, error FROM v_bad", "v_bad")

# --- includes -------------------------------------------------------------------------------

oracle("include_refs", r""", s AS (SELECT doc_id, string_split(content, chr(10)) AS parts FROM v_md),
n AS (SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS line_no FROM s)
SELECT doc_id, line_no, regexp_extract(line, '\{\{<\s*include\s*["'']([^"'']+)["'']\s*>\}\}', 1) AS ref
FROM n WHERE line LIKE '%{{< include %'""", "v_md")

USAGE = r""", l AS (
SELECT unnest(string_split(content, chr(10))) AS line FROM v_md UNION ALL SELECT unnest(string_split(content, chr(10))) FROM v_include),
refs AS (
SELECT regexp_extract(line, '\{\{<\s*include\s*"([^"]+)"\s*>\}\}', 1) AS ref, count(*) AS n FROM l WHERE line LIKE '%include "%' GROUP BY 1),
usage AS (
SELECT i.include_path, CAST(coalesce(sum(r.n), 0) AS BIGINT) AS uses FROM v_include i
LEFT JOIN refs r ON r.ref IN (i.include_path, concat('/', i.include_path), regexp_replace(i.include_path, '\.md$', ''))
GROUP BY i.include_path)"""
oracle("include_usage", USAGE + " SELECT * FROM usage", "v_md", "v_include")
oracle("include_unused", USAGE + " SELECT * FROM usage WHERE uses = 0", "v_md", "v_include")
oracle("include_used_once", USAGE + " SELECT * FROM usage WHERE uses = 1", "v_md", "v_include")
oracle("include_totals", USAGE + r"""
SELECT count(*) AS fragments, count(*) FILTER (uses = 0) AS unused, count(*) FILTER (uses = 1) AS used_once FROM usage""", "v_md", "v_include")

# fragments grow from the leaves; a fragment that includes itself never appears in f
EXPANDED = r""", f AS (
SELECT doc_id AS id, concat('part ', doc_id, chr(10)) AS t FROM documents WHERE doc_id % 4 = 0 AND doc_id % 50 <> 7
UNION ALL
SELECT d.doc_id, concat('part ', d.doc_id, chr(10), f.t, chr(10)) FROM f JOIN documents d ON d.doc_id = f.id + 1
WHERE d.doc_id % 4 <> 0 AND d.doc_id % 50 <> 7),
target AS (
SELECT *, CASE WHEN doc_id % 3 = 0 THEN 1 ELSE doc_id END AS inc, doc_id % 17 = 0 AS gone FROM v_md),
x AS (
SELECT g.*, concat('{{< include "/inc/', CASE WHEN gone THEN 'gone_' ELSE 'part_' END, inc, '.md" >}}') AS code,
       CASE WHEN gone THEN '' ELSE f.t END AS t FROM target g LEFT JOIN f ON f.id = g.inc)"""
ERRORS = r"""CAST(CASE WHEN gone OR t IS NULL THEN 1 ELSE 0 END AS BIGINT) AS n_errors,
       CASE WHEN gone THEN concat('missing include: inc/gone_', inc, '.md') WHEN t IS NULL THEN 'include cycle' END AS error"""
oracle("expand_includes", EXPANDED + f" SELECT path, replace(content, code, t) AS expanded, {ERRORS} FROM x", "v_md")

ARCHIVE = EXPANDED + rf""", a AS (
SELECT doc_id, path, CASE WHEN {UNCLOSED} THEN false ELSE gone END AS gone, inc, code, CASE WHEN {UNCLOSED} THEN '' ELSE t END AS t,
       {BODY} AS body FROM x WHERE path NOT LIKE '%/_index.md'),
archived AS (
SELECT path, regexp_extract(path, '^/repo/content/([^/]*)/', 1) AS doc_set,
  regexp_replace(replace(replace(replace(body, code, t), concat('{{{{< versions "3.12" "latest" >}}}}', chr(10)), ''),
          concat('{{{{< relref "/alpha/s', doc_id % 7, '/page.md" >}}}}'), {RELINKED}), '(?s)<!--.*?-->', '', 'g') AS archived,
  {ERRORS} FROM a)"""
oracle("archive_docs", ARCHIVE + " SELECT * FROM archived", "v_md")
oracle("archive_stats", ARCHIVE + r"""
SELECT count(*) AS processed, count(*) FILTER (n_errors = 0) AS success, CAST(sum(n_errors) AS BIGINT) AS errors FROM archived""", "v_md")

# --- pages and sites ------------------------------------------------------------------------

oracle("extract_links", r"""
WITH h AS (SELECT page_id, regexp_extract_all(regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', '', 'g'),
                                              '<a href="([^"]*)"', 1) AS hrefs FROM pages)
SELECT page_id, unnest(hrefs) AS href, unnest(range(len(hrefs))) AS pos FROM h""")
oracle("page_links", rf"""
WITH h AS (SELECT url, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM pages)
SELECT rtrim(url, '/') AS src, rtrim(CASE WHEN href LIKE 'http%' THEN {decoded('href')} ELSE concat(regexp_extract(url, '^https?://[^/]+'), {decoded('href')}) END, '/') AS dst FROM h""")

# links of a page by construction: its original anchors, two children, home, top, an image, another set
SITE_LINKS = rf""", p AS (
SELECT page_id, html, CASE page_id % 3 WHEN 0 THEN 'alpha' WHEN 1 THEN 'alpha-one' ELSE 'beta' END AS s,
       page_id * 2 - page_id % 3 + 3 AS child FROM pages),
q AS (SELECT *, concat('{ORIGIN}/', s, CASE WHEN page_id < 3 THEN '' ELSE concat('/p', page_id) END) AS src FROM p),
own AS (SELECT src, s, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href FROM q),
links AS (
SELECT src, s, rtrim(CASE WHEN href LIKE 'http%' THEN href ELSE concat('{ORIGIN}', href) END, '/') AS dst FROM own
UNION ALL SELECT src, s, concat('{ORIGIN}/', s, '/p', child) FROM q UNION ALL SELECT src, s, concat('{ORIGIN}/', s, '/p', child + 3) FROM q
UNION ALL SELECT src, s, concat('{ORIGIN}/', s) FROM q UNION ALL SELECT src, s, concat(src, '#top') FROM q
UNION ALL SELECT src, s, concat('{ORIGIN}/', s, '/i.png') FROM q UNION ALL SELECT src, s, concat('{ORIGIN}/', s, '-x/p1') FROM q)"""
oracle("webpage_filter", SITE_LINKS + " SELECT NOT ends_with(dst, '.png') AS is_page, count(*) AS n_links FROM links GROUP BY 1", "v_base")
oracle("strict_subpath", SITE_LINKS + " SELECT b.doc_set, src, dst FROM links JOIN v_base b ON starts_with(dst, concat(b.base, '/'))", "v_base")
oracle("odd_links", r"""
SELECT page_id, unnest(hrefs) AS href, unnest(range(len(hrefs))) AS pos
FROM (SELECT page_id, list_concat(regexp_extract_all(html, '<a href="([^"]*)"', 1), CASE page_id % 9
    WHEN 0 THEN [concat('/gt', page_id), '/next'] WHEN 1 THEN [concat('/bare', page_id)] WHEN 2 THEN [concat('/shown', page_id)]
    WHEN 3 THEN [concat('/after', page_id)] WHEN 4 THEN [concat('/first', page_id)] WHEN 5 THEN [concat('/upper', page_id)]
    WHEN 6 THEN [''] WHEN 7 THEN [] ELSE ['it''s', concat('/&amp;', page_id)] END) AS hrefs FROM pages)""")
CANDIDATES = SITE_LINKS + r""", cand AS (
SELECT DISTINCT b.doc_set, b.base, l.src, l.dst FROM links l JOIN v_base b ON starts_with(l.dst, concat(b.base, '/'))
WHERE l.dst NOT LIKE '%.png' AND l.dst NOT LIKE '%#%')"""
oracle("crawl_candidates", CANDIDATES + " SELECT * FROM cand", "v_base")
REACH = CANDIDATES + r""", reach AS (
SELECT doc_set, base AS url FROM v_base
UNION SELECT c.doc_set, c.dst FROM reach r JOIN cand c ON c.doc_set = r.doc_set AND c.src = r.url),
found AS (SELECT doc_set, url FROM reach WHERE url NOT IN (SELECT base FROM v_base))"""
oracle("crawl_reachable", REACH + " SELECT doc_set, url FROM found", "v_base")
oracle("pages_per_set", REACH + " SELECT doc_set, count(*) AS n_pages FROM found GROUP BY doc_set", "v_base")
oracle("site_inventory", REACH + " SELECT doc_set, url, substr(doc_set, 1, 31) AS section FROM found", "v_base")

oracle("dated_redirects", """
SELECT a.event_id, r.target FROM v_dated_answer a JOIN v_dated_rule r ON a.prefix = r.prefix AND a.day_no >= r.from_day AND (r.to_day IS NULL OR a.day_no < r.to_day)""", "v_dated_answer", "v_dated_rule")
oracle("commit_before_read", """
SELECT r.event_id, strftime(c.commit_ts, '%Y-%m-%d') AS committed FROM v_reading r ASOF LEFT JOIN v_commits c ON r.path = c.path AND r.day >= c.commit_ts""", "v_reading", "v_commits")
oracle("redirect_chains", """, walk AS (
SELECT prefix, target, CAST(1 AS BIGINT) AS hops FROM v_chain
UNION ALL SELECT w.prefix, c.target, w.hops + 1 FROM walk w JOIN v_chain c ON c.prefix = w.target WHERE w.hops <= 400),
ended AS (SELECT prefix, target, hops FROM walk w WHERE NOT EXISTS (SELECT 1 FROM v_chain c WHERE c.prefix = w.target))
SELECT c.prefix, coalesce(e.target, c.target) AS target, coalesce(e.hops, 0) AS hops, e.hops IS NULL AS cyclic FROM v_chain c LEFT JOIN ended e ON e.prefix = c.prefix""", "v_chain")

# --- XML ------------------------------------------------------------------------------------

XML = r""", inv AS (
SELECT doc_id, path, regexp_extract(path, '^xml/([^/]+)/', 1) AS lang,
       CASE WHEN doc_id % 9 = 0 THEN 'broken' WHEN doc_id % 4 = 0 THEN ''
            ELSE regexp_replace(replace(regexp_extract(xml, 'article name="([^"]*)"', 1), '&amp;', '&'), ' +', ' ', 'g') END AS title FROM v_xml),
newest AS (SELECT path, max(commit_ts) AS ts FROM v_commits GROUP BY path),
rows AS (
SELECT i.lang, i.path AS file, i.title, concat('https://www.example.org/', regexp_replace(substr(i.path, 5), '\.xml$', '.html')) AS link,
       coalesce(strftime(n.ts, '%Y-%m-%dT%H:%M:%S+00:00'), '') AS last_commit
FROM inv i LEFT JOIN newest n ON n.path = i.path WHERE i.lang IN ('cn', 'en', 'he', 'it', 'ja', 'ru', 'tr'))"""
oracle("xml_title", XML + " SELECT doc_id, title FROM inv", "v_xml", "v_commits")
oracle("xml_inventory", XML + " SELECT * FROM rows", "v_xml", "v_commits")
oracle("partitioned_sink", XML + " SELECT * FROM rows", "v_xml", "v_commits")
oracle("column_widths", XML + " SELECT lang, " + ", ".join(
    f"CAST(greatest(max(length({c})), {len(c)}) + 2 AS BIGINT) AS w_{c}" for c in ["file", "title", "link", "last_commit"]
) + " FROM rows GROUP BY lang", "v_xml", "v_commits")
oracle("last_commit", XML + r"""
SELECT v.path, coalesce(strftime(n.ts, '%Y-%m-%dT%H:%M:%S+00:00'), '') AS last_commit FROM v_xml v LEFT JOIN newest n ON n.path = v.path""", "v_xml", "v_commits")
oracle("xml_tree", "SELECT path, xml, regexp_extract(path, '^xml/([^/]+)/', 1) AS lang FROM v_xml WHERE path NOT LIKE 'xml/xx/%'", "v_xml")

# --- enrichment -----------------------------------------------------------------------------

KEYS = "CAST(round(lat * 100000) AS BIGINT) AS lat_key, CAST(round(lon * 100000) AS BIGINT) AS lon_key"
oracle("geo_cache_join", rf""", s AS (SELECT row_id, {KEYS} FROM v_survey)
SELECT s.row_id, g.country FROM s LEFT JOIN v_geo_cache g ON g.lat_key = s.lat_key AND g.lon_key = s.lon_key""", "v_survey", "v_geo_cache")
MISSING = rf""", s AS (SELECT DISTINCT {KEYS} FROM v_survey WHERE lat IS NOT NULL),
missing AS (SELECT s.* FROM s LEFT JOIN v_geo_cache g USING (lat_key, lon_key) WHERE g.country IS NULL)"""
oracle("geo_missing_keys", MISSING + " SELECT * FROM missing", "v_survey", "v_geo_cache")


def nearest(source: str) -> str:
    """Every point against every place by haversine."""
    return rf"""dist AS (
SELECT k.lat_key, k.lon_key, p.place_id, p.country,
       pow(sin(radians(k.lat_key / 100000 - p.lat) / 2), 2)
       + cos(radians(k.lat_key / 100000)) * cos(radians(p.lat)) * pow(sin(radians(k.lon_key / 100000 - p.lon) / 2), 2) AS h
FROM {source} k CROSS JOIN v_place p),
near AS (SELECT lat_key, lon_key, arg_min(country, (round(h, 12), place_id)) AS code FROM dist GROUP BY lat_key, lon_key)"""


oracle("nearest_place", MISSING + ", " + nearest("s") + r"""
SELECT n.lat_key, n.lon_key, coalesce(c.name, n.code) AS country FROM near n LEFT JOIN v_country c ON c.code = n.code
""", "v_survey", "v_geo_cache", "v_place", "v_country")
oracle("cache_upsert", MISSING + ", " + nearest("missing") + r"""
SELECT lat_key, lon_key, country FROM v_geo_cache UNION ALL SELECT lat_key, lon_key, code FROM near
""", "v_survey", "v_geo_cache", "v_place")

oracle("cache_append", r""", fresh AS (
SELECT CAST(round(lat * 100000) AS BIGINT) AS lat_key, CAST(round(lon * 100000) AS BIGINT) AS lon_key, concat('N', min(row_id % 7)) AS country
FROM v_survey WHERE lat IS NOT NULL GROUP BY 1, 2)
SELECT lat_key, lon_key, country FROM v_geo_cache
UNION ALL SELECT f.* FROM fresh f WHERE NOT EXISTS (SELECT 1 FROM v_geo_cache c WHERE c.lat_key = f.lat_key AND c.lon_key = f.lon_key)""", "v_survey", "v_geo_cache")
oracle("bases_file", "SELECT concat('Set ', page_id) AS doc_set, url AS base FROM pages WHERE page_id % 7 <> 0 AND page_id % 5 > 0")
oracle("report_header", """
SELECT concat('Repo path: ', count(*), ' documents') AS value FROM v_md UNION ALL SELECT concat('Date: ', strftime(current_date, '%Y-%m-%d'))""", "v_md")
oracle("clean_survey_places", MISSING + ", " + nearest("missing") + r""", known AS (
SELECT lat_key, lon_key, country FROM v_geo_cache UNION ALL SELECT lat_key, lon_key, code FROM near)
SELECT v.row_id, k.country FROM v_survey v
LEFT JOIN known k ON k.lat_key = CAST(round(v.lat * 100000) AS BIGINT) AND k.lon_key = CAST(round(v.lon * 100000) AS BIGINT)
WHERE v.link_url IS NOT NULL AND (v.q2 IS NULL OR v.q2 NOT ILIKE '%testing%')""", "v_survey", "v_geo_cache", "v_place")

# --- sources, sinks, stream -----------------------------------------------------------------

oracle("scan_doc_tree", "SELECT path, content, CAST(NULL AS VARCHAR) AS error FROM v_md", "v_md")
oracle("lookup_csv", r"""
SELECT prefix, rtrim(arg_max(target, ord), '/') AS target FROM v_redirect GROUP BY prefix""", "v_redirect")
oracle("config_file_lines", "SELECT line, count(*) AS n FROM v_config_lines WHERE line <> '' GROUP BY line", "v_config_lines")
oracle("id_list", "SELECT DISTINCT trim(id) AS id FROM v_exclude", "v_exclude")
oracle("stream_feedback", r"""
SELECT concat('https://docs.example.com/', event_type, '/') AS canonical_url, 'Secure' AS product, CAST(1 AS BIGINT) AS part,
       round(avg(value), 2) AS avg_q1, count(value) AS n, coalesce(string_agg(concat(event_type, ' ', props), '|||' ORDER BY event_id), '') AS q2_comments
FROM events WHERE value IS NOT NULL GROUP BY event_type""")
oracle("stream_corrections", r"""
SELECT concat(link_url, '/') AS canonical_url, 'Secure' AS product, CAST(1 AS BIGINT) AS part, round_even(avg(q1), 2) AS avg_q1, count(q1) AS n,
       coalesce(string_agg(q2, '|||' ORDER BY row_id) FILTER (WHERE q2 IS NOT NULL), '') AS q2_comments
FROM (SELECT * FROM v_correction c WHERE row_id = (SELECT max(row_id) FROM v_correction n WHERE n.response_id = c.response_id)) a
WHERE q1 IS NOT NULL AND start_date <> 'n/a' GROUP BY link_url""", "v_correction")
