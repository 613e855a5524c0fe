"""Derived test views: survey answers, Markdown documents, include fragments and so on.

The given tables lack these shapes, so portable SQL projects them out of whole tables. The same
text runs on Spark (for the queries) and on DuckDB (inside the oracle statements). Text uses
``chr(10)`` because the two engines read backslashes in literals differently.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ["nation", "supplier", "customer", "orders", "events", "documents", "pages", "labels", "conversations"]

ORIGIN = "https://docs.example.com"

# Each engine has its own way to turn one row into twelve.
NUMBERS = "NUMBERS_0_11"

# name -> (views it builds on, SQL)
VIEWS: dict[str, tuple[list[str], str]] = {
    # a fifth of all answers falls on page 0: the hot page
    "v_survey": ([], """
SELECT e.event_id AS row_id,
       concat('R_', CAST(e.event_id AS STRING)) AS response_id,
       CASE WHEN e.event_id % 23 = 0 THEN NULL
            WHEN e.event_id % 31 = 0 THEN concat('  ', p.url, ' ')
            WHEN e.event_id % 37 = 0 THEN concat(p.url, '$is_args$args')
            WHEN e.event_id % 41 = 0 THEN '   '
            WHEN e.event_id % 43 = 0 THEN regexp_replace(p.url, '^https?://[^/]+', '')
            ELSE p.url END AS link_url,
       regexp_replace(p.url, '^https?://[^/]+', '') AS current_url,
       CASE WHEN e.event_id % 11 = 0 THEN NULL ELSE CAST(e.event_id % 5 + 1 AS DOUBLE) END AS q1,
       CASE WHEN e.event_id % 7 = 0 THEN NULL
            WHEN e.event_id % 13 = 0 THEN concat('Testing ', e.event_type)
            WHEN e.event_id % 17 = 0 THEN concat('mail  u', CAST(e.user_id AS STRING), '@mail.example.com  now')
            ELSE concat(e.event_type, ' ok ', e.props) END AS q2,
       CASE WHEN e.event_id % 19 = 0 THEN 'n/a'
            WHEN e.event_id % 5 = 0 THEN concat(CAST(month(e.ts) AS STRING), '/', CAST(day(e.ts) AS STRING), '/', CAST(year(e.ts) AS STRING), ' 10:00')
            WHEN e.event_id % 5 = 1 THEN replace(CAST(CAST(e.ts AS DATE) AS STRING), '-', '')
            WHEN e.event_id % 5 = 2 THEN concat(substr('JanFebMarAprMayJunJulAugSepOctNovDec', CAST(month(e.ts) AS INT) * 3 - 2, 3), ' ',
                                                CAST(day(e.ts) AS STRING), ', ', CAST(year(e.ts) AS STRING))
            WHEN e.event_id % 5 = 3 THEN concat(CAST(day(e.ts) AS STRING), ' ', substr('JanFebMarAprMayJunJulAugSepOctNovDec', CAST(month(e.ts) AS INT) * 3 - 2, 3),
                                                ' ', CAST(year(e.ts) AS STRING))
            ELSE CAST(CAST(e.ts AS DATE) AS STRING) END AS start_date,
       CASE WHEN e.event_id % 29 = 0 THEN NULL
            ELSE CAST((e.user_id * 13 + e.event_id % 50) % 160 AS DOUBLE) - 80 + 0.123456789 END AS lat,
       CASE WHEN e.event_id % 29 = 0 THEN NULL ELSE CAST(e.user_id * 7 % 340 AS DOUBLE) - 170 + 0.5 END AS lon
FROM (SELECT *, CASE WHEN event_type = 'click' THEN 0 ELSE event_id % (SELECT count(*) FROM pages) END AS at_page
      FROM events) e
JOIN pages p ON p.page_id = e.at_page"""),
    "v_survey_raw": (["v_survey"], """
SELECT CAST(0 AS BIGINT) AS ord, 'Response ID' AS response_id, 'Any suggestions for improvement?' AS q2
UNION ALL SELECT CAST(1 AS BIGINT) AS ord, '{"ImportId":"_recordId"}' AS response_id, '{"ImportId":"QID2"}' AS q2
UNION ALL SELECT row_id + 2 AS ord, response_id, q2 FROM v_survey"""),
    # two rules per page; pages of one host repeat the host rule, the first one counts
    "v_redirect": ([], """
SELECT page_id * 2 AS ord, concat(regexp_extract(url, '^(https?://[^/]+)/', 1), '/') AS prefix,
       concat('https://docs.example.com/h', CAST(page_id AS STRING), '/') AS target FROM pages
UNION ALL
SELECT page_id * 2 + 1 AS ord, concat(regexp_extract(url, '^(https?://[^/]+/[^/?#]+)', 1), '/') AS prefix,
       concat('https://docs.example.com/s', CAST(page_id AS STRING), '/') AS target FROM pages"""),
    # the second key extends the first
    "v_lookup": ([], """
SELECT * FROM (VALUES (1, '/content/alpha/', 'https://docs.example.com/alpha'),
                      (2, '/content/alpha-one/', 'https://docs.example.com/one'),
                      (3, '/content/beta/', 'https://docs.example.com/beta')) AS t(ord, prefix, target)"""),
    "v_product": ([], """
SELECT * FROM (VALUES (1, 'https://m.', 'Mobile'), (2, 'https://blog.', 'Blog'),
                      (3, 'http://', 'Plain'), (4, 'https://', 'Secure')) AS t(ord, prefix, target)"""),
    "v_exclude": ([], """
SELECT concat(' R_', CAST(doc_id AS STRING), ' ') AS id FROM labels WHERE toxic = 1"""),
    # chains of up to four fragments; some include themselves
    "v_include": ([], """
SELECT doc_id, concat('inc/part_', CAST(doc_id AS STRING), '.md') AS include_path,
       concat('---', chr(10), 'title: ', source, chr(10), '---', chr(10), 'part ', CAST(doc_id AS STRING), chr(10),
              CASE WHEN doc_id % 50 = 7 THEN concat('{{< include "inc/part_', CAST(doc_id AS STRING), '.md" >}}', chr(10))
                   WHEN doc_id % 4 <> 0 THEN concat('{{< include "inc/part_', CAST(doc_id - 1 AS STRING), '.md" >}}', chr(10))
                   ELSE '' END) AS content
FROM documents"""),
    # a third of all documents include fragment 1; some blocks are broken or never closed
    "v_md": ([], """
SELECT doc_id,
       concat('/repo/content/', CASE doc_id % 5 WHEN 0 THEN 'alpha' WHEN 1 THEN 'alpha-one' WHEN 2 THEN 'beta'
                                               WHEN 3 THEN 'includes' ELSE 'other' END,
              '/s', CAST(doc_id AS STRING), CASE WHEN doc_id % 10 = 0 THEN '/_index.md' ELSE '/page.md' END) AS path,
       concat(CASE WHEN doc_id % 6 = 0 THEN ''
                   WHEN doc_id % 29 = 5 THEN concat('---', chr(10), 'title: [open', chr(10), '---', chr(10))
                   WHEN doc_id % 31 = 7 THEN concat('---', chr(10), 'title: unclosed', chr(10))
                   WHEN doc_id % 37 = 8 THEN concat('---', chr(10), 'title: plain', chr(10), 'weight: 5', chr(10), '---', chr(10))
                   ELSE concat('---', chr(10), 'title: ', source, chr(10),
                               CASE WHEN doc_id % 4 = 0 THEN '' ELSE concat('docs: DOCS-', CAST(doc_id AS STRING), chr(10)) END,
                               'description: About ', lang, chr(10),
                               CASE doc_id % 3 WHEN 0 THEN 'categories: tasks'
                                               WHEN 1 THEN 'categories: [concepts, misc]' ELSE 'categories: misc' END, chr(10),
                               'doctypes: reference', chr(10), 'weight: 10', chr(10), 'tags: x', chr(10),
                               CASE WHEN doc_id % 8 = 1 THEN concat('date: 2024-03-01T12:00:00+05:00', chr(10)) ELSE '' END,
                               '---', chr(10)) END,
              '<!-- note', chr(10), 'hidden -->', chr(10),
              '{{< versions "3.12" "latest" >}}', chr(10),
              '{{< include "/inc/', CASE WHEN doc_id % 17 = 0 THEN 'gone_' ELSE 'part_' END,
              CAST(CASE WHEN doc_id % 3 = 0 THEN 1 ELSE doc_id END AS STRING), '.md" >}}', chr(10),
              'See [x]({{< relref "/alpha/s', CAST(doc_id % 7 AS STRING), '/page.md" >}}) and ',
              '<span style="font-weight:bold; white-space: nowrap">a-b c</span>', chr(10),
              text, chr(10)) AS content
FROM documents"""),
    # documents that could not be read, with dates as inner keys, values that hold themselves, unlike types
    "v_bad": ([], """
SELECT doc_id, concat('/repo/content/alpha/s', CAST(doc_id AS STRING), '/page.md') AS path,
       CASE doc_id % 5 WHEN 0 THEN NULL
                       WHEN 1 THEN concat('---', chr(10), 'menu: {2024-01-01: x}', chr(10), '---', chr(10), 'Some words here.')
                       WHEN 2 THEN concat('---', chr(10), 'a: &x [*x]', chr(10), '---', chr(10), 'Some words here.')
                       WHEN 3 THEN concat('---', chr(10), 'type: [1, tasks]', chr(10), '---', chr(10), 'Some words here.')
                       ELSE concat('Plain words of ', source, '.') END AS content,
       CASE WHEN doc_id % 5 = 0 THEN concat('no such file: ', CAST(doc_id AS STRING)) END AS error
FROM documents"""),
    # texts whose readable form, counts and rewritten spans are known by construction
    "v_known": ([], """
SELECT doc_id, source, lang, doc_id % 50 + 1 AS n,
       concat('# Title ', source, chr(10), chr(10), '> Quote *', lang, '*', chr(10), '- item **', CAST(doc_id AS STRING), '**', chr(10),
              'See [the link](http://x/', CAST(doc_id AS STRING), ') and `code` ~~gone~~.', chr(10), '```', chr(10), 'hidden ', source, chr(10), '```', chr(10),
              '![image](a.png)<b>End</b>') AS markdown,
       concat(repeat('cat ', CAST(doc_id % 50 + 1 AS INT)), 'sat.') AS simple,
       concat('<span style="FONT-WEIGHT:BOLD">a ', source, '</span> <span style="color:red">c-d</span> ',
              '<span style="white-space:nowrap; font-weight:bolder">e-f ', lang, '</span>') AS spans,
       concat('docs/', CASE doc_id % 5 WHEN 0 THEN 'index.md' WHEN 1 THEN 'INDEX.md' WHEN 2 THEN '_index.md' WHEN 3 THEN 'myindex.md' ELSE 'page.md' END) AS path,
       concat('https://docs.example.com/f', CAST(doc_id AS STRING),
              CASE doc_id % 8 WHEN 0 THEN '.png' WHEN 1 THEN '.JPG' WHEN 2 THEN '.svg' WHEN 3 THEN '.yaml' WHEN 4 THEN '.woff' WHEN 5 THEN '.html'
                              WHEN 6 THEN '' ELSE '/png' END) AS link
FROM documents"""),
    "v_xml": ([], """
SELECT doc_id,
       concat('xml/', CASE lang WHEN 'en' THEN 'en' WHEN 'de' THEN 'ru' WHEN 'fr' THEN 'it' ELSE 'xx' END,
              '/docs/d', CAST(doc_id AS STRING), '.xml') AS path,
       CASE WHEN doc_id % 9 = 0 THEN '<module name="broken"'
            WHEN doc_id % 4 = 0 THEN '<doc><section name="no title"/></doc>'
            ELSE concat('<article name="T  ', CAST(doc_id AS STRING), ' &amp; ', source, '"><section/></article>') END AS xml
FROM documents"""),
    "v_commits": ([], """
SELECT concat('xml/', CASE o_custkey % 3 WHEN 0 THEN 'en' WHEN 1 THEN 'ru' ELSE 'it' END,
              '/docs/d', CAST(o_custkey AS STRING), '.xml') AS path, o_orderdate AS commit_ts FROM orders"""),
    # a day within the years of the commits for every event
    "v_reading": ([], """
SELECT event_id, concat('xml/', CASE user_id % 3 WHEN 0 THEN 'en' WHEN 1 THEN 'ru' ELSE 'it' END, '/docs/d', CAST(user_id AS STRING), '.xml') AS path,
       CASE WHEN event_id % 50 <> 0 THEN CAST(DATE '1994-12-01' + CAST(event_id * 37 % 2500 AS INT) AS TIMESTAMP) END AS day FROM events"""),
    "v_dated_answer": ([], """
SELECT event_id, concat('/p', CAST(CASE WHEN event_type = 'click' THEN 0 ELSE event_id % (SELECT count(*) FROM pages) END AS STRING)) AS prefix,
       CASE WHEN event_id % 40 <> 0 THEN CAST(event_id * 31 % 400 AS INT) END AS day_no FROM events"""),
    # twelve rules per page: some overlap, some are empty, the last ones are open
    "v_dated_rule": ([], """
SELECT concat('/p', CAST(page_id AS STRING)) AS prefix, CAST(k * 30 + page_id % 11 - 5 AS INT) AS from_day,
       CASE WHEN k < 11 THEN CAST(k * 30 + page_id % 11 - 5 + k * 7 % 40 AS INT) END AS to_day,
       concat('/new/', CAST(page_id AS STRING), '/', CAST(k AS STRING)) AS target
FROM (SELECT page_id, NUMBERS_0_11 AS k FROM pages) p"""),
    "v_chain": ([], """
SELECT concat('/c/', CAST(doc_id AS STRING)) AS prefix,
       CASE WHEN doc_id % 400 < 399 AND doc_id < (SELECT max(doc_id) FROM documents) THEN concat('/c/', CAST(doc_id + 1 AS STRING))
            WHEN (doc_id - doc_id % 400) / 400 % 3 = 1 THEN concat('/c/', CAST(doc_id - doc_id % 400 AS STRING))
            ELSE concat('/end/', CAST(doc_id AS STRING)) END AS target FROM documents"""),
    # two or three answers of most responses; the arrival order is not that of the answers
    "v_correction": ([], """
SELECT event_id AS row_id, concat('R_', CAST(event_id % (SELECT CAST(count(*) * 0.4 AS BIGINT) + 1 FROM events) AS STRING)) AS response_id,
       concat('https://docs.example.com/', event_type, '/', CAST(user_id % 9 AS STRING)) AS link_url,
       CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(event_id % 5 + 1 AS DOUBLE) END AS q1,
       CASE WHEN event_id % 6 = 0 THEN NULL ELSE concat(event_type, ' ', CAST(event_id AS STRING)) END AS q2,
       CASE WHEN event_id % 17 = 0 THEN 'n/a' ELSE '2024-01-05' END AS start_date, event_id * 7919 % 1000 AS arrival FROM events"""),
    # three doc sets; every page links to two deeper pages of its set, stored or not
    "v_site": ([], """
SELECT concat('https://docs.example.com/', s.doc_set, CASE WHEN s.page_id < 3 THEN '' ELSE concat('/p', CAST(s.page_id AS STRING)) END) AS url,
       concat(s.html, '<a class="x" href="../', s.doc_set, '/p', CAST(s.child AS STRING), '/">1</a>',
              '<a href="/', s.doc_set, '/p', CAST(s.child + 3 AS STRING), '">2</a>',
              '<a href="https://docs.example.com/', s.doc_set, '">home</a><a href="#top">top</a>',
              '<a href="/', s.doc_set, '/i.png">img</a><a href="/', s.doc_set, '-x/p1">other</a>') AS html
FROM (SELECT page_id, html, CASE page_id % 3 WHEN 0 THEN 'alpha' WHEN 1 THEN 'alpha-one' ELSE 'beta' END AS doc_set,
             page_id * 2 - page_id % 3 + 3 AS child
      FROM pages) s"""),
    # Markdown whose text is known by construction: titles, lists, references, escapes, code, tables, tags
    "v_marked": ([], """
SELECT doc_id, coalesce(source, 'none') AS source, CASE doc_id % 8
    WHEN 0 THEN concat('Title ', coalesce(source, 'none'), chr(10), '=====', chr(10), 'Some *soft* and **loud** text', chr(10), 'Sub', chr(10), '---', chr(10), 'End ', CAST(doc_id AS STRING), chr(10))
    WHEN 1 THEN concat('- one', chr(10), '  - two ', coalesce(source, 'none'), chr(10), '    goes on', chr(10), chr(10), '        code ', CAST(doc_id AS STRING), chr(10), '- three', chr(10), chr(10), '7) x', chr(10))
    WHEN 2 THEN concat('See [the ', coalesce(source, 'none'), '][1], [two] and [none].', chr(10), chr(10), '[1]: https://example.org/', CAST(doc_id AS STRING), ' "t"', chr(10), '[TWO]: <x y>', chr(10))
    WHEN 3 THEN concat(chr(92), '*not soft', chr(92), '* ', chr(92), '# ', coalesce(source, 'none'), ' snake_case_', CAST(doc_id AS STRING), ' and 2 * 3 * 4', chr(10))
    WHEN 4 THEN concat('Run `a *b* <i>` or ``x ` y`` ', coalesce(source, 'none'), chr(10), chr(10), '```sh', chr(10), 'rm ', CAST(doc_id AS STRING), chr(10), chr(10), '```', chr(10), 'Done.', chr(10))
    WHEN 5 THEN concat('| Name | Value |', chr(10), '|:-----|------:|', chr(10), '| ', coalesce(source, 'none'), ' | *', CAST(doc_id AS STRING), '* ', chr(92), '| more |', chr(10), chr(10), 'After', chr(10))
    WHEN 6 THEN concat('> Quote **', coalesce(source, 'none'), '**', chr(10), 'lazy &amp; <b class="x > y">bold</b><!-- *no* -->', chr(10), chr(10), '<div>', chr(10), '*', CAST(doc_id AS STRING), '*', chr(10), '</div>', chr(10))
    ELSE concat('![no](i.png)[a *', coalesce(source, 'none'), '*](/u_', CAST(doc_id AS STRING), '_ "t") <https://e.org/', CAST(doc_id AS STRING), '>', chr(10), '***', chr(10), '## Last ##', chr(10)) END AS content
FROM documents"""),
    # stored pages followed by markup that patterns misread
    "v_odd_page": ([], """
SELECT page_id, concat(html, CASE page_id % 9
    WHEN 0 THEN concat('<a title="a > b" href="/gt', CAST(page_id AS STRING), '">x</a><p title=''<a href="/no">''><a alt=''"'' href="/next">')
    WHEN 1 THEN concat('<a class=k href=/bare', CAST(page_id AS STRING), '>b</a><abbr href="/no">')
    WHEN 2 THEN concat('<!-- > <a href="/no"> -- > --><a href=''/shown', CAST(page_id AS STRING), '''><!-- <a href="/no">')
    WHEN 3 THEN concat('<script>if (a<b) w("<a href=''/no''></scripty>")</script ><a href="/after', CAST(page_id AS STRING), '"><style>a > b {}<a href="/no">')
    WHEN 4 THEN concat('<a href="/first', CAST(page_id AS STRING), '" href="/no"><a data-href="/no" =href="/no">')
    WHEN 5 THEN concat('<title><a href="/no"></title><textarea></p><a href=/no></textarea><A HREF = "/upper', CAST(page_id AS STRING), '">')
    WHEN 6 THEN '</a href="/no"></><?php <a href="/no"?><a href>'
    WHEN 7 THEN '<a title="x" href="/cut'
    ELSE concat('<a href="it''s"><a/href=/&amp;', CAST(page_id AS STRING), '>< a href="/no">') END) AS html
FROM pages"""),
    "v_base": ([], """
SELECT * FROM (VALUES ('Alpha', 'https://docs.example.com/alpha'), ('Alpha One', 'https://docs.example.com/alpha-one'),
                      ('Beta', 'https://docs.example.com/beta')) AS t(doc_set, base)"""),
    "v_place": ([], """
SELECT s_suppkey AS place_id, CAST(s_suppkey * 37 % 141 - 70 AS DOUBLE) + 0.25 AS lat,
       CAST(s_suppkey * 113 % 359 - 179 AS DOUBLE) + 0.75 AS lon, concat('N', CAST(s_nationkey AS STRING)) AS country
FROM supplier"""),
    "v_country": ([], """
SELECT concat('N', CAST(n_nationkey AS STRING)) AS code, n_name AS name FROM nation WHERE n_regionkey <> 4"""),
    # places of users whose documents were labelled are known already
    "v_geo_cache": (["v_survey"], """
SELECT DISTINCT CAST(round(v.lat * 100000) AS BIGINT) AS lat_key, CAST(round(v.lon * 100000) AS BIGINT) AS lon_key,
       concat('C', CAST(e.user_id % 10 AS STRING)) AS country
FROM v_survey v JOIN events e ON e.event_id = v.row_id JOIN labels l ON l.doc_id = e.user_id
WHERE v.lat IS NOT NULL"""),
    # every third page writes into one hot file
    "v_config_lines": ([], """
SELECT CASE WHEN page_id % 3 = 0 THEN 0 ELSE page_id END AS file_id, page_id * 12 + k.k AS line_no,
       CASE k.k WHEN 0 THEN '# rules return 302 /never;'
                WHEN 1 THEN concat('location = /old/', CAST(page_id AS STRING), ' {')
                WHEN 2 THEN concat('/skipped/', CAST(page_id AS STRING), ' /x/')
                WHEN 3 THEN concat('  return 301 "/new/', CAST(page_id AS STRING), '$is_args$args";')
                WHEN 4 THEN '}'
                WHEN 5 THEN concat('/a/', CAST(page_id % 50 AS STRING), ' /b/', CAST(page_id AS STRING))
                WHEN 6 THEN concat('location /one/', CAST(page_id AS STRING), ' { return 301 /line/; }')
                WHEN 7 THEN concat('Location /open/', CAST(page_id AS STRING), ' {')
                WHEN 8 THEN concat('LOCATION /inner/', CAST(page_id AS STRING), ' {')
                WHEN 9 THEN CASE WHEN page_id % 2 = 0 THEN 'return 302 https:/out.example.org//x;' ELSE '' END
                WHEN 10 THEN concat('/late/', CAST(page_id AS STRING), ' late/')
                ELSE concat('location /', CAST(page_id AS STRING), '$var {') END AS line
FROM (SELECT page_id, NUMBERS_0_11 AS k FROM pages) k"""),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. One that is a single small file, as test tables are, is dealt out to all cores."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.repartition(spark.sparkContext.defaultParallelism) if len(df.inputFiles()) == 1 else df


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived view over the tables of ``sf_dir``."""
    needs, sql = VIEWS[name]
    for t in TABLES:
        if re.search(rf"(?:FROM|JOIN) {t}\b", sql):
            table(spark, sf_dir, t).createOrReplaceTempView(t)
    for other in needs:
        view(spark, sf_dir, other).createOrReplaceTempView(other)
    return spark.sql(sql.replace(NUMBERS, "explode(sequence(0, 11))"))


def with_views(sql: str, *names: str) -> str:
    """A statement preceded by the views it uses, for DuckDB."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for other in VIEWS[name][0]:
            add(other)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    bodies = ",\n".join(f"{name} AS ({VIEWS[name][1]})" for name in ordered)
    separator = "" if sql.lstrip().startswith(",") else "\n"
    return f"WITH RECURSIVE {bodies}{separator}{sql}".replace(NUMBERS, "unnest(range(12))")
