"""Queries of this subpackage: one per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.skew import lookup_join
from ..session import materialize, scratch_path
from . import language_id, quality, toxicity
from .decontamination import with_hits
from .jaccard_join import similar_documents
from .mixing import mix_sources, words_taken
from .periodic import run_digests
from .prefix_trie import borrowed_heads, conversation_arrays, distinct_sequences, encoded_turns, prefix_nodes
from .secret_scan import BASE_RULES, MORE_RULES, scan_secrets, spelled
from .sharding import shard_rows
from .suffix_dedup import digest, with_spans
from .tables import id_crc, n_words, table
from .token_counts import apply_all, change_rows, create_store, n_pieces, totals
from .topk import top_k

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_shards(spark, sf_dir):
    text = F.col("text").cast("binary")
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    placed = shard_rows(docs, 24)
    return placed.withColumn("law", F.lit("rows")).withColumn("grown_shard", F.lit(None).cast("int"))


@query
def op4_mix(spark, sf_dir):
    thin = table(spark, sf_dir, "documents").select("doc_id", "source", n_words(F.col("text")).alias("size"))
    mixed, sources = mix_sources(thin, F.col("size"), F.col("source"))
    taken = words_taken(mixed, sources)
    return taken.select("doc.doc_id", "size", "source", "source_size", "target", "taken", "in_shards")


@query
def op5_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(id_crc() % 3 == 1, F.lit(False))
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").filter(~held_out).select("doc_id", "toxic"))
    scored = toxicity.score(docs.withColumn("held_out", held_out), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op9_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(id_crc() % 4 == 2, F.lit(False))
    model = language_id.fit(docs.filter(~held_out).select("text", "lang"))
    found = language_id.predict(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")


@query
def op7_top_k(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    found = top_k(rows, rows.filter(F.col("vec_id") % 100 == 0), 10)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


ORACLES["op7_top_k"] = """
with e as (
    select vec_id, list_transform(embedding, lambda x: floor(1024 * cast(x as double))::bigint) as v
    from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
    select q.vec_id as query_id, c.vec_id as vec_id,
           list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint as score
    from e q join e c on q.vec_id <> c.vec_id and q.vec_id % 100 = 0
)
select query_id, rank::int as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
where rank <= 10
"""


@query
def op8_secrets(spark, sf_dir):
    found = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = [F.size(F.filter(F.col("found.kind"), F.lit(r.kind).__eq__)).cast("long").alias(f"n_{r.kind}") for r in BASE_RULES]
    base = spelled(F.filter("found", lambda s: s["kind_no"] < len(BASE_RULES)))
    return found.select("doc_id", *count, F.sha2(base, 256).alias("base_sha256"), spelled(F.col("found")).alias("spans"))


def _secret_oracle() -> str:
    """One list of (start, rule, end) per rule, from the split pieces and the matches between them."""
    parts = []
    for no, rule in enumerate([*BASE_RULES, *MORE_RULES]):
        p = rule.pattern.replace("'", "''")
        parts.append(f"""
select doc_id, text, {no} as kind_no, '{rule.kind}' as kind, i,
       list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i-1], lambda x: length(x))), 0) as start,
       length(hits[i]) as n, length(checks[i]) as checked, {rule.least} as least
from (
    select doc_id, text, gaps, hits, checks, unnest(range(1, len(hits) + 1)) as i
    from (
        select doc_id, text, string_split_regex(text, '{p}') as gaps, regexp_extract_all(text, '{p}', 0) as hits,
               regexp_extract_all(text, '{p}', {rule.group}) as checks
        from documents
    )
)""")
    return f"""
with hits as (
{" union all ".join(parts)}
), kept as (
    select doc_id, kind_no, kind, start, kind || ':' || start::bigint || ':' || (start + n)::bigint as span from hits where checked >= least
), told as (
    select doc_id,
           count(*) filter (where kind = 'assign') as n_assign,
           count(*) filter (where kind = 'access') as n_access,
           count(*) filter (where kind = 'hex') as n_hex,
           string_agg(span, ',' order by start, kind_no) filter (where kind_no < {len(BASE_RULES)}) as base,
           string_agg(span, ',' order by start, kind_no) as spans
    from kept group by doc_id
)
select d.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
       sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from documents d left join told t on t.doc_id = d.doc_id
"""


ORACLES["op8_secrets"] = _secret_oracle()


@query
def op3_jaccard(spark, sf_dir):
    found = similar_documents(table(spark, sf_dir, "documents"))
    return found.select(F.col("key").alias("doc_id"), "n_shingles", "component_id", "n_links")


ORACLES["op3_jaccard"] = """
with recursive worded as (
    select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w
    from documents
), sets as (
    select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
                                      else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s
    from worded
), tokens as (
    select doc_id, len(s) as n, unnest(s) as token from sets
), pairs as (
    select a.doc_id as x, b.doc_id as y, a.n as nx, b.n as ny, count(*) as common
    from tokens a join tokens b on a.token = b.token and a.doc_id <> b.doc_id
    group by all
), links as (
    select x, y from pairs where 100 * common >= 80 * (nx + ny - common)
), reached as (
    select x, y from links
    union
    select r.x, l.y from reached r join links l on r.y = l.x
)
select s.doc_id, len(s.s)::bigint as n_shingles,
       least(s.doc_id, coalesce((select min(y) from reached r where r.x = s.doc_id), s.doc_id)) as component_id,
       (select count(*) from links l where l.x = s.doc_id) as n_links
from sets s
"""


@query
def op10_leaks(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_hits(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    hit = found.select("doc_id", F.explode("hits").alias("hit"))
    return hit.select("doc_id", "hit.item_id", "hit.start_word", "hit.n_words", F.round("hit.similarity", 6).alias("similarity"))


@query
def op6_repeats(spark, sf_dir):
    found = with_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", digest(F.col("text"), F.col("spans")).alias("told")).select("doc_id", "told.*")


# texts as hexadecimal digits, two per byte; every window of 200 bytes, then islands of repeated ones
ORACLES["op6_repeats"] = """
with raw as (
    select doc_id, hex(encode(coalesce(text, ''))) as h from documents
), windows as (
    select doc_id, i, md5(substr(h, 2 * i + 1, 400)) as w
    from (select doc_id, h, unnest(range(0, len(h) // 2 - 199)) as i from raw where len(h) >= 400)
), twice as (
    select w from windows group by w having count(*) > 1
), marked as (
    select doc_id, i, coalesce(i - lag(i) over (partition by doc_id order by i) > 200, true) as new
    from windows where w in (select w from twice)
), runs as (
    select doc_id, min(i) as a, max(i) + 200 as b
    from (select doc_id, i, sum(new::int) over (partition by doc_id order by i) as run from marked)
    group by doc_id, run
), pieces as (
    select r.doc_id, r.a, r.b, substr(h, 2 * coalesce(lag(r.b) over o, 0) + 1, 2 * (r.a - coalesce(lag(r.b) over o, 0))) as before
    from runs r join raw using (doc_id)
    window o as (partition by r.doc_id order by r.a)
), kept as (
    select doc_id, sum(b - a)::bigint as n_removed, count(*) as n_spans, string_agg(before, '' order by a) as head, max(b) as last
    from pieces group by doc_id
)
select raw.doc_id, (len(h) // 2)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) as kept_sha256
from raw left join kept using (doc_id)
"""


@query
def op2_token_totals(spark, sf_dir):
    """All documents by words, then all revised to another tokenizer, then later copies of a text deleted; the
    revision is sent twice."""
    docs = table(spark, sf_dir, "documents")
    text = F.col("text")
    marked = docs.withColumn("mark", F.sha2(text, 256))
    # only texts that occur twice; a text that very many documents share is sliced by the join
    first = marked.groupBy("mark").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("rows")).filter("rows > 1").drop("rows")
    copies = lookup_join(marked.drop("text"), first, "mark", "inner").filter("doc_id > first")
    revise = change_rows(docs, "doc_id", "revise", "pieces-2", n_pieces(text))
    store = create_store(spark, scratch_path(spark, "token-totals"))
    apply_all(spark, store, [
        ("load", change_rows(docs, "doc_id", "insert", "words-1", n_words(text))),
        ("retokenize", revise),
        ("retract", change_rows(copies, "doc_id", "delete", "pieces-2", F.lit(0))),
        ("retokenize", revise),
    ])
    return totals(spark, store)


ORACLES["op2_token_totals"] = """
select source, lang, 'pieces-2' as tokenizer, count(*) as n_docs,
       sum(len(regexp_extract_all(text, '[\\p{L}\\p{N}]+|[^\\p{L}\\p{N}\\x20\\x09-\\x0D]')))::bigint as n_tokens
from documents d
where text is null or doc_id = (select min(doc_id) from documents e where e.text = d.text)
group by source, lang
"""


@query
def op12_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(id_crc() % 3 == 1, F.lit(False))
    model = quality.fit(docs, table(spark, sf_dir, "labels").filter(~held_out).select("doc_id", "quality"))
    scored = quality.score(docs.withColumn("held_out", held_out), model)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _crc_sql(column: str) -> str:
    """Unsigned CRC-32 of an integer's decimal digits, bit by bit."""
    text = f"cast({column} as varchar)"
    return f"""xor(4294967295, list_reduce(
        list_transform(range(0, 8 * length({text})), lambda k: ((ascii(substr({text}, (k // 8 + 1)::int, 1)) >> (k % 8)) & 1)::bigint),
        lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1)), 4294967295::bigint))"""


@query
def op11_runs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    told = run_digests(docs, F.col("text"), id_crc())
    return told.select("doc_id", "told.*")


# stretches that repeat q words later: islands of equal word triples at one distance; the smallest q of equal stretches
ORACLES["op11_runs"] = f"""
with given as (
    select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w, {_crc_sql("doc_id")} as h
    from documents
), sized as (
    select doc_id, w, len(w) as n, h % 10 = 0 and len(w) > 0 as again, h // 10 as g from given
), placed as (
    select *, case when again then g % n else n end as a from sized
), pieces as (
    select *, case when again then 1 + (n - a) // (3 + g % 8) else 1 end as p from placed
), made as (
    select doc_id, n, case when again then list_transform(range(0, n), lambda i: case when i < a then w[i + 1] else w[a + (i - a) % p + 1] end) else w end as w
    from pieces
), triples as (
    select doc_id, n, i, w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] as t
    from (select doc_id, n, w, unnest(range(0, n - 2)) as i from made where n >= 6)
), meets as (
    select x.doc_id, y.i - x.i as q, x.i
    from triples x join triples y on x.doc_id = y.doc_id and x.t = y.t and x.i < y.i and 4 * (y.i - x.i) <= x.n
), islands as (
    select doc_id, q, min(i) as start, count(*) + q + 2 as length
    from (select *, i - row_number() over (partition by doc_id, q order by i) as island from meets)
    group by doc_id, q, island
), runs as (
    select doc_id, start, length, min(q) as period from islands group by doc_id, start, length
    having length >= 6 and length >= 4 * min(q)
), dropped as (
    select distinct doc_id, unnest(range(start + period, start + length)) as i from runs
), kept as (
    select m.doc_id, string_agg(m.word, ' ' order by m.i) as collapsed
    from (select doc_id, unnest(w) as word, unnest(range(0, n)) as i from made) m anti join dropped d on m.doc_id = d.doc_id and m.i = d.i
    group by m.doc_id
), told as (
    select doc_id, count(*) as n_runs, arg_min({{'start': start, 'length': length, 'period': period}}, (-length, start, period)) as best,
           string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as lines
    from runs group by doc_id
)
select m.doc_id, coalesce(n_runs, 0) as n_runs, best.start as start, best.length as length, best.period as period, 1000 * best.length // best.period as exponent_milli,
       sha256(coalesce(lines, '')) as runs_sha256, sha256(coalesce(collapsed, '')) as collapsed_sha256
from made m left join told t on t.doc_id = m.doc_id left join kept k on k.doc_id = m.doc_id
"""


@query
def op13_trie(spark, sf_dir):
    conversations = materialize(conversation_arrays(encoded_turns(table(spark, sf_dir, "conversations"))), "trie-paths")
    c = F.col("conv_id")
    rebuilt = borrowed_heads(conversations, id_crc("conv_id") % 4, c - c % 20, 3)
    return prefix_nodes(distinct_sequences(rebuilt))


ORACLES["op13_trie"] = f"""
with turns as (
    select conv_id, turn, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as mark,
           len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as words
    from conversations where conv_id is not null
), own as (
    select conv_id, list(mark order by turn nulls first, mark) as marks, list(words order by turn nulls first, mark) as words
    from turns group by conv_id
), headed as (
    select c.conv_id, c.marks, c.words, b.marks as b_marks, b.words as b_words, {_crc_sql("c.conv_id")} % 4 as h
    from own c left join own b on b.conv_id = c.conv_id - c.conv_id % 20
), paths as (
    select conv_id, list_concat(coalesce(b_marks, [])[1:h], marks[h + 1:]) as marks, list_concat(coalesce(b_words, [])[1:h], words[h + 1:]) as words
    from headed
), steps as (
    select conv_id, d, md5(array_to_string(marks[1:d], ',')) as node, case when d > 0 then md5(array_to_string(marks[1:d - 1], ',')) end as parent,
           case when d > 0 then words[d] else 0 end as n_words, d = len(marks) as ends
    from (select *, unnest(range(0, len(marks) + 1)) as d from paths)
), nodes as (
    select node, d, any_value(parent) as parent, min(conv_id) as conv_id, count(*) as n_convs, any_value(n_words) as n_words,
           sha256(coalesce(string_agg(conv_id, ',' order by conv_id) filter (where ends), '')) as ends_sha256
    from steps group by node, d
), counted as (
    select n.*, (select count(*) from nodes c where c.parent = n.node and c.d = n.d + 1) as n_children from nodes n
), lines as (
    select distinct below.node as below, below.d as below_d, above.node as above, above.d as above_d
    from steps below join steps above on above.conv_id = below.conv_id and above.d <= below.d
), subtrees as (
    select above, above_d, sum((c.n_children = 0)::int)::bigint as n_leaves, sum((c.n_convs - 1) * c.n_words)::bigint as saved_tokens
    from lines l join counted c on c.node = l.below and c.d = l.below_d
    group by above, above_d
)
select c.conv_id, c.d as depth, u.conv_id as parent_conv_id, c.n_convs, c.n_children, s.n_leaves, s.saved_tokens, c.ends_sha256
from counted c join subtrees s on s.above = c.node and s.above_d = c.d left join nodes u on u.node = c.parent and u.d = c.d - 1
"""
