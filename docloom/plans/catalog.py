"""Registered queries and their SQL, by name."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom.functions import text as tx
from docloom.operators import evidence, jobs, labels, postings, search
from docloom.plans import changes, claimed, flowing, indexed, labelled, located, patents, placed, ranked, reports, streamed
from docloom.sources.readers import table

QUERIES: dict = reports.QUERIES | labelled.QUERIES | patents.QUERIES | indexed.here.queries | located.here.queries | claimed.here.queries | changes.here.queries | streamed.here.queries | placed.here.queries | ranked.here.queries | flowing.here.queries
SQL: dict[str, str] = reports.SQL | labelled.SQL | patents.SQL | indexed.here.sql | located.here.sql | claimed.here.sql | changes.here.sql | placed.here.sql | flowing.here.sql


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


WS = r"trim(regexp_replace(coalesce({}, ''), '\s+', ' ', 'g'))"
TOKENS = r"list_filter(string_split_regex(strip_accents(lower(coalesce(text, ''))), '[^\p{L}\p{N}]+'), lambda x: x <> '')"


@query(rf"select doc_id, {WS.format('text')} as norm_text from documents")
def ws_normalize(spark, d):
    return table(spark, d, "documents").select("doc_id", tx.collapse_space(F.col("text")).alias("norm_text"))


@query(rf"select doc_id, substring({WS.format('text')}, 1, 160) as clipped from documents")
def clip_text(spark, d):
    return table(spark, d, "documents").select("doc_id", tx.clip(F.col("text"), 160).alias("clipped"))


@query("select p_partkey, trim(regexp_replace(replace(lower(p_name), '&', 'and'), '[^a-z0-9]+', '_', 'g'), '_') as tag from part")
def tag_normalize(spark, d):
    return table(spark, d, "part").select("p_partkey", tx.tag(F.col("p_name")).alias("tag"))


@query(r"select c_custkey, coalesce(try_cast(regexp_extract(reverse(c_name), '^\s*([+-]?\d+)', 1) as bigint), 0) as n from customer")
def numeric_text_order(spark, d):
    return table(spark, d, "customer").select("c_custkey", tx.leading_number(F.reverse("c_name")).alias("n"))


@query(r"select doc_id, len(regexp_extract_all(text, '[0-9]{7,}'))::bigint as n_fragments, coalesce(regexp_extract(text, '[0-9]{7,}'), '') as first_fragment from documents")
def id_fragment_extract(spark, d):
    f = tx.id_fragments(F.col("text"))
    return table(spark, d, "documents").select("doc_id", F.size(f).cast("long").alias("n_fragments"), F.coalesce(F.try_element_at(f, F.lit(1)), F.lit("")).alias("first_fragment"))


@query(r"""select doc_id, regexp_replace(regexp_replace(text, '\bAKIA[0-9A-Z]{16}\b', '[redacted]', 'g'), 'token = "[0-9a-f]{16,}"', 'token = "[redacted]"', 'g') as safe_text from documents""")
def redact_secrets(spark, d):
    return table(spark, d, "documents").select("doc_id", tx.redacted(F.col("text")).alias("safe_text"))


SPANS = rf"""with l as (select doc_id, generate_subscripts(string_split(text, chr(10)), 1) as i, unnest(string_split(text, chr(10))) as raw from documents),
s as (select doc_id, cast(floor((i - 1) / 40) + 1 as int) as page_no, cast(i as int) as line_no, {WS.format('raw')} as text from l where {WS.format('raw')} <> '') """


@query(SPANS + "select * from s")
def spans_explode(spark, d):
    return evidence.spans(table(spark, d, "documents"))


@query(SPANS + "select doc_id, page_no, count(*) as n_lines, cast(sum(length(text)) as bigint) as n_chars from s group by all")
def page_text_counts(spark, d):
    return evidence.page_counts(table(spark, d, "documents"))


@query(SPANS + """, h as (select *, row_number() over (partition by doc_id, substring(text, 1, 180) order by line_no) as again from s where length(text) between 40 and 800),
n as (select doc_id, cast(row_number() over (partition by doc_id order by line_no) as int) as n, line_no, text from h where again = 1)
select * from n where n <= 10""")
def description_snippets(spark, d):
    return evidence.snippets(table(spark, d, "documents"))


CHARS = r"""with c as (select doc_id, text, length(trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g'))) as n, regexp_replace(coalesce(text, ''), '\s+', '', 'g') as solid from documents),
r as (select *, case when length(solid) > 0 then round(length(regexp_replace(solid, '[^\p{L}]', '', 'g')) / length(solid)::double, 3) else 0 end as letters,
  case when length(solid) > 0 then round(length(regexp_replace(solid, '[^0-9]', '', 'g')) / length(solid)::double, 3) else 0 end as digits from c) """


@query(CHARS + "select doc_id, letters, digits from r")
def char_stats(spark, d):
    return table(spark, d, "documents").select("doc_id", tx.letter_share(F.col("text")).alias("letters"), tx.digit_share(F.col("text")).alias("digits"))


@query(CHARS + r""", s as (select doc_id, case when n = 0 then 100 else least(100,
  case when n < 120 then 20 else 0 end + case when n > 20000 then 15 else 0 end + case when letters < 0.75 then 25 else 0 end + case when digits > 0.1 then 20 else 0 end
  + case when regexp_matches(text, '[#$%&*]{3}') then 30 else 0 end + case when regexp_matches(text, '[|]') then 10 else 0 end) end as v from r)
select doc_id, cast(v as int) as severity, case when v >= 70 then 'severe' when v >= 45 then 'high' when v >= 25 then 'medium' when v > 0 then 'low' else 'ok' end as bucket from s""")
def audit_severity(spark, d):
    return evidence.audit(table(spark, d, "documents"))


@query("""select conv_id, turn, case when role = 'assistant' then lag(turn) over (partition by conv_id order by turn) end as parent_turn,
case when role = 'assistant' then 'dependent' else 'independent' end as turn_type from conversations""")
def claim_parent_type(spark, d):
    return evidence.turn_forest(table(spark, d, "conversations"))


@query(rf"""with q as (select doc_id, max(quality) as quality from labels group by 1),
t as (select d.doc_id, q.quality, substring({WS.format("string_split(text, chr(10))[1]")}, 1, 240) as title from documents d left join q using (doc_id))
select doc_id, title, case quality when 1 then 0.9::double when 0 then 0.6::double else 0.75::double end as confidence,
concat_ws(',', case when length(title) > 180 then 'long_title' end, case when length(title) < 8 then 'short_title' end, case when regexp_matches(title, '[#$%&*]{{3}}') then 'noisy_title' end, case when quality is null then 'unlabelled' end) as qc_flags from t""")
def card_qc_flags(spark, d):
    return evidence.cards(table(spark, d, "documents"), table(spark, d, "labels"))


@query("""select user_id, arg_max(event_type, (ts, event_id)) as status, max(ts) as updated_at, cast(count(*) filter (event_type = 'error') as bigint) as retry_count from events group by 1""")
def job_latest_state(spark, d):
    return jobs.latest_state(table(spark, d, "events"))


@query("""select user_id, count(*) as n_errors, max(ts) as last_error from events where event_type = 'error' and ts >= (select max(ts) from events) - interval 6 hours group by 1""")
def job_recent_failures(spark, d):
    return jobs.recent_failures(table(spark, d, "events"))


@query("select distinct user_id from events where user_id not in (select user_id from events where event_type in ('purchase', 'error'))")
def job_pending(spark, d):
    return jobs.pending(table(spark, d, "events"))


BM25 = rf"""with p as (select item_id as query_id, array_to_string(({TOKENS})[1:2], ' ') as phrase from benchmark),
t as materialized (select doc_id, {TOKENS} as t from documents),
g as (select doc_id, unnest(list_transform(range(1, len(t)), lambda i: array_to_string(t[i:i + 1], ' '))) as phrase from t where len(t) >= 2),
h as (select query_id, doc_id, count(*) as f from g join p using (phrase) group by all),
n as (select query_id, count(*) as n from h group by 1),
c as (select count(*) as n_docs, avg(len(t)) as mean from t),
s as (select query_id, doc_id, (case when ln((n_docs - n + 0.5) / (n + 0.5)) <= 0 then 1e-6 else ln((n_docs - n + 0.5) / (n + 0.5)) end) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * len(t) / mean)) as score
  from h join n using (query_id) join t using (doc_id), c),
r as (select *, cast(row_number() over (partition by query_id order by round(score, 9) desc, doc_id) as int) as rank from s) """


def _phrases(spark, d):
    t = tx.search_tokens(F.col("text"))
    return table(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), F.array_join(F.slice(t, 1, 2), " ").alias("phrase"))


def _ranked(spark, d):
    return postings.search(indexed.index_of(spark, d), _phrases(spark, d).select("query_id", F.split("phrase", " ").alias("tokens")))


@query(BM25 + "select query_id, doc_id, round(score, 6) as score, rank from r where rank <= 10")
def search_bm25_batch(spark, d):
    return indexed.shown(_ranked(spark, d))


@query(BM25 + """, e as (select *, row_number() over (partition by doc_id order by query_id) as i from r where rank <= 10),
f as (select doc_id, sum(case when i = 1 then score + greatest(0, 2 - 0.15 * rank) else 0.35 * score end) + 0.8 * count(*) as v, count(*) as n_hits from e group by 1)
select doc_id, round(v, 6) as fused_score, n_hits from f order by round(v, 9) desc, doc_id limit 20""")
def search_fusion(spark, d):
    return search.fused(_ranked(spark, d)).withColumn("fused_score", F.round("fused_score", 6))


@query("""with e as (select q.vec_id as query_id, v.vec_id, list_sum(list_transform(list_zip(v.embedding, q.embedding), lambda x: (x[1]::double - x[2]::double) * (x[1]::double - x[2]::double))) as distance
  from embeddings v, embeddings q where q.vec_id % 50 = 0),
r as (select *, cast(row_number() over (partition by query_id order by round(distance, 9), vec_id) as int) as rank from e)
select query_id, vec_id, round(distance, 6) as distance, rank from r where rank <= 10""")
def dense_topk(spark, d):
    v = table(spark, d, "embeddings")
    return search.nearest(v, v.filter("vec_id % 50 = 0")).withColumn("distance", F.round("distance", 6))


@query("""select o_orderkey, o_custkey from orders where o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING') and not exists (select 1 from lineitem where l_orderkey = o_orderkey and l_returnflag = 'R')""")
def semi_anti_filter(spark, d):
    building = table(spark, d, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    returned = table(spark, d, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, d, "orders").select("o_orderkey", "o_custkey").join(building, "o_custkey", "left_semi").join(returned, "o_orderkey", "left_anti").select("o_orderkey", "o_custkey")


@query(f"""with c as ({SQL["card_qc_flags"]}), f as (select doc_id, unnest(list_filter(string_split(qc_flags, ','), lambda x: x <> '')) as flag from c),
r as (select *, row_number() over (partition by flag order by doc_id) as i from f)
select flag, count(*) as n, string_agg(doc_id::varchar, ',' order by doc_id) filter (i <= 12) as examples from r group by 1""")
def qc_report(spark, d):
    return labels.flag_report(card_qc_flags(spark, d))


@query(f"""with a as ({SQL["audit_severity"]}) select bucket, count(*) as n, min(severity) as low, max(severity) as high from a group by 1""")
def audit_buckets(spark, d):
    return audit_severity(spark, d).groupBy("bucket").agg(F.count("*").alias("n"), F.min("severity").alias("low"), F.max("severity").alias("high"))


@query(f"""with c as ({SQL["card_qc_flags"]}), s as ({SQL["description_snippets"]})
select doc_id, doc_id || ':title' as unit_id, 'title' as unit_type, 1.2::double as source_weight, title as text from c where title <> ''
union all select doc_id, doc_id || ':line_' || line_no, 'line', 1.0::double, text from s""")
def evidence_units(spark, d):
    return evidence.units(table(spark, d, "documents"))


@query(BM25 + f""", t2 as (select doc_id, {TOKENS.replace("text", "substring(string_split(text, chr(10))[1], 1, 240)")} as title from documents),
w as (select r.query_id, r.doc_id, r.score, len(list_intersect(string_split(p.phrase, ' '), title)) as hits from r join p using (query_id) join t2 using (doc_id) where rank <= 10)
select query_id, doc_id, hits::bigint as title_hits, round(greatest(0, least(20, score)) + least(12, 1.6 * hits), 6) as fit from w""")
def search_rerank(spark, d):
    return search.refitted(_ranked(spark, d), table(spark, d, "documents"), _phrases(spark, d))
