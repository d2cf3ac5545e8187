"""References and captions of all `documents`, and ids looked up by the numbers in questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom.functions import rules
from docloom.operators import identifiers, locate, references, regions
from docloom.plans.claimed import patents
from docloom.plans.registry import Registry
from docloom.sources import store
from docloom.sources.readers import table

here = Registry()
query = here.query
PAGE_LINES = r"""l0 as (select doc_id, (n - 1) // 20 + 1 as page_no, n, line from (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as n from documents where text is not null)),
l1 as (select doc_id, page_no, line as raw, trim(regexp_replace(line, '\s+', ' ', 'g')) as line, n from (select doc_id, page_no, n, unnest(string_split_regex(line, '\r')) as line from l0)),
l as (select doc_id, page_no, raw, line, row_number() over (partition by doc_id, page_no order by n) as line_no from l1 where line <> ''),
named as (select doc_id, page_no, line_no, line, coalesce(nullif(regexp_extract(line, '(?i)图\s*(\d+)|FIG\.?\s*(\d+)|도\s*(\d+)', 1), ''), nullif(regexp_extract(line, '(?i)图\s*(\d+)|FIG\.?\s*(\d+)|도\s*(\d+)', 2), ''), nullif(regexp_extract(line, '(?i)图\s*(\d+)|FIG\.?\s*(\d+)|도\s*(\d+)', 3), '')) as figure_no from l where line_no <= 8),
drawn as (select doc_id, page_no, min_by(figure_no, line_no) as figure_no from named where figure_no is not null group by all)"""


@query(rf"""with {PAGE_LINES}, r as (select doc_id, page_no, unnest(regexp_extract_all(raw, '{rules.REFERENCE}')) as ref from l)
select doc_id, page_no::int as page_no, case when figure_no is null then 'description' else 'drawing' end as section, figure_no, ref, count(*) as n from r left join drawn using (doc_id, page_no) group by all""")
def page_references(spark, d):
    """How often each page has each reference, with its section; no claims are known here."""
    pages = locate.pages_of(table(spark, d, "documents"))
    found = references.references(pages, pages.select("doc_id", "page_no").filter("false"))
    return found.groupBy("doc_id", "page_no", "section", "figure_no", "ref").agg(F.count("*").alias("n"))


@query()
def patent_references(spark, d):
    """References of pages and of claims, of all documents and some patents, with the claims' own pages."""
    docs, (pages, countries) = table(spark, d, "documents"), patents(spark)
    every = locate.pages_of(docs).unionByName(pages)
    claims = store.written(regions.extracted(every, docs.select("doc_id", F.lit("US").alias("country")).unionByName(countries)), "patent-claims")
    inside = claims.select("doc_id", F.explode(F.sequence("page_start", F.greatest("page_end", "page_start"))).alias("page_no")).filter("page_no is not null")
    of_pages = references.references(every, inside).select("doc_id", F.lit(None).cast("string").alias("claim_no"), "page_no", "section", "ref").distinct()
    return of_pages.unionByName(references.of_claims(claims).select("doc_id", "claim_no", "page_no", F.lit("claim").alias("section"), "ref"))


IDS = "(case o_orderkey % 3 when 0 then 'us' when 1 then 'cn' else 'kr' end || lpad(((o_orderkey * 7919 + o_custkey) % 100000000)::varchar, 8, '0') || (o_orderkey % 7)::varchar || 'b2')"


@query(f"""with ids as (select distinct {IDS} as id from orders),
q as (select o_orderkey as query_id, case o_orderkey % 4 when 0 then 'US number ' when 1 then '한국 ' else 'No. ' end || substring({IDS}, 3, 8) || ' or 000' || substring({IDS}, 4, 7) as text from orders where o_orderkey % 50 = 0),
p as (select query_id, text, case when contains(lower(text), 'us') or contains(text, '미국') then 'us' when contains(lower(text), 'cn') or contains(text, '중국') then 'cn' when contains(lower(text), 'kr') or contains(text, '한국') then 'kr' else '' end as prefix, regexp_extract_all(text, '[0-9]{{7,}}') as f from q),
n as (select query_id, prefix, generate_subscripts(f, 1) as number, unnest(f) as fragment from p),
forms as (select query_id, prefix, number, 0 as form, fragment from n union all select query_id, prefix, number, 1, ltrim(fragment, '0') from n where ltrim(fragment, '0') not in ('', fragment)),
m as (select *, row_number() over (partition by query_id, number, form order by length(id), id) as k from forms join ids on contains(id, fragment) and starts_with(id, prefix)),
o as (select query_id, id, min((number, form, k)) as first from m where k <= 8 group by all)
select query_id, rank, id from (select query_id, id, cast(row_number() over (partition by query_id order by first) as int) as rank from o) where rank <= 8""")
def id_lookup(spark, d):
    """Ids made of all orders, looked up by the numbers in the questions of every fiftieth order."""
    key = F.expr("(o_orderkey * 7919 + o_custkey) % 100000000").cast("string")
    name = F.concat(F.when(F.col("o_orderkey") % 3 == 0, "us").when(F.col("o_orderkey") % 3 == 1, "cn").otherwise("kr"), F.lpad(key, 8, "0"), (F.col("o_orderkey") % 7).cast("string"), F.lit("b2"))
    orders = table(spark, d, "orders").select("o_orderkey", name.alias("id"))
    word = F.when(F.col("o_orderkey") % 4 == 0, "US number ").when(F.col("o_orderkey") % 4 == 1, "한국 ").otherwise("No. ")
    asked = orders.filter("o_orderkey % 50 = 0").select(F.col("o_orderkey").alias("query_id"), F.concat(word, F.substring("id", 3, 8), F.lit(" or 000"), F.substring("id", 4, 7)).alias("text"))
    return identifiers.lookup(asked, orders.select("id").distinct())
