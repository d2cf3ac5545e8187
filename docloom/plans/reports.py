"""Counts, audits and ordered picks over the tables: queries and their SQL, by name."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from docloom.functions import text as tx
from docloom.sources.readers import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        SQL[f.__name__] = sql
        return f

    return add


@query("select event_type as status, count(*) as n from events group by 1")
def count_by_status(spark, d):
    return table(spark, d, "events").groupBy(F.col("event_type").alias("status")).agg(F.count("*").alias("n"))


@query("""select d.lang, count(*) as n_docs, count(l.doc_id) as n_labelled, cast(count(*) filter (l.quality = 0) as bigint) as n_poor
from documents d left join (select doc_id, max(quality) as quality from labels group by 1) l using (doc_id) group by 1""")
def language_report(spark, d):
    one = table(spark, d, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.lit(1).alias("has"))
    return table(spark, d, "documents").select("doc_id", "lang").join(one, "doc_id", "left").groupBy("lang").agg(
        F.count("*").alias("n_docs"), F.count("has").alias("n_labelled"), F.count_if(F.col("quality") == 0).alias("n_poor"))


@query(r"""with t as (select page_id, trim(regexp_replace(coalesce(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), ''), '\s+', ' ', 'g')) as title from pages)
select page_id, title, (length(title) < 8 or length(title) > 180 or regexp_matches(title, '[#$%&*]{3}')) as needs_repair from t""")
def title_from_html(spark, d):
    title = tx.collapse_space(F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1))
    t = table(spark, d, "pages").select("page_id", title.alias("title"))
    return t.withColumn("needs_repair", (F.length("title") < 8) | (F.length("title") > 180) | F.col("title").rlike("[#$%&*]{3}"))


@query("""with c as (select o_custkey, o_orderkey, o_totalprice, case o_orderpriority when '1-URGENT' then 0 when '2-HIGH' then 1 else 2 end as p from orders),
r as (select *, cast(row_number() over (partition by o_custkey order by p, o_totalprice desc, o_orderkey) as int) as rank from c)
select o_custkey, o_orderkey, p as priority, rank from r where rank <= 8""")
def priority_topk(spark, d):
    p = F.when(F.col("o_orderpriority") == "1-URGENT", 0).when(F.col("o_orderpriority") == "2-HIGH", 1).otherwise(2)
    rank = F.row_number().over(Window.partitionBy("o_custkey").orderBy("priority", F.desc("o_totalprice"), "o_orderkey"))
    rows = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice", p.alias("priority"))
    return rows.withColumn("rank", rank).filter("rank <= 8").select("o_custkey", "o_orderkey", "priority", "rank")


@query("""with s as (select o_custkey, o_orderkey, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) as rank, count(*) over (partition by o_custkey) as n, o_totalprice from orders)
select o_custkey, round(sum(o_totalprice) filter (rank <= 4) + 0.3 * ln(1 + any_value(n)), 4) as score, any_value(n) as n_units from s group by 1""")
def group_score(spark, d):
    of = Window.partitionBy("o_custkey")
    rows = table(spark, d, "orders").select("o_custkey", "o_totalprice", F.row_number().over(of.orderBy(F.desc("o_totalprice"), "o_orderkey")).alias("rank"), F.count("*").over(of).alias("n"))
    return rows.groupBy("o_custkey").agg(F.round(F.sum(F.when(F.col("rank") <= 4, F.col("o_totalprice"))) + 0.3 * F.log(1 + F.first("n")), 4).alias("score"), F.first("n").alias("n_units"))


@query(r"""with t as (select doc_id, unnest(list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: regexp_full_match(x, '[a-z]{1,3}'))) as w from documents),
c as (select doc_id, w, count(*) as n from t group by all having count(*) >= 8)
select doc_id, cast(sum(n) as bigint) as repeated from c group by 1""")
def repeated_short_tokens(spark, d):
    w = F.explode(F.filter(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}\p{N}]+"), lambda x: x.rlike("^[a-z]{1,3}$")))
    return table(spark, d, "documents").select("doc_id", w.alias("w")).groupBy("doc_id", "w").agg(F.count("*").alias("n")).filter("n >= 8").groupBy("doc_id").agg(F.sum("n").alias("repeated"))


@query("select doc_id, length(text) as n from documents where text is not null order by length(text), doc_id limit 20")
def shortest_first(spark, d):
    return table(spark, d, "documents").filter("text is not null").select("doc_id", F.length("text").cast("long").alias("n")).orderBy("n", "doc_id").limit(20)


@query("""with m as (select conv_id, role, turn, row_number() over (partition by conv_id, role order by turn) as i from conversations) select conv_id, role, turn from m where i = 1""")
def first_per_parent(spark, d):
    i = F.row_number().over(Window.partitionBy("conv_id", "role").orderBy("turn"))
    return table(spark, d, "conversations").withColumn("i", i).filter("i = 1").select("conv_id", "role", "turn")


@query("""select conv_id, string_agg(coalesce(role, '') || ': ' || coalesce(text, ''), chr(10) order by turn, role, text) as body from conversations group by 1""")
def text_rebuild(spark, d):
    line = F.concat(F.coalesce("role", F.lit("")), F.lit(": "), F.coalesce("text", F.lit("")))
    each = F.sort_array(F.collect_list(F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), line.alias("line"))))
    return table(spark, d, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(each, lambda x: x["line"]), "\n").alias("body"))


@query("""select coalesce(a.doc_id, b.doc_id) as doc_id, a.doc_id is not null as in_documents, b.doc_id is not null as in_labels
from (select distinct doc_id from documents) a full outer join (select distinct doc_id from labels) b on a.doc_id = b.doc_id""")
def alignment(spark, d):
    a, b = (table(spark, d, t).select("doc_id").distinct().withColumn(f"in_{t}", F.lit(True)) for t in ("documents", "labels"))
    return a.join(b, "doc_id", "full").na.fill(False, ["in_documents", "in_labels"])
