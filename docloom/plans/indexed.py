"""Ranked search over the index of `documents`: phrases of any length, OR-joined, with filters, and single words."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions import text as tx
from docloom.operators import postings
from docloom.plans.registry import Registry
from docloom.sources.readers import table

here = Registry()
query = here.query
TOKENS = r"list_filter(string_split_regex(strip_accents(lower(coalesce(text, ''))), '[^\p{L}\p{N}]+'), lambda x: x <> '')"
BASE = rf"""t as materialized (select doc_id, {TOKENS} as t from documents),
p as materialized (select distinct query_id, tokens from asked where len(tokens) > 0), """
LONG = """h as (select p.query_id, p.tokens, t.doc_id, len(t.t) as size, len(list_filter(range(1, len(t.t) - len(p.tokens) + 2), lambda i: t.t[i:i + len(p.tokens) - 1] = p.tokens)) as f
  from p join t on contains(' ' || array_to_string(t.t, ' ') || ' ', ' ' || array_to_string(p.tokens, ' ') || ' ')),"""
SHORT = """g as (select doc_id, len(t) as size, unnest(list_transform(range(1, len(t) - {0} + 2), lambda i: t[i:i + {0} - 1])) as tokens from t where len(t) >= {0})"""
SUMS = """n as (select query_id, tokens, count(*) as n from h group by all),
c as (select count(*) as n_docs, avg(len(t)) as mean from t),
s as (select query_id, doc_id, sum((case when ln((n_docs - n + 0.5) / (n + 0.5)) <= 0 then 1e-6 else ln((n_docs - n + 0.5) / (n + 0.5)) end) * f * 2.2 / (f + 1.2 * (0.25 + 0.75 * size / mean))) as score
  from h join n using (query_id, tokens), c group by all)"""


def score_sql(*lengths: int) -> str:
    """Scores of all documents that have a phrase of `asked`; lengths: those of all phrases, if they are few."""
    if not lengths:
        return BASE + LONG + SUMS
    grams = " union all ".join(f"select query_id, tokens, doc_id, size, count(*) as f from ({SHORT.format(k)[6:-1]}) join p using (tokens) group by all" for k in lengths)
    return BASE + f"h as ({grams}), " + SUMS


RANKS = "select query_id, doc_id, round(score, 6) as score, rank from (select *, cast(row_number() over (partition by query_id order by round(score, 9) desc, doc_id) as int) as rank from s) where rank <= 10"


def index_of(spark, d) -> postings.Index:
    return postings.opened(spark, table(spark, d, "documents"))


def items(spark, d) -> DataFrame:
    return table(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), tx.search_tokens(F.col("text")).alias("t"))


def shown(ranked: DataFrame) -> DataFrame:
    return ranked.select("query_id", "doc_id", F.round("score", 6).alias("score"), "rank")


@query(f"with asked as (select item_id as query_id, {TOKENS} as tokens from benchmark), {score_sql()} {RANKS}")
def search_passages(spark, d):
    """Each whole benchmark item as one phrase."""
    return shown(postings.search(index_of(spark, d), items(spark, d).select("query_id", F.col("t").alias("tokens"))))


PARTS = ((1, 2), (3, 4), (7, 1))  # from which token of an item, how many


@query(f"with i as (select item_id as query_id, {TOKENS} as t from benchmark), asked as (" + " union all ".join(f"select query_id, t[{a}:{a + n - 1}] as tokens from i" for a, n in PARTS) + f"), {score_sql(1, 2, 4)} {RANKS}")
def search_any_phrase(spark, d):
    """Three phrases of each item, joined by OR."""
    phrases = F.explode(F.array(*[F.slice("t", a, n) for a, n in PARTS]))
    return shown(postings.search(index_of(spark, d), items(spark, d).select("query_id", phrases.alias("tokens"))))


@query(f"with i as (select item_id as query_id, {TOKENS} as t from benchmark), asked as (select query_id, [unnest(t)] as tokens from i), {score_sql(1)} {RANKS}")
def search_all_words(spark, d):
    """All words of each item, joined by OR; blocks are left out by their bounds."""
    return shown(postings.search_words(index_of(spark, d), items(spark, d).select("query_id", F.col("t").alias("tokens"))))


@query(f"""with i as (select item_id as query_id, {TOKENS} as t from benchmark), asked as (select query_id, case when query_id % 10 = 3 then [] else t[1:2] end as tokens from i), {score_sql(2)},
cards as (select doc_id, coalesce(quality, 0) / 2 as confidence from documents left join labels using (doc_id) where lang = 'en' and source is not null and doc_id in (select doc_id from labels where toxic = 0)),
e as (select query_id, doc_id, score, confidence from s join cards using (doc_id) union all select a.query_id, doc_id, 0.0, confidence from asked a, cards where len(a.tokens) = 0)
select query_id, doc_id, round(score, 6) as score, rank from (select *, cast(row_number() over (partition by query_id order by round(score, 9) desc, confidence desc, doc_id) as int) as rank from e) where rank <= 8""")
def search_cards(spark, d):
    """Cards of a language that have a label, by score, confidence and id; some queries are empty."""
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    has = labels.filter("toxic = 0").select("doc_id")
    cards = docs.filter("lang = 'en' and source is not null").select("doc_id").join(has, "doc_id", "left_semi").join(labels, "doc_id", "left")
    cards = cards.select("doc_id", (F.coalesce("quality", F.lit(0)) / 2).alias("confidence"))
    phrases = items(spark, d).select("query_id", F.when(F.col("query_id") % 10 == 3, F.array().cast("array<string>")).otherwise(F.slice("t", 1, 2)).alias("tokens"))
    return shown(postings.search_cards(index_of(spark, d), phrases, cards))
