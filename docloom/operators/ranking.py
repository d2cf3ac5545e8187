"""Two-level ranking: the parts of documents are scored for a question, and documents by the best of their parts.

A question's terms are the question itself and its words; the first SEARCHED of them find parts by BM25, POOL at most. A part's score adds
what of the terms it holds, its kind, its weight, its document's confidence, and takes off for flags. Of each document the best
parts are kept by a bounded aggregation, and count with the number of its parts in the pool. Documents that a
question names come first, and then are the only ones.

Ties: parts by id, documents by id. A question without parts has no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import rules
from docloom.functions import text as tx
from docloom.operators import postings
from docloom.operators.claims import once
from docloom.sources.store import written

SEARCHED, TERMS, POOL, PARTS, DOCS = 16, 40, 100, 4, 8
NAMED = 100.0
MOST = 20_000  # questions whose pools go to all tasks: POOL ids of each


def terms_of(question: Column) -> Column:
    """The question and its words in order, each once, without stop words and single characters."""
    whole, words = tx.collapse_space(question), F.regexp_extract_all(F.lower(question), F.lit(r"[A-Za-z0-9_가-힣一-鿿]+"), F.lit(0))
    some = F.array_distinct(F.concat(F.array(whole), words))
    return F.slice(F.filter(some, lambda x: ~F.lower(x).isin(*rules.STOP_TERMS) & (F.length(x) >= 2)), 1, TERMS)


def part_score(hits: Column) -> Column:
    """Of rows with kind, independent, leaning, flags (array), bm25, weight, confidence, qc_flags (array), title. hits: how many terms it has."""
    claim, flags, n = F.col("kind") == "claim", F.col("flags"), F.size("flags")
    score = F.least(F.lit(5.0), 0.7 * hits) + F.when(claim, 2.0).otherwise(0.0)
    score += F.when(F.col("independent") & ~F.col("leaning"), 1.4).when(claim & F.col("leaning"), -1.6).otherwise(0.0)
    score += F.when(F.col("kind") == "minimal_summary", 0.7).when(F.col("kind") == "figure", -0.5).otherwise(0.0)
    score += F.when(F.col("bm25").isNull(), 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(2.0), F.col("bm25") / 4))) + 0.4 * F.col("weight")
    score += F.least(F.lit(0.8), F.greatest(F.lit(0.0), F.col("confidence") - 0.5)) - 0.6 * n - 0.8 * F.size("qc_flags")
    score -= F.when(F.array_contains(flags, "publication_line_only"), 2.0).otherwise(0.0) + F.when(F.array_contains(flags, "short_claim_text"), 1.2).otherwise(0.0)
    return score - F.when(F.col("title").rlike(rules.NOISE), 1.0).otherwise(0.0) - F.when(F.col("title").rlike(rules.GENERIC), 0.4).otherwise(0.0)


def ranked(index: postings.Index, questions: DataFrame, parts: DataFrame, about: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """query_id, doc_id, rank, score, n_parts, parts (part, score) of the best documents.

    questions: query_id, text, named (array of doc_id: documents it names); parts: part (the id in the index), doc_id, text and the columns of part_score().
    about: adds those of them that parts lack to the parts of the pool. The pools of up to MOST questions go to all tasks, so that the
    parts are not shuffled.
    """
    few = F.broadcast if questions.limit(MOST + 1).count() <= MOST else lambda rows: rows
    asked = once(questions.select("query_id", "named", "text"), terms=terms_of(F.col("text"))).drop("text")
    phrases = asked.filter(F.size("named") == 0).select("query_id", F.explode(F.slice("terms", 1, SEARCHED)).alias("x")).select("query_id", tx.search_tokens(F.col("x")).alias("tokens"))
    pool = postings.search(index, phrases, POOL).select("query_id", F.col("doc_id").alias("part"), F.col("score").alias("bm25"))
    own = few(asked.select("query_id", F.explode("named").alias("doc_id"))).join(parts.select("doc_id", "part"), "doc_id")
    first = F.row_number().over(Window.partitionBy("query_id", "doc_id").orderBy("part"))
    own = own.withColumn("k", first).filter(F.col("k") <= 8).select("query_id", "part", F.lit(None).cast("double").alias("bm25"))
    met = written(few(pool.unionByName(own)).join(parts, "part"), "pool")
    met = (about(met) if about else met).join(asked.select("query_id", "terms", "named"), "query_id")
    low = F.lower(F.concat_ws(" ", "text", "title"))
    rows = once(met, low=low).withColumn("hits", F.size(F.filter("terms", lambda t: F.col("low").contains(F.lower(t)))))
    rows = once(rows.select("query_id", "doc_id", "part", "kind", "independent", "leaning", "flags", "bm25", "weight", "confidence", "qc_flags", "title", "hits", "named"), score=part_score(F.col("hits")))
    order = Window.partitionBy("query_id", "doc_id").orderBy(F.desc(F.round("score", 9)), "part")
    best = rows.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= PARTS)
    counts = rows.groupBy("query_id", "doc_id").agg(F.count("*").alias("n_parts"))
    docs = best.groupBy("query_id", "doc_id").agg(F.sum("score").alias("sum"), F.max(F.array_contains("named", F.col("doc_id"))).alias("is_named"), F.sort_array(F.collect_list(F.struct("k", "part", F.round("score", 3).alias("score")))).alias("p"))
    docs = docs.join(counts, ["query_id", "doc_id"])
    score = F.round(F.col("sum") + 0.3 * F.log1p("n_parts") + F.when(F.col("is_named"), NAMED).otherwise(0.0), 3)
    docs = docs.select("query_id", "doc_id", score.alias("score"), "n_parts", F.transform("p", lambda x: F.struct(x["part"].alias("part"), x["score"].alias("score"))).alias("parts"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id"))
    return docs.withColumn("rank", rank).filter(F.col("rank") <= DOCS)
