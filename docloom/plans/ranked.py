"""Documents ranked by their parts, for all benchmark items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.operators import evidence, postings, ranking
from docloom.plans.registry import Registry
from docloom.sources.readers import table

here = Registry()
query = here.query
LINES = 20  # bits of a part's id for its line


def parts_of(docs: DataFrame) -> DataFrame:
    """Titles and lines of all documents, made where a text is read."""
    title = F.col("line_no") == 0
    no = F.lit(False)
    rows = evidence.parts(docs).select("doc_id", "title", "text", F.when(title, "title").otherwise("line").alias("kind"), F.when(title, 1.2).otherwise(1.0).alias("weight"), (F.shiftleft("doc_id", LINES) + F.col("line_no")).alias("part"))
    return rows.select("*", no.alias("independent"), no.alias("leaning"), F.array().cast("array<string>").alias("flags"))


@query()
def evidence_ranking(spark, d):
    """The best documents and their best parts; every tenth item names the document of its own number."""
    parts = parts_of(table(spark, d, "documents"))
    index = postings.opened(spark, parts.select(F.col("part").alias("doc_id"), "text"), "parts")
    items = table(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    named = F.when(F.col("query_id") % 10 == 0, F.array("query_id")).otherwise(F.array().cast("array<bigint>"))
    found = ranking.ranked(index, items.withColumn("named", named), parts, lambda rows: evidence.judged(rows, table(spark, d, "labels")))
    shown = F.array_join(F.transform("parts", lambda x: F.concat_ws(":", x["part"].cast("string"), F.format_number(x["score"], 3))), ",")
    return found.select("query_id", "doc_id", "rank", "score", "n_parts", shown.alias("parts"))
