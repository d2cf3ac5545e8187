"""Documents to positioned lines, units and quality flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import text as tx
from docloom.operators.claims import once

PAGE = 40  # lines of a page


def spans(docs: DataFrame) -> DataFrame:
    """doc_id, page_no, line_no, text of every line with text."""
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("i", "raw"))
    return lines.select("doc_id", (F.floor(F.col("i") / PAGE) + 1).cast("int").alias("page_no"), (F.col("i") + 1).alias("line_no"), tx.collapse_space(F.col("raw")).alias("text")).filter("text <> ''")


def page_counts(docs: DataFrame) -> DataFrame:
    return spans(docs).groupBy("doc_id", "page_no").agg(F.count("*").alias("n_lines"), F.sum(F.length("text").cast("long")).alias("n_chars"))


def first_lines(text: Column, low: int = 40, high: int = 800, most: int = 10, prefix: int = 180) -> Column:
    """line_no, text of a text's first lines of a length between low and high; of lines with the same beginning the first."""
    lines = F.transform(F.split(text, "\n"), lambda x, i: F.struct((i + 1).alias("line_no"), tx.collapse_space(x).alias("text")))
    fit = F.filter(lines, lambda x: F.length(x["text"]).between(low, high))
    again = lambda kept, x: F.exists(kept, lambda y: F.substring(y["text"], 1, prefix) == F.substring(x["text"], 1, prefix))
    none = F.array().cast("array<struct<line_no: int, text: string>>")
    return F.aggregate(fit, none, lambda kept, x: F.when((F.size(kept) < most) & ~again(kept, x), F.array_append(kept, x)).otherwise(kept))


def snippets(docs: DataFrame, low: int = 40, high: int = 800, most: int = 10, prefix: int = 180) -> DataFrame:
    """first_lines() of each document; only these are shuffled, in case an id has several rows."""
    s = docs.select("doc_id", F.inline(first_lines(F.col("text"), low, high, most, prefix))).withColumn("head", F.substring("text", 1, prefix))
    s = s.withColumn("again", F.row_number().over(Window.partitionBy("doc_id", "head").orderBy("line_no"))).filter("again = 1")
    s = s.withColumn("n", F.row_number().over(Window.partitionBy("doc_id").orderBy("line_no"))).filter(F.col("n") <= most)
    return s.select("doc_id", "n", "line_no", "text")


def parts(docs: DataFrame) -> DataFrame:
    """doc_id, title, line_no (0: the title), text: as units(), of documents with one row each; nothing is shuffled."""
    title = tx.clip(F.element_at(F.split("text", "\n"), 1), 240)
    head = F.array(F.struct(F.lit(0).alias("line_no"), title.alias("text")))
    rows = once(docs.filter("doc_id is not null").select("doc_id", "text"), title=title, p=F.concat(head, F.coalesce(first_lines(F.col("text")), F.array().cast("array<struct<line_no: int, text: string>>"))))
    return rows.select("doc_id", "title", F.inline("p")).filter("text <> ''")


def audit(docs: DataFrame) -> DataFrame:
    """doc_id, severity (0 to 100; 100: empty) and bucket of a text's quality; each measure is taken once."""
    rows = once(docs.select("doc_id", "text"), n=F.length(tx.collapse_space(F.col("text"))), solid=F.length(F.regexp_replace(F.coalesce("text", F.lit("")), r"(?U)\s+", "")),
                letters=F.regexp_count("text", F.lit(r"\p{L}")), digits=F.regexp_count("text", F.lit("[0-9]")))
    share = lambda c: F.when(F.col("solid") > 0, F.round(F.col(c) / F.col("solid"), 3)).otherwise(0.0)
    flags = ((F.col("n") < 120, 20), (F.col("n") > 20_000, 15), (share("letters") < 0.75, 25), (share("digits") > 0.1, 20), (F.col("text").rlike("[#$%&*]{3}"), 30), (F.col("text").rlike(r"[|]"), 10))
    total = F.lit(0)
    for on, weight in flags:
        total = total + F.when(on, weight).otherwise(0)
    rows = once(rows, score=F.when(F.col("n") == 0, 100).otherwise(F.least(total, F.lit(100))).cast("int"))
    score = F.col("score")
    bucket = F.when(score >= 70, "severe").when(score >= 45, "high").when(score >= 25, "medium").when(score > 0, "low").otherwise("ok")
    return rows.select("doc_id", score.alias("severity"), bucket.alias("bucket"))


def turn_forest(turns: DataFrame) -> DataFrame:
    """Each turn with the turn that it answers, and whether it stands alone."""
    before = F.lag("turn").over(Window.partitionBy("conv_id").orderBy("turn"))
    return turns.select("conv_id", "turn", F.when(F.col("role") == "assistant", before).alias("parent_turn"), F.when(F.col("role") == "assistant", "dependent").otherwise("independent").alias("turn_type"))


def cards(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, title, confidence, qc_flags of every document."""
    title = tx.clip(F.element_at(F.split("text", "\n"), 1), 240)
    return judged(docs.select("doc_id", title.alias("title")), labels).select("doc_id", "title", "confidence", F.array_join("qc_flags", ",").alias("qc_flags"))


def judged(titled: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows with doc_id and title, with confidence and qc_flags (array)."""
    one = labels.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    flags = F.array_compact(F.array(F.when(F.length("title") > 180, "long_title"), F.when(F.length("title") < 8, "short_title"), F.when(F.col("title").rlike("[#$%&*]{3}"), "noisy_title"), F.when(F.col("quality").isNull(), "unlabelled")))
    confidence = F.when(F.col("quality") == 1, 0.9).when(F.col("quality") == 0, 0.6).otherwise(0.75)
    return titled.join(one, "doc_id", "left").withColumns({"confidence": confidence, "qc_flags": flags}).drop("quality")


def units(docs: DataFrame) -> DataFrame:
    """doc_id, unit_id, unit_type, source_weight, text: the title and the lines that can be cited."""
    title = docs.select("doc_id", F.concat(F.col("doc_id").cast("string"), F.lit(":title")).alias("unit_id"), F.lit("title").alias("unit_type"), F.lit(1.2).alias("source_weight"), tx.clip(F.element_at(F.split("text", "\n"), 1), 240).alias("text")).filter("text <> ''")
    lines = snippets(docs).select("doc_id", F.concat(F.col("doc_id").cast("string"), F.lit(":line_"), F.col("line_no").cast("string")), F.lit("line"), F.lit(1.0), "text")
    return title.union(lines)
