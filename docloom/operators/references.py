"""References to parts of drawings and captions of figures, each with its place.

A page whose first eight lines hold the name of a figure is a drawing; the first such line is its caption. Other pages
have captions where a line describes a figure. References are found line by line with where they start, and get the section of
their page (claim, drawing or description) and, in drawings, the figure. Bare numbers are no references.

Null texts have no lines; blank lines do not count; equal references at different places are rows of their own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import rules
from docloom.functions import text as tx

HEAD_LINES = 8
MAY_REFER = r"[0-9][A-Za-z]|[A-Za-z][0-9]|CS|DR|CR|FG|CG|SG|EG"  # every reference meets it
MAY_NAME = r"(?:图|도|[fF][iIıİ][gG]\.?)[\t-\r \x85\p{Z}]*\p{N}"  # every name of a figure meets it
PLACES = "array<struct<ref: string, start: int>>"


def meeting_all(pages: DataFrame, *patterns: str) -> DataFrame:
    """The pages whose text meets each pattern, by RE2; what follows is not done to the others (Spark would move it before a filter)."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for p in patterns:
                b = b.filter(pc.match_substring_regex(b.column("text"), p))
            yield b

    return pages.mapInArrow(run, pages.schema)


def lines_of(pages: DataFrame, most: int | None = None) -> DataFrame:
    """doc_id, page_no, line_no (from 1, of the lines that are not blank), raw, line (white space collapsed); the first `most` of each page, or all."""
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), r"\r\n|[\n\r]"), lambda x: x.rlike(r"(?U)\S"))
    lines = lines if most is None else F.slice(lines, 1, most)
    each = pages.select("doc_id", "page_no", F.posexplode(lines).alias("line_no", "raw"))
    return each.select("doc_id", "page_no", (F.col("line_no") + 1).alias("line_no"), "raw", tx.collapse_space(F.col("raw")).alias("line"))


def _figure(line: Column) -> Column:
    """Number of the figure that a line names first; null for none."""
    return F.coalesce(*[F.nullif(F.regexp_extract(line, f"(?U){rules.CAPTION}", k), F.lit("")) for k in (1, 2, 3)])


def captions(lines: DataFrame) -> DataFrame:
    """doc_id, page_no, line_no, figure_no, caption, drawing: of drawings the first, of other pages each description."""
    named = lines.filter(F.col("line_no") <= HEAD_LINES).withColumn("figure_no", _figure(F.col("line"))).filter("figure_no is not null")
    first = named.groupBy("doc_id", "page_no").agg(F.min(F.struct("line_no", "figure_no", F.col("line").alias("caption"))).alias("c")).select("doc_id", "page_no", "c.*", F.lit(True).alias("drawing"))
    others = lines.join(first.select("doc_id", "page_no"), ["doc_id", "page_no"], "left_anti").withColumn("caption", F.regexp_extract("line", f"(?U){rules.DESCRIBED}", 1)).filter("caption <> ''")
    others = others.select("doc_id", "page_no", "line_no", F.regexp_extract("caption", r"(?U)图\s*(\d+)", 1).alias("figure_no"), "caption", F.lit(False).alias("drawing"))
    return first.unionByName(others)


def places(text: Column) -> Column:
    """Each reference of a text with where it starts."""
    @F.pandas_udf(PLACES)
    def found(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pattern = re.compile(rules.REFERENCE)
        for some in texts:
            yield some.map(lambda x: [{"ref": m[0], "start": m.start()} for m in pattern.finditer(x)] if x else [])

    return found(text)


def references(pages: DataFrame, claim_pages: DataFrame) -> DataFrame:
    """doc_id, page_no, line_no, start, ref, ref_norm, section, figure_no. claim_pages: doc_id, page_no."""
    # most pages have no reference: one read of the text tells, and only the others are cut into lines
    pages = pages.select("doc_id", "page_no", "text")
    lines = lines_of(meeting_all(pages, MAY_REFER))
    drawings = captions(lines_of(meeting_all(pages, MAY_REFER, MAY_NAME), HEAD_LINES)).filter("drawing").groupBy("doc_id", "page_no").agg(F.min(F.struct("line_no", "figure_no")).alias("f")).select("doc_id", "page_no", "f.figure_no")
    # a line that can hold none is not sent to Python
    some = lines.filter(F.col("raw").rlike(MAY_REFER))
    found = some.select("doc_id", "page_no", "line_no", F.inline(places(F.col("raw"))))
    met = found.join(drawings, ["doc_id", "page_no"], "left").join(claim_pages.select("doc_id", "page_no").distinct().withColumn("in_claim", F.lit(True)), ["doc_id", "page_no"], "left")
    section = F.when(F.col("in_claim"), "claim").when(F.col("figure_no").isNotNull(), "drawing").otherwise("description")
    return met.select("doc_id", "page_no", "line_no", "start", "ref", F.upper("ref").alias("ref_norm"), section.alias("section"), F.when(section == "drawing", F.col("figure_no")).alias("figure_no"))


def of_claims(claims: DataFrame) -> DataFrame:
    """doc_id, claim_no, ref, page_no: the different references of each claim (doc_id, claim_no, text, page_start)."""
    return claims.select("doc_id", "claim_no", F.col("page_start").alias("page_no"), F.inline(places(F.col("text")))).select("doc_id", "claim_no", "ref", "page_no").distinct()
