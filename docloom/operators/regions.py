"""Claims out of the pages of a document, by the rules of its country, as column steps over ordered pages.

US, KR and others: the claims begin on the first page with a header cue, or else on the first page that looks like claims; they
end before the description, if that comes later, or with the document (US) or six pages on. CN: a region of the joined
pages, without the cover first and with it where that has no claims. Regions are cut at claim numbers, parents are named by
the claims' own words, and the pages of a claim are those that hold its beginning and its end.

A document's pages are numbered from 1; null text is empty; documents without pages or claims give no rows. The
pages of one document are joined in one row, as a document is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.functions import rules
from docloom.functions import text as tx
from docloom.operators import claims as cl
from docloom.operators import locate
from docloom.sources.store import written

CUT, END = "\u0001", "\u0002"
FALLBACK_PAGES, KR_PAGES, REGION = 8, 6, 120_000
ENDS = r"(?U)\A\s+|\s+\z"


def u(pattern: str) -> str:
    """The pattern with Unicode classes, and lines that end at line feeds only."""
    return f"(?Ud){pattern}"


def numbered_pages(pages: DataFrame, countries: DataFrame) -> DataFrame:
    """doc_id, page_no, text, country, n_pages, and what a page shows: cue, looks (like claims), description.

    A page is looked at together with the next two.
    """
    by_doc = Window.partitionBy("doc_id")
    in_order = by_doc.orderBy("page_no")
    rows = pages.select("doc_id", F.col("page_no").cast("int").alias("page_no"), F.coalesce("text", F.lit("")).alias("text")).join(countries.select("doc_id", "country"), "doc_id")
    rows = rows.withColumn("n_pages", F.count("*").over(by_doc).cast("int"))
    rows = rows.withColumn("window", F.concat_ws("\n", "text", F.lead("text", 1).over(in_order), F.lead("text", 2).over(in_order)))
    return shown(rows).drop("window")


def begins(c: Column, number: int, more: str = "") -> Column:
    return c.rlike(rf"(?imUd)^\s*{number}\s*[.:]\s+(?:{rules.CLAIM_OPENING}{more})")


def shown(rows: DataFrame) -> DataFrame:
    text, page, country = F.col("text"), F.col("page_no"), F.col("country")
    us, kr = country == "US", country == "KR"
    cue = (kr & text.contains(rules.CLAIM_CUE["KR"])) | (us & text.rlike(u(rules.CLAIM_CUE["US"])))
    description = (kr & text.contains(rules.DESCRIPTION_CUE["KR"])) | (us & text.contains(rules.DESCRIPTION_CUE["US"]))
    line = text.rlike(u(rules.CLAIM_LINE))
    numbers = F.array_distinct(F.transform(F.regexp_extract_all("text", F.lit(u(rules.CLAIM_SPLIT["US"])), F.lit(1)), lambda x: x.cast("int")))
    likely = (text != "") & ~(text.rlike(u(rules.DRAWING_NOISE)) & ~line) & (cue | (line & (page >= F.greatest(F.lit(2), F.floor(F.col("n_pages") * 0.35)))))
    more = f"|{rules.CANCELED}"
    numbered = begins(text, 1) & begins(F.col("window"), 2, more) & begins(F.col("window"), 3, more)
    late = (F.size(numbers) >= 3) & line
    terminal = (page >= F.col("n_pages") - 1) & line & (F.array_contains(numbers, 1) | text.rlike(u(rules.CANCELED_RANGE)))
    looks = F.when(us, (page > 1) & likely & (numbered | late | terminal)).otherwise((page <= FALLBACK_PAGES) & text.rlike(u(r"(^|\n)\s*1\s*[.．]")))
    return rows.withColumns({"cue": cue, "looks": looks, "description": description})


def page_range(rows: DataFrame) -> DataFrame:
    """doc_id, country, n_pages, first_page, after_page of the claims (numbered_pages()); not for CN."""
    us = F.col("country") == "US"
    least = {c: F.min(F.when(F.col(c), F.col("page_no"))).alias(c) for c in ("cue", "looks", "description")}
    found = rows.filter("country <> 'CN'").groupBy("doc_id", "country", "n_pages").agg(*least.values())
    first = F.coalesce("cue", "looks")
    end = F.when(F.col("description") > first, F.col("description")).when(us, F.col("n_pages") + 1).otherwise(F.least(F.col("n_pages") + 1, first + KR_PAGES))
    return found.filter(first.isNotNull()).select("doc_id", "country", "n_pages", first.alias("first_page"), end.alias("after_page"))


def joined(rows: DataFrame, *keep: str) -> DataFrame:
    """doc_id, keep, text: a document's pages as one text."""
    pages = F.sort_array(F.collect_list(F.struct("page_no", "text")))
    return rows.groupBy("doc_id", *keep).agg(F.array_join(F.transform(pages, lambda p: p["text"]), "\n").alias("text"))


def cut(text: Column, mark: str, keep_number: bool = False) -> Column:
    """The numbered parts of a text, each its number and what follows it."""
    marked = F.regexp_replace(text, u(mark), f"{CUT}$1{END}$0" if keep_number else f"{CUT}$1{END}")
    return F.slice(F.split(marked, CUT), 2, 1 << 30)


def blocks(regions: DataFrame, part: Column) -> DataFrame:
    """regions, and for each numbered part of a region block_no, claim_no, raw_text."""
    each = regions.select(*regions.columns, F.posexplode(part).alias("block_no", "_part"))
    return each.select(*regions.columns, "block_no", F.substring_index("_part", END, 1).alias("claim_no"), F.substring_index("_part", END, -1).alias("raw_text"))


def by_pages(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """Claims of documents that are not CN: doc_id, country, block_no, claim_no, raw_text. spans: page_range()."""
    inside = rows.select("doc_id", "page_no", "text").join(spans, "doc_id").filter((F.col("page_no") >= F.col("first_page")) & (F.col("page_no") < F.col("after_page")))
    body = F.when(F.col("country") == "US", F.regexp_replace("text", u(r"(?s)\A.*?(?:" + rules.CLAIM_HEADER + ")"), "")).otherwise(F.col("text"))
    regions = cl.once(joined(inside, "country"), body=body)
    part = F.when(F.col("country") == "US", cut(F.col("body"), rules.CLAIM_SPLIT["US"])).when(F.col("country") == "KR", cut(F.col("body"), rules.CLAIM_SPLIT["KR"])).otherwise(cut(F.col("body"), rules.CLAIM_SPLIT[""]))
    regions = cl.once(regions, parts=part).select("doc_id", "country", "parts")
    found = blocks(regions, F.col("parts")).select("doc_id", "country", "block_no", "claim_no", tx.collapse_space(F.col("raw_text")).alias("raw_text"))
    return found.filter("raw_text <> ''")


def with_region(rows: DataFrame) -> DataFrame:
    """rows with parts instead of text: the numbered parts of the claims' region of a CN text, without page headers and numbers."""
    clean = F.regexp_replace("text", "\r\n?", "\n")
    for p in rules.PAGE_ARTIFACTS:
        clean = F.regexp_replace(clean, u(rf"{p}(?:\n|\z)"), "")
    clean = F.regexp_replace(clean, u(r"(?m)^\h+$"), "")
    clean = F.regexp_replace(F.regexp_replace(clean, u(rules.CN_NUMBER), "CN $1$2$3$4$5 $6"), "\n{3,}", "\n\n")
    kept = [c for c in rows.columns if c != "text"]
    rows = cl.once(rows.select(*kept, "text"), clean=clean)
    at = [F.nullif(F.regexp_instr("clean", F.lit(u(p))), F.lit(0)) for p in rules.REGION_START]
    rows = cl.once(rows, body=F.substring("clean", F.coalesce(F.least(*at), F.lit(1)), F.length("clean")))
    ends = F.coalesce(*[F.nullif(F.regexp_instr("body", F.lit(u(p))), F.lit(0)) for p in rules.REGION_END], F.lit(REGION + 1))
    rows = cl.once(rows, region=F.regexp_replace(F.substring("body", F.lit(1), ends - 1), ENDS, ""))
    return cl.once(rows, parts=cut(F.col("region"), rules.CLAIM_SPLIT["CN"], True)).select(*kept, "parts")


def by_regions(rows: DataFrame) -> DataFrame:
    """Claims of CN documents, the cover left out first: doc_id, country, block_no, claim_no, raw_text, skipped (the cover)."""
    cn = rows.filter("country = 'CN'").select("doc_id", "country", "page_no", "n_pages", "text")
    first = with_region(joined(cn.filter((F.col("page_no") > 1) | (F.col("n_pages") == 1)), "country", "n_pages"))
    again = cn.join(first.filter((F.size("parts") > 0) | (F.col("n_pages") == 1)).select("doc_id"), "doc_id", "left_anti")
    second = with_region(joined(again, "country"))
    every = first.filter(F.size("parts") > 0).select("doc_id", "country", "parts", (F.col("n_pages") > 1).alias("skipped"))
    every = every.unionByName(second.filter(F.size("parts") > 0).select("doc_id", "country", "parts", F.lit(False).alias("skipped")))
    found = blocks(every, F.col("parts")).drop("parts")
    once = F.row_number().over(Window.partitionBy("doc_id", "claim_no").orderBy("block_no"))
    found = cl.once(found.withColumn("n", once), block=F.regexp_replace("raw_text", ENDS, ""))
    raw = F.col("block")
    for p in rules.BLOCK_ARTIFACTS:
        raw = F.regexp_replace(raw, u(p), "")
    return found.withColumn("raw_text", F.regexp_replace(F.regexp_replace(raw, "\n{3,}", "\n\n"), ENDS, ""))


def claim_pages(rows: DataFrame, spans: DataFrame, cn: DataFrame) -> DataFrame:
    """doc_id, page_no: pages of claims, where the rules of the country name some."""
    others = rows.select("doc_id", "page_no").join(spans.select("doc_id", "first_page", "after_page"), "doc_id").filter("page_no >= first_page and page_no < after_page").select("doc_id", "page_no")
    docs = cn.groupBy("doc_id").agg(F.max("skipped").alias("skipped"))
    scanned = rows.join(docs, "doc_id").filter(~F.col("skipped") | (F.col("page_no") > 1))
    headed = scanned.filter(F.contains(F.replace("text", F.lit(" "), F.lit("")), F.lit("权利要求书"))).select("doc_id", "page_no")
    probes = cn.filter("block_no < 3").select("doc_id", F.col("block_no").alias("key_id"), F.substring(tx.collapse_space(F.col("block")), 1, 20).alias("text"))
    probed = locate.found(probes, scanned.select("doc_id", "page_no", "text"), same_document=True).select("doc_id", "page_no")
    return others.unionByName(headed).unionByName(probed).distinct()


def extracted(pages: DataFrame, countries: DataFrame) -> DataFrame:
    """doc_id, claim_no, block_no, parent_claim_no, claim_type, text, page_start, page_end of each claim.

    pages: doc_id, page_no, text; countries: doc_id, country (US, KR, CN or others).
    """
    rows = written(numbered_pages(pages, countries), "pages")
    spans, cn = written(page_range(rows), "spans"), written(by_regions(rows), "regions")
    kept = cn.filter((F.col("n") == 1) & (F.col("raw_text") != ""))
    every = written(by_pages(rows, spans).unionByName(kept.select("doc_id", "country", "block_no", "claim_no", "raw_text")), "claims")
    allowed = written(claim_pages(rows, spans, cn), "claim-pages")
    rows = rows.join(every.select("doc_id").distinct(), "doc_id", "left_semi")
    some = rows.join(allowed, ["doc_id", "page_no"], "left_semi").unionByName(rows.join(allowed.select("doc_id").distinct(), "doc_id", "left_anti"))
    some = some.select("doc_id", "page_no", "text")
    begin = every.select("doc_id", F.concat(F.lit("s"), F.col("block_no")).alias("key_id"), F.substring("raw_text", 1, 80).alias("text"))
    end = every.select("doc_id", F.concat(F.lit("e"), F.col("block_no")).alias("key_id"), F.expr("right(raw_text, 80)").alias("text"))
    at = locate.first_and_last(begin.unionByName(end), some, same_document=True)
    starts = at.filter("startswith(key_id, 's')").select("doc_id", F.expr("int(substring(key_id, 2))").alias("block_no"), F.col("first_page").alias("page_start"))
    ends = at.filter("startswith(key_id, 'e')").select("doc_id", F.expr("int(substring(key_id, 2))").alias("block_no"), F.col("last_page").alias("page_end"))
    parent = cl.parent(F.col("country"), F.col("raw_text"))
    told = cl.once(every, parent_claim_no=parent).join(starts, ["doc_id", "block_no"], "left").join(ends, ["doc_id", "block_no"], "left")
    return told.select("doc_id", "claim_no", "block_no", "parent_claim_no", F.when(F.col("parent_claim_no").isNull(), "independent").otherwise("dependent").alias("claim_type"),
                       tx.collapse_space(F.col("raw_text")).alias("text"), "page_start", F.coalesce("page_end", "page_start").alias("page_end"))
