"""Claims out of pages: all `documents`, twenty lines a page, with a few patents among them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.operators import locate, regions
from docloom.plans.registry import Registry
from docloom.sources.readers import table

here = Registry()
query = here.query
US_CLAIMS = "1. A memory device comprising:\na cell array; and\na page buffer.\n2. The memory device of claim 1, wherein the page buffer\nof circuit PB110 latches data.\n3. The memory device of claim 2, wherein FIG. 3 is shown.\n"
#: id, country, pages: with and without a header cue, with claims after the description, over pages, on the cover only, and none.
PATENTS: tuple[tuple[int, str, tuple[str, ...]], ...] = (
    (-1, "US", ("United States Patent\nMemory device", "Detailed Description\nA device D10 is shown, with a buffer 20a.", "What is claimed is:\n" + US_CLAIMS, "4. A method of reading, comprising\nsensing a cell.\n10. The method of claim 4, configured to wait.")),
    (-2, "US", ("United States Patent", "U.S. Patent Sheet 1 of 3 FIG. 1\nS10 W20 100", "BACKGROUND\nSome text.", US_CLAIMS, "5. (canceled)\n6. An apparatus including a host.")),
    (-3, "US", ("U.S. Patent", "text", "more text", "the last page\n1. A system comprising a host and a bus.")),
    (-4, "US", ("only a cover",)),
    (-5, "KR", ("대한민국특허청\n반도체 장치", "청구범위\n청구항 1\n메모리 셀 어레이를 포함하는 반도체 장치.\n청구항 2\n청구항 1에 있어서, 상기 장치는 버퍼를 구비하는 반도체 장치.", "청구항 3\n청구항 2에 있어서, 상기 장치.\n발명의 설명", "기술분야")),
    (-6, "KR", ("표지", "1. 첫째 장치.\n2. 둘째 장치.", "셋째", *("본문",) * 8)),
    (-7, "CN", ("国家知识产权局\n权利要求书1页", "权 利 要 求 书  1/1 页\n1. 一种存储器装置，其包括存储器单元。\n2. 根据权利要求1所述的装置，其中\n所述单元为闪存。\n2. 重复的编号。", "CN 1 2 3 4 5678 A\n3. 如权利要求 2 所述的装置。\n说 明 书  1/3 页\n技术领域\n1. 本发明涉及存储器。")),
    (-8, "CN", ("权利要求书\n1、一种方法，包括读取。\n2、根据权利要求1的方法。", "说明书\n发明内容")),
    (-9, "CN", ("封面", "没有编号的文本")),
    (-10, "", ("preface", "1. First thing.\n2: Second thing, of claim 1.\n\n3. ", "4. Fourth thing")),
)


def patents(spark) -> tuple[DataFrame, DataFrame]:
    pages = [(i, k, text) for i, _, texts in PATENTS for k, text in enumerate(texts, 1)]
    return spark.createDataFrame(pages, "doc_id long, page_no int, text string"), spark.createDataFrame([(i, c) for i, c, _ in PATENTS], "doc_id long, country string")


COUNTRY = {"en": "US", "es": "CN", "fr": "KR"}


@query()
def claims_extracted(spark, d):
    """Claims with their parents and pages; a document's language stands for its country."""
    docs, (pages, countries) = table(spark, d, "documents"), patents(spark)
    lang = F.coalesce(*[F.when(F.col("lang") == k, v) for k, v in COUNTRY.items()], F.lit(""))
    every = regions.extracted(locate.pages_of(docs).unionByName(pages), docs.select("doc_id", lang.alias("country")).unionByName(countries))
    return every.select("doc_id", "claim_no", "block_no", "parent_claim_no", "claim_type", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"), "page_start", "page_end")
