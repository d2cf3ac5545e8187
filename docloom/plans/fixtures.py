"""Small tables of a patent collection, as rows of VALUES that both engines read; each holds its rule's edge cases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LONG = "A memory device comprising a cell array, a page buffer and a control circuit configured to apply a read voltage to a selected word line, wherein the control circuit counts errors. "
TABLES: dict[str, tuple[str, list[tuple]]] = {
    "patents": ("patent_id, country, title, n_pages", [("us1000001p", "US", "Memory device and method of operating the same (57) ABSTRACT", 9), ("us1000002p", "US", "Dev", 4), ("kr2000001p", "KR", "반도체 장치 및 그 동작 방법", 7), ("cn3000001p", "CN", "存储器装置及其操作方法 摘要", 5), ("us1000003p", "US", None, 0)]),
    "claims": ("patent_id, claim_no, claim_type, raw_text, page_start, page_end", [
        ("us1000001p", "1", "independent", LONG, 7, 8), ("us1000001p", "2", "dependent", "The device of claim 1, wherein the circuit is configured to erase.", 8, 8), ("us1000001p", "10", "independent", LONG + "FIG. 3 shows it.", 9, 9), ("us1000001p", "10a", "independent", "Sheet 3 of 9 FIG. 2", 9, 9), ("us1000001p", "3", "dependent", "The device of claim 2 and claim 1.", 9, 9),
        ("us1000002p", "1", "independent", "Memary desver Whas |||| ---- ||||", 3, 3), ("us1000002p", "2", "independent", None, None, None),
        ("kr2000001p", "1", "independent", "메모리 셀 어레이를 포함하는 반도체 장치에 있어서, 상기 장치는 페이지 버퍼를 구비한다.", 5, 6), ("kr2000001p", "2", "dependent", "청구항 1에 있어서, 상기 장치.", 6, 6),
        ("cn3000001p", "1", "independent", "一种存储器装置，其包括存储器单元。", 2, 2), ("cn3000001p", "2", "dependent", "根据权利要求1所述的装置。", 2, 3), ("cn3000001p", "081", "dependent", "如权利要求 1 或 2 所述", 3, 3)]),
    "cards": ("patent_id, title, source_language, claim_type, claim_nos, evidence_ids, problem_labels, solution_labels, effect_labels, confidence, qc_flags, fallback", [
        ("us1000001p", "Memory device and method of operating the same (57) ABSTRACT", "en", "device", "1,2", "claim_1,claim_2,fig_3,claim_99", "power", "page_buffer,read_voltage", "speed", 0.91, None, None), ("us1000002p", "Dev", "en", "device", "1,3", "claim_1", None, None, "speed", 0.55, "short_title", "timeout"),
        ("kr2000001p", "반도체 장치 및 그 동작 방법", "en", "method", "1", "claim_2", "latency", "word_line", None, 0.8, "", None), ("cn3000001p", "存储器装置及其操作方法 摘要", "zh", "method", None, None, None, "Page_Buffer,page_buffer", "power", 0.7, None, None), ("us1000003p", None, None, "unknown", None, None, None, None, None, 0.0, "missing_title", "no_text")]),
    "figures": ("patent_id, figure_no, caption, page_no", [("us1000001p", "3", "FIG. 3 is a block diagram", 3), ("us1000001p", "3", "FIG. 3 continued", 4), ("us1000001p", "3", "FIG. 3 again", 5), ("us1000001p", "3", "FIG. 3 last", 6), ("us1000001p", "1", "FIG. 1", 2), ("kr2000001p", "1", None, 3)]),
    "refs": ("patent_id, claim_no, ref_no, label, section, page_no", [("us1000001p", "1", "100", "memory device", "claim", 7), ("us1000001p", "1", "100", "memory device", "claim", 7), ("us1000001p", "1", "100", "memory device", "description", 4), ("us1000001p", "2", "110", "circuit", "claim", 8), ("us1000001p", None, "110", None, "description", 4), ("kr2000001p", "1", "10", "버퍼", "claim", 5), ("kr2000001p", "1", "10", None, "claim", 5)]),
    "pages": ("patent_id, page_no, line_no, text", [("us1000001p", 1, 1, "United States Patent"), ("us1000001p", 1, 2, "Memory device and method of operating the same"), ("us1000001p", 2, 1, "BACKGROUND of the invention follows here in a few words of text"), ("us1000001p", 9, 1, "claims end here"), ("us1000001p", 10, 1, "The effect of the embodiment is a lower power and a shorter latency of reads"), ("us1000001p", 11, 1, "short"), ("kr2000001p", 1, 1, "대한민국특허청"), ("kr2000001p", 7, 1, "본 발명의 효과는 전력 소모를 줄이고 읽기 속도를 높이는 것이며 그 밖의 효과도 있다. 이 문장은 마흔 글자보다 길다."), ("cn3000001p", 4, 1, "国家知识产权局")]),
    "jobs": ("patent_id, status, retry_count, updated", [("us1000001p", "done", 0, 5), ("us1000002p", "failed", 3, 4), ("kr2000001p", "queued", 0, 3), ("cn3000001p", "failed", 1, 2), ("us1000003p", "running", 2, 1), ("us9999999p", "queued", 0, 6)]),
    "updates": ("patent_id, status, retry_count, updated", [("us1000002p", "queued", None, 7), ("cn3000001p", "done", 1, 8), ("cn3000001p", "failed", 2, 9), ("us7777777p", "queued", 0, 7)]),
    "units": ("unit_id, patent_id, unit_type, text, independent, leans, n_flags, source_weight, confidence, n_qc, bm25", [
        ("u1", "us1000001p", "claim", LONG, True, False, 0, 3.0, 0.91, 0, -6.0), ("u2", "us1000001p", "claim", "The device of claim 1", False, True, 1, 2.1, 0.91, 0, -2.0), ("u3", "us1000001p", "minimal_summary", "page buffer and word line", False, False, 0, 1.5, 0.91, 0, None), ("u4", "us1000001p", "figure", "FIG. 3 page buffer", False, False, 1, 0.9, 0.91, 0, -1.0), ("u5", "us1000001p", "title", "Memory device", False, False, 0, 1.2, 0.91, 0, -12.0),
        ("u6", "kr2000001p", "claim", "word line control", True, False, 0, 3.0, 0.8, 1, -3.0), ("u7", "cn3000001p", "title", "power", False, False, 2, 1.2, 0.4, 2, None)]),
    "terms": ("term", [("page buffer",), ("word line",), ("power",), ("none such",)]),
    "hits": ("query_no, patent_id, score, rank, flags", [(1, "us1000001p", 9.5, 1, None), (1, "kr2000001p", 7.0, 2, "low_minimal_confidence"), (2, "us1000001p", 8.0, 1, None), (2, "us1000002p", 8.5, 2, "missing_strong_independent_claim_text"), (3, "us1000001p", 1.0, 9, None), (3, "cn3000001p", 3.0, 15, "contaminated_independent_claim_text_excluded")]),
    "repairs": ("patent_id, labeler, status, quality_pass, n_labels, confidence, made", [("us1000001p", "a", "ok", True, 3, 0.9, 1), ("us1000001p", "b", "ok", False, 0, 0.5, 2), ("us1000002p", "a", "failed", False, 0, None, 3), ("kr2000001p", "a", "ok", True, 2, 0.7, 4), ("kr2000001p", "b", "ok", True, 2, 0.75, 5)]),
    "seen": ("patent_id, reason, made", [("us1000002p", "empty_problem_labels", 1), ("cn3000001p", "empty_problem_labels", 90), ("kr2000001p", "empty_effect_labels", 95)]),
    "actions": ("id, type, status, patent_ids, dedupe_key, created", [(1, "requeue", "pending", "us1000001p,us1000002p", "k1", 1), (2, "requeue", "pending", "us1000002p,kr2000001p", "k1", 2), (3, "requeue", "done", "cn3000001p", "k1", 3), (4, "rebuild", "pending", None, "k2", 4), (5, "rebuild", "pending", None, "k2", 5)]),
    "numbers": ("n", [(i,) for i in range(1, 13)]),
}


def _literal(x) -> str:
    return "null" if x is None else str(x).lower() if isinstance(x, bool) else f"cast({x} as double)" if isinstance(x, float) else str(x) if isinstance(x, int) else "'" + x.replace("'", "''") + "'"


def values(name: str) -> str:
    """The table as a subquery of either engine."""
    columns, rows = TABLES[name]
    return "(select * from (values " + ", ".join("(" + ", ".join(map(_literal, r)) + ")" for r in rows) + f") as t({columns}))"


def fixture(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"select * from {values(name)}")
