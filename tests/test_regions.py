"""Claims out of pages, against the rules taken document by document, line by line."""

import re

from docloom.operators import locate, regions
from docloom.plans import claimed

OPEN = r"(?:A\b|A[A-Za-z]|An\b|The\b|In\b)"
LINE = re.compile(r"(?im)^\s*\d{1,3}\s*[\.:]\s+" + OPEN + r".*(?:comprising|claim|wherein|configured|including)")
SPLIT = {"US": r"(?im)^\s*(\d{1,3})\s*[\.:]\s*(?=" + OPEN + r"|\(canceled\)|cancelled)", "KR": r"(?m)^\s*청구항\s*(\d+)\s*", "": r"(?m)^\s*(\d+)\s*[\.:]\s*"}
CUE = r"(?i)what\s+is\s+claimed\s+is|the\s+invention\s+claimed\s+is|(?:^|\n)\s*(?:i|we)\s+claim\s*:?"
PARENT = {"CN": (r"根据权利要求\s*(\d+)\s*所述", r"如权利要求\s*(\d+)\s*所述", r"权利要求\s*(\d+)\s*所述", r"根据权利要求\s*([0-9]+)", r"如权利要求\s*([0-9]+)"), "KR": (r"청구항\s*(\d+)에\s*있어서", r"청구항\s*(\d+)"), "": (r"claim\s*(\d+)",)}


def flat(x):
    return re.sub(r"\s+", " ", x).strip()


def parent(country, text):
    return next((m[1] for p in PARENT.get(country, PARENT[""]) if (m := re.search(p, text, re.I))), None)


def cn_blocks(pages):
    lines = []
    for line in "\n".join(pages).split("\n"):
        if any(re.match(p, line.strip(), re.I) for p in (r"权\s*利\s*要\s*求\s*书.*页$", r"说\s*明\s*书.*页$", r"CN\s*[A-Z]?\s*[\d\s]+[ABU]?$", r"\d+$")):
            continue
        lines.append(line if line.strip() else "")
    t = re.sub(r"\n{3,}", "\n\n", re.sub(r"CN\s+(\d)\s+(\d)\s+(\d)\s+(\d)\s+(\d+)\s+([ABU])", r"CN \1\2\3\4\5 \6", "\n".join(lines)))
    begin = min((m.start() for p in (r"权\s*利\s*要\s*求\s*书", r"(?m)^\s*1\s*[\.．、]\s*") for m in re.finditer(p, t)), default=0)
    end = next((begin + m.start() for p in (r"说\s*明\s*书", r"技\s*术\s*领\s*域", r"发\s*明\s*内\s*容", r"附\s*图\s*说\s*明") if (m := re.search(p, t[begin:]))), begin + 120_000)
    region = t[begin:end].strip()
    marks = list(re.finditer(r"(?m)(?:^|\n)\s*(\d{1,3})\s*[\.．、]\s*(?=\S)", region))
    return [(m[1], region[m.start():n].strip()) for m, n in zip(marks, [*[m.start() for m in marks[1:]], len(region)], strict=False)]


def plain(country, pages):
    """claim_no, parent, text, first and last page."""
    numbers = range(1, len(pages) + 1)
    if country == "CN":
        skipped = len(pages) > 1
        found = cn_blocks(pages[1:] if skipped else pages)
        if not found and skipped:
            skipped, found = False, cn_blocks(pages)
        source = numbers[1:] if skipped else numbers
        allowed = {n for n in source for _, b in found[:3] if flat(b)[:20] in flat(pages[n - 1])} | {n for n in source if "权利要求书" in pages[n - 1].replace(" ", "")}
        made, seen = [], set()
        for number, block in found:
            if number in seen:
                continue
            seen.add(number)
            for p in (r"(?m)^\s*权\s*利\s*要\s*求\s*书.*$", r"(?im)^\s*CN\s*[A-Z]?\s*[\d\s]+[ABU]?\s*$", r"(?m)^\s*\d+\s*$"):
                block = re.sub(p, "", block)
            if block.strip():
                made.append((number, re.sub(r"\n{3,}", "\n\n", block).strip()))
        allowed = allowed if found else set()
    else:
        cue = [n for n in numbers if (country == "KR" and "청구범위" in pages[n - 1]) or (country == "US" and re.search(CUE, pages[n - 1]))]
        described = [n for n in numbers if (country == "KR" and "발명의 설명" in pages[n - 1]) or (country == "US" and "Detailed Description" in pages[n - 1])]
        first = cue[0] if cue else None
        for n in numbers if first is None else ():
            t, three = pages[n - 1], "\n".join(pages[n - 1:n + 2])
            if country != "US":
                ok = n <= 8 and re.search(r"(^|\n)\s*1\s*[\.．]", t)
            else:
                noise = re.search(r"(?i)(U\.S\.\s+Patent|Sheet\s+\d+\s+of\s+\d+|FIG\.?\s*\d+|cited by examiner)", t) and not LINE.search(t)
                may = n > 1 and t and not noise and LINE.search(t) and n >= max(2, int(len(pages) * 0.35))
                starts = {int(x) for x in re.findall(SPLIT["US"], t)}
                third = rf"(?:{OPEN}|\(canceled\)|cancelled)"
                three_in_row = re.search(r"(?im)^\s*1\s*[\.:]\s+" + OPEN, t) and all(re.search(rf"(?im)^\s*{k}\s*[\.:]\s+" + third, three) for k in (2, 3))
                at_end = n >= len(pages) - 1 and LINE.search(t) and (1 in starts or re.search(r"(?im)^\s*\d{1,3}\s*-\s*\d{1,3}\s*[\.:]\s*\(canceled\)", t))
                ok = may and (three_in_row or (len(starts) >= 3 and LINE.search(t)) or at_end)
            if ok:
                first = n
                break
        if first is None:
            return []
        after = described[0] if described and described[0] > first else len(pages) + 1 if country == "US" else min(len(pages) + 1, first + 6)
        allowed = set(range(first, after))
        text = "\n".join(pages[first - 1:after - 1])
        if country == "US" and (m := re.search(r"(?i)what\s+is\s+claimed\s+is\s*:|the\s+invention\s+claimed\s+is\s*:|(?:^|\n)\s*(?:i|we)\s+claim\s*:?", text)):
            text = text[m.end():]
        parts = re.split(SPLIT.get(country, SPLIT[""]), text)
        made = [(a, flat(b)) for a, b in zip(parts[1::2], parts[2::2], strict=True) if flat(b)]
    out = []
    for number, raw in made:
        where = [n for n in numbers if not allowed or n in allowed]
        begin = next((n for n in where if (k := flat(raw[:80])[:30]) and k in flat(pages[n - 1])), None)
        end = next((n for n in reversed(where) if (k := flat(raw[-80:])[:30]) and k in flat(pages[n - 1])), None)
        out.append((number, parent(country, raw), flat(raw), begin, end or begin))
    return sorted(out, key=str)


def test_claims_against_the_rules_by_document(spark):
    pages, countries = claimed.patents(spark)
    more = spark.createDataFrame([(1, 1, None), (2, 1, "1. A thing."), (3, 1, "What is claimed is:\n1. A thing comprising a part.")], "doc_id long, page_no int, text string")
    kinds = spark.createDataFrame([(1, "US"), (2, ""), (3, "US"), (4, "CN")], "doc_id long, country string")
    got = {}
    for r in regions.extracted(pages.unionByName(more), countries.unionByName(kinds)).collect():
        assert r.claim_type == ("dependent" if r.parent_claim_no else "independent")
        got.setdefault(r.doc_id, []).append((r.claim_no, r.parent_claim_no, r.text, r.page_start, r.page_end))
    want = {i: plain(c, list(texts)) for i, c, texts in [*claimed.PATENTS, (1, "US", ("",)), (2, "", ("1. A thing.",)), (3, "US", ("What is claimed is:\n1. A thing comprising a part.",))]}
    assert {k: sorted(v, key=str) for k, v in got.items()} == {k: v for k, v in want.items() if v}
    assert sum(map(len, want.values())) > 20


def test_claims_of_all_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {}
    for r in claimed.claims_extracted(spark, "/root/testdata/sf0.001").collect():
        got.setdefault(r.doc_id, []).append((r.claim_no, r.parent_claim_no, r.n_chars, r.page_start, r.page_end))
    pages = {}
    for r in locate.pages_of(docs).orderBy("doc_id", "page_no").collect():
        pages.setdefault(r.doc_id, []).append(r.text)
    langs = {r.doc_id: claimed.COUNTRY.get(r.lang, "") for r in docs.select("doc_id", "lang").collect()}
    want = {i: sorted(((a, b, len(t), x, y) for a, b, t, x, y in plain(langs[i], p)), key=str) for i, p in pages.items()}
    assert {k: sorted(v, key=str) for k, v in got.items() if k >= 0} == {k: v for k, v in want.items() if v}


def test_no_pages(spark):
    none = spark.createDataFrame([], "doc_id long, page_no int, text string")
    assert regions.extracted(none, spark.createDataFrame([(1, "US")], "doc_id long, country string")).count() == 0
