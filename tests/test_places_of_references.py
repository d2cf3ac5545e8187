"""References, captions and id lookup against plain versions."""

import random
import re

from docloom.operators import identifiers, references

REF = re.compile(r"\b(?:\d+[A-Za-z]+|[A-Za-z]{1,8}\d+[A-Za-z]*|W\d+|SGMC\d+|MS\d+|IF\d+|CS|DR|CR|FG|CG|SG|EG)\b")
FIGURE = re.compile(r"图\s*(\d+)|FIG\.?\s*(\d+)|도\s*(\d+)", re.I)
PAGES = [(1, 1, "FIG. 3 shows CS and 12a, 12a\n\n  W7  x100 "), (1, 2, "图 5 是结构图。余下\n\ntext 100 200b"), (1, 3, "\n".join(["line"] * 9) + "\nFIG. 9\n图 7 说明"), (1, 4, None), (2, 1, "a 1b\r\n도 4 fig 2\rDR"), (2, 2, "plain"), (3, 1, "")]


def lines_of(text):
    return [x for x in re.split(r"\r\n|[\n\r]", text or "") if x.split()]


def test_references_and_captions(spark):
    pages = spark.createDataFrame(PAGES, "doc_id long, page_no int, text string")
    claims = spark.createDataFrame([(1, 2), (1, 2), (9, 9)], "doc_id long, page_no int")
    heads, refs = {}, set()
    for d, p, text in PAGES:
        clean = [" ".join(x.split()) for x in lines_of(text)]
        first = next(((k, next(g for g in m.groups() if g), x) for k, x in enumerate(clean[:8], 1) if (m := FIGURE.search(x))), None)
        if first:
            heads[(d, p)] = first
        for k, raw in enumerate(lines_of(text), 1):
            for m in REF.finditer(raw):
                section = "claim" if (d, p) == (1, 2) else "drawing" if first else "description"
                refs.add((d, p, k, m.start(), m[0], m[0].upper(), section, first[1] if section == "drawing" else None))
    got = references.captions(references.lines_of(pages)).collect()
    assert {(r.doc_id, r.page_no): (r.line_no, r.figure_no, r.caption) for r in got if r.drawing} == heads
    assert [(r.doc_id, r.page_no, r.figure_no, r.caption) for r in got if not r.drawing] == [(1, 3, "7", "图 7 说明")]
    assert {tuple(r) for r in references.references(pages, claims).collect()} == refs and len(refs) == 8
    told = references.of_claims(spark.createDataFrame([(1, "1", "12a CS 12a", 3), (1, "2", None, 3)], "doc_id long, claim_no string, text string, page_start int"))
    assert sorted(tuple(r) for r in told.collect()) == [(1, "1", "12a", 3), (1, "1", "CS", 3)]


def test_ids_by_numbers(spark):
    r = random.Random(5)
    ids = sorted({r.choice(["us", "cn", "kr", "ep"]) + "".join(r.choice("0123") for _ in range(r.randint(7, 12))) + r.choice(["", "b2"]) for _ in range(800)})
    asked = [(k, r.choice(["", "US ", "한국 ", "중국 cn "]) + " ".join(("000" if r.random() < 0.4 else "") + "".join(r.choice("0123") for _ in range(7)) for _ in range(r.randint(0, 3)))) for k in range(120)] + [(500, None), (501, "0000000"), (502, ids[3][2:9])]
    want = {}
    for k, text in asked:
        low = (text or "").lower()
        prefix = next((p for p, words in (("us", ("us", "미국")), ("cn", ("cn", "중국")), ("kr", ("kr", "한국"))) if any(w in low for w in words)), "")
        out = []
        for f in re.findall(r"\d{7,}", text or ""):
            for form in dict.fromkeys((f, f.lstrip("0") or f)):
                some = sorted((i for i in ids if form in i and i.startswith(prefix)), key=lambda i: (len(i), i))[:8]
                out += [i for i in some if i not in out]
        if out:
            want[k] = out[:8]
    got = {}
    for x in identifiers.lookup(spark.createDataFrame(asked, "query_id long, text string"), spark.createDataFrame([(i,) for i in ids], "id string")).orderBy("query_id", "rank").collect():
        got.setdefault(x.query_id, []).append(x.id)
    assert got == want and len(want) > 5


def test_ids_of_short_and_of_very_long_numbers(spark):
    long = "31" * 13
    ids = sorted({f"{c}{k:08d}{k % 7}b2" for k in range(0, 4000, 3) for c in ("us", "cn")} | {f"kr{long}5", f"us9{long}-{long}", "0000012 and 3", "é0000012", "0000012一"})
    asked = [(1, "0000012"), (2, f"000{long}"), (3, "US 0000000007"), (4, "0000000000"), (5, f"{long}1 or 00{long[:20]}"), (6, "123 4567"), (7, "한국 0001234567")]
    want = {}
    for k, text in asked:
        prefix, out = next((p for p in ("us", "cn") if p in text.lower()), "kr" if "한국" in text else ""), []
        for f in re.findall(r"\d{7,}", text):
            for form in dict.fromkeys((f, f.lstrip("0") or f)):
                out += [i for i in sorted((i for i in ids if form in i and i.startswith(prefix)), key=lambda i: (len(i), i))[:8] if i not in out]
        if out:
            want[k] = out[:8]
    found = identifiers.lookup(spark.createDataFrame(asked, "query_id long, text string"), spark.createDataFrame([(i,) for i in [*ids, *ids, None]], "id string"))
    got = {}
    for x in found.orderBy("query_id", "rank").collect():
        got.setdefault(x.query_id, []).append(x.id)
    assert got == want and {1, 2, 3, 5} <= set(want)
    # of a short number, only the first ids of each country leave the tasks
    sent = identifiers.holding(spark.createDataFrame([(i,) for i in ids], "id string"), spark.createDataFrame([("0",), ("1",)], "fragment string"), 8)
    n = {r.fragment: r["count"] for r in sent.groupBy("fragment").count().collect()}
    assert set(n) == {"0", "1"} and max(n.values()) <= 8 * 4


def test_only_pages_that_can_hold_a_reference_are_cut_into_lines(spark, monkeypatch):
    pages = spark.createDataFrame([*PAGES, (5, 1, "ﬁg 3\nFıG. ٣ 7a"), (5, 2, "도　 7\n\x1f\n9Z"), (5, 3, "no number\n" * 50), (5, 4, "fig x\n3a")], "doc_id long, page_no int, text string")
    want, cut, seen = sorted(map(str, references.references(pages, spark.createDataFrame([], "doc_id long, page_no int")).collect())), references.lines_of, []
    monkeypatch.setattr(references, "lines_of", lambda rows, *most: seen.append(rows) or cut(rows, *most))
    references.references(pages, spark.createDataFrame([], "doc_id long, page_no int"))
    assert [sorted((r.doc_id, r.page_no) for r in x.collect()) for x in seen] == [[(1, 1), (1, 2), (2, 1), (5, 1), (5, 2), (5, 4)], [(1, 1), (1, 2), (2, 1), (5, 1), (5, 2)]]
    monkeypatch.setattr(references, "MAY_REFER", "")  # all pages are cut
    monkeypatch.setattr(references, "MAY_NAME", "")
    monkeypatch.setattr(references, "lines_of", cut)
    assert sorted(map(str, references.references(pages, spark.createDataFrame([], "doc_id long, page_no int")).collect())) == want
