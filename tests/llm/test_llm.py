"""Edge cases, and comparisons with brute force, of the training-data operators."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from docloom.llm import chat_format, decontaminate, html_text, jaccard_join, kneser_ney, licenses, lz_fingerprint, mix, pii, toxicity

TEXTS = [(1, None), (2, ""), (3, "one two"), (4, "one two"), (5, "a b c d e f g h i j k l"), (6, "a b c d e f g h i j k l"), (7, "A B c d e f g h i j k x"), (None, "lone words here"), (8, "word " * 30_000)]


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, sig string, n int")


def test_chat_round_trip(spark):
    texts = ["\\### user:\n</turn>\n\\\\", "", None, "#\n##\n### </turn></turn>\\", "x\n"]
    rows = spark.createDataFrame([(1, i, "assistant", t) for i, t in enumerate(texts)] + [(2, 0, None, "a"), (2, 0, "a\nb\\n", "b"), (None, None, "user", "c")], "conv_id long, turn long, role string, text string")
    back = {r.conv_id: r for r in chat_format.read_back(chat_format.formatted(rows)).collect()}
    assert [t.text for t in back[1].turns] == [t or "" for t in texts] and back[1].loss_text == "".join(t or "" for t in texts)
    assert [(t.role, t.text) for t in back[2].turns] == [("", "a"), ("a\nb\\n", "b")] and len(back[None].turns) == 1


def test_chat_layouts(spark):
    records = ['{"messages":[{"role":"user","content":"q"},{"role":"assistant","content":"a"}]}', '{"conversations":[{"from":"human","value":"q"},{"from":"gpt","value":"a"}]}', '{"instruction":"q","output":"a"}', '{"prompt":"q","response":"a"}', '{"odd":1}', "not json"]
    out = chat_format.turns_from_json(spark.createDataFrame([(r,) for r in records], "r string"), "r").collect()
    assert all([(t.role, t.text) for t in r.turns] == [("user", "q"), ("assistant", "a")] for r in out[:4])
    assert out[4].turns is None and out[5].turns is None


def test_jaccard_against_brute_force(spark):
    r = np.random.default_rng(1)
    base = [f"w{int(x)}" for x in r.integers(0, 500, 200)]
    rows = list(TEXTS)
    for k in range(60):
        w = list(base)
        for i in r.integers(0, 200, int(r.integers(0, 9))):
            w[i] = f"n{k}{i}"
        rows.append((100 + k, " ".join(w)))
    sets = {}
    for i, t in rows:
        w = [x.lower() for x in (t or "").split()]
        sets.setdefault(i, set(zip(*[w[j:] for j in range(4)])) if len(w) >= 4 else ({tuple(w)} if w else set()))
    ids = sorted(i for i in sets if i is not None)
    root = {i: i for i in ids}
    changed = True
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            m = min(root[a], root[b])
            changed |= root[a] != m or root[b] != m
            root[a] = root[b] = m
    for small in (4096, 3):
        got = jaccard_join.jaccard_components(docs_of(spark, rows), 4, 85, 100, small=small).collect()
        assert len(got) == len(rows)
        for g in got:
            if g.doc_id is not None:
                assert (g.n_shingles, g.component_id) == (len(sets[g.doc_id]), root[g.doc_id])


def test_signatures_meet_at_the_bound():
    r = np.random.default_rng(2)
    for size in (5, 12, 40, 300):
        for _ in range(30):
            a = np.unique(r.integers(0, 1 << 63, size).astype(np.uint64))
            k = (100 - 80) * 2 * len(a) // 180 // 2
            b = np.unique(np.concatenate((r.permutation(a)[k:], r.integers(0, 1 << 63, k).astype(np.uint64))))
            both = len(np.intersect1d(a, b))
            if 100 * both >= 80 * (len(a) + len(b) - both) and both < len(a):
                assert np.intersect1d(jaccard_join.signatures(a, 80, 100), jaccard_join.signatures(b, 80, 100)).size


def test_edit_matching_against_brute_force():
    def distance(p, t):
        d = [0] * (len(t) + 1)
        for i, c in enumerate(p, 1):
            e = [i]
            for j, x in enumerate(t, 1):
                e.append(min(d[j] + 1, e[j - 1] + 1, d[j - 1] + (c != x)))
            d = e
        return min(d)

    r = np.random.default_rng(3)
    for _ in range(60):
        p, t = ("".join(r.choice(list("abc"), n)) for n in (int(r.integers(1, 90)), int(r.integers(0, 60))))
        assert decontaminate.best_end(p, t)[0] == distance(p, t)


def test_contaminated_documents_go(spark):
    item = "The quick brown fox jumps over the lazy dog while the cat sleeps in the warm sun of the garden"
    items = spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id long, text string")
    rows = [*TEXTS, (20, f"before {item.upper()}  after"), (21, item.replace("brown", "brwn").replace("cat", "cart")), (22, item[:40])]
    got = {(h.doc_id, h.item_id, h.distance) for h in decontaminate.hits(docs_of(spark, rows), items).collect()}
    assert got == {(20, 1, 0), (21, 1, 2)}
    assert decontaminate.clean(docs_of(spark, rows), items).count() == len(rows) - 2


def test_mix_reaches_targets(spark):
    rows = [(i, "w " * (1 + i * 37 % 900), f"s{i % 4}" if i % 9 else None) for i in range(300)] + [(7, "a a", "s3"), (None, None, "s1"), (900, "", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mix.mixed(spark, docs, block=64).toPandas()
    assert len(out) == len(rows) and (out.taken <= 2 * out["size"]).all()
    for _, g in out.groupby("source", dropna=False):
        assert abs(g.taken.sum() - g.target.iloc[0]) <= 1
    assert mix.mixed(spark, docs.limit(0)).count() == 0


def test_mix_of_many_sources_and_its_order(spark):
    rows = [(i, "w " * (20 + i * 37 % 90), f"host{i % 5000}") for i in range(10_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mix.mixed(spark, docs, block=16).toPandas()
    for _, g in out.groupby("source"):
        assert abs(g.taken.sum() - g.target.iloc[0]) <= 1
    few = spark.createDataFrame([(i, f"{i} " * (5 + i % 7), "abc"[i % 3], "kept") for i in range(90)], "doc_id long, text string, source string, taken string")
    mixed = mix.corpus(spark, few, block=8).collect()
    assert {r.taken for r in mixed} == {"kept"} and sum(r._taken for r in mixed) == round(1.5 * sum(r._size if hasattr(r, "_size") else r.size for r in mixed))
    at = sorted((s.slot, s.first, s.n, r.source, r._taken) for r in mixed for s in r.slots)
    assert sum(n for _, _, n, _, _ in at) == sum(r._taken for r in mixed)
    # equal-token blocks: no slot holds more than a block, one source a slot, and every stretch of slots is near the target weights
    slots = {}
    for slot, _, n, source, _ in at:
        slots.setdefault(slot, [source, 0])
        assert slots[slot][0] == source
        slots[slot][1] += n
    assert max(n for _, n in slots.values()) <= 8
    target = {r.source: r.target for r in mixed}
    order = [slots[k][0] for k in sorted(slots)]
    for upto in (20, 40, len(order)):
        for c in "abc":
            assert abs(order[:upto].count(c) / upto - target[c] / sum(target.values())) < 0.12


def test_lz_neighbours(spark):
    out = {r.doc_id: r for r in lz_fingerprint.compared(docs_of(spark, TEXTS)).collect()}
    order = sorted((x for x in TEXTS if x[0] is not None), reverse=True) + [(None, "lone words here")]
    assert len(out) == len(TEXTS)
    for k, (i, t) in enumerate(order):
        t, o = t or "", order[(k + 1) % len(order)][1] or ""
        edited = t[: len(t) - len(t) // 3] + o[: len(t) // 3]
        assert out[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and out[i].n_chars == len(t)
        assert out[i].fingerprint == lz_fingerprint.fingerprint(t) and out[i].edited_fingerprint == lz_fingerprint.fingerprint(edited)


def test_language_model_edges(spark):
    docs = docs_of(spark, TEXTS)
    out = kneser_ney.scores(docs.select("doc_id", "text"), kneser_ney.fit(docs)).collect()
    assert len(out) == len(TEXTS) and all(r.score <= 0 and r.n_tokens >= 1 for r in out)
    none = kneser_ney.scores(docs.select("doc_id", "text"), kneser_ney.fit(docs.limit(0))).collect()
    assert all(r.n_known == 0 and r.score == 0 for r in none)


def test_toxicity_without_labels(spark):
    docs = docs_of(spark, TEXTS)
    assert toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int")) is None
    assert {r.score for r in toxicity.scores(docs, None).collect()} == {0.0}


def test_pii_spans(spark):
    text = "mail a.b@c.de or +1 (017) 555-7713, host 10.2.3.4, card 4111 1111 1111 1111."
    assert pii.shown(pii.base_spans(text)) == "email:5:13,ip:41:49,card:56:75,phone:17:34"
    field = pii.trained()
    (_, spans), = pii.all_spans(field, ["ask anna (at) mail7 dot com now"], {})
    assert pii.shown(spans) == "email:4:27"
    assert pii.all_spans(field, ["", "Version 2.0 of 2024-01-15"], {}) == [([], []), ([], [])]
    assert pii.masked(docs_of(spark, [*TEXTS, (50, text)])).filter("doc_id = 50").first().text == "mail [EMAIL] or [PHONE], host [IP], card [CARD]."


def test_pii_windows_against_whole_texts(monkeypatch):
    far = "plain words of no kind " * 6
    texts = [f"{far}ask john (AT) example DOT com now {far}", f"{far}ask john[AT]example[DOT]org now {far}", f"{far}ask jane at mailbox.org today {far}", f"{far}Call +1 (017) 555-7713 at noon. {far}"]
    field = pii.trained()
    windows = pii.decoded(field, texts, {})
    assert [[t[s:e] for _, s, e in spans] for t, spans in zip(texts[:2], windows)] == [["john (AT) example DOT com"], ["john[AT]example[DOT]org"]]
    assert any(w == "mailbox.org" for s in pii.neighbourhoods(texts[2]) for w, _ in s)
    monkeypatch.setattr(pii, "neighbourhoods", lambda t: iter([[(m.group(), m.start()) for m in re.finditer(r"\S+", t)]]))
    assert pii.decoded(field, texts, {}) == windows


@pytest.mark.parametrize("page, want", [(None, ""), ("", ""), ("<p>a", "a"), ("<nav>x</nav><article><h1>T</h1><p>a &amp;\n b<br><p>c</article><footer>f</footer>", "T a & b c"), ("<div class=ad>x</div><main><p>y<aside>z</aside></main>", "y")])
def test_main_text(page, want):
    assert html_text.main_text(page) == want


@pytest.mark.parametrize("page, want", [
    ("<header>h</header><h1>T</h1><p>short</p><div class=ad>x</div><div><p>{0}</p></div><div class=ad>y</div><p>last</p><footer>f</footer>", "T short {0} last"),
    ("<h1>T</h1><div><p>{0}</p><p>{0}</p><p>{0}</p></div><form>q</form><article>{1}</article><article>teaser</article>", "T {0} {0} {0} {1} teaser"),
    ("<div>menu</div><article>{0}</article><div class=ad>x</div><p>outside</p>", "{0}")])
def test_short_blocks_and_teasers(page, want):
    body, teaser = "body words " * 20 + "end", "card words " * 10 + "end"
    assert html_text.main_text(page.format(body, teaser)) == want.format(body, teaser)


def test_licences(spark):
    rows = [*TEXTS, (30, "plain line\nReleased under the MIT License.\nmore"), (31, "Distributed under the Foo Public License, version 9.")]
    got = {(r.doc_id, r.family) for r in licenses.scan(docs_of(spark, rows)).collect()}
    assert got == {(30, "mit"), (31, "unknown")}


def test_licences_within_long_lines(spark):
    text = "tree water stone " * 200 + "Licensed under the Apache License, Version 2.0. " + "house river cloud " * 200
    rows = [(1, text), (2, "tree water stone " * 400), (3, "mit " * 300)]
    got = licenses.scan(docs_of(spark, rows)).collect()
    assert got and {(r.doc_id, r.family) for r in got} == {(1, "apache")}
    assert any("Apache License" in text[r.start : r.end] for r in got)


def test_licences_over_wrapped_lines_and_of_several_families(spark):
    mit = "/*\n * MIT License\n *\n * Permission is hereby granted, free of charge, to any person obtaining a copy\n * of this software and associated documentation files (the \"Software\"), to deal\n * in the Software without restriction, including without limitation the rights\n */"
    bsd = "int x;\n\n# Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that the following conditions\n# are met:"
    gpl = "REM This program is free software: you can redistribute it and/or modify\nREM it under the terms of the GNU General Public License as published by\nREM the Free Software Foundation, either version 3 of the License, or\nREM (at your option) any later version."
    rows = [*TEXTS, (40, mit), (41, bsd), (42, gpl), (43, "MIT OR Apache-2.0"), (44, "SPDX-License-Identifier: MIT OR Apache-2.0"), (45, "tree\n\nDistributed under the Foo Public\nLicense, version 9.\n\nstone"), (46, "tree stone\nReleased under the MIT License.\nmore water")]
    texts, out = dict(rows), licenses.scan(docs_of(spark, rows)).collect()
    assert [r.family for r in out if r.doc_id == 45] == ["unknown"]
    got = sorted((r.doc_id, r.family, texts[r.doc_id][r.start : r.end].split()[0], texts[r.doc_id][r.start : r.end].split()[-1]) for r in out if r.doc_id != 45)
    assert got == [(40, "mit", "MIT", "License"), (40, "mit", "Permission", "rights"), (41, "bsd", "Redistribution", "met"), (42, "gpl", "This", "version"),
                   *((i, f, w, "Apache-2.0") for i, w in ((43, "MIT"), (44, "SPDX-License-Identifier:")) for f in ("apache", "mit")), (46, "mit", "Released", "License")]


def test_template_comparison_against_a_table():
    def plain(t, ws):
        rows = [[0] * (len(ws) + 1) for _ in range(len(t) + 1)]
        for i, x in enumerate(t):
            for j, y in enumerate(ws):
                rows[i + 1][j + 1] = rows[i][j] + 1 if x == y else max(rows[i][j + 1], rows[i + 1][j])
        return rows[-1][-1] / max(len(t), 1)

    r = np.random.default_rng(3)
    for _ in range(200):
        t, ws = (list(r.choice(list("abcde"), int(r.integers(0, 30)))) for _ in range(2))
        assert licenses.in_order(t, ws) == plain(t, ws)


def test_pipeline_stages_keep_columns(spark, tmp_path):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, d)
        assert out.columns == docs.columns and 0 < out.count() <= docs.count()
        docs = out
    assert corpus_pipeline.STAGES[-1][1](spark, docs, d).filter(F.col("taken") > 2 * F.col("size")).count() == 0
