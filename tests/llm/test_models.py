"""The fitted operators against brute force and on rows they have not learned from."""

import hashlib
import math
import re
import time
import zlib
from collections import Counter, defaultdict
from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.llm import decontaminate, html_text, kneser_ney, licenses, lz_fingerprint, pii, toxicity

SF = "/root/testdata/sf0.001"


def words(text):
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def test_language_model_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 60").collect()] + [(1000, None), (1001, "never seen before")]
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows}
    pairs, left, ahead = Counter(), defaultdict(set), defaultdict(Counter)
    unigrams = Counter()
    for i, t in rows:
        if not held[i]:
            before = "begin"
            for w in [*words(t), "end"]:
                pairs[before, w] += 1
                left[w].add(before)
                ahead[before][w] += 1
                unigrams[w] += 1
                before = w
    two = kneser_ney.discounts(*[sum(c == k for c in pairs.values()) for k in (1, 2, 3, 4)])
    one = kneser_ney.discounts(*[sum(len(s) == k for s in left.values()) for k in (1, 2, 3, 4)])
    n_pairs, v = len(pairs), len(unigrams)
    spare = sum(one[min(len(s), 3)] for s in left.values())
    known = sum(unigrams.values())

    def p(before, w):
        n = len(left.get(w, ()))
        low = (max(n - one[min(n, 3)], 0) + spare / (v + 1)) / n_pairs
        f = ahead.get(before)
        if not f:
            return low
        c = f.get(w, 0)
        return (max(c - two[min(c, 3)], 0) + sum(two[min(x, 3)] for x in f.values()) * low) / sum(f.values())

    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    train = docs.filter(kneser_ney.fold("doc_id", 5) != 1)
    got = {r.doc_id: r for r in kneser_ney.scores(docs, kneser_ney.fit(train)).collect()}
    for i, t in rows:
        tokens = [*words(t), "end"]
        score = sum(math.log10(p(b, w)) for b, w in zip(["begin", *tokens], tokens))
        base = sum(math.log10((unigrams[w] + 0.5) / (known + 0.5 * (v + 1))) for w in tokens)
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(w in unigrams for w in tokens), known)
        assert r.score == pytest.approx(score, rel=1e-9) and r.base_score == pytest.approx(base, rel=1e-9)
    assert sum(p("begin", w) for w in [*unigrams, "unknown"]) == pytest.approx(1)


def kneser_ney_by_definition(counts, seen_before, discount_of, low):
    """p of each symbol after one context: counts {symbol: n}, discounted, over low {symbol: p}."""
    total = sum(counts.values())
    if not total:
        return low
    kept = {x: max(n - discount_of(n), 0) for x, n in counts.items()}
    rest = total - sum(kept.values())
    return {x: (kept.get(x, 0) + rest * low[x]) / total for x in low}


def test_class_models_against_definitions():
    given = [("abba", (2, 0)), ("abc", (1, 1)), ("cab", (0, 3)), ("bb", (1, 2)), ("abcab", (0, 1)), ("caba", (4, 0))]
    order, gram, context, end, n = toxicity.gram_counts([w for w, _ in given], np.array([c for _, c in given]))
    model = toxicity.CharModel(order, gram, context, end, n)
    grams = defaultdict(lambda: [0, 0])
    for w, c in given:
        t = f"\x02{w}\x03"
        for k in range(1, toxicity.ORDER + 1):
            for i in range(max(1, k - 1), len(t)):
                for y in (0, 1):
                    grams[t[i + 1 - k : i + 1]][y] += c[y]

    def count(g, y):
        if len(g) < toxicity.ORDER:
            left = [x for x in grams if len(x) == len(g) + 1 and x[1:] == g]
            shared = len(g) <= toxicity.SHARED
            if left and (m := sum((grams[x][0] + grams[x][1] if shared else grams[x][y]) > 0 for x in left)):
                return m
            return sum(grams[g]) if shared else grams[g][y]
        return grams[g][y]

    alphabet = sorted({g for g in grams if len(g) == 1})
    size = len(alphabet) + 1
    d = {(k, y): kneser_ney.discounts(*[sum(count(g, y) == i for g in grams if len(g) == k) for i in (1, 2, 3, 4)]) for k in range(1, toxicity.ORDER + 1) for y in (0, 1)}

    def p(history, y):
        out = dict.fromkeys([*alphabet, "?"], 1 / size)
        for k in range(1, toxicity.ORDER + 1):
            if k - 1 <= len(history):
                c = history[len(history) - k + 1 :]
                out = kneser_ney_by_definition({x: m for x in alphabet if (m := count(c + x, y))}, None, lambda m: d[k, y][min(m, 3)], out)
        return out

    for w in ("abba", "cabx", "bc", "zab"):
        got, place = model.probabilities([w])
        t = f"\x02{w}\x03"
        for i in range(1, len(t)):
            for y in (0, 1):
                by = p(t[:i], y)
                assert sum(by.values()) == pytest.approx(1)
                assert got[i, y] == pytest.approx(by.get(t[i], by["?"]))


def test_word_pairs_against_definitions():
    texts = [([5, 6, 7, 5, 6], 0), ([5, 7], 0), ([6, 6, 7], 1), ([5, 6, 7], 1), ([8], 1), ([7, 5], 0)]
    left, word, n = toxicity.pair_counts([t for t, _ in texts], [y for _, y in texts], 2)
    model = toxicity.WordModel(left, word, n)
    pairs = {y: Counter(x for t, k in texts if k == y for x in zip([1, *t], [*t, 2])) for y in (0, 1)}
    both = pairs[0] + pairs[1]
    words = sorted({w for _, w in both})
    for y in (0, 1):
        out = dict.fromkeys([*words, 0], 1 / (len(words) + 1))
        for seen in (both, pairs[y]):
            c = {w: m for w in words if (m := sum(x[1] == w for x in seen))}
            d = kneser_ney.discounts(*[sum(m == i for m in c.values()) for i in (1, 2, 3, 4)])
            out = kneser_ney_by_definition(c, None, lambda m: d[min(m, 3)], out)
        d = kneser_ney.discounts(*[sum(m == i for m in pairs[y].values()) for i in (1, 2, 3, 4)])
        for v in (1, 5, 6, 7, 8, 99):
            full = kneser_ney_by_definition({w: m for (x, w), m in pairs[y].items() if x == v}, None, lambda m: d[min(m, 3)], out)
            assert sum(full.values()) == pytest.approx(1)
            number = lambda x: model.numbers(np.array(x, np.uint64))
            got = model.probabilities(number([v] * (len(words) + 1)), number([*words, 99]))[:, y]
            assert got == pytest.approx([full[w] for w in (*words, 0)])


def test_toxicity_on_rows_held_out(spark):
    d = "/root/testdata/sf0.01"
    out = toxicity.op7_toxicity(spark, d).toPandas()
    labels = spark.read.parquet(f"{d}/labels.parquet").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).toPandas()
    seen = out[out.held_out].merge(labels, on="doc_id")
    assert out.score.between(0, 1).all() and len(out) == spark.read.parquet(f"{d}/documents.parquet").count()
    toxic, other = seen[seen.toxic == 1], seen[seen.toxic == 0]
    # about 50 toxic rows to learn from, 14 held out: 9 were found, with no false alarm
    assert toxic.predicted.mean() >= 0.5 and other.predicted.mean() <= 0.05


def test_hits_against_a_search_of_every_place(spark):
    items = [(r.item_id, decontaminate.normal(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("length(text) < 2500 and doc_id < 60")
    got = {(h.doc_id, h.item_id, h.distance) for h in decontaminate.hits(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    want = set()
    for r in docs.collect():
        text = decontaminate.normal(r.text or "")
        for k, item in items:
            if item and text:
                distance, _ = decontaminate.best_end(item, text)
                if distance <= decontaminate.budget(len(item), decontaminate.RATE):
                    want.add((r.doc_id, k, distance))
    assert got == want


def test_pii_digest_of_every_document(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in pii.found(docs).collect():
        base = pii.base_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(pii.shown(base).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == j for k, _, _ in base) for j in range(4))
        assert set(pii.shown(base).split(",")) <= set(r.spans.split(","))


def test_pages_as_articles(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    out = html_text.extracted(pages).toPandas()
    assert len(out) == pages.count() and (out.text.str.len() == out.n_chars).all() and (out.n_chars > 0).mean() > 0.9
    assert not out.text.str.contains(r"<(?:div|p|span|script|a)\b|  ", regex=True).any()


def test_licence_notices_held_out(spark):
    """Notices in words that are no template's, wrapped and among plain text; exact templates in many documents."""
    notices = {
        "apache": ["Licensed under the Apache License, Version 2.0 (the License); you may not use these files except in compliance with it.", "This library is licensed under the Apache License, Version 2.0.", "The code is released under the Apache 2.0 license."],
        "bsd": ["Redistributions and use in source and binary forms, with or without modification, are permitted provided that the conditions below are met:", "This code is governed by a BSD-style license that can be found in the LICENSE file.", "Licensed under the BSD 2-Clause License."],
        "cc": ["The text is licensed under a Creative Commons Attribution 4.0 International License.", "Photos are licensed under CC BY-SA 4.0."],
        "gpl": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", "Licensed under the GNU General Public License, version 2."],
        "mit": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this program and associated files, to deal in the program without restriction", "The software is distributed under the MIT license.", "Available under the MIT License."],
        "mpl": ["This file is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License, version 2.0, as it is."],
        "proprietary": ["Copyright 2019 by its owners. All rights reserved.", "No part of this book may be reproduced without prior written permission of the publisher."],
    }
    r, rows, want = np.random.default_rng(9), [], {}
    plain = [x.text for x in spark.read.parquet(f"{SF}/documents.parquet").filter("length(text) > 300").orderBy("doc_id").limit(120).collect()]
    plain = [t for t in plain if not re.search("(?i)licen[sc]e|rights|copyright|CC BY|spdx|permission", t)]
    for f, texts in notices.items():
        for text in texts:
            for width in (0, 40, 72):
                ws = text.split()
                lines, line = [], ""
                for w in ws:
                    if width and len(line) + len(w) > width:
                        lines.append(line)
                        line = ""
                    line = f"{line} {w}".strip()
                around = [str(x) for x in r.choice(plain, 2)]
                mark = ("# ", "// ", "")[len(rows) % 3]
                want[len(rows)] = f
                rows.append((len(rows), f"{around[0]}\n\n" + "\n".join(mark + x for x in [*lines, line]) + f"\n\n{around[1]}"))
    exact = range(1000, 1030)
    rows += [(i, licenses.TEMPLATES["mit"][2]) for i in exact] + [(2000 + i, t) for i, t in enumerate(plain)]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).toPandas()
    found = got.groupby("doc_id").family.agg(set).to_dict()
    assert all(found.get(i) == {"mit"} for i in exact)
    right = sum(want[i] in found.get(i, ()) for i in want)
    wrong = sum(len(found.get(i, set()) - {want[i]}) for i in want) + sum(len(x) for i, x in found.items() if i >= 2000)
    assert right / len(want) >= 0.9 and right / (right + wrong) >= 0.9, (right, wrong, len(want))


def test_licences_without_the_word_gate(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    model = licenses.train([t[:200] for t in texts[:40] if t and not re.search("(?i)licen|rights", t)])
    speaks = licenses.speaking_words()
    families = lambda speaks: [sorted(n[2] for n in licenses.notices(model, speaks, t)) for t in texts if t]
    gated = families(speaks)
    monkeypatch.setattr(licenses, "paragraphs", lambda ws, _: [(i, min(i + licenses.SPAN, len(ws))) for i in range(0, max(len(ws) - licenses.SPAN // 2, 1), licenses.SPAN // 2)])
    assert gated == families(frozenset(w for t in texts if t for w in licenses.words(t))) and sum(map(len, gated)) >= 5


class Slow(HTMLParser):
    """Lines of a page by another parser, and only by what the given pages have."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines, self.text, self.off, self.article, self.broken = [], "", [], False, False

    def line(self):
        if text := " ".join(self.text.split()):
            self.lines.append((text, self.article, self.broken))
            self.broken = False
        self.text = ""

    def handle_starttag(self, tag, attrs):
        if tag in html_text.BLOCKS:
            self.line()
        if tag in ("head", "nav", "footer", "script", "style") or dict(attrs).get("class") == "ad":
            self.off.append(tag)
            self.broken |= tag in ("nav", "footer")
        self.article |= tag == "article"

    def handle_endtag(self, tag):
        if tag in html_text.BLOCKS:
            self.line()
        if self.off and self.off[-1] == tag:
            self.off.pop()
        self.article &= tag != "article"

    def handle_data(self, data):
        self.text += "" if self.off else data


def slow_text(page):
    s = Slow()
    s.feed(page)
    s.close()
    s.line()
    sizes = []
    for k, (text, article, broken) in enumerate(s.lines):
        sizes += ([0] * html_text.BLOCK if k and (broken or article != s.lines[k - 1][1]) else []) + [len(text)]
    sums = [sum(sizes[i : i + html_text.BLOCK]) for i in range(len(sizes))]
    surges = [i for i, x in enumerate(sums) if x >= html_text.SURGE]
    if not surges:
        return None
    first, last = surges[0], surges[-1]
    while first and sums[first - 1]:
        first -= 1
    while last + 1 < len(sums) and sums[last + 1]:
        last += 1
    places = [i for i, x in enumerate(sizes) if x]
    return " ".join(t for i, (t, _, _) in zip(places, s.lines) if first <= i <= last)


def test_pages_against_a_slow_parse(spark):
    pages = [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    told = [(slow_text(p), html_text.main_text(p), html_text.main_text(re.sub(r"(</?)article\b", r"\1div", p))) for p in pages]
    assert sum(a is not None for a, _, _ in told) >= 0.9 * len(told)
    assert all(a is None or a == b for a, b, _ in told) and sum(b == c for _, b, c in told) >= 0.98 * len(told)


def test_surge_and_dive_decide():
    body = "words of the body " * 20
    page = f"<nav>menu</nav><div>Read this today</div><nav>more</nav><div><p>{body}</p><p>short</p></div><footer>f</footer><div>small print</div>"
    kept = {}
    for surge in (1, 20, html_text.SURGE):
        lines = list(html_text.lines(page))
        a, b = html_text.regions(lines, surge)
        kept[surge] = [t for t, *_ in lines[a:b]]
    assert kept[1] == ["Read this today", body.strip(), "short", "small print"]
    assert kept[html_text.SURGE] == kept[20] == [body.strip(), "short"]
    links = "".join(f"<li><a href=x>{'a link of a menu ' * 8}</a></li>" for _ in range(9))
    assert html_text.main_text(f"<ul>{links}</ul><header>h</header><p>{body}</p>") == body.strip()


@pytest.mark.parametrize("page", ['<a href="x ' * 100_000, "<p class='" * 100_000, "<!-- " * 200_000, "<script " * 150_000 + "</script " * 100_000, "<b>" * 200_000 + "</i>" * 200_000, "<div>" * 100_000 + "x"])
def test_broken_pages_take_linear_time(page):
    began = time.time()
    html_text.main_text(page)
    assert time.time() - began < 5


def test_phrases_against_a_step_by_step_parse():
    def plain(text):
        seen, ends, start = set(), [], 0
        for end in range(1, len(text) + 1):
            if text[start:end] not in seen:
                seen.add(text[start:end])
                ends.append(end)
                start = end
        return ends

    r = np.random.default_rng(5)
    texts = ["", "a", "aa", "a" * 500, "ab" * 300, "the the the cat " * 40] + ["".join(r.choice(list("abc d"), int(r.integers(1, 400)))) for _ in range(200)]
    for a, b in zip(texts, texts[1:] + texts[:1]):
        cut = len(a) - len(a) // 3
        edited = a[:cut] + b[: len(a) // 3]
        assert lz_fingerprint.parse(a).ends == plain(a)
        assert lz_fingerprint.parse_changed(edited, cut, lz_fingerprint.parse(a)) == plain(edited)
