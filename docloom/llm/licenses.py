"""Operator 10, licence scans by a trained paragraph classifier.

A paragraph is a run of lines with words, joined (marks of comments hold no words); each of its lines is judged
too, so that a notice of one line is not thinned by its neighbours. What is judged (of more than SPAN words,
stretches of SPAN that overlap by half) is the set of its hashed word 1- and 2-grams; a multinomial logistic regression with sparse weights gives each licence family, an unknown licence and plain text a probability.
It is trained on the driver from the templates below (a small table, varied by rule) and on plain stretches drawn from
the corpus (PLAIN at most, by hash, of lines of any length: a documented bound for fitting). A stretch is plain if no
template is like it (below FAR), whatever its words. A temperature calibrates the probabilities on templates (with all
their variants) and plain stretches left out of that training; then all are fitted. A family whose probability reaches SURE is
confirmed by comparison with its templates: the part of the best template's words that the paragraph
has, in order (ALIKE); the likeliest family below SURE needs a whole template (WHOLE). A heading (a licence by name only) is compared with short lines only. Where words of several families
meet, each family is judged without the others' own words, and all that are confirmed are given.
What is licence text with two words of templates but matches no template well enough, and meets no confirmed family,
is 'unknown'.

Only stretches with two words of templates (short lines: one) are judged: others match no template, and a test
judges all of them to the same result. Defined results: null or empty texts: no paragraphs, no families; ties: the first family by name; repeated
rows give the same; extra columns do not matter.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import small_batches, table

#: SURE: more likely than all other licences together
SURE, ALIKE, WHOLE, UNKNOWN_AT = 0.5, 0.55, 0.95, 0.6
WIDTH = 1 << 15
SPAN = 40  # words of a line that are judged at once
FAR = 0.3  # a stretch less like every template than this is plain
PLAIN = 1_500
WORD = re.compile(r"[^\W_]+(?:[.'-][^\W_]+)*")

# Usual licence notices and phrases, by family.
TEMPLATES = {
    "apache": ("Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "SPDX-License-Identifier: Apache-2.0", "This project is released under the Apache 2.0 license."),
    "bsd": ("Licensed under the BSD 3-Clause License.", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:", "SPDX-License-Identifier: BSD-3-Clause", "Released under the BSD 2-Clause License."),
    "cc": ("Licensed under CC BY-NC 4.0.", "Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "This work is licensed under CC BY-SA 3.0.", "SPDX-License-Identifier: CC-BY-4.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    "gpl": ("This work is licensed under the GNU General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "Licensed under the GNU Lesser General Public License, version 2.1.", "SPDX-License-Identifier: GPL-3.0-or-later", "You should have received a copy of the GNU General Public License along with this program."),
    "mit": ("Released under the MIT License.", "Licensed under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction", "SPDX-License-Identifier: MIT", "This software is distributed under the MIT license."),
    "mpl": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License, version 2.0.", "SPDX-License-Identifier: MPL-2.0"),
    "proprietary": ("All rights reserved.", "Copyright 2021 the authors. All rights reserved.", "Unauthorized copying of this file, via any medium, is strictly prohibited.", "Proprietary and confidential.", "No part of this publication may be reproduced without prior written permission of the publisher."),
}
# Licences by name only; for lines of at most NAMED more words, and those of one word beside another family.
HEADINGS = {
    "apache": ("Apache License", "Apache-2.0", "License Apache-2.0"),
    "bsd": ("BSD License", "BSD", "BSD-2-Clause", "BSD-3-Clause", "License BSD-2-Clause", "License BSD-3-Clause"),
    "cc": ("Creative Commons License", "CC-BY-4.0", "CC-BY-SA-4.0", "CC0-1.0", "License CC-BY-4.0", "License CC-BY-SA-4.0"),
    "gpl": ("GNU General Public License", "GNU Lesser General Public License", "GPL License", "GPL", "LGPL", "GPL-2.0", "GPL-3.0", "GPL-2.0-only", "GPL-3.0-only", "GPL-2.0-or-later", "GPL-3.0-or-later", "LGPL-2.1-or-later", "License GPL-2.0-or-later", "License GPL-3.0-or-later"),
    "mit": ("MIT License", "MIT", "License MIT"),
    "mpl": ("Mozilla Public License", "MPL", "MPL-2.0", "License MPL-2.0"),
    "proprietary": (),
}
NAMED = 4
# Words of templates that tell nothing of a licence; others beside them must.
COMMON = frozenset("a an and any are as be by can for from have in is it may no not of on or that the this to under with you".split())
# Marks of comments that are words.
COMMENT = re.compile(r"^[^\S\n]*@?(?:rem|dnl)(?=[^\S\n])", re.I | re.M)
# Licences of no family above, and plain sentences that talk like one.
OTHER = ("Licensed under the Foo Public License, version 1.", "This work is licensed under the terms of the Sample Community License.", "Released under the Example Source License.", "Distributed under the Boost Software License, Version 1.0.", "Licensed under the Eclipse Public License 2.0.", "SPDX-License-Identifier: Zlib", "This file is licensed under the Artistic License.", "Licensed under the European Union Public Licence.", "Released under the Unlicense.", "Distributed under the ISC License.")
TALK = ("He has a driving license and a car.", "The city issued a license to sell food.", "Work is under way and will be released in version 3.", "The general public was pleased with the work.", "She worked under the terms of the contract.", "Permission to land was granted free of charge.", "The apache helicopter landed.", "Students at MIT released a new version.", "This program is free for all.", "You may obtain a copy at the desk.")
FAMILIES = sorted(TEMPLATES)
CLASSES = (*FAMILIES, "unknown", "plain")


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


@lru_cache(maxsize=200_000)
def _hash(w: str) -> int:
    return xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))


def grams(ws: list[str]) -> np.ndarray:
    """Distinct hashed 1- and 2-grams."""
    h = np.fromiter(map(_hash, ws), np.uint64, len(ws))
    two = (h[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (h[1:] + np.uint64(0x165667B19E3779F9))
    two ^= two >> np.uint64(31)
    return np.unique(np.concatenate((h, two)) % np.uint64(WIDTH)).astype(np.int64)


def examples() -> list[tuple[str, int, int]]:
    """The templates, and each with words left out, joined or put into other text, by rule; class, and number of the template."""
    r, out = np.random.default_rng(11), []
    groups = [(t, FAMILIES.index(f)) for f in FAMILIES for t in TEMPLATES[f]] + [(t, CLASSES.index("unknown")) for t in OTHER] + [(t, CLASSES.index("plain")) for t in TALK]
    for k, (text, y) in enumerate(groups):
        ws = text.split()
        out.append((text, y, k))
        for _ in range(7):
            keep = [w for w in ws if r.random() > 0.08]
            before = ["".join(r.choice(list("abdehinorst"), int(r.integers(2, 9)))) for _ in range(int(r.integers(0, 18)))]
            out.append((" ".join(before + keep + before[::-1]), y, k))
    return out


class Classifier:
    def __init__(self, weights: np.ndarray, heat: float):
        self.weights, self.heat = weights, heat

    def probabilities(self, sets: list[np.ndarray]) -> np.ndarray:
        sizes = np.array([len(s) for s in sets])
        z = np.add.reduceat(self.weights[np.concatenate(sets)], np.cumsum(sizes) - sizes, axis=0) / np.sqrt(sizes)[:, None] / self.heat
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def fitted(table: list[tuple[np.ndarray, int]], rounds: int) -> np.ndarray:
    """Weights of a soft-max regression with ridge; small ones are 0."""
    sets, y = [s for s, _ in table], np.array([k for _, k in table])
    sizes = np.array([len(s) for s in sets])
    used, idx = np.unique(np.concatenate(sets), return_inverse=True)
    by = np.argsort(idx, kind="stable")
    cuts = np.flatnonzero(np.append(True, np.diff(idx[by]) > 0))
    of = np.repeat(np.arange(len(sets)), sizes)[by]
    value = (1 / np.sqrt(sizes))[of][:, None]
    places = [idx[e - n : e] for e, n in zip(np.cumsum(sizes), sizes, strict=True)]
    share = np.bincount(y, minlength=len(CLASSES))
    importance = (len(y) / np.maximum(share, 1) / len(CLASSES))[y] ** 0.5
    w, g2 = np.zeros((len(used), len(CLASSES))), np.full((len(used), len(CLASSES)), 1e-6)
    model = Classifier(w, 1.0)
    for _ in range(rounds):
        d = -model.probabilities(places)
        d[np.arange(len(y)), y] += 1
        d *= importance[:, None]
        g = np.add.reduceat(d[of] * value, cuts, axis=0) - 0.003 * w
        g2 += g**2
        w += 0.3 * g / np.sqrt(g2)
    w[np.abs(w) < 0.01] = 0
    full = np.zeros((WIDTH, len(CLASSES)))
    full[used] = w
    return full


def train(plain: list[str], rounds: int = 150) -> Classifier:
    """Every fourth template of a family and every fourth plain stretch calibrate, then all are fitted."""
    some = [(t, y, k) for t, y, k in examples()] + [(t, CLASSES.index("plain"), i) for i, t in enumerate(plain)]
    some = [(grams(w), y, k % 4 == 3) for t, y, k in some if (w := words(t))]
    rest = [(g, y) for g, y, held in some if held]
    first = fitted([(g, y) for g, y, held in some if not held], rounds)
    heats = np.array([0.5, 0.7, 1.0, 1.4, 2.0])
    loss = [-np.log(Classifier(first, h).probabilities([g for g, _ in rest])[np.arange(len(rest)), [y for _, y in rest]] + 1e-9).mean() for h in heats]
    return Classifier(fitted([(g, y) for g, y, _ in some], rounds), float(heats[int(np.argmin(loss))]))


def in_order(template: list[str], ws: list[str]) -> float:
    """The part of the template's words that ws has in the same order: the longest common subsequence, a bit per word."""
    masks: dict[str, int] = {}
    for i, w in enumerate(template):
        masks[w] = masks.get(w, 0) | 1 << i
    every = (1 << len(template)) - 1
    row = every
    for w in ws:
        if m := masks.get(w):
            u = row & m
            row = (row + u | row - u) & every
    return (len(template) - row.bit_count()) / max(len(template), 1)


@lru_cache
def template_words(family: str) -> list[list[str]]:
    return [words(t) for t in TEMPLATES[family]]


@lru_cache
def heading_words(family: str) -> list[list[str]]:
    return [words(t) for t in HEADINGS[family]]


@lru_cache
def own_words(family: str) -> frozenset[str]:
    """The words of a family's templates and headings that no other licence here has."""
    others = {w for f in FAMILIES if f != family for t in (*template_words(f), *heading_words(f)) for w in t} | {w for t in OTHER for w in words(t)}
    return frozenset(w for t in (*template_words(family), *heading_words(family)) for w in t) - others


def likeness(family: str, ws: list[str], i: int, j: int, own: bool = False) -> float:
    """To the best template, of the words i to j; with own, of the templates by whose own words the family is told.

    A template longer than the words is compared with their surroundings too, no wider than the template.
    """
    best = 0.0
    for t in template_words(family):
        near = ws[max(0, i - max(0, len(t) - SPAN)) : j + max(0, len(t) - SPAN)]
        if not own or own_words(family).intersection(t).intersection(near):
            best = max(best, in_order(t, near))
    return max([best, *(in_order(t, ws) for t in heading_words(family) if len(ws) <= len(t) + NAMED and (own or len(t) > 1))])


def judged(p: np.ndarray, ws: list[str], i: int, j: int) -> tuple[str, float, float] | None:
    """Of the words i to j of a line or paragraph: family or unknown, its probability, likeness to the best template; None for plain text."""
    k = int(np.argmax(p[: len(FAMILIES)]))
    licence = 1 - p[CLASSES.index("plain")]
    if licence < UNKNOWN_AT:
        return None
    alike = likeness(FAMILIES[k], ws, i, j)
    if alike >= (ALIKE if p[k] / licence >= SURE else WHOLE):
        return FAMILIES[k], float(p[k]), alike
    return ("unknown", float(p[CLASSES.index("unknown")]), alike) if len(speaking_words().intersection(ws[i:j])) > 1 else None


def judged_all(model: Classifier, p: np.ndarray, ws: list[str], i: int, j: int) -> list[tuple[str, float, float]]:
    """judged(), and where own words of several families meet, each of these families that is confirmed without the others' own words."""
    first, own = judged(p, ws, i, j), ws[i:j]
    joined = {"and", "or"}.intersection(own)
    if first is None and not (joined and len(own) <= 2 * NAMED):  # "MIT OR Apache-2.0" alone has few words to speak for a licence
        return []
    out = {first[0]: first} if first and first[0] != "unknown" else {}
    named = [f for f in FAMILIES if not own_words(f).isdisjoint(own)]
    for f in named if len(named) > 1 else ():
        foreign = frozenset().union(*(own_words(g) for g in named if g != f))
        rest = [w for k, w in enumerate(own) if w not in foreign and not (w in ("and", "or") and not foreign.isdisjoint(own[max(0, k - 1) : k + 2]))]
        if f in out or (alike := likeness(f, rest, 0, len(rest), own=True)) < ALIKE:
            continue
        q = model.probabilities([grams(rest)])[0]
        k, licence = FAMILIES.index(f), 1 - q[CLASSES.index("plain")]
        if licence >= UNKNOWN_AT and q[k] / licence >= SURE:
            out[f] = (f, float(q[k]), alike)
    return list(out.values()) or ([first] if first else [])


@lru_cache
def speaking_words() -> frozenset[str]:
    """The words of all templates and headings."""
    every = (*OTHER, *(t for ts in (*TEMPLATES.values(), *HEADINGS.values()) for t in ts))
    return frozenset(w for t in every for w in words(t)) - COMMON


def paragraphs(ws: list[str], speaks: frozenset[str]) -> list[tuple[int, int]]:
    """A line's words, in stretches of SPAN by half a SPAN (a short line whole), where two words speak, or one of three."""
    out = []
    for i in range(0, max(len(ws) - SPAN // 2, 1), SPAN // 2):
        j = min(i + SPAN, len(ws))
        if (found := len(speaks.intersection(ws[i:j]))) >= 2 or (found and len(ws) <= 3):
            out.append((i, j))
    return out


def in_paragraph(model: Classifier, speaks: frozenset[str], given: list[tuple[int, str, list[str]]]) -> list[list]:
    """start, end, family, probability, likeness of a paragraph's stretches, from its lines' starts, texts and words."""
    ws = [w for _, _, few in given for w in few]
    if not speaks.intersection(ws):
        return []
    ends = np.cumsum([len(few) for _, _, few in given]).tolist()
    own = list(zip([0, *ends[:-1]], ends, strict=True))
    work = [(a + i, a + j, a, b) for a, b in own for i, j in paragraphs(ws[a:b], speaks)]
    if len(own) > 1:  # a stretch within one line has been judged with it
        work += [(i, j, 0, len(ws)) for i, j in paragraphs(ws, speaks) if not any(a <= i and j <= b for a, b in own)]
    if not work:
        return []
    speaking = [(a, b) for a, b in own if paragraphs(ws[a:b], speaks)]
    pieces: list[list] = []
    for (i, j, a, b), p in zip(work, model.probabilities([grams(ws[i:j]) for i, j, _, _ in work]), strict=True):
        for v in judged_all(model, p, ws[a:b], i - a, j - a):
            at, end = i, j
            if (a, b) not in own:  # plain lines at the ends do not belong to it
                by = [x for x in speaking if x[0] < j and x[1] > i]
                if by:
                    at, end = max(i, min(x for x, _ in by)), min(j, max(y for _, y in by))
            pieces.append([at, end, *v])
    sure = [x for x in pieces if x[2] != "unknown"]
    pieces = sure + [x for x in pieces if x[2] == "unknown" and not any(y[0] < x[1] and x[0] < y[1] for y in sure)]
    out: list[list] = []
    for x in sorted(pieces, key=lambda x: (x[2], x[0], x[1])):
        if out and out[-1][2] == x[2] and x[0] <= out[-1][1] - 1:
            last = out[-1]
            last[1], last[3], last[4] = max(last[1], x[1]), max(last[3], x[3]), max(last[4], x[4])
        else:
            out.append(x)
    if not out:
        return []
    spots = [(at + m.start(), at + m.end()) for at, line, _ in given for m in WORD.finditer(line)]
    return sorted([spots[i][0], spots[j - 1][1], *v] for i, j, *v in out)


def notices(model: Classifier, speaks: frozenset[str], text: str) -> list[list]:
    """start, end, family, probability, likeness of the stretches of one text; neighbours of a family are one."""
    at, out, given = 0, [], []
    text = COMMENT.sub(lambda m: " " * len(m.group()), text)
    for line in text.split("\n"):
        if few := words(line):
            given.append((at, line, few))
        elif given:
            out += in_paragraph(model, speaks, given)
            given = []
        at += len(line) + 1
    return out + (in_paragraph(model, speaks, given) if given else [])


def plain_stretches(some: DataFrame, most: int) -> list[str]:
    """Of a bounded sample of documents, at most `most` stretches that no template is like, by their hash."""
    every = [t for f in FAMILIES for t in (*template_words(f), *heading_words(f))] + [words(t) for t in OTHER]

    def run(it):
        for b in it:
            out = []
            for text in b.column("text").to_pylist():
                ws = words(text or "")
                for i in range(0, len(ws), SPAN):
                    if max(in_order(t, ws[i : i + SPAN]) for t in every) < FAR:
                        out.append(" ".join(ws[i : i + SPAN]))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["t"])

    return [r["t"] for r in some.select("text").mapInArrow(run, "t string").orderBy(F.xxhash64("t"), "t").limit(most).collect()]


def scan(docs: DataFrame, plain_rows: int = PLAIN) -> DataFrame:
    """doc_id, start, end (code points), family, probability, likeness: a row for each stretch of text with a licence."""
    spark = docs.sparkSession
    small_batches(spark)
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    total = given.count()
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003 < min(1.0, plain_rows / max(total, 1))
    model = train(plain_stretches(given.filter(F.coalesce(share, F.lit(False))), plain_rows))
    sent = spark.sparkContext.broadcast((model, speaking_words()))  # of fixed size

    def run(it):
        model, speaks = sent.value
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.float64()]
        for b in it:
            out = [(doc, *x) for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True) if text for x in notices(model, speaks, text)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], ["doc_id", "start", "end", "family", "probability", "likeness"])

    return given.mapInArrow(run, "doc_id long, start long, end long, family string, probability double, likeness double")


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


QUERIES = {"op10_licenses": op10_licenses}
