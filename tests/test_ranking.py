"""Two-level ranking against a plain version."""

import math
import random
import re
from collections import Counter

from docloom.operators import postings, ranking

STOP = {"patent", "candidate", "compare", "method", "device", "system"}


def plain(questions, parts):
    """questions: id, text, named; parts: id, doc, text, kind, independent, leaning, flags, weight, confidence, qc_flags, title."""
    tokens = {p[0]: re.findall(r"[^\W_]+", p[2].lower()) for p in parts}
    mean, n, out = sum(map(len, tokens.values())) / len(parts), len(parts), {}

    def count(phrase, t):
        return sum(t[i:i + len(phrase)] == phrase for i in range(len(t) - len(phrase) + 1))

    for q, text, named in questions:
        terms = [x for x in dict.fromkeys([" ".join(text.split()), *re.findall(r"[a-z0-9_]+", text.lower())]) if x.lower() not in STOP and len(x) >= 2][:40]
        bm25 = Counter()
        for phrase in {tuple(re.findall(r"[^\W_]+", x.lower())) for x in terms[:16]} if not named else ():
            f = {p: c for p, t in tokens.items() if (c := count(list(phrase), t))}
            idf = math.log((n - len(f) + 0.5) / (len(f) + 0.5))
            for p, c in f.items():
                bm25[p] += (idf if idf > 0 else 1e-6) * c * 2.2 / (c + 1.2 * (0.25 + 0.75 * len(tokens[p]) / mean))
        pool = dict(sorted(bm25.items(), key=lambda x: (-round(x[1], 9), x[0]))[:100])
        for d in named:
            pool |= dict.fromkeys(sorted(p[0] for p in parts if p[1] == d)[:8])
        docs = {}
        for i, doc, body, kind, independent, leaning, flags, weight, confidence, qc, title in parts:
            if i in pool:
                low = f"{body} {title}".lower()
                s = min(5.0, 0.7 * sum(t.lower() in low for t in terms)) + 2.0 * (kind == "claim") + (1.4 if independent and not leaning else -1.6 if kind == "claim" and leaning else 0)
                s += {"minimal_summary": 0.7, "figure": -0.5}.get(kind, 0) + (max(0.0, min(2.0, pool[i] / 4)) if pool[i] is not None else 0) + 0.4 * weight + min(0.8, max(0.0, confidence - 0.5))
                s -= 0.6 * len(flags) + 2.0 * ("publication_line_only" in flags) + 1.2 * ("short_claim_text" in flags) + 0.8 * len(qc) + 0.4 * (title.lower() in ("memory device", "method"))
                docs.setdefault(doc, []).append((-round(s, 9), i, s))
        rows = []
        for doc, some in docs.items():
            best = sorted(some)[:4]
            rows.append((-round(sum(x[2] for x in best) + 0.3 * math.log1p(len(some)) + 100 * (doc in named), 3), doc, [x[1] for x in best], len(some)))
        for rank, (s, doc, best, many) in enumerate(sorted(rows)[:8], 1):
            out[(q, rank)] = (doc, round(-s, 3), many, best)
    return out


def test_ranking_against_a_plain_version(spark, tmp_path):
    r = random.Random(4)
    words = [f"w{k}" for k in range(25)] + ["method", "x"]
    parts = []
    for i in range(240):
        kind = r.choice(["claim", "title", "line", "figure", "minimal_summary"])
        parts.append((i, i // 8, " ".join(r.choices(words, k=r.randint(1, 12))), kind, kind == "claim" and r.random() < 0.5, r.random() < 0.3, r.choice([[], ["publication_line_only"], ["short_claim_text", "other"]]), r.choice([1.0, 2.1, 3.0]), r.choice([0.4, 0.75, 1.0, 1.6]), r.choice([[], ["a"], ["a", "b"]]), r.choice(["Memory device", "A title w3", "method", "longer title here"])))
    questions = [(k, " ".join(r.choices(words, k=r.randint(1, 20))), r.choice([[], [], [3], [5, 29, 999]])) for k in range(12)] + [(50, "none here", []), (51, "", [])]
    df = spark.createDataFrame(parts, "part long, doc_id long, text string, kind string, independent boolean, leaning boolean, flags array<string>, weight double, confidence double, qc_flags array<string>, title string")
    index = postings.Index(spark, str(tmp_path)).add(df.selectExpr("part as doc_id", "text"))
    got = ranking.ranked(index, spark.createDataFrame(questions, "query_id long, text string, named array<bigint>"), df).collect()
    want = plain(questions, parts)
    found = {(x.query_id, x["rank"]): (x.doc_id, x.score, x.n_parts, [p.part for p in x.parts]) for x in got}
    assert {k: (found.get(k), want.get(k)) for k in found.keys() | want.keys() if found.get(k) != want.get(k)} == {} and len(want) > 50
