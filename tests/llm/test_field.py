"""The field against enumeration, and every form it was trained on in sentences it was not."""

import itertools

import numpy as np

from docloom.llm import pii

# Neither these nor the three made-up forms below are in the training table.
SENTENCES = ["Ask the porter for {v} when you come.", "Our records list {v} as the main one", "Reply: {v} (until Friday)", "She dictated {v}, slowly and twice.", "new contact {v} since May"]


def scores(field, e, y):
    return sum(e[t, k] for t, k in enumerate(y)) + sum(field.move[a, b] for a, b in itertools.pairwise(y))


def test_viterbi_and_expectations_against_enumeration():
    r, n = np.random.default_rng(5), len(pii.LABELS)
    field = pii.Field()
    field.emit, field.move = r.normal(size=field.emit.shape), r.normal(size=field.move.shape)
    chains = ["write to anna (at)", "call 017 555", "x", "at 12 dot 7"]
    rows = [field.indices(c.split(), {}) for c in chains]
    e, sizes = field.emissions(rows)
    best = field.viterbi(rows)
    p, pair = field.expected(e, sizes)
    pairs = np.zeros((n, n))
    for i, size in enumerate(sizes):
        ways = list(itertools.product(range(n), repeat=int(size)))
        s = np.array([scores(field, e[i], y) for y in ways])
        assert list(best[i]) == list(ways[int(s.argmax())])
        w = np.exp(s - s.max())
        w /= w.sum()
        for t in range(size):
            assert np.allclose(p[i, t], np.bincount([y[t] for y in ways], w, n))
        for y, x in zip(ways, w, strict=True):
            for a, b in itertools.pairwise(y):
                pairs[a, b] += x
    assert np.allclose(pair, pairs)


def luhned(text):
    last = max(i for i, c in enumerate(text) if c.isdigit())
    return next(x for k in range(10) if pii.luhn("".join(filter(str.isdigit, x := f"{text[:last]}{k}{text[last + 1 :]}"))))


def test_every_form_in_sentences_not_trained_on():
    r, field = np.random.default_rng(31), pii.trained()
    digits = lambda n: "".join(map(str, r.integers(0, 10, n)))
    hits, wrong, total = {}, 0, 0
    for k in range(60):
        sentence, values = SENTENCES[k % len(SENTENCES)], pii.forms(r)
        more = {"email": {"{at}": f"jo{digits(1)}k {{at}} bel{digits(1)}a {{dot}} com"}, "phone": {"+-": f"+{digits(2)}-{digits(3)}-{digits(3)}-{digits(4)}", "0--": f"0{digits(2)}-{digits(4)}-{digits(4)}"}}
        for kind, form, value in [(a, b, v) for some in (values, more) for a, fs in some.items() for b, v in fs.items()]:
            value = luhned(value) if kind == "card" else value
            at = sentence.index("{v}")
            (_, spans), = pii.all_spans(field, [sentence.replace("{v}", value)], {})
            want = (pii.KINDS.index(kind), at, at + len(value))
            hits.setdefault((kind, form), []).append(want in spans)
            total, wrong = total + len(spans), wrong + sum(s != want for s in spans)
    assert min(map(np.mean, hits.values())) >= 0.8 and wrong <= 0.05 * total, ({k: np.mean(v) for k, v in hits.items()}, wrong, total)


def test_sentences_without_personal_data():
    field = pii.trained()
    texts = ["In 1998 we sold 12,500 boxes, 400 of them at 3.50 each.", "See section 2.4.1 of version 3.10.2 on page 1024.", "Look at the second dot from the left.", "12 345 6789 100 2000", "From 2020-01-15 to 14.03.2021, 3/4/1999 left out", "order 100200300 of line 55"]
    assert pii.all_spans(field, texts, {}) == [([], [])] * len(texts)
