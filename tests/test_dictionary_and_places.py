"""Rules applied in one pass against each rule apart; keys found on pages against looking at every page."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.functions import rules as fixed
from docloom.operators import dictionary, locate


def made_rules(n):
    r = random.Random(1)
    word = lambda: "".join(r.choice("abcdeé데") for _ in range(r.randint(2, 6)))
    forms = ["{a}", "{a} {b}|{c}", "{a}.{{0,6}}{b}|{c}", r"\b{a}\b", "{a}(?:{b}|{c})", "(?:{a})?{b}+", "[{a}]{{3}}{b}", "{a}?|{b}*", r"{a}\.{b}", "({a}|{b})", r"{a}\d+|{c}[x|y]{b}", "(?i){a}"]
    return tuple((f"label{k % (n - 9)}", forms[k % len(forms)].format(a=word(), b=word(), c=word())) for k in range(n))


def test_one_pass_equals_each_rule_apart():
    table = made_rules(283) + fixed.REPLACEMENTS
    rules, r = dictionary.Rules(table), random.Random(2)
    pieces = [x for _, p in table for x in re.findall(r"[^\W_]{2,}", p)]
    texts = [" ".join(r.choice(pieces) if r.random() < 0.5 else r.choice("abcde. 1x") * r.randint(1, 4) for _ in range(60)).swapcase() for _ in range(150)] + ["", "ſecurity tſt", "İmage", "ıMAGE"]
    for text in texts:
        assert rules.found(text) == list(dict.fromkeys(label for label, p in table if text and re.search(p, text, re.I)))
    assert rules.found(None) == []


def test_few_patterns_run():
    r = random.Random(3)
    table = tuple((f"l{k}", f"word{k} of|{k}th .{{0,9}}thing") for k in range(1_000))
    rules = dictionary.Rules(table)
    assert not rules.always
    texts = [" ".join(f"word{r.randrange(10_000)} of" for _ in range(500)) for _ in range(20)]
    for text in texts:
        rules.found(text)
    assert rules.read < 2 * sum(map(len, texts))  # each rule apart reads 1,000 times as much


def test_context_at_the_ends_of_a_search():
    table = ((("a", r"ab.{0,3}\bcd\b"), ("b", r"\bxy(?!z)"), ("c", r"ab$"), ("d", r"^ab"), ("e", "ab.*zz")))
    rules = dictionary.Rules(table)
    for text in ("ab cde" + "f" * 500, "ab cd " * 200, "xyz" + "q" * 300, "ab" + "c" * 300 + "ab", "q" * 300 + "ab" + "q" * 300, "ab" + "q" * 300 + "zz", "ab" * 200 + "z"):
        assert rules.found(text) == [label for label, p in table if re.search(p, text, re.I)]


@pytest.mark.parametrize(("pattern", "want"), [
    ("memory plane|平面", [("memory plane",), ("平面",)]), ("ab+cd", [("ab", "cd")]), ("abc?def", [("def", "ab")]), ("a.b", None), (r"\bect\b", [("ect",)]), ("x[ab]|yy", None), ("(ab|cd)ef", [("abef",), ("cdef",)]), ("xy (?:a(?:b)|c)d", [("xy ",)]), ("(ab|cd)?ef", [("ef",)]), (r"a\(b(?:cd|e)", [("a(bcd",), ("a(be",)]), ("ab{2}cde", [("cde",)]), ("é컴é퓨", None), ("aéxyzé", [("xyz",)]), ("(?=ab)abc", None), (r"ab\|cd", [("ab|cd",)]), ("a[]|b]cd|ef", [("cd",), ("ef",)])])
def test_literals_of_a_pattern(pattern, want):
    assert dictionary.literals(pattern) == want


def test_labels_of_nulls_and_quality(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "a SECURITY bus"), (4, "plain")], "doc_id long, text string")
    rules = spark.createDataFrame([(2, "b", "bus"), (1, "a", "secur.ty|none"), (3, "a", "plain|bus")], "rule_no int, label string, pattern string")
    assert {r.doc_id: r.labels for r in dictionary.labelled(df, rules, "doc_id").collect()} == {1: [], 2: [], 3: ["a", "b"], 4: ["a"]}
    cases = [(["x", "x", "core_y"], ["r"], ["x"]), (["core_y", "generic_memory_operation"], ["r"], ["r"]), (["core_y", "ect_data_labeling"], [], ["core_y"]), (["ect_data_labeling"], [], []), ([], ["r"], ["r"])]
    rows = spark.createDataFrame([(a, b, c) for a, b, c in cases], "a array<string>, b array<string>, c array<string>").select(dictionary.of_quality(F.col("a"), F.col("b")).alias("got"), "c").collect()
    assert [r.got for r in rows] == [r.c for r in rows]
    kinds = [([], ["device", "system"], ["system_feature_extraction"]), (list("abcdefgh"), ["method"], list("abcdef")), ([], ["x"], []), ([], ["process"], ["method_feature_extraction"])]
    rows = spark.createDataFrame(kinds, "f array<string>, k array<string>, w array<string>").select(dictionary.replacements(F.col("f"), F.col("k")).alias("got"), "w").collect()
    assert [r.got for r in rows] == [r.w for r in rows]


@pytest.mark.parametrize(("same", "most"), [(False, 1_000_000), (True, 1_000_000), (False, 3)])
def test_keys_on_pages_against_every_page(spark, monkeypatch, same, most):
    monkeypatch.setattr(locate, "MOST_MARKS", most)
    r = np.random.default_rng(4)
    pages = [(d, p, "".join(r.choice(list("ab  \nc平😀"), int(r.integers(0, 200))))) for d in range(8) for p in (1, 2, 3)] + [(0, 4, None), (0, 5, "ab" * 4_000)]
    keys = []
    for k in range(150):
        d, p, text = pages[int(r.integers(0, 24))]
        a = int(r.integers(0, len(text) + 1))
        keys.append((k, d, text[a:a + int(r.choice([1, 2, 5, 8, 9, 15, 30, 50]))]))
    keys += [(900, 0, None), (901, 0, " \n"), (902, 0, "ab" * 15), (903, 1, "not there at all, this key"), (903, 0, "ab" * 15)]
    clean = lambda x: " ".join((x or "").split())
    want = {}
    for k, d, text in keys:
        key = clean(text)[:30]
        for doc, p, page in pages:
            if key and key in clean(page) and (doc == d or not same):
                a, b = want.get((k, doc), (p, p))
                want[(k, doc)] = min(a, p), max(b, p)
    key_rows = spark.createDataFrame(keys, "key_id long, doc_id long, text string")
    got = locate.first_and_last(key_rows if same else key_rows.drop("doc_id"), spark.createDataFrame(pages, "doc_id long, page_no int, text string"), same).collect()
    assert {(x.key_id, x.doc_id): (x.first_page, x.last_page) for x in got} == want and len(got) == len(want)


def test_no_keys_and_pages_of_lines(spark):
    docs = spark.createDataFrame([(1, "\n".join(map(str, range(45)))), (2, ""), (3, None)], "doc_id long, text string")
    pages = locate.pages_of(docs)
    assert [(r.doc_id, r.page_no, len(r.text.split("\n"))) for r in pages.orderBy("doc_id", "page_no").collect()] == [(1, 1, 20), (1, 2, 20), (1, 3, 5), (2, 1, 1)]
    assert locate.first_and_last(spark.createDataFrame([(1, "")], "key_id long, text string"), pages).count() == 0
