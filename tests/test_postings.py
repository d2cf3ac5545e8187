"""The index of words: places, phrases, bounds of blocks, further parts, and states that change as one."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from docloom.operators import postings, search
from docloom.sources.store import Manifest

SCHEMA = "doc_id long, text string"


def made_texts(n=400):
    r = np.random.default_rng(3)
    words = [f"w{k}" for k in range(60)]
    share = 1 / np.arange(1, 61)
    rows = [(k, " ".join(r.choice(words, int(r.integers(0, 80)), p=share / share.sum()))) for k in range(n)]
    rows[5] = (5, None)
    return rows + [(7, rows[7][1]), (None, "w1 w2 w3 w2 w3"), (9_000, "W1, w2;\nw3 " * 3_000)]


def asked(spark, rows):
    return spark.createDataFrame(rows, "query_id string, tokens array<string>")


@pytest.fixture(scope="module")
def texts():
    return made_texts()


def index_at(spark, folder, *parts):
    index = postings.Index(spark, str(folder))
    for rows in parts:
        index.add(spark.createDataFrame(rows, SCHEMA).withColumn("part", F.lit("kept")).withColumn("block", F.lit(1)))
    return index


PHRASES = [("a", ["w1", "w2"]), ("a", ["w3"]), ("a", ["w3"]), ("b", ["w2", "w2", "w1"]), ("c", ["none", "w1"]), ("d", ["w1", "w2", "w3", "w2"]), ("e", ["w59"]), ("f", [])]


def plain_hits(rows):
    out = []
    for doc, text in rows:
        t = [x for x in "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()]
        for q, p in {(q, tuple(p)) for q, p in PHRASES if p}:
            f = sum(tuple(t[i:i + len(p)]) == p for i in range(len(t) - len(p) + 1))
            if f:
                out.append((q, len(p), doc if doc is not None else -1, len(t), f))
    return sorted(out)


@pytest.mark.parametrize("small", [False, True])
def test_phrase_hits_against_reading_all_texts(spark, tmp_path, monkeypatch, texts, small):
    if small:
        monkeypatch.setattr(postings, "BLOCK_DOCS", 16)
        monkeypatch.setattr(postings, "QUERIES_AT_ONCE", 2)
    index = index_at(spark, tmp_path, texts[:300], texts[300:])
    phrases = asked(spark, PHRASES)
    hits = postings.phrase_hits(index, phrases).collect()
    long = {}
    for r in hits:
        long.setdefault(r.phrase_no, r.query_id)
    assert len(long) == 5
    got = sorted((r.query_id, r.doc_id if r.doc_id is not None else -1, r.n_tokens, r.f) for r in hits)
    assert got == sorted((q, d, n, f) for q, _, d, n, f in plain_hits(texts))
    state = index.state()
    assert state["n_docs"] == len(texts) and len(state["parts"]) == 2


def test_same_ranks_as_without_an_index(spark, tmp_path, texts):
    texts = [(k, t) for k, (_, t) in enumerate(texts)]
    index = index_at(spark, tmp_path, texts)
    phrases = spark.createDataFrame([(1, "w1 w2"), (2, "w3 w1"), (3, "w40 w2")], "query_id long, phrase string")
    want = search.bm25(spark.createDataFrame(texts, SCHEMA), phrases).collect()
    got = postings.search(index, phrases.select("query_id", F.split("phrase", " ").alias("tokens"))).collect()
    assert {(r.query_id, r["rank"]): (r.doc_id, round(r.score, 9)) for r in want} == {(r.query_id, r["rank"]): (r.doc_id, round(r.score, 9)) for r in got}


def test_blocks_are_left_out_and_ranks_stay(spark, tmp_path, monkeypatch, texts):
    monkeypatch.setattr(postings, "BLOCK_DOCS", 8)
    texts = [(k, t) for k, (_, t) in enumerate(texts)]
    index = index_at(spark, tmp_path, texts[:200], texts[200:])
    words = asked(spark, [("a", ["w1", "w2", "w30"]), ("b", ["w45"]), ("b", ["w45", "w46"]), ("c", ["none"])])
    got = {(r.query_id, r["rank"]): (r.doc_id, round(r.score, 9)) for r in postings.search_words(index, words, 5).collect()}
    single = words.select("query_id", F.explode("tokens").alias("t")).select("query_id", F.array("t").alias("tokens"))
    assert got == {(r.query_id, r["rank"]): (r.doc_id, round(r.score, 9)) for r in postings.search(index, single, 5).collect()}
    (queries,) = postings._whole_queries(words, "string")
    every, some = postings.blocks_wanted(index, queries, postings._known(index, queries), 5)
    assert some.count() < every.count()


def test_a_lost_writer_changes_nothing(spark, tmp_path, monkeypatch, texts):
    index = index_at(spark, tmp_path, texts[:50])
    before = postings.search(index, asked(spark, PHRASES)).collect()

    def broken(*_):
        raise OSError("lost")

    monkeypatch.setattr(Manifest, "put", broken)
    with pytest.raises(OSError):
        index.add(spark.createDataFrame(texts[50:], SCHEMA))
    assert sorted(postings.search(index, asked(spark, PHRASES)).collect()) == sorted(before)


def test_two_writers_of_one_state(spark, tmp_path):
    one, two = Manifest(spark, str(tmp_path)), Manifest(spark, str(tmp_path))
    assert one.state() is None and one.put({"a": 1}, 0) == 1
    with pytest.raises(RuntimeError):
        two.put({"a": 2}, 0)
    assert two.state() == {"a": 1} and two.put({"a": 3}, 1) == 2 and one.state(1) == {"a": 1}


def test_index_of_nothing(spark, tmp_path):
    index = index_at(spark, tmp_path / "none", [])
    assert index.state()["n_docs"] == 0 and postings.search(index, asked(spark, PHRASES)).count() == 0
    index = index_at(spark, tmp_path / "blank", [(1, None), (2, " .")])
    assert postings.search(index, asked(spark, PHRASES)).count() == 0 and postings.search_words(index, asked(spark, PHRASES)).count() == 0


def test_cards_keep_scores_of_the_whole_collection(spark, tmp_path, texts):
    texts = [(k, t) for k, (_, t) in enumerate(texts)]
    index = index_at(spark, tmp_path, texts)
    cards = spark.createDataFrame([(k, (k % 3) / 2) for k in range(0, 400, 2)], "doc_id long, confidence double")
    phrases = asked(spark, [("a", ["w1", "w2"]), ("n", [])])
    got = [tuple(r) for r in postings.search_cards(index, phrases, cards, 4).orderBy("query_id", "rank").collect()]
    whole = [(r.doc_id, r.score) for r in postings.scores(index, phrases).collect() if r.doc_id < 400 and r.doc_id % 2 == 0]
    want = sorted(whole, key=lambda x: (-round(x[1], 9), -(x[0] % 3) / 2, x[0]))[:4]
    assert [(r[1], round(r[2], 9)) for r in got[:4]] == [(d, round(s, 9)) for d, s in want]
    assert [r[1:] for r in got[4:]] == [(2, 0.0, 1), (8, 0.0, 2), (14, 0.0, 3), (20, 0.0, 4)]
