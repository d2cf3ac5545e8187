import os

import duckdb
import pytest
from pyspark.sql import functions as F

from docloom.functions import text as tx
from docloom.operators import evidence, labels, search
from docloom.plans import catalog
from docloom.sources import readers
from docloom.streaming import workers

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"create view {f.split('.')[0]} as select * from read_parquet('{SF}/{f}')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_equals_sql(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF).toPandas()
    want = duck.sql(catalog.SQL[name]).df()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols and len(got) == len(want)
    got, want = (x[cols].sort_values(cols).reset_index(drop=True) for x in (got, want))
    for c in cols:
        if got[c].dtype.kind in "fi" and want[c].dtype.kind in "fi":
            assert ((got[c].fillna(-1) - want[c].fillna(-1)).abs() < 1e-5).all()
        else:
            assert (got[c].astype(str) == want[c].astype(str)).all()


def test_numbers_in_text(spark):
    df = spark.createDataFrame([("12abc",), ("abc",), ("081",), ("81",), ("10a",), (None,)], "x string")
    rows = df.select("x", tx.leading_number(F.col("x")).alias("n"), tx.clause_number(F.col("x")).alias("c")).collect()
    assert [(r.n, r.c) for r in rows] == [(12, "12"), (0, None), (81, None), (81, None), (10, "10"), (0, None)]


def test_space_and_bad_json(spark):
    df = spark.createDataFrame([("a　 b ",), (None,), ("[\"x\"]",)], "x string")
    rows = df.select(tx.collapse_space(F.col("x")).alias("s"), tx.json_strings(F.col("x")).alias("j")).collect()
    assert [r.s for r in rows] == ["a b", "", '["x"]'] and [r.j for r in rows] == [[], [], ["x"]]


def test_empty_documents(spark):
    docs = spark.createDataFrame([(1, ""), (2, None)], "doc_id long, text string")
    assert evidence.spans(docs).count() == 0
    assert search.bm25(docs, spark.createDataFrame([(1, "a b")], "query_id long, phrase string")).count() == 0


def test_first_kept_keeps_nulls(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "a", 2), (1, None, 3), (1, None, 4)], "k long, l string, o int")
    assert sorted(r.o for r in readers.first_kept(df, ["k", "l"], "o").collect()) == [1, 3, 4]


def test_stream_keeps_every_event(spark, tmp_path):
    events = spark.read.parquet(f"{SF}/events.parquet")
    events.write.parquet(str(tmp_path / "in"))
    q = workers.keep_state(workers.event_stream(spark, str(tmp_path / "in"), events.schema), str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == events.count()


def test_labels_by_near_cues(spark):
    texts = ["High power consumption was seen", "The latency is reduced and errors are fewer; fewer errors", "power " + "x" * 40 + " consumed", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: (r.problems, r.effects) for r in labels.labelled(docs).collect()}
    assert rows[0] == (["power_consumption"], [])
    assert rows[1] == (["data_transfer_latency", "error_risk"], ["latency_reduction", "error_reduction"])
    assert rows[2] == rows[3] == ([], []) and rows[4] == ([], [])


def test_kinds_quantities_windows(spark):
    df = spark.createDataFrame([("A method for a system, 10 ms at 5 GHz, 10 ms",), ("",), (None,)], "x string")
    one, two = labels.kinds(F.col("x"))
    rows = df.select(one.alias("a"), two.alias("b"), labels.quantities(F.col("x")).alias("q"), labels.window_of(F.col("x"), "system", 4, 6).alias("w")).collect()
    assert (rows[0].a, rows[0].b, rows[0].q, rows[0].w) == ("system", ["method"], ["10 ms", "5 GHz"], "r a system")
    assert [(r.a, r.q, r.w) for r in rows[1:]] == [(None, [], None)] * 2


def test_chunks_keep_every_turn(spark):
    turns = [(1, i, "x" * n) for i, n in enumerate((4, 4, 9, 30, 1, 0))] + [(2, 0, None)]
    rows = labels.chunks(spark.createDataFrame(turns, "conv_id long, turn long, text string"), 10).orderBy("conv_id", "chunk_no").collect()
    assert [(r.conv_id, r.chunk_no, r.first_turn, r.last_turn, r.n_chars) for r in rows] == [(1, 1, 0, 1, 9), (1, 2, 2, 2, 9), (1, 3, 3, 3, 30), (1, 4, 4, 5, 2), (2, 1, 0, 0, 0)]
