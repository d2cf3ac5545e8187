"""Rules of labels and of claims in texts, with the rows that the SQL gives."""

import duckdb
import pyarrow as pa
from pyspark.sql import functions as F

from docloom.functions import measures
from docloom.functions import rules as fixed
from docloom.functions import text as tx
from docloom.operators import dictionary
from docloom.plans import catalog


def rows_of_both(spark, tmp_path, name, texts):
    """What the query and its SQL give for some documents."""
    folder = str(tmp_path)
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{folder}/documents.parquet/*.parquet')")
    want = con.execute(catalog.SQL[name])
    columns = [c[0] for c in want.description]
    return sorted(map(repr, map(tuple, catalog.QUERIES[name](spark, folder).select(*columns).collect()))), sorted(map(repr, want.fetchall()))


def test_labels_keep_their_kind(spark, tmp_path):
    got, want = rows_of_both(spark, tmp_path, "label_rules", ["power consumption is high; energy saved", None, "", "data was lost and memory saved"])
    assert got == want and len(want) > 3


ODD = ["es desverüau ver", "x desver y", "éFIG. 1 " * 30, None, "", " \n ", "A method. " + "ab cd " * 40, "S100 -- $200 | | | |", "— " * 20, "\U0001d400١ éß " * 50, "Aa " * 7 + "bb " * 8 + "cc " * 9, "The device comprising x"]


def test_audit_takes_words_at_letters_beyond_ascii_as_the_sql_does(spark, tmp_path):
    for name in ("claim_audit", "claim_audit_report", "claim_audit_worst"):
        got, want = rows_of_both(spark, tmp_path, name, ODD)
        assert got == want


def test_labels_of_odd_texts(spark, tmp_path):
    texts = ["power\rreduced", "power\nreduced", "power less", "ENERGY ſaved", "power" + "é" * 24 + "less", "power" + "é" * 25 + "less", None, ""]
    for name in ("label_rules", "label_derive"):
        got, want = rows_of_both(spark, tmp_path, name, texts)
        assert got == want


def test_pieces_are_small_and_whole(monkeypatch):
    monkeypatch.setattr(measures, "PIECE", 10)
    texts = pa.array(["abc", None, "x" * 50, "", "ab", "cd" * 3, "e"])
    some = list(measures.pieces(texts))
    assert pa.concat_arrays(some).equals(texts) and [len(x) for x in some] == [2, 1, 4]


def test_fixed_rules_meet_as_those_of_the_table(spark):
    texts = ["a SECURITY bus", "read\tdata", "캐시 읽기 SSD", "Testing 控制器 image", "", None, "power quality NOR flash"]
    context = {label: f"(?i){p}" for label, p in fixed.REPLACEMENTS}
    rows = spark.createDataFrame([(x,) for x in texts], "text string").select(measures.meeting(F.col("text"), context).alias("m")).collect()
    rules = dictionary.Rules(fixed.REPLACEMENTS)
    assert [r.m for r in rows] == [rules.found(x) for x in texts]


def test_a_claim_is_measured_with_single_spaces_whatever_its_white_space(spark):
    odd = [chr(c) for c in range(0x3100) if c] + ["\U0001f600", "  ", " 　 \n"]
    texts = ["", " ", " a ", "a b", "  a \tb  ", *(f"a{x}b{x}{x} c" for x in odd), *(f"{x}a b{x}" for x in odd)]
    want = [r.t for r in spark.createDataFrame([(k, x) for k, x in enumerate(texts)], "k int, x string").orderBy("k").select(tx.collapse_space("x").alias("t")).collect()]
    assert measures.collapsed(pa.array(texts)).to_pylist() == want
    got = spark.createDataFrame([(k, x) for k, x in enumerate([*texts, None])], "k int, x string").withColumn("m", measures.measured(F.col("x"), {"b": "b"}, {"spaces": " "}, True, True)).orderBy("k").select("m.*").collect()
    assert [(r.b, r.spaces, r.n_clean) for r in got] == [("b" in t, t.count(" "), len(t)) for t in [*want, ""]]


def test_short_tokens_are_counted_by_their_bytes():
    texts = ["an " * 8, "An,aN." * 4, "an " * 7, "é " * 9, "aé " * 9, "a—" * 9, "a_b " * 9, "ab1 " * 9, "abcd " * 9, "x\x00" * 8 + "yz " * 9, "", "Ka " * 8]
    assert measures.repeated(pa.array(["ab", *texts, "ab"]).slice(1, len(texts))).tolist() == [8, 8, 0, 0, 0, 9, 0, 0, 0, 17, 0, 8]
