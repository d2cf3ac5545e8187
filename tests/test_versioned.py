"""Changes of several tables: whole or not at all."""

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from docloom.sources.store import Files
from docloom.sources.versioned import Change, Database, parted

ORDERS, LINES = "k long, status string, retries int", "k long, n int, text string"


@pytest.fixture
def db(spark, tmp_path):
    made = Database(spark, str(tmp_path))
    orders = spark.createDataFrame([(k, "queued", k % 3) for k in range(50)] + [(None, "odd", 1)], ORDERS)
    lines = spark.createDataFrame([(k, n, f"{k}.{n}") for k in range(50) for n in range(3)], LINES)
    made.change().create("orders", orders, ["k"], buckets=8).create("lines", lines, ["k", "n"], ["k"], 8).commit()
    return made


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def keys(spark, *some):
    return spark.createDataFrame([(k,) for k in some], "k long")


def test_one_change_of_two_tables(spark, db):
    before = rows(db.table("orders"))
    assert db.change().delete("orders", keys(spark, 3, None, 99)).delete("lines", keys(spark, 3, None, 99)).commit() == 2
    assert rows(db.table("orders")) == [r for r in before if r[0] not in (3, None)]
    assert db.table("lines").filter("k = 3").count() == 0 and db.table("lines").count() == 147
    assert rows(db.table("orders", 1)) == before


def test_upsert_first_wins_and_replace(spark, db):
    new = spark.createDataFrame([(1, "done", None, 1), (1, "failed", 7, 2), (None, "new", None, 1), (70, None, None, 1)], f"{ORDERS}, at int")
    db.change().upsert("orders", new, "at", ("retries",)).commit()
    got = {r.k: (r.status, r.retries) for r in db.table("orders").collect()}
    assert len(got) == 52 == db.table("orders").count() and got[1] == ("failed", 7) and got[None] == ("new", 1) and got[70] == (None, None) and got[2] == ("queued", 2)
    db.change().insert_new("orders", spark.createDataFrame([(1, "no", 0), (80, "yes", 0), (80, "yes", 0), (None, "no", 0)], ORDERS)).commit()
    got = {r.k: r.status for r in db.table("orders").collect()}
    assert got[1] == "failed" and got[80] == "yes" and got[None] == "new" and db.table("orders").count() == 53
    db.change().backup("lines", "old", keys(spark, 5, 6), "a").replace("lines", keys(spark, 5, 6), spark.createDataFrame([(5, 9, "x"), (90, 0, "y")], LINES)).commit()
    assert rows(db.table("lines").filter("k in (5, 6, 90)")) == [(5, 9, "x"), (90, 0, "y")]
    assert rows(db.table("old").drop("run_id")) == [(k, n, f"{k}.{n}") for k in (5, 6) for n in range(3)]
    db.change().backup("lines", "old", keys(spark, 5), "b").commit()
    assert sorted(r.run_id for r in db.table("old").collect()) == ["a"] * 6 + ["b"]


def test_a_writer_lost_midway_leaves_the_old_state(spark, db, monkeypatch):
    before, put, times = [rows(db.table(t)) for t in ("orders", "lines")], Change._put, []

    def broken(self, name, *rest):
        times.append(name)
        if len(times) == 2:
            raise OSError("lost")
        put(self, name, *rest)

    monkeypatch.setattr(Change, "_put", broken)
    with pytest.raises(OSError):
        db.change().delete("orders", keys(spark, 1)).delete("lines", keys(spark, 1)).commit()
    assert times == ["orders", "lines"] and db.version() == 1 and [rows(db.table(t)) for t in ("orders", "lines")] == before
    monkeypatch.undo()
    db.change().delete("orders", keys(spark, 1)).delete("lines", keys(spark, 1)).commit()
    assert db.table("orders").count() == 50 and db.table("lines").count() == 147


def test_the_second_of_two_writers_fails(spark, db):
    one, two = db.change(), db.change()
    one.delete("orders", keys(spark, 1)).commit()
    with pytest.raises(RuntimeError):
        two.delete("orders", keys(spark, 2)).commit()
    assert db.table("orders").filter("k in (1, 2)").count() == 1


def test_a_step_sees_the_steps_before_and_vacuum_keeps_the_last(spark, db, tmp_path):
    change = db.change().delete("orders", keys(spark, 4)).insert_new("orders", spark.createDataFrame([(4, "again", 0)], ORDERS))
    assert change.table("orders").filter("status = 'again'").count() == 1 and db.table("orders").filter("status = 'again'").count() == 0
    change.delete("lines", keys(spark)).commit()
    before = [rows(db.table(t)) for t in ("orders", "lines")]
    many = len(Files(spark).names(f"{tmp_path}/data"))
    db.vacuum()
    assert [rows(db.table(t)) for t in ("orders", "lines")] == before and len(Files(spark).names(f"{tmp_path}/data")) < many


def test_keys_of_another_type_find_their_rows(spark, db):
    which = spark.createDataFrame([(k,) for k in range(40)], "k int")
    db.change().backup("lines", "old", which, "a").delete("lines", which).upsert("orders", spark.createDataFrame([(7, "done", 1)], "k int, status string, retries int")).commit()
    assert sorted({r.k for r in db.table("lines").collect()}) == list(range(40, 50)) and db.table("old").count() == 120
    assert db.table("orders").filter("k = 7").count() == 1 and db.table("orders").count() == 51


def test_rows_that_a_change_does_not_name_stay_out_of_its_joins(spark):
    rows_ = spark.range(20_000).selectExpr("nullif(id, 0) as k", "id as n")
    stay, may = parted(rows_, keys(spark, None, 3, 3, 19_999, 70_000))
    assert {3, 19_999, None} <= {r.k for r in may.collect()} and may.count() <= 100
    assert rows(stay.unionByName(may)) == rows(rows_)


def test_of_rows_that_share_a_bit_only_keys_are_joined(spark, db, monkeypatch):
    """With so few bits that most rows meet them, a change still joins no rows but those whose key it did not name."""
    monkeypatch.setattr("docloom.sources.versioned.SLOTS", 64)
    before, seen = rows(db.table("lines")), []

    def counted(some, which):
        rest, may = parted(some, which)
        seen.append((rest.count(), may.count()))
        return rest, may

    monkeypatch.setattr("docloom.sources.versioned.parted", counted)
    gone = [k for k in range(0, 50, 2)]
    db.change().delete("lines", keys(spark, *gone, *gone, None)).commit()
    (stay, may), (_, again) = seen
    assert rows(db.table("lines")) == [r for r in before if r[0] % 2] and stay + may == 150 and 75 < may and 0 < again < may
    new = spark.createDataFrame([(1, 0, "x"), (60, 0, "y")], LINES)
    db.change().upsert("lines", new).replace("lines", keys(spark, 3, 4), new.filter("k = 60").withColumn("k", F.lit(3).cast("long"))).commit()
    want = [r for r in before if r[0] % 2 and r[0] != 3 and r[:2] != (1, 0)]
    assert rows(db.table("lines")) == sorted([*want, (1, 0, "x"), (60, 0, "y"), (3, 0, "y")], key=str)


def test_a_table_is_dealt_where_it_is_read_without_a_sort(spark, tmp_path, monkeypatch):
    """Neither making a table from large pieces nor a change sorts rows by bucket, which spills in large tasks."""
    def plans():
        all_ = spark._jsparkSession.sharedState().statusStore().executionsList()
        return [all_.apply(k).physicalPlanDescription() for k in range(all_.size())]

    key, seen, write = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a: (seen.append(int(spark.conf.get(key, "0"))), write(self, *a))[1])
    db, some = Database(spark, str(tmp_path)), spark.range(5_000).selectExpr("nullif(id, 0) as k", "id as n")
    was = len(plans())
    db.change().create("t", some, ["k"], buckets=8, shuffle=False).commit()
    made = [p for p in plans()[was:] if "InsertIntoHadoopFsRelationCommand" in p]
    assert len(made) == 1 and "Sort" not in made[0] and "Exchange" not in made[0] and rows(db.table("t")) == rows(some)
    assert spark.conf.get(key, "0") == "0" and seen == [9]  # a task that has as many files open as this sorts the rest of its rows
    db.change().delete("t", keys(spark, None, 7)).commit()
    assert rows(db.table("t")) == rows(some.filter("k <> 7"))
    assert len(Files(spark).names(f"{tmp_path}/data")) == 2
