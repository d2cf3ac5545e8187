"""Flows that stop midway, fail for some documents, and go on."""

import pytest
from pyspark.sql import functions as F

from docloom.sources.flows import GIVEN, Flow
from docloom.sources.store import Files
from docloom.sources.versioned import parted

DOCS = [(k, f"text {k}") for k in range(40)] + [(50, None), (51, ""), (None, "without a key"), (52, "bad line\ngood line")]


def docs(spark, rows=DOCS):
    return spark.createDataFrame(rows, "doc_id long, text string")


def lines(rows):
    some = rows.withColumn("line", F.explode_outer(F.split("text", "\n")))
    return some.withColumn("error", F.when(F.coalesce("line", F.lit("")) == "", "no text").when(F.col("line").startswith("bad"), "bad line"))


def sized(rows):
    return rows.select("doc_id", "_part", F.length("line").alias("n"))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def flow(spark, folder, *stages, **more):
    return Flow(spark, str(folder), "doc_id", list(stages or (("lines", lines), ("sized", sized))), **({"parts": 6, "at_once": 2} | more))


def want(rows):
    return sorted(((k, len(t)) for k, t in rows if t and "bad" not in t), key=str)


def test_documents_that_fail_wait_and_the_others_go_on(spark, tmp_path):
    f = flow(spark, tmp_path)
    assert f.take(docs(spark)) == 6 and all(f.left()["lines"]) and not f.left()["sized"]
    f.run()
    assert not any(f.left().values()) and rows_of(f.table("sized")) == want(DOCS)
    assert rows_of(f.quarantine()) == [(50, "lines", "no text", 1), (51, "lines", "no text", 1), (52, "lines", "bad line", 1)]
    assert f.table("lines").filter("doc_id = 52").count() == 0 and f.table(GIVEN).count() == len(DOCS)


def test_a_stage_that_is_lost_is_done_for_the_rest_only(spark, tmp_path):
    jobs = []

    def breaks(at):
        def work(rows):
            jobs.append(sorted(r[0] for r in rows.select("_part").distinct().collect()))
            if len(jobs) == at:
                raise OSError("lost")
            return sized(rows)
        return work

    f = flow(spark, tmp_path, ("lines", lines), ("sized", breaks(2)))
    f.take(docs(spark))
    with pytest.raises(OSError):
        f.run()
    assert len(f.left()["sized"]) == 4 and not f.left()["lines"]
    lost, before = jobs.pop(), Files(spark).names(f"{tmp_path}/data")
    again = flow(spark, tmp_path, ("lines", lines), ("sized", breaks(9)))
    again.run()
    assert lost in jobs and sorted(p for j in jobs for p in j) == sorted({p for j in jobs for p in j}) and len(jobs) == 3
    assert set(before) <= set(Files(spark).names(f"{tmp_path}/data")) and rows_of(again.table("sized")) == want(DOCS)
    again.run()
    assert len(jobs) == 3


def test_a_write_that_is_lost_leaves_the_ledger(spark, tmp_path):
    f = flow(spark, tmp_path, ("lines", lines), ("sized", lambda rows: sized(rows).withColumn("n", F.raise_error(F.lit("lost")).cast("int"))))
    f.take(docs(spark))
    with pytest.raises(Exception, match="lost"):
        f.run()
    assert f.table("lines").count() == len(want(DOCS)) and len(f.left()["sized"]) == 6
    flow(spark, tmp_path).run()
    assert rows_of(f.table("sized")) == want(DOCS)


def test_retries_end_and_what_passes_goes_through_all_stages(spark, tmp_path):
    f = flow(spark, tmp_path, tries=3)
    f.take(docs(spark))
    f.run()
    assert f.retry() > 0
    f.run()
    assert rows_of(f.quarantine()) == [(50, "lines", "no text", 2), (51, "lines", "no text", 2), (52, "lines", "bad line", 2)] and rows_of(f.table("sized")) == want(DOCS)
    mended = flow(spark, tmp_path, ("lines", lambda r: lines(r).withColumn("error", F.when(F.col("text").isNull(), "none"))), ("sized", sized))
    assert mended.retry() > 0 and mended.retry() == 0
    mended.run()
    assert rows_of(mended.quarantine()) == [(50, "lines", "none", 3)] and mended.retry() == 0
    assert rows_of(mended.table("sized")) == sorted([*want(DOCS), (51, 0), (52, 8), (52, 9)], key=str)
    assert mended.table("lines").filter("doc_id = 52").count() == 2


def test_more_documents_and_none(spark, tmp_path):
    f = flow(spark, tmp_path)
    assert f.take(docs(spark, [])) == 0 and f.quarantine().count() == 0
    f.take(docs(spark, DOCS[:30]))
    f.run()
    done = f.table("sized").count()
    assert f.take(docs(spark)) > 0 and done == 30
    f.run()
    assert rows_of(f.table("sized")) == want(DOCS) and f.take(docs(spark)) == 0
    with pytest.raises(ValueError):
        flow(spark, tmp_path, ("a", lines), ("a", sized))
    with pytest.raises(ValueError):
        flow(spark, tmp_path, (GIVEN, lines))


def test_only_documents_that_failed_are_joined(spark, tmp_path, monkeypatch):
    """Of a stage's rows, those of documents that failed are shuffled, not the text of all."""
    seen = []

    def counted(rows, which):
        rest, may = parted(rows, which)
        seen.append((rest.count(), may.count()))
        return rest, may

    monkeypatch.setattr("docloom.sources.flows.parted", counted)
    f = flow(spark, tmp_path, tries=2)
    f.take(docs(spark))
    f.run()
    assert seen and all(may <= 4 for _, may in seen) and rows_of(f.table("sized")) == want(DOCS)
    seen.clear()
    assert f.retry() > 0 and seen[0][1] == 3 and seen[0][0] > 0  # of the input, the three documents that failed
    f.run()
    assert rows_of(f.table("sized")) == want(DOCS) and rows_of(f.table("lines").select("line")) == rows_of(spark.createDataFrame([(t,) for _, t in DOCS if t and "bad" not in t], "line string"))


def test_texts_that_were_taken_are_not_joined_again(spark, tmp_path, monkeypatch):
    """A second lot joins keys; of its rows only those whose key proved new after it shared a slot with one that was taken."""
    monkeypatch.setattr("docloom.sources.versioned.SLOTS", 64)
    seen = []

    def counted(rows, which):
        rest, may = parted(rows, which)
        seen.append((rest.count(), may.count(), which.columns))
        return rest, may

    f = flow(spark, tmp_path)
    f.take(docs(spark, DOCS[:30]))
    for module in ("flows", "versioned"):
        monkeypatch.setattr(f"docloom.sources.{module}.parted", counted)
    assert f.take(docs(spark, [*DOCS, *DOCS[35:]]).withColumn("doc_id", F.col("doc_id").cast("int"))) > 0
    (apart, met, columns), (known, again, _) = seen
    assert columns == ["doc_id"] and apart + met == len(DOCS) + len(DOCS[35:]) and known + again == met and 0 < again < met and known > 0
    assert rows_of(f.table(GIVEN)) == rows_of(docs(spark, [*DOCS, *DOCS[35:]]))


def test_failures_are_read_without_the_other_rows(spark, tmp_path):
    f = flow(spark, tmp_path, at_once=6)
    f.take(docs(spark))
    f.run()
    (folder,) = [n for n in Files(spark).names(f"{tmp_path}/data") if n.startswith("lines-")]
    kept = spark.read.parquet(f"{tmp_path}/data/{folder}/_failed=true")
    assert {r[0] for r in kept.select("doc_id").collect()} == {50, 51, 52} and kept.count() == 3  # of 52 the bad line only
    assert rows_of(f.quarantine()) == [(50, "lines", "no text", 1), (51, "lines", "no text", 1), (52, "lines", "bad line", 1)]
