"""The worker's queue: two runs from one checkpoint, late, repeated and reordered events, against one pass in order."""

import datetime

import numpy as np

from docloom.plans import streamed
from docloom.sources.versioned import Database
from docloom.streaming import retries

START, HOUR = datetime.datetime(2024, 1, 1), 3_600
SCHEMA = "event_id long, id long, reason string, kind string, ts timestamp"


def at(seconds):
    return START + datetime.timedelta(seconds=float(seconds))


def plain(events, until, wait=6 * HOUR):
    """events: id, reason, seconds, event_id, kind; all items given out up to a time."""
    out, keys = [], {}
    for k, r, t, e, kind in {(e[1], e[2], e[4], e[0], e[3]) for e in events}:
        keys.setdefault((k, r), []).append((t, e, kind))
    for (k, r), some in keys.items():
        given = done = False
        failed, tries = None, 0
        for t, _, kind in [*sorted(x for x in some if x[0] <= until), (until, 0, "end")]:
            if failed is not None and not done and failed + wait <= t:
                tries += 1
                out.append((k, r, at(failed + wait), tries))
                given, failed = True, None
            if kind == "done":
                done = True
            elif kind == "failed" and not done:
                given, failed = False, t
            elif kind == "weak" and not (done or given or failed is not None):
                tries += 1
                out.append((k, r, at(t), tries))
                given = True
    return sorted(out, key=str)


def test_two_runs_with_late_and_repeated_events(spark, tmp_path):
    r = np.random.default_rng(9)
    events = [(k, int(r.integers(0, 12)) or None, ("a", "b", None)[int(r.integers(0, 3))], str(r.choice(["weak", "failed", "done", "other"], p=[0.5, 0.4, 0.05, 0.05])), int(t)) for k, t in enumerate(np.sort(r.integers(0, 60 * HOUR, 600)))]
    # up to 50 minutes late, in another order, and some twice
    sent = sorted(events + events[::7], key=lambda e: e[4] + float(r.random()) * 3_000)
    end = (10_000, 99, "end", "weak", 100 * HOUR)
    for n, part in enumerate((sent[:200], sent[200:350], sent[350:] + [end, (10_001, None, "x", None, 5)])):
        rows = spark.createDataFrame([(e, i, s, k, at(t)) for e, i, s, k, t in part], SCHEMA)
        rows.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        got = retries.run_once(retries.queue(stream, "6 hours", "1 hour"), str(tmp_path / "out"))
        if n == 0:
            assert 0 < got.count()
    until = 99 * HOUR
    want = plain([e for e in events if e[3] != "other"], until)
    assert sorted(((x.id, x.reason, x["at"], x.tries) for x in got.collect() if x.id != 99), key=str) == want and len(want) > 100


def test_queue_of_all_events(spark):
    d = "/root/testdata/sf0.001"
    got = streamed.worker_queue(spark, d).collect()
    events = streamed.as_work(spark.read.parquet(f"{d}/events.parquet")).collect()
    seconds = lambda t: (t - START).total_seconds()
    until = int(max(seconds(e.ts) for e in events) * 1000) / 1000 - HOUR
    assert sorted(((x.id, x.reason, x["at"], x.tries) for x in got), key=str) == plain([(e.event_id, e.id, e.reason, e.kind, seconds(e.ts)) for e in events], until)


def test_pending_ids_are_added_once(spark, tmp_path):
    schema, db = "type string, id long, at timestamp", Database(spark, str(tmp_path / "db"))
    for n, some in enumerate(([("requeue", 1, 5), ("requeue", 2, 6), ("requeue", 1, 3)], [("requeue", 2, 9), ("rebuild", 2, 9)])):
        spark.createDataFrame([(t, i, at(s)) for t, i, s in some], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        retries.gathered(stream, db, "worker", str(tmp_path / "ck")).awaitTermination()
        assert db.table("batches").collect()[0].number == n
    assert sorted((r.type, r.id, r["at"]) for r in db.table("pending").collect()) == [("rebuild", 2, at(9)), ("requeue", 1, at(3)), ("requeue", 2, at(6))]
    before = db.version()
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))  # the checkpoint is lost: batch 0 comes again, with all rows
    retries.gathered(stream, db, "worker", str(tmp_path / "other")).awaitTermination()
    assert db.version() == before and db.table("pending").count() == 3
