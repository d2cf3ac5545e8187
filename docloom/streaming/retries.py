"""A worker's queue kept by a stream: weak items are given out once, failed ones again after a while, pending ids gathered.

Per key (id, reason), in the order of event time: a weak item is given out if the key is not done, not given out already, and not
within the back-off of a failure; a failed key is given out again when the back-off has passed, without a further event;
a done key never. Events wait in the state until the watermark has passed them, so what comes late (up to `late`) or in another
order changes nothing, and events repeated within `late` (same event_id) count once. The state of a key is its standing and the events of
the last `late`, and lives in the checkpoint: a restarted query goes on where it stopped.

Events later than `late` are dropped; events of one time go by event_id; null ids or reasons are keys like others; null times and
unknown kinds are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from docloom.sources.versioned import Database

WEAK, FAILED, DONE = "weak", "failed", "done"
STATE = "open boolean, done boolean, failed_at long, tries int, until long, at array<long>, event array<long>, kind array<string>"
ITEMS = "at long, tries int"


@dataclass
class Standing:
    """Of a key; times in microseconds. until: what has been taken in."""

    open: bool = False
    done: bool = False
    failed_at: int | None = None
    tries: int = 0
    until: int = -(1 << 62)

    def give(self, at: int) -> int:
        self.open, self.failed_at, self.tries = True, None, self.tries + 1
        return at

    def due(self, wait: int) -> int | None:
        return None if self.done or self.open or self.failed_at is None else self.failed_at + wait

    def advance(self, events: list[tuple[int, int, str]], until: int, wait: int) -> list[tuple[int, int]]:
        """Takes in the events in order, and time up to `until`; returns when items are given out, and the how manieth each is."""
        out = []
        for at, _, kind in [*sorted(events), (until, 0, "")]:
            if (due := self.due(wait)) is not None and due <= at:
                out.append((self.give(due), self.tries))
            if kind == DONE:
                self.done = True
            elif kind == FAILED and not self.done:
                self.open, self.failed_at = False, at
            elif kind == WEAK and not self.done and not self.open and self.failed_at is None:
                out.append((self.give(at), self.tries))
        self.until = max(self.until, until)
        return out


def queue(events: DataFrame, back_off: str = "6 hours", late: str = "1 hour") -> DataFrame:
    """id, reason, at, tries: the items given out. events: a stream of event_id, id, reason, kind, ts."""
    wait = int(pd.Timedelta(back_off).total_seconds() * 1_000_000)
    kinds = {"id": events.schema["id"].dataType.simpleString(), "reason": events.schema["reason"].dataType.simpleString()}
    events = events.filter(F.col("ts").isNotNull() & F.col("kind").isin(WEAK, FAILED, DONE)).select("event_id", "id", "reason", "kind", F.col("ts").cast("timestamp").alias("ts")).withWatermark("ts", late).withColumn("micros", F.unix_micros("ts"))

    def run(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        standing, waiting = Standing(), {}
        if state.exists:
            *facts, at, event, kind = state.get
            standing = Standing(*facts)
            waiting = {e: (a, e, k) for a, e, k in zip(at, event, kind, strict=True)}
        for some in chunks:
            for a, e, k in zip(some.micros.tolist(), some.event_id.tolist(), some.kind.tolist(), strict=True):
                waiting.setdefault(e, (a, e, k))
        mark = state.getCurrentWatermarkMs() * 1000
        ready = [x for x in waiting.values() if standing.until < x[0] <= mark]
        out = standing.advance(ready, mark, wait) if mark > standing.until else []
        kept = [x for x in waiting.values() if x[0] > mark]
        state.update((standing.open, standing.done, standing.failed_at, standing.tries, standing.until, [x[0] for x in kept], [x[1] for x in kept], [x[2] for x in kept]))
        times = [x[0] for x in kept] + ([standing.due(wait)] if standing.due(wait) is not None else [])
        if times:
            state.setTimeoutTimestamp(max(min(times) // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        if out:
            yield pd.DataFrame({"id": [key[0]] * len(out), "reason": [key[1]] * len(out), "at": [a for a, _ in out], "tries": [n for _, n in out]})

    items = events.groupBy("id", "reason").applyInPandasWithState(run, f"id {kinds['id']}, reason {kinds['reason']}, {ITEMS}", STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return items.withColumn("at", F.timestamp_micros("at"))


def gathered(actions: DataFrame, db: Database, name: str, checkpoint: str) -> StreamingQuery:
    """Adds the ids of pending actions (type, id, at) to the table `pending` of a database, each id of a type once.

    The number of the last batch changes with the table, so a batch that runs again adds nothing.
    """
    def batch(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        change = db.change()
        if "batches" not in change.state:
            change.create("pending", rows.filter("false").select("type", "id", "at"), ["type", "id"], buckets=16)
            change.create("batches", spark.createDataFrame([], "name string, number long"), ["name"], buckets=1)
        if change.table("batches").filter((F.col("name") == name) & (F.col("number") >= number)).count():
            return
        change.insert_new("pending", rows.withColumn("first", -F.unix_micros("at")), "first")
        change.upsert("batches", spark.createDataFrame([(name, number)], "name string, number long")).commit()

    return actions.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(batch).start()


def run_once(stream: DataFrame, folder: str) -> DataFrame:
    """Runs what a stream has now into folder/items and returns all of its items; a later call goes on from the checkpoint."""
    spark: SparkSession = stream.sparkSession
    writer = stream.writeStream.format("parquet").option("path", f"{folder}/items").option("checkpointLocation", f"{folder}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/items")
