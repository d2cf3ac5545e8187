"""The queue of a worker, from the stream of all `events`."""

from __future__ import annotations

from pyspark.sql import functions as F

from docloom.plans.registry import Registry
from docloom.sources.readers import table
from docloom.sources.store import new_name, shared_folder
from docloom.streaming import retries

here = Registry()
query = here.query


def as_work(events):
    kind = F.when(F.col("event_type") == "error", retries.FAILED).when(F.col("event_type") == "purchase", retries.DONE).otherwise(retries.WEAK)
    return events.select("event_id", F.col("user_id").alias("id"), F.lit("repair").alias("reason"), kind.alias("kind"), "ts")


@query()
def worker_queue(spark, d):
    """Users given to a worker: at first sight, and again six hours after an error, until a purchase."""
    events = spark.readStream.schema(table(spark, d, "events").schema).parquet(f"{d}/events.parque[t]")  # a pattern, as the table is a file or a folder
    return retries.run_once(retries.queue(as_work(events)), f"{shared_folder(spark)}/{new_name('queue')}")
