"""Job state from an append-only event log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_state(events: DataFrame) -> DataFrame:
    """user_id, status, updated_at, retry_count: the last event of each key, and how often it failed."""
    last = F.max(F.struct("ts", "event_id", "event_type")).alias("last")
    return events.groupBy("user_id").agg(last, F.count_if(F.col("event_type") == "error").alias("retry_count")).select("user_id", F.col("last.event_type").alias("status"), F.col("last.ts").alias("updated_at"), "retry_count")


def recent_failures(events: DataFrame, back_off: str = "INTERVAL 6 HOURS") -> DataFrame:
    """Keys that failed within the back-off before the log's last event."""
    end = events.agg(F.max("ts").alias("end"))
    return events.filter("event_type = 'error'").crossJoin(F.broadcast(end)).filter(F.expr(f"ts >= end - {back_off}")).groupBy("user_id").agg(F.count("*").alias("n_errors"), F.max("ts").alias("last_error"))


def pending(events: DataFrame) -> DataFrame:
    """Keys that are neither done nor failed."""
    done = events.filter("event_type in ('purchase', 'error')").select("user_id").distinct()
    return events.select("user_id").distinct().join(done, "user_id", "left_anti")
