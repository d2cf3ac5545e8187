"""Incremental workers: the job state kept up by a stream of events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def event_stream(spark: SparkSession, folder: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).parquet(folder)


def windowed_counts(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "event_type", "n")


def keep_state(events: DataFrame, table_folder: str, checkpoint: str) -> StreamingQuery:
    """Appends each batch's new keys and events once: a batch that runs again overwrites its own part."""
    def batch(df: DataFrame, epoch: int) -> None:
        df.write.mode("overwrite").parquet(f"{table_folder}/batch={epoch}")

    return events.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(batch).start()
