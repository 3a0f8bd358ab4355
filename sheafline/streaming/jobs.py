"""Structured Streaming jobs: event-time windows with a watermark, and first claims with keyed state.

State and output live in the shared folder; a job that is started again on the same folder goes on where it stopped.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from sheafline.session import shared_dir

WINDOW, LATENESS = "6 hours", "90 days"
#: How long the claim of a key without new events is held.
HELD_MS = 90 * 86_400_000


def with_time(events: DataFrame) -> DataFrame:
    """The event time as a timestamp in UTC; a watermark needs it so."""
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def windowed(events: DataFrame, width: str = WINDOW) -> DataFrame:
    by = events.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("events"), F.sum("value").alias("value"))
    return by.select(F.col("w.start").alias("window_start"), "event_type", "events", "value")


def source(spark: SparkSession, path: str, files_per_batch: int = 16) -> DataFrame:
    """A stream over the files at ``path`` (a folder of part files, or one file)."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path if not path.endswith(".parquet") else f"{path}*")


def run(stream: DataFrame, mode: str, label: str, folder: str | None = None) -> DataFrame:
    """Runs a stream until all that is there is read, and gives the table it wrote.

    Each batch is written under its own number, replacing an earlier try: a batch that is repeated after a failure does not double.
    """
    spark = stream.sparkSession
    base = folder or f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out/batch={number}")

    query = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/checkpoint").foreachBatch(write).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.option("basePath", f"{base}/out").schema(stream.schema.add("batch", "long")).parquet(f"{base}/out")


def run_windowed(spark: SparkSession, path: str, folder: str | None = None) -> DataFrame:
    """Windows of all events, updated batch by batch; the last update of a window holds."""
    stream = windowed(with_time(source(spark, path)).withWatermark("ts", LATENESS))
    out = run(stream, "update", "windows", folder)
    return out.groupBy("window_start", "event_type").agg(F.max_by("events", "batch").alias("events"), F.max_by("value", "batch").alias("value"))


def run_first_claims(spark: SparkSession, path: str, folder: str | None = None) -> DataFrame:
    """(user_id, event_type, event_id): the smallest event id of each key, kept in state; a key emits when its claim changes.

    The state of a key goes ``HELD_MS`` after its last event, in event time. A later event of the key then emits again; the table that is read back keeps the smallest, so
    nothing is lost by it. Events without a time column ``ts`` have no clock to go by: their state stays.
    """
    events = source(spark, path)
    timed = "ts" in events.columns

    def claim(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        held = state.get[0] if state.exists else None
        rows = [(int(b["event_id"].min()), b["ts"].max().timestamp() * 1000 if timed else 0) for b in batches]
        least, last = min(r[0] for r in rows), max(r[1] for r in rows)
        if held is None or least < held:
            state.update((least,))
        if timed:
            state.setTimeoutTimestamp(int(max(last, state.getCurrentWatermarkMs())) + HELD_MS)
        if held is None or least < held:
            yield pd.DataFrame({"user_id": [key[0]], "event_type": [key[1]], "event_id": [least]})

    events = with_time(events).select("user_id", "event_type", "event_id", "ts").withWatermark("ts", LATENESS) if timed else events.select("user_id", "event_type", "event_id")
    types = dict(events.dtypes)
    stream = events.groupBy("user_id", "event_type").applyInPandasWithState(claim, f"user_id {types['user_id']}, event_type string, event_id long", "held long", "update", GroupStateTimeout.EventTimeTimeout if timed else GroupStateTimeout.NoTimeout)
    out = run(stream, "update", "claims", folder)
    return out.groupBy("user_id", "event_type").agg(F.min("event_id").alias("event_id"))
