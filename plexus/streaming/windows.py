"""Event-time windows on the stream: counts by tumbling, sliding and session windows,
and daily active users, with a watermark and state in the state store.

A window is closed, and appended to the sink once, when the watermark (the newest
event time less ``lateness``) has passed its end; a row all of whose windows are closed is late
and is dropped. Closed windows hold what the batch gives on the rows that were not
late. Windows still open are read from the state store, so a dashboard sees both.
A restart goes on with the state and the watermark of the checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plexus.streaming.bronze import bronze_stream, message_stream
from plexus.streaming.silver import LATENESS, timed

TIME = "event_time"


def counts(events: DataFrame, window: Column, lateness: str = LATENESS, keys: tuple[str, ...] = ("action",)) -> DataFrame:
    """window_start, window_end, the keys, events: rows of each window and key. ``window`` is
    ``F.window(TIME, size)``, ``F.window(TIME, size, slide)`` or ``F.session_window(TIME, gap)``."""
    grouped = events.withWatermark(TIME, lateness).groupBy(window.alias("w"), *keys).agg(F.count(F.lit(1)).alias("events"))
    return grouped.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "events")


def active_users(events: DataFrame, size: str = "1 day", lateness: str = LATENESS) -> DataFrame:
    """window_start, window_end, interactions, active_users: first by window and user, then by window
    (a stream has no distinct count; the state is a row a user of the open windows)."""
    users = events.withWatermark(TIME, lateness).groupBy(F.window(TIME, size).alias("w"), "user_from").agg(
        F.count("action").alias("interactions"))
    days = users.groupBy(F.window("w", size).alias("d")).agg(
        F.sum("interactions").alias("interactions"), F.count(F.lit(1)).alias("active_users"))
    return days.select(F.col("d.start").alias("window_start"), F.col("d.end").alias("window_end"), "interactions", "active_users")


def start_windows(spark: SparkSession, aggregate: Callable[[DataFrame], DataFrame], source_path: str, sink_path: str,
                  checkpoint_path: str, source_format: str = "text", source_options: dict[str, str] | None = None,
                  available_now: bool = False) -> StreamingQuery:
    """Start the query messages -> valid rows -> ``aggregate`` -> closed windows, appended to a Parquet table."""
    rows = aggregate(timed(bronze_stream(message_stream(spark, source_format, source_path, source_options))))
    w = rows.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint_path)
    return (w.trigger(availableNow=True) if available_now else w).start(sink_path)


def open_windows(spark: SparkSession, checkpoint_path: str, keys: tuple[str, ...] = ("action",)) -> DataFrame:
    """The windows of ``counts`` (tumbling or sliding) that are not closed yet, from the last committed state."""
    state = spark.read.format("statestore").load(checkpoint_path)
    w = state.schema["key"].dataType.fieldNames()[0]
    return state.select(F.col(f"key.{w}.start").alias("window_start"), F.col(f"key.{w}.end").alias("window_end"),
                        *[F.col(f"key.{k}").alias(k) for k in keys], F.col("value.count").alias("events"))


def live_windows(spark: SparkSession, sink_path: str, checkpoint_path: str, keys: tuple[str, ...] = ("action",)) -> DataFrame:
    """Closed and open windows, told apart by ``closed``."""
    closed = spark.read.parquet(sink_path).withColumn("closed", F.lit(True))
    return closed.unionByName(open_windows(spark, checkpoint_path, keys).withColumn("closed", F.lit(False)))
