"""Streaming Silver: cleaning and duplicate removal with expiring state.

The stream gives what the batch ``operators.silver.clean`` gives on the same rows, as long
as no row is later than ``lateness`` behind the newest event time. The event time is part
of the duplicate key, so a repeat that comes after its key has left the state is
itself behind the watermark and is dropped there: no repeat passes at any delay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plexus.functions.columns import parse_time
from plexus.operators.silver import DEDUP_KEYS
from plexus.schemas import SILVER
from plexus.streaming.bronze import bronze_stream, message_stream

LATENESS = "1 day"


def timed(bronze: DataFrame) -> DataFrame:
    """Bronze rows without nulls and with an ``event_time`` that parses; others go, as in the batch."""
    rows = bronze
    for name in DEDUP_KEYS:
        rows = rows.where(F.col(name).isNotNull())
    return rows.withColumn("event_time", parse_time(F.col("timestamp"))).where(F.col("event_time").isNotNull())


def silver_stream(bronze: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """The Silver columns of a stream of Bronze rows, each different row once."""
    once = timed(bronze).withWatermark("event_time", lateness).dropDuplicatesWithinWatermark(DEDUP_KEYS)
    at = F.col("event_time")
    return once.select("user_from", "user_to", F.upper("action").alias("action"), "timestamp", "event_time",
                       F.date_format(at, "yyyy-MM-dd").alias("event_date"), F.date_format(at, "HH").alias("event_hour"))


def start_silver(spark: SparkSession, source_path: str, sink_path: str, checkpoint_path: str, lateness: str = LATENESS,
                 source_format: str = "text", source_options: dict[str, str] | None = None,
                 available_now: bool = False) -> StreamingQuery:
    """Start the query messages -> Silver, appending to a Parquet table partitioned by ``event_date``."""
    rows = silver_stream(bronze_stream(message_stream(spark, source_format, source_path, source_options)), lateness)
    w = rows.writeStream.outputMode("append").format("parquet").partitionBy("event_date").option(
        "checkpointLocation", checkpoint_path)
    return (w.trigger(availableNow=True) if available_now else w).start(sink_path)


def read_silver(spark: SparkSession, sink_path: str) -> DataFrame:
    return spark.read.schema(SILVER).parquet(sink_path).select(*SILVER.fieldNames())


def state_rows(query: StreamingQuery) -> list[int]:
    """Rows in the state store after each of the query's recent batches."""
    return [sum(s["numRowsTotal"] for s in p["stateOperators"]) for p in query.recentProgress if p["stateOperators"]]
