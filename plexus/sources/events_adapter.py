"""Adapter from the driver's ``events`` table to Bronze-shaped interaction rows.

``events(event_id, ts, user_id, event_type, value, props)`` becomes
``(user_from, user_to, action, timestamp)`` strings, exactly what the upstream
message source delivers, so the real Silver code runs on it unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plexus.schemas import TIME_FORMAT

# How event types map onto interaction actions. Mixed case on
# purpose (Silver upper-cases); unmapped types pass through unchanged.
ACTION_OF_EVENT_TYPE = {"click": "like", "purchase": "Share", "view": "comment"}


def events_path(sf_dir: str) -> str:
    return f"{sf_dir.rstrip('/')}/events.parquet"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(events_path(sf_dir))


def events_to_bronze(events: DataFrame) -> DataFrame:
    """Project the events table into the four raw message strings (column-pruned scan)."""
    action = F.col("event_type")
    for src, dst in ACTION_OF_EVENT_TYPE.items():
        action = F.when(F.col("event_type") == src, F.lit(dst)).otherwise(action)
    target = F.from_json(F.col("props"), "k BIGINT").getField("k")
    return events.select(
        F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("user_from"),
        F.concat(F.lit("user"), target.cast("string")).alias("user_to"),
        action.alias("action"),
        F.date_format(F.col("ts"), TIME_FORMAT).alias("timestamp"),
    )


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze view of the driver tables."""
    return events_to_bronze(read_events(spark, sf_dir))


# DuckDB text of the same adapter, used by the oracle queries.
BRONZE_SQL = """
SELECT 'user' || CAST(user_id AS VARCHAR) AS user_from,
       'user' || CAST(CAST(json_extract(props, '$.k') AS BIGINT) AS VARCHAR) AS user_to,
       CASE event_type WHEN 'click' THEN 'like' WHEN 'purchase' THEN 'Share'
                       WHEN 'view' THEN 'comment' ELSE event_type END AS action,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS "timestamp"
FROM events
"""
