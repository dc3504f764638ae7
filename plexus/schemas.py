"""Declared schemas of every stored layer (no inference anywhere)."""

from pyspark.sql import types as T

# Raw message as produced upstream: four nullable strings.
EVENT = T.StructType([
    T.StructField("user_from", T.StringType(), True),
    T.StructField("user_to", T.StringType(), True),
    T.StructField("action", T.StringType(), True),
    T.StructField("timestamp", T.StringType(), True),
])

# Cleaned events: the raw strings plus the parsed instant and two text parts of it.
SILVER = T.StructType(EVENT.fields + [
    T.StructField("event_time", T.TimestampType(), True),
    T.StructField("event_date", T.StringType(), True),
    T.StructField("event_hour", T.StringType(), True),
])

# Curated edge list, one row per interaction (parallel edges kept).
EDGE = T.StructType([
    T.StructField("user_from", T.StringType(), True),
    T.StructField("user_to", T.StringType(), True),
    T.StructField("action", T.StringType(), True),
    T.StructField("event_time", T.TimestampType(), True),
    T.StructField("event_date", T.StringType(), True),
    T.StructField("event_hour", T.StringType(), True),
])

# Per-user graph metrics.
METRICS = T.StructType([
    T.StructField("user", T.StringType(), True),
    T.StructField("pagerank", T.DoubleType(), True),
    T.StructField("betweenness", T.DoubleType(), True),
    T.StructField("community_louvain", T.LongType(), True),
])

# Fixed values of the data model.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
ISO_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"
TIME_CANDIDATES = ["timestamp", "event_time", "eventTime", "event_time_utc"]
METRIC_DEFAULTS = {"pagerank": 0.0, "betweenness": 0.0, "community_louvain": -1}
