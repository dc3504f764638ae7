"""Silver -> Gold edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame

EDGE_COLUMNS = ["user_from", "user_to", "action", "event_time", "event_date", "event_hour"]


def edges(silver: DataFrame) -> DataFrame:
    """Six-column edge projection (drops the raw ``timestamp`` text)."""
    return silver.select(*EDGE_COLUMNS)
