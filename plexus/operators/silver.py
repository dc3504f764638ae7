"""Bronze -> Silver: dedup, normalise, type, validate, derive calendar text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexus.functions.columns import parse_time

DEDUP_KEYS = ["user_from", "user_to", "action", "timestamp"]


def clean(bronze: DataFrame, normalise_first: bool = False) -> DataFrame:
    """The Silver transformation.

    Rows with a null or an unparseable time go first, so that the one shuffle (the
    dedup on the four raw strings, partially aggregated map-side) carries valid rows
    only; the typed columns are derived after it, once per surviving row. As the raw
    strings decide, ``like`` and ``LIKE`` at one instant both survive
    (``normalise_first=True`` flips that). Empty strings and unknown actions are kept.
    """
    action = F.upper("action") if normalise_first else F.col("action")
    valid = F.lit(True)
    for name in DEDUP_KEYS:
        valid = valid & F.col(name).isNotNull()
    rows = (bronze.where(valid & parse_time(F.col("timestamp")).isNotNull())
            .select("user_from", "user_to", action.alias("action"), "timestamp").distinct())
    at = parse_time(F.col("timestamp"))
    return rows.select("user_from", "user_to", F.upper("action").alias("action"), "timestamp", at.alias("event_time"),
                       F.date_format(at, "yyyy-MM-dd").alias("event_date"), F.date_format(at, "HH").alias("event_hour"))
