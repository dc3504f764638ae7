"""Decoding of raw messages (bytes of a JSON object) into Bronze rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plexus.schemas import EVENT


def parse_messages(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """CAST(value AS STRING) -> from_json with the fixed schema -> flatten.

    Malformed JSON, JSON arrays and null values give an all-null row (they are
    not dropped here; Silver removes them). Missing fields are null, extra
    fields are ignored.
    """
    text = F.col(value_col).cast("string")
    return messages.select(F.from_json(text, EVENT).alias("data")).select("data.*")


def to_messages(bronze: DataFrame) -> DataFrame:
    """Inverse helper: encode Bronze rows as JSON message values (for fixtures and replays)."""
    return bronze.select(F.to_json(F.struct(*[F.col(c) for c in EVENT.fieldNames()]))
                         .cast("binary").alias("value"))
