"""Column-level helpers shared by the layers and the dashboard queries (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plexus.schemas import TIME_CANDIDATES, TIME_FORMAT


def parse_time(c: Column, fmt: str | None = TIME_FORMAT) -> Column:
    """Text -> timestamp that yields null on bad input instead of raising under ANSI."""
    if fmt is None:
        return F.try_to_timestamp(c)
    return F.try_to_timestamp(c, F.lit(fmt))


def strip_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def resolve_time_column(df: DataFrame, candidates: list[str] | None = None,
                        fmt: str | None = None) -> DataFrame:
    """Pick the first present of the candidate time columns, expose it as a
    ``timestamp`` column of type timestamp and drop rows that do not parse."""
    df = strip_column_names(df)
    candidates = candidates or TIME_CANDIDATES
    found = next((c for c in candidates if c in df.columns), None)
    if found is None:
        raise ValueError(f"no time column among {candidates}; columns are {df.columns}")
    src = F.col(found)
    ts = src if dict(df.dtypes)[found] in ("timestamp", "timestamp_ntz") else parse_time(src.cast("string"), fmt)
    return df.withColumn("timestamp", ts).where(F.col("timestamp").isNotNull())


def calendar_columns(df: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """``date``, ``hour`` (int), ``day_name`` (English, full) and ``weekday`` (Mon=0)."""
    ts = F.col(ts_col)
    return df.select(
        "*",
        F.to_date(ts).alias("date"),
        F.hour(ts).alias("hour"),
        F.date_format(ts, "EEEE").alias("day_name"),
        ((F.dayofweek(ts) + 5) % 7).alias("weekday"),
    )


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den, 0 when den is 0 or null."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))
