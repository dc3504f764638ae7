"""Batch table scan / overwrite and CSV exchange of the curated layers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plexus.schemas import EDGE, ISO_TIME_FORMAT, METRIC_DEFAULTS, METRICS
from plexus.session import switch_path


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    """Snapshot read of a stored layer; the table format is a parameter (parquet, delta, ...)."""
    reader = spark.read.format(fmt)
    if schema is not None and fmt not in ("delta",):
        reader = reader.schema(schema)
    return reader.load(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Full-refresh write (re-running is idempotent). The new table is written beside the
    old one and takes its place when it is complete, so a failed write leaves the old
    one as it was. Partitioning Silver by ``event_date`` lets date filters prune files.
    Formats with a transaction log (delta) overwrite in place."""
    w = df.write.format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "delta":
        w.mode("overwrite").save(path)
        return
    new = f"{path.rstrip('/')}__new-{uuid.uuid4().hex[:12]}"
    w.save(new)
    switch_path(df.sparkSession, new, path)


def refresh_partitions(df: DataFrame, path: str, partition_by: list[str], fmt: str = "parquet") -> None:
    """Replace only the partitions that ``df`` has rows of; the files of all others stay as they
    are. Repeating the call gives the same table. A partition that lost all its rows must
    be named by its new rows, so an empty ``df`` changes nothing."""
    df.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).save(path)


# Text tables keep every string as it is: all values quoted, quotes doubled by a
# backslash-free escape, blanks and line ends kept, null and empty told apart.
CSV = {"header": "true", "quoteAll": "true", "escape": '"', "nullValue": "\\N", "emptyValue": "",
       "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
       "timestampFormat": ISO_TIME_FORMAT}


def require_csv(spark: SparkSession, path: str) -> None:
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path)
    if not found.select("path").head(1):
        raise FileNotFoundError(f"no CSV file in {path}")


def write_edges_csv(edges: DataFrame, path: str) -> None:
    """Gold CSV sink with header, lossless for any user id but the null marker itself."""
    edges.write.mode("overwrite").options(**CSV).csv(path)


def write_lines_csv(lines: DataFrame, header: str, path: str) -> None:
    """CSV files from finished lines (one column), each file under its header."""
    lines.toDF(header).write.mode("overwrite").options(
        header="true", quote="\u0000", sep="\u0001", escapeQuotes="false", ignoreLeadingWhiteSpace="false",
        ignoreTrailingWhiteSpace="false").csv(path)


def read_edges_csv(spark: SparkSession, path: str) -> DataFrame:
    """Gold CSV source, declared schema (no inference pass over the data); a row that
    does not fit the schema is an error, and so is a folder without a CSV file."""
    require_csv(spark, path)
    return spark.read.schema(EDGE).options(**CSV, multiLine="true", mode="FAILFAST").csv(path)


def fill_metric_defaults(metrics: DataFrame) -> DataFrame:
    """Require ``user``; add absent metric columns with their defaults (0, 0, -1)."""
    cols = [c.strip() for c in metrics.columns]
    metrics = metrics.toDF(*cols)
    if "user" not in cols:
        raise ValueError(f"metrics need a 'user' column; found {cols}")
    types = {f.name: f.dataType for f in METRICS.fields}
    for name, default in METRIC_DEFAULTS.items():
        if name not in cols:
            metrics = metrics.withColumn(name, F.lit(default).cast(types[name]))
        else:
            metrics = metrics.withColumn(name, F.col(name).cast(types[name]))
    return metrics.select("user", *METRIC_DEFAULTS.keys(),
                          *[c for c in cols if c not in METRICS.fieldNames()])


def read_metrics_csv(spark: SparkSession, path: str) -> DataFrame:
    """Metrics CSV with header; the header decides which columns exist, so the
    string columns are read first and typed by ``fill_metric_defaults``."""
    require_csv(spark, path)
    raw = spark.read.options(**CSV, multiLine="true", inferSchema="false").csv(path)
    return fill_metric_defaults(raw)


def write_metrics_csv(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("overwrite").options(**CSV).csv(path)
