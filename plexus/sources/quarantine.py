"""Rows that do not fit go to a table of their own, with the reason and where they came from.

Good rows load as they always did; nothing is lost and nothing stops the load.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plexus.schemas import EDGE, EVENT
from plexus.session import materialize
from plexus.sources.tables import CSV, require_csv

CORRUPT = "_corrupt"
REJECT = "source string, reason string, raw string"


def _marked(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])


def checked_messages(messages: DataFrame, value_col: str = "value", source: Column | None = None) -> DataFrame:
    """The event fields, ``raw`` (the message as text), ``reason`` (null for a good message) and ``source``.

    Bad are a null message, text that is no JSON object (cut, an array, a number, empty), and an
    object without any of the four fields."""
    text = F.col(value_col).cast("string")
    rows = messages.select(
        text.alias("raw"), (source if source is not None else F.lit(None).cast("string")).alias("source"),
        F.from_json(text, _marked(EVENT), {"columnNameOfCorruptRecord": CORRUPT}).alias("m"))
    fields = [F.col(f"m.{f}").isNull() for f in EVENT.fieldNames()]
    empty = fields[0] & fields[1] & fields[2] & fields[3]
    is_object = F.col("raw").rlike(r"^\s*\{") & F.col(f"m.{CORRUPT}").isNull() & F.col("m").isNotNull()
    reason = F.when(F.col("raw").isNull(), "null message").when(~is_object, "not a JSON object").when(empty, "no known field")
    good = reason.isNull()
    return rows.select(*[F.when(good, F.col(f"m.{f}")).alias(f) for f in EVENT.fieldNames()], "raw", reason.alias("reason"), "source")


def good_messages(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("reason").isNull()).select(*EVENT.fieldNames())


def rejects(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("reason").isNotNull()).select("source", "reason", "raw")


def checked_batch_writer(path: str, rejects_path: str, fmt: str = "parquet"):
    """foreachBatch sink of ``checked_messages``: each micro-batch replaces its own folder in both tables,
    so a replayed batch is there once. The batch is parsed once and kept for the two writes."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            good_messages(batch).write.format(fmt).mode("overwrite").save(f"{path.rstrip('/')}/batch_id={batch_id}")
            rejects(batch).write.format(fmt).mode("overwrite").save(f"{rejects_path.rstrip('/')}/batch_id={batch_id}")
        finally:
            batch.unpersist()
    return write


def read_rejects(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).schema(REJECT).load(f"{path.rstrip('/')}/batch_id=*")


def read_edges_csv_checked(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(good edges, rejects) of a Gold CSV folder. A row is bad if it has too few or too many
    fields or a value that is not of its column's type; its text is kept whole. The files are read
    once, as a reader that is asked for fewer columns would check fewer."""
    require_csv(spark, path)
    rows = spark.read.schema(_marked(EDGE)).options(
        **CSV, multiLine="true", mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT).csv(path)
    rows = materialize(rows.select("*", F.col("_metadata.file_path").alias("source")), "checked-csv")
    bad = F.col(CORRUPT).isNotNull()
    return (rows.where(~bad).select(*EDGE.fieldNames()),
            rows.where(bad).select("source", F.lit("does not fit the schema").alias("reason"), F.col(CORRUPT).alias("raw")))
