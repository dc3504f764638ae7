"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plexus.session import materialize, prepare, ship, written_bytes

# A word is a maximal run of characters other than ASCII white space.
ASCII_SPACE = r"[\x20\x09-\x0D]+"

# Bytes of a broadcast table in memory, and how much rows grow there next to their Parquet files.
BROADCAST_BYTES = 8 << 20
GROWTH = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, by any path Spark's readers can open."""
    prepare(spark)
    ship(spark)
    # long texts reach Python in small batches
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "256")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def col(df: DataFrame, name: str) -> Column:
    """A top-level column by its exact name, dots and all."""
    return df["`" + name.replace("`", "``") + "`"]


def let(value: Column, body) -> Column:
    """Bind an array or number once inside an expression.

    Catalyst copies a projected expression into the lambda that reads it, which
    would evaluate it once per element; a lambda variable is evaluated once."""
    return F.transform(F.array(value), body)[0]


def ascii_words(text: Column) -> Column:
    """All words of a text; null and empty texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), ASCII_SPACE), lambda w: w != F.lit(""))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def small_side(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and mark it for broadcast only while its files
    stay within BROADCAST_BYTES in memory; beyond that the join shuffles both sides."""
    out = materialize(df, name)
    files = out.inputFiles()
    size = written_bytes(df.sparkSession, files[0].rsplit("/", 1)[0]) if files else 0
    return F.broadcast(out) if size * GROWTH <= BROADCAST_BYTES else out


def crc_mod(col_: Column, n: int) -> Column:
    """crc32 of a value's text, modulo n (null stays null)."""
    return F.crc32(col_.cast("string").cast("binary")) % n


