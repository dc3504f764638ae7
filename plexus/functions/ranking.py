"""Distributed ranking helpers: per-group top-k and global average ranks, both
without funnelling a whole group (or the whole table) into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plexus.session import checkpoint


def top_k_per_group(df: DataFrame, group: str, order: list[Column], k: int, salt: int = 32,
                    rank_col: str = "rank") -> DataFrame:
    """Top ``k`` rows of every group by ``order`` (a total order), as rank 1..k.

    Two phases: first the top k inside (group, hash-salt) sub-groups, so a group
    holding a third of the table is cut across ``salt`` tasks; then the top k
    of the at most k*salt survivors per group.
    """
    tie = F.xxhash64(*df.columns) % salt
    w1 = Window.partitionBy(group, "_salt").orderBy(*order)
    pre = (df.withColumn("_salt", tie).withColumn("_r", F.row_number().over(w1))
           .where(F.col("_r") <= k).drop("_r", "_salt"))
    w2 = Window.partitionBy(group).orderBy(*order)
    return pre.withColumn(rank_col, F.row_number().over(w2)).where(F.col(rank_col) <= k)


def average_rank_desc(df: DataFrame, value: str, out: str = "rank") -> DataFrame:
    """Rank by ``value`` descending where tied rows share the average of their
    positions, truncated to an integer (1-based). Nulls rank last.

    Counts are aggregated per distinct value, the distinct values are
    range-partitioned in descending order, and the running count is a
    per-partition cumulative sum plus a per-partition offset (one row per
    partition, so the offset table has a proven bound and is broadcast).
    """
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("_c"))
    order = F.col(value).desc_nulls_last()
    parts = checkpoint(counts.repartitionByRange(order)
                       .select(value, "_c", F.spark_partition_id().alias("_pid")))
    inside = Window.partitionBy("_pid").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    before = parts.withColumn("_before", F.coalesce(F.sum("_c").over(inside), F.lit(0)))
    totals = parts.groupBy("_pid").agg(F.sum("_c").alias("_n"))
    prior = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", F.coalesce(F.sum("_n").over(prior), F.lit(0)).alias("_off"))
    ranked = (before.join(F.broadcast(offsets), "_pid")
              .select(value, F.floor(F.col("_off") + F.col("_before") + 1 + (F.col("_c") - 1) / 2.0)
                      .cast("long").alias(out)))
    return df.join(ranked, df[value].eqNullSafe(ranked[value]), "left").drop(ranked[value])
