"""Token ids in binary files: range-ordered, entropy-coded, checksummed.

``write_tokens`` lays documents out in ascending ``doc_id`` over range partitions,
turns them into ids with an end id after each, and writes records. A record holds
whole documents up to about GROUP ids: their ids and lengths, and the blocks of
``mixcoder`` with the size and crc32 of each. Records are rows of a Parquet table
(part, record, doc_ids, lengths, count, sizes, crcs, payload), so Spark commits
them, splits them and prunes the payload when only positions are asked for.
``read_tokens`` decodes the records and gives every document its global start.

Scale: one range shuffle; a record is the unit of work in both directions, its
memory bounded by GROUP ids and the longest single document. Starts are prefix
sums over per-record counts inside a partition and over one row per partition.

Edge cases: null and empty texts are one end id; repeated rows and equal or null
doc_ids are kept one by one; an empty table writes no record; a damaged block
raises; other columns are never read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plexus.llm import mixcoder
from plexus.llm.common import small_side
from plexus.llm.tokens import chunks, encoder, id_runs

GROUP = 1 << 23

RECORD = ("part int, record int, doc_ids array<long>, lengths array<int>, count long, "
          "sizes array<int>, crcs array<long>, payload binary")


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    def run(batches):
        part, enc = TaskContext.get().partitionId(), encoder(tokenizer)
        number, doc_ids, ids, sizes = 0, [], [], []

        def record() -> pa.RecordBatch:
            flat = np.concatenate(ids)
            payload, words, crcs = mixcoder.encode(flat)
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "record": pa.array([number], pa.int32()),
                "doc_ids": pa.array([doc_ids], pa.list_(pa.int64())),
                "lengths": pa.array([np.concatenate(sizes)], pa.list_(pa.int32())),
                "count": pa.array([len(flat)], pa.int64()),
                "sizes": pa.array([words], pa.list_(pa.int32())), "crcs": pa.array([crcs], pa.list_(pa.int64())),
                "payload": pa.array([payload], pa.binary())})

        for some, texts in chunks(batches, 0, 1):
            flat, n, *_ = enc.encode(texts)
            doc_ids += some
            ids.append(np.insert(flat, np.cumsum(n), end_id))
            sizes.append(n + 1)
            if sum(map(len, ids)) >= GROUP:
                yield record()
                number, doc_ids, ids, sizes = number + 1, [], [], []
        if doc_ids:
            yield record()

    # equal or missing ids are told apart by their texts, so that no id fills one task
    ordered = (docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"),
                           F.xxhash64(docs["text"]).alias("h"))
               .repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text"))
    ordered.mapInArrow(run, RECORD).write.mode("overwrite").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids (little-endian unsigned 32-bit) of every document."""
    records = spark.read.schema(RECORD).parquet(path)
    counts = records.select("part", "record", "count")
    parts = counts.groupBy("part").agg(F.sum("count").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("record").rowsBetween(Window.unboundedPreceding, -1)
    starts = (counts.join(parts, "part").select(
        "part", "record",
        (F.col("part_start") + F.coalesce(F.sum("count").over(inside), F.lit(0))).alias("first")))

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                ids = mixcoder.decode(r["payload"], np.array(r["sizes"]), r["crcs"], r["count"])
                n = np.array(r["lengths"], np.int64)
                ends = np.cumsum(n)
                at = ends - n
                for k in range(0, len(n), 4096):
                    s = slice(k, k + 4096)
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(r["doc_ids"][s], pa.int64()),
                        "start": pa.array(at[s] + r["first"], pa.int64()),
                        "n_tokens": pa.array(n[s], pa.int64()),
                        "ids": id_runs(ids, np.concatenate([at[s][:1], ends[s]]))})

    joined = records.join(small_side(starts, "token-starts"), ["part", "record"])
    return joined.select("doc_ids", "lengths", "count", "sizes", "crcs", "payload", "first").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids binary")
