"""Compaction of a stream's many small files, while the stream goes on appending.

The stream writes each micro-batch to ``data/batch_id=N``. Batches that its checkpoint has
committed are closed: they cannot be written again. Neighbouring closed batches are packed into
bins of at most ``target`` bytes and each bin is written as one file. A manifest, a
new version of it a run, names the folders that took the place of the batches up to
``upto``; readers take the newest manifest's folders and the batches after it, so a row is
read once at any moment. What a manifest replaced is deleted by the run after the
next manifest, when no reader of the older one is left.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from plexus.session import delete_path, folders, last_commit, written_bytes

TARGET = 128 << 20
MANIFEST = "folders array<string>, replaced array<string>, upto long"


def data_path(root: str) -> str:
    """Where the stream's batch writer puts its folders."""
    return f"{root.rstrip('/')}/data"


def _manifest(spark: SparkSession, root: str) -> tuple[int, list[str], list[str], int]:
    """(version, folders, replaced, upto) of the newest manifest."""
    versions = folders(spark, f"{root.rstrip('/')}/manifests", "v")
    if not versions:
        return 0, [], [], -1
    row = spark.read.schema(MANIFEST).json(f"{root.rstrip('/')}/manifests/v={versions[-1]}").first()
    return versions[-1], list(row.folders), list(row.replaced), row.upto


def live_folders(spark: SparkSession, root: str) -> list[str]:
    _, packed, _, upto = _manifest(spark, root)
    return packed + [f"batch_id={n}" for n in folders(spark, data_path(root), "batch_id") if n > upto]


def read_batches(spark: SparkSession, root: str, schema) -> DataFrame:
    """All rows of the table, closed and fresh."""
    live = [f"{data_path(root)}/{f}" for f in live_folders(spark, root)]
    return spark.read.schema(schema).parquet(*live) if live else spark.createDataFrame([], schema)


def bins(sizes: list[tuple[str, int]], target: int) -> list[list[str]]:
    """Neighbouring folders in bins of at most ``target`` bytes; a larger folder has a bin of its own."""
    out: list[list[str]] = []
    room = -1
    for name, size in sizes:
        if size > room:
            out.append([])
            room = target
        out[-1].append(name)
        room -= size
    return out


def compact(spark: SparkSession, root: str, checkpoint: str, schema, target: int = TARGET) -> int:
    """Pack the closed batches (and bins of earlier runs) once; returns the number of live folders.
    A task a bin, many at once: it copies the rows as it reads them, without a shuffle or a sort, so its
    memory does not grow with the bin."""
    root = root.rstrip("/")
    version, packed, replaced, upto = _manifest(spark, root)
    closed = [n for n in folders(spark, data_path(root), "batch_id") if upto < n <= last_commit(spark, checkpoint)]
    if not closed:
        return len(live_folders(spark, root))
    sizes = [(f, written_bytes(spark, f"{data_path(root)}/{f}")) for f in [*packed, *(f"batch_id={n}" for n in closed)]]
    todo = bins(sizes, target)
    kept = [b[0] for b in todo if len(b) == 1]
    merged = [b for b in todo if len(b) > 1]
    new = f"packed={version + 1}"
    if merged:
        delete_path(spark, f"{data_path(root)}/{new}")  # of a run that did not come to its manifest

        def pack(k: int) -> None:
            rows = spark.read.schema(schema).parquet(*[f"{data_path(root)}/{f}" for f in merged[k]])
            rows.coalesce(1).write.mode("overwrite").parquet(f"{data_path(root)}/{new}/bin={k}")

        with ThreadPoolExecutor(max(1, min(len(merged), spark.sparkContext.defaultParallelism))) as pool:
            list(pool.map(pack, range(len(merged))))
    order = kept + [f"{new}/bin={k}" for k in range(len(merged))]
    spark.createDataFrame([(order, [f for b in merged for f in b], max(closed))], MANIFEST).coalesce(1).write.mode(
        "overwrite").json(f"{root}/manifests/v={version + 1}")
    for f in replaced:
        delete_path(spark, f"{data_path(root)}/{f}")
    return len(live_folders(spark, root))
