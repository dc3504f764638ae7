"""Bronze stream: file message source -> parse -> parquet append with checkpoint."""

import os

import pytest
from pyspark.sql import functions as F

from plexus.session import scratch_path
from plexus.streaming.bronze import run_bronze_stream, write_message_files


def _bronze_of(spark, golden_edges):
    return golden_edges.select("user_from", "user_to", "action",
                               F.date_format("event_time", "yyyy-MM-dd HH:mm:ss").alias("timestamp"))


def test_stream_equals_batch_and_restart_appends_only_new(spark, golden_edges):
    bronze = _bronze_of(spark, golden_edges)
    root = scratch_path(spark, "test-stream")
    src, sink, ck = f"{root}/in", f"{root}/out", f"{root}/ckpt"
    first = bronze.limit(30).cache()
    write_message_files(first, f"{src}/part1")
    out = run_bronze_stream(spark, f"{src}/*", sink, ck)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, first.collect()))
    rest = bronze.subtract(first)
    write_message_files(rest, f"{src}/part2")
    out = run_bronze_stream(spark, f"{src}/*", sink, ck)   # restart from the checkpoint
    assert out.count() == bronze.count()
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, bronze.collect()))
    local_ck = ck[5:] if ck.startswith("file:") else ck
    assert os.path.isdir(os.path.join(local_ck, "commits"))


def test_empty_first_batch_creates_readable_table(spark):
    root = scratch_path(spark, "test-empty-stream")
    os.makedirs((root[5:] if root.startswith("file:") else root) + "/in", exist_ok=True)
    out = run_bronze_stream(spark, f"{root}/in", f"{root}/out", f"{root}/ckpt")
    assert out.count() == 0
    assert out.columns == ["user_from", "user_to", "action", "timestamp"]


def test_planned_but_uncommitted_batch_is_replayed_once_file_sink(spark, golden_edges):
    bronze = _bronze_of(spark, golden_edges)
    root = scratch_path(spark, "test-replay")
    src, sink, ck = f"{root}/in", f"{root}/out", f"{root}/ckpt"
    write_message_files(bronze, src)
    run_bronze_stream(spark, src, sink, ck)
    # the state of a driver that died after the sink's write: offset logged, commit missing
    commits = (ck[5:] if ck.startswith("file:") else ck) + "/commits"
    for f in os.listdir(commits):
        os.remove(f"{commits}/{f}")
    out = run_bronze_stream(spark, src, sink, ck)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, bronze.collect()))


def test_planned_but_uncommitted_batch_is_replayed_once_foreach_batch(spark, golden_edges):
    from plexus.streaming.bronze import idempotent_batch_writer, run_bronze_batches

    bronze = _bronze_of(spark, golden_edges)
    root = scratch_path(spark, "test-replay-batch")
    src, sink, ck = f"{root}/in", f"{root}/out", f"{root}/ckpt"
    write_message_files(bronze, src)
    write = idempotent_batch_writer(sink)

    def dies(batch, batch_id):
        write(batch, batch_id)
        raise RuntimeError("the sink fails before the commit")

    with pytest.raises(Exception, match="before the commit"):
        run_bronze_batches(spark, src, sink, ck, writer=dies)
    local = ck[5:] if ck.startswith("file:") else ck
    assert os.listdir(f"{local}/offsets") and not [f for f in os.listdir(f"{local}/commits") if not f.startswith(".")]
    out = run_bronze_batches(spark, src, sink, ck)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, bronze.collect()))
