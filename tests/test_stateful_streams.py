"""Streams with state: windows, duplicate removal, counters, compaction; restarts in between."""

import os

import pytest
from pyspark.sql import functions as F

from plexus.operators import silver
from plexus.schemas import EVENT
from plexus.session import folders, scratch_path, written_bytes
from plexus.streaming import compaction, counters, windows
from plexus.streaming import silver as silver_streaming
from plexus.streaming.bronze import idempotent_batch_writer, start_bronze, write_message_files

HOUR = "1 hour"


def local(path):
    return path[5:] if path.startswith("file:") else path


def events(spark, *rows):
    """(minute of 2025-01-01, user, action) as Bronze rows."""
    return spark.createDataFrame([(u, "x", a, f"2025-01-{1 + m // 1440:02d} {m // 60 % 24:02d}:{m % 60:02d}:00") for m, u, a in rows], EVENT)


class Run:
    """A windowed stream that is fed file by file and restarted each time."""

    def __init__(self, spark, aggregate):
        self.spark, self.aggregate, self.n = spark, aggregate, 0
        root = scratch_path(spark, "test-windows")
        self.src, self.sink, self.ckpt = f"{root}/in", f"{root}/out", f"{root}/ckpt"

    def feed(self, *rows):
        write_message_files(events(self.spark, *rows), f"{self.src}/p{self.n}")
        self.n += 1
        q = windows.start_windows(self.spark, self.aggregate, f"{self.src}/*", self.sink, self.ckpt, available_now=True)
        q.awaitTermination()
        return q

    def closed(self):
        return sorted(((r.window_start.hour, r.window_end.hour, *r[2:])) for r in self.spark.read.parquet(self.sink).collect())


def test_restart_keeps_windows_and_watermark(spark):
    run = Run(spark, lambda e: windows.counts(e, F.window(windows.TIME, HOUR), "30 minutes"))
    run.feed((5, "a", "LIKE"), (70, "b", "LIKE"))
    assert run.closed() == []  # the watermark stands at 00:40
    run.feed((20, "c", "LIKE"), (100, "d", "SHARE"))  # 00:20 is behind the watermark, its window is not
    assert run.closed() == [(0, 1, "LIKE", 2)]  # 01:10
    q = run.feed((30, "e", "LIKE"), (75, "f", "LIKE"), (160, "g", "LIKE"))  # the first is late for good
    assert sum(s["numRowsDroppedByWatermark"] for p in q.recentProgress for s in p["stateOperators"]) == 1
    assert run.closed() == [(0, 1, "LIKE", 2), (1, 2, "LIKE", 2), (1, 2, "SHARE", 1)]  # 02:10
    live = {(r.window_start.hour, r.action, r.events, r.closed) for r in windows.live_windows(spark, run.sink, run.ckpt).collect()}
    assert live == {(0, "LIKE", 2, True), (1, "LIKE", 2, True), (1, "SHARE", 1, True), (2, "LIKE", 1, False)}


def test_sessions_and_active_users(spark):
    run = Run(spark, lambda e: windows.counts(e, F.session_window(windows.TIME, "20 minutes"), "10 minutes", ("user_from",)))
    run.feed((0, "a", "LIKE"), (15, "b", "LIKE"))
    run.feed((10, "a", "LIKE"), (25, "a", "LIKE"))  # a's first two meet across the restart
    run.feed((300, "z", "LIKE"))
    assert {(r.user_from, r.events, r.window_end.minute) for r in spark.read.parquet(run.sink).collect()} == {("a", 3, 45), ("b", 1, 35)}
    run = Run(spark, lambda e: windows.active_users(e, HOUR, "10 minutes"))
    run.feed((1, "a", "LIKE"), (2, "a", "LIKE"), (3, "b", "LIKE"))
    run.feed((50, "b", "LIKE"), (59, "c", "LIKE"))
    run.feed((300, "z", "LIKE"))
    run.feed((301, "z", "LIKE"))
    assert run.closed() == [(0, 1, 5, 3)]


def test_empty_and_unreadable_messages_make_no_window(spark):
    run = Run(spark, lambda e: windows.counts(e, F.window(windows.TIME, HOUR)))
    os.makedirs(local(run.src) + "/bad")
    with open(local(run.src) + "/bad/m.txt", "w") as f:
        f.write('{bad\n[]\n{"user_from":"a"}\n{"user_from":"a","user_to":"b","action":"x","timestamp":"noon"}\n')
    q = windows.start_windows(spark, run.aggregate, f"{run.src}/*", run.sink, run.ckpt, available_now=True)
    q.awaitTermination()
    assert windows.live_windows(spark, run.sink, run.ckpt).count() == 0


def test_stream_silver_once_and_state_expires(spark):
    root = scratch_path(spark, "test-silver-stream")
    src, sink, ckpt = f"{root}/in", f"{root}/out", f"{root}/ckpt"
    first = events(spark, *[(m, "a", "like") for m in range(40)])
    held = []
    for n, part in enumerate([first, first.unionByName(events(spark, (41, "a", "like"), (41, "a", "LIKE"))),
                              events(spark, (5 * 1440, "b", "like")), first]):
        write_message_files(part, f"{src}/p{n}")
        q = silver_streaming.start_silver(spark, f"{src}/*", sink, ckpt, "1 hour", available_now=True)
        q.awaitTermination()
        held.append(silver_streaming.state_rows(q)[-1])
    all_ = first.unionByName(events(spark, (41, "a", "like"), (41, "a", "LIKE"), (5 * 1440, "b", "like")))
    assert sorted(map(tuple, silver_streaming.read_silver(spark, sink).collect())) == sorted(map(tuple, silver.clean(all_).collect()))
    assert held[0] == 40 and held[1] == 42 and held[2] <= 1 and held[3] <= 1
    assert os.path.isdir(f"{local(sink)}/event_date=2025-01-01")


def test_counters_add_up_after_a_failed_batch(spark):
    root = scratch_path(spark, "test-counters")
    src, table, ckpt, path = f"{root}/in", f"{root}/out", f"{root}/ckpt", f"{root}/counters"
    listener = counters.CounterListener(spark, path, "counted-test")
    spark.streams.addListener(listener)
    write = idempotent_batch_writer(table)

    def dies(batch, batch_id):
        write(batch, batch_id)
        raise RuntimeError("before the commit")

    def run(writer):
        q = start_bronze(spark, "text", table, ckpt, source_path=f"{src}/*", available_now=True, batch_writer=writer,
                         transform=counters.observed, name="counted-test")
        try:
            q.awaitTermination()
        finally:
            assert listener.ended.wait(60)

    try:
        write_message_files(events(spark, (1, "a", "LIKE"), (2, "b", "LIKE")), f"{src}/p0")
        run(write)
        write_message_files(events(spark, (3, "a", "LIKE")), f"{src}/p1")
        os.makedirs(f"{local(src)}/p2")
        with open(f"{local(src)}/p2/m.txt", "w") as f:
            f.write("{cut\n[1]\n")
        with pytest.raises(Exception, match="before the commit"):
            run(dies)
        run(write)
    finally:
        spark.streams.removeListener(listener)
    rows = {r.batch_id: (r.rows_in, r.rejected, r.written) for r in counters.read_counters(spark, path).collect()}
    assert rows == {0: (2, 0, 2), 1: (3, 2, 1)}
    assert spark.read.parquet(f"{table}/batch_id=*").count() == sum(r[0] for r in rows.values())


def test_compaction_beside_a_running_stream(spark):
    root = scratch_path(spark, "test-compact")
    src, ckpt = f"{root}/in", f"{root}/ckpt"
    want = []

    def files():
        return sum(f.endswith(".parquet") for folder in compaction.live_folders(spark, root)
                   for f in os.listdir(local(compaction.data_path(root)) + "/" + folder))

    def append(n):
        for i in range(n):
            part = events(spark, (len(want), f"u{len(want)}", "LIKE"))
            want.append(f"u{len(want)}")
            write_message_files(part, f"{src}/p{len(want)}")
            start_bronze(spark, "text", root, ckpt, source_path=f"{src}/*", available_now=True,
                         batch_writer=idempotent_batch_writer(compaction.data_path(root))).awaitTermination()

    def users():
        return sorted(r.user_from for r in compaction.read_batches(spark, root, EVENT).collect())

    assert compaction.compact(spark, root, ckpt, EVENT) == 0
    append(4)
    assert compaction.compact(spark, root, ckpt, EVENT) == 1 and files() == 1 and users() == sorted(want)
    append(2)
    # a batch that is written but not committed stays out of the bins
    for name in ("5", ".5.crc"):
        os.remove(f"{local(ckpt)}/commits/{name}")
    assert users() == sorted(want)
    assert compaction.compact(spark, root, ckpt, EVENT) == 2 and users() == sorted(want)
    append(1)  # replays batch 5 in its own folder, then goes on
    assert users() == sorted(want)
    compaction.compact(spark, root, ckpt, EVENT)
    assert users() == sorted(want) and files() <= 2
    assert folders(spark, compaction.data_path(root), "batch_id") == [5, 6]  # 0 to 4 have been deleted


def test_bins():
    assert compaction.bins([("a", 5), ("b", 4), ("c", 2), ("d", 99), ("e", 1)], 9) == [["a", "b"], ["c"], ["d"], ["e"]]
    assert compaction.bins([], 9) == []


def test_compaction_copies_bins_without_a_sort(spark, monkeypatch):
    """A bin's rows go from file to file; what a run that broke off has left is not read."""
    from pyspark.sql.readwriter import DataFrameWriter

    root, ckpt = scratch_path(spark, "test-copy"), scratch_path(spark, "test-copy-ckpt")
    rows = [(f"u{i}", "v", "like", "2024-01-01 00:00:00") for i in range(40)]
    for n in range(4):
        spark.createDataFrame(rows[10 * n:10 * n + 10], EVENT).write.parquet(f"{compaction.data_path(root)}/batch_id={n}")
    spark.createDataFrame(rows[:5], EVENT).write.parquet(f"{compaction.data_path(root)}/packed=1/bin=7")
    monkeypatch.setattr(compaction, "last_commit", lambda *a: 3)
    plans, real = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **k: (
        plans.append(self._df._jdf.queryExecution().executedPlan().toString()), real(self, *a, **k))[1])
    size = max(written_bytes(spark, f"{compaction.data_path(root)}/batch_id={n}") for n in range(4))
    assert compaction.compact(spark, root, ckpt, EVENT, target=2 * size) == 2
    monkeypatch.undo()
    assert len(plans) == 2 and not any(w in p for p in plans for w in ("Sort", "Exchange"))
    assert folders(spark, compaction.data_path(root) + "/packed=1", "bin") == [0, 1]
    assert compaction.live_folders(spark, root) == ["packed=1/bin=0", "packed=1/bin=1"]
    assert sorted(r.user_from for r in compaction.read_batches(spark, root, EVENT).collect()) == sorted(r[0] for r in rows)
