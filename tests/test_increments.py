"""Incremental Silver and graph, and rejected rows."""

import os
import random

import pytest
from pyspark.sql import functions as F

from plexus.operators import increments, silver
from plexus.operators.graph import build_graph
from plexus.schemas import EDGE, EVENT
from plexus.session import materialize, scratch_path
from plexus.sources import quarantine, tables


def local(path):
    return path[5:] if path.startswith("file:") else path


def rows_of(df):
    return sorted(map(str, df.collect()))


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(local(path)) for f in names
            if f.endswith(".parquet")}


def test_one_day_rewrites_one_partition(spark):
    path = scratch_path(spark, "test-silver-days")
    raw = [(f"u{i}", "x", "like", f"2025-01-0{1 + i % 4} 10:00:{i:02d}") for i in range(40)]
    increments.write_silver(spark.createDataFrame(raw, EVENT), path)
    before = files(path)
    third = [r for r in raw if r[3].startswith("2025-01-03")]
    day = spark.createDataFrame([*third, *third, ("new", "x", "like", "2025-01-03 09:00:00"), ("other", "x", "like", "2025-01-04 09:00:00")], EVENT)
    for _ in range(2):  # repeating it changes nothing
        increments.refresh_silver(day, path, ["2025-01-03"])
        now = files(path)
        kept = {f for f in before if "2025-01-03" not in f}
        assert {f: before[f] for f in kept} == {f: t for f, t in now.items() if f in kept}
        assert {f for f in now if f not in kept} and all("event_date=2025-01-03" in f for f in now if f not in kept)
        want = silver.clean(spark.createDataFrame([*raw, ("new", "x", "like", "2025-01-03 09:00:00")], EVENT))
        assert rows_of(increments.read_silver(spark, path)) == rows_of(want)
    increments.refresh_silver(day.limit(0), path)
    assert increments.read_silver(spark, path).count() == 41
    increments.refresh_silver(spark.createDataFrame([("late", "x", "like", "2025-02-01 00:00:00")], EVENT), path)
    assert increments.read_silver(spark, path).count() == 42


def _edges(spark, rows):
    return materialize(spark.createDataFrame([(a, b, "LIKE", None, None, None) for a, b in rows], EDGE), "edges-of-test")


def test_five_loads_equal_one(spark):
    rng = random.Random(4)
    loads = [[(f"u{rng.randint(0, 8 + 6 * n)}", rng.choice(["hub", f"u{rng.randint(0, 8 + 6 * n)}", None])) for _ in range(60)] for n in range(5)]
    store = increments.GraphStore(spark, scratch_path(spark, "test-store"))
    ids = {}
    for n, load in enumerate(loads):
        got = store.append(_edges(spark, load), n)
        now = {r.user: r.vid for r in store.graph().vertices.collect()}
        assert all(now[u] == v for u, v in ids.items())  # no id ever changes
        assert sorted(now.values()) == list(range(len(now))) and got["new_users"] == len(now) - len(ids)
        ids = now
        if n in (1, 3):
            store.merge()
        if n == 2:  # a load that is repeated replaces itself
            store.append(_edges(spark, load), n)
    whole = build_graph(_edges(spark, [e for load in loads for e in load]))
    g = store.graph()

    def named(graph):
        return sorted((r.a, r.b, r.w) for r in graph.user_names(graph.user_names(graph.projection, "src", "a"), "dst", "b").collect())

    assert named(g) == named(whole)
    assert (g.n_vertices, g.n_pairs, g.n_edges) == (whole.n_vertices, whole.n_pairs, whole.n_edges)
    assert sorted((r.user_from, r.user_to) for r in g.edges.collect()) == sorted((r.user_from, r.user_to) for r in whole.edges.collect())
    with pytest.raises(ValueError, match="load 2"):
        store.append(_edges(spark, loads[2]), 2)
    store.append(_edges(spark, []), 5)
    assert store.graph().n_edges == g.n_edges


def test_old_users_are_not_sorted(spark):
    """The sort of a load is over its own new users: the dictionary is only looked up."""
    store = increments.GraphStore(spark, scratch_path(spark, "test-store-plan"))
    store.append(_edges(spark, [(f"u{i}", f"u{i + 1}") for i in range(50)]), 0)
    seen = []
    real = increments.dense_index

    def spy(df, col, *a):
        seen.append(df.count())
        return real(df, col, *a)

    increments.dense_index = spy
    try:
        store.append(_edges(spark, [("u1", "n1"), ("n1", "u2"), ("n2", "n1")]), 1)
    finally:
        increments.dense_index = real
    assert seen == [2]


MESSAGES = [('{"user_from":"a","user_to":"b","action":"like","timestamp":"t"}', None), ('{"user_from":"a","x":1}', None),
            ("{bad", "not a JSON object"), ("[]", "not a JSON object"), ('[{"user_from":"a"}]', "not a JSON object"), ("", "not a JSON object"),
            ("5", "not a JSON object"), (None, "null message"), ('{"x":1}', "no known field"), ("{}", "no known field"),
            ('{"user_from":null}', "no known field"), ('  {"user_to":"b"}', None), ('{"user_from":"a"', "not a JSON object")]


def test_messages_that_do_not_fit(spark):
    sent = spark.createDataFrame([(m.encode() if m is not None else None, i) for i, (m, _) in enumerate(MESSAGES)], "value binary, n int")
    checked = quarantine.checked_messages(sent, source=F.concat(F.lit("topic:"), F.col("n")))
    got = {r.source: (r.raw, r.reason) for r in checked.collect()}
    assert got == {f"topic:{i}": m for i, m in enumerate(MESSAGES)}
    good, bad = quarantine.good_messages(checked), quarantine.rejects(checked)
    assert good.count() == 3 and bad.count() == len(MESSAGES) - 3
    assert sorted(str(r.user_from) for r in good.collect()) == ["None", "a", "a"]


def test_stream_keeps_rejects(spark):
    from plexus.streaming.bronze import message_stream

    root = scratch_path(spark, "test-rejects")
    os.makedirs(f"{local(root)}/in")
    with open(f"{local(root)}/in/m.txt", "w") as f:
        f.write("\n".join(m for m, _ in MESSAGES if m))
    write = quarantine.checked_batch_writer(f"{root}/good", f"{root}/bad")
    for _ in range(2):  # the second run replays the batch
        q = (quarantine.checked_messages(message_stream(spark, "text", f"{root}/in"), source=F.col("_metadata.file_name")).writeStream
             .foreachBatch(write).option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start())
        q.awaitTermination()
        for name in os.listdir(f"{local(root)}/ckpt/commits"):
            os.remove(f"{local(root)}/ckpt/commits/{name}")
    assert spark.read.parquet(f"{root}/good/batch_id=*").count() == 3
    bad = quarantine.read_rejects(spark, f"{root}/bad").collect()
    assert sorted((r.raw, r.reason) for r in bad) == sorted((m, r) for m, r in MESSAGES if m and r)
    assert {r.source for r in bad} == {"m.txt"}


def test_csv_rows_that_do_not_fit(spark):
    path = scratch_path(spark, "test-bad-csv")
    os.makedirs(local(path))
    head = ",".join(EDGE.fieldNames())
    ok = '"a","b, c","LIKE","2025-01-01T10:00:00.000+00:00","2025-01-01","10"'
    bad = ['"a","b","LIKE"', '"a","b","LIKE","noon","2025-01-01","10"', ok + ',"more"']
    with open(f"{local(path)}/x.csv", "w") as f:
        f.write("\n".join([head, ok, *bad, ok]) + "\n")
    good, rejected = quarantine.read_edges_csv_checked(spark, path)
    assert [tuple(r)[:3] for r in good.collect()] == [("a", "b, c", "LIKE")] * 2
    assert sorted(r.raw for r in rejected.collect()) == sorted(bad)
    assert {os.path.basename(r.source) for r in rejected.collect()} == {"x.csv"}
    with pytest.raises(Exception):
        tables.read_edges_csv(spark, path).collect()
