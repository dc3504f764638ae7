"""Random small multigraphs: Spark results against plain-Python reference code."""

from collections import defaultdict, deque

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from plexus.operators import paths, triangles
from plexus.operators.graph import build_graph
from plexus.operators.pagerank import pagerank

EDGE_LISTS = st.lists(st.tuples(st.integers(0, 7), st.integers(0, 7)), min_size=1, max_size=30)


def _edges_df(spark, pairs):
    rows = [(f"user{a}", f"user{b}", "LIKE", None, "2025-01-01", "10") for a, b in pairs]
    schema = "user_from string, user_to string, action string, event_time timestamp, event_date string, event_hour string"
    return spark.createDataFrame(rows, schema)


def ref_pagerank(pairs, d=0.85, iters=20, tol=1e-7):
    nodes = {f"user{x}" for p in pairs for x in p}
    out = defaultdict(int)
    for a, _ in pairs:
        out[f"user{a}"] += 1
    p = {n: 1 - d for n in nodes}
    delta = dict(p)
    for _ in range(iters):
        m = defaultdict(float)
        for a, b in pairs:
            u, v = f"user{a}", f"user{b}"
            if delta[u] > tol:
                m[v] += delta[u] / out[u]
        delta = {n: d * m[n] for n in nodes}
        for n in nodes:
            p[n] += delta[n]
        if all(x <= tol for x in delta.values()):
            break
    return p


def ref_betweenness(pairs):
    nodes = sorted({f"user{x}" for p in pairs for x in p})
    adj = defaultdict(list)
    for a, b in pairs:
        adj[f"user{a}"].append(f"user{b}")
    bc = dict.fromkeys(nodes, 0.0)
    for s in nodes:
        stack, pred = [], defaultdict(list)
        sigma = dict.fromkeys(nodes, 0.0)
        dist = dict.fromkeys(nodes, -1)
        sigma[s], dist[s] = 1.0, 0
        q = deque([s])
        while q:
            v = q.popleft()
            stack.append(v)
            for w in adj[v]:
                if dist[w] < 0:
                    dist[w] = dist[v] + 1
                    q.append(w)
                if dist[w] == dist[v] + 1:
                    sigma[w] += sigma[v]
                    pred[w].append(v)
        delta = dict.fromkeys(nodes, 0.0)
        while stack:
            w = stack.pop()
            for v in pred[w]:
                delta[v] += sigma[v] / sigma[w] * (1 + delta[w])
            if w != s:
                bc[w] += delta[w]
    return bc


def ref_triangles(pairs):
    und = {(min(a, b), max(a, b)) for a, b in pairs if a != b}
    nb = defaultdict(set)
    for a, b in und:
        nb[a].add(b)
        nb[b].add(a)
    count = defaultdict(int)
    for a, b in und:
        for c in nb[a] & nb[b]:
            if c > b:
                for x in (a, b, c):
                    count[f"user{x}"] += 1
    return count


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(pairs=EDGE_LISTS)
def test_random_graphs_match_reference(spark, pairs):
    g = build_graph(_edges_df(spark, pairs))
    pr = {r["user"]: r["pagerank"] for r in pagerank(g).collect()}
    for u, v in ref_pagerank(pairs).items():
        assert pr[u] == pytest.approx(v, abs=1e-12)
    bc = {r["user"]: r["betweenness"] for r in paths.betweenness(g).collect()}
    for u, v in ref_betweenness(pairs).items():
        assert bc[u] == pytest.approx(v, abs=1e-9)
    tri = {r["user"]: r["triangle_count"] for r in triangles.triangle_count(g).collect()}
    want = ref_triangles(pairs)
    for u in tri:
        assert tri[u] == want.get(u, 0)


def test_undirected_pattern_orientations_and_threshold(spark):
    from collections import Counter

    from pyspark.sql import functions as F

    from plexus.operators.graph import undirected_pattern

    pairs = [(0, 1), (0, 1), (1, 2), (2, 2), (3, 0)]
    g = build_graph(_edges_df(spark, pairs))
    names = {r["user"]: r["vid"] for r in g.vertices.collect()}
    score = {"user0": 0.5, "user1": 0.3, "user2": 0.2, "user3": 0.005}
    scores = g.vertices.select("vid", F.col("user")).rdd.map(
        lambda r: (r["vid"], score[r["user"]])).toDF("vid long, pagerank double")
    got = Counter((r["u"], r["u2"]) for r in undirected_pattern(g, scores, threshold=0.01).collect())
    # every kept edge once per orientation, the self-loop once, user3 (below threshold) nowhere
    want = Counter({("user0", "user1"): 2, ("user1", "user0"): 2, ("user1", "user2"): 1,
                    ("user2", "user1"): 1, ("user2", "user2"): 1})
    assert got == want
    assert set(names) == set(score)


def _hub_pairs():
    """One user sends and receives a third of all interactions each."""
    rest = [((7 * i) % 23 + 1, (11 * i + 3) % 23 + 1) for i in range(60)]
    return [(0, i % 23 + 1) for i in range(60)] + [(i % 23 + 1, 0) for i in range(60)] + rest


def test_hub_graph_without_broadcasts_equals_broadcast(spark, monkeypatch):
    from plexus.operators import communities, graph

    def results():
        g = build_graph(_edges_df(spark, _hub_pairs()))
        labels, _ = communities.label_propagation_run(g)
        louvain, s = communities.louvain_run(g)
        return ({r["user"]: round(r["pagerank"], 12) for r in pagerank(g).collect()},
                {r["vid"]: r["label"] for r in labels.collect()},
                {r["vid"]: r["community"] for r in louvain.collect()}, round(s["modularity"], 12),
                {r["user"]: r["triangle_count"] for r in triangles.triangle_count(g).collect()})

    want = results()
    assert want[0] == {u: pytest.approx(v, abs=1e-12) for u, v in ref_pagerank(_hub_pairs()).items()}
    assert {u: n for u, n in want[4].items() if n} == ref_triangles(_hub_pairs())
    monkeypatch.setattr(graph, "BROADCAST_BYTES", 0)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert results() == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_batches_of_sources_change_nothing_and_leave_nothing(spark):
    import os

    from plexus.session import ensure_checkpoint_dir

    g = build_graph(_edges_df(spark, _hub_pairs()))
    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = {f for f in os.listdir(root) if f.startswith("plexus-round-")}
    want = ref_betweenness(_hub_pairs())
    for per_batch in (5, 12, None):
        got = {r["user"]: r["betweenness"] for r in paths.betweenness(g, sources_per_batch=per_batch).collect()}
        assert got == {u: pytest.approx(v, abs=1e-9) for u, v in want.items()}
    close = [{r["user"]: round(r["closeness"], 12) for r in paths.closeness(g, sources_per_batch=b).collect()} for b in (9, None)]
    assert close[0] == close[1]
    left = {f for f in os.listdir(root) if f.startswith("plexus-round-")} - before
    assert len(left) <= 5  # the five results


def test_louvain_moves_apart_add_up(spark, monkeypatch):
    from plexus.operators import communities
    from plexus.operators.graph import undirected

    monkeypatch.setattr(communities, "MOST_PARTS", 1)  # only moves that touch no common community
    g = build_graph(_edges_df(spark, _hub_pairs()))
    labels, s = communities.louvain_run(g)
    q = communities.modularity_of(undirected(g.projection), labels, label="community").first()["modularity"]
    assert s["converged"] and q == pytest.approx(s["modularity"], abs=1e-12)
    assert s["modularities"] == sorted(s["modularities"])


def _distances(pairs, start, directed=True):
    out = defaultdict(set)
    for a, b in pairs:
        out[a].add(b)
        if not directed:
            out[b].add(a)
    dist, todo = {start: 0}, deque([start])
    while todo:
        v = todo.popleft()
        for w in out[v]:
            if w not in dist:
                dist[w] = dist[v] + 1
                todo.append(w)
    return dist


def _some_graphs():
    import random

    rng = random.Random(8)
    yield [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(260)]  # more users than bits of a word
    yield [(i, i + 1) for i in range(12)] + [(20, 21), (21, 20), (22, 22)]
    yield [(a, b) for a in range(6) for b in range(10, 16)] + [(a, b) for a in range(10, 16) for b in range(20, 26)] + _hub_pairs()


def test_closeness_matches_reference(spark):
    for pairs in _some_graphs():
        g = build_graph(_edges_df(spark, pairs))
        for batch in (None, 70) if len(pairs) > 250 else (None,):
            got = {r["user"]: r["closeness"] for r in paths.closeness(g, sources_per_batch=batch).collect()}
            for v in {x for p in pairs for x in p}:
                d = [k for k in _distances(pairs, v).values() if k]
                assert got[f"user{v}"] == pytest.approx(len(d) / sum(d) if d else 0.0, abs=1e-12)


def test_shortest_path_is_the_smallest(spark):
    for pairs in _some_graphs():
        g = build_graph(_edges_df(spark, pairs))
        nodes = sorted({x for p in pairs for x in p})
        nb = defaultdict(set)
        for a, b in pairs:
            nb[a].add(b)
            nb[b].add(a)
        for a, b in [(nodes[0], nodes[-1]), (nodes[1], nodes[len(nodes) // 2]), (nodes[2], nodes[2])]:
            left = _distances(pairs, b, directed=False)
            row = paths.shortest_path(g, f"user{a}", f"user{b}").collect()
            if a not in left:
                assert row == []
                continue
            want = [a]
            while want[-1] != b:
                want.append(min((x for x in nb[want[-1]] if left.get(x, 99) == left[want[-1]] - 1), key=lambda x: f"user{x}"))
            assert [tuple(r) for r in row] == [(f"user{a}", f"user{b}", len(want) - 1, [f"user{x}" for x in want])]


def test_triangles_match_reference(spark):
    for pairs in _some_graphs():
        g = build_graph(_edges_df(spark, pairs))
        got = {r["user"]: r["triangle_count"] for r in triangles.triangle_count(g).collect()}
        assert {u: n for u, n in got.items() if n} == ref_triangles(pairs)


def test_plans_are_as_wide_after_any_number_of_batches(spark, monkeypatch):
    g = build_graph(_edges_df(spark, _hub_pairs()))
    real, widest = paths.checkpoint, []
    monkeypatch.setattr(paths, "checkpoint", lambda df: (widest.append(
        df._jdf.queryExecution().analyzed().toString().count("Relation")), real(df))[1])
    found = []
    for per_batch in (12, 4):  # 2 and 6 batches
        for run in (paths.betweenness, paths.closeness):
            widest.clear()
            run(g, sources_per_batch=per_batch)
            found.append((run.__name__, max(widest)))
    assert len(set(found)) == 2

def test_louvain_communities_are_connected(spark):
    """A community that a leaving node has cut in two becomes two, with a higher modularity."""
    import random

    from plexus.operators import communities
    from plexus.operators.graph import undirected

    # two cliques that only node 0 joins, in one community without node 0; and one long chain
    pairs = [(a, b) for k in (10, 20) for a in range(k, k + 5) for b in range(a + 1, k + 5)] + [(0, 10), (0, 20)]
    pairs += [(100 + i, 101 + i) for i in range(40)]
    g = build_graph(_edges_df(spark, pairs))
    ids = {r["user"]: r["vid"] for r in g.vertices.collect()}
    sym = undirected(g.projection)
    given = spark.createDataFrame([(v, 0 if u == "user0" else 2 if int(u[4:]) >= 100 else 1) for u, v in ids.items()], "n long, c long")
    got = {r["n"]: r["c"] for r in communities.connected_parts(sym.where("src <> dst"), given, g.n_vertices).collect()}
    want = {}
    for group in ([0], range(10, 15), range(20, 25), range(100, 141)):
        vids = [ids[f"user{x}"] for x in group]
        want |= {v: min(vids) for v in vids}
    assert got == want

    rng = random.Random(5)
    for pairs in (pairs, [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(90)]):
        g = build_graph(_edges_df(spark, pairs))
        labels, s = communities.louvain_run(g)
        lab = {r["vid"]: r["community"] for r in labels.collect()}
        names = {r["vid"]: int(r["user"][4:]) for r in g.vertices.collect()}
        for c in set(lab.values()):
            inside = {names[v] for v, x in lab.items() if x == c}
            edges = [(a, b) for a, b in pairs if a in inside and b in inside]
            assert set(_distances(edges, min(inside), directed=False)) == inside
        q = communities.modularity_of(undirected(g.projection), labels, label="community").first()["modularity"]
        assert q == pytest.approx(s["modularity"], abs=1e-12) and s["modularities"] == sorted(s["modularities"])


def test_betweenness_in_lanes_pieces_and_few_batches(spark, monkeypatch):
    """More sources than lanes, rows cut everywhere, and batches by what sources reach: 150 users who
    only reach 12 others go in one batch and not in one of four sources each."""
    import random

    rng = random.Random(8)
    pairs = [(rng.randint(0, 161), rng.randint(150, 161)) for _ in range(600)] + [(7, 7), (150, 3), (3, 9), (9, 150)]
    g = build_graph(_edges_df(spark, pairs))
    want = ref_betweenness(pairs)
    for name in ("PAIRS", "STATE_ROWS"):
        monkeypatch.setattr(paths, name, 4 * g.n_vertices + 2_000, raising=False)
    real, batches = paths._added, []
    monkeypatch.setattr(paths, "_added", lambda *a: (batches.append(1), real(*a))[1])
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for sizes in ((256, 1 << 14, 1 << 15), (3, 7, 10)):
            for name, n in zip(("EDGES", "MESSAGES", "HELD"), sizes):
                monkeypatch.setattr(paths, name, n, raising=False)
            batches.clear()
            got = {r["user"]: r["betweenness"] for r in paths.betweenness(g).collect()}
            assert got == {u: pytest.approx(v, abs=1e-9) for u, v in want.items()}
            assert len(batches) <= 2
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_betweenness_of_chains_and_empty_graphs(spark):
    for pairs in ([(i, i + 1) for i in range(9)], [(1, 1)], [(1, 2), (2, 1)]):
        got = {r["user"]: r["betweenness"] for r in paths.betweenness(build_graph(_edges_df(spark, pairs))).collect()}
        assert got == {u: pytest.approx(v) for u, v in ref_betweenness(pairs).items()}
    empty = build_graph(_edges_df(spark, [(1, 2)]).where("user_from = 'nobody'"))
    assert paths.betweenness(empty).collect() == []


def test_betweenness_numbers_few_sources_densely_and_many_by_their_ids(spark):
    """The sources of a star are few and get numbers of their own; where most users are sources their ids serve."""
    few = build_graph(_edges_df(spark, [(0, n) for n in range(1, 400)] + [(399, 400), (200, 400)]))
    sources, n = paths._sources(few, paths.adjacency(few))
    assert n == 3 and sorted(r.i for r in sources.collect()) == [0, 1, 2]
    many = build_graph(_edges_df(spark, [(a, a % 2) for a in range(200)]))
    sources, n = paths._sources(many, paths.adjacency(many))
    assert n == many.n_vertices and all(r.s == r.i for r in sources.collect())
    for pairs, g in (([(0, n) for n in range(1, 400)] + [(399, 400), (200, 400)], few), ([(a, a % 2) for a in range(200)], many)):
        want = ref_betweenness(pairs)
        got = {r["user"]: r["betweenness"] for r in paths.betweenness(g).collect()}
        assert got.keys() == want.keys() and all(abs(got[u] - want[u]) < 1e-9 for u in got)


def test_first_level_has_one_lane_a_source(spark):
    rows = paths._seeds(spark.range(130).selectExpr("id + 1000 as s", "id as i")).orderBy("v").collect()
    for i, r in enumerate(rows):
        x, y = np.frombuffer(bytes(r.x)), np.unpackbits(np.frombuffer(bytes(r.y), np.uint8), bitorder="little")
        assert (r.g, r.v, r.n, len(x), len(y)) == (i // 64, 1000 + i, 1, 64, 64)
        assert np.flatnonzero(x).tolist() == np.flatnonzero(y).tolist() == [i % 64] and x.sum() == 1


def test_pagerank_later_rounds_read_reached_users_only(spark, monkeypatch):
    """Most users here have no edge into them: the scores are those of a walk over all edges, and the
    rounds after the first read the few edges whose first user is reached."""
    from plexus.operators import pagerank as pr

    pairs = [(n, n % 3) for n in range(3, 60)] + [(0, 1), (1, 2), (2, 0), (2, 1), (1, 3), (3, 3)]
    read, real = [], pr.checkpoint

    def noted(df, *a):
        out = real(df, *a)
        if "c" in out.columns:
            read.append(sorted(r["src"] for r in out.collect()))
        return out

    monkeypatch.setattr(pr, "checkpoint", noted)
    g = build_graph(_edges_df(spark, pairs))
    ids = {r["user"]: r["vid"] for r in g.vertices.collect()}
    got = {r["user"]: r["pagerank"] for r in pr.pagerank(g, max_iter=9).collect()}
    assert got == pytest.approx(ref_pagerank(pairs, iters=9), abs=1e-12)
    assert read == [sorted(ids[f"user{a}"] for a, _ in set(pairs) if a < 4)]


def test_label_winners_are_the_same_in_one_number_and_in_two(spark):
    """Highest score, ties to the smallest label; votes counted in one number are not sorted."""
    from plexus.operators import communities

    votes = spark.createDataFrame([(0, 4, 7), (0, 2, 7), (0, 1, 6), (1, 0, 1), (2, 4, 2), (2, 0, 9)], "src long, label long, score long")
    for most in (9, 1 << 62):
        best = communities._winners(votes, 5, most)
        assert {r["vid"]: r["new"] for r in best.collect()} == {0: 2, 1: 0, 2: 0}
        assert ("SortAggregate" in best._jdf.queryExecution().toString()) == (most > 9)
