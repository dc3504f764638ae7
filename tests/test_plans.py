"""Physical-plan checks: pushdown, pruning, and the shape of the iterative joins."""

import threading

import pytest

from plexus.operators import graph, silver
from plexus.plans import catalog
from plexus.sources.events_adapter import interactions

from conftest import SMALL_SF


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_events_scan_reads_only_needed_columns(spark):
    plan = _plan(interactions(spark, SMALL_SF))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,props:string>" in plan
    assert "value:double" not in plan and "event_id" not in plan


def test_silver_drops_bad_rows_below_the_dedup(spark):
    plan = _plan(silver.clean(interactions(spark, SMALL_SF)))
    # one shuffle; the validity filter runs on the scanned rows, before it
    assert plan.count("Exchange hashpartitioning") == 1
    exchange = plan.index("Exchange hashpartitioning")
    assert plan.find("Filter", exchange) > exchange and plan.find("Filter", 0, exchange) == -1


def test_graph_queries_read_written_tables_only(spark):
    for name in ("graph_edges", "pattern_one_hop", "top_influencer_subgraph", "ego_network", "kpi_summary", "graph_projection"):
        assert "events.parquet" not in _plan(catalog.QUERIES[name](spark, SMALL_SF)), name


def test_pagerank_queries_start_no_search(spark):
    catalog.clear_cache()
    for name in ("top_influencers", "top_n_stats", "user_rank"):
        catalog.QUERIES[name](spark, SMALL_SF).collect()
    assert not [k for k in catalog._CACHE if k[-1] == "betweenness"]


def test_metrics_are_computed_side_by_side(spark, monkeypatch, tmp_path):
    """Each of the three waits for the other two before it starts; one after the other they would never meet."""
    spark.sql("select id event_id, timestamp_ntz'2024-01-01 10:00:00' ts, id % 5 user_id, 'view' event_type, 1.0D value,"
              """ '{"k": ' || (id % 3) || '}' props from range(40)""").write.parquet(f"{tmp_path}/events.parquet")
    met = threading.Barrier(3, timeout=60)
    for name in ("_pagerank", "_betweenness", "_lpa"):
        def run(s, d, real=getattr(catalog, name)):
            met.wait()
            return real(s, d)
        monkeypatch.setattr(catalog, name, run)
    rows = catalog.metrics_real(spark, str(tmp_path)).collect()
    assert sorted(r.user for r in rows) == [f"user{n}" for n in range(5)]
    assert all(None not in r for r in rows)


def test_metrics_write_no_edge_rows(spark, monkeypatch, tmp_path):
    """The resolved edge rows are written when a query reads them, not for the searches and rankings."""
    spark.sql("select id event_id, timestamp_ntz'2024-01-01 10:00:00' ts, id % 5 user_id, 'view' event_type, 1.0D value,"
              """ '{"k": ' || (id % 3) || '}' props from range(40)""").write.parquet(f"{tmp_path}/events.parquet")
    written, real = [], graph.materialize

    def noted(df, name, **kw):
        written.append(name)
        return real(df, name, **kw)

    monkeypatch.setattr(graph, "materialize", noted)
    assert catalog.QUERIES["metric_stats"](spark, str(tmp_path)).count() == 2
    assert "projection" in written and "edges" not in written
    for _ in range(2):
        assert catalog.QUERIES["graph_edges"](spark, str(tmp_path)).count() == 15
    assert written.count("edges") == 1


def test_metrics_report_what_failed(spark, monkeypatch):
    def fails(s, d):
        raise ValueError("no metric")

    monkeypatch.setattr(catalog, "_lpa", fails)
    with pytest.raises(ValueError, match="no metric"):
        catalog.metrics_real(spark, SMALL_SF)


def test_memo_notices_new_input(spark, tmp_path):
    src = spark.read.parquet(f"{SMALL_SF}/events.parquet")
    d = str(tmp_path)
    src.limit(100).write.parquet(f"{d}/events.parquet")
    first = catalog.QUERIES["graph_counts"](spark, d).first()["total_relationships"]
    src.limit(300).write.mode("overwrite").parquet(f"{d}/events.parquet")
    spark.catalog.refreshByPath(f"{d}/events.parquet")
    assert catalog.QUERIES["graph_counts"](spark, d).first()["total_relationships"] > first


def test_kpi_is_one_aggregation_without_cross_join(spark):
    from plexus.plans import activity
    plan = _plan(activity.kpi_summary(catalog.edges_df(spark, SMALL_SF)))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_influencer_pattern_broadcasts_only_the_vertex_side(spark):
    plan = _plan(catalog.QUERIES["top_influencer_subgraph"](spark, SMALL_SF))
    # two joins against the (small) score table, both broadcast; no sort-merge join
    assert plan.count("BroadcastHashJoin") >= 2
    assert "SortMergeJoin" not in plan


def test_shuffles_write_one_file_a_task(spark):
    """With 200 partitions, as nobody sets them, a map task would open a file for each; other numbers stay."""
    from plexus.session import prepare

    number, initial = "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(number)
    try:
        for n, want in (("200", "201"), ("211", None), ("50", "201"), ("8", None)):
            spark.conf.set(number, n)
            prepare(spark)
            assert spark.conf.get(initial, None) == want
        spark.conf.set(number, "200")
        spark.conf.set(initial, "64")
        prepare(spark)
        assert spark.conf.get(initial) == "64"
    finally:
        spark.conf.unset(initial)
        spark.conf.set(number, before)
