"""Driver contract: entry() runs, every oracle key is a query, a sample matches DuckDB at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as entry

from conftest import SMALL_SF

SAMPLE = ["kpi_summary", "silver_clean", "degrees", "pagerank", "betweenness", "closeness",
          "triangle_count", "label_propagation", "user_rank", "community_top10", "shortest_path",
          "ego_network", "modularity", "hourly_mean", "weekday_volume", "louvain", "louvain_summary",
          "louvain_community_stats", "node_export", "user_metrics_export", "action_date_pivot", "stage_counts",
          "pattern_one_hop", "pattern_has_community", "edge_export", "dq_unique_users", "users_missing_metrics",
          "sparse_user_rank", "user_profile", "influence_score", "stream_late_rows", "quarantine_messages"]


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["user", "pagerank"] and len(rows) == 10


def test_oracle_keys_are_queries():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    # every query of the library proper is checked; the optional subpackage says for itself
    assert not [k for k in q if k not in o and k != "pipeline" and not k.startswith("op")]


@pytest.mark.parametrize("name", SAMPLE)
def test_sample_matches_duckdb(spark, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SMALL_SF}/events.parquet')")
    res = con.sql(entry.oracle_sql()[name])
    want = sorted(map(lambda r: tuple(_n(x) for x in r), res.fetchall()))
    df = entry.queries()[name](spark, SMALL_SF)
    assert sorted(df.columns) == sorted(res.columns)
    order = [res.columns.index(c) for c in df.columns]
    got = sorted(tuple(_n(r[i]) for i in range(len(order))) for r in df.collect())
    want = sorted(tuple(w[j] for j in order) for w in want)
    assert got == want


def _n(x):
    if isinstance(x, float):
        return round(x, 6)
    if isinstance(x, list):
        return tuple(x)
    return x
