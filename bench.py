"""Headline-query benchmark. Prints one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
The whole chain runs once in order: graph build with the layers below it (timed on
its own), then each algorithm and query on the built graph, as a user of the
library would run them. Each entry is the wall time to build and collect that
result; every algorithm is run by its own entry, not by an earlier one.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from plexus.plans import catalog  # noqa: E402
from plexus.session import build_session  # noqa: E402

# Algorithms come before the queries that reuse their written results, so each is timed
# cold, and the others are warm reads of those results.
HEADLINE = [
    "silver_clean", "kpi_summary", "action_distribution", "daily_active_users", "hourly_mean",
    "weekday_volume", "action_by_date", "top_out", "degrees", "graph_stats", "ego_network",
    "pagerank", "top_influencers", "user_rank", "betweenness", "closeness", "triangle_count", "shortest_path",
    "label_propagation", "louvain", "influence_score", "community_stats", "community_top10",
    "stream_bronze",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", app="plexus-bench", shuffle_partitions=cpus)
    catalog.clear_cache()
    times: dict[str, float] = {}
    t0 = time.time()
    catalog.graph_of(spark, sf_dir)
    times["graph_build"] = round(time.time() - t0, 3)
    print(f"graph_build: {times['graph_build']}s", file=sys.stderr, flush=True)
    for name in HEADLINE:
        t = time.time()
        catalog.QUERIES[name](spark, sf_dir).collect()
        times[name] = round(time.time() - t, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times,
                      "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
