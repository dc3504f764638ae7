import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from plexus.session import build_session  # noqa: E402

FIXTURES = os.path.join(ROOT, "tests", "fixtures")
SMALL_SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", app="plexus-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def golden_edges(spark):
    from plexus.sources.tables import read_edges_csv
    return read_edges_csv(spark, os.path.join(FIXTURES, "golden_edges.csv")).cache()


@pytest.fixture(scope="session")
def golden_metrics():
    import pandas as pd
    return pd.read_csv(os.path.join(FIXTURES, "golden_metrics.csv"))


@pytest.fixture(scope="session")
def golden_graph(golden_edges):
    from plexus.operators.graph import build_graph
    return build_graph(golden_edges)
