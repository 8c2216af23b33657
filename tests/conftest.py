import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from snapdiff.session import checkpoint_dir, local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(2, partitions=4, app="snapdiff-tests")
    checkpoint_dir(s)
    yield s
    s.stop()


def graph(spark, adj: dict[int, list[int]], values: dict[int, str]):
    """A SideGraph from an adjacency dict (directed rows, as given)."""
    from snapdiff.operators.similarity import SideGraph, with_degrees

    rows = [(a, b) for a, nbrs in adj.items() for b in nbrs]
    edges = spark.createDataFrame(rows, "src long, dst long")
    vals = spark.createDataFrame([(k, v) for k, v in values.items() if k in adj], "node_id long, stored_value string")
    return SideGraph(vals=vals, adj=with_degrees(edges, []))
