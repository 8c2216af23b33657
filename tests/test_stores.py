"""Shard store by folders, lenient scans that report, strict value lookup."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from snapdiff.operators import graph as G
from snapdiff.sources.matches import decode_matches
from snapdiff.sources.shards import read_shards, write_shards


def shards(spark, offset):
    nodes = spark.createDataFrame([(p, n + offset, f"v{n}", n % 3 == p) for p in range(3) for n in range(9)],
                                  "part int, node_id long, stored_value string, is_subject boolean")
    adj = spark.createDataFrame([(p, n + offset, (n + 1) % 9 + offset) for p in range(3) for n in range(9)], "part int, src long, dst long")
    return nodes, adj


def test_some_parts_open_only_their_files(spark, tmp_path):
    path = str(tmp_path / "shards")
    write_shards(shards(spark, 0), shards(spark, 100), path)
    nodes, adj = read_shards(spark, path, parts=[0, 2], side="original")
    plan = nodes._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].split("\n")[0]
    assert "part" in filters and "IN (0,2)" in filters.replace(", ", ",") and "side" in filters
    files = {r["f"] for r in spark.read.text(path).where("part IN (0, 2) AND side = 'original'").select(F.input_file_name().alias("f")).distinct().collect()}
    assert files and all("side=original" in f and "part=1" not in f for f in files)
    assert sorted(map(tuple, nodes.collect())) == sorted(
        ("original", p, n, f"v{n}", n % 3 == p) for p in (0, 2) for n in range(9))
    assert adj.count() == 18
    assert read_shards(spark, path)[0].count() == 54


def test_skipped_shard_lines_are_reported(spark, tmp_path):
    path = str(tmp_path / "lines")
    spark.createDataFrame([('{"side":"original","part":0,"node_id":1,"stored_value":"a","is_subject":true,"chunk":0,"neighbors":[2]}',), ("junk",),
                           ("",), ('{"side":"original","part":0,"stored_value":"a"}',)], "value string").write.text(path)
    report = Observation("shard-lines")
    nodes, _ = read_shards(spark, path, report=report)
    assert [tuple(r) for r in nodes.collect()] == [("original", 0, 1, "a", True)]
    assert report.get == {"read": 4, "kept": 1, "no_json": 2, "no_node": 1}


def test_skipped_match_lines_are_reported(spark):
    lines = ["original_1\t2_0.5", "original_1", "a\tb\tc", "", "original\t2_0.5", "x_1_2\t2_0.5", "original_1\t2", "original_x\t2_0.5", "original_1\t2_y", "_1\t2_0.5", None]
    report = Observation("match-lines")
    rows = decode_matches(spark.createDataFrame([(x,) for x in lines], "value string"), report=report).collect()
    assert [tuple(r) for r in rows] == [("original", 1, 2, 0.5)]
    assert report.get == {"read": 11, "kept": 1, "no_tab": 4, "bad_key": 3, "bad_value": 1, "no_number": 2}


def test_strict_lookup_names_the_missing_node(spark):
    nodes = spark.createDataFrame([(1, "a"), (2, None)], "node_id long, stored_value string")
    edges = spark.createDataFrame([(1, 2), (2, 77)], "src long, dst long")
    lenient = G.build_shards(nodes, edges, 1, 1)[0]
    assert {(r["node_id"], r["stored_value"]) for r in lenient.collect()} == {(1, "a"), (2, None), (77, None)}
    with pytest.raises(PySparkException, match="node 77"):
        G.build_shards(nodes, edges, 1, 1, strict=True)[0].collect()
    known = spark.createDataFrame([(1, 2)], "src long, dst long")
    assert G.build_shards(nodes, known, 1, 1, strict=True)[0].count() == 2
