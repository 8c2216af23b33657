"""Chunks and pairs are read where they lie; helpers that replace sorts agree with them."""

import random

import numpy as np
from pyspark.sql import functions as F

from snapdiff.llm import pitman_yor as M
from snapdiff.llm.chunks import bucketed, dealt
from snapdiff.llm.text import SPACED, Words


def test_scores_shuffle_no_chunk(spark):
    told = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.createDataFrame([(i, f"a b{i % 3} c{i}") for i in range(40)], "doc_id long, text string")
        scored = M.score_texts(df, F.col("doc_id") % 3 != 0)
        plan = scored._jdf.queryExecution().executedPlan().toString()
        assert scored.count() == 40
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", told)
    scans = [line for line in plan.split("\n") if "FileScan" in line]
    by_key = [line for line in scans if "vocabularies" in line or "owned" in line and "told" in line or "pairs_" in line or "seated" in line]
    assert sum("Bucketed: true" in line for line in by_key) >= 4, plan


def test_a_bucketed_table_keeps_all_rows_and_no_name(spark):
    before = {t.name for t in spark.catalog.listTables()}
    rows = bucketed(spark.range(100).withColumn("x", F.col("id") % 7), "kept", "x", "none")
    assert {t.name for t in spark.catalog.listTables()} == before
    assert sorted(map(tuple, rows.collect())) == [(i, i % 7) for i in range(100)]
    counts = rows.groupBy("x").count()
    assert "Exchange" not in counts._jdf.queryExecution().executedPlan().toString() and counts.count() == 7


def test_helpers_agree_with_sorting():
    rng = np.random.default_rng(5)
    for top in (5, 300, 1 << 40):
        x, y = rng.integers(0, top, 200), rng.integers(0, 50, 200)
        for got, want in zip(M._distinct(x), np.unique(x, return_inverse=True)):
            assert (got == want).all()
        order = M._ordered(x, y)
        assert sorted(zip(x.tolist(), y.tolist())) == list(zip(x[order].tolist(), y[order].tolist()))
        assert (M._rooms(np.sort(x)) == np.unique(np.sort(x), return_inverse=True)[1]).all()
        assert (M._rooms(x) == np.unique(x, return_inverse=True)[1]).all()
    assert [len(a) for a in M._distinct(np.zeros(0, np.int64))] == [0, 0] and len(M._rooms(np.zeros(0, np.int64))) == 0
    for bucket in (rng.integers(0, 9, 100), rng.integers(0, 1 << 40, 100), np.zeros(0, np.int64)):
        assert [(b, r.tolist()) for b, r in dealt(bucket)] == [(b, np.flatnonzero(bucket == b).tolist()) for b in np.unique(bucket).tolist()]


def test_tokens_come_back_from_their_numbers():
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["An", "é", "b", "cc\t", "ZZ"]) for _ in range(rng.randrange(0, 30))).encode() for _ in range(20)]
    token, ptr, words, number = M.tokens(texts)
    distinct, place = np.unique(token, return_inverse=True)
    at = number[M._first_places(place, len(distinct))]
    assert (M._hashes(M._spelled(words, at[at >= 0]), int(np.searchsorted(distinct, M.END_TOKEN))) == distinct).all()
    often = rng.sample(range(len(distinct)), len(distinct))
    code = np.argsort(often).astype(np.int32)
    ids = np.array(rng.sample(range(1000), len(distinct)))
    end = int(np.searchsorted(distinct, M.END_TOKEN))
    back, first, second, pair = M.token_pairs(M._tight(np.array(often, np.int32), code[place]), ptr, end, ids)
    assert (back == place).all() and (second[pair] == place).all()
    want = np.concatenate([[end], place[:-1]])
    want[ptr[:-1]] = end
    assert (first[pair] == want).all()
    assert sorted(zip(ids[first].tolist(), ids[second].tolist())) == list(zip(ids[first].tolist(), ids[second].tolist()))
    none = Words([b""], SPACED)
    assert M._spelled(none, np.zeros(0, np.int64)) == b"" and (M._hashes(b"", 0) == [M.END_TOKEN]).all()
