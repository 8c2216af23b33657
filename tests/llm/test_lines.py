"""Line dedup against a plain count, and its plan."""

import random

from snapdiff.llm import lines


def brute(rows, ratio, least):
    pages, seen = {}, {}
    for _, text, host in rows:
        pages[host] = pages.get(host, 0) + 1
        for line in {x.strip(" ") for x in (text or "").split("\n")} - {""}:
            seen[host, line] = seen.get((host, line), 0) + 1
    bad = {k for k, n in seen.items() if n >= least and n > pages[k[0]] * ratio}
    out = []
    for i, text, host in rows:
        if text is None:
            out.append((i, None, host, 0, 0))
            continue
        parts = text.split("\n")
        kept = [x for x in parts if (host, x.strip(" ")) not in bad]
        out.append((i, "\n".join(kept), host, len(parts), len(parts) - len(kept)))
    return sorted(out, key=repr)


def rows():
    rng = random.Random(2)
    body = [f"line {i}" for i in range(300)]
    out = []
    for i in range(200):
        host = rng.choice(["hot", "hot", "hot", "b", "c", None])
        part = [rng.choice(body) for _ in range(rng.randrange(0, 8))]
        part += rng.sample([f"menu {host}", "  all rights ", "", "\t", "cookie"], rng.randrange(0, 4))
        out.append((i, "\n".join(part), host))
    return out + [(300, None, "b"), (301, "", "b"), (5, out[5][1], out[5][2]), (None, "menu b\nx", "b"), (400, "z\n" * 50_000 + "menu b", "b")]


def test_against_plain_count(spark):
    data = rows()
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    for ratio, least in ((0.05, 5), (0.3, 2)):
        got = lines.dedup_lines(df, max_ratio=ratio, min_pages=least, stats=True).collect()
        assert sorted(map(tuple, got), key=repr) == brute(data, ratio, least)


def test_columns_and_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string, _cut_id string, cut long")
    out = lines.dedup_lines(df)
    assert out.columns == df.columns and out.count() == 0


def test_no_python_in_the_plan(spark):
    plan = lines.dedup_lines(spark.createDataFrame(rows(), "doc_id long, text string, source string"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_sql_counts_rows_that_share_an_id(spark):
    import duckdb
    import pandas as pd

    from snapdiff.llm.oracle import ORACLE

    data = [(1, "menu\nbody", "a")] * 6 + [(100 + i, f"page {i}", "a") for i in range(40)] + [(1, None, "a")]
    documents = pd.DataFrame(data, columns=["doc_id", "text", "source"])
    con = duckdb.connect()
    con.register("documents", documents)
    told = con.sql(ORACLE["op5_line_dedup"])
    expected = sorted((tuple(dict(zip(told.columns, r))[c] for c in ("doc_id", "text", "source", "n_lines", "n_dropped")) for r in told.fetchall()), key=repr)
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    got = sorted((tuple(r) for r in lines.dedup_lines(df, stats=True).collect()), key=repr)
    assert got == expected and (1, "", "a", 2, 2) in got
