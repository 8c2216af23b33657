"""A benchmark of several blocks: one pass at a time, the same hits."""

from snapdiff.llm import decontam


def test_one_step_whatever_the_blocks(spark, monkeypatch):
    items = [(i, " ".join(f"i{i}w{k}" for k in range(20))) for i in range(30)]
    shared = " ".join(f"s{k}" for k in range(15))
    items += [(100 + i, f"{shared} {i}") for i in range(5)]
    docs = [(i, f"own words {items[i][1]} more {items[(i * 7 + 3) % 30][1]} {shared} end") for i in range(30)]
    docs += [(60, None), (61, ""), (62, "nothing here"), docs[0]]
    left, right = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(repr, decontam.find_benchmark(left, right).collect()))
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 400)
    found = decontam.find_benchmark(left, right)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1
    assert sorted(map(repr, found.collect())) == whole
    assert decontam.drop_contaminated(left, right).columns == left.columns
