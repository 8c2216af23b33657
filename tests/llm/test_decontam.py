"""Wu-Manber search against a plain scan."""

import random
import re

from snapdiff.llm import decontam

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        w = words(text)
        hit, names = [False] * len(w), set()
        for item, item_text in items:
            v = words(item_text)
            n = min(13, len(v))
            for i in range(len(v) - n + 1 if n else 0):
                for p in range(len(w) - n + 1):
                    if w[p : p + n] == v[i : i + n]:
                        names.add(str(item))
                        hit[p : p + n] = [True] * n
        out.append((doc_id, len(w), sum(hit), sorted(names), sum(hit) > 0 and 20 * sum(hit) >= len(w)))
    return sorted(out, key=repr)


def run(spark, docs, items):
    from pyspark.sql import functions as F

    df = decontam.find_benchmark(spark.createDataFrame(docs, "doc_id long, text string"),
                                 spark.createDataFrame(items, "item_id long, text string"))
    df = df.withColumn("n_hit", decontam.n_hit("hit_spans"))
    df = df.withColumn("bad", decontam.contaminated(F.col("n_words"), F.col("n_hit")))
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["hit_items"], r["bad"]) for r in df.collect()), key=repr)


def case(seed, vocabulary):
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 5, 12, 13, 14, 30]))) for i in range(12)]
    items += [(20, None), (21, " .,"), (22, items[3][1]), (3, text(20))]
    docs = []
    for i in range(60):
        parts = [text(rng.randrange(0, 40))]
        for _ in range(rng.randrange(3)):
            w = words(rng.choice(items)[1])
            lo = rng.randrange(len(w) + 1)
            parts += [", ".join(w[lo : lo + rng.randrange(1, 25)]).upper(), text(rng.randrange(0, 30))]
        docs.append((i, "\n".join(parts)))
    return docs + [(90, None), (91, ""), (92, docs[0][1]), (92, docs[0][1]), (None, docs[1][1])], items


def test_against_plain_scan(spark):
    for seed, size in ((1, 4), (2, 30), (3, 2000)):
        docs, items = case(seed, [f"w{i}" for i in range(size)] + ["été"])
        assert run(spark, docs, items) == brute(docs, items)


def test_several_blocks(spark, monkeypatch):
    docs, items = case(4, [f"w{i}" for i in range(12)])
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 200)
    assert run(spark, docs, items) == brute(docs, items)


def test_long_text(spark):
    body = " ".join(f"w{i % 9973}" for i in range(80_000))
    items = [(1, " ".join(f"w{i}" for i in range(100, 140)))]
    docs = [(1, body + " " + items[0][1])]
    got = run(spark, docs, items)
    n = len(words(docs[0][1]))
    assert got[0][1] == n and got[0][2] == 40 * sum(1 for i in range(0, 80_000, 9973) if i + 140 <= 80_000) + 40


def test_empty_tables_and_columns(spark):
    assert run(spark, [], [(1, "a b")]) == []
    assert run(spark, [(1, "a b")], []) == [(1, 2, 0, [], False)]
    df = spark.createDataFrame([(1, "a b c", "u", 7), (2, "x", "v", 8)], "doc_id long, text string, n_words string, _n_words long")
    out = decontam.drop_contaminated(df, spark.createDataFrame([(1, "A, B")], "item_id long, text string"))
    assert out.columns == df.columns and [r["doc_id"] for r in out.collect()] == [2]
