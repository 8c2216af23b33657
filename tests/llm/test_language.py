"""Language ID: held-out accuracy on labelled text, and the odd cases."""

import math
import random

import numpy as np

from pyspark.sql import functions as F

from snapdiff.llm import language as L
from snapdiff.llm.text import crc_mod

from conftest import SF_SMALL


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(SF_SMALL.replace("sf0.001", "sf0.01") + "/documents.parquet")
    net = L.train(docs.where(crc_mod("doc_id", 3) != 1))
    got = L.predict(docs, net).where(crc_mod("doc_id", 3) == 1)
    right, total = got.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right / total > 0.95


def test_odd_cases(spark):
    rng = random.Random(1)
    texts = [(i, " ".join(rng.choice(["the", "and", "of"]) for _ in range(40)), "en") for i in range(40)]
    texts += [(100 + i, " ".join(rng.choice(["und", "der", "zu"]) for _ in range(40)), "de") for i in range(40)]
    odd = [(500, None, "en"), (501, "", "de"), (502, "12 ... \n", "en"), (503, "ß", None), (504, "the and " * 40_000, None), (500, None, "en"), (None, "und der", None)]
    df = spark.createDataFrame(texts + odd, "doc_id long, text string, lang string")
    net = L.train(df)
    got = L.predict(df.drop("lang"), net).collect()
    assert len(got) == len(texts) + len(odd)
    by = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got}
    assert by[500] == by[501] == by[502] == ("und", 0.0)
    assert by[503][0] != "und" and by[504][0] == "en" and by[None][0] == "de"
    assert all(0 <= r["score"] <= 1 for r in got)


def test_rows_without_an_id_are_thinned(spark):
    rows = [(None, f"the {i} and of", "en") for i in range(400)] + [(i, f"und {i} der zu", "de") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    net = L.train(df, per_language=5)
    got = L.predict(df, net).groupBy("lang", "lang_pred").count().collect()
    assert net.languages == ["de", "en"] and sum(r["count"] for r in got) == 800


def test_nothing_to_learn_and_empty_table(spark):
    df = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert L.train(df) is None
    assert L.predict(df, None).first()["lang_pred"] == "und"
    empty = spark.createDataFrame([], "doc_id long, text string, score string")
    assert L.predict(empty, None, out=("l", "s")).columns == ["doc_id", "text", "score", "l", "s"]


def test_network_against_a_plain_convolution():
    """Filter by filter and place by place in Python floats."""
    net = L.ByteNet(["a", "b", "c"], seed=3)
    rng = np.random.Generator(np.random.PCG64(1))
    net.bias[:] = rng.normal(0, 0.2, len(net.bias))
    texts = [rng.integers(0, 256, k, dtype=np.uint8).tobytes() for k in (L.WINDOW, 3 * L.WINDOW - 17, 5)]

    def window(data):
        data = data.ljust(L.WINDOW, b" ")
        peaks = []
        for f in range(L.FILTERS * len(L.WIDTHS)):
            width = L.WIDTHS[f // L.FILTERS]
            places = range(L.WINDOW - max(L.WIDTHS) + 1)
            best = max(sum(float(net.embed[data[i + k]][e]) * float(net.conv[k * L.EMBED + e, f]) for k in range(width) for e in range(L.EMBED))
                       for i in places)
            peaks.append(max(best + float(net.bias[f]), 0.0))
        z = [sum(p * float(w) for p, w in zip(peaks, net.dense[:, c])) for c in range(3)]
        top = sum(math.exp(x) for x in z)
        return [math.exp(x) / top for x in z]

    for text, got in zip(texts, net.probabilities(texts)):
        cut = [text[i : i + L.WINDOW] for i in range(0, len(text), L.WINDOW)]
        want = [sum(window(c)[k] * len(c) for c in cut) / len(text) for k in range(3)]
        assert np.allclose(got, want, atol=1e-5)
