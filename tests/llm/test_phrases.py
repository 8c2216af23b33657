"""Collocations against plain counting; automata against plain counts of n-grams."""

import random
import re
from collections import Counter

import numpy as np

from snapdiff.llm import phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top, longest=5, absorb=100):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            ws = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for k in range(1, longest + 1):
                for i in range(len(ws) - k + 1):
                    f[lang, tuple(ws[i : i + k])] += 1
    cand = {p: c for p, c in f.items() if len(p[1]) > 1 and c >= least}
    inside = Counter()
    for (lang, p), c in cand.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                inside[lang, p[i : i + k]] = max(inside[lang, p[i : i + k]], c)
    out = {}
    for (lang, p), a in cand.items():
        if 100 * inside[lang, p] >= absorb * a:
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))]
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n[lang], -score)
                  for lang, found in out.items() for i, (score, a, p, left, right) in enumerate(sorted(found)[:top]))


def texts():
    rng = random.Random(5)
    words = ["a", "b", "É", "the", "of", "c\x01d", "x-y", "n b"] + [f"w{i}" for i in range(40)]
    rows = []
    for i in range(300):
        parts = [rng.choice(words[: rng.choice([4, 8, 48])]) for _ in range(rng.randrange(0, 60))]
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ",", "\x0b"]) for w in parts)
        rows.append((text + "The quick  Brown fox jumps" * (i % 3 == 0), rng.choice(["en", "en", "fr", None, ""])))
    rows += [(None, "en"), ("", "fr"), (None, None), ("...", "en"), ("a b " * 30_000, "long")] + rows[:5]
    return rows


def found(spark, rows, parts=3, **kw):
    df = spark.createDataFrame(rows, "text string, lang string").repartition(parts)
    return sorted(tuple(r) for r in phrases.collocations(df, **kw).collect())


def test_against_plain_counts(spark):
    rows = texts()
    for least, top, absorb in ((8, 2000, 100), (20, 7, 100), (8, 2000, 60)):
        expected = brute(rows, least, top, absorb=absorb)
        assert len(expected) > 10
        assert found(spark, rows, least=least, top=top, absorb=absorb, filter_bits=14) == expected


def test_full_filters_change_nothing(spark):
    rows = texts()
    expected = brute(rows, 8, 2000)
    assert found(spark, rows, parts=7, least=8, filter_bits=9) == expected
    assert found(spark, rows, parts=1, least=300, filter_bits=22) == brute(rows, 300, 2000)


def test_many_small_shards(spark, monkeypatch):
    rows = texts()[:300]
    monkeypatch.setattr(phrases, "SHARD", 2000)
    held = []
    for a in range(0, len(rows), 20):
        part = rows[a : a + 20]
        shard = phrases._Shard([(t or "").encode() for t, _ in part], ["und" if x is None else x for _, x in part])
        made = shard.automaton([], 5)
        pieces = [phrases.Automaton.load(p.dump()) for _, p in made.split(5)]
        held.append(phrases.Automaton.union(pieces))
        for d in range(1, 6):  # the ranges together are the whole
            assert (held[-1].label[d] == made.label[d]).all() and (held[-1].weight[d] == made.weight[d]).all()
    whole = phrases.Automaton.union(held)
    count = Counter()
    for text, lang in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            ws = re.findall("[^\x20\x09]+", piece)
            for k in range(1, 6):
                for i in range(len(ws) - k + 1):
                    count[k, lang, *ws[i : i + k]] += 1
    for k in range(1, 6):
        assert sorted(whole.weight[k].tolist()) == sorted(c for key, c in count.items() if key[0] == k)
    rows_ = whole.paths(3)
    asked = phrases.Automaton.of_grams([rows_[:0, :1], rows_[:0, :2], rows_[:0, :3], rows_[::-2]],
                                       [np.zeros(0, np.int64)] * 3 + [np.ones(len(rows_[::-2]), np.int64)])
    met = asked.compose(whole)[3]
    assert (whole.paths(3)[met] == asked.paths(3)).all()


def test_empty_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "text string, lang string, rank long, phrase string")
    assert phrases.collocations(empty).count() == 0
    same = spark.createDataFrame([("a b", "en", 1, "x", 2)] * 5 + [(None, "en", 1, None, 2)], "text string, lang string, n long, label string, range int")
    assert [tuple(r) for r in phrases.collocations(same, least=5).collect()] == [("en", 1, "a b", 5, 5, 5, 10, 2000)]
    assert phrases.collocations(same, least=6).count() == 0
