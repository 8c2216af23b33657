"""Repetition measures against a plain count."""

import random
import re
from collections import Counter

import pytest

from snapdiff.llm import repetition as R

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain(text):
    text = text or ""
    w = WORD.findall(text)
    chars = sum(map(len, w))

    def inside(n, keep):
        grams = [tuple(w[i : i + n]) for i in range(len(w) - n + 1)]
        count = Counter(grams)
        flag = [False] * len(w)
        for i, g in enumerate(grams):
            if keep(g, count):
                flag[i : i + n] = [True] * n
        return flag

    rep = {n: inside(n, lambda g, c: c[g] > 1) for n in range(2, 11)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return {
        "n_words": len(w), "word_chars": chars, "n_symbols": len(re.findall("[#*$%&|<>]", text)), "n_dup_lines": dup,
        "n_repeat_words": sum(rep[3]),
        "covered": [sum(len(x) for x, f in zip(w, rep[n]) if f) / max(1, chars) for n in range(5, 11)],
    }


def texts():
    rng = random.Random(2)
    out = [None, "", " \n\t ", "one", "a b a b a b a b", "é ü é ü é ü #|<", "x\nx\n\nx y\n x y\nx"]
    for size in (3, 8, 200):
        for _ in range(15):
            words = [rng.choice("abcdefgh") + str(rng.randrange(size)) for _ in range(rng.randrange(1, 150))]
            out.append("".join(x + rng.choice([" ", "\n", "  "]) for x in words))
    out.append("\n".join(["the same line again and again"] * 30))
    out.append(" ".join(f"w{i % 9000}" for i in range(60_000)))
    return out


def test_against_plain_count(spark):
    rows = [(i, t) for i, t in enumerate(texts())] + [(3, "one"), (None, "one")]
    got = R.repetition(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows)
    for r in got:
        want, m = plain(r["text"]), r["repetition"]
        for key in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"):
            assert m[key] == want[key], (key, r["text"])
        assert m["covered"] == pytest.approx(want["covered"])


def test_verdicts(spark):
    rng = random.Random(9)
    clean = " ".join(f"w{rng.randrange(500)}" for _ in range(300))
    looped = " ".join(["buy the best thing right now here"] * 10 + [f"w{rng.randrange(500)}" for _ in range(80)])
    rows = [(1, clean), (2, looped), (3, "too short"), (4, "\n".join([clean[:60], "menu a b"] * 2 + [clean])), (5, None)]
    df = R.repetition(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r[0]: (r[1], r[2]) for r in df.select("doc_id", R.base_failed(), R.repetitive()).collect()}
    assert got[1] == (False, False) and got[2][1] and got[3][0] and got[5][0] and not got[4][0]


def test_empty_table_and_clashing_columns(spark):
    assert R.repetition(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    df = spark.createDataFrame([(1, "a b", "z", 3)], "doc_id long, text string, _text_bytes string, n_words long")
    assert R.repetition(df).columns == [*df.columns, "repetition"]
