"""Personal data: strict matches against the patterns themselves, reliabilities against planted ones."""

import random
import re

import numpy as np

from snapdiff.llm import pii
from snapdiff.llm.queries import op12_personal_data


def luhn_ok(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) if i % 2 == 0 else int(c) * 2
        total += n if n < 10 else n - 9
    return total % 10 == 0


def brute(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = {"email": [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]}
    out["ip"] = [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    out["card"] = [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 16 <= len(digits(m.group())) <= 19 and luhn_ok(digits(m.group()))]
    out["phone"] = [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(digits(m.group())) <= 15]
    return out


def texts():
    rng = random.Random(8)
    bits = ["a", "Z", "é", "@", "@", ".", ".", "-", "+", "+1", "0", "7", "12", "255", "256", "1.2.3.4", "+1 (555) 010-2233", "4539578763621486", " ", " ", "(", ")",
            "x.y@z.org", "a@b.c@d.e", "token = \"0b96a8c8d79c4a5085c919698889f59b72ab7bb6\"", "\n", "_", "%", "٣", "4539 5787 6362 1486", "name (at) host (dot) com"]
    out = ["".join(rng.choice(bits) for _ in range(rng.randrange(0, 40))) for _ in range(3000)]
    return out + ["", "1" * 50_000, "a" * 50_000 + "@", "1." * 20_000 + "1", "+1" + " " * 20_000, "é a@b.co\x00 1.2.3.4.5.6.7.8 256.1.1.1"]


def test_strict_matches_are_the_patterns():
    for text in texts():
        if len(text) < 20_000 or "@" not in text:  # the plain pattern is slow on long runs
            assert {k: v for k, v in pii.strict_spans(text).items()} == brute(text) if len(text) < 1000 else pii.strict_spans(text)
        found = pii.candidates(text)
        assert [(k, a, b) for k, a, b, s in found if s] == sorted(
            ((k, a, b) for k, v in pii.strict_spans(text).items() for a, b in v), key=lambda c: (c[1], c[2], pii.KINDS.index(c[0])))
        strict = [(a, b) for _, a, b, s in found if s]
        assert all(b <= x or y <= a for _, a, b, s in found if not s for x, y in strict)


def test_reliabilities_of_planted_labelers():
    rng = np.random.Generator(np.random.PCG64(4))
    right = np.array([0.95, 0.9, 0.8, 0.7, 0.6])
    truth = rng.random(40_000) < 0.4
    votes = np.where((rng.random((40_000, 5)) < right) == truth[:, None], 1, -1)
    votes[rng.random((40_000, 5)) < 0.2] = 0
    patterns, which, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    chance, share, post = pii.reliabilities([tuple(p) for p in patterns], counts.tolist())
    assert abs(share - 0.4) < 0.02
    told = chance[0, :, 2] / (chance[0, :, 2] + chance[0, :, 0])
    assert np.abs(told - right).max() < 0.03
    assert ((post[which.ravel()] > 0.5) == truth).mean() > ((votes.sum(axis=1) > 0) == truth).mean()


def test_the_method_adds_spans(spark):
    rng = random.Random(6)
    rows, planted = [], {}
    for i in range(300):
        word = " ".join(rng.choice(["the", "of", "and", "tion", "er"]) for _ in range(12))
        secret = "".join(rng.choice("0123456789abcdef") for _ in range(40))
        text = rng.choice([f'{word} token = "{secret}" {word}', f"{word} x.{i}@mail.example.com {word}", f"{word} {rng.randrange(10**6, 10**7)} {word}", word])
        rows.append((i, text))
        if secret in text:
            planted[i] = f"secret:{text.index(secret)}:{text.index(secret) + 40}"
    rows += [(400, None), (401, ""), (402, "x " * 200_000 + "a@b.co"), rows[0], (None, "1.2.3.4")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "1 AS spans")
    found = pii.personal_data(df).collect()
    assert found[0].asDict().keys() == {"doc_id", "text", "spans", "spans_"} and len(found) == len(rows)
    for r in found:
        told = [f"{s['kind']}:{s['start']}:{s['end']}" for s in r["spans_"]]
        base = brute(r["text"] or "")
        assert [t for t, s in zip(told, r["spans_"]) if s["strict"]] == [f"{k}:{a}:{b}" for k in pii.BASE_KINDS for a, b in base[k]]
        if r["doc_id"] in planted:
            assert planted[r["doc_id"]] in told
        elif r["text"] and re.search("[0-9]{7}", r["text"]) and r["doc_id"] != 402 and "@" not in r["text"]:
            assert told == []  # a bare number is not personal data


def test_empty(spark):
    assert pii.personal_data(spark.createDataFrame([], "text string")).count() == 0
    assert [r["spans"] for r in pii.personal_data(spark.createDataFrame([(None,)], "text string")).collect()] == [[]]


def test_query_agrees_with_the_patterns(spark):
    import hashlib

    from conftest import SF_SMALL

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for r in op12_personal_data(spark, SF_SMALL).collect():
        base = brute(docs[r["doc_id"]] or "")
        told = ",".join(f"{k}:{a}:{b}" for k in pii.BASE_KINDS for a, b in base[k])
        assert r["base_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.BASE_KINDS] == [len(base[k]) for k in pii.BASE_KINDS]
        assert set(filter(None, told.split(","))) <= set(r["spans"].split(","))
