"""License scan against a plain scan, and the plan."""

import random
import re

from snapdiff.llm import licenses as L

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(doc_id, text):
    w = words(text)
    places = []
    for phrase, label in L.PHRASES.items():
        p = phrase.split(" ")
        places += [(i, label) for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
    blocks = [[]]
    for line in (text or "").split("\n"):
        if words(line):
            blocks[-1] += words(line)
        else:
            blocks.append([])
    step = max(len(words(t)) for _, t, _ in L.TEMPLATES)
    best = {}
    for block in blocks:
        for start in range(0, len(block), step):
            have = set(block[start : start + 2 * step])
            met = []
            for label, t, must in L.TEMPLATES:
                mine = set(words(t))
                if set(must) <= have and 10 * len(mine & have) >= 8 * len(mine):
                    met.append((label, set(must), len(mine & have) / len(mine)))
            for label, must, share in met:
                if not any(must < other for _, other, _ in met):
                    best[label] = max(best.get(label, 0), share)
    base = sorted({label for _, label in places})
    at = [i for i, _ in places]
    return (doc_id, len(w), len(places), min(at, default=None), max(at, default=None), base, sorted({*base, *best}),
            1.0 if places else max(best.values(), default=0.0))


def rows():
    rng = random.Random(4)
    filler = ["the", "under", "of", "a", "license", "été", "version", "work", "public", "rights", "and", "zoo", "2"]
    out = [(1, None), (2, ""), (3, " .\n"), (4, "Under the MIT License under the mit-license"), (5, "ALL. Rights\nreserved"),
           (6, "all rights reserved"), (7, "cc by nc cc by nc"), (8, "é apache license, version 2.0"), (8, "apache license version 3"),
           (9, "All\nrights\n\nreserved"), (10, "All\n * rights\n*\nreserved"), (11, "\n\n all \n\trights -- \n reserved\n \n"),
           (12, "under the mİt license, released \u212a under the MIT"), (13, "GNU lesser general public license 3, this work is licensed under version")]
    for i in range(120):
        lines = []
        for _ in range(rng.randrange(1, 5)):
            body = [rng.choice(filler) for _ in range(rng.randrange(0, 8))]
            if rng.random() < 0.6:
                t = rng.choice(L.TEMPLATES)[1].split(" ")
                t = [x + ("\n" if rng.random() < 0.1 else "") for x in t]
                t = [x for x in t if rng.random() > rng.choice([0, 0.15, 0.3])]
                body += t if rng.random() < 0.7 else rng.sample(t, len(t))
            if rng.random() < 0.2:
                body.append(rng.choice(list(L.PHRASES)).upper())
            lines.append(rng.choice([" ", ", ", "  "]).join(body))
        out.append((100 + i, "\n".join(lines)))
    out += [out[20], out[21], (None, "cc by nc"), (999, "zoo " * 50_000 + "cc by nc " + "é " * 1000)]
    return out


def got(spark, data):
    df = L.scan_licenses(spark.createDataFrame(data, "doc_id long, text string"))
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_against_plain_scan(spark):
    data = rows()
    assert got(spark, data) == sorted((brute(*r) for r in data), key=repr)


BSD = """Copyright X. All rights kept.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following holds."""


def test_labels_name_the_license(spark):
    probes = {
        "Released under the BSD License.": [],
        "Licensed under CC BY 4.0": [],
        "This work is licensed under the GNU General Public License, version 2.": [],
        BSD: ["bsd"],
        "# " + BSD.replace("\n", "\n# "): ["bsd"],
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": ["cc-by-sa"],
        "This work is licensed under a Creative Commons Attribution 4.0 International License.": ["cc-by"],
        "This work is licensed under the GNU Lesser General Public License, version 3.": ["lgpl-3"],
        "This work is licensed under the GNU Affero General Public License, version 3.": ["agpl-3"],
        "This work is licensed under the GNU General Public License, version 3.": ["gpl-3"],
        "Released under the MIT License.": ["mit"],
    }
    df = L.scan_licenses(spark.createDataFrame(list(enumerate(probes)), "doc_id long, text string"))
    assert {r["doc_id"]: r["labels"] for r in df.collect()} == dict(enumerate(probes.values()))


def test_phrases_that_overlap_themselves(spark):
    df = L.scan_licenses(spark.createDataFrame([(1, "a b a b a, x A-b-a"), (2, "a b")], "doc_id long, text string"), phrases={"a b a": "x"})
    assert sorted((r["doc_id"], r["n_base"], r["first_word"], r["last_word"]) for r in df.collect()) == [(1, 3, 0, 6), (2, 0, None, None)]


def test_clashing_columns(spark):
    data = [(1, "cc by nc", "x", 2)]
    df = L.scan_licenses(spark.createDataFrame(data, "doc_id long, text string, _windows string, n_words int"))
    assert [tuple(r) for r in df.collect()] == [brute(1, "cc by nc")]


def test_empty_table(spark):
    assert got(spark, []) == []


def test_no_python_in_the_plan(spark):
    df = L.scan_licenses(spark.createDataFrame(rows(), "doc_id long, text string"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
