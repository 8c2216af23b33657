"""The pipeline against the brute-force versions of its stages, one after another."""

import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
import test_decontam
import test_lines
import test_near

TOK = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def tables(spark, path):
    rng = random.Random(12)
    word = lambda: rng.choice(["the", "and", "Tion", "ing", "or", "über"]) + str(rng.randrange(300))
    items = [(i, " ".join(word() for _ in range(25))) for i in range(6)]
    docs = []
    for i in range(160):
        text = "\n".join(" ".join(word() for _ in range(rng.randrange(5, 60))) for _ in range(rng.randrange(1, 4)))
        if rng.random() < 0.4:
            text += f"\nmenu of src{i % 3}"
        if rng.random() < 0.15:
            text += "\n" + rng.choice(items)[1]
        docs.append((i, text, rng.choice(["en", "de"]), f"src{i % 3}"))
    docs += [(200 + i, t.replace("the", "The"), "en", s) for i, (_, t, _, s) in enumerate(docs[:25])]
    docs += [(300, None, "en", "src0"), (301, "", "en", "src0"), (302, "123 ...", "de", None), (303, "menu of src0", "en", "src0"),
             (304, " ".join(f"w{k}" for k in range(6000)), "en", "src1")]
    docs = [(i, t, lang, s, len(t or "")) for i, t, lang, s in docs]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return docs, items


def test_against_brute_force(spark, tmp_path):
    docs, items = tables(spark, str(tmp_path))
    kept = [(i, t, s) for i, t, _, s, _ in docs if t and any(c.isalpha() for c in t)]
    kept = [(i, t, s) for i, t, s, _, _ in test_lines.brute(kept, 0.05, 5)]
    component = test_near.brute([(i, t) for i, t, _ in kept])
    before = len(kept)
    kept = [(i, t) for i, t, _ in kept if component[i] == i]
    bad = {r[0] for r in test_decontam.brute(kept, items) if r[4]}
    assert bad and len(kept) <= before - 20  # the fixture has copies and hits
    want = []
    for i, t in kept:
        if i not in bad:
            ids = TOK.encode(t, add_special_tokens=False).ids + [0]
            for k in range(0, len(ids), 2048):
                part = np.array(ids[k : k + 2048], "<u4")
                want.append((i, k // 2048, k, len(part), zlib.crc32(part.tobytes())))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted(want)
    ends = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 2048


def test_stages_keep_the_columns_and_empty_tables(spark, tmp_path):
    tables(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == 0


def test_null_languages_are_told(spark):
    rng = random.Random(2)
    text = lambda ws: " ".join(rng.choice(ws) for _ in range(40))
    known = [(i, text(["the", "and", "of"]), "en") for i in range(60)] + [(100 + i, text(["und", "der", "zu"]), "de") for i in range(60)]
    asked = [(300, text(["the", "and", "of"]), None), (301, text(["und", "der", "zu"]), None), (302, "12", None), (303, "of the", "de")]
    docs = spark.createDataFrame([(i, t, lang, "s", len(t)) for i, t, lang in known + asked],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    out = {r["doc_id"]: r["lang"] for r in corpus_pipeline.identify_language(spark, docs, "").collect()}
    assert out == {**{i: lang for i, _, lang in known}, 300: "en", 301: "de", 303: "de"}
