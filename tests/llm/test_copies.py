"""Exact copies in the pipeline: line dedup must not empty them all."""

import corpus_pipeline
from snapdiff.llm import lines

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows():
    copied = "\n".join(" ".join(f"copied{i}x{k}" for k in range(12)) for i in range(4))
    texts = [(i, f"menu of a\n{' '.join(f'own{i}x{k}' for k in range(20))}", "a") for i in range(99)]
    texts += [(200 + i, copied, "a") for i in range(50)]  # a third of the source
    texts += [(300 + i, copied, None) for i in range(6)] + [(400, None, "a"), (401, None, "a")]
    return copied, [(i, t, "en", s, len(t or "")) for i, t, s in texts]


def test_one_copy_stays_whole(spark, tmp_path):
    copied, data = rows()
    docs = spark.createDataFrame(data, SCHEMA)
    cut = corpus_pipeline.dedup_lines(spark, docs, str(tmp_path)).cache()
    got = {r["doc_id"]: r for r in cut.collect()}
    assert len(got) == len(data)
    assert all(got[i]["text"] == copied and got[i]["n_chars"] == len(copied) for i in [*range(200, 250), *range(300, 306)])
    assert not any("menu of a" in got[i]["text"] for i in range(99))
    kept = corpus_pipeline.dedup_near(spark, cut.where("text is not null"), str(tmp_path)).collect()
    assert [r["doc_id"] for r in kept if r["text"] == copied] == [200]
    assert not any(r["text"] == "" for r in kept)
    cut.unpersist()


def test_counts_of_distinct_pages(spark):
    data = rows()[1] + [(500, "menu of a\nmenu of a", "en", "a", 0), (501, "menu of a\nmenu of a", "en", "a", 0)]
    found = lines.line_frequencies(spark.createDataFrame(data, SCHEMA), copies_once=True).collect()
    counts = {(r["host"], r["pages"], r["host_pages"]) for r in found}
    assert counts == {("a", 100, 102), ("a", 1, 102), (None, 1, 1)}
    # the keys are those of the plain count
    plain = lines.line_frequencies(spark.createDataFrame(data, SCHEMA)).collect()
    assert {(r["host"], r["line_key"]) for r in found} == {(r["host"], r["line_key"]) for r in plain}
