"""The language stage without a labelled row: the same documents stay as with one."""

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
TEXTS = [None, "", "123 ...", "\n", "a", "12 été", "日本", "5 Ж", "the quick brown fox"]


def kept(spark, lang):
    rows = [(i, t, lang, "s", len(t or "")) for i, t in enumerate(TEXTS * 3)]
    out = corpus_pipeline.identify_language(spark, spark.createDataFrame(rows, SCHEMA), "")
    assert out.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    return sorted(map(tuple, (r[:2] for r in out.collect())))


def test_same_documents_with_and_without_labels(spark):
    want = sorted((i, t) for i, t in enumerate(TEXTS * 3) if t and any(map(str.isalpha, t)))
    assert kept(spark, "en") == want
    assert kept(spark, None) == want
