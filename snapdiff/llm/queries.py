"""One query for each dealt operator, over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapdiff.llm import chat, decontam, language, licenses, lines, near, negatives, packing, phrases, pii, pitman_yor, repetition, suffix
from snapdiff.llm.text import crc_mod


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = packing.tokenize_pieces(docs, tokenizer_path())
    found = found.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(found)


def op2_wu_manber_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.find_benchmark(docs, _table(spark, sf_dir, "benchmark")).drop("text")
    found = found.withColumn("n_hit", decontam.n_hit("hit_spans"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "hit_items"), 256).alias("items_sha256"),
        decontam.contaminated(F.col("n_words"), F.col("n_hit")).alias("contaminated"),
    )


def op3_repetition_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repetition.repetition(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    failed = repetition.base_failed()
    return found.select(
        "doc_id", "repetition.n_words", "repetition.word_chars", "repetition.n_symbols", "repetition.n_dup_lines",
        "repetition.n_repeat_words", failed.alias("base_failed"), (~failed & ~repetition.repetitive()).alias("kept"),
        "repetition.covered", "repetition.top",
    )


def op4_pitman_yor_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pitman_yor.score_texts(docs, crc_mod("doc_id", 7) != 2)
    return found.withColumn("held_out", ~F.col("training")).drop("training").withColumn(
        "perplexity", pitman_yor.perplexity(F.col("score"), F.col("n_tokens")))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return lines.dedup_lines(docs, stats=True)


def op6_hyperminhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.withColumns({c: F.concat_ws(",", c) for c in ("base_labels", "labels")})


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", crc_mod("doc_id", 3) == 1)
    net = language.train(docs.where(~F.col("held_out")))
    return language.predict(docs.select("doc_id", "text", "held_out"), net).drop("text")


def op9_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix.repeated_spans(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")], told.schema)
    formatted = chat.format_trees(chat.linear_messages(told.union(own)))
    return chat.read_back(formatted).withColumnRenamed("tree", "conv_id")


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents").select("text", "lang"))


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["strict"])
    of_kind = lambda kind: F.filter(base, lambda s: s["kind"] == kind)
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    counts = {f"n_{k}": F.size(of_kind(k)).cast("long") for k in pii.BASE_KINDS}
    return found.select("doc_id", *[c.alias(n) for n, c in counts.items()], F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", label), F.col("row") % 100 == 0)


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_wu_manber_decontamination": op2_wu_manber_decontamination,
    "op3_repetition_coverage": op3_repetition_coverage,
    "op4_pitman_yor_scores": op4_pitman_yor_scores,
    "op5_line_dedup": op5_line_dedup,
    "op6_hyperminhash_near_dedup": op6_hyperminhash_near_dedup,
    "op7_license_scan": op7_license_scan,
    "op8_language_id": op8_language_id,
    "op9_repeated_bytes": op9_repeated_bytes,
    "op10_chat_formatting": op10_chat_formatting,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_personal_data": op12_personal_data,
    "op13_hard_negatives": op13_hard_negatives,
}
