"""Training-corpus pipeline: language ID, line dedup, near-dedup, decontamination, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame. :func:`run`
writes each stage's result as Parquet into the shared folder and reads it back
as the next stage's ``docs``, so a lost executor repeats tasks of one stage at
most. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapdiff.llm import decontam, language, lines, near, packing
from snapdiff.llm.queries import tokenizer_path
from snapdiff.llm.text import crc_mod, free_names
from snapdiff.session import scratch_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with an identified language: those that get ``und`` (null or
    without a letter) are rejected, and a null ``lang`` becomes the predicted one.
    The network learns from the labelled rows of this stage's input whose
    crc32(doc_id) mod 3 is not 1; without any such row no language can be told,
    and all documents with a letter stay as they are."""
    net = language.train(docs.where(crc_mod("doc_id", 3) != 1))
    if net is None:
        return language.with_letters(docs)
    lang, score = free_names(docs, "_lang_pred", "_lang_score")
    found = language.predict(docs, net, out=(lang, score))
    told = found.where(F.col(lang) != language.UNKNOWN)
    return told.withColumn("lang", F.coalesce("lang", F.col(lang))).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the boilerplate lines of their source; ``n_chars`` follows the text.

    Exact copies count as one page: a document repeated in its source is not
    boilerplate, and the next stage keeps one of its copies."""
    cut = lines.dedup_lines(docs, copies_once=True)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of at most 2048 tokens."""
    found = packing.tokenize_pieces(docs, tokenizer_path())
    return packing.pack(found.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_near),
    ("decontamination", decontaminate),
    ("packing", pack),
]

#: No SQL: the network, the sketches and the packing order are not SQL-expressible.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
