"""Documents in stored chunks, and blobs of numbers exchanged between chunks and buckets."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapdiff.llm.text import as_bytes
from snapdiff.session import scratch_path


def write_chunks(docs: DataFrame, size: int, id_col: str = "doc_id", text: str = "text", flag: Column | None = None) -> DataFrame:
    """``chunk, ids, flags, sizes, data``: rows together, up to ``size`` bytes (a longer text alone).

    Inside a chunk rows are ordered by id (nulls first) and text. ``data`` is
    the compressed UTF-8 of the texts (null: empty). The chunks are a written
    table, so every pass sees the same ones after a task is run again.
    """
    spark = docs.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, flags, texts in in_chunks(batches, size):
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids], pa.list_(pa.int64())), pa.array([flags], pa.list_(pa.bool_())),
                 pa.array([list(map(len, texts))], pa.list_(pa.int64())),
                 pa.array([pa.Codec("zstd").compress(b"".join(texts), asbytes=True)], pa.binary())], names=["ids", "flags", "sizes", "data"])

    made = chunk_rows(docs, id_col, text, flag).mapInArrow(run, "ids array<long>, flags array<boolean>, sizes array<long>, data binary")
    path = scratch_path(spark, "chunks")
    made.withColumn("chunk", F.monotonically_increasing_id()).write.option("compression", "none").parquet(path)
    return spark.read.parquet(path)


def chunk_rows(docs: DataFrame, id_col: str, text: str, flag: Column | None = None) -> DataFrame:
    """``id, flag, text`` (UTF-8) as :func:`in_chunks` takes them."""
    flag = F.lit(True) if flag is None else flag
    return docs.select(F.col(id_col).cast("long").alias("id"), flag.alias("flag"), as_bytes(text).alias("text"))


def in_chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[list, list[bool], list[bytes]]]:
    """Ids, flags and texts of each chunk, ordered by id (nulls first) and text."""
    held: list[tuple] = []
    total = 0

    def out() -> tuple[list, list[bool], list[bytes]]:
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
        return [r[0] for r in held], [r[1] for r in held], [r[2] for r in held]

    for i, f, t in rows_of(batches):
        t = t or b""
        if held and total + len(t) > size:
            yield out()
            held, total = [], 0
        held.append((i, bool(f), t))
        total += len(t)
    if held:
        yield out()


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows one at a time: a batch of blobs is not copied whole."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in batch.columns)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, which gives the memory it freed back to the system when its task ends. Workers serve
    many steps, and what the allocators keep of each would add up beside the executor's heap."""

    @wraps(run)
    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
        if trim:
            trim(0)

    return out


def bucketed(df: DataFrame, name: str, key: str, compression: str) -> DataFrame:
    """``df`` written once to the shared folder as a table of as many buckets by ``key`` as there
    are shuffle partitions, so that joins and groups by ``key`` read it without a shuffle.

    The catalog names the table only while it is made; its files stay until the folder is emptied."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").bucketBy(n, key).option("path", path).option("compression", compression).saveAsTable(table)
    made = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return made


def texts_of(sizes: list[int], data: bytes) -> list[bytes]:
    whole = pa.Codec("zstd").decompress(data, sum(sizes), asbytes=True)
    ends = np.cumsum(sizes).tolist()
    return [whole[e - n : e] for e, n in zip(ends, sizes)]


def dealt(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, row numbers) in bucket order."""
    # 16 bits are sorted by radix
    order = np.argsort(bucket.astype(np.uint16) if bucket.max(initial=0) < 1 << 16 else bucket, kind="stable")
    ranked = bucket[order]
    cut = np.flatnonzero(np.diff(ranked)) + 1
    for rows in np.split(order, cut) if len(order) else []:
        yield int(bucket[rows[0]]), rows


def gathered(bucket: np.ndarray, answers: list[dict] | None, kind) -> np.ndarray:
    """The answers to records that went out by :func:`dealt`, in the records' order."""
    out = np.zeros(len(bucket), kind)
    told = {a["bucket"]: a["answer"] for a in answers or []}
    for b, rows in dealt(bucket):
        out[rows] = np.frombuffer(told[b], kind)
    return out


def by_bucket(sent: DataFrame, columns: list[str], answer: Callable[[list[tuple]], Iterator[tuple[int, bytes]]]) -> DataFrame:
    """``chunk, answers`` (array of bucket, answer) from rows that begin with ``bucket, chunk``.

    There are as many buckets as shuffle partitions, so a bucket is a
    partition's share of the data. ``answer`` gets a bucket's rows, by chunk,
    and yields (chunk, answer).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def out() -> pa.RecordBatch:
            found = list(answer(held))
            return pa.RecordBatch.from_arrays(
                [pa.array([c for c, _ in found], pa.int64()), pa.array([held[0][0]] * len(found), pa.int32()),
                 pa.array([a for _, a in found], pa.binary())], names=["chunk", "bucket", "answer"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0][0] != row[0]:
                    yield out()
                    held = []
                held.append(row)
        if held:
            yield out()

    n = int(sent.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = sent.select(*columns).repartition(n, "bucket").sortWithinPartitions("bucket", "chunk")
    return rows.mapInArrow(lean(run), "chunk long, bucket int, answer binary")


def by_chunk(answers: DataFrame) -> DataFrame:
    return answers.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "answer")).alias("answers"))
