"""Language identification by a byte convolutional network, trained and applied in numpy."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapdiff.llm.text import as_bytes, free_names, pieces

#: Bytes of a window; a text is scored over all its windows.
WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 12
EMBED = 8
#: Training sample: at most so many documents of each language, and so many windows of each document.
TRAIN_DOCS = 1000
TRAIN_WINDOWS = 3
EPOCHS = 4
UNKNOWN = "und"
_ASCII_LETTER = re.compile(rb"[A-Za-z]").search
#: Windows convolved at once.
BLOCK = 256


class ByteNet:
    """Byte embedding, filters of several widths, max pooling over a window, softmax."""

    def __init__(self, languages: list[str], seed: int = 7):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.languages = languages
        span, out = max(WIDTHS), FILTERS * len(WIDTHS)
        self.embed = rng.normal(0, 0.5, (256, EMBED)).astype(np.float32)
        # one matrix for all widths: a narrow filter is zero beyond its width
        self.mask = np.zeros((span * EMBED, out), np.float32)
        for k, width in enumerate(WIDTHS):
            self.mask[: width * EMBED, k * FILTERS : (k + 1) * FILTERS] = 1
        self.conv = (rng.normal(0, 0.25, self.mask.shape) * self.mask).astype(np.float32)
        self.bias = np.zeros(out, np.float32)
        self.dense = rng.normal(0, 0.2, (out, len(languages))).astype(np.float32)
        self.shift = np.zeros(len(languages), np.float32)

    def _columns(self, x: np.ndarray) -> np.ndarray:
        span = max(WIDTHS)
        e = self.embed[x]  # windows, bytes, EMBED
        n = x.shape[1] - span + 1
        return np.concatenate([e[:, i : i + n] for i in range(span)], axis=2)

    def forward(self, x: np.ndarray, train: bool = False) -> tuple[np.ndarray, tuple]:
        columns = self._columns(x)
        maps = columns.reshape(-1, columns.shape[2]) @ self.conv
        maps = maps.reshape(len(x), -1, maps.shape[1])
        top = maps.argmax(axis=1) if train else None
        peak = np.maximum(maps.max(axis=1) + self.bias, 0)
        z = peak @ self.dense + self.shift
        z -= z.max(axis=1, keepdims=True)
        p = np.exp(z)
        return p / p.sum(axis=1, keepdims=True), (columns, top, peak)

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, batch: int = 64, seed: int = 11) -> None:
        """Adam on the cross-entropy; ``x``: windows of bytes, ``y``: class numbers."""
        rng = np.random.Generator(np.random.PCG64(seed))
        params = ["embed", "conv", "bias", "dense", "shift"]
        m = {k: np.zeros_like(getattr(self, k)) for k in params}
        v = {k: np.zeros_like(getattr(self, k)) for k in params}
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for lo in range(0, len(order), batch):
                rows = order[lo : lo + batch]
                xs, ys = x[rows], y[rows]
                p, (columns, top, peak) = self.forward(xs, train=True)
                d = p.copy()
                d[np.arange(len(rows)), ys] -= 1
                d /= len(rows)
                up = (d @ self.dense.T) * (peak > 0)
                g = {"dense": peak.T @ d, "shift": d.sum(0), "bias": up.sum(0)}
                at = columns[np.arange(len(rows))[:, None], top]  # rows, filters, span * EMBED
                g["conv"] = np.einsum("rf,rfk->kf", up, at) * self.mask
                back = up[:, :, None] * self.conv.T[None]  # rows, filters, span * EMBED
                grad = np.zeros_like(self.embed)
                for i in range(max(WIDTHS)):
                    byte = xs[np.arange(len(rows))[:, None], top + i]
                    np.add.at(grad, byte, back[:, :, i * EMBED : (i + 1) * EMBED])
                g["embed"] = grad
                step += 1
                for k in params:
                    m[k] = 0.9 * m[k] + 0.1 * g[k]
                    v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                    rate = 0.01 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                    setattr(self, k, (getattr(self, k) - rate * m[k] / (np.sqrt(v[k]) + 1e-8)).astype(np.float32))

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        """Mean of the window probabilities of each text, by the windows' bytes."""
        n = np.array([-(-len(t) // WINDOW) for t in texts], dtype=np.int64)
        out = np.zeros((len(texts), len(self.languages)))
        if not n.sum():
            return out
        padded = b"".join(t.ljust(int(k) * WINDOW, b" ") for t, k in zip(texts, n))
        x = np.frombuffer(padded, np.uint8).reshape(-1, WINDOW)
        p = np.concatenate([self.forward(x[lo : lo + BLOCK])[0] for lo in range(0, len(x), BLOCK)])
        last = np.cumsum(n) - 1
        weight = np.full(len(x), float(WINDOW))
        some = n > 0
        weight[last[some]] = [len(t) - (k - 1) * WINDOW for t, k in zip(texts, n.tolist()) if k]
        first = (np.cumsum(n) - n)[some]
        total = np.add.reduceat(p * weight[:, None], first, axis=0)
        out[some] = total / np.add.reduceat(weight, first)[:, None]
        return out


def train(labelled: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang",
          per_language: int = TRAIN_DOCS) -> ByteNet | None:
    """A network from a bounded sample of labelled rows (None if there are none).

    The sample is ``per_language`` documents of each language, the least by a
    hash of the id, and ``TRAIN_WINDOWS`` windows of each, evenly spaced; this
    is all that reaches the driver. Rows with null text or language are left
    out. Language counts thin the rows where they are read, so no language
    brings more than about twice ``per_language`` rows to one task.
    """
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & (F.length("text") > 0))
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()  # a row for each language
    if not counts:
        return None
    size = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], r["n"])])
    own = F.coalesce(F.col("id").cast("string"), "text")  # rows without an id are drawn by their text
    draw = F.pmod(F.xxhash64(own), F.lit(1 << 30)) / F.lit(float(1 << 30))
    long = F.octet_length("text")
    windows = F.transform(
        F.sequence(F.lit(0), F.lit(TRAIN_WINDOWS - 1)),
        lambda i: F.substring(F.col("text").cast("binary"),
                              F.lit(1) + F.floor(i * F.greatest(long - WINDOW, F.lit(0)) / max(1, TRAIN_WINDOWS - 1)).cast("int"),
                              F.lit(WINDOW)),
    )
    thin = rows.withColumn("draw", draw).where(F.col("draw") * size[F.col("lang")] < 2 * per_language + 20)
    thin = thin.select("lang", "draw", "id", windows.alias("windows"))
    by_lang = Window.partitionBy("lang").orderBy("draw", "id", "windows")
    sample = (thin.withColumn("rank", F.row_number().over(by_lang)).where(F.col("rank") <= per_language)
              .select("lang", "rank", "windows").collect())
    if not sample:
        return None
    sample.sort(key=lambda r: (r["lang"], r["rank"]))
    languages = sorted({r["lang"] for r in sample})
    number = {k: i for i, k in enumerate(languages)}
    x, y = [], []
    for r in sample:
        for w in dict.fromkeys(map(bytes, r["windows"])):
            x.append(w.ljust(WINDOW, b" "))
            y.append(number[r["lang"]])
    net = ByteNet(languages)
    net.fit(np.frombuffer(b"".join(x), np.uint8).reshape(-1, WINDOW), np.array(y))
    return net


def has_letter(text: bytes | None) -> bool:
    """Whether a text has a letter of any script."""
    return text is not None and (_ASCII_LETTER(text) is not None or any(map(str.isalpha, text.decode("utf-8", "replace"))))


def with_letters(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text has a letter: those :func:`predict` can tell a language of."""
    (body,) = free_names(docs, "_text_bytes")
    columns = docs.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = pa.array([has_letter(t) for t in batch.column(len(columns)).to_pylist()], pa.bool_())
            yield pa.RecordBatch.from_arrays(batch.columns[: len(columns)], names=columns).filter(keep)

    return docs.select(*[F.col(f"`{c}`") for c in columns], as_bytes(text).alias(body)).mapInArrow(run, schema)


def predict(docs: DataFrame, net: ByteNet | None, text: str = "text",
            out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the predicted language of the whole text and its mean probability.

    Null texts and texts without a letter (any script) get ``und`` with score
    0, and so does every text if there was nothing to learn from. Only the text
    is read; rows and their order inside partitions are kept. The two new
    names must be free in ``docs``.
    """
    (body,) = free_names(docs, "_text_bytes")
    columns = docs.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    names = [*columns, *out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(columns)).to_pylist()
            lang, score = [], []
            for _, held in pieces(texts):
                if net is None:
                    lang += [UNKNOWN] * len(held)
                    score += [0.0] * len(held)
                    continue
                p = net.probabilities(held)
                for t, k, s in zip(held, p.argmax(axis=1).tolist(), p.max(axis=1).tolist()):
                    known = has_letter(t)
                    lang.append(net.languages[k] if known else UNKNOWN)
                    score.append(min(1.0, s) if known else 0.0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(columns)], pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=names
            )

    return docs.select(*[F.col(f"`{c}`") for c in columns], as_bytes(text).alias(body)).mapInArrow(
        run, f"{schema}, `{out[0]}` string, `{out[1]}` double")
