"""Personal data by weak supervision.

1. Candidates: the strict patterns' matches, and looser ones (digit groups, dotted
   numbers, words with an ``@``, quoted tokens) that no strict match covers.
2. Labelers vote on each candidate: yes, no or abstain. Regex labelers look at the
   span, gazetteer labelers at lists of domains, issuers and cue words, context labelers
   at what stands around it.
3. Expectation-maximisation over the counts of vote patterns (all candidates of the
   corpus; at most 3 ** labelers patterns a kind) estimates how reliable each labeler is.
4. A classifier of spans is fitted to the labelers' posterior on a bounded sample and
   decides the candidates that are no strict match.

Strict matches are always reported.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from snapdiff.llm.text import free_names
from snapdiff.session import scratch_path

#: Strict kinds in order, then those that only the method adds to.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")
#: Candidates that the classifier is fitted on, for each vote pattern and for each kind: those of the least hash.
TRAIN_EACH, TRAIN_KIND = 200, 20_000
EM_ROUNDS = 200
FEATURES = 1 << 12
#: A candidate of at least this probability is a span.
ACCEPT = 0.8
#: Characters of context on either side.
AROUND = 24

_EMAIL_TAIL = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# patterns begin with what few places have, and none can fail after a long run
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_MASKED = re.compile(r"(?:\(at\)|\[at\]) ?([A-Za-z0-9-]{1,63}(?:(?:\.| ?(?:\(dot\)|\[dot\]) ?)[A-Za-z0-9-]{1,63})*)")
_NUMBER = re.compile(r"[(0-9][0-9 ().-]{5,40}[0-9]")
_TOKEN = re.compile(r"[0-9][A-Za-z0-9_-]*")
_INSIDE = _LOCAL - frozenset(".%+") | {"_"}

#: Gazetteers: cue words by kind, top-level domains, leading digits of card issuers.
CUES = {
    "email": ("email", "e-mail", "mail", "contact", "correo", "courriel", "kontakt"),
    "ip": ("ip", "host", "server", "address", "adresse", "addr", "ping"),
    "card": ("card", "visa", "mastercard", "credit", "karte", "tarjeta", "carte"),
    "phone": ("phone", "tel", "telephone", "call", "mobile", "fax", "telefon", "llame"),
    "secret": ("token", "key", "secret", "password", "passwd", "bearer", "apikey", "api_key"),
}
DOMAINS = ("com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "info", "eu")
ISSUERS = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65", "35", "36", "30", "38")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def strict_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """The strict matches of each kind: leftmost, not overlapping, failing ones dropped."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in BASE_KINDS}
    at, last = text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        tail = _EMAIL_TAIL.match(text, at + 1) if start < at else None
        if tail:
            out["email"].append((start, tail.end()))
            last = tail.end()
        else:
            last = max(last, at + 1)  # no match holds this sign; a later local part starts behind it
        at = text.find("@", max(at + 1, last if tail else 0))
    for m in _DOTTED.finditer(text):
        parts = m.group().split(".") if m.end() - m.start() >= 7 else []
        at = m.start()
        for i in range(0, len(parts) - 3, 4):  # four parts a match, the next begins behind it
            four = parts[i : i + 4]
            size = sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                out["ip"].append((at, at + size))
            at += size + 1
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _digits(m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                out["card"].append(m.span())
    out["phone"] = [m.span() for m in _PHONE.finditer(text) if 8 <= len(_digits(m.group())) <= 15]
    return out


def _loose(text: str) -> Iterator[tuple[str, int, int]]:
    """What might be personal data and is no strict match; may overlap."""
    for m in _MASKED.finditer(text):
        start = m.start() - (text[m.start() - 1 : m.start()] == " ")
        first = start
        while first > max(0, start - 64) and text[first - 1] in _LOCAL:
            first -= 1
        if first < start:
            yield "email", first, m.end()
    at = text.find("@")
    while at >= 0:  # addresses without a dot in their domain
        first, last = at, at + 1
        while first > max(0, at - 64) and text[first - 1] in _LOCAL:
            first -= 1
        while last < min(len(text), at + 64) and text[last] in _LOCAL:
            last += 1
        if first < at and last > at + 1:
            yield "email", first, last
        at = text.find("@", at + 1)
    for m in _NUMBER.finditer(text):
        a, b = m.span()
        while text[a] in "( " and ")" not in text[a:b]:
            a += 1
        n = len(_digits(text[a:b]))
        if 7 <= n <= 19 and not text[a - 1 : a].isalnum() and not text[b : b + 1].isalnum():
            yield "ip" if text.count(".", a, b) == 3 and n <= 12 else "card" if n >= 13 else "phone", a, b
    last = 0
    for m in _TOKEN.finditer(text):
        first = m.start()
        while first > max(last, m.start() - 129) and text[first - 1] in _INSIDE:
            first -= 1
        last = m.end()
        if 20 <= last - first <= 128 and not text[first:last].isdigit():
            yield "secret", first, last


def candidates(text: str) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, strict), in order of start: strict matches, and loose ones that
    touch neither a strict match nor a loose one before them."""
    strict = [(k, a, b, True) for k, spans in strict_spans(text).items() for a, b in spans]
    strict.sort(key=lambda c: c[1:3])
    held, loose, i, reach = sorted(_loose(text), key=lambda c: (c[1], -c[2], c[0])), [], 0, 0
    for kind, a, b in held:
        while i < len(strict) and strict[i][1] < b:
            reach = max(reach, strict[i][2])
            i += 1
        if reach <= a:
            loose.append((kind, a, b, False))
            reach = b
    return sorted(strict + loose, key=lambda c: (c[1], c[2], KINDS.index(c[0])))


def votes(text: str, kind: str, start: int, end: int) -> tuple[int, ...]:
    """One vote of each labeler: 1, -1 or 0 (abstain)."""
    span, before, after = text[start:end], text[max(0, start - AROUND) : start], text[end : end + AROUND]
    digits = _digits(span)
    near = re.findall(r"[a-z_-]+", before.lower())[-3:] + re.findall(r"[a-z_-]+", after.lower())[:1]
    cue = any(w.strip("-_") in CUES[kind] for w in near)
    wrong = any(w.strip("-_") in CUES[k] for w in near for k in KINDS if k != kind)
    if kind == "email":
        shape = 1 if "@" in span and _EMAIL_TAIL.fullmatch(span, span.find("@") + 1) else -1 if "@" not in span else 0
        check = 1 if any(c.isdigit() or c == "." for c in span.split("@")[0]) else 0
        listed = 1 if span.lower().rpartition(".")[2] in DOMAINS else -1
    elif kind == "ip":
        parts = span.split(".")
        fits = len(parts) == 4 and all(p.isdigit() and p.isascii() and int(p) <= 255 for p in parts)
        shape = 1 if fits else -1
        check = -1 if fits and any(len(p) > 1 and p[0] == "0" for p in parts) else 1 if fits else -1
        listed = -1 if span.startswith(("0.", "255.")) else 0
    elif kind == "card":
        shape = 1 if 13 <= len(digits) <= 19 and re.fullmatch(r"[0-9]+|[0-9]{4}([ -][0-9]{1,4}){2,4}", span) else -1
        check = 1 if 12 <= len(digits) <= 19 and luhn(digits) else -1
        listed = 1 if digits.startswith(ISSUERS) else -1
    elif kind == "phone":
        shape = 1 if re.fullmatch(r"\+?[0-9]{0,3} ?\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-]?[0-9]{3,4}", span) else -1
        check = 1 if 8 <= len(digits) <= 15 and not span.isdigit() else -1 if span.isdigit() else 0
        listed = 1 if "555" in span or span.startswith("+") else 0
    else:
        kinds = sum(any(f(c) for c in span) for f in (str.isdigit, str.islower, str.isupper))
        shape = 1 if re.fullmatch(r"[0-9a-f]{32,}|[0-9A-F]{32,}", span) else 0 if kinds >= 2 else -1
        check = 1 if len(set(span)) >= 10 else -1
        listed = -1 if "--" in span or "__" in span else 0
    bounded = 1 if (not before or not before[-1].isalnum()) and (not after or not after[0].isalnum()) else -1
    quoted = 1 if before[-1:] in "\"'=:" and before else 0
    dense = -1 if sum(c.isdigit() for c in before + after) > 8 else 0
    return (shape, check, listed, 1 if cue else 0, -1 if wrong else 0, bounded, quoted, dense)


LABELERS = ("shape", "check", "listed", "cue", "wrong_cue", "bounded", "quoted", "dense")


def reliabilities(patterns: list[tuple[int, ...]], counts: list[int], rounds: int = EM_ROUNDS) -> tuple[np.ndarray, float, np.ndarray]:
    """Expectation-maximisation over vote patterns: (chance of each vote given a yes and given a no
    [2 x labelers x 3], share of yes, posterior of each pattern). Labelers vote
    independently given the truth; the majority starts."""
    v = np.array(patterns, np.int64).reshape(len(patterns), -1) + 1
    n = np.array(counts, np.float64)
    score = (v - 1).sum(axis=1)
    post = 1 / (1 + np.exp(-score.astype(float)))
    one = np.eye(3)[v]  # patterns x labelers x votes
    for _ in range(rounds):
        share = (n @ post + 1) / (n.sum() + 2)
        yes = np.einsum("p,plv->lv", n * post, one) + 1
        no = np.einsum("p,plv->lv", n * (1 - post), one) + 1
        chance = np.stack([yes / yes.sum(axis=1, keepdims=True), no / no.sum(axis=1, keepdims=True)])
        log = np.einsum("plv,klv->kp", one, np.log(chance))
        new = 1 / (1 + np.exp(np.clip(log[1] - log[0] + np.log((1 - share) / share), -500, 500)))
        done = np.abs(new - post).max(initial=0) < 1e-9
        post = new
        if done:
            break
    return chance, float(share), post


def features(text: str, kind: str, start: int, end: int) -> list[int]:
    """Hashed features of a span: its shape and shape trigrams, length, neighbours, words before it."""
    span, before, after = text[start:end], text[max(0, start - AROUND) : start], text[end : end + AROUND]
    shape = re.sub("[A-Z]", "A", re.sub("[a-z]", "a", re.sub("[0-9]", "9", span)))[:64]
    short = re.sub(r"(.)\1+", r"\1+", shape)
    told = [f"kind {kind}", f"short {kind} {short[:24]}", f"length {kind} {min(len(span), 48) // 4}", f"digits {kind} {min(len(_digits(span)), 20)}",
            f"left {kind} {before[-1:]}", f"right {kind} {after[:1]}", f"luhn {kind} {kind == 'card' and luhn(_digits(span) or '1')}",
            f"varied {kind} {min(len(set(span)), 20) // 4}"]
    told += [f"gram {kind} {shape[i : i + 3]}" for i in range(len(shape) - 2)]
    told += [f"word {kind} {w}" for w in re.findall(r"[a-z_-]+", before.lower())[-2:]]
    return sorted({xxhash.xxh32_intdigest(x.encode()) % FEATURES for x in told})


def fit(rows: list[list[int]], target: np.ndarray, weight: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Logistic regression on hashed features and probable labels; the last entry is the offset."""
    w = np.zeros(FEATURES + 1)
    if not rows:
        return w
    at = np.repeat(np.arange(len(rows)), [len(r) + 1 for r in rows])
    col = np.concatenate([np.array([*r, FEATURES]) for r in rows])
    weight = weight / weight.sum()
    size, first, second = 1.0, np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):  # full-batch Adam
        p = 1 / (1 + np.exp(-np.clip(np.bincount(at, w[col], len(rows)), -50, 50)))
        slope = np.bincount(col, (weight * (p - target))[at], FEATURES + 1) + 1e-5 * w
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        w -= 0.1 * size * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-9)
    return w


def probability(w: np.ndarray, row: list[int]) -> float:
    return float(1 / (1 + np.exp(-np.clip(w[row].sum() + w[-1], -50, 50))))


def span_candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """``kind, strict, votes`` (text) and ``features`` of every candidate."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in batch.column(0).to_pylist():
                for kind, a, b, strict in candidates(x or ""):
                    out.append((kind, strict, ",".join(map(str, votes(x, kind, a, b))), features(x, kind, a, b)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([t[0] for t in out], pa.string()), pa.array([t[1] for t in out], pa.bool_()),
                 pa.array([t[2] for t in out], pa.string()), pa.array([t[3] for t in out], pa.list_(pa.int32()))],
                names=["kind", "strict", "votes", "features"])

    return docs.select(F.col(text).cast("string").alias("text")).mapInArrow(
        run, "kind string, strict boolean, votes string, features array<int>")


class Model:
    """Reliabilities by kind (share of yes, chance of each vote) and the classifier's weights."""

    def __init__(self, reliability: dict[str, tuple[np.ndarray, float]], weights: np.ndarray):
        self.reliability, self.weights = reliability, weights

    def accepts(self, text: str, kind: str, start: int, end: int) -> bool:
        return kind in self.reliability and probability(self.weights, features(text, kind, start, end)) >= ACCEPT


def train(docs: DataFrame, text: str = "text", each: int = TRAIN_EACH, most: int = TRAIN_KIND) -> Model:
    """Reliabilities from the vote patterns of all candidates; the classifier from a sample of
    up to ``each`` candidates of every vote pattern and ``most`` of a kind, weighted by the pattern's count."""
    found = span_candidates(docs, text)
    path = scratch_path(docs.sparkSession, "pii-candidates")
    found.write.parquet(path)
    found = docs.sparkSession.read.parquet(path)
    # at most 3 ** labelers patterns a kind, whatever the corpus
    told = found.groupBy("kind", "votes").agg(F.count(F.lit(1)).alias("n")).collect()
    least = found.select("kind", "votes", "features", F.xxhash64("features").alias("h")).distinct()
    by = F.row_number().over(Window.partitionBy("kind", "votes").orderBy("h", "features"))
    few = least.withColumn("place", by).where(F.col("place") <= each)
    turn = F.row_number().over(Window.partitionBy("kind").orderBy("place", "h", "features"))
    sample = few.withColumn("turn", turn).where(F.col("turn") <= most).select("kind", "votes", "features").collect()
    reliability, posterior, count = {}, {}, {}
    for kind in KINDS:
        own = sorted((r["votes"], r["n"]) for r in told if r["kind"] == kind)
        if not own:
            continue
        patterns = [tuple(map(int, x.split(","))) for x, _ in own]
        chance, share, post = reliabilities(patterns, [n for _, n in own])
        reliability[kind] = (chance, share)
        for (x, n), p in zip(own, post):
            posterior[kind, x], count[kind, x] = float(p), n
    sizes: dict[tuple, int] = {}
    for r in sample:
        sizes[r["kind"], r["votes"]] = sizes.get((r["kind"], r["votes"]), 0) + 1
    sample = sorted(sample, key=lambda r: (r["kind"], r["votes"], r["features"]))
    keys = [(r["kind"], r["votes"]) for r in sample]
    target = np.array([posterior[k] for k in keys])
    weight = np.array([np.sqrt(count[k]) / sizes[k] for k in keys])
    return Model(reliability, fit([r["features"] for r in sample], target, weight))


def find_spans(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` and ``spans``: array of (kind, start, end, strict) in code points, end exclusive,
    by kind as in ``KINDS``, then start."""
    columns = docs.columns
    (name,) = free_names(docs, "spans")
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("strict", pa.bool_())]))
    place = columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in batch.column(place).to_pylist():
                x = x or ""
                kept = [(k, a, b, s) for k, a, b, s in candidates(x) if s or model.accepts(x, k, a, b)]
                kept.sort(key=lambda c: (KINDS.index(c[0]), c[1], c[2]))
                out.append([{"kind": k, "start": a, "end": b, "strict": s} for k, a, b, s in kept])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, kind)], names=[*batch.schema.names, name])

    span = StructType().add("kind", "string").add("start", "long").add("end", "long").add("strict", "boolean")
    typed = StructType([*docs.schema.fields]).add(name, ArrayType(span))
    return docs.mapInArrow(run, typed)


def personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``spans`` (:func:`find_spans`) by a model trained on all of ``docs``.

    A null or empty text has no spans. Every text is read whole. Rows that repeat, and
    ids, do not matter; an empty table gives an empty table. A column of the name
    ``spans`` stays and the new one gets a free name.
    """
    return find_spans(docs, train(docs, text), text)
