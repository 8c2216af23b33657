"""Phrase collocations per language, counted by weighted acyclic automata.

1. Each shard (a run of texts inside a task) builds a count transducer from its
   sorted n-grams: a state for each prefix, added below the state of the prefix
   without its last word, weighted with the n-gram's occurrences.
2. The transducers are cut by ranges of prefixes; a range's parts are united and
   their weights summed. An n-gram belongs to the range of its first three words, so
   a frequent word's or word pair's followers lie in many ranges.
3. The parts of a candidate are looked up by composition: each range sends an
   acceptor of the parts that it needs, and its owner walks both automata at once.

An n-gram is frequent only if its parts are. So words, then pairs of frequent words,
then triples of frequent pairs are counted by hash first, and a Bloom filter of the
frequent ones of each length (of a fixed size, whatever the corpus) keeps the rest out
of the transducers. A filter that fills up prunes less; the result is the same.

Words are told apart by 64 bits of their hash. Arithmetic on counts is exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapdiff.llm.text import Words, as_bytes, mix
from snapdiff.session import cut_lineage, scratch_path

#: Words of a phrase, occurrences that make a candidate, rows of a language.
LONGEST, LEAST, TOP = 5, 100, 2000
#: A phrase goes if a longer one around it has this many hundredths of its occurrences.
ABSORB = 100
#: Words of a prefix that decides an n-gram's range.
PREFIX = 3
#: Frequent n-grams of up to so many words are told first, by filters of so many bits (as a power of two; 8 MB).
FILTERS, FILTER_BITS = 3, 26
#: Leading bits of a hash that such counts go by.
KEY_BITS = 40
#: Bits of a slice of a filter; bytes of text of a shard; keys that a task counts before it sends them.
SLICE, SHARD, HELD = 1 << 20, 8 << 20, 4 << 20  # and states of its automaton
UNKNOWN = "und"

_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPACE, _BREAK = b" \t", b".,;:!?\n\x0b\x0c\r"
#: Bytes of a word stay (A-Z lower-cased), all others become a space.
_WORD = bytes(32 if b in _SPACE + _BREAK else b + 32 if 65 <= b <= 90 else b for b in range(256))
_ENDS = bytes(b in _BREAK for b in range(256))


def _codec(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.Codec("zstd").compress(data, asbytes=True)


def _plain(blob: bytes) -> bytes:
    return pa.Codec("zstd").decompress(blob[8:], int.from_bytes(blob[:8], "little"), asbytes=True)


def _numbered(parent: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each (parent, label) among the sorted distinct ones, and one row of each."""
    order = np.lexsort((label, parent))
    new = np.ones(len(order), bool)
    new[1:] = (parent[order[1:]] != parent[order[:-1]]) | (label[order[1:]] != label[order[:-1]])
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return number, order[new]


class Automaton:
    """Weighted acyclic automaton by depth: states sorted by (parent, label), with weights.

    Depth 0 holds languages, depth k the n-grams of k words; a state's parent is its
    prefix, so all n-grams share their prefixes' states.
    """

    def __init__(self, label: list[np.ndarray], parent: list[np.ndarray], weight: list[np.ndarray]):
        self.label, self.parent, self.weight = label, parent, weight

    def states(self) -> int:
        return sum(map(len, self.label))

    def dump(self) -> bytes:
        sizes = np.array([len(self.label), *map(len, self.label)], np.int64)
        # parents ascend: their steps are small
        steps = [np.diff(p, prepend=0) for p in self.parent]
        return _codec(b"".join([sizes.tobytes(), *(x.tobytes() for x in self.label), *(_planes(x) for x in [*steps, *self.weight])]))

    @classmethod
    def load(cls, blob: bytes) -> Automaton:
        data = _plain(blob)
        depths = int(np.frombuffer(data, np.int64, 1)[0])
        sizes = np.frombuffer(data, np.int64, depths, 8)
        at, parts = 8 * (1 + depths), []
        for kind in (np.uint64, np.int64, np.int64):
            part = []
            for n in sizes.tolist():
                part.append(np.frombuffer(data, kind, n, at) if kind is np.uint64 else _unplaned(data, kind, n, at))
                at += 8 * n
            parts.append(part)
        return cls(parts[0], [np.cumsum(p) for p in parts[1]], parts[2])

    @classmethod
    def of_grams(cls, grams: list[np.ndarray], weights: list[np.ndarray], merge=np.maximum) -> Automaton:
        """From label rows: ``grams[k]`` has a language and k words in each row. Of rows
        given twice the weights are merged; prefixes that are not given weigh nothing."""
        label, parent, weight = [], [], []
        rows = [np.zeros(len(g), np.int64) for g in grams]  # the state of each row's prefix so far
        for d in range(len(grams)):
            number, one = _numbered(np.concatenate(rows[d:]), np.concatenate([g[:, d] for g in grams[d:]]))
            label.append(np.concatenate([g[:, d] for g in grams[d:]])[one])
            parent.append(np.concatenate(rows[d:])[one])
            w = np.zeros(len(one), np.int64)
            merge.at(w, number[: len(grams[d])], weights[d])
            weight.append(w)
            ends = np.cumsum([0, *map(len, grams[d:])])
            rows[d:] = [number[a:b] for a, b in zip(ends[:-1], ends[1:])]
        return cls(label, parent, weight)

    @classmethod
    def union(cls, parts: list[Automaton]) -> Automaton:
        """All n-grams of the parts, their weights summed."""
        label, parent, weight = [], [], []
        of = [np.zeros(1, np.int64) for _ in parts]
        for d in range(max(len(p.label) for p in parts)):
            held = [p for p in parts if len(p.label) > d]
            lab = np.concatenate([p.label[d] for p in held])
            par = np.concatenate([m[p.parent[d]] for p, m in zip(parts, of) if len(p.label) > d])
            number, one = _numbered(par, lab)
            w = np.zeros(len(one), np.int64)
            np.add.at(w, number, np.concatenate([p.weight[d] for p in held]))
            label.append(lab[one])
            parent.append(par[one])
            weight.append(w)
            ends = np.cumsum([0, *(len(p.label[d]) for p in held)]).tolist()
            where = iter(zip(ends[:-1], ends[1:]))
            of = [number[slice(*next(where))] if len(p.label) > d else m for p, m in zip(parts, of)]
        return cls(label, parent, weight)

    def pruned(self, least: int) -> Automaton:
        """Without states below ``least`` that lead to none above it."""
        keep = [w >= least for w in self.weight]
        for d in range(len(keep) - 1, 0, -1):
            keep[d - 1][self.parent[d][keep[d]]] = True
        place = [np.cumsum(k) - 1 for k in keep]
        parent = [p[k] if d == 0 else place[d - 1][p[k]] for d, (p, k) in enumerate(zip(self.parent, keep))]
        return Automaton([x[k] for x, k in zip(self.label, keep)], parent, [w[k] for w, k in zip(self.weight, keep)])

    def compose(self, counts: Automaton) -> list[np.ndarray]:
        """The state of ``counts`` that each state meets when both are walked together, or -1."""
        met = []
        for d, label in enumerate(self.label):
            if d >= len(counts.label):
                met.append(np.full(len(label), -1))
                continue
            up = np.zeros(len(label), np.int64) if d == 0 else met[-1][self.parent[d]]
            number, one = _numbered(np.concatenate([counts.parent[d], up]), np.concatenate([counts.label[d], label]))
            state = np.full(len(one), -1)
            state[number[: len(counts.label[d])]] = np.arange(len(counts.label[d]))
            met.append(np.where(up < 0, -1, state[number[len(counts.label[d]):]]))
        return met

    def paths(self, depth: int) -> np.ndarray:
        """The labels of the states of a depth, from the language on."""
        at, columns = np.arange(len(self.label[depth])), []
        for d in range(depth, -1, -1):
            columns.append(self.label[d][at])
            at = self.parent[d][at]
        return np.stack(columns[::-1], axis=1)

    def split(self, ranges: int) -> Iterator[tuple[int, Automaton]]:
        """(range, automaton) of the n-grams of each range; prefixes of other ranges weigh nothing there."""
        owner = [None] + [range_of(self.paths(d), ranges) for d in range(1, len(self.label))]
        pairs: list = [None] * len(self.label)
        for d in range(len(self.label) - 1, -1, -1):
            r, s = (owner[d], np.arange(len(owner[d]))) if d else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            if d + 1 < len(pairs):
                r, s = np.concatenate([r, pairs[d + 1][0]]), np.concatenate([s, self.parent[d + 1][pairs[d + 1][1]]])
            one = _numbered(r, s)[1]
            pairs[d] = r[one], s[one]
        start = {d: np.searchsorted(pairs[d][0], pairs[0][0]) for d in range(len(pairs))}
        for k in np.flatnonzero(np.diff(pairs[0][0], prepend=-1)).tolist():
            r = int(pairs[0][0][k])
            label, parent, weight, above = [], [], [], None
            for d in range(len(pairs)):
                a = int(start[d][k])
                s = pairs[d][1][a : int(np.searchsorted(pairs[d][0], r, "right"))]
                if not len(s):
                    break
                label.append(self.label[d][s])
                parent.append(np.zeros(len(s), np.int64) if d == 0 else np.searchsorted(above, self.parent[d][s]))
                weight.append(np.where(owner[d][s] == r, self.weight[d][s], 0) if d else np.zeros(len(s), np.int64))
                above = s
            yield r, Automaton(label, parent, weight)


def _keys(rows: np.ndarray) -> np.ndarray:
    """Hash of a language and the words behind it (rows of labels)."""
    key = mix(rows[:, 0] ^ rows[:, 1])
    for d in range(2, rows.shape[1]):
        key = mix(key * _BASE + rows[:, d])
    return key


def range_of(rows: np.ndarray, ranges: int) -> np.ndarray:
    """The range of prefixes in which n-grams (language and words in a row) lie."""
    key = _keys(rows[:, : 1 + PREFIX])
    return ((key >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def lang_label(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


class _Shard:
    """Words of some texts: labels, which word follows in the same piece, hashed keys of words and pairs."""

    def __init__(self, texts: list[bytes], langs: list[str]):
        self.words = words = Words(texts, _WORD)
        self.label = words.hash
        n = np.diff(words.ptr)
        doc = np.repeat(np.arange(len(texts)), n)
        piece = np.cumsum(np.frombuffer(words.data.translate(_ENDS), np.uint8), dtype=np.int64)[words.start]
        self.follows = (doc[1:] == doc[:-1]) & (piece[1:] == piece[:-1])
        self.lang = np.array([lang_label(x) for x in langs], np.uint64)[doc] if len(doc) else np.zeros(0, np.uint64)
        self.total: dict[str, int] = {}
        for x, k in zip(langs, n.tolist()):
            self.total[x] = self.total.get(x, 0) + k

    def grams(self, size: int, filters: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Where n-grams of ``size`` words start whose parts may all be frequent, and their hashed keys."""
        at, key = np.arange(len(self.label)), mix(self.lang ^ self.label)
        for k in range(1, size + 1):
            if k > 1:
                ok = np.zeros(len(self.label) + 1, bool)
                ok[at] = True  # starts of possible n-grams of k - 1 words
                on = ok[at + 1] & self.follows[np.minimum(at, len(self.follows) - 1)] if len(self.follows) else np.zeros(len(at), bool)
                at, key = at[on], mix(key[on] * _BASE + self.label[at[on] + k - 1])
            if k <= len(filters):
                may = _may(filters[k - 1], key)
                at, key = at[may], key[may]
        return at, key

    def automaton(self, filters: list[np.ndarray], longest: int) -> Automaton | None:
        """Built by sorted n-grams: those of k words go below the states of their first k - 1."""
        label, parent, weight = [], [], []
        self.linked = np.zeros(0, np.int64)
        known = np.zeros(0, np.uint64)
        for k in range(1, longest + 1):
            starts = self.grams(k, filters)[0]
            if not len(starts):
                break
            if k == 1:
                known, rank = np.unique(self.label[starts], return_inverse=True)
                order = np.full(len(self.label), -1, np.int64)
                order[starts] = rank
                langs, above = np.unique(self.lang[starts], return_inverse=True)
                label, parent, weight = [langs], [np.zeros(len(langs), np.int64)], [np.zeros(len(langs), np.int64)]
                state = np.zeros(len(self.label), np.int64)
                state[starts] = above
            elif k == 2:
                self.linked = np.unique(np.concatenate([starts, starts + 1]))
            grams, found, count = np.unique(state[starts] * len(known) + order[starts + k - 1], return_inverse=True, return_counts=True)
            state[starts] = found
            label.append(known[grams % len(known)])
            parent.append(grams // len(known))
            weight.append(count)
        return Automaton(label, parent, weight) if label else None

    def dictionary(self) -> dict[int, bytes]:
        """Label and text of the words that stand in some n-gram of two or more words."""
        labels, first = np.unique(self.label[self.linked], return_index=True)
        lower = self.words.data.translate(_WORD)
        return {x: lower[self.words.start[i] : self.words.end[i]] for x, i in zip(labels.tolist(), self.linked[first].tolist())}


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[_Shard]:
    texts, langs, size = [], [], 0
    for batch in batches:
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            texts.append(text or b"")
            langs.append(UNKNOWN if lang is None else lang)
            size += len(texts[-1])
            if size >= SHARD:
                yield _Shard(texts, langs)
                texts, langs, size = [], [], 0
    if texts:
        yield _Shard(texts, langs)


def _planes(x: np.ndarray) -> bytes:
    """Bytes of like place together, so that the zeros of small numbers pack well."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def _unplaned(data: bytes, kind, n: int, at: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8, size * n, at).reshape(size, n).T).view(kind).reshape(n)


def _packed(keys: np.ndarray, count: np.ndarray, least: int) -> bytes:
    kind = np.uint8 if least < 256 else np.uint32
    n = np.array([len(keys)], np.int64)
    return _codec(n.tobytes() + _planes(np.diff(keys, prepend=np.uint64(0))) + np.minimum(count, least).astype(kind).tobytes())


def _unpacked(blob: bytes, least: int) -> tuple[np.ndarray, np.ndarray]:
    data = _plain(blob)
    n = int(np.frombuffer(data, np.int64, 1)[0])
    kind = np.uint8 if least < 256 else np.uint32
    return np.cumsum(_unplaned(data, np.uint64, n, 8), dtype=np.uint64), np.frombuffer(data, kind, n, 8 + 8 * n)


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate([c for _, c in parts]), len(keys)).astype(np.int64)


def _key_counts(rows: DataFrame, filters: list, least: int, ranges: int) -> DataFrame:
    """``range, blob`` (keys of the n-grams one word longer than the filters know, with a
    task's counts, at most ``least`` each) and ``lang, label, n`` (words)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        total: dict[str, int] = {}

        def out() -> pa.RecordBatch:
            keys, count = _summed(held) if held else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            r = (keys >> np.uint64(KEY_BITS - 32)) * np.uint64(ranges) >> np.uint64(32)
            first = np.flatnonzero(np.diff(r.astype(np.int64), prepend=-1))
            cut = [(int(r[a]), _packed(keys[a:b], count[a:b], least)) for a, b in zip(first, [*first[1:], len(keys)])]
            names = sorted(total)
            return pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in cut] + [None] * len(names), pa.int32()),
                 pa.array([x for _, x in cut] + [None] * len(names), pa.binary()),
                 pa.array([None] * len(cut) + names, pa.string()),
                 pa.array([None] * len(cut) + [int(np.uint64(lang_label(x)).astype(np.int64)) for x in names], pa.int64()),
                 pa.array([None] * len(cut) + [total[x] for x in names], pa.int64())], names=["range", "blob", "lang", "label", "n"])

        for shard in _shards(batches):
            for lang, n in shard.total.items():
                total[lang] = total.get(lang, 0) + n
            held.append(np.unique(shard.grams(len(filters) + 1, [f.value for f in filters])[1] >> np.uint64(64 - KEY_BITS), return_counts=True))
            if sum(len(k) for k, _ in held) > HELD:
                held = [_summed(held)]
                if len(held[0][0]) > HELD // 2:
                    yield out()
                    held, total = [], {}
        yield out()

    return rows.mapInArrow(run, "range int, blob binary, lang string, label long, n long")


def _filter(counts: DataFrame, least: int, bits: int, ranges: int) -> np.ndarray:
    """A Bloom filter of 2**bits bits of the keys that reach ``least``."""
    slices = max(1, (1 << bits) // SLICE)

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _groups(batches):
            held: list[tuple[np.ndarray, np.ndarray]] = []
            for _, blob in rows:
                held.append(_unpacked(blob, least))
                while len(held) > 1 and 2 * len(held[-1][0]) >= len(held[-2][0]):
                    held[-2:] = [_summed(held[-2:])]
            keys, count = _summed(held)
            place = np.unique(_places(keys[count >= least], bits))
            part = place // SLICE
            for i in np.unique(part).tolist():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i], pa.int32()), pa.array([(place[part == i] % SLICE).astype(np.uint32).tobytes()], pa.binary())], names=["slice", "places"])

    def table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for i, rows in _groups(batches):
            seen = np.zeros(min(SLICE, 1 << bits), bool)
            for _, places in rows:
                seen[np.frombuffer(places, np.uint32)] = True
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([np.packbits(seen).tobytes()], pa.binary())], names=["slice", "bits"])

    dealt = counts.where(F.col("range").isNotNull()).select("range", "blob").repartition(ranges, "range").sortWithinPartitions("range")
    places = dealt.mapInArrow(frequent, "slice int, places binary").repartition("slice").sortWithinPartitions("slice")
    told = {r["slice"]: r["bits"] for r in places.mapInArrow(table, "slice int, bits binary").collect()}
    return np.frombuffer(b"".join(told.get(i, bytes(min(SLICE, 1 << bits) // 8)) for i in range(slices)), np.uint8)


def _places(key: np.ndarray, bits: int) -> np.ndarray:
    """The four bits of each key (keys x 4), in one block of 512."""
    block = key >> np.uint64(KEY_BITS + 9 - bits) if bits > 9 else np.zeros(len(key), np.uint64)
    key = mix(key)
    inside = np.stack([key >> np.uint64(9 * i) & np.uint64(511) for i in range(4)], axis=-1)
    return (block[:, None] * np.uint64(512) + inside).astype(np.int64)


def _may(table: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether keys may be frequent (never false for one that is)."""
    place = _places(key >> np.uint64(64 - KEY_BITS), (len(table) * 8).bit_length() - 1)
    return ((table[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1).all(axis=-1)


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "none").parquet(path)
    return df.sparkSession.read.parquet(path)


def _shard_automata(rows: DataFrame, filters: list, longest: int, ranges: int) -> DataFrame:
    """``range, kind, blob``: count transducers (kind 0) cut by ranges of prefixes, and words
    by ranges of labels (kind 1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Automaton] = []
        told: dict[int, bytes] = {}

        def out() -> pa.RecordBatch:
            cut = [(r, 0, part.dump()) for r, part in Automaton.union(held).split(ranges)] if held else []
            by: dict[int, list[int]] = {}
            for x in told:
                by.setdefault((x >> 32) * ranges >> 32, []).append(x)
            cut += [(r, 1, _codec(np.array([len(xs), *xs], np.uint64).tobytes() + b" ".join(told[x] for x in xs))) for r, xs in by.items()]
            held.clear()
            told.clear()
            return pa.RecordBatch.from_arrays([pa.array([c[0] for c in cut], pa.int32()), pa.array([c[1] for c in cut], pa.int32()),
                                               pa.array([c[2] for c in cut], pa.binary())], names=["range", "kind", "blob"])

        for shard in _shards(batches):
            made = shard.automaton([f.value for f in filters], longest)
            if made is None:
                continue
            told.update(shard.dictionary())
            held.append(made)
            while len(held) > 1 and held[-1].states() * 2 >= held[-2].states():
                held[-2:] = [Automaton.union(held[-2:])]
            if sum(h.states() for h in held) > HELD:
                yield out()
        yield out()

    return rows.mapInArrow(run, "range int, kind int, blob binary")


def _spelled(parts: DataFrame, ranges: int) -> DataFrame:
    """``label, word``, each once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _groups(batches):
            told: dict[int, bytes] = {}
            for _, blob in rows:
                data = _plain(blob)
                n = int(np.frombuffer(data, np.uint64, 1)[0])
                told.update(zip(np.frombuffer(data, np.int64, n, 8).tolist(), data[8 + 8 * n :].split(b" ")))
            yield pa.RecordBatch.from_arrays([pa.array(list(told), pa.int64()), pa.array([w.decode() for w in told.values()], pa.string())],
                                             names=["label", "word"])

    dealt = parts.where(F.col("kind") == 1).select("range", "blob").repartition(ranges, "range").sortWithinPartitions("range")
    return dealt.mapInArrow(run, "label long, word string")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[tuple]]]:
    """(range, its rows) of rows sorted by their first column; rows are read one at a time."""
    from itertools import groupby

    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
    return groupby(rows, key=lambda r: r[0])


def _united(parts: DataFrame, least: int, ranges: int) -> DataFrame:
    """``range, blob``: one transducer for each range, without what is not frequent."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, rows in _groups(batches):
            held: list[Automaton] = []
            for _, blob in rows:  # parts of like size are united first
                held.append(Automaton.load(blob))
                while len(held) > 1 and held[-1].states() * 2 >= held[-2].states():
                    held[-2:] = [Automaton.union(held[-2:])]
            made = Automaton.union(held).pruned(least)
            if len(made.label[0]):
                yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([made.dump()], pa.binary())], names=["range", "blob"])

    dealt = parts.where(F.col("kind") == 0).select("range", "blob").repartition(ranges, "range").sortWithinPartitions("range")
    return dealt.mapInArrow(run, "range int, blob binary")


def _candidates(made: Automaton, least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(words, states, label rows) of the phrases of two or more words that the range owns."""
    for d in range(2, len(made.label)):
        own = np.flatnonzero(made.weight[d] >= least)
        if len(own):
            yield d, own, made.paths(d)[own]


def _asked(made: Automaton, least: int, ranges: int) -> Iterator[tuple[int, Automaton]]:
    """(range, acceptor) of all parts of the candidates; a part weighs as its most frequent whole."""
    depths = len(made.label)
    grams: list[list] = [[] for _ in range(depths)]
    wholes: list[list] = [[] for _ in range(depths)]
    for d, own, rows in _candidates(made, least):
        for size in range(1, d):
            for first in range(1, d - size + 2):
                grams[size].append(np.concatenate([rows[:, :1], rows[:, first : first + size]], axis=1))
                wholes[size].append(made.weight[d][own])
    grams_of = [np.concatenate(g) if g else np.zeros((0, 1 + k), np.uint64) for k, g in enumerate(grams)]
    whole_of = [np.concatenate(w) if w else np.zeros(0, np.int64) for w in wholes]
    owner = [range_of(g, ranges) if k and len(g) else np.zeros(0, np.int64) for k, g in enumerate(grams_of)]
    for r in np.unique(np.concatenate(owner)).tolist():
        here = [o == r if len(o) else np.zeros(0, bool) for o in owner]
        last = max(k for k, h in enumerate(here) if h.any())
        yield r, Automaton.of_grams([g[h] for g, h in zip(grams_of, here)][: last + 1], [w[h] for w, h in zip(whole_of, here)][: last + 1])


def _lookups(whole: DataFrame, least: int, ranges: int) -> DataFrame:
    """``range, source, blob``: the acceptors that a range sends to others (and to itself)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                asked = [(r, a.dump()) for r, a in _asked(Automaton.load(blob), least, ranges)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r for r, _ in asked], pa.int32()), pa.array([source] * len(asked), pa.int32()),
                     pa.array([b for _, b in asked], pa.binary())], names=["range", "source", "blob"])

    return whole.select("range", "blob").mapInArrow(run, "range int, source int, blob binary")


def _answers(whole: DataFrame, asked: DataFrame, ranges: int) -> DataFrame:
    """``range, source, blob``: the parts' weights, back to the range that asked (``source`` answered).
    Rows with source -1 tell a range itself the most frequent whole around each of its phrases."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, rows in _groups(batches):
            counts, around, out = None, [], []
            for _, source, blob in rows:
                if source < 0:
                    counts = Automaton.load(blob)
                    around = [np.zeros(len(w), np.int64) for w in counts.weight]
                    continue
                asked = Automaton.load(blob)
                found = asked.compose(counts)
                for d in range(len(found)):
                    np.maximum.at(around[d], found[d], asked.weight[d])
                weights = [np.where(f >= 0, counts.weight[d][f], 0) for d, f in enumerate(found)]
                out.append((source, r, _codec(np.concatenate(weights).tobytes())))
                if len(out) >= 256:
                    yield _messages(out)
                    out = []
            yield _messages([*out, (r, -1, _codec(np.concatenate(around).tobytes()))])

    told = whole.select("range", F.lit(-1).alias("source"), "blob").union(asked)
    return told.repartition(ranges, "range").sortWithinPartitions("range", "source").mapInArrow(run, "range int, source int, blob binary")


def _messages(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows], pa.int32()), pa.array([x[1] for x in rows], pa.int32()),
                                       pa.array([x[2] for x in rows], pa.binary())], names=["range", "source", "blob"])


def _scored(whole: DataFrame, answers: DataFrame, least: int, absorb: int, ranges: int) -> DataFrame:
    """``lang, words`` (labels), ``a, cuts`` (l, r of each cut) of the candidates that no longer phrase absorbs."""
    kind = pa.list_(pa.struct([("l", pa.int64()), ("r", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, rows in _groups(batches):
            told = {}
            for _, source, blob in rows:
                told[source] = blob
            made = Automaton.load(told[-2])
            around = np.split(np.frombuffer(_plain(told[-1]), np.int64), np.cumsum([len(w) for w in made.weight])[:-1])
            parts = []  # the acceptors that were sent, now with the answers as weights
            for other, asked in _asked(made, least, ranges):
                values = np.frombuffer(_plain(told[other]), np.int64)
                asked.weight = np.split(values, np.cumsum([len(w) for w in asked.weight])[:-1])
                parts.append(asked)
            known = Automaton.union(parts) if parts else None
            for d, own, labels in _candidates(made, least):
                a = made.weight[d][own]
                stay = absorb * a > 100 * around[d][own] if absorb else np.ones(len(own), bool)
                a, labels = a[stay], labels[stay]
                cuts = []
                for k in range(1, d):
                    pair = []
                    for part in (labels[:, : 1 + k], np.concatenate([labels[:, :1], labels[:, 1 + k :]], axis=1)):
                        pair.append(_weights(known, part))
                    cuts.append(pair)
                values = [[{"l": int(c[0][i]), "r": int(c[1][i])} for c in cuts] for i in range(len(a))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(labels[:, 0].astype(np.uint64).view(np.int64)),
                     pa.array(list(np.ascontiguousarray(labels[:, 1:]).view(np.int64)), pa.list_(pa.int64())), pa.array(a, pa.int64()),
                     pa.array(values, kind)], names=["lang", "words", "a", "cuts"])

    told = whole.select("range", F.lit(-2).alias("source"), "blob").union(answers)
    dealt = told.repartition(ranges, "range").sortWithinPartitions("range", "source")
    return dealt.mapInArrow(run, "lang long, words array<long>, a long, cuts array<struct<l:long,r:long>>")


def _weights(known: Automaton, rows: np.ndarray) -> np.ndarray:
    """The weights of label rows, by walking the automaton of the answered parts."""
    at = np.zeros(len(rows), np.int64)
    for d in range(rows.shape[1]):
        n = len(known.label[d])
        number, one = _numbered(np.concatenate([known.parent[d], at]), np.concatenate([known.label[d], rows[:, d]]))
        state = np.full(len(one), -1)
        state[number[:n]] = np.arange(n)
        at = state[number[n:]]
    return known.weight[rows.shape[1] - 1][at]


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST, top: int = TOP,
    absorb: int = ABSORB, filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """The first ``top`` collocations of each language: ``lang, rank, phrase, a, l, r, n, score``.

    Texts are lower-cased (A-Z) and cut into pieces at ``.,;:!?`` and line ends, pieces
    into words at spaces and tabs. Phrases of 2 to ``longest`` words with ``a >= least``
    occurrences within pieces are candidates; ``score`` is the least
    floor(1000 a n / (l r)) over the cuts into a first part (l) and a rest (r), the
    first such cut on ties. A candidate goes if a longer one around it has
    ``100 f >= absorb a``. Ranked by score, a, then phrase in byte order.

    Null texts are empty, a null language is ``und``; rows that repeat all count;
    an empty table, or one without a candidate, gives no rows. Ids and other columns are not read.
    A text of any length is one run of words; memory is that of the longest text
    or a shard, and of a range's n-grams.
    """
    spark = docs.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(as_bytes(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    filters: list = []
    counts = _stored(_key_counts(rows, filters, least, ranges), "phrase-words")
    names = counts.where(F.col("lang").isNotNull()).groupBy(F.col("lang").alias("name"), F.col("label").alias("lang")).agg(F.sum("n").alias("n"))
    for size in range(1, FILTERS + 1):
        counts = counts if size == 1 else _key_counts(rows, list(filters), least, ranges)
        filters.append(spark.sparkContext.broadcast(_filter(counts, least, filter_bits, ranges)))
    shards = _stored(_shard_automata(rows, filters, longest, ranges), "phrase-shards")
    whole = cut_lineage(_united(shards, least, ranges))
    answers = _answers(whole, _lookups(whole, least, ranges), ranges)
    found = cut_lineage(_scored(whole, answers, least, absorb, ranges))

    wide = lambda c: F.col(c).cast("decimal(38,0)")
    cut = F.expr("array_min(transform(cuts, (c, k) -> struct("
                 "cast(whole div (cast(c.l as decimal(38,0)) * cast(c.r as decimal(38,0))) as long) as score, k as k, c.l as l, c.r as r)))")
    best = found.join(names, "lang").withColumn("whole", wide("a") * wide("n") * F.lit(1000).cast("decimal(38,0)"))
    best = best.withColumn("cut", cut).select("name", "n", "words", "a", "cut.l", "cut.r", "cut.score")
    by = Window.partitionBy("name").orderBy(F.desc("score"), F.desc("a"))
    best = best.withColumn("place", F.rank().over(by)).where(F.col("place") <= top).drop("place")
    spelled = best.select("*", F.posexplode("words").alias("at", "label")).join(_spelled(shards, ranges), "label")
    spelled = spelled.groupBy("name", "n", "words", "a", "l", "r", "score").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    ranked = spelled.withColumn("rank", F.row_number().over(by.orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))).cast("long"))
    return ranked.where(F.col("rank") <= top).select(
        F.col("name").alias("lang"), "rank", "phrase", "a", "l", "r", "n", "score")
