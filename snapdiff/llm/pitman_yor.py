"""Language-model scores of a hierarchical Pitman-Yor model, seated by Gibbs sweeps."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapdiff.llm.chunks import bucketed, by_bucket, by_chunk, chunk_rows, dealt, gathered, in_chunks, lean, rows_of
from snapdiff.llm.text import _BASE, SPACED, Words, mix
from snapdiff.session import cut_lineage, scratch_path

#: Bytes of context of the deepest restaurants.
ORDER = 4
#: Discount and strength of the restaurants of each order, root first.
DISCOUNT = (0.3, 0.4, 0.5, 0.6, 0.6)
STRENGTH = (1.0, 1.0, 1.0, 1.0, 1.0)
#: Strength of the restaurant of words and of those after a previous word (their discounts are estimated).
WORD_STRENGTH = 1.0
PAIR_STRENGTH = 1.0
#: A context with more than this share of a bucket's tokens is dealt over all buckets.
HOT_SHARE = 4
#: Rounds between the contexts of two bytes or more and the shorter ones, sweeps of a
#: round, and sweeps whose predictions are averaged.
ROUNDS, SWEEPS, SAMPLES = 3, 3, 5
#: Rounds between the restaurants after a previous word and the restaurant of words.
TURNS = 2
#: Bytes of text in a chunk.
CHUNK = 4 << 20
#: Up to so many binomial numbers all steps of their distributions are made at once.
FEW = 64
#: Words of a restaurant seated together.
PARTY = 1 << 19
#: The end token's hash.
END_TOKEN = np.uint64(0xE4D0F7E87)
#: Blobs: a chunk's words (number, count); those it owns (number, customers, spelling's
#: probability); its pairs in a bucket (contexts, sizes, tokens, times, hot); a bucket's pairs.
TOLD = (np.int64, np.int64)
OWN = (np.int64, np.int64, np.float32)
PAIRS = (np.int64, np.int32, np.int64, np.int32, np.uint8)
MERGED = (np.int64, np.int32, np.int64, np.int64, np.uint8)
HOT = "array<struct<id: bigint, left: double, tables: double>>"


def spell(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all symbols (``ORDER`` bytes of context and the symbol, in 40 bits) and
    the first key of each word, with one more entry.

    A word is spelled by its bytes and a blank, after line feeds as context;
    the empty word stands for the end token and is spelled by a line feed.
    """
    parts = [b"\n" * ORDER + (w + b" " if w else b"\n") for w in words]
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    s = np.frombuffer(b"".join(parts), np.uint8)
    key = np.zeros(max(0, len(s) - ORDER), np.uint64)
    for j in range(ORDER + 1):
        key |= s[ORDER - j : len(s) - j].astype(np.uint64) << np.uint64(8 * j)
    inside = np.ones(len(s), bool)
    first = np.cumsum(size) - size
    for j in range(ORDER):
        inside[first + j] = False
    return key[inside[ORDER:]], np.concatenate([[0], np.cumsum(size - ORDER)])


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, Words, np.ndarray]:
    """Hashes of all tokens (each text's words, then its end), the first of each text, the
    words, and each token's number among them (-1: an end)."""
    words = Words(texts, SPACED)
    n = np.diff(words.ptr) + 1
    out = np.full(int(n.sum()), END_TOKEN, np.uint64)
    is_word = np.ones(len(out), bool)
    is_word[np.cumsum(n) - 1] = False
    out[is_word] = words.hash
    number = np.full(len(out), -1, np.int64)
    number[is_word] = np.arange(len(words.hash))
    return out, np.concatenate([[0], np.cumsum(n)]), words, number


# ------------------------------------------------------------------ seating


def seat(customers: np.ndarray, parent: np.ndarray, others: np.ndarray, strength: float, discount: float,
         draw: Callable[[np.ndarray, int], np.ndarray]) -> np.ndarray:
    """Tables of each dish after all its customers are seated anew, one after another.

    A customer opens a table with weight (strength + discount * tables) * parent
    probability and joins one with weight (seated - discount * the dish's
    tables); ``others`` are the tables of the restaurant's other dishes. The
    first few and those likely to open are drawn singly; then the number that join before the next
    opening is drawn at once, from the ratio of gamma functions that this
    chance is, to first order. Where many openings are ahead, a twentieth of
    the seated are seated at a time, with a binomial number of openings (normal
    where it is large) of the chance that holds in the middle of the party, so
    the steps grow with the log of a dish's customers. All dishes advance together.
    ``draw`` gives uniform numbers for the named dishes at a step.
    """
    tables = (customers > 0).astype(np.int64)
    live = np.flatnonzero(customers > 1)
    seated = np.ones(len(live))
    total, base, rest = customers[live].astype(float), parent[live], others[live].astype(float)
    t = np.ones(len(live))
    step = 0
    while len(live):
        weight = (strength + discount * (rest + t)) * base
        room = seated - discount * t
        u = draw(live, step)
        step += 1
        many = np.flatnonzero(seated >= 40)
        if len(many):
            many = many[weight[many] * np.log(total[many] / seated[many]) > 8]
        arrival = seated + 1
        if len(many) < len(live):
            opened = (u < weight / (room + weight)).astype(float)
            far = np.flatnonzero((seated >= 6) & (weight <= room / 16))
            if len(far):
                w, r = weight[far], room[far]
                half = np.maximum((w - 1) / 2, -0.5)
                with np.errstate(over="ignore", divide="ignore"):
                    joined = np.floor(np.maximum(r + half, r / 2) * (np.exp(np.minimum(-np.log(u[far]) / w, 700)) - 1))
                arrival[far] = seated[far] + joined + 1
                opened[far] = arrival[far] <= total[far]
        else:
            many, opened = slice(None), np.empty(len(live))
        if not isinstance(many, np.ndarray) or len(many):
            now, w, r = seated[many], weight[many], room[many]
            party = np.minimum(np.ceil(now / 20), total[many] - now)
            ahead = (party - 1) / 2
            chance = w / (r + w)
            later = w + discount * ahead * chance * base[many]
            chance = later / (r + ahead * (1 - discount * chance) + later)
            opened[many] = _binomial(u[many], party, chance)
            arrival[many] = now + party
        t += opened
        seated = np.minimum(arrival, total)
        more = seated < total
        if not more.all():
            tables[live[~more]] = t[~more].astype(np.int64)
            live, seated, total, base, rest, t = live[more], seated[more], total[more], base[more], rest[more], t[more]
    return tables


def _binomial(u: np.ndarray, size: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """Binomial numbers from uniform ones: by the distribution where the lesser side has a
    mean of at most 12, else normal (logistic, of the same variance)."""
    less = np.minimum(chance, 1 - chance)
    odds = np.minimum(np.maximum(u, 1e-12), 1 - 1e-12)
    middle = size * less
    few = np.flatnonzero(middle <= 12)
    out = np.empty(len(u))
    if len(few) < len(u):
        noise = np.log(odds / (1 - odds)) / 1.8138 * np.sqrt(middle * (1 - less))
        out = np.minimum(np.maximum(np.rint(middle + noise), 0), size)
    if len(few):
        n, c, odds = size[few], less[few], odds[few]
        term = np.exp(n * np.log1p(-c))
        if len(few) <= FEW:
            k = np.arange(60.0)[:, None]
            terms = np.concatenate([term[None], np.maximum(n - k[:-1], 0) / (k[:-1] + 1) * c / (1 - c)])
            count = (odds > np.add.accumulate(np.multiply.accumulate(terms))).sum(axis=0)
        else:
            reached, count = term.copy(), np.zeros(len(few))
            for k in range(60):
                more = odds > reached
                if not more.any():
                    break
                count += more
                term *= np.maximum(n - k, 0) / (k + 1) * c / (1 - c)
                reached += term
        out[few] = np.minimum(count, n)
    return np.where(chance > 0.5, size - out, out)


class Floor:
    """The restaurants of one order: their dishes, and where these stand one order below."""

    def __init__(self, dishes: np.ndarray, order: int):
        self.dishes, self.order = dishes, order
        self.rooms, self.room = np.unique(dishes >> np.uint64(8), return_inverse=True)
        self.customers = np.zeros(len(dishes), np.int64)
        self.tables = np.zeros(len(dishes), np.int64)

    def below(self) -> tuple[np.ndarray, np.ndarray]:
        """Dishes of the parent order and the number of each dish's parent."""
        context = (self.dishes >> np.uint64(8)) & np.uint64((1 << 8 * (self.order - 1)) - 1)
        return np.unique(context << np.uint64(8) | self.dishes & np.uint64(255), return_inverse=True)

    def sums(self, x: np.ndarray) -> np.ndarray:
        return np.bincount(self.room, x, len(self.rooms))[self.room]

    def sweep(self, guess: np.ndarray, down: np.ndarray, rng: np.random.Generator) -> None:
        """Seats all anew, given the probabilities of the order below and each dish's place there.
        Only dishes of two customers or more may have other than one table."""
        more = np.flatnonzero(self.customers > 1)
        others = np.bincount(self.room, self.tables, len(self.rooms))[self.room[more]] - self.tables[more]
        self.tables = (self.customers > 0).astype(np.int64)
        self.tables[more] = seat(self.customers[more], guess[down[more]], others, STRENGTH[self.order], DISCOUNT[self.order],
                                 lambda live, _: 1 - rng.random(len(live)))

    def predict(self, parent: np.ndarray) -> np.ndarray:
        d, s = DISCOUNT[self.order], STRENGTH[self.order]
        guests = self.sums(self.customers)
        own = np.maximum(self.customers - d * self.tables, 0) / (s + guests)
        return own + (s + d * self.sums(self.tables)) / (s + guests) * parent


def deep_sweeps(keys: np.ndarray, counts: np.ndarray, first_order: np.ndarray, sweeps: int, samples: int,
                seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gibbs sweeps over the orders from ORDER to 2 of whole context groups.

    ``first_order``: 256 x 256 probabilities of a symbol after one byte.
    Returns the mean prediction of each key over the last ``samples`` sweeps,
    and the order-1 dishes (byte, symbol) with the customers sent to them.
    """
    rng = np.random.Generator(np.random.PCG64(seed))
    floors, downs = [Floor(keys, ORDER)], []
    for order in range(ORDER, 1, -1):
        dishes, down = floors[-1].below()
        downs.append(down)
        floors.append(Floor(dishes, order - 1))
    top = floors.pop()  # order 1: seated by the driver
    base = first_order[(top.dishes >> np.uint64(8)).astype(np.int64), (top.dishes & np.uint64(255)).astype(np.int64)]
    floors[0].customers = counts.astype(np.int64)

    def predictions() -> list[np.ndarray]:
        """Of all orders but the deepest, and of the last one here."""
        p, out = base, [base]
        for floor, down in zip(floors[:0:-1], downs[:0:-1]):
            p = floor.predict(p[down])
            out.append(p)
        return out[::-1]

    mean = np.zeros(len(keys))
    guess = predictions()
    for turn in range(sweeps + samples):
        for i, floor in enumerate(floors):
            floor.sweep(guess[i], downs[i], rng)
            if i + 1 < len(floors):
                floors[i + 1].customers = np.bincount(downs[i], floor.tables, len(floors[i + 1].dishes)).astype(np.int64)
        guess = predictions()
        if turn >= sweeps:
            mean += floors[0].predict(guess[0][downs[0]]) / samples
    sent = np.bincount(downs[-1], floors[-1].tables, len(top.dishes)).astype(np.int64)
    return mean, top.dishes, sent


def shallow_sweeps(customers: np.ndarray, sweeps: int, seed: int) -> np.ndarray:
    """256 x 256 probabilities of a symbol after one byte, from the order-1 customers
    (a 256 x 256 matrix): Gibbs sweeps over order 1 and the root, averaged."""
    rng = np.random.Generator(np.random.PCG64(seed))
    first = Floor(np.arange(1 << 16, dtype=np.uint64), 1)
    first.customers = customers.reshape(-1).astype(np.int64)
    dishes, down = first.below()
    root = Floor(dishes, 0)
    uniform = np.full(len(dishes), 1 / 256)
    mean = np.zeros(1 << 16)
    for turn in range(2 * sweeps):
        first.sweep(root.predict(uniform), down, rng)
        root.customers = np.bincount(down, first.tables, len(dishes)).astype(np.int64)
        root.sweep(uniform, np.arange(len(uniform)), rng)
        if turn >= sweeps:
            mean += first.predict(root.predict(uniform)[down]) / sweeps
    return mean.reshape(256, 256)


# ------------------------------------------------------------------ on Spark


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate([c for _, c in parts]), len(keys)).astype(np.int64)


def _vocabularies(docs: DataFrame, training: Column, id_col: str, text: str) -> DataFrame:
    """``chunk, ids, flags, sizes, places, end, counts, spelling``: the rows of a chunk and the
    tokens of each, the tokens themselves as numbers among the chunk's distinct ones, which go by hash; the
    number of the end token; how often training texts have each, and the words.

    Numbers are coded with the chunk's most frequent ones first, so that later passes read them in place
    of the texts in two thirds of their room. A written table, in buckets by chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, flags, texts in in_chunks(batches, CHUNK):
            token, ptr, words, number = tokens(texts)
            distinct, place = np.unique(token, return_inverse=True)
            first = _first_places(place, len(distinct))
            sizes = np.diff(ptr)
            count = np.bincount(place, np.repeat(np.array(flags, bool), sizes), len(distinct)).astype(np.int64)
            often = np.argsort(-np.bincount(place, minlength=len(distinct)), kind="stable").astype(np.int32)
            code = np.empty(len(distinct), np.int32)
            code[often] = np.arange(len(distinct), dtype=np.int32)
            at = number[first]
            end = int(np.searchsorted(distinct, END_TOKEN))
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids], pa.list_(pa.int64())), pa.array([flags], pa.list_(pa.bool_())), pa.array([sizes], pa.list_(pa.int64())),
                 pa.array([_tight(often, code[place])], pa.binary()), pa.array([end], pa.int64()),
                 pa.array([_tight(count)], pa.binary()), pa.array([_spelled(words, at[at >= 0])], pa.binary())],
                names=["ids", "flags", "sizes", "places", "end", "counts", "spelling"])

    made = chunk_rows(docs, id_col, text, training).mapInArrow(
        lean(run), "ids array<long>, flags array<boolean>, sizes array<long>, places binary, end long, counts binary, spelling binary")
    return bucketed(made.withColumn("chunk", F.monotonically_increasing_id()), "vocabularies", "chunk", "zstd")


def _spelled(words: Words, at: np.ndarray) -> bytes:
    """The named words, lower-cased, with line feeds between."""
    clean = np.frombuffer(words.data.translate(SPACED), np.uint8)
    start, size = words.start[at], words.end[at] - words.start[at] + 1
    stop = np.cumsum(size)
    out = clean[np.arange(int(size.sum())) + np.repeat(start - (stop - size), size)]
    out[stop - 1] = 10
    return out[:-1].tobytes()


def _first_places(number: np.ndarray, n: int) -> np.ndarray:
    """Where each of ``n`` numbers stands first."""
    first = np.empty(n, np.int64)
    first[number[::-1]] = np.arange(len(number) - 1, -1, -1)
    return first


def _hashes(spelling: bytes, end: int) -> np.ndarray:
    """Hashes of a chunk's distinct tokens, in order."""
    return np.insert(Words([spelling], SPACED).hash, end, END_TOKEN)


def symbol_counts(owned: DataFrame) -> DataFrame:
    """``key, n`` of every context and symbol of the known words, each word taken once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for spelling in batch.column(0).to_pylist():
                key, _ = spell(spelling.split(b"\n")[:-1])
                held = [_merged([*held, (key, np.ones(len(key), np.int64))])]
        if held:
            keys, total = held[0]
            for lo in range(0, len(keys), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(keys[lo : lo + (1 << 16)].astype(np.int64)), pa.array(total[lo : lo + (1 << 16)])],
                                                 names=["key", "n"])

    parts = owned.select("spelling").mapInArrow(lean(run), "key long, n long")
    return parts.groupBy("key").agg(F.sum("n").alias("n"))


def _known(words: np.ndarray, answers: list[dict], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Count of each word in all training texts, whether this chunk owns it, and its
    number: its place in its bucket, times ``n``, plus the bucket."""
    told, ids = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    said = {a["bucket"]: a["answer"] for a in answers}
    for b, rows in dealt(_bucket(words, n)):
        told[rows], step = _loose(said[b], np.int64, np.int64)
        ids[rows] = np.cumsum(step) * n + b
    return told >> 1, (told & 1).astype(bool), ids


def token_pairs(places: bytes, ptr: np.ndarray, end: int, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each token's place among the distinct tokens, then the distinct (previous,
    token) pairs as such places, ordered by the words' numbers ``ids``, and
    each token's pair. A text's first token follows the end token."""
    often, code = _loose(places, np.int32, np.int32)
    order = np.argsort(ids)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    both = rank[often][code]
    both[1:] += both[:-1] * len(ids)
    both[ptr[:-1]] = both[ptr[:-1]] % len(ids) + rank[end] * len(ids)
    order_of = np.argsort(both)
    both = both[order_of]
    new = np.ones(len(both), bool)
    new[1:] = both[1:] != both[:-1]
    pair = np.empty(len(both), np.int32)
    pair[order_of] = np.cumsum(new, dtype=np.int32) - 1
    before, token = np.divmod(both[new], len(ids))
    return often[code], order[before], order[token], pair


def pair_buckets(first: np.ndarray, second: np.ndarray, ids: np.ndarray, seen: np.ndarray, train_tokens: int, n: int) -> np.ndarray:
    """Bucket of each pair: its context's, or its own if the context is hot (``seen``: each
    word's customers), so that a frequent word's followers meet in no single task."""
    ids = ids.astype(np.uint64)
    out = _bucket(ids, n).astype(np.int64)[first]
    own = np.flatnonzero(is_hot(seen, train_tokens, n)[first])
    out[own] = _bucket(ids[first[own]] * np.uint64(_BASE) + ids[second[own]], n)
    return out


def is_hot(seen: np.ndarray, train_tokens: int, n: int) -> np.ndarray:
    return seen * n > HOT_SHARE * train_tokens


def estimated_discount(once: int, twice: int) -> float:
    return min(0.95, max(0.05, once / max(1, once + 2 * twice)))


def pair_sweeps(previous: np.ndarray, customers: np.ndarray, parent: np.ndarray, spread: np.ndarray, seed: int,
                discount: float | None = None, elsewhere: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gibbs sweeps over the restaurants of some contexts, each with all its pairs here or
    (hot) with one in ``spread``; ``elsewhere``: the tables that a context has in other
    buckets, where they are known (else -1). Returns what the customers of each pair keep and what
    they leave to the parent (averaged over the last sweeps), and the pair's
    tables of the last sweep, which are customers of the parent.

    Without ``discount`` it is estimated from the pairs here. A context adds up what
    its pairs leave, so its probabilities sum to one.
    """
    rng = np.random.Generator(np.random.PCG64(seed))
    if discount is None:
        discount = estimated_discount(int((customers == 1).sum()), int((customers == 2).sum()))
    if elsewhere is None:
        elsewhere = np.full(len(customers), -1.0)
    room = _rooms(previous)
    tables = (customers > 0).astype(np.int64)
    mean = tables.astype(float)
    # only pairs of two customers or more may have other than one table
    more = np.flatnonzero(customers > 1)
    rooms, several, parent, elsewhere, spread = room[more], customers[more], parent[more], elsewhere[more], spread[more]
    single = np.bincount(room, customers == 1)
    now, mean[more] = tables[more], 0
    for turn in range(SWEEPS + SAMPLES):
        here = (single + np.bincount(rooms, now, len(single)))[rooms]
        others = np.where(elsewhere >= 0, here + elsewhere, here * spread) - now
        now = seat(several, parent, others, PAIR_STRENGTH, discount, lambda live, _: 1 - rng.random(len(live)))
        if turn >= SWEEPS:
            mean[more] += now / SAMPLES
    tables[more] = now
    return np.maximum(customers - discount * mean, 0), discount * mean, tables


def _rooms(previous: np.ndarray) -> np.ndarray:
    """Number of each context among the distinct ones."""
    if (previous[1:] >= previous[:-1]).all():
        return np.cumsum(np.concatenate([[0], previous[1:] != previous[:-1]])[: len(previous)]).astype(np.int64)
    return np.unique(previous, return_inverse=True)[1]


def _distinct(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct whole numbers from 0 and each one's place among them; by a table where
    the largest is but a few times as large as there are numbers."""
    top = int(numbers.max(initial=-1)) + 1
    if top > 4 * len(numbers):
        return np.unique(numbers, return_inverse=True)
    there = np.zeros(top, bool)
    there[numbers] = True
    place = np.cumsum(there, dtype=np.int32)
    return np.flatnonzero(there), place[numbers] - 1


def _tight(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed blob, each by planes of equal bytes of its numbers, so that
    the high bytes of small numbers take no room."""
    planes = b"".join(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in map(np.ascontiguousarray, arrays))
    return np.array([len(a) for a in arrays], np.int64).tobytes() + pa.Codec("zstd").compress(planes, asbytes=True)


def _loose(blob: bytes, *kinds: type) -> list[np.ndarray]:
    sizes = np.frombuffer(blob, np.int64, len(kinds)).tolist()
    width = [np.dtype(k).itemsize for k in kinds]
    planes = pa.Codec("zstd").decompress(blob[8 * len(kinds) :], sum(m * w for m, w in zip(sizes, width)), asbytes=True)
    out, at = [], 0
    for kind, m, w in zip(kinds, sizes, width):
        part = np.frombuffer(planes, np.uint8, m * w, at).reshape(w, m)
        out.append(np.ascontiguousarray(part.T).reshape(-1).view(kind))
        at += m * w
    return out


def _starts(sizes: list[int]) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.array(sizes, np.int64))])


def _ordered(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Order by two whole numbers from 0, as one number where it fits."""
    width = int(second.max(initial=0)) + 1
    if (int(first.max(initial=0)) + 1) * width < 1 << 63:
        return np.argsort(first * width + second, kind="stable")
    return np.lexsort((second, first))


def _grouped(previous: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Contexts of ordered pairs (as steps from the one before) and the pairs of each."""
    first = np.flatnonzero(np.concatenate([[True], previous[1:] != previous[:-1]])[: len(previous)])
    return np.diff(previous[first], prepend=0), np.diff(np.append(first, len(previous))).astype(np.int32)


def word_tables(count: np.ndarray, base: np.ndarray, tables: float, discount: float, samples: int = SAMPLES) -> np.ndarray:
    """Mean tables of each word in the restaurant of words, given the tables of the sweep
    before, over seatings whose chance follows from the word's own count and
    spelling (so every chunk seats a word alike)."""
    mean = np.zeros(len(count))
    seed = base.astype(np.float64).view(np.uint64) ^ mix(count.astype(np.uint64))
    base = base.astype(np.float64)
    for sample in range(samples):
        def draw(live: np.ndarray, step: int) -> np.ndarray:
            bits = mix(seed[live] + np.uint64((step * SAMPLES + sample + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
            return ((bits >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53

        mean += seat(count, base, np.full(len(count), max(tables - 1, 0)), WORD_STRENGTH, discount, draw) / samples
    return mean


def fit(counts: DataFrame) -> DataFrame:
    """``key, p``: the averaged predictive probability of every counted key.

    Contexts that share their last two bytes form a group whose restaurants of
    order 2 and up hang together; groups are dealt over the partitions. Order 1
    and the root are 256 x 256 numbers at most, whatever the corpus, and are
    seated on the driver between the rounds.
    """
    spark = counts.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    group = F.shiftright("key", 8).bitwiseAND(F.lit(0xFFFF))
    table = cut_lineage(counts.withColumn("group", group).repartition(n, "group").select("key", "n"))

    def rounds(first_order: np.ndarray, turn: int, samples: int, predict: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
            if not held:
                return
            keys = np.concatenate([k for k, _ in held])
            order = np.argsort(keys)
            keys, number = keys[order].astype(np.uint64), np.concatenate([c for _, c in held])[order]
            p, dishes, sent = deep_sweeps(keys, number, first_order, SWEEPS, samples, turn * 1_000_003 + int(keys[0]) % 1_000_003)
            if predict:
                yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(p)], names=["key", "p"])
            else:
                yield pa.RecordBatch.from_arrays([pa.array(dishes.astype(np.int64)), pa.array(sent)], names=["dish", "customers"])

        return run

    first_order = np.full((256, 256), 1 / 256)
    for turn in range(ROUNDS - 1):
        sent = table.mapInArrow(lean(rounds(first_order, turn, 0, False)), "dish long, customers long")
        customers = np.zeros(1 << 16, np.int64)
        for r in sent.groupBy("dish").agg(F.sum("customers").alias("n")).collect():  # 65,536 rows at most
            customers[r["dish"]] = r["n"]
        first_order = shallow_sweeps(customers.reshape(256, 256), SWEEPS, turn)
    return table.mapInArrow(lean(rounds(first_order, ROUNDS, SAMPLES, True)), "key long, p double")


def _bucket(keys: np.ndarray, n: int) -> np.ndarray:
    return mix(keys) % np.uint64(n)


def score_texts(docs: DataFrame, training: Column, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id, training, n_tokens, n_known, train_tokens, base_score, score``.

    Rows whose ``training`` is true are learned from; all are scored, whole.
    Tokens are the words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z, then one
    end token. ``base_score`` is the add-one unigram log10 probability of the
    tokens (c + 1 over train tokens + distinct + 1), ``n_known`` the tokens with
    c > 0. ``score`` is the log10 probability that the model gives to the same
    token sequence. A token sits in the Pitman-Yor restaurant of the token before
    it (the end token before a text's first), learned from the running training
    texts. All these share as parent a restaurant of words, whose customers are
    their tables; its parent is a hierarchy of restaurants for the bytes that spell a word,
    each context of k bytes sharing the parent of its last k - 1 bytes. Like
    the unigrams, the model speaks of the known words and one class of unknown
    ones, whose probability is what the spelling leaves to unseen words. Null texts are empty (their end token is
    scored). Repeated rows each count and score. Without training rows all
    tokens are unknown, with score 0. An empty table gives an empty table.

    Texts are stored in chunks, as a vocabulary and its numbers in text order, in tables bucketed by
    chunk; what is kept of pairs is bucketed too, so that only questions and answers are shuffled. The chunks send
    their words and counts to buckets and are told the totals; the contexts of
    the spellings are counted over all known words and fitted; the chunk that owns a word
    asks the buckets that hold the fitted contexts and tells its probability to
    those who need it, so neither vocabulary nor model is ever whole in one place. Pairs of tokens are counted in their chunk
    and merged in the bucket of their context, under one discount estimated over all.
    In ``TURNS`` rounds the buckets ask for the words' probabilities and seat their
    pairs (at first given the words as counted), and the pairs' tables seat the
    restaurant of words anew.
    """
    spark = docs.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    vocabulary = _vocabularies(docs, training, id_col, text)
    request = "bucket int, chunk long, keys binary, counts binary"
    columns = ["bucket", "chunk", "keys", "counts"]

    def ask_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, spelling, end, counts in rows_of(batches):
            words, counts = _hashes(spelling, end), _loose(counts, np.int64)[0]
            yield _sent([(b, chunk, words[r].tobytes(), _tight(counts[r])) for b, r in dealt(_bucket(words, n))])

    def count_words(rows: list[tuple]) -> Iterator[tuple[int, bytes]]:
        asked = [np.frombuffer(r[2], np.uint64) for r in rows]
        distinct, number = np.unique(np.concatenate(asked), return_inverse=True)
        total = np.bincount(number, np.concatenate([_loose(r[3], np.int64)[0] for r in rows]), len(distinct)).astype(np.int64)
        told = total[number] << 1
        told[_first_places(number, len(distinct))] |= 1  # the first chunk to ask for a word owns it
        at = 0
        for r, a in zip(rows, asked):
            here = slice(at, at + len(a))
            yield r[1], _tight(told[here], np.diff(number[here], prepend=0))
            at += len(a)
        yield -1, np.array([total.sum(), (total > 0).sum(), (total == 1).sum(), (total == 2).sum()], np.int64).tobytes()

    asked = vocabulary.select("chunk", "spelling", "end", "counts").mapInArrow(lean(ask_words), request)
    counted = cut_lineage(by_bucket(asked, columns, count_words))
    sums = counted.where(F.col("chunk") == -1).select("answer").collect()  # four numbers for each bucket
    train_tokens, types, once, twice = np.sum([np.frombuffer(r["answer"], np.int64) for r in sums] or [[0] * 4], axis=0).tolist()
    discount = estimated_discount(once, twice)

    def own_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, spelling, end, known in rows_of(batches):
            count, own, ids = _known(_hashes(spelling, end), known, n)
            own &= count > 0
            words = spelling.split(b"\n") if spelling else []
            words.insert(end, b"")
            said = [w + b"\n" for w, mine in zip(words, own.tolist()) if mine]
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int64()), pa.array([_tight(ids, count)], pa.binary()),
                 pa.array([_tight(ids[own], count[own])], pa.binary()), pa.array([b"".join(said)], pa.binary())],
                names=["chunk", "told", "own", "spelling"])

    # every known word is spelled in one chunk, its owner
    known = by_chunk(counted.where(F.col("chunk") >= 0)).withColumnRenamed("answers", "known")
    told = vocabulary.join(known, "chunk").select("chunk", "spelling", "end", "known").mapInArrow(
        lean(own_words), "chunk long, told binary, own binary, spelling binary")
    owned = bucketed(told, "owned", "chunk", "zstd")
    model = fit(cut_lineage(symbol_counts(owned)))

    def ask_symbols(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, spelling in rows_of(batches):
            distinct = np.unique(spell(spelling.split(b"\n")[:-1])[0])
            yield _sent([(b, chunk, distinct[r].tobytes(), b"") for b, r in dealt(_bucket(distinct, n))])

    def offer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, p = batch.column(0).to_numpy().astype(np.uint64), batch.column(1).to_numpy()
            yield _sent([(b, -1, keys[r].tobytes(), np.log10(p[r]).tobytes()) for b, r in dealt(_bucket(keys, n))])

    def look_up(rows: list[tuple]) -> Iterator[tuple[int, bytes]]:
        held = [r for r in rows if r[1] == -1]
        keys = np.concatenate([np.frombuffer(r[2], np.uint64) for r in held])
        value = np.concatenate([np.frombuffer(r[3], np.float64) for r in held])
        order = np.argsort(keys)
        keys, value = keys[order], value[order]
        for r in rows:
            if r[1] != -1:
                yield r[1], value[np.searchsorted(keys, np.frombuffer(r[2], np.uint64))].astype(np.float32).tobytes()

    wanted = owned.select("chunk", "spelling").mapInArrow(lean(ask_symbols), request).union(model.mapInArrow(lean(offer), request))
    spelled = by_chunk(by_bucket(wanted, columns, look_up)).withColumnRenamed("answers", "spelled")

    def spell_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, own, spelling, values in rows_of(batches):
            ids, count = _loose(own, *OWN[:2])
            base = np.zeros(len(ids), np.float32)
            key, ptr = spell(spelling.split(b"\n")[:-1])
            if len(key):
                distinct, number = np.unique(key, return_inverse=True)
                value = gathered(_bucket(distinct, n), values, np.float32).astype(np.float64)
                base[:] = 10 ** np.add.reduceat(value[number], ptr[:-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int64()), pa.array([_tight(ids, count, base)], pa.binary()),
                 pa.array([float(base.sum(dtype=np.float64))])], names=["chunk", "own", "spelled"])

    out = owned.select("chunk", "own", "spelling").join(spelled, "chunk", "left").select("chunk", "own", "spelling", "spelled").mapInArrow(
        lean(spell_out), "chunk long, own binary, spelled double")
    based = bucketed(out, "spelled", "chunk", "none")
    spelled_known = float(based.agg(F.sum("spelled")).first()[0] or 0)

    def parties(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
        """The own words of chunks, several chunks together: a word is seated alike wherever it is."""
        held, size = [], 0
        for (blob,) in rows_of(batches):
            held.append(_loose(blob, *OWN))
            size += len(held[-1][0])
            if size >= PARTY:
                yield [np.concatenate(x) for x in zip(*held)]
                held, size = [], 0
        if held:
            yield [np.concatenate(x) for x in zip(*held)]

    def restaurant(table: DataFrame, start: int, discount: float) -> tuple[float, float]:
        """Tables of the restaurant of words, of the last sweep but one and of the last."""
        def seated(tables: float) -> float:
            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for _, guests, base in parties(batches):
                    total = float(word_tables(guests, base, tables, discount, 1).sum())
                    yield pa.RecordBatch.from_arrays([pa.array([total])], names=["tables"])

            return float(table.select("own").mapInArrow(lean(run), "tables double").agg(F.sum("tables")).first()[0] or 0)

        # each sweep reseats every word given the tables of the sweep before
        before, tables = float(start), seated(float(start))
        for _ in range(SWEEPS - 1):
            before, tables = tables, seated(tables)
        return before, tables

    def predicted(customers: np.ndarray, base: np.ndarray, before: float, unseen: float, guests: int, discount: float) -> np.ndarray:
        own = np.maximum(customers - discount * word_tables(customers, base, before, discount), 0)
        return own / (WORD_STRENGTH + guests) + unseen * base.astype(np.float64)

    before, tables = restaurant(based, types, discount)
    unseen = (WORD_STRENGTH + discount * tables) / (WORD_STRENGTH + train_tokens)  # chance of a new table

    # the words of each pair by number, merged in the bucket of their context
    def ask_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, flags, sizes, places, end, blob in rows_of(batches):
            ids, count = _loose(blob, *TOLD)
            _, first, second, pair = token_pairs(places, _starts(sizes), end, ids)
            learned = np.repeat(np.array(flags, bool), sizes)
            times = np.bincount(pair, learned, len(first)).astype(np.int32)
            for b, r in dealt(known_buckets(first, second, ids, count)):
                if b < n:
                    step, size = _grouped(ids[first[r]])
                    hot = is_hot(count[first[r]][np.cumsum(size) - size], train_tokens, n).astype(np.uint8)
                    yield _sent([(b, chunk, _tight(step, size, ids[second[r]], times[r], hot), b"")])

    def known_buckets(first: np.ndarray, second: np.ndarray, ids: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Buckets of pairs; ``n`` for pairs with an unknown word, which no bucket knows."""
        known = count > 0
        return np.where(known[first] & known[second], pair_buckets(first, second, ids, count, train_tokens, n), n)

    def merge_pairs(rows: list[tuple]) -> Iterator[tuple[int, bytes]]:
        asked = [_loose(r[2], *PAIRS) for r in rows]
        previous = np.concatenate([np.repeat(np.cumsum(a[0]), a[1]) for a in asked])
        token = np.concatenate([a[2] for a in asked])
        hot = np.concatenate([np.repeat(a[4], a[1]) for a in asked])
        times, sizes = np.concatenate([a[3] for a in asked]), [len(a[2]) for a in asked]
        del asked
        order = _ordered(previous, token)
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(previous[order]) != 0) | (np.diff(token[order]) != 0)
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(new) - 1
        first = order[new]
        customers = np.bincount(number, times, len(first)).astype(np.int64)
        step, size = _grouped(previous[first])
        yield -1, _tight(step, size, token[first], customers, hot[first][np.cumsum(size) - size])
        yield -2, np.array([(customers == 1).sum(), (customers == 2).sum()], np.int64).tobytes()
        shared_out = (hot[first] > 0) & (customers > 0)
        yield -3, _tight(*np.unique(previous[first][shared_out], return_counts=True))
        at = 0
        for r, size in zip(rows, sizes):
            yield r[1], _tight(np.diff(number[at : at + size], prepend=0))
            at += size

    read = vocabulary.select("chunk", "flags", "sizes", "places", "end").join(owned.select("chunk", "told"), "chunk")
    asked = read.select("chunk", "flags", "sizes", "places", "end", "told").mapInArrow(lean(ask_pairs), request)
    found = by_bucket(asked, columns, merge_pairs).withColumn("bucket", F.col("bucket").cast("long"))
    paired = bucketed(found, "pairs", "bucket", "none")
    sums = paired.where(F.col("chunk") == -2).select("answer").collect()  # two numbers for each bucket
    pair_discount = estimated_discount(*np.sum([np.frombuffer(r["answer"], np.int64) for r in sums] or [[0] * 2], axis=0).tolist())
    merged = paired.where(F.col("chunk") == -1).select("bucket", "answer")

    def hot_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in _loose(blob, np.int64, np.int64)], names=["id", "tables"])

    def hot_sums(rows: DataFrame, *names: str) -> list[np.ndarray]:
        """Sums of each hot context in order of its number: fewer rows than there are buckets."""
        found = rows.groupBy("id").agg(*[F.sum(c).cast("double").alias(c) for c in names]).orderBy("id").collect()
        return [np.array([r["id"] for r in found], np.int64), *[np.array([r[c] for r in found]) for c in names]]

    def ask_parents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, blob in rows_of(batches):
            ids, _ = _distinct(_loose(blob, *MERGED)[2])
            yield _sent([(b, bucket, _tight(ids[r]), b"") for b, r in dealt(ids % n)])

    def tell_parents(rows: list[tuple]) -> Iterator[tuple[int, bytes]]:
        held = [_loose(r[2], np.int64, np.float32) for r in rows if r[1] == -1]
        value = np.zeros(1 + max((int(i[-1]) // n for i, _ in held if len(i)), default=0), np.float32)
        for i, p in held:
            value[i // n] = p
        for r in rows:
            if r[1] != -1:
                yield r[1], _tight(value[_loose(r[2], np.int64)[0] // n])

    def offered(words: DataFrame, parent: Callable) -> DataFrame:
        """The probability of each known word, from a chunk that owns it."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for ids, guests, base in parties(batches):
                own = np.argsort(ids)
                p = parent(guests[own], base[own]).astype(np.float32)
                yield _sent([(b, -1, _tight(ids[own][r], p[r]), b"") for b, r in dealt(ids[own] % n)])

        return words.select("own").mapInArrow(lean(run), request)

    def seat_turn(words: DataFrame, parent: Callable, turn: int, last: DataFrame | None) -> DataFrame:
        """Every bucket's pairs seated given the words: what they keep, their contexts
        leave, the tables sent to each word, and the sums of hot contexts; a written table.
        Hot contexts have as many tables in other buckets as in the turn before (``last``), at
        first one for each pair."""
        totals = hot_ids, hot_tables

        def seat_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for bucket, blob, answers, earlier in rows_of(batches):
                step, size, token, customers, hot = _loose(blob, *MERGED)
                contexts, hot = np.cumsum(step), hot.astype(bool)
                ids, at = _distinct(token)
                p = np.zeros(len(ids), np.float32)
                told = {a["bucket"]: a["answer"] for a in answers}
                for b, r in dealt(ids % n):
                    p[r] = _loose(told[b], np.float32)[0]
                room = np.repeat(np.arange(len(size)), size)
                elsewhere = np.full(len(size), -1.0)
                if hot.any():  # the same contexts in the same order in every turn
                    own = [h["tables"] for h in earlier] if turn else np.bincount(room, customers > 0, len(size))[hot]
                    told = np.zeros(int(hot.sum()))
                    held = np.isin(contexts[hot], totals[0])
                    told[held] = totals[1][np.searchsorted(totals[0], contexts[hot][held])]
                    elsewhere[hot] = np.maximum(told - own, 0)
                keep, left, sent = pair_sweeps(room, customers, p[at].astype(np.float64), np.ones(len(room), np.int64),
                                               turn * n + bucket, pair_discount, elsewhere[room])
                left, tables = np.bincount(room, left, len(size)), np.bincount(room, sent, len(size))
                served = np.bincount(at, sent, len(ids)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([bucket], pa.int64()), pa.array([_tight(keep.astype(np.float32), left, size)], pa.binary()),
                     pa.array([_tight(ids[served > 0], served[served > 0])], pa.binary()),
                     pa.array([list(zip(contexts[hot].tolist(), left[hot].tolist(), tables[hot].tolist()))],
                              pa.list_(pa.struct([("id", pa.int64()), ("left", pa.float64()), ("tables", pa.float64())])))],
                    names=["bucket", "kept", "served", "hot"])

        wanted = merged.mapInArrow(lean(ask_parents), request).union(offered(words, parent))
        parents = by_chunk(by_bucket(wanted, columns, tell_parents)).withColumnRenamed("chunk", "bucket")
        earlier = F.array().cast(HOT) if last is None else F.col("hot")
        rows = merged.join(parents, "bucket") if last is None else merged.join(parents, "bucket").join(last.select("bucket", "hot"), "bucket")
        found = rows.select("bucket", "answer", "answers", earlier.alias("earlier")).mapInArrow(
            lean(seat_bucket), f"bucket long, kept binary, served binary, hot {HOT}")
        return bucketed(found, "seated", "bucket", "none")

    # the restaurant of words again: its customers are the tables of the pairs
    def offer_tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                ids, sent = _loose(blob, np.int64, np.int64)
                yield _sent([(b, -1, _tight(ids[r]), _tight(sent[r])) for b, r in dealt(ids % n)])

    def ask_of(kinds: tuple) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        """Asks for the known words of a chunk (number and count or customers first in its blobs)."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for chunk, blob in rows_of(batches):
                ids, count = _loose(blob, *kinds)[:2]
                ids = ids[count > 0]
                yield _sent([(b, chunk, _tight(ids[r]), b"") for b, r in dealt(ids % n)])

        return run

    def count_tables(rows: list[tuple]) -> Iterator[tuple[int, bytes]]:
        keys = [_loose(r[2], np.int64)[0] // n for r in rows]
        total = np.zeros(1 + max(int(k.max()) for k in keys), np.int64)
        for r, k in zip(rows, keys):
            if r[1] == -1:
                np.add.at(total, k, _loose(r[3], np.int64)[0])
        for r, k in zip(rows, keys):
            if r[1] >= 0:
                yield r[1], _tight(total[k])
        yield -1, np.array([total.sum(), (total == 1).sum(), (total == 2).sum()], np.int64).tobytes()

    def customers_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, blob, answers in rows_of(batches):
            ids, _, base = _loose(blob, *OWN)
            served = np.zeros(len(ids), np.int64)
            told = {a["bucket"]: a["answer"] for a in answers or []}
            for b, r in dealt(ids % n):
                served[r] = _loose(told[b], np.int64)[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int64()), pa.array([_tight(ids, served, base)], pa.binary())], names=["chunk", "own"])

    served, guests, shared = based, train_tokens, discount
    seated = None
    hot_ids, hot_tables = hot_sums(paired.where(F.col("chunk") == -3).select("answer").mapInArrow(lean(hot_pairs), "id long, tables long"), "tables")
    for turn in range(TURNS):
        seated = seat_turn(served, partial(predicted, before=before, unseen=unseen, guests=guests, discount=shared), turn, seated)
        hot_ids, hot_left, hot_tables = hot_sums(seated.select(F.inline("hot")), "left", "tables")
        wanted = based.select("chunk", "own").mapInArrow(lean(ask_of(OWN)), request).union(seated.select("served").mapInArrow(lean(offer_tables), request))
        counted = cut_lineage(by_bucket(wanted, columns, count_tables))
        sums = counted.where(F.col("chunk") == -1).select("answer").collect()  # three numbers for each bucket
        guests, once, twice = np.sum([np.frombuffer(r["answer"], np.int64) for r in sums] or [[0] * 3], axis=0).tolist()
        shared = estimated_discount(once, twice)
        path = scratch_path(spark, "served")
        based.select("chunk", "own").join(by_chunk(counted.where(F.col("chunk") >= 0)), "chunk", "left").mapInArrow(
            lean(customers_of), "chunk long, own binary").write.option("compression", "none").parquet(path)
        served = spark.read.parquet(path)
        before, tables = restaurant(served, types, shared)
        unseen = (WORD_STRENGTH + shared * tables) / (WORD_STRENGTH + guests)
    unknown = unseen * max(1 - spelled_known, 1e-12)
    final = partial(predicted, before=before, unseen=unseen, guests=guests, discount=shared)
    wanted = owned.select("chunk", "told").mapInArrow(lean(ask_of(TOLD)), request).union(offered(served, final))
    parents = by_chunk(by_bucket(wanted, columns, tell_parents)).withColumnRenamed("answers", "parents")

    def answer_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, index, kept in rows_of(batches):
            keep, left, size = _loose(kept, np.float32, np.float64, np.int32)
            room = np.repeat(np.arange(len(size)), size)
            found = []
            for asked in index:
                pairs = np.cumsum(_loose(asked["answer"], np.int64)[0])
                at = room[pairs]
                found.append(_tight(keep[pairs], left[at[np.concatenate([[True], at[1:] != at[:-1]])]]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([a["chunk"] for a in index], pa.int64()), pa.array([bucket] * len(index), pa.int32()),
                 pa.array(found, pa.binary())], names=["chunk", "bucket", "answer"])

    index = paired.where(F.col("chunk") >= 0).groupBy("bucket").agg(F.collect_list(F.struct("chunk", "answer")).alias("index"))
    met = index.join(seated.select("bucket", "kept"), "bucket").select("bucket", "index", "kept")
    answered = by_chunk(met.mapInArrow(lean(answer_chunks), "chunk long, bucket int, answer binary"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, flags, sizes, places, end, blob, parents, answers in rows_of(batches):
            ids, count = _loose(blob, *TOLD)
            ptr = _starts(sizes)
            number, first, second, pair = token_pairs(places, ptr, end, ids)
            plain = np.log10((count + 1) / (train_tokens + types + 1))
            shared_p = np.full(len(ids), unknown)
            known = np.flatnonzero(count > 0)
            said = {a["bucket"]: a["answer"] for a in parents or []}
            for b, r in dealt(ids[known] % n):
                shared_p[known[r]] = _loose(said[b], np.float32)[0]
            keep, left = np.zeros(len(first)), np.zeros(len(ids))
            told = {a["bucket"]: a["answer"] for a in answers or []}
            for b, r in dealt(known_buckets(first, second, ids, count)):
                if b < n:
                    keep[r], reserve = _loose(told[b], np.float32, np.float64)
                    context = first[r]
                    left[context[np.concatenate([[True], context[1:] != context[:-1]])]] = reserve
            hot = np.flatnonzero(is_hot(count, train_tokens, n) & np.isin(ids, hot_ids))
            left[hot] = hot_left[np.searchsorted(hot_ids, ids[hot])]
            p = np.log10((keep + (PAIR_STRENGTH + left[first]) * shared_p[second]) / (PAIR_STRENGTH + count[first]))
            seen = np.add.reduceat((count > 0).astype(np.int64)[number], ptr[:-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(flags, pa.bool_()), pa.array(np.diff(ptr)), pa.array(seen),
                 pa.array(np.full(len(rows), train_tokens, np.int64)), pa.array(np.add.reduceat(plain[number], ptr[:-1])),
                 pa.array(np.add.reduceat(p[pair], ptr[:-1]))],
                names=["doc_id", "training", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    told = vocabulary.select("chunk", "ids", "flags", "sizes", "places", "end").join(owned.select("chunk", "told"), "chunk")
    told = told.join(parents, "chunk", "left").join(answered, "chunk", "left")
    return told.select("ids", "flags", "sizes", "places", "end", "told", "parents", "answers").mapInArrow(
        lean(score), "doc_id long, training boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def perplexity(score: Column, n_tokens: Column) -> Column:
    """Perplexity a token from a log10 probability."""
    return F.pow(F.lit(10.0), -score / n_tokens)


def _sent(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
    columns = list(zip(*rows)) if rows else [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["bucket", "chunk", "keys", "counts"])
