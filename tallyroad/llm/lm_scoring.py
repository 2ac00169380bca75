"""Language-model scoring by a hierarchical Pitman-Yor model.

The dishes are words and the end of a text. Every word that stands before another one, and
the start of a text, is a context with a restaurant of its own; all share one parent, the
root, over a base without atoms, so that a word that training never saw takes the root's
whole unseen mass. Counts cover every training document, nothing is merged or cut.

Seating is sampled by Gibbs. Given the root, restaurants are independent; given a drawn
strength of a restaurant (a gamma variable that stands for its total number of tables),
its dishes are independent too, and all customers of a dish leave and are seated again
jointly, which needs the number of their tables only: its law is that of generalised
Stirling numbers (see ``seat``). After a round of sweeps the root is seated from the tables
of all restaurants, and the next round begins; in the last one the predictive
probabilities of SAMPLES sweeps are averaged. Every draw is a hash of its restaurant, dish
and sweep, so results depend neither on the number of partitions nor on their order.

Texts are tokenised in chunks. A chunk sends its (context, word) pairs, with the documents
that hold them, to the contexts' blocks; blocks learn about the root by exchanging numbers
of words with the words' blocks, and answer with sums for each document, so no vocabulary
is ever broadcast and no text is read twice.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroad.llm import common

#: Discount and strength of the context restaurants and of the root.
D1, S1, D0, S0 = 0.8, 1.0, 0.8, 50.0
#: Rounds that end with a new root, sweeps of a round that are not used and that are, and tables of Stirling numbers.
ROUNDS, BURN, SAMPLES, EXACT = 2, 4, 8, 512
#: Bytes of texts in a chunk.
CHUNK = 5 << 20
FOLDS, ADD = 10, 0.1
START, END = np.uint64(0xD1B54A32D192ED03), np.uint64(0x9E3779B97F4A7C15)
#: Sums of logarithms travel as whole numbers of this part of one, so that their order changes nothing.
UNIT = float(1 << 32)
_LOWER = bytes.maketrans(common.UPPER.encode(), common.LOWER.encode())
_KEPT_WORDS = 500_000


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def held_out(doc_id: int | None) -> bool | None:
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % FOLDS == 0


def _zip(*arrays: np.ndarray) -> bytes:
    """Integer arrays in one compressed value; equal bytes of neighbours stand together."""
    head = np.array([len(arrays), *[x for a in arrays for x in (len(a), a.dtype.itemsize, a.dtype.kind == "u")]], np.int64)
    planes = b"".join(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T).tobytes() for a in map(np.ascontiguousarray, arrays) if len(a))
    return zstandard.ZstdCompressor(level=1).compress(head.tobytes() + planes)


def _unzip(raw: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(raw)
    n = int(np.frombuffer(data, np.int64, 1)[0])
    out, at = [], 8 + 24 * n
    for size, item, unsigned in np.frombuffer(data, np.int64, 3 * n, 8).reshape(n, 3).tolist():
        planes = np.frombuffer(data, np.uint8, size * item, at).reshape(item, size)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(np.dtype(f"{'u' if unsigned else 'i'}{item}")))
        at += size * item
    return out


# ---- draws


def _mixed(*keys) -> np.ndarray:
    """64-bit hash of its keys, which are arrays or numbers."""
    x = np.uint64(0x2545F4914F6CDD1D)
    with np.errstate(over="ignore"):
        for k in keys:
            x = (x ^ np.asarray(k, np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
            x = x ^ (x >> np.uint64(29))
            x = x * np.uint64(0x94D049BB133111EB)
            x = x ^ (x >> np.uint64(32))
    return x


def uniform(*keys) -> np.ndarray:
    """Numbers in (0, 1) made from keys."""
    return ((_mixed(*keys) >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def gamma(shape: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A gamma variable for each shape and key, by a squeezed cubed normal that is tried until it fits."""
    grown = np.where(shape < 1, shape + 1, shape)
    d = grown - 1 / 3
    out, todo, turn = np.zeros(len(shape)), np.arange(len(shape)), 0
    while len(todo):
        k = key[todo]
        z = np.sqrt(-2 * np.log(uniform(k, 3 * turn + 1))) * np.cos(2 * np.pi * uniform(k, 3 * turn + 2))
        v = (1 + z / np.sqrt(9 * d[todo])) ** 3
        with np.errstate(invalid="ignore", divide="ignore"):
            fits = (v > 0) & (np.log(uniform(k, 3 * turn + 3)) < 0.5 * z**2 + d[todo] * (1 - v + np.log(v)))
        out[todo[fits]] = d[todo[fits]] * v[fits]
        todo, turn = todo[~fits], turn + 1
    return np.where(shape < 1, out * uniform(key, 0) ** (1 / np.maximum(shape, 1e-12)), out)


@cache
def log_stirling(most: int, discount: float) -> np.ndarray:
    """Logarithms of the weights of seating n customers at t tables, for all n and t up to ``most``."""
    out = np.full((most + 1, most + 2), -np.inf)
    out[1, 1] = 0.0
    t = np.arange(most + 2)
    for n in range(1, most):
        with np.errstate(divide="ignore", invalid="ignore"):
            stay = np.where(n - discount * t > 0, np.log(np.maximum(n - discount * t, 1e-300)), -np.inf) + out[n]
        out[n + 1, 1:] = np.logaddexp(out[n, :-1], stay[1:])
    return out


def _choose(logits: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Index drawn from each row's weights by a uniform number."""
    weights = np.cumsum(np.exp(logits - logits.max(axis=1, keepdims=True)), axis=1)
    return np.minimum((weights < u[:, None] * weights[:, -1:]).sum(axis=1), logits.shape[1] - 1)


def _seat_many(n: int, a: float, u: float, seed: int) -> int:
    """As ``seat``, for more than EXACT customers: the first EXACT exactly, with the weight that the others give each number of
    their tables, by the saddle point of the others' generating function (1 - x)^-y exp(a (1 - (1 - x)^D1) / D1); then the others' tables."""
    t = np.arange(1, EXACT + 1)
    y, m = EXACT - D1 * t, n - EXACT
    low, high = np.full(EXACT, -60.0), np.full(EXACT, -1e-12)  # logarithm of z = 1 - x
    mid = np.clip(np.log(y) - np.log(m + y), low, high)
    for _ in range(60):  # Newton's steps on logarithms, halves where they leave the bounds
        z = np.exp(mid)
        first, second = y / z, a * z ** (D1 - 1)
        over = np.log(-np.expm1(mid) * (first + second)) - np.log(m)
        low, high = np.where(over > 0, mid, low), np.where(over > 0, high, mid)
        step = mid + over / (z / (1 - z) + (first + (1 - D1) * second) / (first + second))
        step = np.where((step > low) & (step < high), step, (low + high) / 2)
        done = np.abs(step - mid).max() < 1e-8  # the weights below don't change in first order
        mid = step
        if done:
            break
    z = np.exp(mid)
    x = 1 - z
    others = a / D1 * (1 - z**D1)
    bend = m + x**2 * (y / z**2 + a * (1 - D1) * z ** (D1 - 2))
    weight = log_stirling(EXACT, D1)[EXACT, 1 : EXACT + 1] + t * np.log(a) - y * np.log(z) + others - m * np.log(x) - 0.5 * np.log(bend)
    k = int(_choose(weight[None], np.array([u]))[0])
    return int(min(n, t[k] + np.random.default_rng(seed).poisson(others[k])))


def seat(customers: np.ndarray, a: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Tables of each dish's customers, all seated anew: t tables have the weight S(customers, t) a^t, with generalised Stirling numbers S of discount D1."""
    tables = (customers > 0).astype(np.int64)
    u, loga = uniform(key, 1), np.log(a)
    order = np.argsort(customers, kind="stable")
    order = order[np.searchsorted(customers[order], 2) :]
    counts = customers[order]
    cuts = np.flatnonzero(np.diff(counts, prepend=-1))
    for low, high in zip(cuts.tolist(), np.append(cuts, len(order))[1:].tolist(), strict=True):
        n = int(counts[low])
        if n > EXACT:
            for i in order[low:high].tolist():
                tables[i] = _seat_many(n, float(a[i]), float(u[i]), int(key[i]))
            continue
        weight, t = log_stirling(EXACT, D1)[n, 1 : n + 1], np.arange(1, n + 1)
        step = max(1, (1 << 20) // n)
        for b in range(low, high, step):
            rows = order[b : min(b + step, high)]
            tables[rows] = 1 + _choose(weight + loga[rows, None] * t, u[rows])
    return tables


class Restaurants:
    """The restaurants of some contexts: customers ``count`` of the pairs (``context``, ``word``) of numbered contexts and words."""

    def __init__(self, context: np.ndarray, word: np.ndarray, count: np.ndarray, context_key: np.ndarray, word_key: np.ndarray):
        self.context, self.word, self.count, self.context_key = context, word, count, context_key
        self.key = _mixed(context_key[context], word_key[word])
        self.customers = np.bincount(context, count, len(context_key)).astype(np.int64)
        self.tables = (count > 0).astype(np.int64)
        # a lone customer has one table, so sweeps need the other pairs and their contexts only
        self.some = np.flatnonzero(count > 1)
        self.some_contexts, self.some_context = np.unique(context[self.some], return_inverse=True)
        self.lone = np.bincount(context[count == 1], minlength=len(context_key)).astype(np.int64)

    def totals(self) -> np.ndarray:
        """Tables of each restaurant."""
        out = self.lone.copy()
        out[self.some_contexts] += np.bincount(self.some_context, self.tables[self.some], len(self.some_contexts)).astype(np.int64)
        return out

    def sweep(self, root: np.ndarray, turn: int) -> None:
        """Draw the strengths given the tables, then all tables given the strengths and the root's probability of each word."""
        some, at = self.some, self.some_contexts
        strength = gamma(S1 / D1 + self.totals()[at], _mixed(self.context_key[at], turn))
        self.tables[some] = seat(self.count[some], D1 * strength[self.some_context] * root[self.word[some]], _mixed(self.key[some], turn))

    def predict(self, root: np.ndarray, turns: range) -> np.ndarray:
        """Probability of each pair's word in its context, the mean of sweeps."""
        own, all_ = (self.count == 1).astype(np.float64), np.zeros(len(self.context_key))
        mean = np.zeros(len(self.some))
        for turn in turns:
            self.sweep(root, turn)
            mean += self.tables[self.some]
            all_ += self.totals()
        own[self.some], all_ = mean / len(turns), all_ / len(turns)
        return (self.count - D1 * own + (S1 + D1 * all_[self.context]) * root[self.word]) / (S1 + self.customers[self.context])


def root_probabilities(tables: np.ndarray, n_tables: int, n_words: int) -> np.ndarray:
    """Root's probability of words that have so many tables in all restaurants; one without any is the unknown word."""
    return np.where(tables > 0, tables - D0, S0 + D0 * n_words) / (S0 + n_tables)


# ---- chunks


def _least(a: np.ndarray) -> np.ndarray:
    """Numbers from 0 in as few bytes as they need."""
    return a.astype(np.min_scalar_type(int(a.max(initial=0))))


def _ask(places: list[int]):
    """Documents -> for each chunk and block the contexts, words and documents of its pairs, and once for each chunk what its documents are."""
    n = len(places)

    def made(chunk: int, ids: list, texts: list[bytes], words: _Hashes) -> pa.RecordBatch:
        if len(words) > _KEPT_WORDS:
            words.clear()
        parts, lengths = [], []
        for t in texts:
            found = t.translate(_LOWER).split()
            parts += [np.array([START]), np.fromiter(map(words.__getitem__, found), np.uint64, len(found)), np.array([END])]
            lengths.append(len(found) + 2)
        tokens, lengths = np.concatenate(parts), np.array(lengths)
        ends = np.cumsum(lengths)
        train = np.array([held_out(i) is False for i in ids], bool)
        known, at = np.unique(tokens, return_inverse=True)
        first = np.ones(len(tokens), bool)
        first[ends - 1] = False  # the end is no context
        first = np.flatnonzero(first)
        context, word, doc = at[first], at[first + 1], np.repeat(np.arange(len(ids)), lengths - 1)
        block = ((known >> np.uint64(33)) % np.uint64(n)).astype(np.int64)
        rank = np.empty(len(known), np.int64)
        rank[np.argsort(block, kind="stable")] = np.arange(len(known))
        code = rank[context] * len(known) + word
        order = np.argsort(code, kind="stable")  # documents of a pair stay in order
        code, context, word, doc = code[order], context[order], word[order], doc[order]
        pair = np.flatnonzero(np.diff(code, prepend=-1))
        size = np.diff(np.append(pair, len(code)))
        pair_context, pair_word = context[pair], word[pair]
        cuts = np.searchsorted(block[pair_context], np.arange(n + 1))
        bits = np.packbits(train)
        chunks, buckets, packets, infos = [], [], [], []
        for b in range(n):
            lo, hi = int(cuts[b]), int(cuts[b + 1])
            if lo == hi:
                continue
            begin, end = pair[lo], pair[hi - 1] + size[hi - 1]
            start = np.flatnonzero(np.diff(pair_context[lo:hi], prepend=-1))
            buckets.append(places[b])
            packets.append(_zip(known[pair_context[lo:hi][start]], _least(np.diff(np.append(start, hi - lo))), known[pair_word[lo:hi]], _least(size[lo:hi]), _least(doc[begin:end]), bits))
            infos.append(None)
        # what is known of the documents goes with any block
        buckets.append(places[chunk % n])
        packets.append(None)
        is_known = np.array([i is not None for i in ids], np.uint8)
        infos.append(_zip(np.array([i or 0 for i in ids], np.int64), is_known, _least(lengths - 1)))
        chunks = [chunk] * len(buckets)
        return pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), pa.array(chunks, pa.int64()), pa.array(packets, pa.binary()), pa.array(infos, pa.binary())], names=["bucket", "chunk", "packet", "info"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Hashes()
        numbers = itertools.count(TaskContext.get().partitionId() << 32)
        ids: list = []
        texts: list[bytes] = []
        size = 0
        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids.append(i)
                texts.append(t or b"")
                size += len(texts[-1]) + 64
                if size >= CHUNK:
                    yield made(next(numbers), ids, texts, words)
                    ids, texts, size = [], [], 0
        if ids:
            yield made(next(numbers), ids, texts, words)

    return run


class _Block:
    """All pairs that chunks ask a block for, with their training counts."""

    def __init__(self, asks: pa.Table):
        self.chunks, self.packets, self.infos = [], [], []
        for chunk, packet, info in sorted(zip(*(asks.column(c).to_pylist() for c in ("chunk", "packet", "info")), strict=True), key=lambda r: (r[0], r[1] is None)):
            if packet is None:
                self.infos.append((chunk, info))
            else:
                self.chunks.append(chunk)
                self.packets.append(_unzip(packet))
        parts = [(np.repeat(c, k), w) for c, k, w, *_ in self.packets]
        empty = np.zeros(0, np.uint64)
        self.context_key, context = np.unique(np.concatenate([empty, *[c for c, _ in parts]]), return_inverse=True)
        self.word_key, word = np.unique(np.concatenate([empty, *[w for _, w in parts]]), return_inverse=True)
        code, self.pair_of = np.unique(context * max(1, len(self.word_key)) + word, return_inverse=True)
        trained = [np.add.reduceat(self._train(p)[p[4]], np.cumsum(p[3], dtype=np.int64) - p[3]).astype(np.int64) for p in self.packets]
        count = np.bincount(self.pair_of, np.concatenate([np.zeros(0), *trained]), len(code)).astype(np.int64)
        self.restaurants = Restaurants(code // max(1, len(self.word_key)), code % max(1, len(self.word_key)), count, self.context_key, self.word_key)

    @staticmethod
    def _train(packet: list[np.ndarray]) -> np.ndarray:
        return np.unpackbits(packet[5]).astype(np.int64)

    def _by_place(self, n: int) -> Iterator[tuple[int, np.ndarray]]:
        place = ((self.word_key >> np.uint64(20)) % np.uint64(n)).astype(np.int64)
        order = np.argsort(place, kind="stable")
        cuts = np.searchsorted(place[order], np.arange(n + 1))
        for b in range(n):
            yield b, order[cuts[b] : cuts[b + 1]]

    def tell(self, places: list[int], bucket: int) -> pa.RecordBatch:
        """The words of this block with their tables and customers here, for the words' blocks; every one of these is asked for its sums."""
        r = self.restaurants
        tables, count = (np.bincount(r.word, x, len(self.word_key)).astype(np.int64) for x in (r.tables, r.count))
        rows = [(places[b], bucket, _zip(self.word_key[w], _least(tables[w]), _least(count[w]))) for b, w in self._by_place(len(places))]
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows], kind) for k, kind in enumerate((pa.int32(), pa.int32(), pa.binary()))], names=["place", "bucket", "packet"])

    def hear(self, places: list[int], replies: pa.Table) -> None:
        """Take the words' tables and customers in all restaurants from the replies."""
        told = {p: _unzip(x) for p, x in zip(replies.column("place").to_pylist(), replies.column("packet").to_pylist(), strict=True)}
        tables, self.count = np.zeros(len(self.word_key), np.int64), np.zeros(len(self.word_key), np.int64)
        sums = np.zeros(3, np.int64)
        for b, w in self._by_place(len(places)):
            tables[w], self.count[w] = told[places[b]][0], told[places[b]][1]
            sums += told[places[b]][2]
        self.n_words, self.n_train = int(sums[1]), int(sums[2])
        self.root = root_probabilities(tables, int(sums[0]), self.n_words)

    def answers(self, turns: range) -> pa.RecordBatch:
        """For each chunk the sums of its documents, and what its documents are."""
        r = self.restaurants
        score = np.round(np.log10(r.predict(self.root, turns)) * UNIT).astype(np.int64)
        base = np.round(np.log10((self.count + ADD) / (self.n_train + ADD * (self.n_words + 1))) * UNIT).astype(np.int64)
        base, known = base[r.word], (self.count > 0)[r.word]
        rows, low = [], 0
        for chunk, (_, _, words, size, doc, _) in zip(self.chunks, self.packets, strict=True):
            pair = self.pair_of[low : low + len(words)]
            low += len(words)
            held = np.bincount(doc)  # documents are numbered from 0 in a chunk
            docs, token = np.flatnonzero(held), np.repeat(pair, size)
            low_bits = (1 << 26) - 1  # two exact sums of halves

            def add(x, doc=doc, docs=docs, token=token, low_bits=low_bits):
                v = x[token]
                return (np.bincount(doc, v >> 26)[docs].astype(np.int64) << 26) + np.bincount(doc, v & low_bits)[docs].astype(np.int64)

            rows.append((chunk, _zip(docs, add(score), add(base), _least(np.bincount(doc, known[token])[docs].astype(np.int64))), None))
        rows += [(chunk, None, info) for chunk, info in self.infos]
        names = ["chunk", "packet", "info", "train_tokens"]
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows], pa.int64()), pa.array([x[1] for x in rows], pa.binary()), pa.array([x[2] for x in rows], pa.binary()), pa.array([self.n_train] * len(rows), pa.int64())], names=names)


def _root(key: tuple, told: pa.Table) -> pa.Table:
    """Add up the words of a place, and answer each block about the words it told."""
    place = key[0].as_py()
    order = np.argsort(told.column("bucket").to_numpy())
    buckets = told.column("bucket").to_numpy()[order].tolist()
    parts = [_unzip(told.column("packet")[int(i)].as_py()) for i in order]
    word, of = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    tables, count = (np.bincount(of, np.concatenate([p[k].astype(np.int64) for p in parts]), len(word)).astype(np.int64) for k in (1, 2))
    sums = np.array([tables.sum(), (count > 0).sum(), count.sum()], np.int64)
    cuts = np.cumsum([len(p[0]) for p in parts])
    replies = [_zip(_least(tables[w]), _least(count[w]), sums) for w in np.split(of, cuts[:-1])]
    return pa.table([pa.array(buckets, pa.int32()), pa.array([place] * len(buckets), pa.int32()), pa.array(replies, pa.binary())], names=["bucket", "place", "packet"])


def _finish(key: tuple, answers: pa.Table) -> pa.Table:
    """Documents of a chunk from the sums of all blocks."""
    rows = list(zip(answers.column("packet").to_pylist(), answers.column("info").to_pylist(), strict=True))
    ids, known, lengths = _unzip(next(i for _, i in rows if i is not None))
    sums = np.zeros((3, len(ids)), np.int64)
    for packet, _ in rows:
        if packet is not None:
            docs, *values = _unzip(packet)
            for total, v in zip(sums, values, strict=True):
                total[docs] += v.astype(np.int64)
    own = [int(i) if k else None for i, k in zip(ids, known, strict=True)]
    n_train = answers.column("train_tokens")[0].as_py()
    return pa.table(
        [
            pa.array(own, pa.int64()), pa.array([held_out(i) for i in own], pa.bool_()), pa.array(lengths.astype(np.int64)), pa.array(sums[2]), pa.array(np.full(len(ids), n_train, np.int64)),
            pa.array(sums[1] / UNIT), pa.array(sums[0] / UNIT),
        ],
        names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    )


def _places(spark, n: int) -> list[int]:
    """n numbers that hash partitioning deals to n different partitions, so that each block has a task of its own."""
    found = spark.range(0, 40 * n + 200, 1, 1).select(F.col("id").cast("int").alias("id")).select("id", F.pmod(F.hash("id"), F.lit(n)).alias("p"))
    places = [r["id"] for r in found.groupBy("p").agg(F.min("id").alias("id")).orderBy("id").collect()]  # n numbers
    if len(places) < n:
        raise AssertionError(f"{len(places)} of {n} partitions were met")
    return places


def lm_scores(docs: DataFrame) -> DataFrame:
    """Score every whole text under the model of the documents whose crc32(doc_id as text) mod 10 is not 0.

    ``docs`` needs doc_id and text. Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score (log10 probability of the text) and perplexity (of a token). Null and empty texts are one end token;
    a null doc_id gives a null held_out and doesn't train; repeated rows train as often as they stand; an
    empty table gives an empty table. Words are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    places = _places(spark, common.shuffle_partitions(spark))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    asked = base.mapInArrow(_ask(places), "bucket int, chunk long, packet binary, info binary")
    told_columns, reply_columns = "place int, bucket int, packet binary", "bucket int, place int, packet binary"

    def first(key: tuple, asks: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_Block(asks).tell(places, key[0].as_py())])

    def again(turn: int):
        def run(key: tuple, asks: pa.Table, replies: pa.Table) -> pa.Table:
            block = _Block(asks)
            block.hear(places, replies)
            for k in range(BURN + 1):
                block.restaurants.sweep(block.root, turn + k)
            return pa.Table.from_batches([block.tell(places, key[0].as_py())])

        return run

    def last(turn: int):
        def run(key: tuple, asks: pa.Table, replies: pa.Table) -> pa.Table:
            block = _Block(asks)
            block.hear(places, replies)
            for k in range(BURN):
                block.restaurants.sweep(block.root, turn + k)
            return pa.Table.from_batches([block.answers(range(turn + BURN, turn + BURN + SAMPLES))])

        return run

    told = asked.groupBy("bucket").applyInArrow(first, told_columns)
    for k in range(ROUNDS):
        replies = told.groupBy("place").applyInArrow(_root, reply_columns)
        told = asked.groupBy("bucket").cogroup(replies.groupBy("bucket")).applyInArrow(again(100 * k), told_columns)
    replies = told.groupBy("place").applyInArrow(_root, reply_columns)
    answers = asked.groupBy("bucket").cogroup(replies.groupBy("bucket")).applyInArrow(last(100 * ROUNDS), "chunk long, packet binary, info binary, train_tokens long")
    scored = answers.groupBy("chunk").applyInArrow(_finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return scored.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def op6_lm_scoring(spark, sf_dir: str) -> DataFrame:
    return lm_scores(common.read(spark, sf_dir, "documents"))
