"""Toxicity by a convolutional text classifier trained in numpy.

A word is the sum of hashed embeddings of the whole word and its prefixes. Filters of
widths 1, 2 and 3 slide over a text's words, each filter keeps its maximum over the whole
text, and a logistic layer scores the maxima. The model is fitted to all labelled rows
and broadcast; its size is fixed. Rows are dealt to shards by their id; in every epoch
each shard continues from the common model, and what shards changed is averaged, a slot
over the shards that moved it, in the order of their numbers. The slots' first values
are counts over all shards. Decision thresholds are calibrated by language on all rows
that are held back from fitting. Scores themselves never see language, source, labels
or ids.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tallyroad.llm import common

#: Labelled rows, and bytes of their texts, that a shard holds on average; there are as many shards as that takes.
SHARD_ROWS, SHARD_BYTES = 6000, 32 << 20
SLOTS, DIM = 1 << 16, 8
#: (width, number of filters)
FILTERS = ((1, 8), (2, 4), (3, 4))
N_FILTERS = sum(n for _, n in FILTERS)
#: Columns of a word's projections: one for each filter and position in its window.
COLUMNS = sum(w * n for w, n in FILTERS)
PREFIXES = (3, 4, 5, 6, 7)
EPOCHS, BATCH, RATE = 8, 32, 0.05
PREDICT = 0.7
#: Part of the rows that is held back for thresholds, thresholds tried, and slots that travel together.
HELD, GRID, TOGETHER = 0.2, np.arange(0.3, 0.91, 0.05), 512
#: Words whose projections a worker keeps, and window starts evaluated at once.
KEPT_WORDS, BLOCK = 200_000, 100_000
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def slots(word: str) -> list[int]:
    """Embedding slots of a word: itself and its prefixes."""
    raw = [f"={word}"] + [f"<{word[:n]}" for n in PREFIXES if len(word) >= n]
    return [zlib.crc32(x.encode("utf-8", "surrogatepass")) % SLOTS for x in raw]


@dataclass
class Model:
    embedding: np.ndarray
    filters: list[np.ndarray]  # (filters, width, DIM) for each width
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    thresholds: dict[str, float]

    def project(self, vectors: np.ndarray) -> np.ndarray:
        return np.concatenate([vectors @ w[:, j].T for w in self.filters for j in range(w.shape[1])], axis=1)

    def score(self, pooled: np.ndarray) -> np.ndarray:
        z = np.maximum(pooled + self.bias, 0) @ self.out + self.out_bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _windows(projected: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Filter responses of the windows at ``starts``; a text is followed by padding, so windows stay inside."""
    parts, at = [], 0
    for width, n in FILTERS:
        total = projected[starts, at : at + n]
        for j in range(1, width):
            total = total + projected[starts + j, at + j * n : at + (j + 1) * n]
        parts.append(total)
        at += width * n
    return np.concatenate(parts, axis=1)


class _Encoder:
    """Distinct words of a worker with their projections; starts anew when full."""

    def __init__(self, model: Model):
        self.model = model
        self.reset()

    def reset(self) -> None:
        self.index: dict[str, int] = {}
        self.table = np.zeros((1, COLUMNS), np.float32)  # row 0 is padding
        self.new: list[list[int]] = []

    def ids(self, found: list[str]) -> np.ndarray:
        index = self.index
        for w in set(found).difference(index):
            index[w] = len(index) + 1
            self.new.append(slots(w))
        return np.fromiter(map(index.__getitem__, found), np.int64, len(found))

    def projections(self) -> np.ndarray:
        if self.new:
            counts = np.fromiter(map(len, self.new), np.int64, len(self.new))
            flat = np.fromiter((s for x in self.new for s in x), np.int64, int(counts.sum()))
            vectors = np.add.reduceat(self.model.embedding[flat], np.concatenate([[0], np.cumsum(counts)[:-1]]), axis=0)
            self.table = np.concatenate([self.table, self.model.project(vectors)])
            self.new = []
        return self.table


def score_texts(model: Model, texts: list[str | None], encoder: _Encoder | None = None) -> np.ndarray:
    """Scores of whole texts; a text without words is scored as one padding word."""
    encoder = encoder or _Encoder(model)
    pooled = np.full((len(texts), N_FILTERS), -np.inf, np.float32)
    pad = np.zeros(2, np.int64)
    i = 0
    while i < len(texts):
        if len(encoder.index) > KEPT_WORDS:
            encoder.reset()
        parts, first, n = [], i, 0
        while i < len(texts) and n < BLOCK and (i == first or len(encoder.index) <= KEPT_WORDS):
            ids = encoder.ids(words(texts[i]))
            parts.append(np.concatenate([ids if len(ids) else pad[:1], pad]))
            n += len(parts[-1])
            i += 1
        flat, table = np.concatenate(parts), encoder.projections()
        lengths = np.fromiter((len(p) - 2 for p in parts), np.int64, len(parts))
        ends = np.cumsum(lengths)
        starts = np.arange(ends[-1]) + 2 * np.repeat(np.arange(len(parts)), lengths)
        owner = np.repeat(np.arange(first, i), lengths)
        for low in range(0, len(starts), BLOCK):
            at, own = starts[low : low + BLOCK], owner[low : low + BLOCK]
            piece = table[flat[at[0] : at[-1] + 3]]
            cuts = np.flatnonzero(np.diff(own, prepend=-1))
            best = np.maximum.reduceat(_windows(piece, at - at[0]), cuts, axis=0)
            pooled[own[cuts]] = np.maximum(pooled[own[cuts]], best)
    return model.score(pooled).astype(np.float64)


@dataclass
class Shard:
    """Some labelled texts as numbers of their distinct words, and the slots of those."""

    flat: np.ndarray
    ends: np.ndarray
    padded: np.ndarray  # the last row is the padding word, slot SLOTS stays zero
    labels: np.ndarray
    held: np.ndarray
    langs: list[str | None]

    def doc(self, i: int) -> np.ndarray:
        return self.flat[self.ends[i - 1] if i else 0 : self.ends[i]]

    def seen(self, hold: bool) -> np.ndarray:
        """Documents to fit that have a slot, by class."""
        out = np.zeros((2, SLOTS + 1), np.int64)
        for i in self.train(hold):
            out[int(self.labels[i]), np.unique(self.padded[np.unique(self.doc(i))])] += 1
        return out

    def train(self, hold: bool) -> np.ndarray:
        return np.flatnonzero(~self.held) if hold else np.arange(len(self.labels))


def pack(texts: list[str | None], labels: list[int], held: list[bool], langs: list[str | None]) -> Shard:
    index: dict[str, int] = {}
    docs = [np.array([index.setdefault(w, len(index)) for w in words(t)], np.int32) for t in texts]
    padded = np.full((len(index) + 1, len(PREFIXES) + 1), SLOTS, np.int32)
    for k, w in enumerate(index):
        s = slots(w)
        padded[k, : len(s)] = s
    return Shard(np.concatenate([np.zeros(0, np.int32), *docs]), np.cumsum([len(d) for d in docs], dtype=np.int64), padded, np.array(labels, np.float64), np.array(held, bool), list(langs))


@dataclass
class State:
    """A model while it is fitted: its parameters and their sums of squared gradients."""

    emb: np.ndarray
    emb_sum: np.ndarray
    dense: list[np.ndarray]  # filters of each width, bias, out, c
    dense_sum: list[np.ndarray]

    def model(self) -> Model:
        *filters, bias, out, c = self.dense
        return Model(self.emb[:SLOTS].copy(), filters, bias, out, float(c[0]), {})


def begun(seen: np.ndarray, n1: int, n0: int, seed: int) -> State:
    """The first dimension starts from the slots' log odds over all documents, the rest at random."""
    rng = np.random.default_rng(seed)
    odds = np.log((seen[1] + 1) / (n1 + 2)) - np.log((seen[0] + 1) / (n0 + 2))
    emb = rng.normal(0, 0.02, (SLOTS + 1, DIM)).astype(np.float32)
    emb[:, 0] = np.clip(odds, -1.0, 4.0) * (np.minimum(seen[1] + 1, 20) / 20) * 0.3
    emb[SLOTS] = 0
    filt = [rng.normal(0, 0.1, (n, w, DIM)).astype(np.float32) for w, n in FILTERS]
    for f in filt:
        f[:, 0, 0] += 0.7
    dense = [*filt, np.full(N_FILTERS, -0.2, np.float32), np.full(N_FILTERS, 0.3, np.float32), np.full(1, -1.0, np.float32)]
    return State(emb, np.full_like(emb, 1e-3), dense, [np.full_like(d, 1e-2) for d in dense])


def _forward(state: State, shard: Shard, batch: np.ndarray):
    """Maxima of the batch's filters, where they are, and the words' vectors."""
    filt, pad_row = state.dense[: len(FILTERS)], len(shard.padded) - 1
    parts = [np.concatenate([d if len(d := shard.doc(i)) else [pad_row], [pad_row, pad_row]]) for i in batch]
    flat = np.concatenate(parts)
    distinct, at = np.unique(flat, return_inverse=True)
    vectors = state.emb[shard.padded[distinct]].sum(axis=1)
    proj = np.concatenate([vectors @ f[:, j].T for f in filt for j in range(f.shape[1])], axis=1)[at]
    pooled, where, base = [], [], 0
    for p in parts:
        out = _windows(proj, np.arange(base, base + len(p) - 2))
        k = out.argmax(axis=0)
        pooled.append(out[k, np.arange(N_FILTERS)])
        where.append(k + base)
        base += len(p)
    return np.array(pooled), np.array(where), flat, vectors, at


def train(state: State, shard: Shard, epochs: range, n1: int, n0: int, hold: bool, key: tuple[int, ...]) -> np.ndarray:
    """Fit ``state`` to the shard's rows for some epochs; the slots that moved. ``n1`` and ``n0``: rows of each class in all shards."""
    emb, (*filt, bias, out, c), (*filt_sum, bias_sum, out_sum, c_sum) = state.emb, state.dense, state.dense_sum
    rows, labels, most = shard.train(hold), shard.labels, shard.padded.shape[1]
    owner_of = np.repeat(np.arange(len(FILTERS)), [n for _, n in FILTERS])
    weight = np.where(labels == 1, (n1 + n0) / (2 * n1), (n1 + n0) / (2 * n0))
    seen = np.zeros(SLOTS + 1, bool)
    for epoch in epochs:
        order = np.random.default_rng((*key, epoch)).permutation(rows)
        rate = RATE * (1 - 0.8 * epoch / EPOCHS)
        for low in range(0, len(order), BATCH):
            batch = order[low : low + BATCH]
            pooled, where, flat, vectors, at = _forward(state, shard, batch)
            hidden = np.maximum(pooled + bias, 0)
            z = hidden @ out + c[0]
            d = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[batch]) * weight[batch] / len(batch)).astype(np.float32)
            g = [d @ hidden + 1e-4 * out, np.array([d.sum()], np.float32)]
            dh = d[:, None] * out * (hidden > 0)
            g.insert(0, dh.sum(axis=0))
            touched, changes = [], []
            for w, (width, _) in enumerate(FILTERS):
                cols = np.flatnonzero(owner_of == w)
                gf = np.zeros_like(filt[w])
                for j in range(width):
                    pos = where[:, cols] + j
                    gf[:, j] = np.einsum("df,dfk->fk", dh[:, cols], vectors[at[pos]])
                    touched.append(shard.padded[flat[pos]].reshape(-1, most))
                    changes.append((dh[:, cols, None] * filt[w][:, j][None]).reshape(-1, DIM))
                filt_sum[w] += gf**2
                filt[w] -= rate * gf / np.sqrt(filt_sum[w])
            ids = np.concatenate(touched)
            moved, back = np.unique(ids, return_inverse=True)
            total = np.zeros((len(moved), DIM), np.float32)
            np.add.at(total, back.reshape(ids.shape), np.concatenate(changes)[:, None, :])
            state.emb_sum[moved] += total**2
            emb[moved] -= rate * total / np.sqrt(state.emb_sum[moved])
            emb[SLOTS] = 0
            seen[moved] = True
            for v, squares, gradient in zip((bias, out, c), (bias_sum, out_sum, c_sum), g, strict=True):
                squares += gradient**2
                v -= rate * gradient / np.sqrt(squares)
    seen[SLOTS] = False
    return np.flatnonzero(seen)


def calibration(state: State, shard: Shard) -> list[tuple[str, int, int, int, int, int]]:
    """(language, number of a threshold, rows of each class, rows at or above it, those of label 1) of the rows held back."""
    model, rows = state.model(), np.flatnonzero(shard.held)
    parts = [model.score(_forward(state, shard, rows[low : low + BATCH])[0]) for low in range(0, len(rows), BATCH)]
    scores, labels = np.concatenate([np.zeros(0), *parts]), shard.labels[rows]
    names = [shard.langs[i] for i in rows]
    out = []
    for lang in sorted({n for n in names if n is not None}):
        mine = np.array([n == lang for n in names])
        s, y = scores[mine], labels[mine] == 1
        out += [(lang, k, int(y.sum()), int((~y).sum()), int((s >= t).sum()), int(((s >= t) & y).sum())) for k, t in enumerate(GRID)]
    return out


def thresholds(found: list[tuple[str, int, int, int, int, int]]) -> dict[str, float]:
    """By language: the threshold of the best F1 on the held-back rows, the middle of the best range; 20 rows of each class at least."""
    f1: dict[str, np.ndarray] = {}
    for lang, k, n1, n0, above, right in found:
        if min(n1, n0) >= 20:
            f1.setdefault(lang, np.zeros(len(GRID)))[k] = 2 * right / max(1, above + n1)
    return {lang: float(np.round(np.median(GRID[v >= v.max() - 1e-12]), 2)) for lang, v in sorted(f1.items())}


def constant(label: int) -> Model:
    """The model where only one class is known."""
    return Model(np.zeros((SLOTS, DIM), np.float32), [np.zeros((n, w, DIM), np.float32) for w, n in FILTERS], np.zeros(N_FILTERS, np.float32), np.zeros(N_FILTERS, np.float32), 30.0 if label else -30.0, {})


def fit(rows: list[tuple[str | None, int, str | None]], seed: int = 7) -> Model:
    """Fit to (text, label, language) rows as one shard. Without rows of both classes the score is the share of label 1."""
    texts, labels, langs = (list(x) for x in zip(*rows, strict=True)) if rows else ([], [], [])
    if len(set(labels)) < 2:
        return constant(max(labels, default=0))
    shard = pack(texts, labels, (np.random.default_rng(seed).random(len(rows)) < HELD).tolist(), langs)
    hold = len(set(shard.labels[~shard.held])) == 2
    n1 = int(shard.labels[shard.train(hold)].sum())
    n0 = len(shard.train(hold)) - n1
    state = begun(shard.seen(hold), n1, n0, seed)
    train(state, shard, range(EPOCHS), n1, n0, hold, (seed, 0))
    model = state.model()
    model.thresholds = thresholds(calibration(state, shard) if hold else [])
    return model


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, toxic, lang, held) of all labelled documents whose crc32(doc_id as text) mod 3 is not 1."""
    mine = F.crc32(F.col("doc_id").cast("string")) % 3 != 1
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).where(mine)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", lang.alias("lang")).where(mine).join(known, "doc_id")
    # one text for a doc_id that repeats: the greatest
    one = found.groupBy("doc_id").agg(F.max(F.struct("text", "toxic", "lang")).alias("r")).select("doc_id", "r.text", "r.toxic", "r.lang")
    return one.withColumn("held", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1000)) < int(1000 * HELD))


_TOLD = "part int, shard int, data binary"


def _packed(key: tuple, rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("doc_id")
    shard = pack(*(rows.column(c).to_pylist() for c in ("text", "toxic", "held", "lang")))
    return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([zstandard.ZstdCompressor(level=1).compress(pickle.dumps(shard))], pa.binary())], names=["shard", "data"])


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Shard]]:
    for batch in batches:
        for number, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            yield number, pickle.loads(zstandard.ZstdDecompressor().decompress(data.as_py()))  # noqa: S301  made by _packed


def _gathered(packed: DataFrame, work: Callable[[int, Shard], list[tuple[int, object]]], merge: Callable[[int, list], object]) -> dict[int, object]:
    """What shards tell about each part of the model, merged in the order of shards; the driver gets one of each part."""

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, shard in _shards(batches):
            told = work(number, shard)
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in told], pa.int32()), pa.array([number] * len(told), pa.int32()), pa.array([pickle.dumps(x) for _, x in told], pa.binary())], names=["part", "shard", "data"])

    def join(key: tuple, told: pa.Table) -> pa.Table:
        told = told.sort_by("shard")
        whole = merge(key[0].as_py(), [pickle.loads(x.as_py()) for x in told.column("data")])  # noqa: S301  made above
        return pa.table([told.column("part")[:1].combine_chunks(), pa.array([pickle.dumps(whole)], pa.binary())], names=["part", "data"])

    got = packed.mapInArrow(tell, _TOLD).groupBy("part").applyInArrow(join, "part int, data binary").collect()
    return {r["part"]: pickle.loads(r["data"]) for r in got}  # noqa: S301  made above


def _by_parts(ids: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    cuts = np.flatnonzero(np.diff(ids // TOGETHER, prepend=-1))
    for piece in np.split(ids, cuts[1:]):
        if len(piece):
            yield int(piece[0] // TOGETHER), piece


def _mean(part: int, told: list) -> object:
    """Part -1 are the dense parameters; of a slot, the mean of the shards that moved it."""
    if part < 0:
        return [[np.mean(x, axis=0, dtype=np.float64).astype(np.float32) for x in zip(*side, strict=True)] for side in zip(*told, strict=True)]
    total, n = np.zeros((TOGETHER, 2 * DIM)), np.zeros(TOGETHER)
    for ids, values in told:
        total[ids - part * TOGETHER] += values
        n[ids - part * TOGETHER] += 1
    moved = np.flatnonzero(n)
    return moved + part * TOGETHER, (total[moved] / n[moved, None]).astype(np.float32)


def fitted(docs: DataFrame, labels: DataFrame, seed: int = 7) -> Model:
    """Fit to all labelled rows: they are packed once, every epoch is a pass over the shards, and the driver holds one model."""
    spark = docs.sparkSession
    rows = common.materialize(training_rows(docs, labels), "labelled")
    n_of = lambda which: F.coalesce(F.sum(F.when(F.expr(which), 1).otherwise(0)), F.lit(0))
    n, size, all1, fit1, fit0 = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), n_of("toxic = 1"), n_of("toxic = 1 and not held"), n_of("toxic = 0 and not held")).first()
    if not 0 < all1 < n:
        common.discard(rows)
        return constant(int(all1 > 0))
    hold = min(fit1, fit0) > 0
    n1, n0 = (fit1, fit0) if hold else (all1, n - all1)
    shards = max(1, -(-n // SHARD_ROWS), -(-size // SHARD_BYTES))
    packed = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(shards)).cast("int")).repartitionByRange(int(shards), "shard")
    packed = common.materialize(packed.groupBy("shard").applyInArrow(_packed, "shard int, data binary"), "shards")
    common.discard(rows)

    def count(number: int, shard: Shard) -> list:
        seen = shard.seen(hold)
        return [(p, (ids, seen[:, ids])) for p, ids in _by_parts(np.flatnonzero(seen.any(axis=0)))]

    def add(part: int, told: list) -> object:
        total = np.zeros((2, TOGETHER), np.int64)
        for ids, values in told:
            total[:, ids - part * TOGETHER] += values
        return total

    seen = np.zeros((2, SLOTS // TOGETHER + 1, TOGETHER), np.int64)
    for part, total in _gathered(packed, count, add).items():
        seen[:, part] = total
    state = begun(seen.reshape(2, -1)[:, : SLOTS + 1], n1, n0, seed)
    for epochs in [range(EPOCHS)] if shards == 1 else [range(e, e + 1) for e in range(EPOCHS)]:
        shared = spark.sparkContext.broadcast(state)

        def work(number: int, shard: Shard, shared=shared, epochs=epochs) -> list:
            mine = pickle.loads(pickle.dumps(shared.value))  # noqa: S301  a copy
            moved = train(mine, shard, epochs, n1, n0, hold, (seed, number))
            values = np.concatenate([mine.emb, mine.emb_sum], axis=1)
            return [(-1, (mine.dense, mine.dense_sum)), *((p, (ids, values[ids])) for p, ids in _by_parts(moved))]

        for part, whole in _gathered(packed, work, _mean).items():
            if part < 0:
                state.dense, state.dense_sum = whole
            else:
                ids, values = whole
                state.emb[ids], state.emb_sum[ids] = values[:, :DIM], values[:, DIM:]
        shared.destroy()
    model = state.model()
    if hold:
        model.thresholds = _calibrated(packed, state)
    common.discard(packed)
    return model


def _calibrated(packed: DataFrame, state: State) -> dict[str, float]:
    shared = packed.sparkSession.sparkContext.broadcast(state)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["lang", "k", "n1", "n0", "above", "right"]
        for _, shard in _shards(batches):
            found = calibration(shared.value, shard)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], pa.int64() if i else pa.string()) for i in range(len(names))], names=names)

    told = packed.mapInArrow(run, "lang string, k long, n1 long, n0 long, above long, right long")
    sums = told.groupBy("lang", "k").agg(*[F.sum(c).alias(c) for c in ("n1", "n0", "above", "right")]).where("n1 >= 20 and n0 >= 20")
    found = [tuple(r) for r in sums.collect()]  # one a language and threshold
    shared.destroy()
    return thresholds(found)


def _score(shared, keep_text: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        encoder = _Encoder(model)
        for batch in batches:
            at = batch.schema.names.index("text")
            scores = score_texts(model, batch.column(at).to_pylist(), encoder)
            rest = [(n, c) for n, c in zip(batch.schema.names, batch.columns, strict=True) if keep_text or n != "text"]
            yield pa.RecordBatch.from_arrays([c for _, c in rest] + [pa.array(scores)], names=[n for n, _ in rest] + ["score"])

    return run


def toxicity_scores(docs: DataFrame, labels: DataFrame, other: tuple[str, ...] | None = None) -> DataFrame:
    """Score every whole text: doc_id, held_out, score, predicted, threshold and rejected; with ``other``, text and carried (a struct of the columns it names) too.

    ``docs`` needs doc_id and text, ``labels`` doc_id and toxic; a ``lang`` column in docs only chooses the
    calibrated ``threshold`` behind ``rejected``. Null and empty texts get the score of a text without
    words; a null doc_id gives a null held_out; labels other than 0 and 1 are ignored, of repeated labels
    the larger counts; without labels of both classes the score is constant; empty tables give empty tables.
    """
    spark = docs.sparkSession
    model = fitted(docs, labels)
    shared = spark.sparkContext.broadcast(model)
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), lang.alias("lang"), "text")
    made = StructType([StructField("doc_id", LongType()), StructField("lang", StringType())])
    if other is not None:
        base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), lang.alias("lang"), "text", common.carry(other))
        made = StructType([*made, base.schema["text"], base.schema["carried"]])
    scored = base.mapInArrow(_score(shared, other is not None), StructType([*made, StructField("score", DoubleType())]))
    limit = F.lit(PREDICT)
    for name, value in model.thresholds.items():  # one a language with enough labelled rows
        limit = F.when(F.col("lang") == name, value).otherwise(limit)
    return scored.select("doc_id", (F.crc32(F.col("doc_id").cast("string")) % 3 == 1).alias("held_out"), "score", (F.col("score") >= PREDICT).cast("int").alias("predicted"), limit.alias("threshold"), (F.col("score") >= limit).alias("rejected"), *(["text", "carried"] if other is not None else []))


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    return toxicity_scores(common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "labels"))
