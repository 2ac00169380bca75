"""Removal of passages that repeat across documents, by multi-document suffix structures.

A whole-collection transform would need a round for every byte of the longest text, so the
work is cut into collections of short strings that can be built apart. Every 50-byte string
has a key: the least hash of its 20-byte pieces. Neighbouring strings with one key form a
segment of at most SPAN strings. Keys that one document alone has can't repeat, and drop
out. The segments of the other keys go to their key's block, where the transform and the
common prefixes of all distinct segments are built column by column (see ``bcr``): strings
that share 50 bytes or more lie next to each other, so a run of common prefixes of 50 or
more is one repeated string, and the smallest doc_id of its segments decides. A key with
more segments than a collection holds is split by the first symbols of its strings, so
every collection is built the same way and has a bounded size. Documents that are equal as
a whole are collapsed before, segments that are equal within a batch of documents before
they are sent. What a block finds goes back in packets to the partition of the document,
where it is merged, so that what is sent follows the removed bytes and not the blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroad.llm import bcr, common

LENGTH, PIECE = 50, 20
SPAN = LENGTH - PIECE + 1
#: Bytes of texts whose keys are found together, and segments of a collection.
CHUNK, COLLECTION = 2 << 20, 4096
#: Bytes of segments that a task gathers before it sends them.
BATCH = 8 << 20
_RNG = np.random.default_rng(5)
_BYTE = _RNG.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_FACTORS = _RNG.integers(0, 1 << 63, 5, np.uint64) * np.uint64(2) + np.uint64(1)
_LOW = np.uint64(0xFFFFFFFF)


def _keys(text: np.ndarray) -> np.ndarray:
    """Key of the string that starts at each byte, for all full strings of ``text``."""
    with np.errstate(over="ignore"):
        h1 = _BYTE[text]
        h2 = h1[:-1] * _FACTORS[0] + h1[1:]
        h4 = h2[:-2] * _FACTORS[1] + h2[2:]
        h8 = h4[:-4] * _FACTORS[2] + h4[4:]
        h16 = h8[:-8] * _FACTORS[3] + h8[8:]
        h = h16[:-4] * _FACTORS[4] + h4[16:]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    for step in (1, 2, 4, 8):
        h = np.minimum(h[:-step], h[step:])
    return np.minimum(h[:-15], h[15:])


def _segments(pieces: list[tuple[int, bytes, int]], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(number, start, strings, key) of all segments of (number, bytes, offset in its text) pieces; the key has the bucket above 32 bits."""
    flat = np.frombuffer(b"".join(p for _, p, _ in pieces), np.uint8)
    lengths = np.fromiter((len(p) for _, p, _ in pieces), np.int64, len(pieces))
    begins = np.cumsum(lengths) - lengths
    keys = _keys(flat) if len(flat) >= LENGTH else np.zeros(0, np.uint64)
    edge = np.zeros(len(flat) + 1, np.int64)
    full = lengths >= LENGTH
    np.add.at(edge, begins[full], 1)
    np.add.at(edge, (begins + lengths - LENGTH + 1)[full], -1)
    inside = np.flatnonzero(np.cumsum(edge)[: len(keys)])  # starts of full strings
    if not len(inside):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    k = keys[inside]
    new = np.ones(len(inside), bool)
    new[1:] = (k[1:] != k[:-1]) | (np.diff(inside) != 1)
    new[np.searchsorted(inside, begins[full])] = True
    at = np.flatnonzero(new)
    counts = np.diff(np.append(at, len(inside)))
    parts = -(-counts // SPAN)  # text of one short period keeps its key for long: cut it
    owner = np.repeat(np.arange(len(at)), parts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
    start = inside[at[owner]] + nth * SPAN
    strings = np.minimum(SPAN, counts[owner] - nth * SPAN)
    piece = np.searchsorted(begins, start, side="right") - 1
    while len(piece) and (short := lengths[piece] == 0).any():  # empty pieces begin where the next one does
        piece[short] -= 1
    key = k[at[owner]]
    number = np.fromiter((n for n, _, _ in pieces), np.int64, len(pieces))[piece]
    offset = np.fromiter((o for _, _, o in pieces), np.int64, len(pieces))[piece]
    return number, start - begins[piece] + offset, strings, (((key >> np.uint64(32)) % np.uint64(buckets)) << np.uint64(32)) | (key & _LOW)


def _pieces(number: int, text: bytes) -> list[tuple[int, bytes, int]]:
    """A text in pieces of at most CHUNK starts, overlapping so that every string lies whole in one."""
    return [(number, text[o : o + CHUNK + LENGTH - 1], o) for o in range(0, max(1, len(text) - LENGTH + 1), CHUNK)] if len(text) >= LENGTH else []


def _pack(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *[x for a in arrays for x in (len(a), a.dtype.num)]], np.int64)
    return zstandard.ZstdCompressor(level=1).compress(head.tobytes() + b"".join(a.tobytes() for a in arrays))


def _unpack(raw: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(raw)
    n = int(np.frombuffer(data, np.int64, 1)[0])
    head = np.frombuffer(data, np.int64, 2 * n, 8)
    out, at = [], 8 + 16 * n
    for k in range(n):
        kind = _KINDS[int(head[2 * k + 1])]
        out.append(np.frombuffer(data, kind, int(head[2 * k]), at))
        at += out[-1].nbytes
    return out


_KINDS = {np.dtype(k).num: np.dtype(k) for k in (np.uint8, np.uint16, np.uint32, np.int64, np.uint64)}


def _by_bucket(key: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    bucket = (key >> np.uint64(32)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    for a, b in zip(cuts, np.append(cuts, len(order))[1:], strict=True):
        yield int(bucket[order[a]]), order[a:b]


def _send_keys(buckets: int):
    """Texts -> packets of distinct keys by bucket: keys that one document of the batch has, keys of several, and who has the latter."""

    def flush(docs: list[tuple[int, int]], parts: list) -> pa.RecordBatch | None:
        number, key = np.concatenate([p[0] for p in parts]), np.concatenate([p[3] for p in parts])
        order = np.lexsort((number, key))
        number, key = number[order], key[order]
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (number[1:] != number[:-1])
        number, key = number[fresh], key[fresh]  # (key, document) once
        first = np.ones(len(key), bool)
        first[1:] = key[1:] != key[:-1]
        several = ~first | np.append(~first[1:], False)
        ids, marks = np.array([d for d, _ in docs], np.int64), np.array([t for _, t in docs], np.int64)
        out_b, out_p = [], []
        for b, rows in _by_bucket(key):
            n, k, f, s = number[rows], (key[rows] & _LOW).astype(np.uint32), first[rows], several[rows]
            alone, known = f & ~s, s
            used, local = np.unique(n, return_inverse=True)
            local = local.astype(np.uint32)
            out_b.append(b)
            # by document, so that document numbers compress
            a = np.flatnonzero(alone)
            a = a[np.argsort(local[a], kind="stable")]
            out_p.append(_pack(ids[used], marks[used], k[a], local[a], k[f & s], k[known], local[known]))
        return pa.RecordBatch.from_arrays([pa.array(out_b, pa.int32()), pa.array(out_p, pa.binary())], names=["bucket", "packet"]) if out_b else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs: list[tuple[int, int]] = []
        parts: list = []
        waiting: list = []
        size = held = 0
        for batch in batches:
            for doc_id, mark, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                docs.append((doc_id, mark))
                for piece in _pieces(len(docs) - 1, text):
                    waiting.append(piece)
                    size += len(piece[1])
                    if size >= CHUNK:
                        parts.append(_segments(waiting, buckets))
                        held += len(parts[-1][0])
                        waiting, size = [], 0
                if held >= BATCH // 16:
                    if waiting:
                        parts.append(_segments(waiting, buckets))
                    if (out := flush(docs, parts)) is not None:
                        yield out
                    docs, parts, waiting, size, held = [], [], [], 0, 0
        if waiting:
            parts.append(_segments(waiting, buckets))
        if parts and (out := flush(docs, parts)) is not None:
            yield out

    return run


def _deal(ids: np.ndarray, marks: np.ndarray, values: list[np.ndarray], targets: int) -> pa.RecordBatch:
    """One packet for each target partition of documents: documents, how many values each has, and the values by document."""
    target = marks.view(np.uint64) % np.uint64(targets)
    order = np.lexsort((values[0], ids, marks, target))
    target, ids, marks, values = target[order].astype(np.int64), ids[order], marks[order], [v[order] for v in values]
    cuts = np.flatnonzero(np.diff(target, prepend=-1))
    out = []
    for a, b in zip(cuts, np.append(cuts, len(target))[1:], strict=True):
        i, m = ids[a:b], marks[a:b]
        docs = np.flatnonzero(np.append(True, (i[1:] != i[:-1]) | (m[1:] != m[:-1])))
        counts = np.diff(np.append(docs, b - a)).astype(np.uint32)
        # differences compress, and a value never changes by them: sums wrap as they did
        out.append(_pack(i[docs], m[docs], counts, *[np.diff(v[a:b], prepend=v.dtype.type(0)) for v in values]))
    return pa.RecordBatch.from_arrays([pa.array(target[cuts], pa.int32()), pa.array(out, pa.binary())], names=["target", "packet"])


def _by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packets of a target partition -> a row for each document with all its values."""
    for _, packets in _gathered(batches):
        ids, marks, rows = [], [], []
        for doc_ids, doc_marks, counts, *values in map(_unpack, packets):
            ids.append(np.repeat(doc_ids, counts))
            marks.append(np.repeat(doc_marks, counts))
            rows.append(np.stack([np.cumsum(v, dtype=v.dtype) for v in values], axis=1))
        i, m, stacked = np.concatenate(ids), np.concatenate(marks), np.concatenate(rows)
        order = np.lexsort((m, i))
        i, m, stacked = i[order], m[order], stacked[order]
        cuts = np.flatnonzero(np.append(True, (i[1:] != i[:-1]) | (m[1:] != m[:-1])))
        held = [stacked[a:b].tobytes() for a, b in zip(cuts, np.append(cuts, len(i))[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(i[cuts], pa.int64()), pa.array(m[cuts], pa.int64()), pa.array(held, pa.binary())], names=["doc_id", "mark", "found"])


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    """Packets of one bucket after the other, from rows sorted by bucket."""
    at, held = None, []
    for batch in batches:
        for b, packet in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if b != at and held:
                yield at, held
                held = []
            at = b
            held.append(packet)
    if held:
        yield at, held


def _repeated_keys(targets: int):
    """Packets of keys -> packets of the keys that documents share, for the partitions of the documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, packets in _gathered(batches):
            parts = [_unpack(p) for p in packets]
            lone = np.concatenate([p[2] for p in parts])
            several = np.concatenate([p[4] for p in parts])
            everything = np.sort(np.concatenate([lone, several]))
            twice = np.unique(everything[1:][everything[1:] == everything[:-1]])
            ids, marks, keys = [], [], []
            for doc_ids, doc_marks, alone, who, _, known, whose in parts:
                at = np.searchsorted(twice, alone)
                at[at == len(twice)] = 0
                hit = twice[at] == alone if len(twice) else np.zeros(len(alone), bool)
                k, n = np.concatenate([alone[hit], known]), np.concatenate([who[hit], whose])
                ids.append(doc_ids[n])
                marks.append(doc_marks[n])
                keys.append(k.astype(np.uint64) | (np.uint64(bucket) << np.uint64(32)))
            yield _deal(np.concatenate(ids), np.concatenate(marks), [np.concatenate(keys)], targets)

    return run


def _send_segments(buckets: int):
    """Texts with their shared keys -> packets of segments by bucket."""

    def flush(occurrences: list, seen: dict, local: list) -> pa.RecordBatch | None:
        # (key, content) -> number; the first occurrence of a content in a larger document is removed at once
        contents = [c for _, c in seen]
        key = np.fromiter((k for k, _ in seen), np.uint64, len(seen))
        occ = np.array(occurrences, np.int64).reshape(-1, 4)  # content, doc_id, mark, start
        of_content = np.argsort(occ[:, 0], kind="stable")
        sorted_content = occ[of_content, 0]
        gone = np.array(local, np.int64).reshape(-1, 4)  # doc_id, mark, start, end
        out_b, out_p = [], []
        blocks = list(_by_bucket(key))
        for turn, (b, rows) in enumerate(blocks):
            renumber = np.full(len(contents), -1, np.int64)
            renumber[rows] = np.arange(len(rows))
            lo, hi = np.searchsorted(sorted_content, rows), np.searchsorted(sorted_content, rows, side="right")
            mine = of_content[np.repeat(lo - np.cumsum(hi - lo) + (hi - lo), hi - lo) + np.arange((hi - lo).sum())]
            text = b"".join(contents[r] for r in rows)
            g = gone[turn :: len(blocks)]  # what is removed already travels in equal shares
            out_b.append(b)
            out_p.append(
                _pack(
                    (key[rows] & _LOW).astype(np.uint32), np.fromiter((len(contents[r]) for r in rows), np.uint16, len(rows)), np.frombuffer(text, np.uint8),
                    renumber[occ[mine, 0]].astype(np.uint32), occ[mine, 1], occ[mine, 2], occ[mine, 3], *[np.ascontiguousarray(g[:, k]) for k in range(4)],
                )
            )
        return pa.RecordBatch.from_arrays([pa.array(out_b, pa.int32()), pa.array(out_p, pa.binary())], names=["bucket", "packet"]) if out_b else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, bytes], int] = {}
        least: list[int] = []
        occurrences: list = []
        local: list = []
        docs: list[tuple[int, int, bytes]] = []
        wanted: list[np.ndarray] = []
        waiting: list = []
        size = held = 0

        def take() -> int:
            """Enter the shared segments of the waiting pieces; bytes of new contents."""
            number, start, strings, key = _segments(waiting, buckets)
            own = np.unique(np.concatenate([_of_document(keys, np.full(len(keys), n)) for n, keys in enumerate(wanted)]))
            mine = _of_document(key, number)
            at = np.searchsorted(own, mine)
            at[at == len(own)] = 0
            hit = np.flatnonzero(own[at] == mine)
            fresh = 0
            for d, s, n, k in zip(number[hit].tolist(), start[hit].tolist(), strings[hit].tolist(), key[hit].tolist(), strict=True):
                doc_id, mark, text = docs[d]
                content = text[s : s + n + LENGTH - 1]
                number_of = seen.setdefault((k, content), len(least))
                if number_of == len(least):
                    least.append(doc_id)
                    fresh += len(content)
                elif least[number_of] < doc_id:
                    local.append((doc_id, mark, s, s + len(content)))
                    continue
                else:
                    least[number_of] = doc_id
                occurrences.append((number_of, doc_id, mark, s))
            waiting.clear()
            return fresh

        for batch in batches:
            for doc_id, mark, text, keys in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                docs.append((doc_id, mark, text))
                wanted.append(np.frombuffer(keys, np.uint64))
                for piece in _pieces(len(docs) - 1, text):
                    waiting.append(piece)
                    held += len(piece[1])
                    if held >= CHUNK:
                        size += take()
                        held = 0
                if not waiting:
                    docs, wanted = [], []
                if size >= BATCH or len(local) + len(occurrences) >= 1_000_000:
                    if waiting:
                        size += take()
                        held = 0
                    docs, wanted = [], []
                    if (out := flush(occurrences, seen, local)) is not None:
                        yield out
                    seen, least, occurrences, local, size = {}, [], [], [], 0
        if waiting:
            take()
        if seen and (out := flush(occurrences, seen, local)) is not None:
            yield out

    return run


def _of_document(keys: np.ndarray, number: np.ndarray) -> np.ndarray:
    """One number for a key in a document; two that agree by chance only send a segment that nobody shares."""
    with np.errstate(over="ignore"):
        x = (keys ^ (number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _least_of_strings(contents: list[bytes], least: np.ndarray) -> list[np.ndarray]:
    """For each string of each segment: the smallest doc_id of a segment that holds it, from one suffix structure."""
    owner, offset, shared, _ = bcr.build(contents)
    lengths = np.fromiter(map(len, contents), np.int64, len(contents))
    run = np.cumsum(shared < LENGTH)
    full = np.flatnonzero(offset + LENGTH <= lengths[owner])
    classes = np.cumsum(np.diff(run[full], prepend=-1) != 0) - 1  # runs come in order
    value = np.full(len(full), np.iinfo(np.int64).max)
    np.minimum.at(value, classes, least[owner[full]])
    bases = np.cumsum(lengths - LENGTH + 1) - (lengths - LENGTH + 1)
    out = np.empty(int((lengths - LENGTH + 1).sum()), np.int64)
    out[bases[owner[full]] + offset[full]] = value[classes]
    return np.split(out, bases[1:])


def _by_first_symbols(flat: np.ndarray, starts: np.ndarray) -> Iterator[np.ndarray]:
    """Strings of LENGTH at ``starts`` in groups of at most COLLECTION that no equal string is outside of; larger ones hold one string only."""
    waiting = [(np.arange(len(starts)), 0)]
    while waiting:
        rows, depth = waiting.pop()
        if len(rows) <= COLLECTION or depth == LENGTH:
            yield rows
            continue
        symbol = flat[starts[rows] + depth].astype(np.int64)
        order = np.argsort(symbol, kind="stable")
        waiting += [(part, depth + 1) for part in np.split(rows[order], np.flatnonzero(np.diff(symbol[order])) + 1)]


def _split_key(contents: list[bytes], least: np.ndarray) -> list[np.ndarray]:
    """As _least_of_strings, for a key with more contents than a collection holds."""
    counts = np.fromiter((len(c) - LENGTH + 1 for c in contents), np.int64, len(contents))
    flat = np.frombuffer(b"".join(contents), np.uint8)
    owner = np.repeat(np.arange(len(contents)), counts)
    begins = np.cumsum(counts + LENGTH - 1) - (counts + LENGTH - 1)
    firsts = np.cumsum(counts) - counts
    starts = begins[owner] + np.arange(len(owner)) - firsts[owner]
    out = np.empty(len(owner), np.int64)
    block: list[tuple[np.ndarray, np.ndarray]] = []  # rows and which of their distinct strings each has
    strings: list[bytes] = []

    def build() -> None:
        rows, which = (np.concatenate(x) for x in zip(*block, strict=True))
        lows = np.full(len(strings), np.iinfo(np.int64).max)
        np.minimum.at(lows, which, least[owner[rows]])
        out[rows] = np.concatenate(_least_of_strings(strings, lows))[which]
        block.clear()
        strings.clear()

    for rows in _by_first_symbols(flat, starts):
        if len(rows) > COLLECTION:  # one string
            rows_of = {flat[starts[rows[0]] : starts[rows[0]] + LENGTH].tobytes(): len(strings)}
            which = np.full(len(rows), len(strings))
        else:
            rows_of = {}
            which = np.array([rows_of.setdefault(flat[s : s + LENGTH].tobytes(), len(strings) + len(rows_of)) for s in starts[rows].tolist()])
        strings += rows_of
        block.append((rows, which))
        if len(strings) >= COLLECTION:
            build()
    if block:
        build()
    return np.split(out, firsts[1:])


def _joined(found: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(doc_id, mark, [start, length]) of (doc_id, mark, start, end) ranges, with those of a document that meet made one."""
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    other = np.append(True, (found[1:, 0] != found[:-1, 0]) | (found[1:, 1] != found[:-1, 1]))[: len(found)]
    shift = np.cumsum(other) << 40  # no text has as many bytes, so a document's ranges end before the next one's
    reach = np.maximum.accumulate(found[:, 3] + shift)
    new = np.flatnonzero(np.append(True, found[1:, 2] + shift[1:] > reach[:-1])[: len(found)])
    ends = (reach - shift)[np.append(new, len(found))[1:] - 1]
    return found[new, 0], found[new, 1], [found[new, 2], ends - found[new, 2]]


def _removals(targets: int):
    """Packets of segments -> packets of removed ranges, for the partitions of the documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, packets in _gathered(batches):
            number: dict[tuple[int, bytes], int] = {}
            occ: list[np.ndarray] = []
            gone: list[np.ndarray] = []
            for p in packets:
                key, length, text, content, doc, mark, start, *local = _unpack(p)
                raw, ends = text.tobytes(), np.cumsum(length.astype(np.int64))
                mapped = np.fromiter((number.setdefault((k, raw[e - n : e]), len(number)) for k, e, n in zip(key.tolist(), ends.tolist(), length.tolist(), strict=True)), np.int64, len(key))
                occ.append(np.stack([mapped[content], doc, mark, start], axis=1))
                gone.append(np.stack(local, axis=1))
            contents = [c for _, c in number]
            keys = np.fromiter((k for k, _ in number), np.int64, len(number))
            every = np.concatenate(occ)
            least = np.full(len(contents), np.iinfo(np.int64).max)
            np.minimum.at(least, every[:, 0], every[:, 1])
            order = np.argsort(keys, kind="stable")
            cuts = np.flatnonzero(np.diff(keys[order], prepend=-1))
            sizes = np.diff(np.append(cuts, len(order)))
            strings: list[np.ndarray] = [np.zeros(0, np.int64)] * len(contents)
            block: list[int] = []

            def build(rows: list[int], how) -> None:
                for i, found in zip(rows, how([contents[i] for i in rows], least[rows]), strict=True):
                    strings[i] = found

            for a, n in zip(cuts.tolist(), sizes.tolist(), strict=True):
                rows = order[a : a + n].tolist()
                if n > COLLECTION:
                    build(rows, _split_key)
                    continue
                if len(block) + n > COLLECTION:
                    build(block, _least_of_strings)
                    block = []
                block += rows
            if block:
                build(block, _least_of_strings)
            # the strings of every occurrence that a smaller document has, as ranges
            counts = np.fromiter(map(len, strings), np.int64, len(strings))
            bases, flat = np.cumsum(counts) - counts, np.concatenate(strings)
            n = counts[every[:, 0]]
            owner = np.repeat(np.arange(len(every)), n)
            nth = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
            cut = flat[bases[every[owner, 0]] + nth] < every[owner, 1]
            first = cut & np.append(True, ~cut[:-1] | (owner[1:] != owner[:-1]))[: len(cut)]
            last = cut & np.append(~cut[1:] | (owner[1:] != owner[:-1]), True)[: len(cut)]
            who = every[owner[first]]
            begin, end = who[:, 3] + nth[first], who[:, 3] + nth[last] + LENGTH
            gone.append(np.stack([who[:, 1], who[:, 2], begin, end], axis=1))
            yield _deal(*_joined(np.concatenate(gone)), targets)

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: dict[str, list] = {"doc_id": [], "mark": [], "n_removed": [], "n_spans": [], "kept": []}
        for doc_id, mark, text, ranges in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            pairs = np.frombuffer(ranges, np.int64).reshape(-1, 2)
            edge = np.zeros(len(text) + 1, np.int64)
            np.add.at(edge, pairs[:, 0], 1)
            np.add.at(edge, pairs.sum(axis=1), -1)
            removed = np.cumsum(edge)[:-1] > 0
            out["doc_id"].append(doc_id)
            out["mark"].append(mark)
            out["n_removed"].append(int(removed.sum()))
            out["n_spans"].append(int((np.diff(removed.view(np.int8), prepend=0) == 1).sum()))
            out["kept"].append(np.frombuffer(text, np.uint8)[~removed].tobytes())
        yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())]))


def _structures(docs: DataFrame):
    spark = docs.sparkSession
    buckets = common.shuffle_partitions(spark)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_of().cast("binary").alias("text")).withColumn("mark", F.xxhash64("text"))
    told = common.materialize(base.select("doc_id", "mark", F.octet_length("text").cast("long").alias("n_bytes"), F.unhex(F.sha2("text", 256)).alias("sha")), "texts")
    firsts = told.groupBy("sha").agg(F.min("doc_id").alias("first_id"))
    info = common.materialize(told.join(common.materialize(firsts, "firsts"), "sha"), "texts")
    alone = info.where(F.col("doc_id").isNotNull() & (F.col("doc_id") == F.col("first_id")) & (F.col("n_bytes") >= LENGTH)).select("doc_id", "mark").distinct()
    join = lambda other: base.join(other, ["doc_id", "mark"])
    gathered = lambda df, key: df.repartitionById(buckets, key).sortWithinPartitions(key)
    keys = gathered(join(alone).select("doc_id", "mark", "text").mapInArrow(_send_keys(buckets), "bucket int, packet binary"), "bucket")
    shared = gathered(keys.mapInArrow(_repeated_keys(buckets), "target int, packet binary"), "target").mapInArrow(_by_document, "doc_id long, mark long, found binary")
    segments = gathered(join(shared).select("doc_id", "mark", "text", "found").mapInArrow(_send_segments(buckets), "bucket int, packet binary"), "bucket")
    removed = gathered(segments.mapInArrow(_removals(buckets), "target int, packet binary"), "target").mapInArrow(_by_document, "doc_id long, mark long, found binary")
    cut = join(removed).select("doc_id", "mark", "text", "found").mapInArrow(_cut, "doc_id long, mark long, n_removed long, n_spans long, kept binary")
    return info, cut


def suffix_dedup(docs: DataFrame) -> DataFrame:
    """Remove every byte covered by a 50-byte string that also starts in a document with a smaller doc_id.

    ``docs`` needs doc_id and text; texts are UTF-8 bytes and strings are judged on the input. Returns
    doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and kept_sha256. Null and empty texts have
    no bytes; texts under 50 bytes lose none; rows that repeat a doc_id are one document and remove nothing
    from each other; a null doc_id takes no part; an empty table gives an empty table.
    """
    info, cut = _structures(docs)
    cut = cut.select("doc_id", "mark", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")).dropDuplicates(["doc_id", "mark"])
    copy = (F.col("doc_id") > F.col("first_id")) & (F.col("n_bytes") >= LENGTH)
    copy = F.coalesce(copy, F.lit(False))
    return info.join(cut, ["doc_id", "mark"], "left").select(
        "doc_id",
        "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(copy, F.sha2(F.lit(b""), 256)).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("sha")))).alias("kept_sha256"),
    )


def op9_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return suffix_dedup(common.read(spark, sf_dir, "documents"))


OP9_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, '')))::BIGINT AS n FROM documents),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, greatest(n - 49, 0))) AS i FROM d)),
m AS (SELECT s, min(doc_id) AS first_id FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)),
r AS (SELECT w.doc_id, i, i > coalesce(lag(i) OVER (PARTITION BY w.doc_id ORDER BY i) + 50, -1) AS starts FROM w JOIN m USING (s) WHERE first_id < w.doc_id),
g AS (SELECT doc_id, i, sum(starts::INTEGER) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM r),
p AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM g GROUP BY doc_id, span),
q AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM p),
k AS (SELECT q.doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS kept FROM q JOIN d USING (doc_id) GROUP BY q.doc_id)
SELECT d.doc_id, d.n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
