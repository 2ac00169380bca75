"""Burrows-Wheeler transform and common prefixes of a collection, built column by column.

Round j inserts the suffix of length j of every string that is long enough, each at the
place that its first symbol and the place of its remainder give. Two sequences in suffix
order are kept, the places of the remainders (the transform is read off them at the end)
and the common prefixes, and a round rewrites each of them once from front to back. A
collection is one bounded block of a task, so the sequences are held as arrays rather than
as files on a machine's own disk, which other machines could not see.
"""

from __future__ import annotations

import numpy as np

_SPAN = 64
#: Common prefixes count no further.
MOST = 255


class _RangeMin:
    """Minima of ranges: ends are read, whole spans between them come from a table of doubled spans."""

    def __init__(self, values: np.ndarray):
        whole = len(values) // _SPAN
        self.values = values
        self.levels = [values[: whole * _SPAN].reshape(-1, _SPAN).min(axis=1)] if whole else [values[:0]]
        while 2 << (len(self.levels) - 1) <= len(self.levels[0]):
            half, last = 1 << (len(self.levels) - 1), self.levels[-1]
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def _read(self, low: np.ndarray, n: np.ndarray) -> np.ndarray:
        ends = np.cumsum(n)
        flat = np.repeat(low - ends + n, n) + np.arange(ends[-1])
        return np.minimum.reduceat(self.values[flat], ends - n)

    def __call__(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Minimum over first..last, both included, for each pair."""
        a, b = first // _SPAN + 1, last // _SPAN  # whole spans a..b-1
        long = b > a
        out = np.empty(len(first), self.values.dtype)
        short = np.flatnonzero(~long)
        if len(short):
            out[short] = self._read(first[short], last[short] - first[short] + 1)
        far = np.flatnonzero(long)
        if len(far):
            x, y = a[far], b[far]
            low = np.minimum(self._read(first[far], x * _SPAN - first[far]), self._read(y * _SPAN, last[far] - y * _SPAN + 1))
            level = np.log2(y - x).astype(np.int64)
            for k in np.unique(level):
                here = level == k
                table = self.levels[k]
                low[here] = np.minimum(low[here], np.minimum(table[x[here]], table[y[here] - (1 << k)]))
            out[far] = low
        return out


def build(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(string, offset, common prefix with the suffix before, symbol before) of all suffixes in order, empty ones first.

    Symbols are bytes plus one, 0 stands before a whole string. Equal suffixes follow the order of their strings.
    """
    m = len(strings)
    lengths = np.fromiter(map(len, strings), np.int64, m)
    text = np.frombuffer(b"".join(strings), np.uint8)
    starts = np.cumsum(lengths) - lengths
    # round 0: an empty suffix a string; pile c holds the suffixes that begin with symbol c
    piles = np.zeros(258, np.int64)
    piles[1:] = m
    rest, common, place = np.arange(m, dtype=np.int64), np.zeros(m, np.uint8), np.arange(m, dtype=np.int64)
    for j in range(1, int(lengths.max(initial=0)) + 1):
        live = np.flatnonzero(lengths >= j)
        symbol = text[starts[live] + lengths[live] - j].astype(np.int64) + 1
        size = len(rest)
        order = np.argsort(symbol * size + place[live])
        live, symbol = live[order], symbol[order]
        remainder = place[live]
        at = np.empty(len(live), np.int64)
        groups = np.flatnonzero(np.diff(symbol, prepend=-1))
        lows, highs = piles[symbol[groups]], piles[symbol[groups] + 1]
        for a, b, low, high in zip(groups.tolist(), [*groups[1:].tolist(), len(live)], lows.tolist(), highs.tolist(), strict=True):
            at[a:b] = rest[low:high].searchsorted(remainder[a:b]) + low
        fresh = at + np.arange(len(live))
        # a new suffix has a new common prefix with the one before it, and so has the old one behind it
        inner = np.ones(len(live), bool)
        inner[groups] = at[groups] > lows  # the first of a pile shares nothing
        follows = np.append(False, (at[1:] == at[:-1]) & (symbol[1:] == symbol[:-1]))  # the one before is new, too
        inner = np.flatnonzero(inner)
        before = np.where(follows[inner], remainder[inner - 1], rest[at[inner] - 1])
        behind = np.flatnonzero(~np.append(follows[1:], False) & (at < np.repeat(highs, np.diff(np.append(groups, len(live))))))
        first = np.concatenate([before, remainder[behind]]) + 1
        last = np.concatenate([remainder[inner], rest[at[behind]]])
        shared = np.minimum(_RangeMin(common)(first, last), MOST - 1) + 1 if len(first) else common[:0]
        # places move back by the suffixes inserted before them
        kept = np.ones(size + len(live), bool)
        kept[fresh] = False
        moved = np.flatnonzero(kept)
        rest2, common2 = np.empty(size + len(live), np.int64), np.zeros(size + len(live), np.uint8)
        rest2[kept], rest2[fresh] = moved.take(rest), moved[remainder]
        common2[kept] = common
        common2[fresh[inner]], common2[moved[at[behind]]] = shared[: len(inner)], shared[len(inner) :]
        rest, common = rest2, common2
        place = moved[place]
        place[live] = fresh
        piles[1:] += np.searchsorted(symbol, np.arange(1, 258))
    owner, offset, before = np.empty(len(rest), np.int64), np.empty(len(rest), np.int64), np.zeros(len(rest), np.int32)
    at, live = place.astype(np.int64), np.arange(m)
    for o in range(int(lengths.max(initial=0)) + 1):
        owner[at], offset[at] = live, o
        if o:
            before[at] = text[starts[live] + o - 1].astype(np.int32) + 1
        more = lengths[live] > o
        live, at = live[more], rest[at[more]]
    return owner, offset, common.astype(np.int64), before
