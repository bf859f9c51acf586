"""Two-stage suffix sorting of many short segments, and the common prefixes of neighbours.

A suffix smaller than its successor (type S) is sorted directly. A larger one (type L) is its
first symbol before a suffix that comes earlier, so one scan over the buckets of first symbols,
from the smallest, puts every L suffix where it belongs. Suffixes end with their segment.
"""

from __future__ import annotations

import numpy as np


class Segments:
    """Segments one behind another, each closed by symbol 0; bytes are symbols 1 to 256."""

    def __init__(self, texts: list[bytes], counts: list[int]):
        """`counts`: how many suffixes of each segment, from its first byte on, are wanted."""
        self.data = b"\0".join(texts) + b"\0" * 9
        lengths = np.array([len(t) for t in texts], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1]
        self.ends = self.starts + lengths
        self.counts = np.array(counts, np.int64)
        size = int(self.ends[-1]) + 1
        symbols = np.frombuffer(self.data, np.uint8, size).astype(np.int16) + 1
        symbols[self.ends] = 0
        self.symbols = symbols
        self.small = self._types()
        self.needed = self._needed()

    def _types(self) -> np.ndarray:
        """Type S: the next different symbol is larger. Separators count as neither."""
        step = np.diff(self.symbols.astype(np.int32), append=-1)
        at = np.where(step != 0, np.arange(len(step)), len(step) - 1)
        following = np.minimum.accumulate(at[::-1])[::-1]
        small = step[following] > 0
        small[self.ends] = False
        return small

    def _needed(self) -> np.ndarray:
        """The wanted suffixes and those behind them up to one that is sorted directly."""
        places = np.arange(len(self.symbols))
        next_small = np.where(self.small, places, len(places))
        next_small = np.minimum.accumulate(next_small[::-1])[::-1]
        last = np.minimum(next_small[self.starts + self.counts], self.ends)
        change = np.zeros(len(places) + 1, np.int32)
        np.add.at(change, self.starts, 1)
        np.add.at(change, last + 1, -1)
        return np.cumsum(change[:-1]) > 0

    def wanted(self) -> np.ndarray:
        change = np.zeros(len(self.symbols) + 1, np.int32)
        np.add.at(change, self.starts, 1)
        np.add.at(change, self.starts + self.counts, -1)
        return np.cumsum(change[:-1]) > 0

    def segment_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, places, "right") - 1


def suffix_array(text: Segments) -> np.ndarray:
    """The needed suffixes in order; equal ones by their place or what induced them."""
    data, symbols = text.data, text.symbols
    direct = np.flatnonzero(text.small & text.needed)
    ends = text.ends[text.segment_of(direct)]
    keys = [data[p:e] for p, e in zip(direct.tolist(), ends.tolist(), strict=True)]
    direct = direct[np.array(sorted(range(len(keys)), key=keys.__getitem__), np.int64)]
    del keys
    bounds = np.searchsorted(symbols[direct], np.arange(258))

    induced: list[list[np.ndarray]] = [[] for _ in range(258)]
    large = ~text.small & text.needed

    def induce(places: np.ndarray, symbol: int) -> np.ndarray:
        """Puts the L suffixes one before `places` into their buckets; returns those of this one."""
        before = places[places > 0] - 1
        before = before[large[before] & (symbols[before] > 0)]
        if not len(before):
            return before
        first = symbols[before]
        order = np.argsort(first, kind="stable")
        before, first = before[order], first[order]
        cuts = np.flatnonzero(np.diff(first)) + 1
        own = before[:0]
        for group, at in zip(np.split(before, cuts), [0, *cuts.tolist()], strict=True):
            if first[at] == symbol:
                own = group
            else:
                induced[first[at]].append(group)
        return own

    induce(text.ends[text.needed[text.ends]], 0)
    out = []
    for symbol in range(1, 257):
        scan = induced[symbol]
        if scan:
            new = np.concatenate(scan)
            while len(new):
                out.append(new)
                new = induce(new, symbol)
            induced[symbol] = []
        small = direct[bounds[symbol] : bounds[symbol + 1]]
        if len(small):
            out.append(small)
            induce(small, symbol)
    return np.concatenate(out) if out else np.empty(0, np.int64)


def common_prefixes(text: Segments, order: np.ndarray, most: int) -> np.ndarray:
    """Of each suffix in `order` and the one before it: bytes in common, at most `most`; 0 for
    the first. Bytes behind the end of a segment are never counted."""
    left, right = order[:-1], order[1:]
    room = np.minimum(text.ends[text.segment_of(left)] - left, text.ends[text.segment_of(right)] - right)
    room = np.minimum(room, most)
    data = np.frombuffer(text.data, np.uint8)
    words = np.lib.stride_tricks.as_strided(data[:8].view("<u8"), (len(data) - 8,), (1,))
    found = np.zeros(len(left), np.int64)
    alive = np.flatnonzero(room > 0)
    depth = 0
    while len(alive):
        differs = words[left[alive] + depth] ^ words[right[alive] + depth]
        same = differs == 0
        stopped = alive[~same]
        low = differs[~same]
        low = low & (~low + np.uint64(1))  # the lowest set bit lies in the first byte that differs
        found[stopped] = depth + (np.log2(low.astype(np.float64)).astype(np.int64) >> 3)
        depth += 8
        alive = alive[same]
        found[alive] = depth
        alive = alive[room[alive] > depth]
    return np.concatenate([[0], np.minimum(found, room)])[: len(order)]
