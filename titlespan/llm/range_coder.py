"""An adaptive range coder for blocks of ids, many blocks in step with each other.

An id is predicted by what followed the last two ids, by what followed the last one, and by what
the block holds most. The confidences of the three predictions, and whether they agree, are mixed
in the logistic domain, with weights that learn, to the probability that the prediction of the
highest order that has one holds. Next comes the prediction of a lower order, if it is another;
the two questions are one choice of three. What neither foretold is coded by an adaptive
distribution over classes of ids of like size. All of it drives a carry-free range coder with
64-bit state. Every block starts from the same state, knows its length, and ends with a checksum.

One numpy operation does the same step for every block, so the cost is per step and not per id.
All arithmetic is in integers: what one machine writes, another reads.
"""

from __future__ import annotations

import zlib
from math import exp, log

import numpy as np

BLOCK = 4096
MAGIC = b"TSB2"
#: Slots by block for the predictions of orders 1 and 2, and levels of confidence.
SLOTS, LEVELS = 1024, 8
#: Ids are below this.
MOST = (1 << 20) - 64

_U = np.uint64
_LOW32, _TOP = _U(0xFFFFFFFF), _U(1 << 32)
#: Bits of a mixed probability, of the choice of three, and of the distribution over classes.
_FLAG_BITS, _PICK_BITS, _CLASS_BITS = 12, 16, 15
_CLASS_STEP, _CLASS_MOST = 24, 1 << 15
#: The distribution over classes is renewed at these steps and at every multiple of the last one.
_RENEWED = (4, 8, 16, 32)
_WEIGHT, _WEIGHT_MOST = 24000, 1 << 18


def _squash(x: int) -> int:
    return min(4064, max(32, round(4096 / (1 + exp(-x / 256)))))


#: By `x + 2048`; what is beyond either end has the value of that end.
_SQUASH = np.array([_squash(x) for x in range(-2048, 2048)], np.int32)
#: The probability that the second try holds, of 12 bits, kept off the ends.
_AGAIN = np.array([min(4064, max(32, p)) for p in range(4096)], np.int32)
_STRETCH = np.array(
    [max(-2047, min(2047, round(256 * log((p + 0.5) / (4095.5 - p))))) for p in range(4096)], np.int32
)
#: The next level by `level + LEVELS * (it held)`; nought where the prediction is replaced.
_NEXT = np.array([*(n >> 1 for n in range(LEVELS)), *(min(n + 1, LEVELS - 1) for n in range(LEVELS))], np.int32)


#: Order 0 is patient: what does not hold costs a level at every eighth step only.
_PATIENCE = 8
_NEXT_0 = np.array([*range(LEVELS), *_NEXT[LEVELS:]], np.int32), np.array(
    [*(max(n - 1, 0) for n in range(LEVELS)), *_NEXT[LEVELS:]], np.int32
)


def _classes(limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By id: its class; by class: its first id and the bits of the rest. Four to an octave."""
    of_id = np.empty(limit, np.intp)
    first, bits = [], []
    at = 0
    while at < limit:
        octave = (at + 64).bit_length() - 1
        width = 1 << (octave - 2)
        of_id[at : at + width] = len(first)
        first.append(at)
        bits.append(octave - 2)
        at += width
    return of_id, np.array(first, np.int32), np.array(bits, np.uint64)


class _Model:
    """What the blocks have seen so far; `lanes` blocks side by side."""

    def __init__(self, lanes: int, classes: int):
        rows = np.arange(lanes)
        # A slot holds an id and, in its last three bits, the level of confidence. Order 0 has one.
        self.table = np.zeros(lanes * (1 + 2 * SLOTS), np.int32)
        self.base = [lanes + rows * SLOTS, lanes + (lanes + rows) * SLOTS]
        self.slot = np.stack([rows, *self.base])
        self.before = np.zeros(lanes, np.int64)
        # Probabilities of 16 bits, by order, level and agreement with the first try; at last those
        # of the second try.
        cells = 8 * LEVELS
        self.odds = np.full(lanes * cells, 16384, np.int32)
        self.cells = rows * cells + 2 * LEVELS * np.arange(4)[:, None]
        self.weights = np.full((3, lanes), _WEIGHT, np.int32)
        self.classes, self.places = classes, rows * classes
        self.counts = np.ones((lanes, classes), np.int32)
        self.totals = np.full(lanes, classes, np.int64)
        # A row for each class, and one for the end.
        self.bounds = np.empty((classes + 1, lanes), np.int32)
        self.steps = 0
        self._renew()

    def predict(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """`(first try, its share, second try, its share)`, of all that `_PICK_BITS` can tell apart;
        a second try that is the first one has none."""
        entry = self.table.take(self.slot, mode="clip")
        level, ids = entry & (LEVELS - 1), entry >> 3
        known = level[1] > 0
        first = np.where(level[2] > 0, ids[2], np.where(known, ids[1], ids[0]))
        agree = ids == first
        lower = known & ~agree[1]
        second = np.where(lower, ids[1], ids[0])
        cell = self.cells[:3] + (level + (agree.view(np.uint8) << 3))
        odds = self.odds.take(cell, mode="clip")
        inputs = _STRETCH.take(odds >> 4, mode="clip")
        mixed = (self.weights * inputs).sum(axis=0, dtype=np.int32) >> 16
        chance = _SQUASH.take(mixed + 2048, mode="clip")
        cell_again = self.cells[3] + (level[1] + (lower.view(np.uint8) << 3))
        odds_again = self.odds.take(cell_again, mode="clip")
        again = _AGAIN.take(odds_again >> 4, mode="clip")
        other = second != first
        share = ((1 << _FLAG_BITS) - chance) * again >> 8
        self.now = entry, level, ids, cell, odds, inputs, chance, cell_again, odds_again, other
        return first, chance << 4, second, share * other

    def learn(self, x: np.ndarray, hit: np.ndarray, hit_again: np.ndarray) -> None:
        entry, level, ids, cell, odds, inputs, chance, cell_again, odds_again, other = self.now
        held = hit.astype(np.int32)
        self.odds[cell] = odds + ((held << 16) - odds >> 5)
        moved = (hit_again.astype(np.int32) << 16) - odds_again >> 5
        self.odds[cell_again] = odds_again + moved * (other & ~hit)
        self.weights += inputs * (((held << _FLAG_BITS) - chance) * 6) >> 10
        np.maximum(np.minimum(self.weights, _WEIGHT_MOST), -_WEIGHT_MOST, out=self.weights)
        seen = level + ((ids == x).view(np.uint8) << 3)
        after = _NEXT.take(seen, mode="clip")
        after[0] = _NEXT_0[self.steps % _PATIENCE == 0].take(seen[0], mode="clip")
        self.table[self.slot] = np.where(after > 0, entry - level + after, (x << 3) + 1)
        wide = x.astype(np.int64)
        mark = wide * 40503
        np.add(self.base[0], mark >> 4 & (SLOTS - 1), out=self.slot[1])
        np.add(self.base[1], mark + self.before >> 3 & (SLOTS - 1), out=self.slot[2])
        self.before = wide * 48271

    def bounds_of(self, lanes: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and size of classes among `1 << _CLASS_BITS`."""
        row = self.bounds.shape[1]
        at = kind * row + lanes
        start = self.bounds.take(at, mode="clip")
        return start.astype(np.uint64), (self.bounds.take(at + row, mode="clip") - start).astype(np.uint64)

    def kind_at(self, lanes: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The classes whose shares hold the places."""
        return (self.bounds.take(lanes, axis=1, mode="clip") <= place).sum(axis=0, dtype=np.intp) - 1

    def seen(self, lanes: np.ndarray, kind: np.ndarray) -> None:
        """Counts the classes of the lanes that coded one; ends a step."""
        self.counts.reshape(-1)[self.places.take(lanes, mode="clip") + kind] += _CLASS_STEP
        self.totals[lanes] += _CLASS_STEP
        self.steps += 1
        if self.steps in _RENEWED or self.steps % _RENEWED[-1] == 0:
            self._renew()

    def _renew(self) -> None:
        """The distribution over classes from their counts: each has a share of one at least."""
        full = np.flatnonzero(self.totals > _CLASS_MOST)
        if len(full):
            self.counts[full] = (self.counts[full] >> 1) + 1
            self.totals[full] = self.counts[full].sum(axis=1)
        free = (1 << _CLASS_BITS) - self.classes
        sums = np.cumsum(self.counts, axis=1, dtype=np.int64) * free // self.totals[:, None]
        self.bounds[0] = 0
        self.bounds[1:] = (sums + np.arange(1, self.classes + 1)).T


class _Range:
    """Low end and width of every block's interval; 32 bits move on when the width needs them."""

    def __init__(self, lanes: int):
        self.low = np.zeros(lanes, np.uint64)
        self.width = np.full(lanes, _LOW32 << _U(31), np.uint64)

    def pick(self, share: np.ndarray, share_again: np.ndarray, hit: np.ndarray, coded: np.ndarray) -> None:
        """The first try, the second one, or neither."""
        rest = (1 << _PICK_BITS) - share - share_again
        size = np.where(hit, share, np.where(coded, rest, share_again)).astype(np.uint64)
        start = (share * ~hit + share_again * coded).astype(np.uint64)
        unit = self.width >> _U(_PICK_BITS)
        self.low += unit * start
        self.width = unit * size

    def settled(self, among: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The blocks whose upper 32 bits are fixed, cut so that they are, and their low ends before."""
        if among is None:
            at = np.flatnonzero(self.width < _TOP)
        else:
            at = among[self.width.take(among, mode="clip") < _TOP]
        low = self.low.take(at, mode="clip")
        rest = low & _LOW32
        self.width[at] = np.minimum(self.width.take(at, mode="clip"), _TOP - rest) << _U(32)
        self.low[at] = rest << _U(32)
        return at, low


class Coder:
    """Codes ids below `limit`; the same limit must be given to read."""

    def __init__(self, limit: int):
        if not 0 < limit <= MOST:
            raise ValueError(f"ids must be below {MOST}")
        self.of_id, self.first, self.bits = _classes(limit)
        self.width = len(self.first)

    def encode(self, ids: np.ndarray, block: int = BLOCK) -> list[bytes]:
        """The records of the blocks that `ids`, one behind another, fill; the last may be short."""
        lanes = max(1, -(-len(ids) // block))
        full = np.zeros(lanes * block, np.int32)
        full[: len(ids)] = ids
        steps = np.ascontiguousarray(full.reshape(lanes, block).T)
        del full
        model, interval = _Model(lanes, self.width), _Range(lanes)
        places: list[np.ndarray] = []
        words: list[np.ndarray] = []
        small = np.uint16 if lanes < 1 << 16 else np.int64

        def out(among: np.ndarray | None = None) -> None:
            at, low = interval.settled(among)
            places.append(at.astype(small))
            words.append((low >> _U(32)).astype(np.uint32))

        for x in steps:
            first, share, second, share_again = model.predict()
            hit = first == x
            hit_again = (second == x) & ~hit
            coded = ~(hit | hit_again)
            interval.pick(share, share_again, hit, coded)
            out()
            some = np.flatnonzero(coded)
            own = x.take(some, mode="clip")
            kind = self.of_id.take(own)
            start, size = model.bounds_of(some, kind)
            unit = interval.width.take(some, mode="clip") >> _U(_CLASS_BITS)
            low = interval.low.take(some, mode="clip") + unit * start
            unit = unit * size >> self.bits.take(kind, mode="clip")
            interval.low[some] = low + unit * (own - self.first.take(kind, mode="clip")).astype(np.uint64)
            interval.width[some] = unit
            out(some)
            model.learn(x, hit, hit_again)
            model.seen(some, kind)
        # The end: two words of a number inside the interval.
        for _ in range(2):
            places.append(np.arange(lanes).astype(small))
            words.append((interval.low >> _U(32)).astype(np.uint32))
            interval.low = (interval.low & _LOW32) << _U(32)
        at, all_words = np.concatenate(places), np.concatenate(words)
        order = np.argsort(at, kind="stable")
        ends = np.cumsum(np.bincount(at, minlength=lanes))
        parts = np.split(all_words[order].astype("<u4"), ends[:-1])
        return [
            _record(ids[i * block : (i + 1) * block], block, p)
            for i, p in enumerate(parts)
        ]

    def decode(self, records: list[bytes]) -> list[np.ndarray]:
        """The ids of each record; a record that was changed raises `ValueError`."""
        heads = [_parsed(r) for r in records]
        if not heads:
            return []
        block = heads[0][1]
        if any(h[1] != block for h in heads):
            raise ValueError("blocks of one length are read together")
        lanes = len(heads)
        sizes = np.array([len(h[3]) for h in heads])
        data = np.concatenate([*(h[3] for h in heads), np.zeros(4, "<u4")]).astype(np.uint64)
        at = np.cumsum(sizes) - sizes
        end = np.cumsum(sizes)
        model, interval = _Model(lanes, self.width), _Range(lanes)
        code = data[at] << _U(32) | data[at + 1]
        at += 2

        def move(among: np.ndarray | None = None) -> None:
            some, _ = interval.settled(among)
            here = at.take(some, mode="clip")
            now = data.take(np.minimum(here, end.take(some, mode="clip")))
            code[some] = code.take(some, mode="clip") << _U(32) | now
            at[some] = here + 1

        steps = np.empty((block, lanes), np.int32)
        most = (1 << _CLASS_BITS) - 1
        for t in range(block):
            first, share, second, share_again = model.predict()
            unit, place = interval.width >> _U(_PICK_BITS), code - interval.low
            hit = place < unit * share.astype(np.uint64)
            coded = place >= unit * (share + share_again).astype(np.uint64)
            hit_again = ~(hit | coded)
            interval.pick(share, share_again, hit, coded)
            move()
            x = np.where(hit, first, second)
            some = np.flatnonzero(coded)
            unit = interval.width.take(some, mode="clip") >> _U(_CLASS_BITS)
            low = interval.low.take(some, mode="clip")
            place = code.take(some, mode="clip") - low
            kind = model.kind_at(some, np.minimum(place // unit, _U(most)).astype(np.int32))
            start, size = model.bounds_of(some, kind)
            place -= unit * start
            low += unit * start
            bits = self.bits.take(kind, mode="clip")
            unit = unit * size >> bits
            value = np.minimum(place // unit, (_U(1) << bits) - _U(1))
            interval.low[some] = low + unit * value
            interval.width[some] = unit
            move(some)
            x[some] = self.first.take(kind) + value.astype(np.int32)
            steps[t] = x
            model.learn(x, hit, hit_again)
            model.seen(some, kind)
        out = []
        for ids, (count, _, crc, _) in zip(steps.T, heads, strict=True):
            own = np.ascontiguousarray(ids[:count])
            if zlib.crc32(own.astype("<u4").tobytes()) != crc:
                raise ValueError("checksum of a block differs")
            out.append(own)
        return out


def _record(ids: np.ndarray, block: int, words: np.ndarray) -> bytes:
    """Magic, number of ids, steps of the block, checksum of the ids, words."""
    crc = zlib.crc32(ids.astype("<u4").tobytes())
    return MAGIC + np.array([len(ids), block, crc], "<u4").tobytes() + words.tobytes()


def _parsed(record: bytes) -> tuple[int, int, int, np.ndarray]:
    if record[:4] != MAGIC or len(record) < 24:
        raise ValueError("not a block of ids")
    count, block, crc = np.frombuffer(record, "<u4", 3, 4).tolist()
    return count, block, crc, np.frombuffer(record, "<u4", offset=16)
