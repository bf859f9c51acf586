"""A6, A8, A9's comparison of two taggings, for Arrow batches of records.

Inside a task the tags of a batch are codes in numpy arrays, so that spans are found for all of its
records at once; Spark deals the records out and adds the counters up.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructType

from titlespan.types import ENTITY_TYPES

#: Tokens worked on at once, about; a record is not split.
PIECE_TOKENS = 200_000

_BLANK, _OUT, _BEGIN, _INSIDE, _OTHER = range(5)

# Tasks get this module's code with the query, so that executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _lengths(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _starts(lengths: np.ndarray) -> np.ndarray:
    return np.cumsum(lengths) - lengths


def _pieces(lists: pa.Array) -> Iterator[tuple[int, int]]:
    """Start and number of records, so that pieces have few enough tokens."""
    ends = np.cumsum(_lengths(lists))
    start = 0
    while start < len(ends):
        done = ends[start - 1] if start else 0
        stop = max(int(np.searchsorted(ends, done + PIECE_TOKENS, side="right")), start + 1)
        yield start, stop - start
        start = stop


class Tags:
    """One side's tags: `codes` into `labels`, with the row and the place of each."""

    def __init__(self, lists: pa.Array, at_most: np.ndarray | None = None):
        lengths = _lengths(lists)
        encoded = pc.fill_null(lists.flatten().cast(pa.string()), "").dictionary_encode()
        self.labels = encoded.dictionary.to_pylist()
        self.codes = encoded.indices.to_numpy(zero_copy_only=False)
        self.row = np.repeat(np.arange(len(lengths)), lengths)
        self.pos = np.arange(len(self.row)) - np.repeat(_starts(lengths), lengths)
        if at_most is not None and (lengths > at_most).any():
            left = self.pos < at_most[self.row]
            self.codes, self.row, self.pos = self.codes[left], self.row[left], self.pos[left]
            lengths = np.minimum(lengths, at_most)
        self.lengths = lengths
        kinds = {"": _BLANK, "O": _OUT}
        prefixes = {"B-": _BEGIN, "I-": _INSIDE}
        self.kind = np.array([kinds.get(x, prefixes.get(x[:2], _OTHER)) for x in self.labels], np.int8)
        self.types = sorted({x[2:] for x in self.labels if x[:2] in prefixes})
        place = {t: i for i, t in enumerate(self.types)}
        self.type = np.array([place[x[2:]] if x[:2] in prefixes else -1 for x in self.labels], np.int64)

    def spans(self, strict: bool) -> tuple[np.ndarray, ...]:
        """Row, type, start, stop and last place of the ranges that `functions.tags` calls spans.

        In strict mode blanks continue a span and tags that are none close it; otherwise blanks close
        it and tags that are none are passed over. `stop` is the next boundary.
        """
        kinds = self.kind[self.codes]
        events = np.flatnonzero(kinds != (_BLANK if strict else _OTHER))
        code, kind, row, pos = self.codes[events], kinds[events], self.row[events], self.pos[events]
        type_ = self.type[code]
        continues = np.zeros(len(events), bool)
        same = (code[1:] == code[:-1]) | ((kind[:-1] == _BEGIN) & (type_[1:] == type_[:-1]))
        continues[1:] = (kind[1:] == _INSIDE) & (row[1:] == row[:-1]) & same
        breaks = np.flatnonzero(~continues)
        rows, starts = row[breaks], pos[breaks]
        stops = self.lengths[rows]
        in_row = np.flatnonzero(rows[1:] == rows[:-1])
        stops[in_row] = starts[in_row + 1]
        last = pos[np.append(breaks[1:], len(events)) - 1] if len(breaks) else pos[:0]
        opens = (kind[breaks] == _BEGIN) | (kind[breaks] == _INSIDE)
        return tuple(x[opens] for x in (rows, type_[breaks], starts, stops, last))


def _texts(tokens: pa.Array, starts: np.ndarray, row, start, stop) -> pa.Array:
    """The tokens of each range joined by blanks; NULL tokens are left out."""
    lengths = stop - start
    ends = np.cumsum(lengths)
    where = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[row] + start - (ends - lengths), lengths)
    taken = tokens.take(pa.array(where))
    if taken.null_count:
        known = taken.is_valid().to_numpy(zero_copy_only=False)
        ends = np.append(0, np.cumsum(known))[ends]
        taken = taken.drop_null()
    offsets = pa.array(np.append(0, ends).astype(np.int32))
    return pc.binary_join(pa.ListArray.from_arrays(offsets, taken), " ")


def matches(tokens: pa.Array, true: pa.Array, pred: pa.Array, types: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Per record and listed type whether the sets of texts are equal, and whether they only
    overlap; spans are strict and as long as the tokens at most."""
    lengths = _lengths(tokens)
    words, starts = tokens.flatten().cast(pa.string()), _starts(lengths)
    listed = {t: i for i, t in enumerate(types)}
    found = []
    for lists in (true, pred):
        side = Tags(lists, lengths)
        row, type_, start, stop, _ = side.spans(strict=True)
        number = np.array([listed.get(t, -1) for t in side.types], np.int64)
        type_ = number[type_] if len(number) else type_
        keep = type_ >= 0
        row, type_, start, stop = row[keep], type_[keep], start[keep], stop[keep]
        found.append((row * len(types) + type_, _texts(words, starts, row, start, stop)))
    texts = pa.concat_arrays([t for _, t in found]).dictionary_encode()
    codes = texts.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    n, split = max(len(texts.dictionary), 1), len(found[0][0])
    a = np.unique(found[0][0] * n + codes[:split])
    b = np.unique(found[1][0] * n + codes[split:])
    apart = np.zeros(len(lengths) * len(types), bool)
    common = apart.copy()
    apart[np.setxor1d(a, b, assume_unique=True) // n] = True
    common[np.intersect1d(a, b, assume_unique=True) // n] = True
    shape = (len(lengths), len(types))
    return ~apart.reshape(shape), (apart & common).reshape(shape)


def with_types(seqs: DataFrame, types: Sequence[str] = ENTITY_TYPES) -> DataFrame:
    """Adds `by_type`, an array of `(type, exact, partial)`, NULL for a record that lacks an array.

    Spark copies a function's input into the function's call, and such a call into what reads it; what
    goes through `mapInArrow` is worked out once.
    """
    types = list(types)
    columns = seqs.columns
    at = [columns.index(c) for c in ("tokens", "true_tags", "pred_tags")]

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n in _pieces(batch.column(at[0])):
                piece = batch.slice(first, n)
                sides = [piece.column(i) for i in at]
                whole = np.logical_and.reduce([x.is_valid().to_numpy(zero_copy_only=False) for x in sides])
                flags = [pa.array(f.ravel(), mask=np.repeat(~whole, len(types))) for f in matches(*sides, types)]
                names = pa.array(types, pa.string()).take(pa.array(np.tile(np.arange(len(types)), n)))
                structs = pa.StructArray.from_arrays([names, *flags], ["type", "exact", "partial"])
                lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * len(types)), structs)
                yield pa.RecordBatch.from_arrays([*piece.columns, lists], [*columns, "by_type"])

    match = StructType().add("type", StringType()).add("exact", BooleanType()).add("partial", BooleanType())
    return seqs.mapInArrow(compared, StructType(list(seqs.schema.fields)).add("by_type", ArrayType(match)))


class Counters:
    """Rows `(group, grain, k1, k2, n)`."""

    def __init__(self):
        self.group, self.grain, self.k1, self.k2, self.n = [], [], [], [], []

    def add(self, grain: str, groups: np.ndarray, first, names1: Sequence[str], second=None, names2: Sequence[str] = ("",)) -> None:
        """Counts the combinations of a group, a name and perhaps a second name."""
        size1, size2 = len(names1), len(names2)
        keys = groups * (size1 * size2) + np.asarray(first, np.int64) * size2 + (0 if second is None else second)
        for key, n in zip(*(x.tolist() for x in np.unique(keys, return_counts=True)), strict=True):
            self.group.append(key // (size1 * size2))
            self.grain.append(grain)
            self.k1.append(names1[key // size2 % size1])
            self.k2.append(names2[key % size2])
            self.n.append(n)


def _groups(columns: list[pa.Array], n: int) -> tuple[np.ndarray, np.ndarray]:
    """The group of every row by equal values, NULL included, and a row of each group."""
    group = np.zeros(n, np.int64)
    for column in columns:
        codes = column.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        group = np.unique(group * (int(codes.max(initial=0)) + 1) + codes, return_inverse=True)[1]
    return group, np.unique(group, return_index=True)[1]


def _span_counters(counters: Counters, group: np.ndarray, true: pa.Array, pred: pa.Array) -> None:
    sides = [Tags(true), Tags(pred)]
    types = sorted({t for s in sides for t in s.types})
    place = {t: i for i, t in enumerate(types)}
    found = []
    for grain, side in zip(("span_true", "span_pred"), sides, strict=True):
        row, type_, start, _, last = side.spans(strict=False)
        number = np.array([place[t] for t in side.types], np.int64)
        type_ = number[type_] if len(number) else type_
        counters.add(grain, group[row], type_, types or [""])
        found.append((row << 32 | start, type_, last, row))
    # Spans of one tagging start at different places.
    (a, type_a, last_a, row), (b, type_b, last_b, _) = found
    _, at, other = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    same = (type_a[at] == type_b[other]) & (last_a[at] == last_b[other])
    counters.add("span_hit", group[row[at[same]]], type_a[at[same]], types or [""])


def _record_counters(counters: Counters, group: np.ndarray, tokens: pa.Array, true: pa.Array, pred: pa.Array) -> None:
    sides = [Tags(true), Tags(pred)]
    counters.add("pair", group[sides[0].row], sides[0].codes, sides[0].labels or [""], sides[1].codes, sides[1].labels or [""])
    types = ENTITY_TYPES
    exact, partial = matches(tokens, true, pred, types)
    for kind, held in (("total", np.ones_like(exact)), ("exact", exact), ("partial", partial)):
        row, type_ = np.nonzero(held)
        counters.add("match", group[row], type_, types, 0, [kind])
    records = {
        "sequences": np.ones(len(group), bool), "exact": (exact | partial).all(axis=1), "partial": partial.any(axis=1)
    }
    for kind, held in records.items():
        counters.add("record", group[held], 0, [kind])


def counts(seqs: DataFrame, by: Sequence[str], records: bool) -> DataFrame:
    """`(*by, grain, k1, k2, n)` of spans, with `records` also of pairs, matches and records.

    A record without tags counts nowhere; with `records`, one whose arrays differ in length is an error.
    """
    by = list(by)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n in _pieces(batch.column(len(by) + 1)):
                piece = batch.slice(first, n)
                arrays = piece.columns[len(by) :]
                if records:
                    lengths = [pc.fill_null(pc.list_value_length(x), -1) for x in arrays]
                    if not (lengths[0].equals(lengths[1]) and lengths[0].equals(lengths[2])):
                        raise ValueError("tokens and tags differ in length")
                whole = pc.and_(arrays[1].is_valid(), arrays[2].is_valid())
                if not pc.all(whole, min_count=0).as_py():
                    piece = piece.filter(whole)
                    arrays = piece.columns[len(by) :]
                group, shown = _groups(piece.columns[: len(by)], len(piece))
                counters = Counters()
                if records:
                    _record_counters(counters, group, *arrays)
                _span_counters(counters, group, *arrays[1:])
                keys = [c.take(pa.array(shown[np.array(counters.group, np.int64)])) for c in piece.columns[: len(by)]]
                made = [pa.array(x, pa.string()) for x in (counters.grain, counters.k1, counters.k2)]
                made.append(pa.array(counters.n, pa.int64()))
                yield pa.RecordBatch.from_arrays([*keys, *made], [*by, "grain", "k1", "k2", "n"])

    narrow = seqs.select(*by, "tokens", "true_tags", "pred_tags")
    out = StructType([narrow.schema[c] for c in by])
    for c in ("grain", "k1", "k2"):
        out.add(c, StringType())
    found = narrow.mapInArrow(counted, out.add("n", LongType()))
    # Never NULL, which spares the branches that read them filters that differ.
    keys = [F.coalesce(c, F.lit("")).alias(c) for c in ("grain", "k1", "k2")]
    return found.select(*by, *keys, "n").groupBy(*by, "grain", "k1", "k2").agg(F.expr("coalesce(sum(n), 0L) AS n"))
