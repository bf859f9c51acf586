"""Long tables in pieces: what an Arrow batch holds of one block of a record travels as one row.

A row per token costs a shuffle its key, its place and its strings over and over. A piece has the key
once; positions are differences, and a string is a number into the piece's own distinct strings.
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
from pyspark.sql.types import StructField, StructType

#: Tokens worked on at once, and rows of a batch that is given back, about.
PIECE_TOKENS = 200_000
OUT_ROWS = 50_000

# Tasks get this module's code with the query, so that executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _ints(values: pa.Array) -> np.ndarray:
    return pc.fill_null(values, 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _codes(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Numbers into the distinct values; NULL is one of them."""
    encoded = values.dictionary_encode(null_encoding="encode")
    return encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), encoded.dictionary


def _narrow(values: np.ndarray, starts: np.ndarray) -> tuple[pa.Array, int]:
    """Numbers from nought as bytes, a value a piece, in the least width that holds them all."""
    kind = np.dtype(np.min_scalar_type(values.max(initial=0)))
    ends = (np.append(starts, len(values)) * kind.itemsize).astype(np.int32)
    data = np.ascontiguousarray(values.astype(kind))
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(data)]), kind.itemsize


def _wide(blobs: pa.Array, widths: np.ndarray, n: np.ndarray) -> np.ndarray:
    """What `_narrow` has packed, of pieces that may differ in width."""
    parts = [
        np.frombuffer(blob, f"u{width}", count)
        for blob, width, count in zip(blobs.to_pylist(), widths.tolist(), n.tolist(), strict=True)
    ]
    return np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)


def schema(long: DataFrame, strings: Sequence[str]) -> StructType:
    """Of the pieces: key, number of tokens, positions, and each string column twice."""
    own = "".join(f", {s}_words array<string>, {s}_codes binary" for s in strings)
    rest = "block bigint, n int, placed boolean, first bigint, steps binary, widths array<int>" + own
    return StructType([StructField("record_id", long.schema["record_id"].dataType), *StructType.fromDDL(rest)])


def packed(long: DataFrame, block: int, strings: Sequence[str]) -> DataFrame:
    """The pieces of `(record_id, pos, *strings)`, with blocks of `block` positions.

    A piece has rows of one record and block, in the order of their positions if the table had them
    so; rows of other records may lie between them. Rows without a position are pieces of their own.
    """
    rows = long.selectExpr("record_id", "CAST(pos AS BIGINT) AS pos", *strings)
    out = schema(long, strings)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _pieces(batch, block, strings, out.fieldNames())

    return rows.mapInArrow(run, out)


def _pieces(batch: pa.RecordBatch, block: int, strings: Sequence[str], names: list[str]) -> pa.RecordBatch:
    record, _ = _codes(batch.column(0))
    blocks = pa.array(_ints(batch.column(1)) // block, mask=batch.column(1).is_null().to_numpy(zero_copy_only=False))
    inside, _ = _codes(blocks)
    key = record * (inside.max() + 1) + inside
    if np.count_nonzero(np.diff(key)) >= len(pc.unique(pa.array(key))):  # a key that comes back
        order = np.argsort(key, kind="stable")
        batch, blocks, key = batch.take(pa.array(order)), blocks.take(pa.array(order)), key[order]
    starts = np.append(0, np.flatnonzero(np.diff(key)) + 1)
    n = np.diff(np.append(starts, len(key)))
    piece = np.repeat(np.arange(len(starts)), n)
    pos = _ints(batch.column(1))
    # Steps may go back: they are folded to numbers from nought, and the first is none.
    steps = np.append(0, np.diff(pos))
    steps[starts] = 0
    steps_blob, width = _narrow(steps << 1 ^ steps >> 63, starts)
    widths, columns = [width], []
    for s in range(len(strings)):
        code, words = _codes(batch.column(2 + s))
        # In the order they come, which is piece by piece.
        local, distinct = _codes(pa.array(piece * len(words) + code))
        distinct = distinct.to_numpy()
        ends = np.searchsorted(distinct // len(words), np.arange(len(starts) + 1))
        blob, width = _narrow(local - ends[piece], starts)
        widths.append(width)
        own = words.take(pa.array(distinct % len(words)))
        columns += [pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), own), blob]
    firsts = pa.array(starts)
    head = [batch.column(0).take(firsts), blocks.take(firsts), pa.array(n, pa.int32())]
    head += [blocks.is_valid().take(firsts), pa.array(pos[starts], pa.int64()), steps_blob]
    all_widths = pa.array(np.tile(widths, len(starts)).astype(np.int32))
    head.append(pa.ListArray.from_arrays(pa.array(np.arange(len(starts) + 1, dtype=np.int32) * len(widths)), all_widths))
    return pa.RecordBatch.from_arrays(head + columns, names)


class _Tokens:
    """Pieces taken apart: the piece, the position and the strings of every token."""

    def __init__(self, fields: dict[str, pa.Array], strings: Sequence[str]):
        n = _ints(fields["n"])
        self.n = n
        self.piece = np.repeat(np.arange(len(n)), n)
        widths = _ints(fields["widths"].flatten()).reshape(len(n), -1)
        folded = _wide(fields["steps"], widths[:, 0], n)
        steps = folded >> 1 ^ -(folded & 1)
        run = np.cumsum(steps)
        starts = np.cumsum(n) - n
        self.pos = run + np.repeat(_ints(fields["first"]) - run[starts], n)
        self.words: dict[str, pa.Array] = {}
        for i, s in enumerate(strings):
            words = fields[f"{s}_words"]
            sizes = _ints(pc.list_value_length(words))
            code = _wide(fields[f"{s}_codes"], widths[:, i + 1], n)
            self.words[s] = words.flatten().take(pa.array(code + np.repeat(np.cumsum(sizes) - sizes, n)))


# --- two tables side by side -------------------------------------------------------------


class _Held:
    """The right side's tokens that may still meet others, by group and position."""

    def __init__(self):
        self.key, self.met = np.zeros(0, np.int64), np.zeros(0, bool)
        self.row, self.pos, self.placed = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        self.ids, self.tags = None, None

    def add(self, key, row, pos, placed, ids: pa.Array, tags: pa.Array) -> None:
        """Tokens whose keys are not below those held; `row` says which of `ids` is theirs."""
        before = 0 if self.ids is None else len(self.ids)
        self.ids = ids if self.ids is None else pa.concat_arrays([self.ids, ids])
        tags = tags if self.tags is None else pa.concat_arrays([self.tags, tags])
        key = np.append(self.key, key)
        order = np.argsort(key, kind="stable")
        self.key, self.tags = key[order], tags.take(pa.array(order))
        self.row = np.append(self.row, row + before)[order]
        self.pos, self.placed = np.append(self.pos, pos)[order], np.append(self.placed, placed)[order]
        self.met = np.append(self.met, np.zeros(len(row), bool))[order]

    def drop(self, below: int) -> None:
        """Forgets what cannot meet others any more."""
        at = int(np.searchsorted(self.key, below))
        rows, self.row = np.unique(self.row[at:], return_inverse=True)
        self.key, self.met = self.key[at:].copy(), self.met[at:].copy()
        self.pos, self.placed = self.pos[at:].copy(), self.placed[at:].copy()
        if self.ids is not None:
            self.ids = self.ids.take(pa.array(rows))
            self.tags = self.tags.take(pa.array(np.arange(at, len(self.tags))))


def _slices(total: int) -> Iterator[tuple[int, int]]:
    for start in range(0, total, OUT_ROWS):
        yield start, min(start + OUT_ROWS, total)


def paired(true: DataFrame, pred: DataFrame, block: int = 4096) -> DataFrame:
    """Full outer join of `(record_id, pos, token, tag)` with `(record_id, pos, tag)` on both keys, NULLs
    being equal: `(record_id, pos, token, true_tag, pred_tag)`.

    Both sides are shuffled in pieces. A task reads its blocks in order, the right side's pieces
    first, and holds those of one block; the left side's are worked on as they come, however often a
    record repeats, and rows are given back in small batches.
    """
    keys = true.select("record_id", "pos").union(pred.select("record_id", "pos")).schema
    kinds = {f.name: f.dataType.simpleString() for f in keys}
    place = "CAST(pos AS BIGINT) AS pos"
    same_id = f"CAST(record_id AS {kinds['record_id']}) AS record_id"
    left = packed(true.selectExpr(same_id, place, "token", "tag"), block, ["token", "tag"])
    right = packed(pred.selectExpr(same_id, place, "tag"), block, ["tag"])
    both = left.withColumn("side", F.lit(1)).unionByName(right.withColumn("side", F.lit(0)), allowMissingColumns=True)
    dealt = both.repartition("record_id", "block").sortWithinPartitions("record_id", "block", "side")
    names = dealt.columns

    def rows(ids: pa.Array, pos, placed, token: pa.Array, tag: pa.Array, other: pa.Array) -> pa.RecordBatch:
        columns = [ids, pa.array(pos, pa.int64(), mask=~placed), token, tag, other]
        return pa.RecordBatch.from_arrays(columns, ["record_id", "pos", "token", "true_tag", "pred_tag"])

    def lonely(held: _Held, below: int | None) -> Iterator[pa.RecordBatch]:
        end = len(held.key) if below is None else int(np.searchsorted(held.key, below))
        left_over = np.flatnonzero(~held.met[:end])
        for start, stop in _slices(len(left_over)):
            at = left_over[start:stop]
            none = pa.nulls(len(at), pa.string())
            yield rows(held.ids.take(pa.array(held.row[at])), held.pos[at], held.placed[at], none, none, held.tags.take(pa.array(at)))

    def meet(held: _Held, key, found: _Tokens, ids: pa.Array, placed) -> Iterator[pa.RecordBatch]:
        low, high = np.searchsorted(held.key, key), np.searchsorted(held.key, key, side="right")
        edges = np.bincount(low, minlength=len(held.key) + 1) - np.bincount(high, minlength=len(held.key) + 1)
        held.met |= np.cumsum(edges)[: len(held.key)] > 0
        times = np.maximum(high - low, 1)
        ends = np.cumsum(times)
        tags = pa.nulls(0, pa.string()) if held.tags is None else held.tags
        for start, stop in _slices(int(ends[-1]) if len(ends) else 0):
            k = np.arange(start, stop)
            mine = np.searchsorted(ends, k, side="right")
            theirs = low[mine] + k - (ends[mine] - times[mine])
            lacking = (high == low)[mine]
            at = pa.array(mine)
            other = tags.take(pa.array(np.where(lacking, 0, theirs), mask=lacking))
            yield rows(
                ids.take(pa.array(found.piece[mine])), found.pos[mine], placed[found.piece[mine]],
                found.words["token"].take(at), found.words["tag"].take(at), other,
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, group, last = _Held(), 0, None
        for batch in batches:
            sizes = np.cumsum(_ints(batch.column(names.index("n"))))
            start = 0
            while start < batch.num_rows:
                done = sizes[start - 1] if start else 0
                stop = max(int(np.searchsorted(sizes, done + PIECE_TOKENS, side="right")), start + 1)
                part = batch.slice(start, stop - start)
                start = stop
                # Copied, as a slice's parts would be the whole batch's.
                fields = dict(zip(names, part.take(pa.array(range(part.num_rows))).columns, strict=True))
                key = [fields["record_id"], fields["block"]]
                if last is not None:
                    key = [pa.concat_arrays([before, k]) for before, k in zip(last, key, strict=True)]
                new = np.zeros(len(key[0]), bool)
                for k in key:
                    new[1:] |= np.diff(_codes(k)[0]) != 0
                groups = group + np.cumsum(new[-part.num_rows :])
                last, group = [k.slice(len(k) - 1) for k in key], int(groups[-1])
                theirs = fields["side"].to_numpy(zero_copy_only=False) == 0
                for side in (True, False):
                    at = np.flatnonzero(theirs == side)
                    if not len(at):
                        continue
                    mine = {c: v.take(pa.array(at)) for c, v in fields.items()}
                    found = _Tokens(mine, ["tag"] if side else ["token", "tag"])
                    placed = mine["placed"].to_numpy(zero_copy_only=False)
                    within = found.pos - (_ints(mine["first"]) // block * block)[found.piece]
                    place = groups[at][found.piece] * block + within
                    if side:
                        held.add(place, found.piece, found.pos, placed[found.piece], mine["record_id"], found.words["tag"])
                    else:
                        yield from meet(held, place, found, mine["record_id"], placed)
                yield from lonely(held, group * block)
                held.drop(group * block)
        yield from lonely(held, None)

    out = f"record_id {kinds['record_id']}, pos bigint, token string, true_tag string, pred_tag string"
    found = dealt.mapInArrow(run, out)
    return found.withColumn("pos", F.col("pos").cast(kinds["pos"])) if kinds["pos"] != "bigint" else found
