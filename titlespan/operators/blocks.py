"""Records in compressed values: long arrays are shuffled and written in a few bytes a token.

A row of a shuffle has eight bytes and more for each entry of an array, besides its text. Here some
records are one value: their strings one after the other, lengths and codes as narrow as they can
be, compressed as a whole. `by_id` is a join by such values.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

#: Tokens a task deals out by their records' ids at once, about.
DEALT_TOKENS = 500_000
#: An array of strings is written as codes if it has no more different ones than a byte can tell apart.
_CODES, _LOOK = 256, 1000

# Tasks get this module's code with the query, so that executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def spare() -> None:
    """Gives freed memory back, which a worker that is kept for other tasks would hold otherwise."""
    pa.default_memory_pool().release_unused()
    if hasattr(trim := ctypes.CDLL(None), "malloc_trim"):
        trim.malloc_trim(0)


# --- values ------------------------------------------------------------------------------


def squeezed(parts: Sequence[np.ndarray]) -> bytes:
    """Numbers from nought (or their bytes) as one compressed value."""
    narrow = [np.ascontiguousarray(p.astype(np.min_scalar_type(p.max(initial=0)))) for p in parts]
    head = np.array([len(parts), *(x for p in narrow for x in (p.itemsize, p.nbytes))], np.uint32)
    raw = b"".join([head.tobytes(), *(p.tobytes() for p in narrow)])
    return len(raw).to_bytes(4, "little") + pa.Codec("zstd", compression_level=3).compress(raw, asbytes=True)


def opened(value: bytes) -> list[np.ndarray]:
    raw = pa.Codec("zstd").decompress(value[4:], int.from_bytes(value[:4], "little"), asbytes=True)
    count = int.from_bytes(raw[:4], "little")
    head = np.frombuffer(raw, np.uint32, 2 * count, 4).reshape(-1, 2).tolist()
    parts, at = [], 4 + 8 * count
    for width, size in head:
        parts.append(np.frombuffer(raw, f"u{width}", size // width, at))
        at += size
    return parts


def _known(values: pa.Array) -> np.ndarray:
    """Bits of what is not NULL, none if nothing is."""
    if not values.null_count:
        return np.zeros(0, np.uint8)
    return np.packbits(values.is_valid().to_numpy(zero_copy_only=False))


def _unknown(bits: np.ndarray, n: int) -> np.ndarray | None:
    return np.unpackbits(bits, count=n) == 0 if len(bits) else None


def strings(values: pa.Array) -> list[np.ndarray]:
    """Three parts for an array of strings."""
    texts = values.cast(pa.binary())
    known = _known(texts)
    if texts.null_count:
        texts = pc.fill_null(texts, b"")
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, np.int32, len(texts) + 1, 4 * texts.offset) if len(texts) else np.zeros(1, np.int32)
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]
    return [known, np.diff(ends), data]


def strings_from(parts: Sequence[np.ndarray]) -> pa.Array:
    known, lengths, data = parts
    ends = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=ends[1:])
    valid = None
    if (unknown := _unknown(known, len(lengths))) is not None:
        valid = pa.py_buffer(np.packbits(~unknown, bitorder="little"))
    return pa.Array.from_buffers(pa.string(), len(lengths), [valid, pa.py_buffer(ends), pa.py_buffer(data)])


def _lists(values: pa.Array) -> list[np.ndarray]:
    """Six parts for an array of lists of strings."""
    lengths = pc.fill_null(pc.list_value_length(values), 0).to_numpy(zero_copy_only=False)
    flat = values.flatten().cast(pa.string())
    codes = np.zeros(0, np.uint8)
    if len(flat) and len(flat.slice(0, _LOOK).unique()) < _CODES and len(flat.unique()) < _CODES:
        encoded = flat.dictionary_encode(null_encoding="encode")
        codes, flat = encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary
    return [_known(values), lengths, codes, *strings(flat)]


def _lists_from(parts: Sequence[np.ndarray]) -> pa.Array:
    known, lengths, codes, *own = parts
    flat = strings_from(own)
    if len(codes):
        flat = flat.take(pa.array(codes))
    ends = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=ends[1:])
    unknown = _unknown(known, len(lengths))
    offsets = pa.array(ends) if unknown is None else pa.array(ends, mask=np.append(unknown, False))
    return pa.ListArray.from_arrays(offsets, flat)


class Shape:
    """Which columns of a table are arrays of strings; the others are kept as Arrow writes them."""

    def __init__(self, schema: StructType):
        self.names = schema.fieldNames()
        kinds = [f.dataType for f in schema]
        self.lists = [i for i, t in enumerate(kinds) if isinstance(t, ArrayType) and isinstance(t.elementType, StringType)]
        self.rest = [i for i in range(len(kinds)) if i not in self.lists]

    def value(self, records: pa.RecordBatch) -> bytes:
        others = [records.column(i) for i in self.rest]
        batch = pa.RecordBatch.from_arrays(others, [self.names[i] for i in self.rest])
        # Copied, as a slice would be written with the whole batch's buffers.
        whole = pa.Table.from_batches([batch]).take(pa.array(range(batch.num_rows), pa.int64()))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, whole.schema) as writer:
            writer.write_table(whole)
        parts = [np.frombuffer(sink.getvalue(), np.uint8)]
        for i in self.lists:
            parts += _lists(records.column(i))
        return squeezed(parts)

    def records(self, value: bytes) -> pa.RecordBatch:
        parts = opened(value)
        table = pa.ipc.open_stream(parts[0].tobytes()).read_all().combine_chunks()
        columns = {i: c.chunk(0) if c.num_chunks else pa.array([], c.type) for i, c in zip(self.rest, table.columns, strict=True)}
        columns |= {i: _lists_from(parts[1 + 6 * k : 7 + 6 * k]) for k, i in enumerate(self.lists)}
        return pa.RecordBatch.from_arrays([columns[i] for i in range(len(self.names))], self.names)

    def list_of(self, value: bytes, at: int) -> pa.Array:
        """One of the arrays of strings alone."""
        k = self.lists.index(at)
        return _lists_from(opened(value)[1 + 6 * k : 7 + 6 * k])


def runs(lists: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Start and number of records, so that runs have few enough tokens."""
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    start, held_tokens = 0, 0
    for i, n in enumerate(lengths):
        if i > start and held_tokens + n > most:
            yield start, i - start
            start, held_tokens = i, 0
        held_tokens += int(n)
    if len(lengths) > start:
        yield start, len(lengths) - start


def together(batches: Iterator[pa.RecordBatch], at: int, most: int) -> Iterator[pa.RecordBatch]:
    """The records in batches of half of `most` to `most` entries of the list in column `at`, about; a
    record is not split, and what a batch has in one piece is not copied."""
    held, n = [], 0
    for batch in batches:
        for start, count in runs(batch.column(at), most):
            some = batch.slice(start, count)
            tokens = pc.sum(pc.list_value_length(some.column(at))).as_py() or 0
            if held and n + tokens > most:
                yield one_batch(held)
                held, n = [], 0
            held, n = [*held, some], n + tokens
            if n >= most // 2:
                yield one_batch(held)
                held, n = [], 0
                spare()
    if held:
        yield one_batch(held)
    spare()


def one_batch(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(batches) == 1:
        return batches[0]
    table = pa.Table.from_batches(batches)
    columns = [pa.concat_arrays(c.chunks) for c in table.columns]
    return pa.RecordBatch.from_arrays(columns, table.column_names)


# --- tables ------------------------------------------------------------------------------


def by_id(records: DataFrame, found: DataFrame, column: str) -> DataFrame:
    """`records` with the integer `column` of `(record_id, column)`, which has every id once; NULL is an id.

    Both are dealt out by a hash of the id, the records in compressed values. A task has the ids of
    one part at a time, and its records a value at a time, however often an id repeats.
    """
    schema = records.schema.toNullable()
    shape, at = Shape(schema), schema.fieldNames().index("tokens")
    id_at = schema.fieldNames().index("record_id")
    id_type = schema["record_id"].dataType
    parts = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64("record_id"), F.lit(parts)).cast("int").alias("_part")
    dealt_schema = StructType().add("_part", "integer").add("side", "integer").add("record_id", id_type).add(column, "integer").add("records", "binary")
    names = dealt_schema.fieldNames()

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in together(batches, at, DEALT_TOKENS):
            place = some.column(len(shape.names)).to_numpy(zero_copy_only=False)
            order = np.argsort(place, kind="stable")
            starts = np.append(0, np.flatnonzero(np.diff(place[order])) + 1)
            for mine in np.split(order, starts[1:]):
                rows = some.select(shape.names).take(pa.array(mine))
                row = [pa.array([int(place[mine[0]])], pa.int32()), pa.array([1], pa.int32())]
                row += [pa.nulls(1, rows.column(id_at).type), pa.nulls(1, pa.int32()), pa.array([shape.value(rows)], pa.binary())]
                yield pa.RecordBatch.from_arrays(row, names)

    left = records.select("*", part).mapInArrow(deal, dealt_schema)
    right = found.select(
        part, F.lit(0).alias("side"), "record_id", F.col(column).cast("int").alias(column), F.lit(None).cast("binary").alias("records")
    )
    both = right.union(left).repartition("_part").sortWithinPartitions("_part", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, values = None, [], []
        for batch in batches:
            place = batch.column(0).to_numpy(zero_copy_only=False)
            side = batch.column(1).to_numpy(zero_copy_only=False)
            starts = np.append(0, np.flatnonzero((np.diff(place) != 0) | (np.diff(side) != 0)) + 1)
            for start, stop in zip(starts.tolist(), [*starts[1:].tolist(), len(place)], strict=True):
                if place[start] != now:
                    now, ids, values = place[start], [], []
                some = batch.slice(start, stop - start)
                if side[start] == 0:
                    ids.append(some.column(2))
                    values.append(some.column(3))
                    continue
                ids, values = [pa.concat_arrays(ids)], [pa.concat_arrays(values)]
                for value in some.column(4):
                    mine = shape.records(value.as_py())
                    where = pc.index_in(mine.column(id_at), value_set=ids[0])
                    if where.null_count:
                        raise ValueError("a record's id is not in the other table")
                    yield pa.RecordBatch.from_arrays([*mine.columns, values[0].take(where)], [*shape.names, column])
            spare()

    return both.mapInArrow(run, StructType([*schema.fields, StructField(column, IntegerType())]))
