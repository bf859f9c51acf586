"""Operator 1: bounded-space online packing of token ids into windows.

Every partition keeps a fixed number of open windows. A document's ids are cut into full
windows and a rest; the rest goes to the open window it fits best; when it fits none, the
fullest is emitted and a new one opened. What is open at a partition's end carries its ids, is
written, and merged: groups of partitions fill windows to the last place (a piece is cut there
if need be) and leave one open window a group, again and again until there is one group.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titlespan.llm.common import documents, two_columns, written
from titlespan.llm.words import default_path, packed, word_ids

WINDOW = 2048
OPEN_WINDOWS = 64
END_ID = 1
#: Partitions, and then groups, that one merging task takes: 32 x 64 windows of 8 KB at most.
FAN_IN = 32
#: A window's id: level of merging, partition or group, running number.
LEVEL_BITS, PART_BITS = 56, 28

PIECE_COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


@dataclass(order=True)
class Window:
    room: int
    number: int
    pieces: list[tuple] = field(compare=False, default_factory=list)

    def put(self, piece: tuple) -> None:
        """`piece`: document, start, its ids, ids of the document."""
        self.pieces.append(piece)
        self.room -= len(piece[2]) // 4


class OpenWindows:
    """The open windows of one partition, ordered by room."""

    def __init__(self, window: int, most: int, base: int):
        self.window, self.most, self.next, self.windows = window, most, base, []

    def new(self) -> Window:
        self.next += 1
        return Window(self.window, self.next - 1)

    def place(self, doc_id, ids: bytes) -> Iterator[Window]:
        """Places a document; yields the windows that this closes."""
        total, start = len(ids) // 4, 0
        while total - start >= self.window:
            full = self.new()
            full.put((doc_id, start, ids[4 * start : 4 * (start + self.window)], total))
            start += self.window
            yield full
        if start == total:
            return
        rest = total - start
        at = bisect_left(self.windows, Window(rest, -1))
        if at < len(self.windows):
            best = self.windows.pop(at)
        else:
            if len(self.windows) >= self.most:
                yield self.windows.pop(0)
            best = self.new()
        best.put((doc_id, start, ids[4 * start :], total))
        if best.room:
            insort(self.windows, best)
        else:
            yield best


def _rows(windows: list[Window], kind: pa.DataType, with_ids: bool, part: int, more: bool):
    """The pieces of windows as a batch; `part` names the partition of windows still open."""
    cells = []
    for window in windows:
        offset = 0
        for doc_id, start, ids, total in window.pieces:
            length = len(ids) // 4
            crc = zlib.crc32(ids)
            cells.append(
                (doc_id, start, length, crc, total, window.number, offset, ids if with_ids else None)
            )
            offset += length
    columns = list(zip(*cells, strict=True)) if cells else [[]] * 8
    arrays = [pa.array(columns[0], kind)]
    arrays += [pa.array(c, pa.int64()) for c in columns[1:7]]
    arrays.append(pa.array(columns[7], pa.binary()))
    arrays.append(pa.array([part if more else None] * len(cells), pa.int64()))
    return pa.RecordBatch.from_arrays(arrays, [*PIECE_COLUMNS, "ids", "open_part"])


def _schema(kind: str) -> str:
    longs = ", ".join(f"{c} long" for c in PIECE_COLUMNS[1:])
    return f"doc_id {kind}, {longs}, ids binary, open_part long"


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    end_id: int = END_ID,
    window: int = WINDOW,
    open_windows: int = OPEN_WINDOWS,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: `doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids`.

    Every id of every document, the end id included, lies in one piece; a sequence's pieces
    follow each other without gaps from offset 0. Null, empty and white texts are the end id
    alone; null and repeated ids are documents like others; an empty table gives no rows. A long
    text fills windows of its own and is cut only there or where merging fills a window. There
    is no shuffle but that of the windows left open, whose number follows the partitions.
    """
    path = path or default_path()
    narrow = two_columns(docs, id_col, text_col)
    kind = narrow.schema["doc_id"].dataType.simpleString()
    end = packed([end_id])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = word_ids(path).ids
        part = TaskContext.get().partitionId()
        state = OpenWindows(window, open_windows, part << PART_BITS)
        arrow_kind = pa.null()
        for batch in batches:
            arrow_kind, closed = batch.column(0).type, []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                closed += state.place(doc_id, work(text.as_py()) + end)
                if len(closed) >= 256:
                    yield _rows(closed, arrow_kind, with_ids, part, False)
                    closed = []
            yield _rows(closed, arrow_kind, with_ids, part, False)
        if state.windows:
            yield _rows(state.windows, arrow_kind, True, part, True)

    # Written, as both what is closed and what is merged must come from one run of each task.
    table = written(narrow.mapInArrow(first, _schema(kind)), "packed")
    return merge_open(table, window, with_ids)


def merge_open(table: DataFrame, window: int = WINDOW, with_ids: bool = True) -> DataFrame:
    """Closes the windows that `table` marks as open; see `pack` for the columns."""
    kind = table.schema["doc_id"].dataType.simpleString()
    result = table.filter("open_part IS NULL").drop("open_part")
    left = table.filter("open_part IS NOT NULL")
    parts = (left.agg(F.max("open_part")).first()[0] or 0) + 1
    level = 0
    while True:
        level, parts = level + 1, -(-parts // FAN_IN)
        base, last = level << LEVEL_BITS, parts == 1

        def fill(pieces: pa.Table, base=base, last=last) -> pa.Table:
            group = pieces.column("open_part")[0].as_py()
            number, arrow_kind = base + (group << PART_BITS), pieces.schema.field("doc_id").type
            out, current = [], Window(window, number)
            for row in pieces.to_pylist():
                ids, start = row["ids"], row["start"]
                while ids:
                    now = ids[: 4 * current.room]
                    current.put((row["doc_id"], start, now, row["doc_tokens"]))
                    ids, start = ids[len(now) :], start + len(now) // 4
                    if not current.room:
                        out.append(current)
                        current = Window(window, current.number + 1)
            batches = [_rows(out, arrow_kind, with_ids, group, False)]
            if current.pieces:
                batches.append(_rows([current], arrow_kind, with_ids or not last, group, not last))
            return pa.Table.from_batches(batches)

        # Sorted as a partition left them: the pieces of a window stay neighbours.
        left = (
            left.withColumn("open_part", F.expr(f"open_part div {FAN_IN}"))
            .groupBy("open_part")
            .applyInArrow(_sorted(fill), _schema(kind))
        )
        if not last:
            left = written(left, "packed-open")
        result = result.unionByName(left.filter("open_part IS NULL").drop("open_part"))
        if last:
            return result if with_ids else result.drop("ids")
        left = left.filter("open_part IS NOT NULL")


def _sorted(fill):
    def run(pieces: pa.Table) -> pa.Table:
        return fill(pieces.sort_by([("sequence_id", "ascending"), ("offset", "ascending")]))

    return run


def sequences(pieces: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """`(sequence_id, length, doc_ids, starts, lengths, ids)` from the pieces of `pack`.

    `ids` are padded to the window with `pad_id`, but not where the length is a power of two.
    A sequence is one window, so its group is bounded.
    """
    ordered = pieces.groupBy("sequence_id").agg(
        F.sum("length").alias("length"),
        F.sort_array(F.collect_list(F.struct("offset", "doc_id", "start", "length", "ids"))).alias("p"),
    )
    filled = F.when(F.bit_count("length") == 1, F.col("length")).otherwise(F.lit(window))
    pad = F.expr(f"unhex('{packed([pad_id]).hex()}')")
    return ordered.select(
        "sequence_id",
        "length",
        F.expr("p.doc_id").alias("doc_ids"),
        F.expr("p.start").alias("starts"),
        F.expr("p.length").alias("lengths"),
        F.concat(
            F.expr("aggregate(p, CAST('' AS BINARY), (a, x) -> concat(a, x.ids))"),
            F.unhex(F.repeat(F.hex(pad), (filled - F.col("length")).cast("int"))),
        ).alias("ids"),
    )


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), with_ids=False)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pipeline's last stage: sequences with their ids as pieces."""
    return pack(docs)
