"""Operator 2: token ids of a corpus in files of range-coded blocks.

Documents in ascending order of their ids become one stream of token ids, a part of it for each
task and so for each file. A file's rows are blocks: the record of the range coder, which
stands for itself, and the documents that begin in it with their lengths. Parts are named by
their place in the stream, and a part's place follows from the sizes of those before it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from titlespan.llm.common import documents, two_columns
from titlespan.llm.range_coder import BLOCK, Coder
from titlespan.llm.words import default_path, packed, word_ids
from titlespan.session import new_path

END_ID = 2
#: Ids of the vocabulary are below this.
LIMIT = 49_408
#: Blocks that are coded in step with each other, as far as there are as many; up to a half more.
WAVE = 1536
#: Bytes of text a task of `write_files` gets: some `WAVE` blocks, as a step costs much the same for fewer.
PART_BYTES = 36 << 20


def _waves(blocks: int) -> list[int]:
    """Sizes of the waves that `blocks` blocks are coded in: even ones, as near to `WAVE` as can be."""
    waves = max(1, (2 * blocks + WAVE) // (2 * WAVE))
    return [(i + 1) * blocks // waves - i * blocks // waves for i in range(waves)]


class _Blocks:
    """A part's blocks from its documents, a wave at a time."""

    def __init__(self, part: int, coder: Coder, kind: pa.DataType):
        self.part, self.coder, self.kind = part, coder, kind
        self.ids: list[bytes] = []
        self.held = self.done = 0
        self.docs: list[tuple] = []  # place in the part, id, length

    def add(self, doc_id, ids: bytes) -> Iterator[pa.RecordBatch]:
        self.docs.append((self.done + self.held, doc_id, len(ids) // 4))
        self.ids.append(ids)
        self.held += len(ids) // 4
        if self.held >= 2 * WAVE * BLOCK:
            yield from self.flush(last=False)

    def flush(self, last: bool) -> Iterator[pa.RecordBatch]:
        """All blocks; or whole waves, so that enough is left for another one."""
        data = np.frombuffer(b"".join(self.ids), "<u4")
        self.ids = []
        waves = _waves(-(-len(data) // BLOCK)) if last else [WAVE] * (len(data) // (WAVE * BLOCK) - 1)
        at = 0
        for wave in waves:
            now = data[at : at + wave * BLOCK]
            yield self._rows(self.coder.encode(now), now)
            at += len(now)
        self.ids, self.held = [data[at:].tobytes()], len(data) - at

    def _rows(self, records: list[bytes], ids: np.ndarray) -> pa.RecordBatch:
        first = self.done // BLOCK
        self.done += len(ids)
        here = [[] for _ in records]
        rest = []
        for doc in self.docs:
            place = doc[0] // BLOCK - first
            (here[place] if place < len(here) else rest).append(doc)
        self.docs = rest
        columns = [
            pa.array([self.part] * len(records), pa.int32()),
            pa.array(range(first, first + len(records)), pa.int64()),
            pa.array([min(BLOCK, len(ids) - i * BLOCK) for i in range(len(records))], pa.int32()),
            pa.array([[d[1] for d in docs] for docs in here], pa.list_(self.kind)),
            pa.array([[d[2] for d in docs] for docs in here], pa.list_(pa.int64())),
            pa.array(records, pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(
            columns, ["part", "block", "n_ids", "doc_ids", "doc_tokens", "record"]
        )


def write_files(
    docs: DataFrame,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    end_id: int = END_ID,
    limit: int = LIMIT,
) -> None:
    """Writes the ids of every whole text, each followed by `end_id`, to `folder`.

    Null, empty and white texts are the end id alone; null document ids come first; rows that
    repeat an id are in the order of their texts; texts of any length are coded whole; an empty
    table writes files without blocks. The folder must not exist. One shuffle of the
    texts sorts them by as many ranges of ids as their size asks for; lost tasks are repeated and files commit as a whole.
    """
    path = path or default_path()
    narrow = two_columns(docs, id_col, text_col)
    kind = narrow.schema["doc_id"].dataType.simpleString()
    end = packed([end_id])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = None
        for batch in batches:
            if blocks is None:
                part = TaskContext.get().partitionId()
                blocks = _Blocks(part, Coder(limit), batch.column(0).type)
            work = word_ids(path).ids
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                yield from blocks.add(doc_id, work(text.as_py()) + end)
        if blocks is not None and blocks.held:
            yield from blocks.flush(last=True)

    size = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = size // PART_BYTES + 1
    ordered = narrow.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    rows = ordered.mapInArrow(
        run,
        f"part int, block long, n_ids int, doc_ids array<{kind}>, doc_tokens array<long>, record binary",
    )
    # The records are as small as they get.
    rows.write.option("compression", "none").parquet(folder)


class _Documents:
    """Documents from the blocks of one part after another, a wave at a time."""

    def __init__(self, coder: Coder, with_ids: bool):
        self.coder, self.with_ids = coder, with_ids
        self.wave: list[tuple] = []
        self.part, self.place = None, 0
        self.docs: list[tuple] = []
        self.ids: list[np.ndarray] = []
        self.held = 0

    def flush(self, kind: pa.DataType, size: int) -> pa.RecordBatch:
        """The documents that end in the next `size` blocks."""
        rows: list[tuple] = []
        wave, self.wave = self.wave[:size], self.wave[size:]
        for block, ids in zip(wave, self.coder.decode([b[4] for b in wave]), strict=True):
            part, doc_ids, doc_tokens, n_ids, _ = block
            if part != self.part:
                self._closed()
                self.part, self.place = part, 0
            if len(ids) != n_ids:
                raise ValueError("a block has not the length that its row says")
            self.docs += zip(doc_ids, doc_tokens, strict=True)
            self.ids.append(ids)
            self.held += len(ids)
            if self.docs and self.held >= self.docs[0][1]:
                rows += self._taken()
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
        kinds = [kind, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            ["doc_id", "part", "place", "n_tokens", "ids_crc32", "ids"],
        )

    def _taken(self) -> Iterator[tuple]:
        data = np.concatenate(self.ids).astype("<u4").tobytes()
        at, used = 0, 0
        for doc_id, tokens in self.docs:
            if at + 4 * tokens > len(data):
                break
            own = data[at : at + 4 * tokens]
            yield doc_id, self.part, self.place, tokens, zlib.crc32(own), own if self.with_ids else None
            self.place += tokens
            at += 4 * tokens
            used += 1
        self.docs = self.docs[used:]
        self.ids = [np.frombuffer(data, "<u4", offset=at)]
        self.held = len(self.ids[0])

    def _closed(self) -> None:
        if self.docs or self.held:
            raise ValueError(f"part {self.part} does not end with a document")


def read_files(
    spark: SparkSession, folder: str, limit: int = LIMIT, with_ids: bool = True
) -> DataFrame:
    """`(doc_id, start, n_tokens, ids_crc32, ids)` from files of `write_files`.

    `start`: ids of all documents before; `ids`: little-endian unsigned 32-bit integers with the
    end id, null without `with_ids`. Every block's checksum is tested. A part is read by one
    task in portions; a document is held as a whole.
    """
    rows = spark.read.parquet(folder)
    kind = rows.schema["doc_ids"].dataType.elementType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, arrow_kind = _Documents(Coder(limit), with_ids), None
        for batch in batches:
            arrow_kind = batch.column("doc_ids").type.value_type
            columns = ("part", "doc_ids", "doc_tokens", "n_ids", "record")
            for row in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
                reader.wave.append(row)
                if len(reader.wave) >= 2 * WAVE:
                    yield reader.flush(arrow_kind, WAVE)
        for size in _waves(len(reader.wave)) if reader.wave else []:
            yield reader.flush(arrow_kind, size)
        reader._closed()

    found = (
        rows.repartition("part")
        .sortWithinPartitions("part", "block")
        .mapInArrow(
            run,
            f"doc_id {kind.simpleString()}, part int, place long, n_tokens long, ids_crc32 long, ids binary",
        )
    )
    # A row for each file: as many as the writing tasks.
    sizes = rows.groupBy("part").agg(F.sum("n_ids").alias("size"))
    before = F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("part", F.coalesce(before, F.lit(0)).alias("offset"))
    return found.join(offsets, "part").select(
        "doc_id", (F.col("offset") + F.col("place")).alias("start"), "n_tokens", "ids_crc32", "ids"
    )


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "token-files")
    write_files(documents(spark, sf_dir), folder)
    return read_files(spark, folder, with_ids=False).drop("ids")
