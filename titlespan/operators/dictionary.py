"""M3's lookup: a lexicon as arrays that tasks probe where the records are.

A `Dictionary` holds the tokens in the order of a checksum, and beside them, in arrays, the codes
of their tags and their confidences, one column per fold. It is broadcast once, and every Arrow
batch of records asks it for the batch's distinct tokens. `held` makes one of a lexicon that is
small enough; `in_blocks` is the way for larger ones: blocks of records ask by shuffle for their
distinct tokens only, and get the answers back as one array.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructType

from titlespan.operators.blocks import Shape, one_batch, opened, runs, spare, squeezed, strings, strings_from
from titlespan.session import written
from titlespan.types import OUTSIDE

#: Tokens of a block of records, and of one of the rows it is written as, about; a record is not split.
BLOCK_TOKENS = 300_000
ROW_TOKENS = 20_000
#: Entries of a lexicon that are asked together, about, and into how many parts it is dealt at least.
BUCKET_ENTRIES, LEAST_BUCKETS = 200_000, 16
#: Words looked up at once, about.
ASKED_WORDS = 100_000
#: Entries a task deals out at once, about.
DEALT_ENTRIES = 50_000
#: Bits of the map that keeps unknown tokens from being asked for: 16 MB at most.
SCREEN_BITS = 1 << 27

# Tasks get this module's code with the query, so that executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_FOUND = StructType().add("pred_tags", ArrayType(StringType())).add("confidence", ArrayType(DoubleType()))


def _marks(words: pa.Array) -> np.ndarray:
    texts = words.cast(pa.binary()).to_pylist()
    return np.fromiter(map(zlib.crc32, texts), np.uint32, len(texts))


def _lists(lengths: np.ndarray, values: pa.Array) -> pa.ListArray:
    ends = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), values)


class Dictionary:
    """Tokens, `codes[token, fold]` into `labels`, and `confidence[token, fold]`."""

    def __init__(self, marks, tokens: pa.Array, codes, confidence, labels: pa.Array):
        self.marks, self.tokens, self.codes, self.confidence, self.labels = marks, tokens, codes, confidence, labels

    @classmethod
    def of(cls, tokens: pa.Array, tags: pa.Array, confidence: pa.Array) -> Dictionary:
        """From a lexicon's columns; tags and confidences may be lists of one entry per fold.

        An entry without a tag, also in one fold, answers as a token that is not known.
        """
        folds = 1
        if pa.types.is_list(tags.type):
            folds = len(tags[0]) if len(tags) else 1
            tags, confidence = tags.flatten(), confidence.flatten()
        labels = pa.concat_arrays([pa.array([OUTSIDE]), pc.unique(tags.drop_null()).cast(pa.string())])
        codes = pc.fill_null(pc.index_in(tags.cast(pa.string()), value_set=labels), 0)
        codes = codes.to_numpy(zero_copy_only=False).astype(np.int32).reshape(-1, folds)
        shares = pc.fill_null(confidence, 1.0).to_numpy(zero_copy_only=False).reshape(-1, folds)
        marks = _marks(tokens)
        order = np.argsort(marks, kind="stable")
        return cls(marks[order], tokens.take(pa.array(order)), codes[order], shares[order], labels)

    @classmethod
    def merged(cls, parts: Sequence[Dictionary]) -> Dictionary:
        """Of dictionaries with the same folds; the first label of each is the one for no entry."""
        labels = pa.concat_arrays([p.labels for p in parts]).unique()
        codes = [pc.index_in(p.labels, value_set=labels).to_numpy(zero_copy_only=False)[p.codes] for p in parts]
        marks = np.concatenate([p.marks for p in parts])
        order = np.argsort(marks, kind="stable")
        tokens = pa.concat_arrays([p.tokens for p in parts]).take(pa.array(order))
        confidence = np.concatenate([p.confidence for p in parts])
        return cls(marks[order], tokens, np.concatenate(codes)[order], confidence[order], labels)

    def value(self, places: np.ndarray) -> bytes:
        """Some entries as one compressed value."""
        shares, where = np.unique(self.confidence[places], return_inverse=True)
        parts = [*strings(self.tokens.take(pa.array(places))), *strings(self.labels)]
        return squeezed([*parts, self.codes[places].ravel(), where.ravel(), shares.view(np.uint64)])

    @classmethod
    def from_value(cls, value: bytes) -> Dictionary:
        """What `value` made, with the entries in its order, so not to be asked before it is merged."""
        parts = opened(value)
        tokens, labels = strings_from(parts[:3]), strings_from(parts[3:6])
        shares = parts[8].astype(np.uint64).view(np.float64)[parts[7]].reshape(len(tokens), -1)
        return cls(_marks(tokens), tokens, parts[6].astype(np.int32).reshape(len(tokens), -1), shares, labels)

    def arrays(self) -> tuple:
        """What makes it up, without any class of this library."""
        return self.marks, self.tokens, self.codes, self.confidence, self.labels

    def find(self, words: pa.Array) -> np.ndarray:
        """The place of each word, -1 for unknown ones: by checksum, then by the word itself."""
        marks = _marks(words)
        at = np.searchsorted(self.marks, marks)
        places = np.full(len(words), -1, np.int64)
        left = np.arange(len(words))
        while len(left):
            inside = at[left] < len(self.marks)
            inside[inside] = self.marks[at[left[inside]]] == marks[left[inside]]
            left = left[inside]
            same = pc.equal(self.tokens.take(pa.array(at[left])), words.take(pa.array(left)))
            same = same.to_numpy(zero_copy_only=False)
            places[left[same]] = at[left[same]]
            left = left[~same]
            at[left] += 1
        return places

    def answers(self, lists: pa.Array, folds: np.ndarray | None = None) -> tuple[pa.Array, pa.Array]:
        """Tags and confidences for lists of tokens; unknown and null tokens are `O` with 1."""
        lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        asked = lists.flatten().dictionary_encode()
        places = np.append(self.find(asked.dictionary), -1)
        where = pc.fill_null(asked.indices, len(places) - 1).to_numpy(zero_copy_only=False)
        place = places[where]
        fold = 0 if folds is None else np.repeat(folds, lengths)
        known = place >= 0
        if not len(self.marks):
            codes, shares = np.zeros(len(place), np.int32), np.ones(len(place))
        else:
            codes = np.where(known, self.codes[place, fold], 0)
            shares = np.where(known, self.confidence[place, fold], 1.0)
        return _lists(lengths, self.labels.take(pa.array(codes))), _lists(lengths, pa.array(shares))


class Held:
    """A dictionary that the tasks have: broadcast once, usable in any number of queries.

    A worker process opens the broadcast arrays once and keeps them for its later tasks.
    """

    def __init__(self, shared: Broadcast):
        self.shared = shared

    def column(self, tokens: str, fold_col: str | None = None) -> Column:
        """`(pred_tags, confidence)` for the tokens, in the records' own task."""
        shared = self.shared

        def plain(lists: pa.Array) -> pa.Array:
            found = Dictionary(*shared.value).answers(lists)
            return pa.StructArray.from_arrays(found, ["pred_tags", "confidence"])

        def by_fold(lists: pa.Array, folds: pa.Array) -> pa.Array:
            found = Dictionary(*shared.value).answers(lists, folds.to_numpy(zero_copy_only=False))
            return pa.StructArray.from_arrays(found, ["pred_tags", "confidence"])

        if fold_col:
            return F.arrow_udf(by_fold, _FOUND)(tokens, fold_col)
        return F.arrow_udf(plain, _FOUND)(tokens)

    def release(self) -> None:
        """Gives the executors' memory back; the dictionary must not be asked again."""
        self.shared.destroy()


def _folds(lexicon: DataFrame) -> str:
    return "size(tag)" if isinstance(lexicon.schema["tag"].dataType, ArrayType) else "1"


def lexicon_bytes(lexicon: DataFrame) -> int:
    """Size of the lexicon as joined rows: its strings and an allowance per row and fold."""
    folds = _folds(lexicon)
    tags = "octet_length(tag) + 64" if folds == "1" else f"octet_length(array_join(tag, '')) + 64 + 48 * {folds}"
    return lexicon.agg(F.expr(f"coalesce(sum(octet_length(token) + {tags}), 0L) AS b")).first()["b"]


def dictionary_bytes(lexicon: DataFrame) -> int:
    """Size of the arrays: the token with its place and checksum, code and confidence per fold."""
    row = f"octet_length(token) + 8 + 12 * {_folds(lexicon)}"
    return lexicon.agg(F.expr(f"CAST(coalesce(sum({row}), 0) AS BIGINT) AS b")).first()["b"]


def held(lexicon: DataFrame, max_bytes: int) -> Held | None:
    """The lexicon as a broadcast dictionary, or None if it measures more than `max_bytes`."""
    entries = lexicon.select("token", "tag", "confidence").filter("token IS NOT NULL")
    if dictionary_bytes(entries) > max_bytes:
        return None
    table = entries.toArrow().combine_chunks()
    parts = [c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in table.columns]
    made = Dictionary.of(parts[0].cast(pa.string()), parts[1], parts[2])
    return Held(lexicon.sparkSession.sparkContext.broadcast(made.arrays()))


# --- lexicons beyond a broadcast -----------------------------------------------------------


def _screen(lexicon: DataFrame) -> tuple[np.ndarray, int]:
    """A bit for the checksum of every token, in a map of eight bits per token and a fixed size at
    most: what it does not know need not be asked for, what it knows may still be unknown. And the
    number of entries."""
    n = lexicon.count()
    bits = 1 << 15
    while bits < min(8 * n, SCREEN_BITS):
        bits <<= 1
    bit = F.crc32(F.col("token").cast("binary")) % bits + 1
    parts = (
        lexicon.filter("token IS NOT NULL")
        .select(bit.alias("bit"))
        .groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    )
    full = np.zeros(bits // 8, np.uint8)
    for part in parts.toLocalIterator():
        data = np.frombuffer(part["bits"], np.uint8)
        full[(part["bucket"] - 1) * len(data) :][: len(data)] = data
    return full, n


def _nullable(kind: pa.DataType) -> pa.DataType:
    """The type with parts that may be NULL, which is what a cogroup must return."""
    if pa.types.is_list(kind):
        return pa.list_(_nullable(kind.value_type))
    if pa.types.is_struct(kind):
        return pa.struct([pa.field(f.name, _nullable(f.type)) for f in kind])
    if pa.types.is_map(kind):
        return pa.map_(_nullable(kind.key_type), _nullable(kind.item_type))
    return kind


def _by_fold(batch: pa.RecordBatch, at: int | None) -> Iterator[tuple[int | None, pa.RecordBatch]]:
    """The records of each fold; all of them under 0 without folds."""
    if at is None:
        yield 0, batch
        return
    folds = batch.column(at)
    for fold in pc.unique(folds).to_pylist():
        yield fold, batch.filter(pc.is_in(folds, value_set=pa.array([fold], folds.type)))


def _screened(words: pa.Array, screen: np.ndarray) -> pa.Array:
    bit = _marks(words) % (8 * len(screen))
    return words.filter(pa.array(screen[bit >> 3] >> (bit & 7) & 1 == 1))


class Blocks:
    """Records of `schema`, written as `(block, row, fold, records)`: blocks of one fold, each some numbered
    rows of few tokens, as Parquet holds a hundred rows at least in memory."""

    def __init__(self, table: DataFrame, schema: StructType):
        self.table, self.schema = table, schema

    @classmethod
    def of(cls, records: DataFrame, name: str, fold_col: str | None = None, screen: Broadcast | None = None) -> Blocks:
        """All records have an array `tokens`; a block has those of one value of `fold_col`. With a screen,
        `asked` has the tokens of a row that it knows and that no earlier row of the block has."""
        schema = records.schema.toNullable()
        shape, at = Shape(schema), schema.fieldNames().index("tokens")
        fold_at = schema.fieldNames().index(fold_col) if fold_col else None
        names = ["block", "row", "fold", "records"] + ["asked"] * bool(screen)

        def made(block: int, fold: int | None, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            before = pa.array([], pa.string())
            for i, (start, n) in enumerate(runs(rows.column(at), ROW_TOKENS)):
                some = rows.slice(start, n)
                row = [pa.array([block], pa.int64()), pa.array([i], pa.int32()), pa.array([fold], pa.int32())]
                row.append(pa.array([shape.value(some)], pa.binary()))
                if screen:
                    words = pc.unique(some.column(at).flatten()).drop_null().cast(pa.string())
                    words = _screened(words.filter(pc.invert(pc.is_in(words, value_set=before))), np.frombuffer(screen.value, np.uint8))
                    before = pa.concat_arrays([before, words])
                    row.append(_lists(np.array([len(words)]), words))
                yield pa.RecordBatch.from_arrays(row, names)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            block = TaskContext.get().partitionId() << 32
            held: dict[int | None, tuple[list[pa.RecordBatch], int]] = {}
            for batch in batches:
                for fold, part in _by_fold(batch, fold_at):
                    for start, n in runs(part.column(at), BLOCK_TOKENS):
                        some = part.slice(start, n)
                        tokens = pc.sum(pc.list_value_length(some.column(at))).as_py() or 0
                        before, m = held.get(fold, ([], 0))
                        if before and m + tokens > BLOCK_TOKENS:
                            yield from made(block, fold, one_batch(before))
                            block, before, m = block + 1, [], 0
                            spare()
                        held[fold] = ([*before, some], m + tokens)
            for fold, (rows, _) in held.items():
                yield from made(block, fold, one_batch(rows))
                block += 1
            held.clear()
            spare()

        out = "block long, row int, fold int, records binary" + ", asked array<string>" * bool(screen)
        return cls(written(records.mapInArrow(run, out), name), schema)

    def filter(self, condition: Column) -> Blocks:
        """Some blocks, by their number or fold."""
        return Blocks(self.table.filter(condition), self.schema)

    def records(self) -> DataFrame:
        shape = Shape(self.schema)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for value in batch.column(0):
                    yield shape.records(value.as_py())
                spare()

        return self.table.select("records").mapInArrow(run, self.schema)

    @property
    def asked(self) -> str:
        """The column that says what a row asks for."""
        return "asked" if "asked" in self.table.columns else "records"


def _words_of(value: pa.Scalar, shape: Shape, at: int) -> pa.Array:
    """What a row asks for, by its `asked` or its records."""
    return shape.list_of(value.as_py(), at).flatten() if pa.types.is_binary(value.type) else value.values.cast(pa.string())


def _asked_words(lists: Sequence[pa.Array], screen: np.ndarray, buckets: int) -> tuple[pa.Array, np.ndarray]:
    """The distinct strings that the screen knows, by bucket and in their order, and their buckets."""
    words = _screened(pa.concat_arrays([x.unique() for x in lists]).unique().drop_null().sort(), screen)
    place = (_marks(words) % buckets).astype(np.int32)
    order = np.argsort(place, kind="stable")
    return words.take(pa.array(order)), place[order]


def _asked(blocks: Blocks, known: Broadcast, buckets: int) -> DataFrame:
    """`(block, row, rows, fold, bucket, words)`: what some rows of a block, all in general, ask for of a
    bucket as one compressed value."""
    shape, at = Shape(blocks.schema), blocks.schema.fieldNames().index("tokens")
    names = ["block", "row", "rows", "fold", "bucket", "words"]

    def ask(block: int, row: int, fold: int | None, lists: list[pa.Array], screen: np.ndarray) -> pa.RecordBatch:
        words, place = _asked_words(lists, screen, buckets)
        starts = np.append(0, np.flatnonzero(np.diff(place)) + 1) if len(place) else np.zeros(0, np.int64)
        stops = [*starts[1:].tolist(), len(place)][: len(starts)]
        values = [squeezed(strings(words.slice(a, b - a))) for a, b in zip(starts.tolist(), stops, strict=True)]
        same = [pa.array([block], pa.int64())] + [pa.array([x], pa.int32()) for x in (row, len(lists), fold)]
        columns = [c.take(pa.array(np.zeros(len(starts), np.int32))) for c in same]
        return pa.RecordBatch.from_arrays([*columns, pa.array(place[starts]), pa.array(values, pa.binary())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        screen = np.frombuffer(known.value, np.uint8)
        now, lists = None, []
        for batch in batches:
            for *key, value in zip(*batch.columns, strict=True):
                block, row, fold = (k.as_py() for k in key)
                if now is not None and (block, row) != (now[0], now[1] + len(lists)):
                    yield ask(*now, lists, screen)
                    now = None
                    spare()
                if now is None:
                    now, lists = (block, row, fold), []
                lists.append(_words_of(value, shape, at))
        if now is not None:
            yield ask(*now, lists, screen)

    rows = blocks.table.select("block", "row", "fold", blocks.asked)
    return rows.mapInArrow(run, "block long, row int, rows int, fold int, bucket int, words binary")


def _column(table: pa.Table, name: str) -> pa.Array:
    chunks = table.column(name).chunks
    return pa.concat_arrays(chunks) if chunks else pa.array([], table.schema.field(name).type)


def _dealt(entries: DataFrame, buckets: int) -> DataFrame:
    """`(bucket, entries)`: those of a bucket of tokens in their order, as compressed values."""

    def deal(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = Dictionary.of(batch.column(0).cast(pa.string()), *batch.columns[1:])
        ordered = pc.sort_indices(own.tokens).to_numpy()
        place = own.marks[ordered] % buckets
        order = np.argsort(place, kind="stable")
        ordered, place = ordered[order], place[order].astype(np.int32)
        starts = np.append(0, np.flatnonzero(np.diff(place)) + 1)
        values = [own.value(ordered[a:b]) for a, b in zip(starts, [*starts[1:], len(place)], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(place[starts]), pa.array(values, pa.binary())], ["bucket", "entries"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held, n = [*held, batch], n + batch.num_rows
            if n >= DEALT_ENTRIES:
                yield deal(one_batch(held))
                held, n = [], 0
                spare()
        if n:
            yield deal(one_batch(held))

    return entries.mapInArrow(run, "bucket int, entries binary")


def _answered(asked: pa.Table, dealt: pa.Table) -> pa.Table:
    """`(block, row, rows, bucket, found)`: tags and confidences for what was asked of one bucket, in its
    order, as compressed values; none where nothing is known."""
    spare()
    entries = _column(dealt, "entries").to_pylist()
    own = Dictionary.merged([Dictionary.from_value(e) for e in entries]) if entries else None
    folds, values = _column(asked, "fold").to_pylist(), _column(asked, "words").to_pylist()
    found: list[bytes | None] = [None] * len(values)
    at, listed = 0, None if own is None else strings(own.labels)
    while own is not None and at < len(values):
        some = []
        while at + len(some) < len(values) and sum(map(len, some)) < ASKED_WORDS:
            some.append(strings_from(opened(values[at + len(some)])))
        places = np.split(own.find(pa.concat_arrays(some)), np.cumsum([len(w) for w in some])[:-1])
        for i, place in enumerate(places, at):
            if folds[i] is None or not (place >= 0).any():
                continue
            fold = folds[i] if own.codes.shape[1] > 1 else 0
            codes = np.where(place >= 0, own.codes[place, fold], 0)
            shares, where = np.unique(np.where(place >= 0, own.confidence[place, fold], 1.0), return_inverse=True)
            found[i] = squeezed([codes, where, shares.view(np.uint64), *listed])
        at += len(some)
    columns = [_column(asked, c) for c in ("block", "row", "rows", "bucket")]
    table = pa.table([*columns, pa.array(found, pa.binary())], ["block", "row", "rows", "bucket", "found"])
    return table.filter(pc.is_valid(table.column("found")))


def in_blocks(records: DataFrame | Blocks, lexicon: DataFrame, fold_col: str | None = None) -> DataFrame:
    """`records` with `pred_tags` and `confidence`, for a lexicon of any size.

    Records are written in blocks, unless they are, of one fold each. A block asks for its distinct
    tokens, without those the screen does not know; a token is asked for once a block, so no token skews
    the join with the lexicon, which is by buckets of tokens. The answers are those of the block's fold,
    in the order of the questions, which the block's rows give again. They meet in a cogroup, whose
    sort spills and which holds one block at a time. All travel as compressed values.
    """
    entries = lexicon.select("token", "tag", "confidence").filter("token IS NOT NULL")
    screen, size = _screen(entries)
    shared = lexicon.sparkSession.sparkContext.broadcast(screen.tobytes())
    blocks = records if isinstance(records, Blocks) else Blocks.of(records, "blocks", fold_col, shared)
    buckets = max(size // BUCKET_ENTRIES, LEAST_BUCKETS)
    asked = _asked(blocks, shared, buckets)
    both = asked.groupBy("bucket").cogroup(_dealt(entries, buckets).groupBy("bucket"))
    answers = both.applyInArrow(_answered, "block long, row int, rows int, bucket int, found binary")
    schema, names = blocks.schema, blocks.schema.fieldNames()
    shape, at = Shape(schema), names.index("tokens")

    def unpacked(rows: pa.Table, found: pa.Table) -> pa.Table:
        spare()
        known = np.frombuffer(shared.value, np.uint8)
        order = dict(sorted(zip(_column(rows, "row").to_pylist(), range(rows.num_rows), strict=True)))
        values = _column(rows, "records").to_pylist()
        whole = one_batch([shape.records(values[i]) for i in order.values()])
        answers: dict[tuple[int, int], list[tuple[int, bytes]]] = {}
        for row, n, *answer in zip(*(_column(found, c).to_pylist() for c in ("row", "rows", "bucket", "found")), strict=True):
            answers.setdefault((row, n), []).append(tuple(answer))
        asking = _column(rows, rows.column_names[-1])
        words, labels, told = [pa.array([], pa.string())], [pa.array([OUTSIDE])], 1
        codes, shares = [], []
        for (row, n), answer in answers.items():
            own, place = _asked_words([_words_of(asking[order[i]], shape, at) for i in range(row, row + n)], known, buckets)
            code, share = np.zeros(len(own), np.int64), np.ones(len(own))
            for bucket, value in answer:
                tags, where, each, *listed = opened(value)
                mine = slice(*np.searchsorted(place, [bucket, bucket + 1]).tolist())
                code[mine], share[mine] = tags.astype(np.int64) + told, each.astype(np.uint64).view(np.float64)[where]
                labels.append(strings_from(listed))
                told += len(labels[-1])
            words, codes, shares = [*words, own], [*codes, code], [*shares, share]
        code, share = np.concatenate([*codes, [0]]).astype(np.int64), np.concatenate([*shares, [1.0]])
        lists, words = whole.column(at), pa.concat_arrays(words)
        place = pc.fill_null(pc.index_in(lists.flatten(), value_set=words), len(words)).to_numpy(zero_copy_only=False)
        lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        tags = pa.concat_arrays(labels).take(pa.array(code)).take(pa.array(place))
        kept = [c.cast(_nullable(c.type)) for c in whole.columns]
        columns = [*kept, _lists(lengths, tags), _lists(lengths, pa.array(share[place]))]
        return pa.Table.from_batches([pa.RecordBatch.from_arrays(columns, [*names, "pred_tags", "confidence"])])

    out = StructType([*schema.fields, *_FOUND.fields])
    meeting = blocks.table.select(*dict.fromkeys(["block", "row", "records", blocks.asked])).groupBy("block")
    return meeting.cogroup(answers.groupBy("block")).applyInArrow(unpacked, out)
