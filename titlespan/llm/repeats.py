"""Operator 4: removal of repeated byte strings by suffix arrays.

A string of `LENGTH` bytes is repeated if it starts at a second place in any document. Its
least 32-byte gram (the first one, of equal ones) depends on nothing but the string, so equal
strings have equal anchors, and the strings of a document fall into runs of neighbouring starts
with one anchor. Runs whose anchor's gram occurs once anywhere hold nothing repeated. The
others, equal ones merged and counted, are cut out and brought together by anchor, where a
suffix array of all of them and the common prefixes of its neighbours say which starts are
repeated. The runs of an anchor that has very many different ones are cut into parts, whose strings
share more than the gram, and the parts are brought together by what they share.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titlespan.llm.common import documents, join_groups, two_columns, written
from titlespan.llm.suffix_array import Segments, common_prefixes, suffix_array

LENGTH = 400
GRAM = 32
#: Bytes of text looked at at once; longer documents are cut with overlap.
PORTION = 1 << 19
#: Bits of a gram's hash that give way to its place.
PLACE_BITS = 24
#: Bytes of segments that one suffix array takes, if no anchor has more.
SORTED_BYTES = 1 << 18
#: Bytes of texts that a task returns at once.
RETURNED_BYTES = 4 << 20
#: Different runs of one anchor, or parts of one key, that are sorted together.
ANCHOR_RUNS = 1024
#: Starts of a part, while its key has more; each width divides the one before.
PART_WIDTHS = (128, 32, 8, 2, 1)

_BASE = 0x9E3779B97F4A7C15 | 1
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the `GRAM` bytes from each place on."""
    n = len(data)
    values = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(29)
    # Doubling: hashes of 1, 2, 4, ... bytes from each place on.
    span = 1
    while span < GRAM:
        factor = np.uint64(pow(_BASE, span, 1 << 64))
        values = values[:-span] * factor + values[span:]
        span *= 2
    values ^= values >> np.uint64(31)
    values *= _MIX
    values ^= values >> np.uint64(30)
    return values[: n - GRAM + 1]


def window_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` neighbours."""
    count = len(values) - width + 1
    blocks = -(-len(values) // width)
    full = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    full[: len(values)] = values
    full = full.reshape(blocks, width)
    ahead = np.minimum.accumulate(full, axis=1).ravel()
    behind = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])


def runs(data: bytes, starts: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Of texts one behind another: `(text, first start, count, anchor)` of every run; starts are
    places in `data`."""
    values = gram_hashes(np.frombuffer(data, np.uint8))
    place = np.uint64((1 << PLACE_BITS) - 1)
    least = window_least(values & ~place | np.arange(len(values), dtype=np.uint64), length - GRAM + 1)
    anchors = (least & place).astype(np.int64)
    change = np.zeros(len(data) + 1, np.int32)
    long = ends - starts >= length
    np.add.at(change, starts[long], 1)
    np.add.at(change, ends[long] - length + 1, -1)
    valid = np.flatnonzero(np.cumsum(change[: len(anchors)]) > 0)
    if not len(valid):
        return tuple(np.empty(0, np.int64) for _ in range(3)) + (np.empty(0, np.uint64),)
    at = anchors[valid]
    new = np.flatnonzero(np.diff(at, prepend=-1) != 0)
    first = valid[new]
    count = np.diff(np.append(new, len(valid)))
    text = np.searchsorted(starts, first, "right") - 1
    return text, first, count, values[at[new]]


def _portions(column: pa.Array, length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """`(row, offset, bytes)` of whole texts or overlapping parts of long ones, a portion each."""
    held, size = [], 0
    for row, text in enumerate(column):
        data = (text.as_py() or "").encode("utf-8", "surrogatepass")
        if len(data) < length:
            continue
        step = PORTION - length + 1
        for offset in range(0, max(1, len(data) - length + 1), step):
            part = data[offset : offset + PORTION]
            if held and size + len(part) > PORTION:
                yield held
                held, size = [], 0
            held.append((row, offset, part))
            size += len(part)
    if held:
        yield held


def occurrences(texts: DataFrame, length: int) -> DataFrame:
    """`(anchor, segment, doc_id, text_hash, start, count)` of every run of the texts; `segment`
    is a digest of the bytes its strings cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for portion in _portions(batch.column("text"), length):
                data = b"".join(p[2] for p in portion)
                sizes = np.array([len(p[2]) for p in portion])
                ends = np.cumsum(sizes)
                with np.errstate(over="ignore"):
                    text, first, count, anchors = runs(data, ends - sizes, ends, length)
                digests = [
                    xxhash.xxh3_128_digest(data[f : f + c + length - 1])
                    for f, c in zip(first.tolist(), count.tolist(), strict=True)
                ]
                row = np.array([p[0] for p in portion])[text]
                start = first - (ends - sizes)[text] + np.array([p[1] for p in portion])[text]
                row = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchors.view(np.int64)),
                        pa.array(digests, pa.binary()),
                        batch.column("doc_id").take(row),
                        batch.column("text_hash").take(row),
                        pa.array(start.astype(np.int64)),
                        pa.array(count.astype(np.int32)),
                    ],
                    ["anchor", "segment", "doc_id", "text_hash", "start", "count"],
                )

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(
        run,
        f"anchor long, segment binary, doc_id {kind}, text_hash long, start long, count int",
    )


def _cut(wanted: DataFrame, length: int) -> DataFrame:
    """`(anchor, segment, n, count, bytes)` from texts with their list of wanted segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "segment", "n", "count", "bytes"]
        kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.binary()]
        for batch in batches:
            rows, size = [], 0
            for text, segments in zip(batch.column(0), batch.column(1), strict=True):
                data = (text.as_py() or "").encode("utf-8", "surrogatepass")
                for s in segments.as_py():
                    part = data[s["start"] : s["start"] + s["count"] + length - 1]
                    rows.append((s["anchor"], s["segment"], s["n"], s["count"], part))
                    size += len(part)
                    if size > PORTION:
                        columns = zip(*rows, strict=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
                        )
                        rows, size = [], 0
            if rows:
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
                )

    return wanted.mapInArrow(run, "anchor long, segment binary, n long, count int, bytes binary")


def repeated_starts(texts: list[bytes], counts: list[int], n: list[int], length: int) -> list[list[tuple[int, int]]]:
    """By segment: `(first, last + 1)` of its repeated starts; `n`: how often the segment occurs."""
    segments = Segments(texts, counts)
    order = suffix_array(segments)
    order = order[segments.wanted()[order]]
    shared = common_prefixes(segments, order, length) >= length
    hit = shared.copy()
    hit[:-1] |= shared[1:]
    repeated = np.zeros(len(segments.symbols) + 1, bool)
    repeated[order[hit]] = True
    out = []
    for start, count, times in zip(segments.starts.tolist(), counts, n, strict=True):
        if times > 1:
            out.append([(0, count)])
            continue
        own = repeated[start : start + count].astype(np.int8)
        edges = np.flatnonzero(np.diff(own, prepend=0, append=0))
        out.append(list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)))
    return out


_RANGES = "array<struct<low:int,high:int>>"


def _decided(segments: DataFrame, length: int) -> DataFrame:
    """`(segment, ranges)`: the repeated starts of every segment that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))

        def decide(rows: list) -> pa.RecordBatch:
            _, names, n, counts, texts = zip(*rows, strict=True)
            found = repeated_starts(list(texts), list(counts), list(n), length)
            some = [i for i, f in enumerate(found) if f]
            ranges = [[{"low": a, "high": b} for a, b in found[i]] for i in some]
            return pa.RecordBatch.from_arrays(
                [pa.array([names[i] for i in some], pa.binary()), pa.array(ranges, kind)],
                ["segment", "ranges"],
            )

        held, size, anchor = [], 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[0] != anchor and size > SORTED_BYTES:
                    yield decide(held)
                    held, size = [], 0
                anchor = row[0]
                held.append(row)
                size += len(row[4])
        if held:
            yield decide(held)

    together = segments.repartition("anchor").sortWithinPartitions("anchor")
    return together.mapInArrow(run, f"segment binary, ranges {_RANGES}")


def _parts(rows: DataFrame, width: int, length: int) -> DataFrame:
    """`(key, name, segment, offset, anchor, n, count, bytes)`: runs cut where the number of bytes
    before the anchor's gram passes a multiple of `width`.

    Equal strings have the gram at one place, so they are in parts of one cut; and all strings of a
    part share the bytes around the gram that no start in it leaves out. `key` is a digest of
    those, `name` one of all the part's bytes, `offset` its place in the segment.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "name", "segment", "offset", "anchor", "n", "count", "bytes"]
        kinds = [pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]

        def made(out: list) -> pa.RecordBatch:
            columns = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            out, size = [], 0
            columns = (batch.column(c).to_pylist() for c in ("segment", "offset", "anchor", "n", "count", "bytes"))
            for segment, offset, anchor, n, count, data in zip(*columns, strict=True):
                with np.errstate(over="ignore"):
                    grams = gram_hashes(np.frombuffer(data, np.uint8))
                # Of equal grams the first one is the anchor of every string that holds it.
                at = int(np.flatnonzero(grams.view(np.int64) == anchor)[0])
                for cell in range((at - count + 1) // width, at // width + 1):
                    low, high = cell * width, min((cell + 1) * width, length - GRAM + 1)
                    first, last = max(0, at - high + 1), min(count - 1, at - low)
                    part = data[first : last + length]
                    core = data[at - low : at + length - high + 1]
                    key = xxhash.xxh3_128_digest(b"%d %d " % (anchor, cell) + core)
                    name = xxhash.xxh3_128_digest(key + part)
                    out.append((key, name, segment, offset + first, anchor, n, last - first + 1, part))
                    size += len(part)
                    if size > PORTION:
                        yield made(out)
                        out, size = [], 0
            if out:
                yield made(out)

    kind = "key binary, name binary, segment binary, offset int, anchor long, n long, count int, bytes binary"
    return rows.select("segment", "offset", "anchor", "n", "count", "bytes").mapInArrow(run, kind)


def _decided_in_parts(segments: DataFrame, length: int) -> DataFrame:
    """As `_decided`, for anchors with too many different runs: they are sorted in parts.

    A part's key is longer than the gram, and the longer the narrower the part; equal parts are one,
    with the number of their runs. Keys with too many different parts are cut further; a part of a
    single start is one string, so that its key has no different parts.
    """
    rows, decided = segments.withColumn("offset", F.lit(0)), []
    for width in PART_WIDTHS:
        parts = written(_parts(rows, width, length), "repeats-parts")
        own = parts.groupBy("name").agg(
            F.first("key").alias("key"),
            F.sum("n").alias("n"),
            F.first("count").alias("count"),
            F.first("bytes").alias("bytes"),
            F.count("*").alias("times"),
        )
        own = written(own, "repeats-names")
        keys = own.groupBy("key").agg(F.count("*").alias("different"))
        too_many = F.col("different") > (ANCHOR_RUNS if width > 1 else 1)
        crowded = written(keys.filter(too_many).select("key"), "repeats-crowded")
        sorted_here = own.join(crowded, "key", "left_anti").select(F.col("key").alias("anchor"), F.col("name").alias("segment"), "n", "count", "bytes")
        ranges = _decided(sorted_here, length).withColumnRenamed("segment", "name")
        ranges = written(ranges.join(own.select("name", "times"), "name"), "repeats-ranges")
        found = join_groups(parts.select("name", "segment", "offset"), ranges, "name", "times")
        moved = "transform(ranges, r -> struct(offset + r.low AS low, offset + r.high AS high))"
        decided.append(found.filter("ranges IS NOT NULL").select("segment", F.expr(moved).alias("ranges")))
        if crowded.isEmpty():
            break
        rows = parts.join(crowded, "key", "left_semi")
    together = reduce(DataFrame.union, decided)
    return together.groupBy("segment").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))


def removed_ranges(texts: DataFrame, length: int) -> DataFrame:
    """`(doc_id, text_hash, ranges)`: the repeated starts of every document that has any; `texts`
    has `(doc_id, text, text_hash)`. Ranges are in bytes, may touch, and come in no order."""
    found = written(occurrences(texts, length), "repeats-runs")
    anchors = found.groupBy("anchor").agg(F.count("*").alias("times"))
    anchors = written(anchors.filter("times > 1").select("anchor"), "repeats-anchors")
    found = written(found.join(anchors, "anchor", "left_semi"), "repeats-found")
    rep = F.min(F.struct("doc_id", "text_hash", "start")).alias("rep")
    segments = found.groupBy("segment").agg(
        F.first("anchor").alias("anchor"), F.first("count").alias("count"), F.count("*").alias("n"), rep
    )
    segments = written(segments, "repeats-segments")
    crowded = segments.groupBy("anchor").agg(F.count("*").alias("runs")).filter(F.col("runs") > ANCHOR_RUNS)
    crowded = written(crowded.select("anchor", F.lit(True).alias("crowded")), "repeats-crowded")

    wanted = segments.groupBy(F.col("rep.doc_id").alias("key"), F.col("rep.text_hash").alias("key_hash")).agg(
        F.collect_list(
            F.struct("anchor", "segment", "n", "count", F.col("rep.start").alias("start"))
        ).alias("segments")
    )
    once = texts.join(
        wanted, (texts["text_hash"] == wanted["key_hash"]) & texts["doc_id"].eqNullSafe(wanted["key"])
    )
    cut = _cut(once.select("text", "segments"), length)
    if crowded.limit(1).count():
        cut = written(cut, "repeats-cut")
        cut = cut.dropDuplicates(["segment"])  # rows that repeat id and text
        some = cut.join(crowded, "anchor", "left_semi")
        ranges = _decided(cut.join(crowded, "anchor", "left_anti"), length).unionByName(_decided_in_parts(some, length))
    else:
        ranges = _decided(cut, length)
    ranges = written(ranges.dropDuplicates(["segment"]), "repeats-ranges")
    ranges = written(ranges.join(segments.select("segment", "n"), "segment"), "repeats-ranges")
    return (
        join_groups(found.select("segment", "doc_id", "text_hash", "start"), ranges, "segment", "n")
        .filter("ranges IS NOT NULL")
        .selectExpr(
            "doc_id", "text_hash", "transform(ranges, r -> struct(start + r.low AS low, start + r.high AS high)) AS ranges"
        )
        .groupBy("doc_id", "text_hash")
        .agg(F.flatten(F.collect_set("ranges")).alias("ranges"))
    )


def covered(ranges: list[tuple[int, int]], length: int) -> list[tuple[int, int]]:
    """Maximal runs of bytes that the strings from `ranges` of starts cover."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(ranges):
        end = high + length - 1
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((low, end))
    return out


def dedup_strings(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`(doc_id, n_bytes, n_removed, spans, kept)`, one row per input row.

    Texts are UTF-8 bytes, null is empty. Every byte covered by a string of `length` bytes that
    also starts anywhere else, in the same document or another, is removed: `spans` are the
    maximal removed runs as `(low, high)`, `kept` the other bytes joined. Rows that repeat an id
    or a text are documents of their own. Very long texts are looked at in overlapping portions. Other columns are not looked at; an empty table gives
    no rows.
    """
    if length <= GRAM:
        raise ValueError(f"strings of more than {GRAM} bytes are looked for")
    texts = two_columns(docs, id_col, text_col).withColumn(
        "text_hash", F.xxhash64(F.coalesce("text", F.lit("")))
    )
    ranges = removed_ranges(texts, length).select(
        F.col("doc_id").alias("key"), F.col("text_hash").alias("key_hash"), "ranges"
    )
    joined = texts.join(
        ranges,
        (texts["text_hash"] == ranges["key_hash"]) & texts["doc_id"].eqNullSafe(ranges["key"]),
        "left",
    ).select("doc_id", "text", "ranges")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))
        names = ["doc_id", "n_bytes", "n_removed", "spans", "kept"]

        def made(ids: pa.Array, rows: list) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), span, pa.binary()]
            columns = zip(*rows, strict=True)
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays([ids, *arrays], names)

        for batch in batches:
            ids, first, rows, size = batch.column("doc_id"), 0, [], 0
            for text, found in zip(batch.column("text"), batch.column("ranges"), strict=True):
                data = (text.as_py() or "").encode("utf-8", "surrogatepass")
                spans = covered([(r["low"], r["high"]) for r in found.as_py() or []], length)
                at, parts = 0, []
                for low, high in spans:
                    parts.append(data[at:low])
                    at = high
                kept = b"".join(parts) + data[at:]
                told = [{"low": a, "high": b} for a, b in spans]
                rows.append((len(data), len(data) - len(kept), told, kept))
                size += len(data)
                if size > RETURNED_BYTES:
                    yield made(ids.slice(first, len(rows)), rows)
                    first, rows, size = first + len(rows), [], 0
            if rows:
                yield made(ids.slice(first, len(rows)), rows)

    kind = texts.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(
        run,
        f"doc_id {kind}, n_bytes long, n_removed long,"
        " spans array<struct<low:bigint,high:bigint>>, kept binary",
    )


def op4_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digests of `dedup_strings`, and the bytes that stay as `text`, in which a letter that was
    cut through reads U+FFFD."""
    return dedup_strings(documents(spark, sf_dir)).select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        F.make_valid_utf8(F.col("kept").cast("string")).alias("text"),
    )
