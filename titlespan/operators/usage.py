"""V4, V5's multiset difference and M1's counts, for Arrow batches of records.

Tokens are counted some millions at a time. What a task found of one bucket of tokens is one
compressed value, so that a token is a few bytes in the shuffle; a task adds up bucket by bucket.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlespan.operators.blocks import opened, spare, squeezed, strings, strings_from, together

#: Tokens counted at once, about; a record is not split.
COUNTED_TOKENS = 500_000
#: Counts of a bucket that are held before they are added up, about.
HELD_COUNTS = 200_000

# Tasks get this module's code with the query, so that executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_USAGE = pa.struct([("token", pa.string()), ("used", pa.int32()), ("have", pa.int32())])


def _words(lists: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The strings of the lists that are not NULL, each with its row."""
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    words = lists.flatten().cast(pa.string())
    known = words.is_valid()
    row = np.repeat(np.arange(len(lists)), lengths)
    return row[known.to_numpy(zero_copy_only=False)], words.drop_null()


def _used_beyond(texts: pa.Array, tokens: pa.Array) -> pa.Array:
    """Per record `(token, used, have)` of the tokens that the texts use more often than it has them."""
    lengths = pc.fill_null(pc.list_value_length(texts), 0).to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(texts)), lengths)
    flat = texts.flatten().cast(pa.string())
    lacking = ~np.logical_and(texts.is_valid(), tokens.is_valid())
    lacking[rows[flat.is_null().to_numpy(zero_copy_only=False)]] = True
    text_row, flat = _words(texts)
    split = pc.split_pattern(flat, " ")
    used_row = np.repeat(text_row, pc.list_value_length(split).to_numpy(zero_copy_only=False))
    have_row, have = _words(tokens)
    words = pa.concat_arrays([split.flatten(), have]).dictionary_encode()
    code = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    n = max(len(words.dictionary), 1)
    keys, used = np.unique(used_row * n + code[: len(used_row)], return_counts=True)
    had, times = np.unique(have_row * n + code[len(used_row) :], return_counts=True)
    place = np.minimum(np.searchsorted(had, keys), max(len(had) - 1, 0))
    held = np.where(had[place] == keys, times[place], 0) if len(had) else np.zeros(len(keys), np.int64)
    beyond = (used > held) & ~lacking[keys // n]
    keys, used, held = keys[beyond], used[beyond], held[beyond]
    found = [words.dictionary.take(pa.array(keys % n)), pa.array(used, pa.int32()), pa.array(held, pa.int32())]
    ends = np.searchsorted(keys // n, np.arange(len(texts)), side="right").astype(np.int32)
    offsets = pa.array(np.append(0, ends).astype(np.int32), mask=np.append(lacking, False))
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(found, fields=list(_USAGE)))


def token_usage(texts: Column, tokens: Column) -> Column:
    """V4, V5: `(token, used, have)` for each token the texts use more often than it occurs; NULL for a
    record without tokens or with a text that is NULL. `have` is 0 for a token that does not occur."""
    # Spark copies expressions it takes for pure into every place that reads them, and runs them there again.
    once = F.arrow_udf(_used_beyond, "array<struct<token:string,used:int,have:int>>").asNondeterministic()
    return once(texts, tokens)


def _places(lengths: np.ndarray, n: np.ndarray) -> pa.Array:
    """Of `n` places a record, where in the flat values they are; NULL past a record's own."""
    pos = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return pa.array(pos + np.repeat(np.cumsum(lengths) - lengths, n), mask=pos >= np.repeat(lengths, n))


def _values(tokens: pa.Array, tags: pa.Array, folds: np.ndarray | None, k: int, buckets: int) -> pa.RecordBatch:
    """The distinct tokens of some records with their tags and how often they have them, by fold: a
    value for each bucket of tokens, which holds them in their order."""
    lengths = [pc.fill_null(pc.list_value_length(c), 0).to_numpy(zero_copy_only=False) for c in (tokens, tags)]
    n = lengths[0]
    word, tag = tokens.flatten().cast(pa.string()), tags.flatten().cast(pa.string())
    if (lengths[0] != lengths[1]).any():
        both = np.logical_and(tokens.is_valid(), tags.is_valid())
        n = np.where(both, np.maximum(*lengths), 0)
        word, tag = word.take(_places(lengths[0], n)), tag.take(_places(lengths[1], n))
    words = word.dictionary_encode(null_encoding="encode")
    labels = pc.fill_null(tag, "").dictionary_encode()
    sorted_words = pc.sort_indices(words.dictionary).to_numpy()
    marks = [0 if w is None else zlib.crc32(w) for w in words.dictionary.cast(pa.binary()).to_pylist()]
    bucket = np.array(marks, np.int64) % buckets
    order = sorted_words[np.argsort(bucket[sorted_words], kind="stable")]
    rank = np.zeros(len(order), np.int64)
    rank[order] = np.arange(len(order))
    kinds = max(len(labels.dictionary), 1) * k
    keys = rank[words.indices.to_numpy(zero_copy_only=False)] * kinds
    keys += labels.indices.to_numpy(zero_copy_only=False).astype(np.int64) * k
    if folds is not None:
        keys += np.repeat(folds, n)
    keys, times = np.unique(keys, return_counts=True)
    own, bucket, listed = words.dictionary.take(pa.array(order)), bucket[order], strings(labels.dictionary)
    starts = np.append(0, np.flatnonzero(np.diff(bucket)) + 1) if len(bucket) else np.zeros(0, np.int64)
    stops = np.append(starts[1:], len(bucket)) if len(bucket) else starts
    made = []
    for start, stop in zip(starts.tolist(), stops.tolist(), strict=True):
        low, high = np.searchsorted(keys, [start * kinds, stop * kinds])
        place, kind = np.divmod(keys[low:high], kinds)
        each = np.bincount(place - start, minlength=stop - start)
        made.append(squeezed([*strings(own.slice(start, stop - start)), each, kind, times[low:high], *listed]))
    return pa.RecordBatch.from_arrays([pa.array(bucket[starts], pa.int32()), pa.array(made, pa.binary())], ["bucket", "counts"])


class _Counts:
    """Counts of one bucket, by token, tag and fold; added up as they come."""

    def __init__(self, k: int):
        self.k, self.parts, self.rows = k, [], 0

    def add(self, value: bytes) -> None:
        parts = opened(value)
        each, kind, times = (x.astype(np.int64) for x in parts[3:6])
        label, fold = np.divmod(kind, self.k)
        word = np.repeat(np.arange(len(each)), each)
        self.parts.append((strings_from(parts[:3]), strings_from(parts[6:9]), word, label, fold, times))
        self.rows += len(times)
        if len(self.parts) > 1 and self.rows > 2 * max(HELD_COUNTS, len(self.parts[0][5])):
            self.parts = [self.total()]
            self.rows = len(self.parts[0][5])

    def total(self) -> tuple[pa.Array, pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Tokens, labels in the order of their bytes, and by token, label and fold the counts."""
        words = pa.concat_arrays([p[0] for p in self.parts]).dictionary_encode(null_encoding="encode")
        labels = pa.concat_arrays([p[1] for p in self.parts])
        ordered = labels.cast(pa.binary()).unique().sort().cast(pa.string())
        of_label = pc.index_in(labels, value_set=ordered).to_numpy(zero_copy_only=False)
        of_word = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        keys, at_word, at_label = [], 0, 0
        for own, named, word, label, fold, _ in self.parts:
            key = of_word[word + at_word] * len(ordered) + of_label[label + at_label]
            keys.append(key * self.k + fold)
            at_word, at_label = at_word + len(own), at_label + len(named)
        keys, where = np.unique(np.concatenate(keys), return_inverse=True)
        times = np.zeros(len(keys), np.int64)
        np.add.at(times, where, np.concatenate([p[5] for p in self.parts]))
        key, fold = np.divmod(keys, self.k)
        word, label = np.divmod(key, max(len(ordered), 1))
        return words.dictionary, ordered, word, label, fold, times


def _best(word: np.ndarray, label: np.ndarray, n: np.ndarray, words: int) -> tuple[np.ndarray, ...]:
    """By word the label with the highest count, its count and the sum of all; -1 and nought without one."""
    some = np.flatnonzero(n > 0)
    order = some[np.lexsort((label[some], -n[some], word[some]))]
    first = order[np.append(True, np.diff(word[order]) != 0)[: len(order)]]
    best, times, total = np.full(words, -1, np.int64), np.zeros(words, np.int64), np.zeros(words, np.int64)
    best[word[first]], times[word[first]] = label[first], n[first]
    np.add.at(total, word, n)
    return best, times, total


def _labels(best: np.ndarray, labels: pa.Array) -> pa.Array:
    return labels.take(pa.array(best, mask=best < 0))


def _entries(counts: _Counts) -> pa.RecordBatch:
    words, labels, word, label, _, n = counts.total()
    best, times, total = _best(word, label, n, len(words))
    columns = [words, _labels(best, labels), pa.array(times), pa.array(total), pa.array(times / total)]
    return pa.RecordBatch.from_arrays(columns, ["token", "tag", "n", "total", "confidence"])


def _entries_per_fold(counts: _Counts) -> pa.RecordBatch:
    k = counts.k - 2  # beside the folds, one that is none of them and one that is NULL
    words, labels, word, label, fold, n = counts.total()
    pair, inverse = np.unique(word * len(labels) + label, return_inverse=True)
    by_fold = np.zeros((len(pair), k + 2), np.int64)
    by_fold[inverse, fold] = n
    known = by_fold[:, : k + 1].sum(axis=1)
    word, label = np.divmod(pair, max(len(labels), 1))
    found = [_best(word, label, known - by_fold[:, f], len(words)) for f in range(k)]
    best, times, total = (np.stack(x, axis=1).ravel() for x in zip(*found, strict=True))
    share = pa.array(times / np.maximum(total, 1), mask=total == 0)
    ends = pa.array(np.arange(len(words) + 1, dtype=np.int32) * k)
    lists = [pa.ListArray.from_arrays(ends, x) for x in (_labels(best, labels), share)]
    return pa.RecordBatch.from_arrays([words, *lists], ["token", "tag", "confidence"])


def _added_up(seqs: DataFrame, k: int, entries: Callable[[_Counts], pa.RecordBatch], out: str) -> DataFrame:
    """`entries` of every bucket of `(tokens, tags[, fold])`, after one shuffle of compressed counts."""
    buckets = int(seqs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in together(batches, 0, COUNTED_TOKENS):
            folds = some.column(2).to_numpy(zero_copy_only=False) if some.num_columns > 2 else None
            yield _values(some.column(0), some.column(1), folds, k, buckets)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, counts = None, _Counts(k)
        for batch in batches:
            for bucket, value in zip(*(batch.column(i) for i in range(2)), strict=True):
                if bucket.as_py() != now:
                    if counts.parts:
                        yield entries(counts)
                        spare()
                    now, counts = bucket.as_py(), _Counts(k)
                counts.add(value.as_py())
        if counts.parts:
            yield entries(counts)

    dealt = seqs.mapInArrow(count, "bucket int, counts binary").repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(add_up, out)


def most_frequent(seqs: DataFrame, tag_col: str) -> DataFrame:
    """M1 over sequences: `(token, tag, n, total, confidence)`; a blank tag is '', ties by tag text."""
    arrays = seqs.select("tokens", F.col(tag_col).cast("array<string>").alias("tags"))
    return _added_up(arrays, 1, _entries, "token string, tag string, n bigint, total bigint, confidence double")


def most_frequent_per_fold(folded: DataFrame, tag_col: str, k: int) -> DataFrame:
    """M1 for each of `k` folds over the others: `(token, tag, confidence)` with an entry per fold, NULL
    where the others do not have the token. Other numbers of a fold are in none of them; NULL is left out."""
    fold = F.when(F.col("fold").isNull(), k + 1).when(F.col("fold").between(0, k - 1), F.col("fold")).otherwise(k)
    arrays = folded.select("tokens", F.col(tag_col).cast("array<string>").alias("tags"), fold.cast("int").alias("fold"))
    return _added_up(arrays, k + 2, _entries_per_fold, "token string, tag array<string>, confidence array<double>")
