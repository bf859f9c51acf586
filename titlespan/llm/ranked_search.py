"""Ranked lexical search: bundles of items travel through the owners of their terms.

The documents become an inverted index in segments of bounded size, one list per segment and
term, with only terms that a fixed-size bit map of the items' terms lets through. Terms are owned
by how many documents hold them, rare ones first. A bundle, some items over one segment, starts
empty, meets at every owner the lists of that owner's terms in a cogroup, adds their integer
contributions to its sparse sums per document and goes on; after the owner of the most common
terms it keeps each item's best documents. No task holds more than a segment of one bundle, however
common a term is.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from titlespan.llm.common import documents, quoted_name, table, two_columns, written

#: Documents and distinct terms of documents that a segment holds at most (a document is not split).
SEGMENT_DOCS, SEGMENT_TERMS = 8192, 4_000_000
#: Items of a bundle, about: they are dealt out by a hash of their id.
BUNDLE_ITEMS = 256
#: An owner has the terms that at most one document in so many holds; the last one has the rest.
OWNERS = (1000, 30)
#: Bits of the map of the items' terms.
SCREEN_BITS = 1 << 22
#: Results of an item.
TOP = 50

# The weights of the score.
_K1, _SCALE, _FLAT, _BY_LENGTH = 1000, 1_000_000_000, 20, 50

#: Bytes of UTF-8 that belong to terms, A-Z as a-z; all others are blanks.
_TERM_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """The maximal runs of ASCII letters, digits and letters beyond ASCII, with A-Z lower-cased,
    in UTF-8. No byte of a longer character is an ASCII one, so bytes tell the runs apart."""
    return text.encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split() if text else []


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """`(item_id, term)`, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms_of(t))) for t in batch.column(1).to_pylist()]
            at = pa.array([i for i, ts in enumerate(found) for _ in ts], pa.int64())
            flat = pa.array([t for ts in found for t in ts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), flat], ["item_id", "term"])

    narrow = items.select(
        quoted_name(id_col).alias("item_id"), quoted_name(text_col).cast("string").alias("text")
    )
    kind = narrow.schema["item_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"item_id {kind}, term binary").distinct()


def screen(terms: DataFrame) -> bytes:
    """A bit for every checksum of a term, modulo the map's size: half a megabyte, always."""
    bit = F.crc32("term") % SCREEN_BITS + 1
    parts = (
        terms.select(bit.alias("bit"))
        .groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
        .collect()
    )
    full = bytearray(SCREEN_BITS // 8)
    for part in parts:
        start = (part["bucket"] - 1) * len(part["bits"])
        full[start : start + len(part["bits"])] = part["bits"]
    return bytes(full)


def index(docs: DataFrame, bits: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The inverted segments: `(segment, term, places, counts, lengths, ids)`.

    A list has a term, the documents' places in the segment in ascending order, the term's
    occurrences there and the documents' lengths. Every segment has one more row without a term:
    the ids of all its documents by place, and all their lengths. Places follow the ids.
    """
    kind = docs.select(quoted_name(id_col)).schema[0].dataType.simpleString()
    known = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little").astype(bool)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, made = TaskContext.get().partitionId(), 0
        asked: dict[bytes, bool] = {}
        ids: list = []
        lengths: list[int] = []
        lists: dict[bytes, tuple[list[int], list[int]]] = {}
        held = 0

        def segment() -> Iterator[pa.RecordBatch]:
            nonlocal made, held
            if not ids:
                return
            order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i]))
            place = np.empty(len(ids), np.int32)
            place[order] = np.arange(len(ids), dtype=np.int32)
            sizes = np.array(lengths, np.int64)
            number = task << 32 | made
            made += 1

            def batch(term, places, counts, sizes, ids) -> pa.RecordBatch:
                def many(parts, kind):
                    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
                    return pa.ListArray.from_arrays(ends, pa.array(np.concatenate(parts), kind))

                columns = [
                    pa.array([number] * len(term), pa.int64()),
                    pa.array(term, pa.binary()),
                    many(places, pa.int32()),
                    many(counts, pa.int32()),
                    many(sizes, pa.int64()),
                    pa.array(ids, pa.list_(id_type)),
                ]
                return pa.RecordBatch.from_arrays(columns, _INDEX)

            none = np.empty(0, np.int32)
            yield batch([None], [none], [none], [sizes[order]], [[ids[i] for i in order]])
            found = list(lists)
            for first in range(0, len(found), 2000):
                some = found[first : first + 2000]
                at = [np.array(lists[t][0], np.int64) for t in some]
                by = [np.argsort(place[a]) for a in at]
                yield batch(
                    some,
                    [place[a][o] for a, o in zip(at, by, strict=True)],
                    [np.array(lists[t][1], np.int32)[o] for t, o in zip(some, by, strict=True)],
                    [sizes[a][o] for a, o in zip(at, by, strict=True)],
                    [None] * len(some),
                )
            ids.clear(), lengths.clear(), lists.clear()
            held = 0

        id_type = None
        for batch in batches:
            id_type = batch.column(0).type
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if len(ids) >= SEGMENT_DOCS or held >= SEGMENT_TERMS:
                    yield from segment()
                words = terms_of(text)
                here = len(ids)
                for term, n in Counter(words).items():
                    wanted = asked.get(term)
                    if wanted is None:
                        if len(asked) > 200_000:
                            asked.clear()
                        wanted = asked[term] = bool(known[zlib.crc32(term) % SCREEN_BITS])
                    if wanted:
                        places, counts = lists.setdefault(term, ([], []))
                        places.append(here)
                        counts.append(n)
                        held += 1
                ids.append(doc_id)
                lengths.append(len(words))
        yield from segment()

    return two_columns(docs, id_col, text_col).mapInArrow(
        run,
        f"segment long, term binary, places array<int>, counts array<int>, "
        f"lengths array<long>, ids array<{kind}>",
    )


_INDEX = ["segment", "term", "places", "counts", "lengths", "ids"]


def _owner(share: str) -> str:
    cases = " ".join(f"WHEN {share} * {limit} <= 1 THEN {i}" for i, limit in enumerate(OWNERS))
    return f"CASE {cases} ELSE {len(OWNERS)} END"


def _contributions(weight: int, counts, lengths, n_docs: int, n_terms: int):
    """What a term adds to each document of its list, in 64-bit integers."""
    length = 100 - _BY_LENGTH + _BY_LENGTH * lengths * n_docs // n_terms
    tf = counts.astype(np.int64)
    return weight * (_SCALE * tf // (_K1 * tf + _FLAT * length))


def _flat(column: pa.ChunkedArray, row: int, kind) -> np.ndarray:
    return column[row].values.to_numpy(zero_copy_only=False).astype(kind, copy=False)


def _met(bundles: DataFrame, lists: DataFrame, last: bool, top: int, n_docs: int, n_terms: int) -> DataFrame:
    """One owner's work on all bundles: `(segment, bundle, item, places, sums, ids)`.

    A bundle's rows are its items' sums so far, and one row without an item that has the segment's
    ids. After the last owner an item keeps its `top` best documents.
    """

    def run(carried: pa.Table, owned: pa.Table) -> pa.Table:
        head = carried.filter(pc.is_null(carried["item"]))
        if not head.num_rows:
            return carried.slice(0, 0)
        ids = head["ids"][0].values
        rows = carried.filter(pc.is_valid(carried["item"]))
        before = {item: row for row, item in enumerate(rows["item"].to_pylist())}
        asked: dict[int, list[int]] = {}
        added = []
        for row, items in enumerate(owned["items"].to_pylist()):
            weight = owned["weight"][row].as_py()
            counts, lengths = _flat(owned["counts"], row, np.int64), _flat(owned["lengths"], row, np.int64)
            added.append(
                (_flat(owned["places"], row, np.int64), _contributions(weight, counts, lengths, n_docs, n_terms))
            )
            for item in items:
                asked.setdefault(item, []).append(row)
        items, places, sums = [], [], []
        for item in sorted(before.keys() | asked.keys()):
            full = np.zeros(len(ids), np.int64)
            if item in before:
                full[_flat(rows["places"], before[item], np.int64)] = _flat(rows["sums"], before[item], np.int64)
            for row in asked.get(item, ()):
                where, what = added[row]
                full[where] += what
            at = np.flatnonzero(full)
            if last and len(at) > top:
                # Places follow the ids, and a stable sort keeps them in order among equal sums.
                at = at[np.argsort(-full[at], kind="stable")[:top]]
            if len(at):
                items.append(item)
                places.append(at.astype(np.int32))
                sums.append(full[at])

        def many(parts, kind) -> pa.Array:
            ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
            return pa.ListArray.from_arrays(ends, pa.array(np.concatenate(parts), kind))

        none = np.empty(0, np.int32)
        count = len(items) + 1
        if last:
            # The ids of the places kept stand in for the head, which has done its work.
            at_ids = [ids.take(pa.array(p)) for p in places] + [ids.slice(0, 0)]
            at_ids = pa.chunked_array([pa.array([a.to_pylist() for a in at_ids], pa.list_(ids.type))])
        else:
            at_ids = pa.chunked_array([pa.array([None] * (count - 1) + [ids.to_pylist()], pa.list_(ids.type))])
        out = {
            "segment": pa.array([head["segment"][0].as_py()] * count, pa.int64()),
            "bundle": pa.array([head["bundle"][0].as_py()] * count, pa.int32()),
            "item": pa.array([*items, None], pa.int64()),
            "places": many([*places, none], pa.int32()),
            "sums": many([*sums, none.astype(np.int64)], pa.int64()),
            "ids": at_ids,
        }
        return pa.table(out)

    return (
        bundles.groupBy("segment", "bundle")
        .cogroup(lists.groupBy("segment", "bundle"))
        .applyInArrow(run, bundles.schema)
    )


def ranked(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    top: int = TOP,
) -> DataFrame:
    """`(item_id, rank, doc_id, score)`: each item's `top` documents with a score above 0.

    A document's score is the sum, over the item's distinct terms, of the term's weight times a
    saturated count, all in 64-bit integers but for the logarithm (the formula is in `OP12_SQL`).
    Equal scores come in ascending order of doc_id. Null and empty texts have no terms and are
    never found; an item without terms, or whose terms no document holds, has no rows. Every row
    of `docs` is a document of its own, so a repeated id can be listed twice; rows of one item id
    are one item. Null ids are ids that sort first. Texts of any length are used whole. Empty
    tables give no rows; other columns are not looked at.
    """
    spark = docs.sparkSession
    asked = written(item_terms(items, item_col, item_text), "search-items")
    lists = written(index(docs, screen(asked), id_col, text_col), "search-index")
    heads = lists.filter("term IS NULL")
    totals = heads.agg(
        F.expr("coalesce(sum(size(filter(lengths, n -> n > 0))), 0L) AS docs"),
        F.expr("coalesce(sum(aggregate(lengths, 0L, (a, n) -> a + n)), 0L) AS terms"),
    ).first()
    n_docs, n_terms = totals["docs"], max(totals["terms"], 1)

    names = asked.select("item_id").distinct()
    bundles_n = max(1, -(-names.count() // BUNDLE_ITEMS))
    # Numbers stand for item ids of any type while their sums travel.
    numbered = written(
        names.select(
            "item_id",
            F.monotonically_increasing_id().alias("item"),
            F.pmod(F.xxhash64("item_id"), F.lit(bundles_n)).cast("int").alias("bundle"),
        ),
        "search-numbers",
    )
    same_item = asked["item_id"].eqNullSafe(numbered["item_id"])
    holders = (
        asked.join(numbered, same_item)
        .groupBy("term", "bundle")
        .agg(F.collect_list("item").alias("items"))
    )
    frequency = lists.filter("term IS NOT NULL").groupBy("term").agg(F.sum(F.size("places")).alias("df"))
    owned = frequency.select(
        "term",
        F.expr(f"CAST(floor(1000 * ln(CAST(2 * {n_docs}L + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS weight"),
        F.expr(f"{_owner(f'df / {max(n_docs, 1)}.0D')} AS owner"),
    )
    # A term has one list a segment, so no term holds more of this table than any other common one.
    dealt = written(
        lists.filter("term IS NOT NULL")
        .join(holders.join(owned, "term"), "term")
        .select("segment", "bundle", "owner", "weight", "items", "places", "counts", "lengths"),
        "search-lists",
    )
    carried = heads.select(
        "segment",
        F.explode(F.sequence(F.lit(0), F.lit(bundles_n - 1))).alias("bundle"),
        F.lit(None).cast("long").alias("item"),
        "places",
        F.expr("CAST(array() AS array<bigint>) AS sums"),
        "ids",
    )
    for owner in range(len(OWNERS) + 1):
        here = dealt.filter(F.col("owner") == owner).drop("owner")
        carried = _met(carried, here, owner == len(OWNERS), top, n_docs, n_terms)
    best = carried.filter("item IS NOT NULL").select(
        "item", F.explode(F.arrays_zip("ids", "sums")).alias("z")
    ).select("item", F.col("z.ids").alias("doc_id"), F.col("z.sums").alias("score"))
    order = W.partitionBy("item").orderBy(F.desc("score"), F.asc("doc_id"))
    listed = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return listed.join(numbered.drop("bundle"), "item").select("item_id", "rank", "doc_id", "score")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


#: The same rows by SQL.
OP12_SQL = r"""
WITH low AS (
  SELECT doc_id AS id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
), words AS (
  SELECT id, unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM low
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), sizes AS (
  SELECT id, count(*) AS n FROM words GROUP BY id
), total AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes
), lists AS (
  SELECT id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY id, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
  FROM lists, total GROUP BY term, docs
), scored AS (
  SELECT item_id, l.id AS doc_id,
    CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // terms)))) AS BIGINT) AS score
  FROM asked a JOIN lists l USING (term) JOIN weights USING (term) JOIN sizes s ON s.id = l.id, total
  GROUP BY item_id, l.id
), placed AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT * FROM placed WHERE rank <= 50
"""
