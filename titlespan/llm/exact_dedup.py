"""Operator 7: exact duplicates over immutable snapshots, screened by binary-fuse filters.

Documents arrive in loads. A load becomes a snapshot that never changes: its distinct digests in
buckets, each with its text, and for each bucket a static filter. The digests of the next load
are grouped among themselves first, so a digest asks once however many rows share it. They
meet the filters of their buckets; what a filter does not know is new. What it may know
joins the exact buckets, where the texts themselves are compared. Bits of the filters are
never the last word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titlespan.llm.common import ascii_lower, documents, join_groups, quoted_name, two_columns, written

LOADS = 2
#: Digests of a bucket on average; fixes the number of buckets, and so a filter's memory.
BUCKET_ROWS = 500_000

_MIX = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = keys + np.uint64((seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * _MIX
        x = (x ^ (x >> np.uint64(27))) * _MIX2
        return x ^ (x >> np.uint64(31))


class FuseFilter:
    """A static 3-wise binary-fuse filter with 16-bit prints: no false negatives, about one false
    positive in 65,536. Slots of a key lie in three neighbouring segments."""

    def __init__(self, seed: int, segment: int, segments: int, prints: np.ndarray):
        self.seed, self.segment, self.segments, self.prints = seed, segment, segments, prints

    @staticmethod
    def _slots(mixed: np.ndarray, segment: int, segments: int) -> np.ndarray:
        mask = np.uint64(segment - 1)
        first = ((mixed >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
        within = [mixed & mask, (mixed >> np.uint64(14)) & mask, (mixed >> np.uint64(28)) & mask]
        return np.stack([(first + np.uint64(i)) * np.uint64(segment) + w for i, w in enumerate(within)])

    @staticmethod
    def _prints(mixed: np.ndarray) -> np.ndarray:
        return ((mixed * _MIX2) >> np.uint64(48)).astype(np.uint16)

    @classmethod
    def build(cls, keys: np.ndarray) -> FuseFilter:
        keys = np.unique(keys.astype(np.uint64))
        n = len(keys)
        segment = 1 << max(2, min(14, int(np.log(max(n, 2)) / np.log(3.33) + 2.25)))
        room = 1.125 if n > 100_000 else 1.25 + 8 / max(n, 1) ** 0.5
        segments = max(1, int(np.ceil(n * room / segment)))
        for seed in range(1, 200):
            with np.errstate(over="ignore"):
                order = cls._peeled(keys, seed, segment, segments)
            if order is not None:
                return cls._filled(keys, seed, segment, segments, order)
            if seed % 5 == 0:
                segments += max(1, segments // 8)
        raise RuntimeError("no filter found")

    @classmethod
    def _peeled(cls, keys, seed, segment, segments):
        """Rounds of (keys, their free slots): a slot of one key only frees that key."""
        slots = cls._slots(_mixed(keys, seed), segment, segments).astype(np.int64)
        size = segment * (segments + 2)
        counts = np.bincount(slots.ravel(), minlength=size)
        sums = np.zeros(size, np.int64)
        for row in slots:
            np.add.at(sums, row, np.arange(len(keys)))
        rounds, left = [], len(keys)
        single = np.flatnonzero(counts == 1)
        while left and len(single):
            freed, at = np.unique(sums[single], return_index=True)
            free = single[at]
            rounds.append((freed, free))
            left -= len(freed)
            touched = slots[:, freed]
            for row in touched:
                np.subtract.at(counts, row, 1)
                np.subtract.at(sums, row, freed)
            near = np.unique(touched)
            single = near[counts[near] == 1]
        return None if left else rounds

    @classmethod
    def _filled(cls, keys, seed, segment, segments, rounds):
        mixed = _mixed(keys, seed)
        slots = cls._slots(mixed, segment, segments).astype(np.int64)
        with np.errstate(over="ignore"):
            want = cls._prints(mixed)
        prints = np.zeros(segment * (segments + 2), np.uint16)
        for freed, free in reversed(rounds):
            three = slots[:, freed]
            prints[free] = 0
            prints[free] = want[freed] ^ prints[three[0]] ^ prints[three[1]] ^ prints[three[2]]
        return cls(seed, segment, segments, prints)

    def knows(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            mixed = _mixed(keys.astype(np.uint64), self.seed)
            slots = self._slots(mixed, self.segment, self.segments).astype(np.int64)
            found = self.prints[slots[0]] ^ self.prints[slots[1]] ^ self.prints[slots[2]]
            return found == self._prints(mixed)

    def to_bytes(self) -> bytes:
        head = np.array([self.seed, self.segment, self.segments], "<u4").tobytes()
        return head + self.prints.astype("<u2").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> FuseFilter:
        seed, segment, segments = np.frombuffer(data, "<u4", 3).tolist()
        return cls(seed, segment, segments, np.frombuffer(data, "<u2", offset=12))


def _keys(digests: pa.Array) -> np.ndarray:
    """The first eight bytes of each digest."""
    return np.array([int.from_bytes(d[:8], "little") for d in digests.to_pylist()], np.uint64)


def digested(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`(doc_id, text, digest)`: the text lower-cased in A-Z only, null as empty; its sha256."""
    text = ascii_lower(F.coalesce(F.col("text"), F.lit("")))
    rows = two_columns(docs, id_col, text_col).withColumn("text", text)
    return rows.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))


class Snapshot:
    """`exact(bucket, digest, keep_id, n, text)` and `filters(bucket, filter)`, both written."""

    def __init__(self, exact: DataFrame, filters: DataFrame, buckets: int):
        self.exact, self.filters, self.buckets = exact, filters, buckets


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int")


def snapshot(rows: DataFrame, groups: DataFrame) -> Snapshot:
    """An immutable snapshot of `digested` rows; `groups` are their groups by digest.

    The text of a group is that of its largest id, fetched by one join on it.
    """
    buckets = max(1, -(-groups.count() // BUCKET_ROWS))
    chosen = groups.select("digest", "keep_id", "n")
    texts = (
        rows.join(
            chosen.hint("shuffle_merge"),
            (rows["digest"] == chosen["digest"]) & rows["doc_id"].eqNullSafe(chosen["keep_id"]),
        )
        .select(chosen["digest"], "keep_id", "n", "text")
        .dropDuplicates(["digest"])  # rows that repeat id and text
    )
    exact = written(texts.withColumn("bucket", _bucket(buckets)), "dedup-exact")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One bucket after another: the rows are sorted by it.
        bucket, keys = None, []
        for batch in batches:
            numbers, found = batch.column(0).to_numpy(zero_copy_only=False), _keys(batch.column(1))
            for number in np.unique(numbers).tolist():
                if number != bucket and keys:
                    yield made(bucket, keys)
                    keys = []
                bucket = number
                keys.append(found[numbers == number])
        if keys:
            yield made(bucket, keys)

    def made(bucket: int, keys: list[np.ndarray]) -> pa.RecordBatch:
        data = FuseFilter.build(np.concatenate(keys)).to_bytes()
        return pa.RecordBatch.from_arrays(
            [pa.array([bucket], pa.int32()), pa.array([data], pa.binary())], ["bucket", "filter"]
        )

    sorted_rows = exact.select("bucket", "digest").repartition("bucket").sortWithinPartitions("bucket")
    filters = written(sorted_rows.mapInArrow(build, "bucket int, filter binary"), "dedup-filters")
    return Snapshot(exact, filters, buckets)


def screened(groups: DataFrame, known: Snapshot) -> DataFrame:
    """`groups` of a load whose digest the snapshot's filters may know.

    A digest stands in `groups` once, so a bucket holds about `BUCKET_ROWS` times the loads'
    ratio of them, whatever the rows behind a digest.
    """

    kind = groups.schema["keep_id"].dataType.simpleString()
    asked = groups.select("digest", "keep_id", "n").withColumn("bucket", _bucket(known.buckets))

    def together(left: pa.Table, right: pa.Table) -> pa.Table:
        columns = ["digest", "keep_id", "n"]
        if not left.num_rows or not right.num_rows:
            return left.select(columns).slice(0, 0)
        fuse = FuseFilter.from_bytes(right.column("filter")[0].as_py())
        keys = _keys(left.column("digest").combine_chunks())
        return left.select(columns).filter(pa.array(fuse.knows(keys)))

    return (
        asked.groupBy("bucket")
        .cogroup(known.filters.groupBy("bucket"))
        .applyInArrow(together, f"digest binary, keep_id {kind}, n long")
    )


def _grouped(rows: DataFrame) -> DataFrame:
    """`(digest, keep_id, n)`, summed before the shuffle."""
    return rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("n"))


def groups_of(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", loads: int = LOADS
) -> tuple[DataFrame, DataFrame]:
    """The written narrow rows `(load, doc_id, digest)` and groups `(digest, keep_id, n)`.

    The table is taken as `loads` loads, dealt by a hash of the id; each one but the last leaves
    a snapshot that the later ones are held against.
    """
    full = digested(docs, id_col, text_col).withColumn(
        "load", F.pmod(F.xxhash64("doc_id"), F.lit(loads)).cast("int")
    )
    rows = written(full.select("load", "doc_id", "digest"), "dedup-rows")
    kept: DataFrame | None = None
    snapshots: list[Snapshot] = []
    for load in range(loads):
        own = written(_grouped(rows.filter(F.col("load") == load)), "dedup-load")
        texts = full.filter(F.col("load") == load).select("doc_id", "text", "digest")
        met = own.withColumn("seen", F.lit(False)).limit(0)
        for known in snapshots:
            met = met.unionByName(confirmed(screened(own, known), texts, known))
        # A group already in an earlier load adds its rows there; the keeper is the largest id.
        merged = own if kept is None else _merged(kept, own, met)
        kept = written(merged, "dedup-groups")
        if load + 1 < loads:
            fresh = own.join(met.select("digest"), "digest", "left_anti") if snapshots else own
            snapshots.append(snapshot(texts, fresh))
    return rows, kept


def confirmed(maybe: DataFrame, texts: DataFrame, known: Snapshot) -> DataFrame:
    """Those groups that the snapshot does hold: the texts, byte by byte, are the same.

    Two texts of one digest that differ would be an error of the digest; the job then fails
    instead of losing a document.
    """
    asked = maybe.select("digest", F.col("keep_id").alias("asked_id"), "n")
    own = (
        texts.join(
            asked,
            (texts["digest"] == asked["digest"]) & texts["doc_id"].eqNullSafe(asked["asked_id"]),
        )
        .select(asked["digest"], F.col("asked_id").alias("keep_id"), "n", "text")
        .dropDuplicates(["digest"])
    )
    exact = known.exact.select(F.col("digest").alias("there"), F.col("text").alias("text_there"))
    same = F.col("text").cast("binary") == F.col("text_there").cast("binary")
    return (
        own.join(exact, own["digest"] == exact["there"])
        .withColumn("seen", F.when(same, True).otherwise(F.raise_error(F.lit("digest collision")).cast("boolean")))
        .filter("seen")
        .select("digest", "keep_id", "n", "seen")
    )


def _merged(kept: DataFrame, own: DataFrame, met: DataFrame) -> DataFrame:
    """Groups after a load: those met grow, the others of the load are new ones."""
    new = own.join(met.select("digest"), "digest", "left_anti")
    both = kept.unionByName(met.drop("seen")).unionByName(new)
    return both.groupBy("digest").agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("n"))


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", loads: int = LOADS
) -> DataFrame:
    """`(doc_id, keep_id, group_size, kept, text_sha256)`, one row per input row.

    Texts are equal if they are after lower-casing A-Z; null is empty. The largest id of a
    group stays (a null id only if there is no other). Rows that repeat id and text are copies:
    one of them stays. Texts of any length are digested and compared whole. An empty table gives
    no rows; other columns are not looked at.
    """
    rows, groups = groups_of(docs, id_col, text_col, loads)
    copies = written(rows.groupBy("doc_id", "digest").agg(F.count("*").alias("copies")), "dedup-copies")
    all_rows = join_groups(copies, groups, "digest", "n")
    return all_rows.select(
        "doc_id", "keep_id", "n", "digest", F.explode(F.expr("sequence(1L, copies)")).alias("copy")
    ).select(
        "doc_id",
        "keep_id",
        F.col("n").alias("group_size"),
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


#: The same rows by SQL.
OP7_SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
)
SELECT doc_id,
  max(doc_id) OVER (PARTITION BY t) AS keep_id,
  count(*) OVER (PARTITION BY t) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY t) AS kept,
  sha256(t) AS text_sha256
FROM d
"""


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal texts, with all its columns.

    The join key holds the id besides the digest, so a large group of copies is spread.
    """
    _, groups = groups_of(docs)
    keepers = groups.select("keep_id", F.col("digest").alias("keep_digest"))
    digest = F.unhex(F.sha2(ascii_lower(F.coalesce(F.col("text"), F.lit(""))).cast("binary"), 256))
    keyed = docs.select(
        F.struct(*map(quoted_name, docs.columns)).alias("row"), F.col("doc_id").alias("key"), digest.alias("digest")
    )
    stays = keyed.join(
        keepers,
        (keyed["digest"] == keepers["keep_digest"]) & keyed["key"].eqNullSafe(keepers["keep_id"]),
        "left_semi",
    )
    return stays.dropDuplicates(["key", "digest"]).select("row.*")
