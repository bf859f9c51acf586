"""Operator 5: near-duplicates by MinHash, with sequential Bayesian verification.

Documents with the same words are one class, so copies are counted and never paired. Classes
that agree on a band of their signatures are candidates. A candidate pair's signatures are
compared batch by batch; after each the posterior of its similarity (uniform prior) says how
likely it still reaches the threshold, and below the miss probability it goes. Survivors are
verified on their full sets of shingles.

Only links between different components matter, so a bucket is first held against its least
member. Where that leaves a bucket in several components, its pairs across components are
compared, in blocks of bounded size: each block gives the strongest surviving pairs that would
tie its components together, one fewer than those at most. For members that are still apart and
have survivors, the block gets their full sets and gives the ties among the pairs that are links. So
no pairs leave a block but those, however large a group of near copies is and however close to the
threshold its pairs are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from titlespan.llm.common import documents, join_groups, quoted_name, two_columns, written
from titlespan.llm.links import components

WORDS = 5
PERCENT = 80
#: Hash functions at most, the chance that a pair at the threshold meets in no band, and the
#: posterior chance of similarity at which a pair is given up.
HASHES = 128
BAND_MISS = 1e-5
POSTERIOR_MISS = 1e-6
BATCH = 25
#: Members of a block in which a bucket's pairs are compared.
BLOCK = 512
#: Pairs whose signatures are compared at once, and shingles whose common documents are counted.
PAIRS = 1 << 16
COLUMNS = 2048
KEPT_WORDS = 300_000
SEED = 20

_ONE, _TWO = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def bands_of(percent: int) -> tuple[int, int]:
    """Bands and rows: the most rows a band may have for the chance of no common band to stay
    below `BAND_MISS` at the threshold."""
    t = percent / 100
    fitting = [r for r in range(1, 33) if (1 - t**r) ** (HASHES // r) <= BAND_MISS]
    rows = max(fitting, default=1)
    return HASHES // rows, rows


@cache
def least_matches(compared: int, percent: int) -> int:
    """Matches below which the posterior chance of similarity is under `POSTERIOR_MISS`.

    With a uniform prior the posterior after m matches of n is Beta(m + 1, n - m + 1), whose
    upper tail at t is the lower tail of a binomial of n + 1 trials.
    """
    t, tail = percent / 100, 0.0
    for m in range(compared + 1):
        tail += comb(compared + 1, m) * t**m * (1 - t) ** (compared + 1 - m)
        if tail >= POSTERIOR_MISS:
            return m
    return compared + 1


def words_of(text: str | None) -> list[bytes]:
    """Runs of anything but blank and U+0009 to U+000D, lower-cased in A-Z."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


@cache
def _word_hashes() -> _WordHashes:
    return _WordHashes()


@cache
def _multipliers(count: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(SEED)
    draw = random.integers(0, 1 << 63, (2, count), dtype=np.uint64)
    return draw[0] << np.uint64(1) | np.uint64(1), draw[1] << np.uint64(1)


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """The distinct hashes of a document's shingles, sorted; of all its words if they are fewer."""
    if not words:
        return np.empty(0, np.uint64)
    values = np.fromiter(map(_word_hashes().__getitem__, words), np.uint64, len(words))
    span = min(size, len(words))
    factors = _multipliers(span)[0]
    count = len(words) - span + 1
    mixed = values[:count] * factors[0]
    for i in range(1, span):
        mixed = mixed + values[i : i + count] * factors[i]
    mixed ^= mixed >> np.uint64(31)
    mixed *= _ONE
    mixed ^= mixed >> np.uint64(29)
    mixed *= _TWO
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def signature(hashes: np.ndarray, count: int) -> bytes:
    factors, offsets = _multipliers(64 + count)
    factors, offsets = factors[64:], offsets[64:]
    least = np.full(count, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), 1024):
        np.minimum(least, (hashes[i : i + 1024, None] * factors + offsets).min(axis=0), out=least)
    return (least >> np.uint64(32)).astype("<u4").tobytes()


def _text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def signed(docs: DataFrame, words: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """`(doc_id, text_hash, class, n_shingles, signature)`; class and signature are null without
    words."""
    bands, rows = bands_of(percent)
    count = bands * rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes, sizes, signatures = [], [], []
            with np.errstate(over="ignore"):
                for text in batch.column("text"):
                    own = words_of(text.as_py())
                    hashes = shingle_hashes(own, words)
                    sizes.append(len(hashes))
                    classes.append(
                        hashlib.blake2b(b" ".join(own), digest_size=16).digest() if own else None
                    )
                    signatures.append(signature(hashes, count) if own else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array(classes, pa.binary()),
                    pa.array(sizes, pa.int64()),
                    pa.array(signatures, pa.binary()),
                ],
                ["doc_id", "text_hash", "class", "n_shingles", "signature"],
            )

    narrow = two_columns(docs, id_col, text_col).withColumn("text_hash", _text_hash(F.col("text")))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(
        run,
        f"doc_id {kind}, text_hash long, class binary, n_shingles long, signature binary",
    )


def _matrix(column: pa.Array) -> np.ndarray:
    if not len(column):
        return np.empty((0, 1), "<u4")
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(len(column), -1)


def likely(
    left: np.ndarray, right: np.ndarray, percent: int, x: np.ndarray, y: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs survive all batches, the k-th being row `x[k]` of `left` and `y[k]` of `right`;
    and in how many places they agree."""
    alive = np.arange(len(x))
    matches = np.zeros(len(x), np.int64)
    for at in range(0, left.shape[1], BATCH):
        # Batches of columns behind each other in memory, so that a pair reads two short runs.
        one, other = (np.ascontiguousarray(m[:, at : at + BATCH]) for m in (left, right))
        matches = matches + (one[x[alive]] == other[y[alive]]).sum(axis=1)
        keep = matches >= least_matches(min(at + BATCH, left.shape[1]), percent)
        alive, matches = alive[keep], matches[keep]
        if not len(alive):
            break
    return alive, matches


def _star_survivors(pairs: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """`(a, b)` of `pairs` that survive the comparison of signatures."""
    a = signatures.select(F.col("class").alias("a"), F.col("signature").alias("of_a"))
    b = signatures.select(F.col("class").alias("b"), F.col("signature").alias("of_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_rows = np.arange(batch.num_rows)
            sides = [_matrix(batch.column(c)) for c in ("of_a", "of_b")]
            alive, _ = likely(*sides, percent, all_rows, all_rows)
            kept = batch.take(pa.array(alive))
            yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b")], ["a", "b"])

    joined = pairs.join(a, "a").join(b, "b").select("a", "b", "of_a", "of_b")
    return joined.mapInArrow(run, "a binary, b binary")


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list, list]]:
    """`((bucket, one, other), rows of the first block, rows of the second)` from sorted rows that
    begin with `bucket, one, other, block, class, component`; one list twice if they are one block."""

    def sides(key: tuple, rows: list) -> tuple[tuple, list, list]:
        first = [r for r in rows if r[0] == key[1]]
        return key, first, first if key[1] == key[2] else [r for r in rows if r[0] == key[2]]

    key, rows = None, []
    for batch in batches:
        for bucket, one, other, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (bucket, one, other) != key:
                if rows:
                    yield sides(key, rows)
                key, rows = (bucket, one, other), []
            rows.append(rest)
    if rows:
        yield sides(key, rows)


def _apart(first: list, second: list) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Pairs across components, and the components of both sides as numbers."""
    names: dict = {}
    numbers = [
        np.array([names.setdefault(r[2], len(names)) for r in side], np.int64) for side in (first, second)
    ]
    wanted = numbers[0][:, None] != numbers[1][None, :]
    if first is second:
        wanted = np.triu(wanted)
    return *np.nonzero(wanted), numbers


def _tying(i: np.ndarray, j: np.ndarray, strength: np.ndarray, numbers: list[np.ndarray]) -> Iterator[int]:
    """The strongest pairs that tie components together: fewer than there are components."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = up
        return x

    for k in np.argsort(-strength, kind="stable").tolist():
        one, other = root(int(numbers[0][i[k]])), root(int(numbers[1][j[k]]))
        if one != other:
            parent[one] = other
            yield k


def _survivors(first: list, second: list, percent: int):
    """Pairs across components whose signatures, the rows' last cells, survive."""
    i, j, numbers = _apart(first, second)
    left, right = (
        np.frombuffer(b"".join(r[3] for r in side), "<u4").reshape(len(side), -1) for side in (first, second)
    )
    kept = [
        (at + alive, strength)
        for at in range(0, len(i), PAIRS)
        for alive, strength in [likely(left, right, percent, i[at : at + PAIRS], j[at : at + PAIRS])]
    ]
    alive, strength = (np.concatenate(p) for p in zip(*kept, strict=True)) if kept else (i[:0], i[:0])
    return i[alive], j[alive], strength, numbers


def _dealt(members: DataFrame) -> DataFrame:
    return members.repartition("bucket", "one", "other").sortWithinPartitions("bucket", "one", "other")


def _pairs_out(found: Iterator[tuple[bytes, bytes]]) -> Iterator[pa.RecordBatch]:
    held: set = set()
    for pair in found:
        held.add(pair)
        if len(held) >= 5000:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*held, strict=True)], ["a", "b"])
            held = set()
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*held, strict=True)], ["a", "b"])


def _ties(members: DataFrame, percent: int) -> DataFrame:
    """`(a, b)`: of every block pair the strongest surviving pairs that tie its components together;
    `members` has `(bucket, one, other, block, class, component, signature)`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple[bytes, bytes]]:
            for _, first, second in _by_block(batches):
                if first and second:
                    i, j, strength, numbers = _survivors(first, second, percent)
                    for k in _tying(i, j, strength, numbers):
                        yield first[i[k]][1], second[j[k]][1]

        yield from _pairs_out(found())

    return _dealt(members).mapInArrow(run, "a binary, b binary")


def _in_question(members: DataFrame, percent: int) -> DataFrame:
    """The members of block pairs that have a surviving pair across components: rows as in
    `_ties`, without signatures."""
    names = ["bucket", "one", "other", "block", "class", "component"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary(), pa.binary()]
        for key, first, second in _by_block(batches):
            if not first or not second:
                continue
            i, j, _, _ = _survivors(first, second, percent)
            if first is second:
                some = [first[k] for k in np.union1d(i, j)]
            else:
                some = [first[k] for k in np.unique(i)] + [second[k] for k in np.unique(j)]
            if some:
                columns = zip(*((*key, *row[:3]) for row in some), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
                )

    schema = "bucket long, one string, other string, block string, class binary, component binary"
    return _dealt(members).mapInArrow(run, schema)


def _exact_ties(members: DataFrame, percent: int) -> DataFrame:
    """`(a, b)`: of every block pair the most similar pairs that are links, as far as they tie its
    components together; as `_ties`, with the sets of shingle hashes instead of signatures."""

    def similar(first: list, second: list):
        i, j, numbers = _apart(first, second)
        rows = first if first is second else first + second
        sets = [np.frombuffer(r[3], np.uint64) for r in rows]
        sizes = np.array([len(x) for x in sets])
        _, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(len(rows)), sizes)
        shared = count[at] > 1
        columns = np.cumsum(count > 1) - 1
        at, owner = columns[at[shared]], owner[shared]
        order = np.argsort(at, kind="stable")
        at, owner = at[order], owner[order]
        common = np.zeros((len(rows), len(rows)), np.float32)
        for low in range(0, int(at[-1]) + 1 if len(at) else 0, COLUMNS):
            part = slice(*np.searchsorted(at, [low, low + COLUMNS]))
            has = np.zeros((len(rows), COLUMNS), np.float32)
            has[owner[part], at[part] - low] = 1
            common += has @ has.T
        shift = 0 if first is second else len(first)
        both = common[i, j + shift].astype(np.int64)
        union = sizes[i] + sizes[j + shift] - both
        linked = 100 * both >= percent * union
        return i[linked], j[linked], (both / union)[linked], numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple[bytes, bytes]]:
            for _, first, second in _by_block(batches):
                if first and second:
                    i, j, strength, numbers = similar(first, second)
                    for k in _tying(i, j, strength, numbers):
                        yield first[i[k]][1], second[j[k]][1]

        yield from _pairs_out(found())

    return _dealt(members).mapInArrow(run, "a binary, b binary")


def _sets(texts: DataFrame, words: int) -> DataFrame:
    """`(class, hashes)`: the full set of a class's shingles, as hashes of 64 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            with np.errstate(over="ignore"):
                sets = [shingle_hashes(words_of(t.as_py()), words).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("class"), pa.array(sets, pa.binary())], ["class", "hashes"])

    return texts.select("class", "text").mapInArrow(run, "class binary, hashes binary")


def _verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """`(a, b)` whose full shingle sets reach the threshold."""

    def shingles(text: str) -> set:
        own = words_of(text)
        if len(own) < words:
            return {tuple(own)}
        return set(zip(*(own[i:] for i in range(words)), strict=False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, of_last = None, set()
        for batch in batches:
            kept = []
            rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            for i, (a, b, text_a, text_b) in enumerate(rows):
                if b != last:
                    last, of_last = b, shingles(text_b)
                own = shingles(text_a)
                common = len(own & of_last)
                if 100 * common >= percent * (len(own) + len(of_last) - common):
                    kept.append(i)
            taken = batch.take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays([taken.column("a"), taken.column("b")], ["a", "b"])

    a = texts.select(F.col("class").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("class").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(run, "a binary, b binary")


def linked(
    docs: DataFrame, words: int, percent: int, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """The written rows of `signed` without signatures, and for every class its component:
    `(class, size, component_id, keep_id, keep_hash)`, the smallest id and the row that stays."""
    bands, rows = bands_of(percent)
    all_rows = written(signed(docs, words, percent, id_col, text_col), "near-signed")
    # A class's row: a known id before a null one, the smallest first.
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "signature"))
    classes = written(
        all_rows.filter("class IS NOT NULL").groupBy("class").agg(best.alias("best"), F.count("*").alias("size"))
        .selectExpr("class", "size", "best.doc_id", "best.text_hash", "best.signature"),
        "near-classes",
    )
    band = f"transform(sequence(0, {bands - 1}), i -> xxhash64(i, substring(signature, i * {4 * rows} + 1, {4 * rows})))"
    places = classes.select("class", F.explode(F.expr(band)).alias("bucket"))
    buckets = places.groupBy("bucket").agg(F.min("class").alias("head"), F.count("*").alias("members"))
    buckets = written(buckets.filter("members > 1"), "near-buckets")
    members = written(places.join(buckets, "bucket"), "near-members")

    in_question = members.select("class").distinct()
    signatures = written(classes.select("class", "signature").join(in_question, "class", "left_semi"), "near-asked")
    # Each class is held against the least member it meets most often.
    meetings = members.filter("class <> head").groupBy("class", "head").agg(F.count("*").alias("n"))
    stars = meetings.groupBy(F.col("class").alias("a")).agg(
        F.max_by("head", F.struct("n", "head")).alias("b")
    )
    survivors = written(_star_survivors(stars, signatures, percent), "near-stars")

    texts = _texts(docs, classes, survivors, id_col, text_col)
    links = written(_verified(survivors, texts, words, percent), "near-links")
    first = written(components(links), "near-first")

    def asked(components_now: DataFrame) -> DataFrame:
        blocked = written(_blocked(written(_split(members, components_now), "near-split")), "near-blocked")
        return blocked.join(signatures, "class").select(
            "bucket", "one", "other", "block", "class", "component", "signature"
        )

    def with_links(more: DataFrame) -> tuple[DataFrame, DataFrame]:
        own = _texts(docs, classes, more, id_col, text_col)
        all_links = links.union(written(_verified(more, own, words, percent), "near-links"))
        return all_links, written(components(all_links), "near-components")

    # The strongest pairs of what is apart; then exact ties among all that may be similar.
    now = first
    more = written(_ordered(_ties(asked(now), percent)).join(survivors, ["a", "b"], "left_anti"), "near-ties")
    if more.limit(1).count():
        links, now = with_links(more)
    question = written(_in_question(asked(now), percent), "near-question")
    if question.limit(1).count():
        own = _texts(docs, classes, question.selectExpr("class AS a", "class AS b"), id_col, text_col)
        full = question.join(written(_sets(own, words), "near-sets"), "class").select(
            "bucket", "one", "other", "block", "class", "component", "hashes"
        )
        more = written(_ordered(_exact_ties(full, percent)), "near-ties")
        links, now = with_links(more)

    known = now.select(F.col("node").alias("class"), F.col("component").alias("root"))
    rooted = classes.drop("signature").join(known, "class", "left").withColumn("root", F.coalesce("root", "class"))
    rooted = written(rooted, "near-rooted")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("best")
    roots = rooted.groupBy("root").agg(least).selectExpr(
        "root", "best.doc_id AS component_id", "best.text_hash AS keep_hash"
    )
    found = rooted.select("class", "size", "root").join(written(roots, "near-roots"), "root").drop("root")
    return all_rows.drop("signature"), written(found, "near-found")


def _ordered(pairs: DataFrame) -> DataFrame:
    """Each pair once, the larger class first."""
    return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _split(members: DataFrame, components_now: DataFrame) -> DataFrame:
    """`(bucket, class, component)` of the buckets that lie in several components."""
    known = components_now.select(F.col("node").alias("class"), "component")
    placed = members.join(known, "class", "left").select(
        "bucket", "class", F.coalesce("component", "class").alias("component")
    )
    placed = written(placed, "near-placed")
    split = placed.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return placed.join(split.filter("low <> high").select("bucket"), "bucket", "left_semi")


def _blocked(placed: DataFrame) -> DataFrame:
    """Members once for every pair of blocks they are compared in: `(bucket, one, other, block,
    class, component)`.

    A component with a block's worth of members has blocks of its own, which are not compared
    with each other; the small ones share blocks.
    """
    counted = placed.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    large = F.col("n") >= BLOCK
    sized = counted.withColumn("team", F.when(large, F.xxhash64("component")).otherwise(F.lit(0)))
    teams = sized.groupBy("bucket", "team").agg(F.sum("n").alias("n"))
    teams = teams.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    listed = written(
        teams.select("bucket", "team", "blocks", F.explode(F.expr("sequence(0, blocks - 1)")).alias("part")),
        "near-teams",
    )
    name = F.struct("team", "part")
    one = listed.select("bucket", name.alias("one"))
    other = listed.select("bucket", name.alias("other"))
    pairs = one.join(other, "bucket").filter(
        "one <= other AND (one.team <> other.team OR one.team = 0)"
    )
    sides = pairs.select("bucket", "one", "other", F.col("one").alias("block")).union(
        pairs.filter("one <> other").select("bucket", "one", "other", F.col("other").alias("block"))
    )
    own = placed.join(sized.select("bucket", "component", "team"), ["bucket", "component"])
    own = own.join(teams.select("bucket", "team", "blocks"), ["bucket", "team"]).select(
        "bucket", "class", "component",
        F.struct("team", F.expr("pmod(xxhash64(class), blocks)").cast("int").alias("part")).alias("block"),
    )
    label = "concat(hex({0}.team), '-', {0}.part)"
    return own.join(sides, ["bucket", "block"]).select(
        "bucket",
        *[F.expr(label.format(c)).alias(c) for c in ("one", "other", "block")],
        "class",
        "component",
    )


def _texts(docs: DataFrame, classes: DataFrame, pairs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The written `(class, text)` of the classes in `pairs`."""
    needed = pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct()
    wanted = classes.join(needed, "class", "left_semi").select(
        "class", F.col("doc_id").alias("key"), F.col("text_hash").alias("key_hash")
    )
    full = two_columns(docs, id_col, text_col).withColumn("text_hash", _text_hash(F.col("text")))
    found = full.join(
        wanted, (F.col("text_hash") == F.col("key_hash")) & F.col("doc_id").eqNullSafe(F.col("key"))
    )
    return written(found.select("class", "text").dropDuplicates(["class"]), "near-texts")


def near_dedup(
    docs: DataFrame,
    words: int = WORDS,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """`(doc_id, n_shingles, component_id, kept)`, one row per input row.

    Documents are linked if their sets of `words`-word shingles share at least `percent` per
    cent of their union; `component_id` is the smallest id reachable by links. Null, empty and
    blank texts have no shingles, are linked with nothing and stay. Rows that repeat id and text
    are listed each; a null id is no smallest id unless all are null. Very long texts have as many
    shingles as they have. Other columns are not looked at; an empty table gives no rows.
    """
    rows, found = linked(docs, words, percent, id_col, text_col)
    wordless = rows.filter("class IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    worded = join_groups(rows.filter("class IS NOT NULL"), found, "class", "size")
    both = worded.select("doc_id", "n_shingles", "component_id").union(wordless)
    return both.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(documents(spark, sf_dir), words=3, percent=85)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates, with all its columns, and all those
    without words. Of rows that repeat id and text one stays; an empty table stays empty."""
    _, found = linked(docs, WORDS, PERCENT)
    keepers = found.select("component_id", "keep_hash").distinct()
    keyed = docs.select(
        F.struct(*map(quoted_name, docs.columns)).alias("row"),
        F.col("doc_id").alias("key"),
        _text_hash(F.col("text")).alias("key_hash"),
        (~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")).alias("wordless"),
    )
    stays = keyed.filter(~F.col("wordless")).join(
        keepers,
        (F.col("key_hash") == F.col("keep_hash")) & F.col("key").eqNullSafe(F.col("component_id")),
        "left_semi",
    )
    once = stays.dropDuplicates(["key", "key_hash"])
    return once.select("row.*").union(keyed.filter("wordless").select("row.*"))
