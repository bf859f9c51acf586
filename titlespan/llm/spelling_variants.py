"""Spelling variants: words one edit apart, grouped under their most frequent forms.

Pairs are found by asymmetric chunks. Taken as the one side, a word contributes its two disjoint
halves; taken as the other, its positional grams as long as such a chunk. One edit leaves one of
the two chunks whole: the first one where it was, or the second one shifted by the difference of
lengths, nought or one. So the other side need only write the grams at those places, and every
pair of words one edit apart shares a chunk and its place. What shares one is verified.

A chunk that would give more than `KEY_PAIRS` pairs is not joined: the part of the word beside the
chunk is cut into two chunks in its turn, and so on, until few enough words share all that is
kept or a single letter is left open, where the alphabet bounds them.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titlespan.llm.common import documents, join_groups, two_columns, written

#: Pairs that a key may give before it is cut further.
KEY_PAIRS = 100
#: Words a task counts before it hands them on. Bounds memory, never results.
HELD_WORDS = 400_000

#: Bytes of Latin-1 that belong to a run, A-Z as a-z; all others are blanks.
_LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0xC0 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)


def runs_of(text: str | None) -> list[bytes]:
    """The maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased, in Latin-1."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split() if text else []


def thinned(run: bytes, start: int, every: int) -> bytes:
    """The run, or, if the checksum of its UTF-8 that goes on from `start` divides by `every`,
    the run without the letter at the checksum modulo its length."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = 5,
    min_count: int = 3,
    thin: int | None = None,
) -> DataFrame:
    """`(word, n)` of the words with enough letters and occurrences in all texts.

    With `thin` a letter is taken out of the runs for which it divides the checksum of
    `<id>:<run>`, by document (a null id reads `null`). Each task counts before the shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def handed() -> pa.RecordBatch:
            words = [w.decode("latin-1") for w in counts]
            columns = [pa.array(words, pa.string()), pa.array(list(counts.values()), pa.int64())]
            counts.clear()
            return pa.RecordBatch.from_arrays(columns, ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = Counter(runs_of(text))
                start = zlib.crc32(f"{'null' if doc_id is None else doc_id}:".encode())
                for word, n in own.items():
                    if thin:
                        word = thinned(word, start, thin)
                    if len(word) >= min_length:
                        counts[word] += n
                if len(counts) > HELD_WORDS:
                    yield handed()
        yield handed()

    counted = two_columns(docs, id_col, text_col).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _open_parts(words: DataFrame) -> DataFrame:
    """Both sides of every word with the whole word open: `(word, n, d, at, m)`.

    `at` and `m` are start and length of the open part in the shorter word. `d` is null on the
    side of the chunks; on the side of the grams it is how many letters this word is longer.
    """
    side = F.explode(F.expr("array(CAST(NULL AS INT), 0, 1)")).alias("d")
    sides = words.select("word", "n", side)
    return sides.select(
        "*", F.lit(0).alias("at"), F.expr("length(word) - coalesce(d, 0)").alias("m")
    ).filter("m > 0")


def _halved(parts: DataFrame) -> DataFrame:
    """Each open part is cut into two chunks, and either of them stays open: `key` is what is kept."""
    halves = "array(struct(at, m div 2 AS m), struct(at + m div 2 AS at, m - m div 2 AS m))"
    cut = parts.select("word", "n", "d", F.expr(f"explode({halves})").alias("o"))
    kept = (
        "concat_ws(':', length(word) - coalesce(d, 0), o.at, o.m, "
        "substr(word, 1, o.at), substr(word, CAST(o.at + o.m AS INT) + coalesce(d, 0) + 1))"
    )
    return cut.select(
        "word", "n", "d", F.col("o.at").cast("int").alias("at"), F.col("o.m").cast("int").alias("m"),
        F.expr(kept).alias("key"),
    )


def near_pairs(words: DataFrame, key_pairs: int = KEY_PAIRS) -> DataFrame:
    """`(a, a_n, b, b_n)`: the pairs of `words(word, n)` that differ by exactly one inserted,
    deleted or replaced code point, each once; `a` is the shorter or, of equal length, the smaller."""
    found: list[DataFrame] = []
    parts = _open_parts(words)
    while True:
        keyed = written(_halved(parts), "variants-keys")
        sizes = keyed.groupBy("key").agg(
            F.count_if(F.col("d").isNull()).alias("chunks"),
            F.count("d").alias("grams"),
            F.count("*").alias("rows"),
            F.first("m").alias("open"),
        )
        shared = written(sizes.filter("chunks > 0 AND grams > 0 AND rows > 2"), "variants-shared")
        # A key without both sides, or with the two sides of one word alone, gives no pair.
        crowded = F.expr(f"chunks * grams > {key_pairs} AND open > 1")
        marked = written(
            join_groups(keyed, shared, "key", "rows")
            .filter("chunks IS NOT NULL")
            .select("word", "n", "d", "at", "m", "key", crowded.alias("crowded")),
            "variants-marked",
        )
        few = marked.filter("NOT crowded")
        chunks = few.filter("d IS NULL").select("key", F.col("word").alias("a"), F.col("n").alias("a_n"))
        grams = few.filter("d IS NOT NULL").select("key", "d", F.col("word").alias("b"), F.col("n").alias("b_n"))
        joined = chunks.join(grams, "key").filter("(d = 1 OR a < b) AND levenshtein(a, b, 1) = 1")
        found.append(written(joined.select("a", "a_n", "b", "b_n"), "variants-pairs"))
        parts = marked.filter("crowded").select("word", "n", "d", "at", "m")
        if parts.isEmpty():
            return reduce(DataFrame.union, found).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """`(word, root)` for `forms(word, form)`: forms are followed to the last one, twice as far in
    every round. A form is always more frequent than its word, so there are no circles."""
    now = written(forms.select("word", F.col("form").alias("root")), "variants-roots")
    while True:
        on = now.select(F.col("word").alias("there"), F.col("root").alias("further"))
        step = now.join(on, now["root"] == on["there"], "left")
        after = written(
            step.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
            "variants-roots",
        )
        now = after.select("word", "root")
        if after.filter("moved").isEmpty():
            return now


def grouped(words: DataFrame, key_pairs: int = KEY_PAIRS) -> DataFrame:
    """`(word, form, root, n, n_near, form_n)` for `words(word, n)`, one row per word.

    A word's form is its near word of largest n (ties: the smallest in code-point order), if that
    has at least twice the word's n, else null; the root is the last form, or the word itself.
    """
    pairs = written(near_pairs(words, key_pairs), "variants-near")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).union(
        pairs.select("b", "a", "a_n")
    )
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    chosen = F.expr("-best.less >= 2 * n")
    formed = written(
        words.join(best, "word", "left").select(
            "word",
            F.when(chosen, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(chosen, -F.col("best.less")).alias("form_n"),
        ),
        "variants-forms",
    )
    roots = _roots(formed.filter("form IS NOT NULL").select("word", "form"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = 5,
    min_count: int = 3,
    thin: int | None = None,
    key_pairs: int = KEY_PAIRS,
) -> DataFrame:
    """`grouped` over the words of whole texts.

    Null and empty texts have no words. Rows count as often as they stand in the table. Words of
    any length are compared whole. An empty table, or one without frequent words, gives no rows;
    other columns are not looked at.
    """
    words = written(word_counts(docs, id_col, text_col, min_length, min_count, thin), "variants-words")
    return grouped(words, key_pairs)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(documents(spark, sf_dir), thin=97)


#: The same rows by SQL, with the checksum spelled out.
OP13_SQL = r"""
WITH RECURSIVE byte AS (
  SELECT list(list_reduce([i::UBIGINT] || list_value(0, 0, 0, 0, 0, 0, 0, 0)::UBIGINT[],
    lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) ORDER BY i) AS crc
  FROM range(256) r(i)
), runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
), own AS (
  SELECT doc_id, run, count(*) AS n, hex(coalesce(doc_id::VARCHAR, 'null') || ':' || run) AS x FROM runs GROUP BY doc_id, run
), hashed AS (
  SELECT run, n, xor(list_reduce([4294967295::UBIGINT] ||
      list_transform(range(1, length(x) // 2 + 1), lambda i: ('0x' || substr(x, 2 * i - 1, 2))::UBIGINT),
      lambda c, b: xor(c >> 8, crc[1 + (xor(c, b) & 255::UBIGINT)::INT])), 4294967295::UBIGINT) AS h
  FROM own, byte
), words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 97 = 0
      THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n
    FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), less AS (
  SELECT word, n, i, substr(word, 1, i::INT - 1) || substr(word, i::INT + 1) AS rest
  FROM words, LATERAL (SELECT unnest(range(1, length(word) + 1)) AS i)
), near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT l.word, w.word, w.n FROM less l JOIN words w ON l.rest = w.word
  UNION SELECT w.word, l.word, l.n FROM less l JOIN words w ON l.rest = w.word
), best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other COLLATE "C") AS other, max(other_n) AS other_n
  FROM near GROUP BY word
), formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN other_n >= 2 * w.n THEN other END AS form, CASE WHEN other_n >= 2 * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN best b USING (word)
), chain AS (
  SELECT word, word AS root FROM formed
  UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON c.root = f.word WHERE f.form IS NOT NULL
), last AS (
  SELECT c.word, c.root FROM chain c JOIN formed f ON c.root = f.word WHERE f.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN last USING (word)
"""
