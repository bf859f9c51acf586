"""Operator 6: byte-pair encoding by dynamic programming over prefixes, and decoding.

A run of merges leaves on every prefix of a piece exactly one last token. Tokens that end at a
place are the suffix matches of an automaton over the vocabulary; of those, the one that may
stand behind the last token of the prefix before it is the one sought. Two tokens may stand
side by side if no merge across their border comes before both are complete, which is read
off the merges that built them. Back-pointers from the end of the piece give the ids.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from titlespan.llm.common import documents, two_columns
from titlespan.llm.words import WordIds, default_path

#: Moves the last letter of a piece out of the way of the same letter inside one.
LAST = 0x1000
#: Remembered answers about pairs; more start the table anew.
KEPT_PAIRS = 400_000
NEVER = 1 << 30


class PrefixBpe:
    """Merges of one vocabulary: `merge(letters)` gives the ids of a piece."""

    def __init__(self, path: str):
        import ahocorasick

        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocabulary, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        self.rank: dict[tuple[int, int], int] = {}
        self.built = [-1] * (max(vocabulary.values()) + 1)
        self.halves = [(-1, -1)] * len(self.built)
        made = set()
        for at, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            token = vocabulary[left + right]
            self.rank[vocabulary[left], vocabulary[right]] = at
            if token not in made:
                made.add(token)
                self.built[token], self.halves[token] = at, (vocabulary[left], vocabulary[right])
        self.automaton = ahocorasick.Automaton()
        letters: dict[int, str] = {}
        for text, token in vocabulary.items():
            if token not in made:  # one letter, inside a piece or its last
                inner = text.removesuffix(suffix) if len(text) > 1 else text
                letters[token] = inner if inner == text else chr(ord(inner) + LAST)
        for token in sorted(made, key=self.built.__getitem__):
            left, right = self.halves[token]
            letters[token] = letters[left] + letters[right] if self._reached(token, letters) else ""
        for token, text in letters.items():
            if text:
                self.automaton.add_word(text, (token, len(text)))
        self.automaton.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}

    def _reached(self, token: int, letters: dict[int, str]) -> bool:
        """Whether the merges ever make this token: both halves, and nothing across before it."""
        left, right = self.halves[token]
        return bool(letters[left] and letters[right]) and self._apart(left, right, top=False)

    def _apart(self, left: int, right: int, top: bool = True) -> bool:
        """Whether the border between two tokens outlives their making.

        Undoes the later of the two sides' last merges, again and again; `left_ends` and
        `right_ends` say when the tokens now at the border were used up. Of two equal pairs
        the left one merges first.
        """
        left_ends = right_ends = NEVER
        while True:
            across = self.rank.get((left, right))
            if across is not None and top and across < left_ends and across <= right_ends:
                return False
            top = True
            made_left, made_right = self.built[left], self.built[right]
            if made_left < 0 and made_right < 0:
                return True
            if made_left > made_right:
                left_ends, left = made_left, self.halves[left][1]
            else:
                right_ends, right = made_right, self.halves[right][0]

    def _fits(self, left: int, right: int) -> bool:
        pair = left, right
        known = self.pairs.get(pair)
        if known is None:
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            known = self.pairs[pair] = self._apart(left, right)
        return known

    def merge(self, letters: str) -> list[int]:
        text = letters[:-1] + chr(ord(letters[-1]) + LAST)
        last: list[tuple[int, int]] = []  # by prefix: its last token and that token's length
        fits = self._fits
        for end, match in self.automaton.iter(text):
            if len(last) > end:
                continue  # this prefix has its token
            before = end - match[1]
            if before < 0 or fits(last[before][0], match[0]):
                last.append(match)
        ids, at = [], len(text) - 1
        while at >= 0:
            token, length = last[at]
            ids.append(token)
            at -= length
        return ids[::-1]


class Codec:
    """`encode(text)`: packed ids; `decode(ids)`: the text as the library gives it back."""

    def __init__(self, path: str):
        self.words = WordIds(path, PrefixBpe(path).merge)
        tokenizer = self.words.tokenizer
        if tokenizer.decoder is not None:
            raise ValueError("decoding is that of a vocabulary without a decoder: tokens and blanks")
        self.tokens = [tokenizer.id_to_token(i) for i in range(tokenizer.get_vocab_size())]

    def encode(self, text: str | None) -> bytes:
        return self.words.ids(text)

    def decode(self, ids: bytes) -> str:
        return " ".join(map(self.tokens.__getitem__, memoryview(ids).cast("I")))


@cache
def codec(path: str) -> Codec:
    """One for each Python worker."""
    return Codec(path)


def encode(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None
) -> DataFrame:
    """`(doc_id, ids)`, ids as little-endian unsigned 32-bit integers, one row per input row.

    A null, empty or white text has no ids. Ids of rows may be null or repeat; other columns are
    not looked at. No shuffle; memory is a batch of rows and bounded tables.
    """
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = codec(path).encode
        for batch in batches:
            ids = pa.array((work(t) for t in batch.column(1).to_pylist()), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    narrow = two_columns(docs, id_col, text_col)
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, ids binary")


def decode(
    coded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None
) -> DataFrame:
    """`(doc_id, text)` from packed ids; null ids give an empty text."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = codec(path).decode
        for batch in batches:
            texts = pa.array((work(i or b"") for i in batch.column(1).to_pylist()), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], ["doc_id", "text"])

    narrow = coded.selectExpr(f"`{id_col}` AS doc_id", f"`{ids_col}` AS ids")
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, text string")


def digests(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None
) -> DataFrame:
    """Encoding and decoding in one pass: `(doc_id, n_tokens, ids_sha256, decoded_sha256)`.

    The same two steps as `encode` and `decode`, without moving ids and decoded texts, several
    times the input, to the JVM and back.
    """
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = codec(path)
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            for text in batch.column(1):
                ids = work.encode(text.as_py())
                counts.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(work.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha), pa.array(text_sha)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    narrow = two_columns(docs, id_col, text_col)
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir))
