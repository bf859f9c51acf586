"""Operator 9: token counts under a unigram vocabulary, by dynamic programming over a trie.

A pre-token is a run of anything but white space behind the vocabulary's blank mark. Its tokens
are those of the segmentation with the best sum of log probabilities. The distinct new pre-tokens
of many texts go into a trie; a node holds the best score and token count of its prefix, worked out
once, for all nodes of a depth in numpy, and shared by every pre-token that passes it. Counts are
read off the terminal nodes.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from functools import cache
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from titlespan.llm.common import documents, two_columns

BLANK = "▁"
#: Letters of a trie's pre-tokens with their padding, and remembered counts: a full table becomes the older
#: one, from which what is asked for again comes back. Bounds memory, never results.
NODES = 4_000_000
KEPT = 300_000
#: Pre-tokens whose counts are asked for at once.
HELD = 500_000
#: Pre-tokens of so many letters have tries of their own, as a trie is as wide as its longest one.
SHORT = 24
#: Pre-tokens of so many letters are scored without a trie, one by one, and not remembered.
IN_TRIE = 128
#: What a byte of a letter beyond the vocabulary scores below the worst piece.
UNKNOWN = 10.0


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def unigram(path: str) -> dict[str, float]:
    """Log probability by piece. The vocabulary is in order of frequency; probabilities fall
    with the rank as 1 / rank (Zipf), up to a constant."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    plain = [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    total = log(sum(1 / (rank + 1) for rank in range(len(plain))))
    return {piece: -log(rank + 1) - total for rank, piece in enumerate(plain)}


class _Endings:
    """The vocabulary's pieces from their ends: a state for each ending of a piece, nought for none.
    States and letters lead on through a hash table with linear probing, looked up by arrays."""

    def __init__(self, scores: dict[str, float]):
        letters = {letter: i for i, letter in enumerate(sorted(set("".join(scores))), 1)}
        self.of_letter = np.zeros(sys.maxunicode + 1, np.int32)
        self.of_letter[[ord(letter) for letter in letters]] = [*letters.values()]
        self.span = len(letters) + 1
        after: dict[int, int] = {}
        ends = {}
        for piece, score in scores.items():
            state = 0
            for letter in reversed(piece):
                state = after.setdefault(state * self.span + letters[letter], len(after) + 1)
            ends[state] = score
        #: Of every state the score of its piece; not a number if it is none.
        self.score = np.full(len(after) + 1, np.nan)
        self.score[[*ends]] = [*ends.values()]
        bits = max(4, (4 * len(after)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.states = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
        for slot, (key, state) in zip(self._slots(np.array([*after], np.int64)).tolist(), after.items(), strict=True):
            while self.keys[slot] >= 0:
                slot = slot + 1 & self.mask
            self.keys[slot], self.states[slot] = key, state

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def after(self, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The states of the endings that are longer by a letter in front."""
        keys = state.astype(np.int64) * self.span + letter
        slots = self._slots(keys)
        there = self.keys.take(slots)
        found = np.where(there == keys, self.states.take(slots), 0)
        open_ = np.flatnonzero((there != keys) & (there >= 0))
        while len(open_):
            slots[open_] = slots[open_] + 1 & self.mask
            there = self.keys.take(slots[open_])
            met = there == keys[open_]
            found[open_[met]] = self.states.take(slots[open_[met]])
            open_ = open_[~met & (there >= 0)]
        return found


class CountTrie:
    """`counts(pre_tokens)`: by pre-token the tokens of its best segmentation; of equal ones that of
    fewer tokens.

    A trie is made of many sorted pre-tokens at once. Its nodes are numbered by their depth; what is
    known of a depth follows by array operations from that of the depths above."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.longest = max(map(len, scores), default=1)
        self.unknown = min(scores.values(), default=0.0) - UNKNOWN
        self.endings = _Endings(scores)
        self.terminal: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def _alone(self, text: str) -> int:
        """By the recurrence itself, a letter after the other."""
        known = self.scores.get
        score, tokens = [0.0], [0]
        for end in range(1, len(text) + 1):
            width = len(text[end - 1].encode("utf-8", "surrogatepass"))
            best, fewest = score[end - 1] + width * self.unknown, tokens[end - 1] + width
            for start in range(max(0, end - self.longest), end):
                piece = known(text[start:end])
                if piece is not None:
                    found, count = score[start] + piece, tokens[start] + 1
                    if found > best or (found == best and count < fewest):
                        best, fewest = found, count
            score.append(best)
            tokens.append(fewest)
        return tokens[-1]

    def _trie(self, texts: list[str]) -> list[int]:
        """Tokens of sorted, distinct texts."""
        sizes = np.array([*map(len, texts)])
        depth = int(sizes.max())
        # A row for each depth, a column for each text.
        letters = np.ascontiguousarray(np.array(texts, f"U{depth}").view(np.uint32).reshape(-1, depth).T)
        places = np.arange(depth)[:, None]
        # A prefix is new from the first letter on in which a text differs from the one before it.
        new = np.ones(letters.shape, bool)
        np.not_equal(letters[:, 1:], letters[:, :-1], out=new[:, 1:])
        new[:, 1:] |= places >= sizes[:-1]
        np.logical_or.accumulate(new, axis=0, out=new)
        new &= places < sizes
        at = np.flatnonzero(new)
        nodes = len(at)
        path = np.zeros((depth + 1, len(texts)), np.int32)  # the root is number 0
        path[1:].reshape(-1)[at] = np.arange(1, nodes + 1)
        np.maximum.accumulate(path, axis=1, out=path)
        flat_path, codes, row = path.reshape(-1), letters.reshape(-1), len(texts)
        # Ways into a node: the piece of its last letters from the node before them, or the letter's bytes.
        code = codes.take(at)
        widths = 1 + (code >= 0x80).astype(np.int8) + (code >= 0x800) + (code >= 0x10000)
        alone = np.array([w * self.unknown for w in range(5)])
        into, before = [np.arange(nodes, dtype=np.int32)], [flat_path.take(at)]
        gain, more = [alone.take(widths)], [widths]
        state, node, place = np.zeros(nodes, np.int32), into[0], at
        for _ in range(self.longest):
            state = self.endings.after(state, self.endings.of_letter.take(codes.take(place)))
            going = np.flatnonzero(state)
            state, node, place = state[going], node[going], place[going]
            score = self.endings.score.take(state)
            ends = np.flatnonzero(score == score)
            into.append(node[ends])
            before.append(flat_path.take(place[ends]))
            gain.append(score[ends])
            more.append(np.ones(len(ends), np.int8))
            inside = np.flatnonzero(place >= row)
            state, node, place = state[inside], node[inside], place[inside] - row
        all_into = np.concatenate(into)
        order = np.argsort(all_into, kind="stable")
        all_before, all_gain, all_more = (np.concatenate(c)[order] for c in (before, gain, more))
        ways = np.bincount(all_into, minlength=nodes)
        starts = np.concatenate([[0], np.cumsum(ways)])
        score, tokens = np.zeros(nodes + 1), np.zeros(nodes + 1, np.int32)
        edges = np.concatenate([[0], np.cumsum(np.count_nonzero(new, axis=1))]).tolist()
        for low, high in zip(edges, edges[1:]):
            here = slice(starts[low], starts[high])
            firsts = starts[low:high] - starts[low]
            found = score.take(all_before[here]) + all_gain[here]
            count = tokens.take(all_before[here]) + all_more[here]
            best = score[low + 1 : high + 1] = np.maximum.reduceat(found, firsts)
            count[found < np.repeat(best, ways[low:high])] = np.iinfo(np.int32).max
            tokens[low + 1 : high + 1] = np.minimum.reduceat(count, firsts)
        return tokens.take(path[sizes, np.arange(row)]).tolist()

    def learn(self, pre_tokens: set[str]) -> None:
        """Puts the counts of pre-tokens that `terminal` does not hold into it."""
        short: list[str] = []
        wide: list[str] = []
        for word in pre_tokens:
            count = self.older.get(word)
            if count is not None:
                self.terminal[word] = count
            elif len(word) < IN_TRIE:
                (short if len(word) < SHORT else wide).append(word)
            else:
                self.terminal[word] = self._alone(BLANK + word)
        for words in (short, wide):
            words.sort()
            step = max(1, NODES // (SHORT if words is short else IN_TRIE))
            for at in range(0, len(words), step):
                own = words[at : at + step]
                self.terminal.update(zip(own, self._trie([BLANK + word for word in own]), strict=True))

    def counts(self, texts: Iterable[str]) -> Iterator[tuple[int, int]]:
        """`(pre-tokens, tokens)` of every text; those of some texts are looked up at once."""
        held: list[list[str]] = []
        size, new = 0, set()
        for text in texts:
            held.append(text.split())
            size += len(held[-1])
            new |= set(held[-1]).difference(self.terminal)
            if size >= HELD or len(new) >= KEPT:
                yield from self._taken(held, new)
                held, size, new = [], 0, set()
        yield from self._taken(held, new)

    def _taken(self, held: list[list[str]], new: set[str]) -> Iterator[tuple[int, int]]:
        self.learn(new)
        known = self.terminal.__getitem__
        found = [(len(own), sum(map(known, own))) for own in held]
        for word in new:
            if len(word) >= IN_TRIE:
                del self.terminal[word]
        if len(self.terminal) >= KEPT:
            self.older, self.terminal = self.terminal, {}
        return iter(found)

    def count(self, pre_token: str) -> int:
        """Of a single pre-token."""
        if pre_token not in self.terminal:
            return next(self._taken([[pre_token]], {pre_token}))[1]
        return self.terminal[pre_token]


@cache
def count_trie(path: str) -> CountTrie:
    """One for each Python worker."""
    return CountTrie(unigram(path))


def token_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None
) -> DataFrame:
    """`(doc_id, n_pre_tokens, n_tokens)`, one row per input row.

    Null, empty and white texts have none of either. Ids may be null or repeat; other columns
    are not looked at; an empty table gives no rows. Pre-tokens of `IN_TRIE` letters and more, as very
    long texts may have, are scored by the same recurrence without a place in the trie. No shuffle; memory is a batch of rows and the bounded trie.
    """
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = count_trie(path)
        for batch in batches:
            texts = (text.as_py() or "" for text in batch.column(1))
            words, tokens = zip(*trie.counts(texts), strict=True) if batch.num_rows else ((), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())],
                ["doc_id", "n_pre_tokens", "n_tokens"],
            )

    narrow = two_columns(docs, id_col, text_col)
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, n_pre_tokens long, n_tokens long")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir))
