"""Ids of whole texts under the word vocabulary, one stretch between spaces at a time.

The vocabulary's rules (white space dropped, no piece across it) make the ids of a text the
ids of its space-separated stretches, one after another. Stretches recur, so their ids are
kept in two bounded tables: by stretch, and by piece (a run of letters, a digit, a run of
signs). What is new goes to the tokenizers library: its merge model for pieces that are lower
case already and in a range where normalising changes nothing, the whole library otherwise.
"""

from __future__ import annotations

import struct
from collections.abc import Callable
from functools import cache

import regex

#: Entries of each table; a full one starts anew. Bounds memory, never results.
KEPT = 150_000
#: Longer stretches are not kept.
KEPT_LENGTH = 64

# The vocabulary's pattern of pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# Up to U+02AF every letter is its own composed form and lower-cases by itself.
_beyond = regex.compile("[^\x00-ʯ]").search
_plain = regex.compile("[\x21-\x7e\xa1-ʯ]+").fullmatch
_pieces = regex.compile(PIECES).findall


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@cache
def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: printable ones for themselves, others from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def lettered(piece: str) -> str:
    """The piece's UTF-8 bytes, a letter for each."""
    return piece if piece.isascii() else piece.encode().decode("latin-1").translate(byte_letters())


def packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class _Kept(dict):
    """Ids by text. A missing one is worked out and kept; when the table is full it becomes the
    older one, from which what is asked for again comes back, and a new one starts."""

    def __init__(self, work: Callable[[str], bytes]):
        self.work, self.older = work, {}

    def __missing__(self, text: str) -> bytes:
        ids = self.older.get(text)
        if ids is None:
            ids = self.work(text)
        if len(text) <= KEPT_LENGTH:
            if len(self) >= KEPT:
                self.older = dict(self)
                self.clear()
            self[text] = ids
        return ids


class WordIds:
    """`ids(text)`: packed ids. `merge` gives the ids of one piece of byte letters; by default
    the library's model does."""

    def __init__(self, path: str, merge: Callable[[str], list[int]] | None = None):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        self.tokenizer = tokenizer
        model = tokenizer.model
        self.merge = merge or (lambda piece: [t.id for t in model.tokenize(piece)])
        self.special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.marks = [mark.lower() for mark in self.special]
        self.own = merge is not None
        self.pieces = _Kept(self._piece)
        self.lower = _Kept(self._lower)
        self.raw = _Kept(self._raw)

    def _piece(self, piece: str) -> bytes:
        return packed(self.merge(lettered(piece)))

    def _lower(self, stretch: str) -> bytes:
        """Of a text that is lower case and has no letter beyond U+02AF and no special mark."""
        if stretch.isalpha():
            return self.pieces[stretch]
        body, sign = stretch[:-1], stretch[-1:]
        if sign in ".,;:!?" and body.isalpha():
            return self.pieces[body] + self.pieces[sign]
        if _plain(stretch):
            return b"".join(map(self.pieces.__getitem__, _pieces(stretch)))
        return self._raw(stretch)

    def _raw(self, stretch: str) -> bytes:
        if self.own:
            return self._parts(stretch)
        return packed(self.tokenizer.encode(stretch, add_special_tokens=False).ids)

    def _parts(self, stretch: str) -> bytes:
        """Normalised and cut into pieces by the library, merged by `merge`."""
        out, at = [], 0
        marks = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)")
        for found in [*marks.finditer(stretch), None]:
            text = stretch[at : found.start() if found else len(stretch)]
            if text:
                lower = self.tokenizer.normalizer.normalize_str(text)
                cut = self.tokenizer.pre_tokenizer.pre_tokenize_str(lower)
                out += [packed(self.merge(piece)) for piece, _ in cut]
            if found:
                out.append(packed([self.tokenizer.token_to_id(found.group())]))
                at = found.end()
        return b"".join(out)

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        spaced = text.replace("\n", " ")
        if _beyond(text):
            return b"".join(map(self.raw.__getitem__, spaced.split(" ")))
        lower = spaced.lower()
        if not self._marked(lower):
            return b"".join(map(self.lower.__getitem__, lower.split(" ")))
        # Marks are matched in their own letters: what may hold one goes to the library as it is.
        pairs = zip(spaced.split(" "), lower.split(" "), strict=True)
        return b"".join(self.raw[own] if self._marked(low) else self.lower[low] for own, low in pairs)

    def _marked(self, lower: str) -> bool:
        return any(mark in lower for mark in self.marks)


@cache
def word_ids(path: str) -> WordIds:
    """One for each Python worker, which serves many tasks."""
    return WordIds(path)
