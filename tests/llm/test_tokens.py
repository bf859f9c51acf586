"""Operators 1, 2, 6 and 9 against the tokenizers library and plain brute force."""

import hashlib
import random
import struct
import sys
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.tables import empty, prose, rows, table
from titlespan.llm import bpe, packing, token_counts, token_files, words
from titlespan.llm.range_coder import Coder
from titlespan.session import new_path

tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")

ODD = [
    "İstanbul J̌ ǰ Σίσυφος ΣΑΣ é é",
    "a\x1cb\x85c d 's 'S It's IT'S ½ ² 12ab \t x",
    "日本語 テキスト한국어 🎉👨‍👩‍👧",
    "</w> </w <|startoftext|>x<|endoftext|> <|end",
    "a" * 3000 + "!!!???...,,",
    "­​ zero﻿ \x00\x01 \x1f ﬁ ŉ ß ẞ ŸÇ",
    "I'LL i'd'd''s LLL that, that. that!",
]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(words.default_path())


def coded(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


@pytest.mark.parametrize("make", [words.WordIds, bpe.Codec])
def test_ids_are_the_library_s(library, make):
    work = make(words.default_path())
    encode = work.ids if isinstance(work, words.WordIds) else work.encode
    for text in ODD + [t for _, t in rows() if t] + [prose(s, 200).title() for s in range(5)]:
        assert encode(text) == coded(library.encode(text, add_special_tokens=False).ids), text[:80]


@pytest.mark.parametrize("make", [words.WordIds, bpe.Codec])
def test_marks_count_in_their_own_letters(library, make):
    work = make(words.default_path())
    encode = work.ids if isinstance(work, words.WordIds) else work.encode
    marks = ["<|ENDOFTEXT|>", "<|EndOfText|>", "<|STARTOFTEXT|>", "<|endoftext|>", "<|startoftext|>"]
    texts = [t for m in marks for t in (m, f"One {m} two\n{m}", f"It's{m}x, {m}{marks[3]} End.", f"日本 {m} Ö")]
    for text in [*texts, " ".join(marks), "".join(marks), *texts]:
        assert encode(text) == coded(library.encode(text, add_special_tokens=False).ids), text
    assert coded(library.encode("<|ENDOFTEXT|>", add_special_tokens=False).ids) != encode("<|endoftext|>")


def test_full_tables_start_anew(library, monkeypatch):
    monkeypatch.setattr(words, "KEPT", 5)
    monkeypatch.setattr(bpe, "KEPT_PAIRS", 5)
    text = prose(9, 500)
    expected = coded(library.encode(text, add_special_tokens=False).ids)
    assert words.WordIds(words.default_path()).ids(text) == expected
    assert bpe.Codec(words.default_path()).encode(text) == expected


def test_encode_and_decode(spark, library):
    got = bpe.digests(table(spark)).collect()
    assert len(got) == len(rows())
    expected = []
    for doc_id, text in rows():
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        expected.append(
            (doc_id, len(ids), hashlib.sha256(coded(ids)).hexdigest(), hashlib.sha256(back.encode()).hexdigest())
        )
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))
    both = bpe.decode(bpe.encode(table(spark))).collect()
    texts = [library.decode(library.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False) for _, t in rows()]
    assert sorted(r["text"] for r in both) == sorted(texts)
    assert bpe.digests(empty(spark)).count() == 0


def check_pieces(pieces, expected, window):
    """Every id in one piece, sequences without gaps."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
    for doc_id, ids in expected.items():
        at = 0
        for p in sorted(by_doc[doc_id], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            own = ids[at : at + p["length"]]
            assert p["ids_crc32"] == zlib.crc32(coded(own))
            assert "ids" not in p or bytes(p["ids"]) == coded(own)
            at += p["length"]
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= window
    return {s: sum(p["length"] for p in own) for s, own in by_sequence.items()}


@pytest.mark.parametrize("window,open_windows,fan_in", [(64, 4, 2), (2048, 64, 32)])
def test_packing(spark, library, monkeypatch, window, open_windows, fan_in):
    monkeypatch.setattr(packing, "FAN_IN", fan_in)
    texts = [(i, prose(i, 5 + 37 * i % 300)) for i in range(120)] + [(500, None), (501, ""), (502, prose(1, 9000))]
    docs = table(spark, texts).repartition(7)
    pieces = [r.asDict() for r in packing.pack(docs, window=window, open_windows=open_windows).collect()]
    expected = {i: library.encode(t or "", add_special_tokens=False).ids + [1] for i, t in texts}
    filled = check_pieces(pieces, expected, window)
    assert sum(filled.values()) / (len(filled) * window) > 0.9


def test_packed_sequences(spark, library):
    pieces = packing.pack(table(spark), window=32)
    made = packing.sequences(pieces, window=32, pad_id=0).collect()
    total = sum(len(library.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows())
    assert sum(r["length"] for r in made) == total
    for r in made:
        full = r["length"] if r["length"] & (r["length"] - 1) == 0 else 32
        assert len(r["ids"]) == 4 * full and sum(r["lengths"]) == r["length"]
        assert bytes(r["ids"])[4 * r["length"] :] == b"\0" * 4 * (full - r["length"])
    assert packing.pack(empty(spark)).count() == 0


@pytest.mark.parametrize("count,limit,block", [(0, 9, 16), (1, 9, 16), (1000, 49408, 64), (5000, 5, 128), (777, 1048000, 32)])
def test_range_coder(count, limit, block):
    ids = np.random.default_rng(count).zipf(1.3, count) % limit
    coder = Coder(limit)
    records = coder.encode(ids, block)
    back = coder.decode(records)
    assert np.array_equal(np.concatenate(back), ids)
    # Blocks stand for themselves.
    assert np.array_equal(coder.decode(records[-1:])[0], back[-1])


def test_repeating_ids_take_little_room():
    ids = np.tile([5, 700, 31, 9], 4096)
    assert sum(map(len, Coder(49408).encode(ids))) < len(ids) // 4


@pytest.mark.parametrize("kind", ["one id", "frequent id", "no pattern", "pairs"])
def test_range_coder_learns(kind):
    draw = np.random.default_rng(7)
    ids = draw.integers(0, 49408, 9000)
    if kind == "one id":
        ids[:] = 320
    elif kind == "frequent id":  # order 0: no order sees it coming, but it is half of all
        ids[draw.random(9000) < 0.5] = 320
    elif kind == "pairs":  # order 1: every other id follows from the one before
        ids = np.repeat(draw.integers(0, 300, 4500), 2)
        ids[1::2] += 7000
    coder = Coder(49408)
    records = coder.encode(ids)
    assert np.array_equal(np.concatenate(coder.decode(records)), ids)
    most = {"one id": 0.2, "frequent id": 10, "no pattern": 17, "pairs": 6.5}
    assert sum(map(len, records)) * 8 / len(ids) < most[kind]
    # A block is coded alike, whichever blocks it is coded with.
    assert coder.encode(ids[4096:8192]) == records[1:2]


def test_changed_blocks_are_found():
    coder = Coder(49408)
    record = bytearray(coder.encode(np.arange(3000) % 777, 4096)[0])
    for at in (0, 40, len(record) // 2):
        changed = bytearray(record)
        changed[at] ^= 1
        with pytest.raises(ValueError):
            coder.decode([bytes(changed)])


@pytest.mark.parametrize("wave", [1, 1536])
def test_files(spark, library, monkeypatch, wave):
    monkeypatch.setattr(token_files, "WAVE", wave)
    folder = new_path(spark, "files")
    token_files.write_files(table(spark), folder)
    got = token_files.read_files(spark, folder).collect()
    at, expected = 0, []
    for doc_id, text in sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        expected.append((doc_id, at, len(ids), zlib.crc32(coded(ids)), coded(ids)))
        at += len(ids)
    assert sorted(map(repr, expected)) == sorted(repr((*r[:4], bytes(r[4]))) for r in got)


@pytest.mark.parametrize("part_bytes", [1 << 30, 20_000])
def test_parts_follow_the_size_of_the_texts(spark, monkeypatch, part_bytes):
    monkeypatch.setattr(token_files, "PART_BYTES", part_bytes)
    texts = [(i, prose(i, 100)) for i in range(400)]
    folder = new_path(spark, "files")
    token_files.write_files(table(spark, texts), folder)
    parts = spark.read.parquet(folder).select("part").distinct().count()
    wanted = sum(len(t) for _, t in texts) // part_bytes + 1
    assert parts == 1 if wanted == 1 else wanted / 2 < parts <= wanted
    assert token_files.read_files(spark, folder).count() == 400


@pytest.mark.parametrize("sizes", [[17], [41], [1] * 14, [3] * 20, [0.25] * 30, [9, 0.5, 30]])
def test_waves_are_even(monkeypatch, sizes):
    monkeypatch.setattr(token_files, "WAVE", 8)
    waves = []

    class Counted(Coder):
        def encode(self, ids):
            waves.append(-(-len(ids) // token_files.BLOCK))
            return super().encode(ids)

    blocks = token_files._Blocks(0, Counted(9), pa.int64())
    made = []
    for doc_id, size in enumerate(sizes):
        made += blocks.add(doc_id, np.full(int(size * token_files.BLOCK), doc_id % 9, "<u4").tobytes())
    made += blocks.flush(True)
    rows = [r for batch in made for r in batch.to_pylist()]
    assert [r["block"] for r in rows] == list(range(len(rows)))
    assert sum(r["n_ids"] for r in rows) == sum(int(s * token_files.BLOCK) for s in sizes)
    assert [d for r in rows for d in r["doc_ids"]] == list(range(len(sizes)))
    # A step costs much the same for fewer blocks, so no wave is left with a few.
    assert max(waves) <= 12 and (len(waves) == 1 or min(waves) >= 6)


def test_files_of_nothing(spark):
    folder = new_path(spark, "files")
    token_files.write_files(empty(spark), folder)
    assert token_files.read_files(spark, folder).count() == 0


def brute_count(text, scores, unknown):
    best = [(0.0, 0)]
    for end in range(1, len(text) + 1):
        width = len(text[end - 1].encode())
        found = (best[end - 1][0] + width * unknown, best[end - 1][1] - width)
        for start in range(end):
            if text[start:end] in scores:
                found = max(found, (best[start][0] + scores[text[start:end]], best[start][1] - 1))
        best.append(found)
    return -best[-1][1]


def test_token_counts(spark, monkeypatch):
    scores = token_counts.unigram(token_counts.default_path())
    trie = token_counts.CountTrie(scores)
    got = token_counts.token_counts(table(spark)).collect()
    expected = []
    for doc_id, text in rows():
        own = (text or "").split()
        counts = {w: brute_count(token_counts.BLANK + w, scores, trie.unknown) for w in set(own) if len(w) < 400}
        counts |= {w: trie.count(w) for w in own if len(w) >= 400}
        expected.append((doc_id, len(own), sum(counts[w] for w in own)))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))
    assert token_counts.token_counts(empty(spark)).count() == 0


def test_small_tries_count_alike(monkeypatch):
    scores = token_counts.unigram(token_counts.default_path())
    whole = token_counts.CountTrie(scores)
    own = prose(3, 400).split() + ["x" * 300, "日本" * 90]
    expected = [whole.count(w) for w in own]
    for name in ("NODES", "KEPT", "IN_TRIE"):
        monkeypatch.setattr(token_counts, name, 6)
    small = token_counts.CountTrie(scores)
    assert [small.count(w) for w in own] == expected


def odd_words(seed: int, count: int) -> set[str]:
    rng = random.Random(seed)
    sizes = [1, 2, 3, 5, 9, 23, 24, 30, 126, 127, 128, 150]
    made = {"".join(rng.choices("abcdeéßñ日本\x00\x01­🎉.,!ABC▁", k=rng.choice(sizes))) for _ in range(count)}
    return made | {w + "\0" for w in list(made)[::9]}


def test_tries_count_odd_words():
    scores = token_counts.unigram(token_counts.default_path())
    trie = token_counts.CountTrie(scores)
    for own in (sorted(odd_words(1, 300)), sorted(odd_words(2, 300), reverse=True)):
        expected = [brute_count(token_counts.BLANK + w, scores, trie.unknown) for w in own]
        assert [n for _, n in trie.counts(own)] == expected
        assert list(trie.counts([" ".join(own), "", own[0]])) == [(len(own), sum(expected)), (0, 0), (1, expected[0])]


def test_new_words_share_their_steps():
    trie = token_counts.CountTrie(token_counts.unigram(token_counts.default_path()))
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghij", k=9)) for _ in range(20_000)]
    calls = 0

    def seen(frame, event, arg):
        nonlocal calls
        calls += event == "call"

    sys.setprofile(seen)
    try:
        found = list(trie.counts([" ".join(words)]))
    finally:
        sys.setprofile(None)
    assert found[0][0] == len(words)
    assert calls < len(words) / 2  # some 8 a word when a letter was worked on after the other


def test_full_tables_of_counts_keep_what_is_asked_again(monkeypatch):
    monkeypatch.setattr(token_counts, "KEPT", 50)
    monkeypatch.setattr(token_counts, "HELD", 20)
    trie = token_counts.CountTrie(token_counts.unigram(token_counts.default_path()))
    made: list[str] = []
    work = trie._trie
    trie._trie = lambda texts: made.extend(texts) or work(texts)
    common = [f"w{i}" for i in range(10)]
    texts = [" ".join(common + [f"n{i}x{j}" for j in range(10)]) for i in range(30)]
    assert len(list(trie.counts(texts))) == 30
    assert len(trie.terminal) < 70 and len(trie.older) < 70
    assert all(made.count(token_counts.BLANK + w) == 1 for w in common)
