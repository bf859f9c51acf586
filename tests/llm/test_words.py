"""Operators 11, 12 and 13: conversations, ranked search, spelling variants."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.tables import empty, prose, rows, table
from titlespan.llm import chat, ranked_search, spelling_variants
from titlespan.llm.spelling_variants import near_pairs

# --- conversations -----------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, formatted string, `a.b` string"
MARKS = ["<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[/ROLE]", "[SAYS]", "[/SAYS]", "[NEXT]"]


def turns():
    """`(conv_id, turn, role, text)` with every mark, plain, escaped and cut short."""
    found = [(1, i, "user" if i % 2 else "assistant", f"{m} {m[0]}\\{m[1:]} {m[0]}\\\\{m[1:]}{m[:-1]}") for i, m in enumerate(MARKS)]
    found += [(2, 0, "system", "be\n[INST]"), (2, 1, "user", "<"), (2, 2, "user", "/s>["), (2, 3, "user", "")]
    found += [(2, 4, "assistant", "ä🎉\\"), (2, 5, "assistant", " two "), (2, 6, "user", None)]
    found += [(3, 0, "tool", "x"), (3, 1, "tool", "y [/ROLE]"), (3, 2, "[SAYS] </s>", "z"), (3, 3, None, "n"), (3, 3, "", "m")]
    found += [(4, None, "user", "first"), (4, 0, "assistant", "same"), (4, 0, "assistant", "same"), (4, 0, "assistant", "other")]
    found += [(None, 0, "user", "nobody's"), (5, 0, "assistant", prose(1, 30_000)), (6, 0, "user", "\\" * 3000 + "<" + "\\" * 3000 + "/s>")]
    return found


def conversations(spark):
    full = [(*t, "f", "ab") for t in turns()]
    return spark.createDataFrame(full, TURNS).repartition(4)


def in_order():
    found = defaultdict(list)
    for conv, turn, role, text in turns():
        found[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {conv: [(r, t) for *_, r, t in sorted(ts)] for conv, ts in found.items()}


def test_conversations_are_read_back(spark):
    made = chat.formatted(conversations(spark))
    got = made.select("*", F.expr(f"{chat.read_turns()} AS turns"), F.expr(f"{chat.read_loss()} AS texts")).collect()
    expected = in_order()
    assert len(got) == len(expected)
    for r in got:
        assert [tuple(t) for t in r.turns] == expected[r.conv_id]
        trained = [t for role, t in expected[r.conv_id] if role == "assistant"]
        assert r.texts == trained
        octets = r.formatted.encode()
        for span, text in zip(r.loss, trained, strict=True):
            piece = r.formatted[span.start : span.start + span.length]
            assert piece.encode() == octets[span.byte_start : span.byte_start + span.byte_length]
            assert len(piece) >= len(text) and not any(m in piece for m in MARKS)
        # Neighbours of one role share a block.
        roles = [role for role, _ in expected[r.conv_id]]
        blocks = 1 + sum(a != b for a, b in zip(roles, roles[1:], strict=False))
        assert sum(r.formatted.count(e) for e in ("</s>", " [/INST]", " [/SYS]", " [/ROLE]")) == blocks
        assert r.formatted.count("[NEXT]") == len(roles) - blocks


def test_conversation_digests(spark):
    got = {r.conv_id: r for r in chat.digests(chat.formatted(conversations(spark))).collect()}
    for conv, ts in in_order().items():
        r, trained = got[conv], "".join(t for role, t in ts if role == "assistant")
        assert r.n_turns == len(ts) and r.loss_chars == len(trained)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in ts).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(trained.encode()).hexdigest()


def test_one_conversation_of_many_turns(spark):
    """A third of all rows and more; offsets stay right over thousands of turns."""
    many = spark.range(20_000).selectExpr(
        "7L AS conv_id", "id AS turn", "if(id % 3 = 0, 'user', 'assistant') AS role", "concat('t', id, ' </s>') AS text"
    )
    got = chat.formatted(many).select("formatted", F.expr(f"{chat.read_loss()} AS texts")).collect()
    assert len(got) == 1 and got[0].texts == [f"t{i} </s>" for i in range(20_000) if i % 3]


def test_conversation_names_and_empty_tables(spark):
    frame = spark.createDataFrame([("c", 1, "user", "hi")], "`x.y` string, t int, r string, s string")
    r = chat.formatted(frame, "x.y", "t", "r", "s").first()
    assert (r.conv_id, r.formatted, r.loss) == ("c", "<s>[INST] hi [/INST]", [])
    none = chat.formatted(spark.createDataFrame([], TURNS))
    assert none.columns == ["conv_id", "formatted", "loss"] and none.count() == 0


def test_conversations_need_no_python(spark):
    plan = chat.digests(chat.formatted(conversations(spark)))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("count", [0, 1, 2, 3, 4, 10, 101])
def test_running_sums(spark, count):
    values = [i * i % 17 for i in range(count)]
    frame = spark.createDataFrame([(values,)], "v array<long>")
    got = frame.select(F.expr(chat.running_sums("v"))).first()[0]
    assert got == [sum(values[:i]) for i in range(count)]


# --- ranked search -----------------------------------------------------------------------

RUNS = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute_search(docs, items, top):
    terms = [(i, Counter(RUNS.findall(lowered(t)))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in terms]
    n_docs, total = sum(n > 0 for n in sizes), sum(sizes)
    held = Counter(t for _, c in terms for t in c)
    asked = defaultdict(set)
    for item, text in items:
        asked[item] |= set(RUNS.findall(lowered(text)))
    found = []
    for item, words in asked.items():
        scores = []
        for (doc, counts), n in zip(terms, sizes, strict=True):
            score = 0
            for w in words & counts.keys():
                weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[w] + 1)))
                m = 100 - 50 + 50 * n * n_docs // total
                score += weight * (10**9 * counts[w] // (1000 * counts[w] + 20 * m))
            if score > 0:
                scores.append((-score, doc is not None, doc or 0, doc))
        for rank, (score, _, _, doc) in enumerate(sorted(scores)[:top], 1):
            found.append((item, rank, doc, -score))
    return sorted(map(repr, found))


ITEMS = [
    (1, prose(1, 12)), (2, prose(3, 40)), (3, "öl ÖL Ñandú"), (4, None), (5, ""), (6, "nowhere-found"),
    (7, "one"), (7, "two TWO"), (None, "the of and"), (8, "du"), (9, "\x80 日本語 🎉"),
]


def items(spark, found=ITEMS):
    return spark.createDataFrame([(i, t, 1, "k") for i, t in found], "item_id long, text string, doc_id int, term string")


@pytest.mark.parametrize("segment_docs,segment_terms,top", [(8192, 4_000_000, 50), (3, 4_000_000, 4), (100, 60, 1)])
def test_ranked_search(spark, monkeypatch, segment_docs, segment_terms, top):
    monkeypatch.setattr(ranked_search, "SEGMENT_DOCS", segment_docs)
    monkeypatch.setattr(ranked_search, "SEGMENT_TERMS", segment_terms)
    monkeypatch.setattr(ranked_search, "BUNDLE_ITEMS", 3)
    # Copies tie; common terms are spread over all owners.
    texts = rows() + [(100 + i, prose(i % 7, 25)) for i in range(120)]
    got = ranked_search.ranked(table(spark, texts), items(spark), top=top).collect()
    assert sorted(repr(tuple(r)) for r in got) == brute_search(texts, ITEMS, top)


def test_search_with_owners_in_turn(spark, monkeypatch):
    """Rare, middling and common terms have different owners, and sums pass from one to the next."""
    monkeypatch.setattr(ranked_search, "OWNERS", (40, 8))
    texts = [(i, prose(i % 50, 20) + (" rare%d" % (i % 90))) for i in range(300)]
    asked = [(i, prose(i, 20) + f" rare{i} the of") for i in range(30)]
    got = ranked_search.ranked(table(spark, texts), items(spark, asked)).collect()
    assert sorted(repr(tuple(r)) for r in got) == brute_search(texts, asked, 50)


def test_search_of_empty_tables(spark):
    blank = table(spark, [(1, None), (2, ""), (3, " - ")])
    assert ranked_search.ranked(blank, items(spark)).count() == 0
    assert ranked_search.ranked(empty(spark), items(spark)).count() == 0
    none = ranked_search.ranked(table(spark), items(spark, []))
    assert none.columns == ["item_id", "rank", "doc_id", "score"] and none.count() == 0


def test_terms():
    text = "".join(map(chr, range(0x250))) + "日本語 A1b-c_d e F"
    assert [t.decode() for t in ranked_search.terms_of(text)] == RUNS.findall(lowered(text))


# --- spelling variants -------------------------------------------------------------------


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_pairs(words):
    pairs = set()
    for i, a in enumerate(words):
        for b in words[i + 1 :]:
            if near(a, b):
                pairs.add((a, b) if (len(a), a) < (len(b), b) else (b, a))
    return pairs


def vocabulary(seed, letters, count, longest):
    rng = random.Random(seed)
    found = {"".join(rng.choices(letters, k=rng.randint(1, longest))) for _ in range(count)}
    for w in sorted(found)[: count // 3]:
        i = rng.randrange(len(w))
        found |= {w[:i] + w[i + 1 :], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1 :]}
    return sorted(found - {""})


@pytest.mark.parametrize("key_pairs", [0, 5, 10**9])
@pytest.mark.parametrize("letters,count,longest", [("ab", 200, 9), ("abcdeéÿ", 500, 14), ("x", 40, 60)])
def test_near_pairs(spark, key_pairs, letters, count, longest):
    """Whatever the limit of a key: none, so that all are cut to the letter, a few pairs, all."""
    words = vocabulary(count, letters, count, longest)
    frame = spark.createDataFrame([(w, 1) for w in words], "word string, n long").repartition(3)
    got = near_pairs(frame, key_pairs).collect()
    assert {(r.a, r.b) for r in got} == brute_pairs(words) and len(got) == len({(r.a, r.b) for r in got})


def brute_words(docs, min_length, min_count, thin):
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'null' if doc is None else doc}:{run}".encode())
            if thin and h % thin == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}


def brute_variants(docs, min_length=5, min_count=3, thin=None):
    words = brute_words(docs, min_length, min_count, thin)
    form, count = {}, Counter()
    for w in words:
        others = [o for o in words if near(w, o)]
        count[w] = len(others)
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    found = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        found.append((w, form[w], root, n, count[w], words.get(form[w])))
    return sorted(map(repr, found))


def variant_texts():
    rng = random.Random(3)
    stem, found = "Straßenbahn×÷Öl", []
    for i in range(150):
        words = []
        for k in range(6):
            w = stem[: 6 + k]
            for _ in range(rng.randrange(3)):
                at = rng.randrange(len(w))
                w = w[:at] + rng.choice(["", "e", "é"]) + w[at + 1 :]
            words += [w] * rng.randint(1, 3)
        found.append((i, "-".join(words) + "日" + words[0]))
    return found


@pytest.mark.parametrize("thin", [None, 3, 97])
def test_spelling_variants(spark, thin):
    texts = rows() + variant_texts() + [(5, "fünfzehn " * 3), (5, "funfzehn " * 7), (6, "chain " * 4 + "chains " * 8 + "chaines " * 16)]
    got = spelling_variants.spelling_variants(table(spark, texts), thin=thin).collect()
    assert sorted(repr(tuple(r)) for r in got) == brute_variants(texts, thin=thin)


def test_many_words_share_a_chunk(spark):
    """A third of all words begins alike, and another third ends alike."""
    rng = random.Random(9)
    words = ["gemein" + "".join(rng.choices("abcd", k=5)) for _ in range(700)]
    words += ["".join(rng.choices("abcd", k=5)) + "schaft" for _ in range(700)]
    texts = [(1, " ".join(sorted(set(words)) * 3))]
    got = spelling_variants.spelling_variants(table(spark, texts), key_pairs=50).collect()
    assert sorted(repr(tuple(r)) for r in got) == brute_variants(texts)


def test_variants_of_empty_tables(spark):
    columns = ["word", "form", "root", "n", "n_near", "form_n"]
    for docs in (empty(spark), table(spark, [(1, None), (2, ""), (3, "12 ĀĀĀĀĀ"), (4, "short four")])):
        got = spelling_variants.spelling_variants(docs)
        assert got.columns == columns and got.count() == 0


def test_words_counted_in_portions(spark, monkeypatch):
    monkeypatch.setattr(spelling_variants, "HELD_WORDS", 10)
    got = spelling_variants.word_counts(table(spark), thin=97).collect()
    assert {r.word: r.n for r in got} == brute_words(rows(), 5, 3, 97) and len(got) == len({r.word for r in got})
