"""Operators 4, 5, 7 and 10 against brute force."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from tests.llm.tables import empty, prose, rows, table
from titlespan.llm import embedding_dedup, exact_dedup, near_dedup, repeats
from titlespan.llm.exact_dedup import FuseFilter
from titlespan.llm.links import components
from titlespan.llm.suffix_array import Segments, common_prefixes, suffix_array


class Sets(dict):
    def find(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self[max(a, b)] = min(a, b)


# --- links -------------------------------------------------------------------------------


def test_components(spark):
    rng = random.Random(5)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    pairs += [(1000, 1000 + i) for i in range(200)] + [(i, i + 1) for i in range(2000, 2100)] + [(7, 7)]
    sets = Sets()
    for a, b in pairs:
        sets.join(a, b)
    found = components(spark.createDataFrame(pairs, "a long, b long").repartition(9)).collect()
    expected = {x: sets.find(x) for a, b in pairs if a != b for x in (a, b)}
    assert {r["node"]: r["component"] for r in found} == expected and len(found) == len(expected)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- exact -------------------------------------------------------------------------------


@pytest.mark.parametrize("count", [1, 2, 10, 1000, 60_000])
def test_fuse_filter(count):
    keys = np.random.default_rng(count).integers(0, 1 << 63, count, dtype=np.uint64)
    fuse = FuseFilter.from_bytes(FuseFilter.build(keys).to_bytes())
    assert fuse.knows(keys).all()
    others = np.random.default_rng(count + 1).integers(0, 1 << 63, 50_000, dtype=np.uint64)
    assert fuse.knows(others).mean() < 0.001
    assert fuse.prints.nbytes < 64 + 200 * count ** 0.5 + 2.8 * count


def ascii_lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("loads", [1, 2, 4])
def test_exact_dedup(spark, loads):
    got = exact_dedup.exact_dedup(table(spark), loads=loads).collect()
    groups = defaultdict(list)
    for doc_id, text in rows():
        groups[ascii_lowered(text)].append(doc_id)
    expected, kept = [], defaultdict(int)
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        expected += [(i, keep, len(ids), sha) for i in ids]
    assert sorted(map(repr, expected)) == sorted(repr(tuple(r)[:3] + (r["text_sha256"],)) for r in got)
    for r in got:
        kept[r["text_sha256"]] += r["kept"]
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
    assert set(kept.values()) == {1}
    assert exact_dedup.exact_dedup(empty(spark), loads=loads).count() == 0


def test_exact_stage_keeps_rows(spark):
    docs = table(spark)
    kept = exact_dedup.stage(spark, docs, "").collect()
    assert kept[0].__fields__ == docs.columns
    assert sorted(ascii_lowered(r["text"]) for r in kept) == sorted({ascii_lowered(t) for _, t in rows()})


# --- near --------------------------------------------------------------------------------


def brute_near(texts, words, percent):
    """`(doc_id, set size, least id of the component)` by row; and the components of rows."""
    sets = []
    for _, text in texts:
        own = (text or "").encode().lower().split()
        full = set(zip(*(own[i:] for i in range(words)))) if len(own) >= words else {tuple(own)}
        sets.append(full if own else set())
    links = Sets()
    for i, a in enumerate(sets):
        links.find(i)
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                links.join(i, j)
    least = {}
    for i, (doc_id, _) in enumerate(texts):
        root = links.find(i)
        if doc_id is not None:
            least[root] = min(least.get(root, doc_id), doc_id)
    found = [(texts[i][0], len(sets[i]), least.get(links.find(i))) for i in range(len(texts))]
    return found, {links.find(i) for i in range(len(texts)) if sets[i]}


def near_texts():
    rng = random.Random(2)
    texts = list(rows())
    for family in range(12):
        words = prose(100 + family, rng.choice([40, 120, 300])).split()
        for copy in range(rng.choice([2, 5, 30])):
            own = list(words)
            for _ in range(rng.randrange(1 + len(words) // 60)):
                own[rng.randrange(len(own))] = f"w{rng.randrange(1000)}"
            texts.append((1000 + 100 * family + copy, " ".join(own)))
    return texts


@pytest.mark.parametrize("words,percent,block", [(3, 85, 512), (5, 80, 512), (3, 85, 4)])
def test_near_dedup(spark, monkeypatch, words, percent, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    texts = near_texts()
    got = near_dedup.near_dedup(table(spark, texts), words, percent).collect()
    expected, _ = brute_near(texts, words, percent)
    assert sorted(map(repr, expected)) == sorted(repr(tuple(r)[:3]) for r in got)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_links_across_a_split_bucket(spark, monkeypatch):
    """What the least member of a bucket does not link is compared with the others."""
    monkeypatch.setattr(near_dedup, "bands_of", lambda percent: (120, 1))
    texts = [(i, t) for i, t in near_texts() if i is not None and i >= 1000]
    got = near_dedup.near_dedup(table(spark, texts), 3, 85).collect()
    assert sorted(map(repr, brute_near(texts, 3, 85)[0])) == sorted(repr(tuple(r)[:3]) for r in got)


def test_near_of_nothing(spark):
    assert near_dedup.near_dedup(empty(spark)).count() == 0
    assert near_dedup.near_dedup(table(spark, [(1, None), (2, " "), (2, " ")])).count() == 3


def test_near_stage(spark):
    texts = near_texts()
    docs = table(spark, texts)
    kept = near_dedup.stage(spark, docs, "").collect()
    assert kept[0].__fields__ == docs.columns
    wordless = sum(1 for _, t in texts if not (t or "").split())
    assert len(kept) == wordless + len(brute_near(texts, 5, 80)[1])


def test_posterior():
    assert near_dedup.least_matches(100, 85) > near_dedup.least_matches(100, 80) > 50
    for percent in (80, 85, 95):
        bands, rows_of_band = near_dedup.bands_of(percent)
        assert bands * rows_of_band <= near_dedup.HASHES
        assert (1 - (percent / 100) ** rows_of_band) ** bands <= near_dedup.BAND_MISS


# --- repeated strings --------------------------------------------------------------------


def test_suffix_array():
    rng = random.Random(1)
    for _ in range(150):
        letters = rng.choice([2, 3, 26])
        texts = [bytes(rng.randrange(letters) + 97 for _ in range(rng.randrange(1, 30))) for _ in range(rng.randrange(1, 8))]
        texts += [texts[0], b"a" * rng.randrange(1, 20)] if rng.random() < 0.5 else []
        counts = [rng.randrange(1, len(t) + 1) for t in texts]
        segments = Segments(texts, counts)
        order = suffix_array(segments)
        own = [segments.data[p : segments.ends[segments.segment_of(np.array([p]))[0]]] for p in order]
        assert own == sorted(own)
        assert set(np.flatnonzero(segments.wanted()).tolist()) <= set(order.tolist())
        shared = common_prefixes(segments, order, 12)
        for i in range(1, len(order)):
            same = 0
            while same < min(len(own[i - 1]), len(own[i]), 12) and own[i - 1][same] == own[i][same]:
                same += 1
            assert shared[i] == same


def brute_strings(texts, length):
    data = [(t or "").encode() for _, t in texts]
    seen = defaultdict(int)
    for d in data:
        for p in range(len(d) - length + 1):
            seen[d[p : p + length]] += 1
    out = []
    for (doc_id, _), d in zip(texts, data):
        gone = bytearray(len(d))
        for p in range(len(d) - length + 1):
            if seen[d[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        kept = bytes(c for c, g in zip(d, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc_id, len(d), len(d) - len(kept), spans, kept))
    return out


def shared_in_part():
    """One long passage, and beginnings and ends of it, between own and shared surroundings."""
    passage, found = prose(78, 160), []
    for i in range(45):
        before = prose(600 + i % 7, 40) if i % 3 else prose(700 + i, 40)
        after = prose(800 + i % 5, 40) if i % 4 else prose(900 + i, 40)
        found.append((500 + i, f"{before[i % 11 :]} {passage[10 * (i % 6) : len(passage) - 13 * (i % 4)]} {after}"))
    return found


@pytest.mark.parametrize("crowd", [0, 1, 3, 20])
@pytest.mark.parametrize("length", [60, 400])
def test_strings_of_crowded_anchors(spark, monkeypatch, length, crowd):
    """Runs are cut into parts, down to single starts, and no string is lost on the way."""
    monkeypatch.setattr(repeats, "ANCHOR_RUNS", crowd)
    texts = shared_in_part() + [(1, "ab" * 700), (2, "ab" * 650 + "c"), (3, None)]
    got = repeats.dedup_strings(table(spark, texts), length).collect()
    found = [(r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), bytes(r["kept"])) for r in got]
    assert sorted(map(repr, brute_strings(texts, length))) == sorted(map(repr, found))


@pytest.mark.parametrize("length,crowd,portion", [(400, 4096, 1 << 19), (60, 4096, 2000), (60, 2, 2000)])
def test_repeated_strings(spark, monkeypatch, length, crowd, portion):
    monkeypatch.setattr(repeats, "ANCHOR_RUNS", crowd)
    monkeypatch.setattr(repeats, "PORTION", portion)
    monkeypatch.setattr(repeats, "SORTED_BYTES", 3000)
    passage = prose(77, 90)
    texts = rows() + [(200 + i, f"{prose(300 + i, 40)} {passage} {prose(400 + i, 30)}") for i in range(20)]
    got = repeats.dedup_strings(table(spark, texts), length).collect()
    found = [(r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), bytes(r["kept"])) for r in got]
    assert sorted(map(repr, brute_strings(texts, length))) == sorted(map(repr, found))
    assert repeats.dedup_strings(empty(spark), length).count() == 0


def test_repeats_query(spark, tmp_path):
    """Digests and remaining texts of whole documents; letters cut through are replaced."""
    passage = "é" * 250
    texts = [(1, f"a{passage} one"), (2, f"bb{passage} two"), (3, None), (4, "alone"), (5, passage[:150])]
    table(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in repeats.op4_repeats(spark, str(tmp_path)).collect()}
    for doc_id, n_bytes, n_removed, n_spans, kept in brute_strings(texts, 400):
        r = got[doc_id]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (n_bytes, n_removed, n_spans)
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()
        assert r.text == kept.decode(errors="replace")
    assert got[1].n_removed > 400 and got[4].text == "alone" and got[3].text == ""


# --- embeddings --------------------------------------------------------------------------


def vectors():
    rng = np.random.default_rng(3)
    out = []
    for cluster in range(8):
        center = rng.normal(size=16)
        for spread in (0.02, 0.1, 0.3):
            out += [(center + spread * rng.normal(size=16)).tolist() for _ in range(25)]
    out += [rng.normal(size=16).tolist() for _ in range(300)]
    out += [out[3]] * 40 + [[2 * x for x in out[3]]] * 3
    out += [None, [], [0.0] * 16, [1.0] * 15 + [None], [float("nan")] * 16, [float("inf")] * 16, [1.0, 0.0], [2.0, 0.1]]
    return [(i if i % 97 else None, v) for i, v in enumerate(out)]


@pytest.mark.parametrize("block,leaf,chunk", [(4096, 8, 1024), (60, 1, 7)])
def test_embedding_links(spark, monkeypatch, block, leaf, chunk):
    for name, value in (("BLOCK", block), ("LEAF", leaf), ("CHUNK", chunk)):
        monkeypatch.setattr(embedding_dedup, name, value)
    own = vectors()
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in own], "vec_id long, embedding array<double>, label int, class string")
    got = embedding_dedup.embedding_dedup(frame.repartition(3)).collect()
    usable = [embedding_dedup._usable(v) for _, v in own]
    links, sets = [0] * len(own), Sets()
    for i, a in enumerate(usable):
        sets.find(i)
        for j in range(i):
            b = usable[j]
            if a is None or b is None or len(a) != len(b):
                continue
            if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= 0.9:
                links[i] += 1
                links[j] += 1
                sets.join(i, j)
    least = {}
    for i, (vec_id, _) in enumerate(own):
        if vec_id is not None:
            root = sets.find(i)
            least[root] = min(least.get(root, vec_id), vec_id)
    expected = [(vec_id, links[i], least.get(sets.find(i))) for i, (vec_id, _) in enumerate(own)]
    assert sorted(map(repr, expected)) == sorted(repr(tuple(r)[:3]) for r in got)
    assert embedding_dedup.embedding_dedup(frame.limit(0)).count() == 0


def circle(*angles):
    return np.array([[np.cos(a), np.sin(a)] for a in angles])


def small_trees():
    rng = np.random.default_rng(5)
    near = np.array([1.0, 0.0, 0.0]) + 1e-5 * rng.normal(size=(40, 3))
    # Points exactly, or but for rounding, as far from the first as a radius of some level.
    radii = [2 * np.arcsin(r / 2) for r in (2.0, 1.0, 0.5, 0.25, 0.125)]
    shifted = [a + k * 1e-9 for a in radii for k in (-2, -1, 1, 2)]
    return {
        "opposite": np.array([[1.0, 0.0], [-1.0, 0.0]]),
        "opposites": np.concatenate([x := rng.normal(size=(50, 8)), -x]),
        "radii": circle(0.0, *radii, *[-a for a in radii]),
        "about radii": circle(0.0, *shifted),
        "very near": near,
        "near and opposite": np.concatenate([near, -near]),
    } | {f"radius {a:.3f} {k}": circle(0.0, a + k * 1e-9, a / 2) for a in radii for k in (-1, 0, 1)}


@pytest.mark.parametrize("leaf", [8, 1])
def test_trees_of_points_at_a_radius(monkeypatch, leaf):
    monkeypatch.setattr(embedding_dedup, "LEAF", leaf)
    for name, raw in small_trees().items():
        tree = embedding_dedup.CoverTree(raw, np.ones(len(raw), np.int64))
        assert sorted(tree.order) == list(range(len(raw))), name
        walk = embedding_dedup.Walk(tree, tree, 0.9)
        links = np.cumsum(walk.steps[0])[:-1]
        units = tree.raw / np.linalg.norm(tree.raw, axis=1, keepdims=True)
        assert links.tolist() == ((units @ units.T >= 0.9).sum(axis=1) - 1).tolist(), name


def test_opposite_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [-1.0, 0.0]), (3, [0.9, 0.1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    got = embedding_dedup.embedding_dedup(frame).collect()
    assert sorted(tuple(r)[:3] for r in got) == [(1, 1, 1), (2, 0, 2), (3, 1, 1)]
