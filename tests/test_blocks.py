"""Cross-validation moves and writes compressed values, and leaves no shuffle behind."""

import glob
import os
import random
import time
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from titlespan.operators import blocks, dictionary, folds, tagger, usage
from titlespan.operators.metrics import evaluate_predictions

SEQ = "record_id long, tokens array<string>, true_tags array<string>"


@pytest.fixture(scope="module")
def data():
    rng = random.Random(7)
    words = [f"w{rng.randrange(10**9)}" for _ in range(3000)] + ["", "ä", "日本", "a\xa0b"]
    rows = []
    for i in range(300):
        tokens = rng.choices(words, k=rng.randrange(0, 200))
        rows.append((i, tokens, [rng.choice(["O", "O", "B-OEM", "I-OEM", "", "bad"]) for _ in tokens]))
    return rows


def test_values_are_read_back(spark):
    schema = StructType.fromDDL("a array<string>, id string, n array<array<int>>, b array<string>")
    shape = blocks.Shape(schema)
    many = [f"x{i}" for i in range(700)]
    a = [many, None, [], [None, "", "ü😀"], ["z\x00"]]
    b = [["O"] * 700, [None], None, ["B", None, "O"], []]
    n = [[[1], None], None, [], [[2, None]], [[]]]
    rows = pa.RecordBatch.from_arrays(
        [pa.array(a, pa.list_(pa.string())), pa.array(["p", None, "q", "", "r"]), pa.array(n, pa.list_(pa.list_(pa.int32()))),
         pa.array(b, pa.list_(pa.string()))], ["a", "id", "n", "b"],
    )
    for part in (rows, rows.slice(1), rows.slice(2, 2), rows.slice(0, 0), rows.slice(3, 1)):
        value = shape.value(part)
        assert shape.records(value).to_pylist() == part.to_pylist()
        assert shape.list_of(value, 3).to_pylist() == part.column(3).to_pylist()


def test_folds_join_repeated_and_missing_ids(spark, data, monkeypatch):
    monkeypatch.setattr(blocks, "DEALT_TOKENS", 500)
    odd = [(None if i % 50 == 7 else i // 2, t, g, i) for i, t, g in data] + [(None, None, None, -1), (999, [], None, -2)]
    seqs = spark.createDataFrame(odd, SEQ + ", number int").repartition(5)
    found = folds.with_folds(seqs, 3, 1)
    assert found.columns == ["record_id", "tokens", "true_tags", "number", "fold"]
    rows = found.collect()
    assert sorted((repr(tuple(r)[:4]) for r in rows)) == sorted(repr(r) for r in odd)
    assert all(len({r.fold for r in rows if r.record_id == i}) == 1 for i in {r.record_id for r in rows})
    ids = folds.with_length_bins(seqs).groupBy("record_id").agg(F.min("bin").alias("bin"))
    expected = {r.record_id: r.fold for r in folds.stratified_folds(ids, 3, 1).collect()}
    assert {r.record_id: r.fold for r in rows} == expected


def test_fold_lexicons_with_one_shuffle(spark, data, monkeypatch):
    """NULLs, arrays of unequal length, and folds that are none count as their long table does."""
    monkeypatch.setattr(usage, "COUNTED_TOKENS", 300)
    monkeypatch.setattr(usage, "HELD_COUNTS", 5)
    rows = [(*r, [0, 1, 2, 5, None][r[0] % 5]) for r in data[:80]]
    rows += [
        (1, ["a", None, "a"], ["O", "B-OEM"], 0), (2, None, ["O"], 1), (3, ["q"], None, 1), (4, [], ["O", "P"], 2),
        (5, ["z", "z"], ["B", "C", "D"], 2), (6, ["only"], ["O"], 1), (7, ["none"], ["O"], None),
    ]
    folded = spark.createDataFrame(rows, SEQ + ", fold int")
    counts, tokens = defaultdict(Counter), set()
    for _, words, tags, fold in rows:
        if words is None or tags is None:
            continue
        for i in range(max(len(words), len(tags))):
            word, tag = (words[i] if i < len(words) else None), (tags[i] if i < len(tags) else None)
            tokens.add(word)
            for f in range(3):
                if fold is not None and fold != f:
                    counts[word, f][tag or ""] += 1
    expected = {}
    for word in tokens:
        tags, shares = [], []
        for f in range(3):
            own = counts[word, f]
            best = min(own, key=lambda t: (-own[t], t.encode())) if own else None
            tags.append(best)
            shares.append(own[best] / sum(own.values()) if own else None)
        expected[word] = (tags, shares)
    lexicon = tagger.fit_per_fold(folded, 3)
    assert lexicon._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    found = {r.token: (r.tag, r.confidence) for r in lexicon.collect()}
    assert len(found) == lexicon.count() and found == expected
    assert tagger.fit_per_fold(folded.limit(0), 3).collect() == []


def test_blocks_whose_rows_are_apart_get_their_answers(spark, data, monkeypatch):
    monkeypatch.setattr(dictionary, "BLOCK_TOKENS", 4000)
    monkeypatch.setattr(dictionary, "ROW_TOKENS", 300)
    monkeypatch.setattr(dictionary, "BUCKET_ENTRIES", 50)
    monkeypatch.setattr(dictionary, "ASKED_WORDS", 20)
    monkeypatch.setattr(dictionary, "DEALT_ENTRIES", 70)
    seqs = spark.createDataFrame([(*r, r[0] % 3) for r in data], SEQ + ", fold int").repartition(2)
    written = dictionary.Blocks.of(seqs, "apart", "fold")
    assert sorted(map(tuple, written.records().collect())) == sorted((*r, r[0] % 3) for r in data)
    lexicon = tagger.fit_per_fold(written, 3).localCheckpoint()
    apart = dictionary.Blocks(written.table.repartition(7), written.schema)
    screened = dictionary.Blocks.of(seqs, "screened", "fold", spark.sparkContext.broadcast(dictionary._screen(lexicon)[0].tobytes()))
    screened = dictionary.Blocks(screened.table.repartition(7), screened.schema)
    best = {r.token: (r.tag, r.confidence) for r in lexicon.collect()}
    for seen in (written, apart, screened, written.filter(F.col("fold") == 1)):
        found = tagger.predict_tokens(seen, lexicon, ["true_tags"], ["fold"], "fold", max_broadcast_bytes=0).collect()
        assert len(found) == (100 if seen not in (written, apart, screened) else 300)
        for r in found:
            assert r.pred_tags == ["O" if best[t][0][r.fold] is None else best[t][0][r.fold] for t in r.tokens]
            assert r.confidence == [1.0 if best[t][1][r.fold] is None else best[t][1][r.fold] for t in r.tokens]
            assert r.true_tags == data[r.record_id][2] and r.tokens == data[r.record_id][1]


def _shuffled(spark) -> dict[str, int]:
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f: os.path.getsize(f) for d in folders for f in glob.glob(f"{d}/*/shuffle_*.data")}


@pytest.mark.parametrize("model", [False, True])
def test_cross_validation_leaves_no_shuffle(spark, data, model):
    """Tables of the records are on disk once, in fewer bytes than their text has; the settings are as before."""
    seqs = spark.createDataFrame(data, SEQ).repartition(4).localCheckpoint()
    before, set_before = set(_shuffled(spark)), [spark.conf.get(c, None) for c in folds.SPARING]
    if model:
        found = folds.cross_validate_with(lambda train: folds.written(tagger.fit_sequences(train), "own"), seqs, 3)
    else:
        found = folds.cross_validate(seqs, 3, max_broadcast_bytes=0)
    until = time.time() + 20
    while (left := sum(n for f, n in _shuffled(spark).items() if f not in before)) > 60_000 and time.time() < until:
        time.sleep(0.2)
    assert left <= 60_000
    assert [spark.conf.get(c, None) for c in folds.SPARING] == set_before
    folded = {r.record_id: r.fold for r in folds.with_folds(seqs, 3).collect()}
    rows = []
    for fold in range(3):
        own = defaultdict(Counter)
        for i, tokens, tags in data:
            if folded[i] != fold:
                for t, g in zip(tokens, tags, strict=True):
                    own[t][g] += 1
        best = {t: min(c, key=lambda g: (-c[g], g.encode())) for t, c in own.items()}
        rows += [(i, ts, gs, [best.get(t, "O") for t in ts], fold) for i, ts, gs in data if folded[i] == fold]
    predicted = spark.createDataFrame(rows, SEQ + ", pred_tags array<string>, fold int")
    expected = {(r.fold, r.metric): r.value for r in evaluate_predictions(predicted, by=["fold"]).collect()}
    got = {(r.fold, r.metric): r.value for r in found.collect()}
    assert set(got) <= set(expected) and len(got) == 21
    assert all(got[k] == pytest.approx(expected[k]) for k in got)
