import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from titlespan.operators import dictionary, folds, tagger
from titlespan.operators.tokens import with_tokens
from titlespan.sources import store

SEQ = "record_id bigint, tokens array<string>, true_tags array<string>"


@pytest.fixture(scope="module")
def data():
    """A third of all tokens is one word."""
    rng = random.Random(9)
    rows = []
    for i in range(400):
        tokens = [
            "für" if rng.random() < 0.33 else rng.choice(["Bosch", "ATE", "x", f"w{rng.randrange(60)}"])
            for _ in range(rng.randrange(0, 12))
        ]
        rows.append((i, tokens, [rng.choice(["O", "B-OEM", "I-OEM"]) for _ in tokens]))
    return rows


@pytest.fixture(scope="module")
def seqs(spark, data):
    return spark.createDataFrame(data, SEQ)


def majority(data):
    counts = defaultdict(Counter)
    for _, tokens, tags in data:
        for token, tag in zip(tokens, tags):
            counts[token][tag] += 1
    best = {t: min(c, key=lambda tag: (-c[tag], tag)) for t, c in counts.items()}
    return best, counts


def test_fit_takes_the_majority(seqs, data):
    best, counts = majority(data)
    rows = {r.token: r for r in tagger.fit_sequences(seqs).collect()}
    assert {t: r.tag for t, r in rows.items()} == best
    for token, r in rows.items():
        total = sum(counts[token].values())
        assert (r.n, r.total) == (counts[token][best[token]], total)
        assert r.confidence == pytest.approx(r.n / total)


@pytest.mark.parametrize("limit", [tagger.MAX_BROADCAST_BYTES, 0])
def test_both_lookups_predict_the_same(spark, seqs, data, limit):
    """With a limit of 0 the records ask in blocks."""
    best, _ = majority(data[:200])
    lexicon = tagger.fit_sequences(seqs.filter("record_id < 200"))
    predicted = tagger.predict_tokens(seqs, lexicon, parallel=["true_tags"], max_broadcast_bytes=limit)
    rows = {r.record_id: r for r in predicted.collect()}
    assert len(rows) == len(data)
    for i, tokens, tags in data:
        assert rows[i].tokens == tokens and rows[i].true_tags == tags
        assert rows[i].pred_tags == [best.get(t, "O") for t in tokens]


def test_joined_tokens(spark, seqs, data, monkeypatch):
    """Long tables of tokens: the frequent ones are answered apart."""
    monkeypatch.setattr(tagger, "HOT_SHARE", 2)
    lexicon = tagger.fit_sequences(seqs.filter("record_id < 200"))
    best, _ = majority(data[:200])
    rows = seqs.selectExpr("record_id", "posexplode(tokens) AS (pos, token)")
    for limit in (tagger.MAX_BROADCAST_BYTES, 0):
        found = tagger.lookup(rows, lexicon, max_broadcast_bytes=limit).collect()
        got = sorted((r.record_id, r.pos, r.token, r._tag or "O") for r in found)
        assert got == sorted((i, p, t, best.get(t, "O")) for i, ts, _ in data for p, t in enumerate(ts))


def test_shuffled_lookup_broadcasts_frequent_tokens_only(seqs):
    lexicon = tagger.fit_sequences(seqs)
    rows = seqs.selectExpr("record_id", "posexplode(tokens) AS (pos, token)")
    joined = tagger.lookup(rows, lexicon, max_broadcast_bytes=0)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in plan and "ResolvedHint" not in plan.replace("strategy=broadcast", "", 1)


def test_repeated_and_missing_ids_keep_their_rows(spark, seqs):
    titles = spark.createDataFrame(
        [(1, "a b c"), (1, "x y"), (None, "p"), (None, "q r"), (2, None)], "record_id bigint, title string"
    )
    lexicon = tagger.fit_sequences(seqs)
    for limit in (tagger.MAX_BROADCAST_BYTES, 0):
        found = tagger.predict_tokens(with_tokens(titles), lexicon, max_broadcast_bytes=limit)
        got = [(r.record_id, r.tokens) for r in found.collect()]
        expected = [(1, ["a", "b", "c"]), (1, ["x", "y"]), (None, ["p"]), (None, ["q", "r"]), (2, [])]
        assert sorted(map(repr, got)) == sorted(map(repr, expected))


def test_records_are_tagged_where_they_are(spark, seqs):
    """No exchange of records or tokens, and one look-up for tags and confidences."""
    lexicon = tagger.fit_sequences(seqs)
    for found in (
        tagger.predict_tokens(seqs, lexicon, parallel=["true_tags"]),
        tagger.predict(spark.range(5).selectExpr("id AS record_id", "'Bosch x' AS title"), lexicon),
    ):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("ArrowEvalPython") == 1


def test_large_lexicons_are_asked_for_distinct_tokens(spark, seqs, data, monkeypatch):
    """Beyond the limit: what is joined is a block's distinct tokens that the lexicon may know."""
    monkeypatch.setattr(dictionary, "BLOCK_TOKENS", 300)
    blocks = []
    write = dictionary.written
    monkeypatch.setattr(dictionary, "written", lambda df, name: blocks.append(write(df, name)) or blocks[-1])
    lexicon = store.written(tagger.fit_sequences(seqs.filter("record_id < 100")), "lexicon")
    found = tagger.predict_tokens(seqs, lexicon, max_broadcast_bytes=0)
    best, _ = majority(data[:100])
    rows = {r.record_id: r.pred_tags for r in found.collect()}
    assert rows == {i: [best.get(t, "O") for t in tokens] for i, tokens, _ in data}
    pairs = [(r.block, t) for r in blocks[0].collect() for t in r.asked]
    assert len(pairs) == len(set(pairs)) and len({b for b, _ in pairs}) > 3
    assert len(pairs) < sum(len(tokens) for _, tokens, _ in data) / 2


def test_blocks_are_written_in_small_rows(spark, seqs, data, monkeypatch):
    """Parquet holds a hundred rows at least; the answers are never gathered in one row."""
    monkeypatch.setattr(dictionary, "BLOCK_TOKENS", 300)
    monkeypatch.setattr(dictionary, "ROW_TOKENS", 50)
    blocks = []
    write = dictionary.written
    monkeypatch.setattr(dictionary, "written", lambda df, name: blocks.append(write(df, name)) or blocks[-1])
    folded = seqs.coalesce(1).selectExpr("*", "CAST(record_id % 3 AS INT) AS fold")
    lexicon = store.written(tagger.fit_per_fold(folded, 3), "lexicon")
    found = tagger.predict_tokens(folded, lexicon, keep=["fold"], fold_col="fold", max_broadcast_bytes=0)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "collect_list" not in plan
    bests = [majority([r for r in data if r[0] % 3 != f])[0] for f in range(3)]
    rows = {r.record_id: r.pred_tags for r in found.collect()}
    assert rows == {i: [bests[i % 3].get(t, "O") for t in tokens] for i, tokens, _ in data}
    rows_of = Counter(r.block for r in blocks[0].collect())
    assert len(rows_of) > 3 and max(rows_of.values()) > 3
    assert all(len({r.fold for r in blocks[0].filter(f"block = {b}").collect()}) == 1 for b in list(rows_of)[:3])


@pytest.mark.parametrize("limit", [tagger.MAX_BROADCAST_BYTES, 0])
def test_odd_records_are_tagged(spark, seqs, limit):
    odd = spark.createDataFrame(
        [(1, None, "a"), (2, [], None), (3, [None, "Bosch", "", "Bosch"], "b"), (4, ["w1"] * 5000, "c")],
        "record_id int, tokens array<string>, `x.y` string",
    ).withColumnRenamed("x.y", "block")
    lexicon = tagger.fit_sequences(seqs)
    found = tagger.predict_tokens(odd, lexicon, keep=["block"], max_broadcast_bytes=limit)
    rows = {r.record_id: r for r in found.collect()}
    best = {r.token: (r.tag, r.confidence) for r in lexicon.collect()}
    assert [(rows[i].tokens, rows[i].pred_tags, rows[i].block) for i in (1, 2)] == [([], [], "a"), ([], [], None)]
    assert list(zip(rows[3].pred_tags, rows[3].confidence)) == [("O", 1.0), best["Bosch"], ("O", 1.0), best["Bosch"]]
    assert rows[4].pred_tags == [best["w1"][0]] * 5000
    none = tagger.predict_tokens(odd, lexicon.limit(0), keep=["block"], max_broadcast_bytes=limit)
    assert {t for r in none.collect() for t in r.pred_tags} == {"O"}
    assert tagger.predict_tokens(odd.limit(0), lexicon, keep=["block"], max_broadcast_bytes=limit).count() == 0


def test_a_dictionary_serves_many_queries(seqs, data):
    lexicon = tagger.fit_sequences(seqs)
    model = tagger.held(lexicon)
    best, _ = majority(data)
    for part in ("record_id < 50", "record_id >= 50"):
        for r in tagger.predict_tokens(seqs.filter(part), model).collect():
            assert r.pred_tags == [best[t] for t in r.tokens]
    assert tagger.held(model) is model and tagger.held(lexicon, 10) is None


def test_words_of_one_checksum():
    """Checksums only lead to a word; the word itself decides."""
    words = [f"w{i}" for i in range(300)] + ["", "ä", "日本"]
    tags = pa.array([None if i % 7 == 0 else f"B-{i % 3}" for i in range(len(words))])
    shares = pa.array([i / len(words) for i in range(len(words))])
    made = dictionary.Dictionary.of(pa.array(words), tags, shares)
    assert (np.diff(made.marks.astype(np.int64)) >= 0).all()
    asked = pa.array([*words, "other"])
    order = np.argsort(dictionary._marks(made.tokens) // 1000, kind="stable")
    assert (made.find(asked) >= 0).sum() == len(words) and made.find(asked)[-1] == -1
    blurred = dictionary.Dictionary(
        dictionary._marks(made.tokens)[order] // 1000, made.tokens.take(pa.array(order)), made.codes[order],
        made.confidence[order], made.labels,
    )
    marks = dictionary._marks
    try:
        dictionary._marks = lambda w: marks(w) // 1000
        lists = pa.array([[*words, "other", None], [], None, ["w7", "w8"]])
        found, sure = blurred.answers(lists)
    finally:
        dictionary._marks = marks
    expected = [t.as_py() or "O" for t in tags] + ["O", "O"]
    assert found.to_pylist() == [expected, [], [], ["O", tags[8].as_py()]]
    assert sure.to_pylist()[0][-2:] == [1.0, 1.0] and sure.to_pylist()[3][1] == shares[8].as_py()


def test_failures_of_a_model_show(spark, seqs):
    def broken(batch):
        raise KeyError("weights")

    found = tagger.predict_with(seqs, broken).collect()
    assert all(r.error == "KeyError: 'weights'" and set(r.pred_tags) <= {"O"} for r in found)
    good = tagger.predict_with(seqs, lambda batch: [["O"] * len(t) for t in batch], keep=["true_tags"])
    assert good.columns == ["record_id", "true_tags", "tokens", "pred_tags", "error"]
    assert good.filter("error IS NOT NULL").count() == 0


def test_records_of_one_id_share_a_fold(spark):
    df = spark.createDataFrame(
        [(i % 40 if i % 9 else None, ["a"] * (i % 7)) for i in range(200)],
        "record_id bigint, tokens array<string>",
    )
    folded = folds.with_folds(df, k=4).collect()
    assert len(folded) == 200
    assert all(len({r.fold for r in folded if r.record_id == i}) == 1 for i in [None, *range(40)])


def test_unknown_tokens_are_outside(spark, seqs):
    titles = spark.createDataFrame([(1, "Bosch qqq"), (2, None)], "record_id bigint, title string")
    rows = {r.record_id: r for r in tagger.predict(titles, tagger.fit_sequences(seqs)).collect()}
    assert rows[1].pred_tags[1] == "O" and rows[1].confidence[1] == 1.0
    assert rows[2].tokens == [] and rows[2].pred_tags == []


def test_user_model_with_failures(spark):
    data = [("1", "a 5"), ("2", "boom"), ("3", ""), ("4", "long one")]
    titles = spark.createDataFrame(data, "record_id string, title string")

    def model(batch):
        if any("boom" in tokens for tokens in batch):
            raise RuntimeError
        return [["B-OEM"] * (len(tokens) - 1) if len(tokens) < 3 else ["O"] * 9 for tokens in batch]

    predicted = tagger.predict_with(with_tokens(titles), model)
    rows = {r.record_id: r.pred_tags for r in predicted.collect()}
    assert rows == {"1": ["B-OEM", "O"], "2": ["O"], "3": [], "4": ["B-OEM", "O"]}


def test_align(spark):
    df = spark.createDataFrame(
        [(["a", "b"], ["B-OEM"]), (["a", "b"], ["O", "O", "B-OEM"]), ([], ["O"])],
        "tokens array<string>, pred_tags array<string>",
    )
    assert [r.pred_tags for r in tagger.align(df).collect()] == [["B-OEM", "O"], ["O", "O"], []]


def test_prediction_stats(spark):
    df = spark.createDataFrame([(["B-OEM", "I-OEM", "O"],), ([],), (["B-EAN", "bad"],)], "pred_tags array<string>")
    stats = {r.metric: r.value for r in tagger.prediction_stats(df).collect()}
    assert stats["total_texts"] == 3 and stats["total_tokens"] == 5 and stats["o_tag_count"] == 1
    assert stats["average_tokens_per_text"] == pytest.approx(5 / 3)
    assert stats["entity_count:OEM"] == 2 and stats["entity_count:EAN"] == 1 and stats["entity_count:Farbe"] == 0


def test_model_round_trip(spark, seqs, tmp_path):
    lexicon = tagger.fit_sequences(seqs)
    path = str(tmp_path / "model")
    store.save_model(lexicon, path, kind="majority")
    assert sorted(store.load_model(spark, path).collect()) == sorted(lexicon.collect())
    info = store.load_info(spark, path).first()
    assert info.num_labels == 23 and info.is_trained and info.model_params == {"kind": "majority"}
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        store.save_model(lexicon, path)


def qcut(lengths, q=5):
    """Quantile bins with linear interpolation and duplicate edges dropped."""
    s = sorted(lengths)

    def quantile(p):
        k = (len(s) - 1) * p
        low = int(k)
        high = min(low + 1, len(s) - 1)
        return round(s[low] + (s[high] - s[low]) * (k - low), 9)

    edges = sorted({quantile(i / q) for i in range(q + 1)})
    return [max(sum(e < n for e in edges) - 1, 0) for n in lengths]


@pytest.mark.parametrize("lengths", [[1, 1, 1, 2, 3, 4, 5], [3], list(range(40)), [2, 2, 2, 2]])
def test_length_bins(spark, lengths):
    df = spark.createDataFrame(list(enumerate(lengths)), "record_id bigint, n int")
    binned = folds.with_length_bins(df.selectExpr("record_id", "n", "array_repeat('t', n) AS tokens"))
    got = {r.record_id: r.bin for r in binned.collect()}
    assert [got[i] for i in range(len(lengths))] == qcut(lengths)


def test_folds_are_balanced_and_stable(spark):
    """One bin holds most records; every bin is split evenly all the same."""
    df = spark.range(5000).selectExpr("id AS record_id", "if(id % 10 < 8, 0, 1) AS bin")
    first = folds.stratified_folds(df, k=5)
    sizes = Counter((r.bin, r.fold) for r in first.collect())
    for b in (0, 1):
        counts = [sizes[b, f] for f in range(5)]
        assert max(counts) - min(counts) <= 1
    again = folds.stratified_folds(df.repartition(3), k=5)
    assert sorted(first.collect()) == sorted(again.collect())
    assert sorted(folds.stratified_folds(df, k=5, seed=1).collect()) != sorted(first.collect())
    for prefix in (1, 2):
        assert sorted(folds.stratified_folds(df, k=5, prefix=prefix).collect()) == sorted(first.collect())


def test_fold_lexicons_leave_their_fold_out(spark, data):
    folded = [(*row, row[0] % 3) for row in data]
    df = spark.createDataFrame(folded, SEQ + ", fold int")
    rows = {r.token: r.tag for r in tagger.fit_per_fold(df, 3).collect()}
    for f in range(3):
        best, _ = majority([row[:3] for row in folded if row[3] != f])
        assert {t: tags[f] for t, tags in rows.items() if tags[f] is not None} == best


def test_folds_are_planned_without_a_job(spark):
    """The plan counts in a table of its own; nothing runs before an action."""
    df = spark.range(100).selectExpr("id AS record_id", "0 AS bin")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("fold-planning", "none")
    try:
        folds.stratified_folds(df, k=5)
        assert list(tracker.getJobIdsForGroup("fold-planning")) == []
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_cross_validation_beyond_a_broadcast(seqs):
    few = folds.cross_validate(seqs, k=3, max_broadcast_bytes=0).collect()
    assert sorted(map(repr, few)) == sorted(map(repr, folds.cross_validate(seqs, k=3).collect()))


def test_cross_validation(spark, seqs):
    results = folds.cross_validate(seqs, k=3)
    rows = results.collect()
    assert len(rows) == 3 * 7
    f1 = [r.value for r in rows if r.metric == "token_f1"]
    mean = sum(f1) / 3
    summary = {r.metric: r for r in folds.cv_summary(results).collect()}
    assert summary["token_f1"].mean == pytest.approx(mean)
    assert summary["token_f1"].std == pytest.approx((sum((x - mean) ** 2 for x in f1) / 3) ** 0.5)


def test_sequences_are_counted_as_long_tables_with_one_shuffle(spark, monkeypatch):
    """arrays of unequal length, NULLs and repeated records count as their long table does."""
    from titlespan.operators import usage
    from titlespan.operators.tokens import tagged_long

    monkeypatch.setattr(usage, "COUNTED_TOKENS", 5)
    rows = [
        (1, ["a", "b", None, "a"], ["O", None, "", "X"]), (1, ["a", "b", None, "a"], ["O", None, "", "X"]),
        (2, None, ["O"]), (3, ["q"], None), (4, [], ["O", "P"]), (5, ["z", "z", "a"], ["B"]), (6, [], []),
        *[(i, [f"t{j % i}" for j in range(9)], [f"B-{j % 4}" for j in range(9)]) for i in range(7, 30)],
    ]
    seqs = spark.createDataFrame(rows, "record_id long, tokens array<string>, true_tags array<string>")
    for some in (seqs, seqs.filter("record_id = 3")):
        found, expected = tagger.fit_sequences(some), tagger.fit(tagged_long(some))
        assert found.schema == expected.schema
        assert sorted(map(repr, found.collect())) == sorted(map(repr, expected.collect()))
    plan = tagger.fit_sequences(seqs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
