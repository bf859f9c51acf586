import random
from collections import Counter

import pytest
from pyspark.sql import Row

from tests.model import spans as model_spans
from titlespan.operators import errors, metrics, pieces
from titlespan.types import ENTITY_TYPES, labels

SCHEMA = "record_id bigint, tokens array<string>, true_tags array<string>, pred_tags array<string>"
P, C = "Produktart", "Farbe"


@pytest.fixture(scope="module")
def data():
    rng = random.Random(4)
    choices = ["O", "O", "", "bad", f"B-{P}", f"I-{P}", f"B-{C}", f"I-{C}"]
    rows = []
    for i in range(300):
        k = rng.randrange(0, 12)
        true = rng.choices(choices, k=k)
        pred = [t if rng.random() < 0.8 else rng.choice(choices) for t in true]
        rows.append((i, rng.choices(["x", "y", "z"], k=k), true, pred))
    return rows


@pytest.fixture(scope="module")
def seqs(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def ratio(a, b):
    return a / b if b else 0.0


def f1(p, r):
    return ratio(2 * p * r, p + r)


def test_confusion_identities(seqs, data):
    flat = Counter((t, p) for _, _, ts, ps in data for t, p in zip(ts, ps))
    conf = metrics.confusion(metrics.token_pairs(seqs))
    assert {(r.true_tag, r.pred_tag): r.n for r in conf.collect()} == flat
    rows = {r.label: r for r in metrics.per_label(conf).collect()}
    n = sum(flat.values())
    for label, r in rows.items():
        tp = flat[label, label]
        support = sum(v for (t, _), v in flat.items() if t == label)
        predicted = sum(v for (_, p), v in flat.items() if p == label)
        assert (r.true_positives, r.false_positives, r.false_negatives) == (tp, predicted - tp, support - tp)
        assert r.true_positives + r.false_positives + r.false_negatives + r.true_negatives == n
        assert r.precision == pytest.approx(ratio(tp, predicted))
        assert r.f1 == pytest.approx(f1(ratio(tp, predicted), ratio(tp, support)))
    overall = metrics.token_metrics(metrics.token_pairs(seqs)).first()
    accuracy = sum(v for (t, p), v in flat.items() if t == p) / n
    # The support-weighted recall is the accuracy.
    assert overall.token_accuracy == pytest.approx(accuracy) == pytest.approx(overall.token_recall)
    assert overall.support == n
    seen = [r.label for r in metrics.labels_seen(metrics.token_pairs(seqs)).collect()]
    assert seen == sorted({x for pair in flat for x in pair})


def test_matrix_has_vocabulary_columns(seqs):
    listed = [*labels(), "", "X", "bad"]
    pairs = metrics.token_pairs(seqs).filter("true_tag IN ('', 'O') AND pred_tag IN ('', 'O')")
    wide = metrics.confusion_matrix(metrics.confusion(pairs), listed)
    assert wide.columns == ["true_tag", *(x or metrics.BLANK_COLUMN for x in listed)]
    assert sorted(r.true_tag for r in wide.collect()) == sorted(listed)


def test_matrix_holds_every_pair(seqs):
    pairs = metrics.token_pairs(seqs)
    wide = metrics.confusion_matrix(metrics.confusion(pairs))
    seen = [r.label for r in metrics.labels_seen(pairs).collect()]
    assert wide.columns[1:] == [x or metrics.BLANK_COLUMN for x in seen]
    assert sum(sum(r[1:]) for r in wide.collect()) == pairs.count()
    with pytest.raises(Exception, match="label is not listed"):
        metrics.confusion_matrix(metrics.confusion(pairs), ["O"]).collect()


@pytest.mark.parametrize("tags", [(["O", "B-EAN"], ["O"]), (["O"], ["O", "O"]), (["O", "O"], None)])
def test_unequal_lengths_are_errors(spark, tags):
    df = spark.createDataFrame([(1, ["a", "b"], *tags)], SCHEMA)
    for found in (
        metrics.token_pairs(df),
        errors.error_examples(df),
        metrics.evaluation_counts(df),
        metrics.evaluate_predictions(df),
    ):
        with pytest.raises(Exception, match="differ in length"):
            found.collect()


def test_pairing_loses_nothing(spark):
    true = spark.createDataFrame(
        [(1, 0, "a", "O"), (1, 1, "b", None), (2, 0, "c", "B-EAN"), (None, 0, "n", "O"), (3, 0, "d", "O")],
        "record_id long, pos int, token string, tag string",
    )
    pred = spark.createDataFrame(
        [(1, 0, "O"), (1, 2, "O"), (None, 0, None), (4, 0, "I-EAN"), (4, 1, "O"), (3, 0, "O")],
        "record_id long, pos int, tag string",
    )
    pairs = metrics.pair_long(true, pred)
    assert pairs.columns == ["record_id", "pos", "token", "true_tag", "pred_tag"]
    expected = [
        (1, 0, "a", "O", "O"), (1, 1, "b", "", None), (1, 2, None, None, "O"), (2, 0, "c", "B-EAN", None),
        (None, 0, "n", "O", ""), (3, 0, "d", "O", "O"), (4, 0, None, None, "I-EAN"), (4, 1, None, None, "O"),
    ]
    assert sorted(map(repr, map(tuple, pairs.collect()))) == sorted(map(repr, expected))
    found = {(r.rule, r.record_id, r.pos, r.n) for r in metrics.unpaired_tokens(pairs).collect()}
    assert found == {
        ("missing_prediction", 1, 1, 1), ("missing_prediction", 2, 0, 1),
        ("missing_truth", 1, 2, 1), ("missing_truth", 4, 0, 2),
    }


def test_records_without_a_partner_show(spark):
    kind = "record_id long, tokens array<string>, tags array<string>"
    true = spark.createDataFrame([(1, ["a"], ["O"]), (None, ["n"], ["O"]), (2, ["b"], ["O"]), (5, ["x"], ["O"])], kind)
    pred = spark.createDataFrame([(1, ["O"]), (None, ["O"]), (3, ["O"]), (5, ["O"]), (5, ["B-EAN"])], "record_id long, tags array<string>")
    pairs = metrics.pair_sequences(true, pred)
    got = sorted(repr(tuple(r)) for r in pairs.collect())
    assert got == sorted(map(repr, [
        (1, ["a"], ["O"], ["O"]), (None, ["n"], ["O"], ["O"]), (2, ["b"], ["O"], None), (3, None, None, ["O"]),
        (5, ["x"], ["O"], ["O"]), (5, ["x"], ["O"], ["B-EAN"]),
    ]))
    found = {(r.rule, r.record_id, r.n) for r in metrics.pairing_violations(true, pred).collect()}
    assert found == {("missing_prediction", 2, 1), ("missing_truth", 3, 1), ("repeated_record", 5, 2)}
    assert {(r.record_id, r.side) for r in metrics.unpaired_records(true, pred).collect()} == {(2, "true"), (3, "pred")}
    with pytest.raises(Exception, match="differ in length"):
        metrics.evaluation_counts(pairs).collect()
    none = metrics.pairing_violations(true.limit(0), pred.limit(0))
    assert none.columns == ["rule", "record_id", "n"] and none.count() == 0


def test_types_of_equal_spans_must_agree(spark):
    """Spans at the same places, of other types, known or not, are no hits."""
    rows = [(1, ["a", "b", "c"], ["B-X", "I-X", "B-EAN"], ["B-Y", "I-Y", "B-EAN"]), (2, [], [], [])]
    counts = metrics.span_counts(spark.createDataFrame(rows, SCHEMA)).collect()
    got = {(r.grain, r.k1): r.n for r in counts}
    assert got == {
        ("span_true", "X"): 1, ("span_true", "EAN"): 1, ("span_pred", "Y"): 1, ("span_pred", "EAN"): 1, ("span_hit", "EAN"): 1,
    }


def test_long_tables_pair_up_as_a_join(spark):
    """Ids that repeat, are missing or lie apart, several blocks, places out of order or missing."""
    rng = random.Random(4)
    ids = [None, 1, 2, 3, 4]
    true = [(rng.choice(ids), rng.choice([None, *range(-3, 12)]), rng.choice(["a", None]), rng.choice([None, "O", "x"])) for _ in range(400)]
    pred = [(rng.choice([*ids, 9]), rng.choice([None, *range(9)]), rng.choice([None, "", "B-P"])) for _ in range(300)]
    true += [(50, i, f"w{i}", "O") for i in range(300)]
    pred += [(50, i, f"t{i}") for i in range(0, 310, 2)]
    want = []
    for i, p, token, tag in true:
        found = [t or "" for j, q, t in pred if (j, q) == (i, p)]
        want += [(i, p, token, tag or "", t) for t in found or [None]]
    keys = {(i, p) for i, p, *_ in true}
    want += [(i, p, None, None, t or "") for i, p, t in pred if (i, p) not in keys]
    long = "record_id bigint, pos int, token string, tag string"
    left = spark.createDataFrame(true, long).repartition(3)
    right = spark.createDataFrame(pred, "record_id int, pos int, tag string").repartition(2)
    for paired in (metrics.pair_long(left, right), pieces.paired(left.fillna("", ["tag"]), right.fillna("", ["tag"]), block=4)):
        assert sorted(map(str, paired.collect())) == sorted(str(Row(**dict(zip(paired.columns, w, strict=True)))) for w in want)
    none = metrics.pair_long(left.limit(0), right.limit(0))
    assert none.collect() == [] and dict(none.dtypes)["pos"] == "int"


def test_pairs_are_shuffled_in_pieces(spark):
    """A record's tokens travel together: no join, and no row per token in the shuffle."""
    long = spark.range(2000).selectExpr("id div 1000 AS record_id", "CAST(id % 1000 AS INT) AS pos", "'t' AS token", "'O' AS tag")
    plan = metrics.pair_long(long, long)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "MapInArrow" in plan.split("Exchange hashpartitioning")[1]


def test_tables_must_pair_up(spark):
    true = spark.createDataFrame([(1, ["a"], ["O"]), (2, ["b"], ["O"])], "record_id int, tokens array<string>, tags array<string>")
    assert metrics.evaluate_tables(true, true.drop("tokens")).filter("key = 'O'").count()
    for pred in (true.filter("record_id = 1"), true.union(true)):
        with pytest.raises(Exception, match="do not pair up"):
            metrics.evaluate_tables(true, pred.drop("tokens")).collect()


def test_entity_scores_equal_sets_of_spans(seqs, data):
    true, pred = set(), set()
    for i, tokens, ts, ps in data:
        true |= {(i, *s[:3]) for s in model_spans(tokens, ts, "lenient")}
        pred |= {(i, *s[:3]) for s in model_spans(tokens, ps, "lenient")}
    row = metrics.entity_metrics(seqs).first()
    p, r = ratio(len(true & pred), len(pred)), ratio(len(true & pred), len(true))
    assert (row.support, row.predicted, row.hits) == (len(true), len(pred), len(true & pred))
    assert (row.entity_precision, row.entity_recall) == pytest.approx((p, r))
    assert row.entity_f1 == pytest.approx(f1(p, r))
    rows = {r.type: r for r in metrics.type_entity_metrics(metrics.rates(metrics.span_counts(seqs))).collect()}
    assert set(rows) == {P, C, "micro avg", "macro avg", "weighted avg"}
    assert rows["micro avg"].f1 == pytest.approx(row.entity_f1)
    assert rows["macro avg"].f1 == pytest.approx((rows[P].f1 + rows[C].f1) / 2)


def exact(true, pred, strict):
    whole, part = True, False
    for t in ENTITY_TYPES:
        a, b = set(true.get(t, [])), set(pred.get(t, []))
        if a == b:
            continue
        if a & b:
            part = True
            whole = whole and not strict
        else:
            whole = False
    return whole, part


@pytest.mark.parametrize("strict", [False, True])
def test_exact_match_equals_sets(seqs, data, strict):
    results = []
    for _, tokens, ts, ps in data:
        sides = []
        for tags in (ts, ps):
            found = {}
            for s in model_spans(tokens, tags, "strict"):
                found.setdefault(s[0], []).append(s[3])
            sides.append(found)
        results.append(exact(*sides, strict))
    row = metrics.exact_match(metrics.with_exact_match(seqs, partial_breaks_exact=strict)).first()
    assert row.exact_matches == sum(r[0] for r in results)
    assert row.partial_matches == sum(r[1] for r in results)


@pytest.mark.parametrize(
    "true, pred, flags",
    [
        ({P: ["x", "y"]}, {P: ["x"]}, (True, True)),
        ({}, {}, (True, False)),
        ({P: ["x"]}, {}, (False, False)),
        ({P: ["x", "x"]}, {P: ["x"]}, (True, False)),
    ],
)
def test_exact_match_cases(spark, true, pred, flags):
    full = [{t: d.get(t, []) for t in ENTITY_TYPES} for d in (true, pred)]
    df = spark.createDataFrame(
        [tuple(full)], "true_entities map<string,array<string>>, pred_entities map<string,array<string>>"
    )
    row = metrics.exact_match_of_entities(df).first()
    assert (row.exact, row.partial) == flags


def test_no_records_give_null_rates(seqs):
    row = metrics.exact_match(metrics.with_exact_match(seqs.limit(0))).first()
    assert row.total_examples == 0 and row.exact_match_accuracy is None


def test_one_pass_equals_the_single_metrics(seqs):
    counts = metrics.evaluation_counts(seqs)
    long = {(r.grain, r.key, r.metric): r.value for r in metrics.metrics_long(counts).collect()}
    token = metrics.token_metrics(metrics.token_pairs(seqs)).first()
    entity = metrics.entity_metrics(seqs).first()
    match = metrics.exact_match(metrics.with_exact_match(seqs)).first()
    assert long["overall", "", "token_f1"] == pytest.approx(token.token_f1)
    assert long["overall", "", "entity_f1"] == pytest.approx(entity.entity_f1)
    assert long["overall", "", "exact_match_accuracy"] == pytest.approx(match.exact_match_accuracy)
    assert long["overall", "", "num_sequences"] == 300
    for r in metrics.exact_match_by_type(metrics.with_exact_match(seqs)).collect():
        assert long["exact", r.type, "exact_match_rate"] == pytest.approx(r.exact_match_rate)
    summary = {r.metric: r.value for r in metrics.summary(counts).collect()}
    assert set(summary) == set(metrics.SUMMARY_METRICS)
    report = {r.type: r for r in metrics.per_type_report(metrics.metrics_long(counts)).collect()}
    assert list(report) == ENTITY_TYPES or set(report) == set(ENTITY_TYPES)
    assert report[P].b_f1 == pytest.approx(long["label", f"B-{P}", "f1"])
    assert report["OEM"].entity_f1 is None and report["OEM"].exact_match_rate == 1.0


def test_all_metrics_scan_the_data_once(spark, seqs, tmp_path):
    seqs.write.parquet(str(tmp_path / "seqs"))
    counts = metrics.evaluation_counts(spark.read.parquet(str(tmp_path / "seqs")))
    long = metrics.metrics_long(counts)
    long.collect()
    plan = long._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1


def test_unequal_lengths(spark):
    df = spark.createDataFrame([(1, ["a"], ["O"], ["O", "O"])], SCHEMA)
    assert [r.record_id for r in metrics.misaligned(df).collect()] == [1]
    with pytest.raises(Exception, match="differ in length"):
        metrics.evaluate_predictions(df).collect()


def test_pairing_two_tables(spark):
    true = spark.createDataFrame([(1, ["a"], ["O"]), (2, ["b"], ["O"])], "record_id bigint, tokens array<string>, tags array<string>")
    pred = spark.createDataFrame([(1, ["O"]), (3, ["O"])], "record_id bigint, tags array<string>")
    paired = {r.record_id: (r.tokens, r.true_tags, r.pred_tags) for r in metrics.pair_sequences(true, pred).collect()}
    assert paired == {1: (["a"], ["O"], ["O"]), 2: (["b"], ["O"], None), 3: (None, None, ["O"])}
    assert {(r.record_id, r.side) for r in metrics.unpaired_records(true, pred).collect()} == {(2, "true"), (3, "pred")}


def test_mean_f1_lists_every_type(seqs):
    tokens = metrics.type_token_metrics(metrics.label_rates(metrics.confusion(metrics.token_pairs(seqs))))
    by_tag = {r.tag: r.f1 for r in tokens.collect()}
    means = {r.type: r.mean_f1 for r in metrics.mean_f1_by_type(tokens).collect()}
    assert means[P] == pytest.approx((by_tag[f"B-{P}"] + by_tag[f"I-{P}"]) / 2)
    assert means["OEM"] == 0.0 and len(means) == 11


def test_errors(seqs, data):
    pairs = metrics.token_pairs(seqs)
    wrong = [(t, p) for _, _, ts, ps in data for t, p in zip(ts, ps) if t != p]
    kinds = Counter(
        "false_positive" if t == "O" else "false_negative" if p == "O" else "misclassification" for t, p in wrong
    )
    assert {r.error_type: r.n for r in errors.error_counts(pairs).collect()} == {**kinds, "all": len(wrong)}
    shares = {r.error_type: r.percentage for r in errors.error_distribution(pairs).collect()}
    assert sum(shares.values()) == pytest.approx(100)
    top = errors.top_confusion_pairs(pairs, 3).collect()
    ranked = sorted(Counter(f"{t} -> {p}" for t, p in wrong).items(), key=lambda x: (-x[1], x[0]))
    assert [(r.pair, r.n) for r in top] == ranked[:3]


def test_error_examples_take_whole_records(seqs, data):
    ids = [i for i, _, ts, ps in data if ts != ps]
    got = errors.error_examples(seqs, limit=10).collect()
    assert {r.record_id for r in got} == set(ids[:10])
    assert len(got) == sum(t != p for i, _, ts, ps in data if i in ids[:10] for t, p in zip(ts, ps))
    everything = errors.error_examples(seqs)
    assert everything.count() == errors.errors(metrics.token_pairs(seqs)).count()
    matrix = errors.entity_error_matrix(everything).collect()
    assert sum(r.n for r in matrix) == everything.count()
    assert {r.true_type for r in matrix} <= {"O", P, C}


def test_no_errors_give_a_zero_total(spark):
    df = spark.createDataFrame([(1, ["a"], ["O"], ["O"])], SCHEMA)
    pairs = metrics.token_pairs(df)
    assert [(r.error_type, r.n) for r in errors.error_counts(pairs).collect()] == [("all", 0)]
    assert errors.error_distribution(pairs).count() == 0


def _by_model(rows):
    """Counters of `evaluation_counts`, by loops."""
    found = Counter()
    for _, tokens, ts, ps in rows:
        for a, b in zip(ts, ps):
            found["pair", a or "", b or ""] += 1
        lenient = [{(s[0], s[1], s[2]) for s in model_tag_spans(tags)} for tags in (ts, ps)]
        for grain, spans in (("span_true", lenient[0]), ("span_pred", lenient[1]), ("span_hit", lenient[0] & lenient[1])):
            found.update((grain, s[0], "") for s in spans)
        sides = []
        for tags in (ts, ps):
            words = model_spans(tokens, [t or "" for t in tags], "strict")
            sides.append({(s[0], s[3]) for s in words if s[0] in ENTITY_TYPES})
        flags = {}
        for t in ENTITY_TYPES:
            a, b = ({x for x in side if x[0] == t} for side in sides)
            found["match", t, "total"] += 1
            flags[t] = "exact" if a == b else "partial" if a & b else ""
            if flags[t]:
                found["match", t, flags[t]] += 1
        found["record", "sequences", ""] += 1
        found["record", "exact", ""] += all(flags.values())
        found["record", "partial", ""] += "partial" in flags.values()
    return +found


def model_tag_spans(tags):
    """Spans of any type in lenient mode: blanks close, what is no tag is passed over."""
    spans, before = [], None
    for i, tag in enumerate(tags):
        tag = tag or "O"
        if tag != "O" and tag[:2] not in ("B-", "I-"):
            continue
        if tag[:2] == "I-" and before and before[2:] == tag[2:] and before != "O":
            spans[-1][2] = i
        elif tag != "O":
            spans.append([tag[2:], i, i])
        before = tag
    return spans


def test_counters_equal_loops(spark, monkeypatch):
    """Records of any length, several pieces, unknown and empty types, NULL tags, no tags at all."""
    from titlespan.operators import comparison

    monkeypatch.setattr(comparison, "PIECE_TOKENS", 40)
    rng = random.Random(11)
    choices = ["O", "", None, "bad", f"B-{P}", f"I-{P}", f"I-{C}", "B-", "I-", "B-neu", "I-neu", "b"]
    rows = []
    for i in range(400):
        k = rng.choice([0, 1, 3, 9, 60])
        true = rng.choices(choices, k=k)
        rows.append((i, rng.choices(["x", "y", "ä b", ""], k=k), true, [t if rng.random() < 0.8 else rng.choice(choices) for t in true]))
    df = spark.createDataFrame([*rows, (None, None, None, None)], SCHEMA).repartition(3)
    got = {(r.grain, r.k1, r.k2): r.n for r in metrics.evaluation_counts(df).collect()}
    assert {(g, a, "" if g == "record" else b): n for (g, a, b), n in got.items()} == _by_model(rows)
    by = metrics.evaluation_counts(df.selectExpr("*", "record_id % 2 AS part"), by=["part"]).collect()
    summed = Counter()
    for r in by:
        summed[r.grain, r.k1, r.k2] += r.n
    assert summed == got and {r.part for r in by} == {0, 1}
    flags = metrics.with_exact_match(df).filter("record_id IS NULL").first()
    assert flags.exact is None and flags.partial is None and len(flags.by_type) == len(ENTITY_TYPES)
    assert metrics.exact_match(metrics.with_exact_match(df)).first().total_examples == 401


def test_records_are_compared_once(spark, seqs, tmp_path):
    """The report compares the records in one pass."""
    seqs.write.parquet(str(tmp_path / "seqs"))
    counts = metrics.evaluation_counts(spark.read.parquet(str(tmp_path / "seqs")))
    report = metrics.per_type_report(metrics.metrics_long(counts))
    report.collect()
    plan = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("MapInArrow") == 1
