import random
from collections import Counter

import pytest

from tests.model import transitions
from tests.test_spans import SEQ, random_sequences
from titlespan.operators import checks
from titlespan.types import ENTITY_TYPES, SUBMISSION_COLUMNS

REC = "record_id bigint, tokens array<string>, entities map<string, array<string>>"


def rules(df):
    return sorted((r.rule, r.record_id, r.pos, r.col, r.detail, r.n) for r in df.collect())


def test_input(spark):
    df = spark.createDataFrame([("a", None), (None, None)], "title string, EAN string")
    found = rules(checks.validate_input(df, ["title", "EAN", "OEM"]))
    assert found == sorted(
        [
            ("missing_column", None, None, "OEM", None, 1),
            ("null_values", None, None, "title", None, 1),
            ("null_values", None, None, "EAN", None, 2),
        ],
    )
    empty = df.limit(0)
    assert [r[0] for r in rules(checks.validate_input(empty, ["title"]))] == ["empty_table"]
    assert checks.missing_columns(df)[:2] == ["Hersteller", "Kompatible_Fahrzeug_Marke"]


def test_alignment(spark):
    df = spark.createDataFrame(
        [
            (1, ["a", "b"], ["B-Hersteller", ""]),
            (2, ["a", "b", "c"], ["O", "B-X", "bad"]),
            (3, ["a"], ["O", "O"]),
            (4, ["a", "b"], [None, "I-EAN"]),
        ],
        SEQ,
    )
    assert rules(checks.validate_alignment(df)) == [
        ("bad_tag", 2, 1, None, "B-X", 1),
        ("bad_tag", 2, 2, None, "bad", 1),
        ("length_mismatch", 3, None, None, "1 tokens, 2 tags", 1),
    ]
    first = checks.record_violations(df, checks.alignment_findings("tokens", "tags", first_only=True))
    assert [r[2] for r in rules(first) if r[0] == "bad_tag"] == [1]
    upper = {r[1]: r[4] for r in rules(checks.validate_alignment(df, pattern="upper"))}
    assert upper == {1: "B-Hersteller", 2: "bad", 3: "1 tokens, 2 tags"}
    assert [r[1] for r in rules(checks.length_violations(df))] == [3]


def test_transitions_equal_the_loop(spark):
    data = [(i, t, g) for i, t, g, _ in random_sequences(1000, 5)]
    found = checks.validate_sequence(spark.createDataFrame(data, SEQ)).collect()
    want = sorted((i, pos) for i, _, tags in data for pos in transitions(tags))
    assert sorted((r.record_id, r.pos) for r in found) == want


@pytest.mark.parametrize(
    "tags, bad",
    [
        (["B-P", "I-F"], [1]),
        (["I-P"], []),
        (["B-P", "O", "I-F"], []),
        (["B-P", "", "I-F"], []),
        (["B-P", "X", "I-F"], [2]),
    ],
)
def test_transition_cases(spark, tags, bad):
    df = spark.createDataFrame([(1, tags, tags)], SEQ)
    assert [r.pos for r in checks.validate_sequence(df).collect()] == bad


def test_entities_against_tokens(spark):
    df = spark.createDataFrame(
        [
            (1, ["a", "b"], {"Produktart": ["a a"]}),
            (2, ["a"], {"Produktart": ["z"]}),
            (3, ["a", "a"], {"Produktart": ["a"], "Farbe": ["a"]}),
            (4, ["a"], {"Foo": []}),
        ],
        REC,
    )
    overuse = ("token_overuse", 1, None, None, "a", 1)
    unknown = ("unknown_token", 2, None, None, "z", 1)
    foreign_type = ("unknown_type", 4, None, None, "Foo", 1)
    assert rules(checks.validate_entities(df)) == sorted([overuse, foreign_type])
    assert rules(checks.validate_reconstruction(df)) == sorted([overuse, unknown, foreign_type])


def test_multisets_equal_counter(spark):
    rng = random.Random(2)
    data = [
        (i, rng.choices("abcd", k=rng.randrange(0, 9)), {"OEM": [" ".join(rng.choices("abcde", k=5))]})
        for i in range(400)
    ]
    found = checks.validate_reconstruction(spark.createDataFrame(data, REC)).collect()
    want = {
        (i, token, used - Counter(tokens)[token])
        for i, tokens, entities in data
        for token, used in Counter(entities["OEM"][0].split(" ")).items()
        if used > Counter(tokens)[token]
    }
    assert {(r.record_id, r.detail, r.n) for r in found} == want


def test_submission_cells(spark):
    row = {c: "x" for c in SUBMISSION_COLUMNS}
    bad = [{"Farbe": "a\tb"}, {"Farbe": "a\nb"}, {"EAN": "a\rb"}, {"OEM": None}]
    schema = ", ".join(f"{c} string" for c in SUBMISSION_COLUMNS)
    df = spark.createDataFrame([tuple({**row, **b}.values()) for b in bad], schema)
    found = {(r.rule, r.col): r.n for r in checks.validate_submission(df).collect()}
    assert found == {
        ("tab", "Farbe"): 1,
        ("line_break", "Farbe"): 1,
        ("line_break", "EAN"): 1,
        ("non_string", "OEM"): 1,
    }
    with pytest.raises(ValueError, match="line_break EAN"):
        checks.assert_submission(df)
    with pytest.raises(ValueError, match="column_mismatch"):
        checks.assert_submission(df.limit(0).select("id"))
    checks.assert_submission(df.limit(0))


def test_data_quality(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", 1.0), ("a", None), ("", None), (None, 2.0), ("x" * 1001, 2.0)],
        "s string, v double",
    )
    rows = {r.col: r for r in checks.data_quality(df).collect()}
    assert rows["s"].total_records == 6 and rows["s"].duplicate_rows == 1
    assert (rows["s"].null_count, rows["s"].empty_count, rows["s"].max_length) == (1, 1, 1001)
    assert rows["s"].very_long and not rows["v"].very_long
    assert rows["v"].null_count == 2


def test_duplicates_tell_null_from_text(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("null", "a")], "x string, y string")
    assert checks.data_quality(df).first().duplicate_rows == 0


def test_summary(spark):
    df = spark.createDataFrame([(1, ["a"], []), (2, [], ["O"]), (3, ["a"], ["bad"])], SEQ)
    rows = {r.rule: r for r in checks.validation_summary(checks.validate_alignment(df)).collect()}
    assert {k: r.violations for k, r in rows.items()} == {"length_mismatch": 2, "bad_tag": 1, "all": 3}
    clean = checks.validation_summary(checks.validate_alignment(df.limit(0))).collect()
    assert [(r.rule, r.is_valid) for r in clean] == [("all", True)]


def test_types_listed_once():
    assert len(set(ENTITY_TYPES)) == 11


def test_usage_equals_counter(spark):
    """Any number of records a batch, empty and repeated texts, NULLs; one call whatever reads it."""
    rng = random.Random(3)
    rows = []
    for i in range(200):
        tokens = rng.choices(["a", "b", "ä", ""], k=rng.randrange(0, 6))
        texts = [" ".join(rng.choices(["a", "b", "neu", ""], k=rng.randrange(1, 4))) for _ in range(rng.randrange(0, 3))]
        rows.append((i, tokens, {"Farbe": texts}))
    odd = [(900, None, {"Farbe": ["a"]}), (901, ["a"], None), (902, ["a"], {"Farbe": ["neu", None]}), (903, ["a"], {"Farbe": None})]
    df = spark.createDataFrame([*rows, *odd], "record_id bigint, tokens array<string>, entities map<string,array<string>>")
    expected = set()
    for i, tokens, entities in rows:
        used, have = Counter(w for t in entities["Farbe"] for w in t.split(" ")), Counter(tokens)
        for w, n in used.items():
            if n > have[w]:
                expected.add(("token_overuse" if have[w] else "unknown_token", i, w, n - have[w]))
    found = checks.validate_reconstruction(df)
    assert {(r.rule, r.record_id, r.detail, r.n) for r in found.collect()} == expected
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("+- ArrowEvalPython") + plan.count(": ArrowEvalPython") == 1 and "map_zip_with" not in plan
