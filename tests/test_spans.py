import random

import pytest
from pyspark.sql import functions as F

from tests.model import spans as expected_spans
from titlespan.functions import tags as G
from titlespan.operators import spans as ops
from titlespan.types import ENTITY_TYPES

P, C = "Produktart", "Farbe"
SEQ = "record_id bigint, tokens array<string>, tags array<string>"
# tags (P, F for the two types, _ for blank) → strict, lenient
CASES = [
    ("B-P _ O O", [(P, "a b")], [(P, "a")]),
    ("_ B-P _ _", [(P, "b c d")], [(P, "b")]),
    ("B-P B-P O O", [(P, "a"), (P, "b")], [(P, "a"), (P, "b")]),
    ("I-P I-P O O", [(P, "a b")], [(P, "a b")]),
    ("B-P I-F I-F O", [(P, "a"), (C, "b c")], [(P, "a"), (C, "b c")]),
    ("B-F X I-F O", [(C, "a"), (C, "c")], [(C, "a c")]),
    ("B-P O _ I-P", [(P, "a"), (P, "d")], [(P, "a"), (P, "d")]),
    ("B-P I-P I-P I-P", [(P, "a b c d")], [(P, "a b c d")]),
    ("O O O O", [], []),
]


def parse(text):
    words = {"P": P, "F": C}
    return [
        "" if t == "_" else t[:2] + words[t[2:]] if t[2:] in words else t for t in text.split()
    ]


@pytest.mark.parametrize("tags, strict, lenient", CASES)
def test_rule_table(spark, tags, strict, lenient):
    df = spark.createDataFrame([(1, list("abcd"), parse(tags))], SEQ)
    for mode, want in (("strict", strict), ("lenient", lenient)):
        rows = ops.spans(df, mode).orderBy("span_no").collect()
        assert [(r.type, r.text) for r in rows] == want, mode


def test_reference_mode(spark):
    schema = SEQ + ", ref array<string>"
    tags = parse("B-P O I-P O")
    df = spark.createDataFrame(
        [(1, list("abcd"), tags, ["x", "", "", "x"]), (2, list("abcd"), tags, list("xxxx"))], schema
    )
    rows = ops.spans(df, "reference", reference_col="ref").orderBy("record_id", "span_no").collect()
    assert [(r.record_id, r.text) for r in rows] == [(1, "a b c"), (2, "a"), (2, "c")]


def test_duplicates_are_kept(spark):
    df = spark.createDataFrame([(1, ["VW", "VW"], parse("B-P B-P"))], SEQ)
    assert ops.entities(df).first().entities[P] == ["VW", "VW"]


def random_sequences(n, seed):
    rng = random.Random(seed)
    choices = ["O", "", None, "bad", "B-Farbe", "I-Farbe", "I-OEM", "B-OEM", "I-Foo"]
    rows = []
    for i in range(n):
        k = rng.randrange(0, 15)
        tokens = [rng.choice(["VW", "Golf", "x", "7"]) for _ in range(k)]
        rows.append((i, tokens, rng.choices(choices, k=k), rng.choices(["", None, "x"], k=k)))
    return rows


@pytest.mark.parametrize("mode", G.MODES)
def test_array_and_long_form_equal_the_loop(spark, mode):
    data = random_sequences(1500, 11)
    df = spark.createDataFrame(data, SEQ + ", ref array<string>")
    ref = "ref" if mode == "reference" else None
    want = sorted(
        (i, *s)
        for i, tokens, tags, refs in data
        for s in expected_spans(tokens, tags, mode, refs if ref else None)
    )
    array_form = ops.spans(df, mode, reference_col=ref).collect()
    assert sorted((r.record_id, r.type, r.start_pos, r.end_pos, r.text) for r in array_form) == want

    tagged = df.select(
        "record_id", F.posexplode(F.arrays_zip("tokens", "tags", "ref")).alias("pos", "z")
    ).select("record_id", "pos", F.col("z.tokens").alias("token"), F.col("z.tags").alias("tag"), "z.ref")
    for block in (3, 4096):
        long_form = ops.spans_from_long(tagged, mode, ref, block=block).collect()
        got = sorted((r.record_id, r.type, r.start_pos, r.end_pos, r.text) for r in long_form)
        assert got == want, block


def test_tag_spans_equal_spans_without_text(spark):
    data = [(i, t, g) for i, t, g, _ in random_sequences(500, 3)]
    df = spark.createDataFrame(data, SEQ)
    for mode in ("strict", "lenient"):
        got = {(r.record_id, r.type, r.start_pos, r.end_pos) for r in ops.tag_spans(df, mode).collect()}
        spans = ops.spans(df, mode).collect()
        known = {s for s in got if s[1] in ENTITY_TYPES}
        assert known == {
            (r.record_id, r.type, r.start_pos, r.end_pos) for r in spans if r.type in ENTITY_TYPES
        }


def test_errors(spark):
    short = spark.createDataFrame([(1, list("abcd"), parse("O O O"))], SEQ)
    unknown = spark.createDataFrame([(2, list("abcd"), parse("B-Foo O B-P O"))], SEQ)
    with pytest.raises(Exception, match="4 tokens but 3 tags"):
        ops.spans(short).collect()
    with pytest.raises(Exception, match="unknown type"):
        ops.spans(unknown, on_error="raise").collect()
    assert [r.text for r in ops.spans(unknown, "lenient").collect()] == ["c"]
    rows = ops.batch_reconstruct(short.union(unknown)).collect()
    assert len(rows) == 2
    assert all(set(r.entities) == set(ENTITY_TYPES) and not any(r.entities.values()) for r in rows)
    with pytest.raises(ValueError):
        ops.spans(short, "reference")


def test_one_long_record_is_linear(spark):
    """A 200,000-token record: quadratic work would not end in test time."""
    df = spark.range(1).selectExpr(
        "id AS record_id",
        "transform(sequence(1, 200000), i -> concat('w', i)) AS tokens",
        "transform(sequence(1, 200000), i -> if(i % 5 = 0, 'B-OEM', 'I-OEM')) AS tags",
    )
    assert ops.spans(df).count() == 40_001
    assert ops.spans(df, "lenient").count() == 40_001


def test_no_shuffle_and_no_second_evaluation(spark):
    df = spark.createDataFrame([(1, "a b", ["O", "O"])], "record_id bigint, title string, tags array<string>")
    seqs = df.selectExpr("record_id", "split(title, ' ') AS tokens", "tags")
    plan = ops.spans(seqs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert plan.count("split(") == 1


def test_one_record_with_most_of_a_long_table(spark):
    """Its blocks are spread over tasks, and spans cross their borders."""
    seqs = spark.range(50).selectExpr(
        "id AS record_id",
        "transform(sequence(1, if(id = 0, 60000, 20)), i -> concat('w', i)) AS tokens",
        "transform(sequence(1, if(id = 0, 60000, 20)), i -> "
        "CASE WHEN i % 997 = 0 THEN 'B-OEM' WHEN i % 1501 = 0 THEN 'O' ELSE '' END) AS tags",
    )
    tagged = seqs.select(
        "record_id", F.posexplode(F.arrays_zip("tokens", "tags")).alias("pos", "z")
    ).selectExpr("record_id", "pos", "z.tokens AS token", "z.tags AS tag")
    want = ops.spans(seqs).drop("span_no").collect()
    got = ops.spans_from_long(tagged, block=500).select("record_id", "type", "start_pos", "end_pos", "text")
    assert len(want) > 50
    assert sorted(got.collect()) == sorted(want)


def test_whole_spans_meet_no_others(spark):
    """Only pieces at the edges of blocks are shuffled once more."""
    tagged = spark.range(1000).selectExpr(
        "id % 2 AS record_id", "CAST(id div 2 AS INT) AS pos", "'t' AS token", "if(id % 6 < 2, 'B-EAN', 'O') AS tag"
    )
    found = ops.spans_from_long(tagged, block=100)
    assert found.count() == 334
    lines = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    # Below the union, the first side is exploded as it is; only the second one is grouped by its spans.
    assert lines[0].startswith("Union") and "start_pos" in lines[1] and lines[2].startswith(":  +- Generate")
    grouped = [line for line in lines if "Aggregate" in line and "start_pos" in line]
    assert len(grouped) == 1 and grouped[0].startswith("+- Aggregate")


@pytest.mark.parametrize("mode", ["strict", "lenient"])
def test_texts_outside_spans_are_not_shuffled(spark, mode):
    """of a token that no span can hold only the tag travels, and the spans are those of the arrays."""
    tags = ["B-Farbe", "I-Farbe", "O", "I-Farbe", "", "bad", "", "B-OEM", "O", None, "I-OEM"]
    rows = [(r, p, f"w{r}.{p}", tags[(r + p * p) % len(tags)]) for r in range(12) for p in range(40)]
    long = spark.createDataFrame(rows, "record_id int, pos int, token string, tag string")
    found = ops.spans_from_long(long, mode, block=8)
    arrays = long.groupBy("record_id").agg(F.expr("sort_array(collect_list(struct(pos, token, tag))) AS z"))
    whole = ops.spans(arrays.selectExpr("record_id", "z.token AS tokens", "z.tag AS tags"), mode).drop("span_no")
    order = sorted(whole.columns)
    assert sorted(map(repr, found.select(order).collect())) == sorted(map(repr, whole.select(order).collect()))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert any("AS item#" in line and "else null" in line for line in plan.splitlines())
