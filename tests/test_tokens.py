import random
import re

from pyspark.sql import functions as F

from titlespan.functions import tokens as T
from titlespan.operators import tokens as ops
from titlespan.types import ENTITY_TYPES, decode_label, encode_label, label_vocab, labels


def one(spark, sql, **values):
    """The value of an expression over one row of string columns."""
    schema = ", ".join(f"{k} string" for k in values)
    return spark.createDataFrame([tuple(values.values())], schema).select(F.expr(sql)).first()[0]


def test_tokenize_cases(spark):
    cases = {
        None: [],
        "": [],
        "  ": [],
        "a\tb  c": ["a", "b", "c"],
        "a b　c": ["a", "b", "c"],
        "a\x1cb c": ["a", "b", "c"],
        "Zahnriemensatz+WaPu VW VW": ["Zahnriemensatz+WaPu", "VW", "VW"],
    }
    df = spark.createDataFrame([(t,) for t in cases], "title string")
    rows = df.select("title", F.expr(T.tokenize("title"))).collect()
    assert {r[0]: r[1] for r in rows} == cases


def test_tokenize_equals_python_split(spark):
    alphabet = "aÄß9 \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85       　​"
    rng = random.Random(7)
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(0, 20))) for _ in range(500)]
    rows = (
        spark.createDataFrame([(t,) for t in texts], "t string")
        .select("t", F.expr(T.tokenize("t")))
        .collect()
    )
    assert all(r[1] == r[0].split() for r in rows)


def test_character_features_equal_python(spark):
    words = [
        "ÖL", "Öl", "öl", "3er", "B6", "VW-Golf", "McX", "C-Klasse", "STRAßE", "123", "²", "ª", "ªx",
        "ǅ", "ǅx", "ß", "a1B", "Ab Cd", "A.b", "٣", "①", "x²", "é", "É", "ÉA", "-", "1A", "A1a", "Ⅷ", "ⓐ",
    ]
    flags = {
        "is_numeric": str.isdigit,
        "is_alphanumeric": lambda w: bool(re.match(r"^[a-zA-Z0-9]+$", w)),
        "has_special_chars": lambda w: bool(re.search(r"[^a-zA-Z0-9\s]", w)),
        "is_uppercase": str.isupper,
        "is_lowercase": str.islower,
        "is_title_case": str.istitle,
        "contains_digit": lambda w: bool(re.search(r"\d", w)),
        "length": len,
    }
    df = spark.createDataFrame([(w,) for w in words], "w string")
    sql = T.features("w")
    rows = df.select("w", *[F.expr(sql[f]).alias(f) for f in flags]).collect()
    for row in rows:
        assert {f: row[f] for f in flags} == {f: g(row["w"]) for f, g in flags.items()}, row["w"]


def test_dictionary_flags(spark):
    assert one(spark, T.is_abbreviation("w"), w="WaPu")
    assert not one(spark, T.is_abbreviation("w"), w="wapu")
    assert one(spark, T.is_automotive_term("w"), w="KÜHLER")
    assert not one(spark, T.is_automotive_term("w"), w="WaPu")


def test_features_have_all_fields_and_neighbours(spark):
    df = spark.createDataFrame([(1, "Bosch Öl 5"), (2, " ")], "record_id bigint, title string")
    rows = ops.token_features(df).orderBy("pos").collect()
    assert [r.token for r in rows] == ["Bosch", "Öl", "5"]
    assert [(r.prev_token, r.prev_length) for r in rows] == [("<START>", 0), ("Bosch", 5), ("Öl", 2)]
    assert [(r.next_token, r.next_length) for r in rows] == [("Öl", 2), ("5", 1), ("<END>", 0)]
    assert [(r.is_first, r.is_last) for r in rows] == [(True, False), (False, False), (False, True)]


def test_training_rows(spark):
    df = spark.createDataFrame(
        [(1, "a b c", "B-OEM", None), (2, "", "O", "O")],
        "record_id bigint, title string, t0 string, t1 string",
    )
    rows = ops.training_rows(df).orderBy("pos").collect()
    assert [(r.record_id, r.token, r.tag) for r in rows] == [(1, "a", "B-OEM"), (1, "b", "O"), (1, "c", "O")]


def test_sequences_from_wide_closes_up_nulls(spark):
    df = spark.createDataFrame(
        [(1, "a  b", "O", None, "B-OEM", "O")],
        "record_id bigint, tokens string, t0 string, t1 string, t2 string, p0 string",
    )
    row = ops.sequences_from_wide(df, ["t0", "t1", "t2"], ["p0"]).first()
    assert row.tokens == ["a", "", "b"]
    assert row.true_tags == ["O", "B-OEM"] and row.pred_tags == ["O"]


def test_label_vocabulary(spark):
    assert len(labels()) == 2 * len(ENTITY_TYPES) + 1 == label_vocab(spark).count()
    assert one(spark, encode_label("t"), t="O") == 0
    assert one(spark, encode_label("t"), t="I-Hersteller") == 2
    assert one(spark, encode_label("t"), t="bad") is None
    assert one(spark, decode_label(encode_label("t")), t="B-OEM") == "B-OEM"
    assert one(spark, decode_label("23"), t="") is None


def test_neighbours_do_not_carry_the_token_array(spark):
    df = spark.createDataFrame([(1, "a b")], "record_id bigint, title string")
    plan = ops.token_features(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Window" not in plan
