"""Every registered query against its SQL, over the smallest tables."""

import glob
import os

import pytest

import __spark_entry__ as entry_points
from tests.conftest import SMALL

duckdb = pytest.importorskip("duckdb")

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables here")
QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        table = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return connection


def cell(value):
    return round(value, 6) + 0.0 if isinstance(value, float) else value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(repr([cell(row[i]) for i in order]) for row in rows)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, database, name):
    result = QUERIES[name](spark, SMALL)
    rows = result.collect()
    assert rows
    if name not in ORACLES:
        return
    cursor = database.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(result.columns)
    assert rows_of(result.columns, rows) == rows_of(columns, cursor.fetchall())


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    flagship = entry_points.entry(spark)
    assert flagship.columns[0] == "id" and len(flagship.columns) == 12


def test_tags_follow_their_rule(spark):
    """The look-up gives what the rule says, also without an id or with a negative one."""
    from titlespan.plans import inputs
    from titlespan.types import ENTITY_TYPES

    rows = [(i, [("x" * (1 + (i + j) % 9)) for j in range(i % 60)]) for i in [*range(0, 400, 3), 2**55, -1, -17, -303]]
    df = spark.createDataFrame([*rows, (None, ["a", "bc"])], "record_id bigint, tokens array<string>")
    other = [*ENTITY_TYPES[:-1], inputs.UNKNOWN_TYPE]
    rules = {
        inputs._true_tags(): inputs.true_tag("record_id", "i", "t"),
        inputs._true_tags(other): inputs.true_tag("record_id", "i", "t", other),
        inputs._PRED_TAGS: inputs.pred_tag("record_id", "i", "t"),
    }
    for quick, rule in rules.items():
        sides = df.selectExpr("record_id", f"{quick} AS a", f"transform(tokens, (t, i) -> {rule}) AS b")
        assert sides.filter("NOT a <=> b").count() == 0 and sides.count() == len(rows) + 1
    assert "CASE" not in inputs._PRED_TAGS.split("transform(tokens, (t, i) -> ")[1]


def test_tags_made_in_batches_follow_their_rule(spark, monkeypatch):
    """Tags come from Arrow batches, some records at a time, and equal the rule's for any id and text;
    no lambda runs over the tokens of a record that has a place in the table."""
    from titlespan.plans import inputs
    from titlespan.types import ENTITY_TYPES

    monkeypatch.setattr(inputs, "TAGGED_RECORDS", 7)
    ids = [*range(0, 400, 3), 2**55, -1, -17, -303, None, 3]
    rows = [(i, " ".join("xü😀"[j % 3] * (1 + j % 9) for j in range((i or 5) % 60))) for i in ids]
    titles = spark.createDataFrame([*rows, (4, None), (5, " \t")], "record_id bigint, title string")
    found = inputs.tagged_in_batches(titles)
    for column, rule in (("true_tags", inputs.true_tag), ("pred_tags", inputs.pred_tag)):
        plain = f"transform(tokens, (t, i) -> {rule('record_id', 'i', 't')})"
        assert found.filter(f"NOT {column} <=> {plain}").count() == 0
    assert found.count() == len(rows) + 2
    assert "ArrowEvalPython" in found._jdf.queryExecution().executedPlan().toString()
    other = inputs._tags_in_batches([*ENTITY_TYPES[:-1], inputs.UNKNOWN_TYPE])
    assert found.select("tokens", "record_id").limit(0).select(other).collect() == []
