import pytest

from titlespan.operators import checks
from titlespan.operators import submission as ops
from titlespan.sources import samples, tsv
from titlespan.types import ENTITY_TYPES, SUBMISSION_COLUMNS

SCHEMA = ", ".join(f"{c} string" for c in SUBMISSION_COLUMNS)


def table(spark, *rows):
    return spark.createDataFrame([(str(i), *r) for i, r in enumerate(rows)], SCHEMA)


def test_records_without_spans_survive(spark):
    seqs = spark.createDataFrame(
        [(1, ["Bosch", "ATE", "x"], ["B-Hersteller", "B-Hersteller", "O"]), (2, ["x"], ["O"]), (3, [], [])],
        "record_id bigint, tokens array<string>, tags array<string>",
    )
    rows = {r.id: r for r in ops.submission(seqs).collect()}
    assert rows["1"].Hersteller == "Bosch|ATE" and rows["1"].Farbe == ""
    assert set(rows) == {"1", "2", "3"}
    assert list(rows["2"][1:]) == [""] * 11


def test_format_predictions(spark):
    df = spark.createDataFrame(
        [(7, ["a", "b"], "x", 0, 2.5, False), (8, [], None, 3, 0.0, True)],
        "record_id bigint, OEM array<string>, EAN string, Anzahl int, Material double, Zustand boolean",
    )
    rows = ops.format_predictions(df).orderBy("id").collect()
    assert ops.format_predictions(df).columns == SUBMISSION_COLUMNS
    assert (rows[0].OEM, rows[0].EAN, rows[0].Anzahl, rows[0].Material, rows[0].Zustand) == ("a|b", "x", "", "2.5", "")
    assert (rows[1].OEM, rows[1].EAN, rows[1].Anzahl, rows[1].Material, rows[1].Zustand) == ("", "", "3", "", "True")


def test_stats(spark):
    df = table(spark, ["a|b"] + [""] * 10, [" "] + ["x"] * 10)
    rows = {r.type: r for r in ops.submission_stats(df).collect()}
    first = rows["Hersteller"]
    assert (first.non_empty_count, first.empty_count, first.has_multiple_entities) == (1, 1, 1)
    written = "\t".join(SUBMISSION_COLUMNS) + "\n" + "\n".join("\t".join(r) for r in df.collect()) + "\n"
    assert first.size_bytes == len(written.encode())


def test_merge_with_metadata(spark):
    df = table(spark, ["a"] + [""] * 10, ["b"] + [""] * 10)
    meta = spark.createDataFrame([(0, "k")], "id bigint, kind string")
    merged = {r.id: r.kind for r in ops.merge_with_metadata(df, meta).collect()}
    assert merged == {"0": "k", "1": None}
    assert ops.merge_with_metadata(df, meta.select("kind")) is df
    assert ops.merge_with_metadata(df) is df


def test_round_trip_is_verbatim(spark, tmp_path):
    awkward = ['"q"', ' "a" b ', "'", "\\", "a\\", "ä|ö", "#x", "NA", "null", "", " "]
    df = table(spark, awkward, [""] * 11, awkward[::-1])
    for header in (True, False):
        path = str(tmp_path / f"out-{header}")
        tsv.save_submission(df, path, include_header=header)
        assert tsv.verify_output(spark, path, has_header=header) == 3
        assert sorted(tsv.read_submission(spark, path, header).collect()) == sorted(df.collect())


def test_written_text_has_no_quotes(spark, tmp_path):
    path = str(tmp_path / "out")
    tsv.save_submission(table(spark, ['say "x"'] + [""] * 10).coalesce(1), path)
    lines = [r.value for r in spark.read.text(path).collect()]
    assert lines == ["\t".join(SUBMISSION_COLUMNS), '0\tsay "x"' + "\t" * 10]


@pytest.mark.parametrize("cell", ["a\tb", "a\nb", "a\rb", None])
def test_bad_cells_fail_the_write(spark, tmp_path, cell):
    path = tmp_path / "out"
    with pytest.raises(Exception, match="column OEM"):
        tsv.save_submission(table(spark, [""] * 10 + [cell]), str(path))
    assert not (path / "_SUCCESS").exists()


def test_wrong_columns_fail(spark, tmp_path):
    df = table(spark, [""] * 11)
    with pytest.raises(ValueError):
        tsv.save_submission(df.drop("OEM"), str(tmp_path / "a"))
    df.write.option("header", True).option("sep", ",").csv(str(tmp_path / "b"))
    with pytest.raises(ValueError):
        tsv.verify_output(spark, str(tmp_path / "b"))


def test_samples(spark):
    rows = samples.sample_titles(samples.ids(spark, 200)).collect()
    assert rows == samples.sample_titles(samples.ids(spark, 200)).collect()
    for r in rows:
        assert r.title == f"{r.Hersteller} {r.Produktart} für {r.Kompatible_Fahrzeug_Marke} {r.Kompatibles_Fahrzeug_Modell}"
        assert len(r.Herstellernummer) == 6 and len(r.EAN) == 13 and r.OEM == ""
    new = sum(r.Zustand == "Neu" for r in rows)
    assert 110 < new < 170
    sample = {r.id: r for r in samples.sample_submission(samples.ids(spark, 5)).collect()}
    assert sample["0"].EAN == "SampleEAN_0" and sample["1"].EAN == "SampleEAN_1|SampleEAN_2"
    assert list(sample["2"][1:]) == [""] * len(ENTITY_TYPES)


def test_repeated_metadata_is_an_error(spark):
    df = spark.createDataFrame([("1",)], "id string")
    meta = spark.createDataFrame([(1, "a"), (1, "b")], "id int, kind string")
    with pytest.raises(Exception, match="more than once"):
        ops.merge_with_metadata(df, meta).collect()


def test_unknown_types_are_errors(spark):
    seqs = spark.createDataFrame(
        [(1, ["a", "b"], ["B-Foo", "B-EAN"])], "record_id int, tokens array<string>, tags array<string>"
    )
    with pytest.raises(Exception, match="unknown type"):
        ops.submission(seqs).collect()
    found = [(r.rule, r.pos, r.detail) for r in checks.unknown_types(seqs).collect()]
    assert found == [("unknown_type", 0, "Foo")]
    assert ops.submission(seqs, on_error="empty").first().EAN == ""
