import gzip

import pytest

from titlespan import session
from titlespan.operators import checks, tagger
from titlespan.plans import jobs
from titlespan.sources import samples, store, tsv
from titlespan.streaming import incremental


def write_gz(path, text):
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write(text)
    return str(path)


def test_read_keeps_text_as_it_is(spark, tmp_path):
    path = write_gz(
        tmp_path / "a.tsv.gz",
        'id\ttitle\tFarbe\n1\tNA\t\n\n2\t"a ""b""\tc"\tnull\n\tÖl für\tNaN\n3\n',
    )
    rows = tsv.read_tsv_gz(spark, path).collect()
    assert sorted(tuple(r) for r in rows) == [
        ("", "Öl für", "NaN"),
        ("1", "NA", ""),
        ("2", 'a "b"\tc', "null"),
        ("3", "", ""),
    ]


def test_other_delimiter_and_encoding(spark, tmp_path):
    path = tmp_path / "a.gz"
    path.write_bytes(gzip.compress("id;title\n1;Öl\n".encode("latin-1")))
    rows = tsv.read_tsv_gz(spark, str(path), delimiter=";", encoding="ISO-8859-1").collect()
    assert [tuple(r) for r in rows] == [("1", "Öl")]


def test_multiline(spark, tmp_path):
    path = write_gz(tmp_path / "a.gz", 'id\ttitle\n1\t"a\nb"\n')
    assert tsv.read_tsv_gz(spark, path, multiline=True).first().title == "a\nb"


def test_path_checks(spark, tmp_path):
    with pytest.raises(ValueError):
        tsv.read_tsv_gz(spark, str(tmp_path / "a.tsv"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tsv.read_tsv_gz(spark, str(tmp_path / "none.gz"))


def test_corrupt_rows_and_fallback(spark, tmp_path):
    path = write_gz(tmp_path / "a.gz", 'a\tb\n1\tx\n2\ty\textra\n3\n4\t"open\n')
    read = tsv.read_tsv_gz(spark, path, keep_corrupt=True)
    long = tsv.corrupt_rows(read).collect()
    assert [(r.line, r.n_fields, r.fields) for r in long] == [("2\ty\textra", 3, ["2", "y", "extra"])]
    rows = {r.a: r.b for r in tsv.with_fallback(read).collect()}
    assert rows["1"] == "x" and rows["2"] == "y" and rows["3"] == "" and set(rows) == {"1", "2", "3", "4"}


def test_default_read_loses_nothing(spark, tmp_path):
    stray = write_gz(tmp_path / "a.gz", 'id\ttitle\tEAN\n1\t"Bosch 12\t4711\n2\tx\t5\n')
    assert sorted(map(tuple, tsv.read_tsv_gz(spark, stray).collect())) == [
        ("1", '"Bosch 12', "4711"), ("2", "x", "5"),
    ]
    surplus = write_gz(tmp_path / "b.gz", "id\ttitle\n1\tx\textra\n")
    with pytest.raises(Exception, match="more fields than the header"):
        tsv.read_tsv_gz(spark, surplus).collect()
    assert [tuple(r) for r in tsv.read_tsv_gz(spark, surplus, on_surplus="drop").collect()] == [("1", "x")]
    read = tsv.read_tsv_gz(spark, surplus, keep_corrupt=True)
    assert [tuple(r) for r in tsv.surplus_violations(read).collect()] == [
        ("surplus_fields", None, "1\tx\textra", 1)
    ]


def test_headers_are_matched_by_name(spark, tmp_path):
    (tmp_path / "one").mkdir()
    (tmp_path / "two").mkdir()
    write_gz(tmp_path / "one" / "a.gz", "id\ttitle\tEAN\n1\tx\t5\n")
    write_gz(tmp_path / "two" / "a.gz", "id\tEAN\ttitle\n2\t6\ty\n")
    read = tsv.read_tsv_gz(spark, [f"{tmp_path}/one/*.gz", f"{tmp_path}/two/*.gz"])
    assert sorted((r.id, r.title, r.EAN) for r in read.collect()) == [("1", "x", "5"), ("2", "y", "6")]
    with pytest.raises(Exception, match="header"):
        tsv.read_tsv_gz(spark, f"{tmp_path}/*/*.gz").collect()


def test_streams_check_what_they_write(spark, tmp_path):
    schema = "record_id string, tokens array<string>, tags array<string>"
    spark.createDataFrame([("a\tb", ["x"], ["O"])], schema).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    with pytest.raises(Exception, match="TAB, a line break or NULL"):
        incremental.submission_stream(
            stream, str(tmp_path / "out"), str(tmp_path / "state")
        ).awaitTermination()


def test_file_info(spark, tmp_path):
    write_gz(tmp_path / "a.gz", "x\ny\n")
    (tmp_path / "b.txt").write_text("x\ny\nz")
    rows = {r.file_path.rsplit("/", 1)[1]: r for r in tsv.file_info(spark, str(tmp_path)).collect()}
    assert rows["a.gz"].is_compressed and rows["a.gz"].total_lines is None
    assert rows["b.txt"].total_lines == 3 and rows["b.txt"].file_size_bytes == 5
    assert rows["b.txt"].file_size_mb == 0.0


def test_few_files_are_spread(spark, tmp_path):
    path = write_gz(tmp_path / "a.gz", "id\n" + "\n".join(map(str, range(100))))
    assert tsv.read_tsv_gz(spark, path).rdd.getNumPartitions() == 1
    assert tsv.read_tsv_gz(spark, path, partitions=5).rdd.getNumPartitions() == 5
    spark.range(100).repartition(20).write.parquet(str(tmp_path / "many"))
    many = spark.read.parquet(str(tmp_path / "many"))
    assert session.spread(many) is many


def test_shared_folder_is_the_sessions(spark):
    assert session.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session.new_path(spark, "x") != session.new_path(spark, "x")


def test_save_json(spark, tmp_path):
    df = spark.createDataFrame([("a", None)], "metric string, value double")
    store.save_json(df, str(tmp_path / "m"))
    assert [r.value for r in spark.read.text(str(tmp_path / "m")).collect()] == ['{"metric":"a","value":null}']


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(
        [
            ("1", "Bosch Öl", "B-Hersteller", "B-Produktart"),
            ("2", "ATE Öl x", "B-Hersteller", "B-Produktart"),
            ("x3", "Bosch x", "B-Hersteller", "O"),
        ],
        "id string, title string, t0 string, t1 string",
    )


def test_jobs(spark, raw, tmp_path):
    model, report, out = (str(tmp_path / n) for n in ("model", "report", "out"))
    found = {r.rule: r.violations for r in jobs.train(raw, ["t0", "t1"], model).collect()}
    assert found == {"all": 0}
    per_type = {r.type: r for r in jobs.evaluate(spark, model, raw, ["t0", "t1"], report).collect()}
    assert per_type["Hersteller"].entity_f1 == 1.0 and per_type["Produktart"].b_f1 == 1.0
    assert spark.read.json(f"{report}/metrics").filter("metric = 'token_accuracy'").first().value == 1.0
    assert jobs.predict(spark, model, raw, out) == 3
    rows = {r.id: (r.Hersteller, r.Produktart) for r in tsv.read_submission(spark, out).collect()}
    assert rows == {"1": ("Bosch", "Öl"), "2": ("ATE", "Öl"), "x3": ("Bosch", "")}


def test_stream_equals_batch(spark, raw, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    lexicon = store.written(
        tagger.fit(
            spark.createDataFrame([("Bosch", "B-Hersteller"), ("Öl", "B-Produktart")], "token string, tag string")
        ),
        "lexicon",
    )
    raw.select("id", "title").repartition(3, "id").write.option("sep", "\t").option("header", True).csv(source)
    stream = incremental.tsv_stream(spark, source, ["id", "title"], files_per_trigger=1)
    checkpoint = str(tmp_path / "state")
    incremental.tagged_submission_stream(stream, lexicon, out, checkpoint).awaitTermination()
    batch_out = str(tmp_path / "batch")
    store.save_model(lexicon, str(tmp_path / "model"))
    jobs.predict(spark, str(tmp_path / "model"), raw, batch_out)
    want = sorted(tsv.read_submission(spark, batch_out).collect())
    assert sorted(incremental.read_batches(spark, out).collect()) == want
    # A second start finds nothing new and adds nothing.
    incremental.tagged_submission_stream(stream, lexicon, out, checkpoint).awaitTermination()
    assert sorted(incremental.read_batches(spark, out).collect()) == want


def test_running_counts_and_quality(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([(["O", "B-OEM", None],), (["O"],), ([],)], "tags array<string>").write.parquet(source)
    stream = spark.readStream.schema("tags array<string>").parquet(source)
    query = (
        incremental.running_tag_counts(stream)
        .writeStream.outputMode("complete")
        .format("memory")
        .queryName("tag_counts")
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert {r.tag: r.n for r in spark.table("tag_counts").collect()} == {"O": 2, "B-OEM": 1, "": 1}
    out = str(tmp_path / "quality")
    incremental.quality_stream(stream, out, str(tmp_path / "state2")).awaitTermination()
    assert incremental.running_quality(out, stream.sparkSession.read.parquet(source)).first().total_records == 3


def quality(df):
    return sorted(map(repr, df.collect()))


def test_quality_runs_over_batches(spark, tmp_path):
    """Copies in different batches are duplicates, also after the stream has been stopped."""
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "_c long, text string, n int"
    for part in ([(1, "a", 1), (2, None, 1)], [(1, "a", 1), (3, "", None)], [(1, "a", 1), (4, "b" * 1500, 2)]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    incremental.quality_stream(stream, out, state).awaitTermination()
    seen = spark.read.schema(schema).parquet(source)
    assert spark.read.parquet(out).count() == 3
    assert quality(incremental.running_quality(out, seen)) == quality(checks.data_quality(seen))
    assert incremental.running_quality(out, seen).first().duplicate_rows == 2
    spark.createDataFrame([(1, "a", 1), (5, "c", 1)], schema).coalesce(1).write.mode("append").parquet(source)
    incremental.quality_stream(stream, out, state).awaitTermination()
    seen = spark.read.schema(schema).parquet(source)
    assert quality(incremental.running_quality(out, seen)) == quality(checks.data_quality(seen))
    assert incremental.running_quality(out, seen).first().duplicate_rows == 3


STRAY = ["id\tname\tbrand", '1\t"open\tB1', '2\t"quoted ""x"""\tB2', "3\tshort", "4\ta\tb\tmore\tyet more", "", '5\t\t""']


def test_streamed_files_are_read_as_in_a_batch(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(3):
        with gzip.open(folder / f"f{i}.tsv.gz", "wt") as f:
            f.write("\n".join(STRAY) + "\n")
    columns = ["id", "name", "brand"]
    raw = incremental.tsv_stream(spark, str(folder), columns, files_per_trigger=2, keep_corrupt=True)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    incremental.ingest_stream(raw, out, state).awaitTermination()
    got = sorted(map(tuple, incremental.read_ingested(spark, out).collect()))
    batch = tsv.read_tsv_gz(spark, f"{folder}/*.gz", on_surplus="drop")
    assert got == sorted(map(tuple, batch.collect())) and len(got) == 15
    assert ("1", '"open', "B1") in got and ("3", "short", "") in got
    found = incremental.read_ingested(spark, out, "violations").collect()
    assert [(r.rule, r.detail, r.n) for r in found] == [("surplus_fields", STRAY[4], 2)] * 3
    with pytest.raises(ValueError):
        incremental.tsv_stream(spark, str(folder), columns, on_surplus="ignore")


def test_a_surplus_field_fails_the_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "f.tsv").write_text("\n".join(STRAY))
    rows = incremental.tsv_stream(spark, str(folder), ["id", "name", "brand"])
    query = rows.writeStream.format("memory").queryName("surplus").option("checkpointLocation", str(tmp_path / "s"))
    with pytest.raises(Exception, match="more fields than the header has"):
        query.trigger(availableNow=True).start().awaitTermination()


def test_streams_take_the_newest_model(spark, tmp_path, monkeypatch):
    """One dictionary per version, whatever the number of batches."""
    path, source, out = (str(tmp_path / n) for n in ("models", "in", "out"))
    with pytest.raises(ValueError, match="no version"):
        incremental.Models(spark, path).current()
    schema = "token string, tag string"
    first = tagger.fit(spark.createDataFrame([("Bosch", "B-Hersteller")], schema))
    second = tagger.fit(spark.createDataFrame([("Bosch", "B-Produktart")], schema))
    assert store.save_version(first, path) == 1
    made = []
    monkeypatch.setattr(incremental, "held", lambda *a: made.append(1) or tagger.held(*a))
    models = incremental.Models(spark, path)
    for i in range(4):
        spark.createDataFrame([(str(i), "Bosch")], "id string, title string").write.mode("append").parquet(source)
    stream = spark.readStream.schema("id string, title string").option("maxFilesPerTrigger", 1).parquet(source)
    state = str(tmp_path / "state")
    incremental.tagged_submission_stream(stream, models, out, state).awaitTermination()
    assert len(made) == 1 and {r.Hersteller for r in incremental.read_batches(spark, out).collect()} == {"Bosch"}
    assert store.save_version(second, path) == 2 and store.latest_version(spark, path) == 2
    (tmp_path / "models" / "version=9" / "lexicon").mkdir(parents=True)
    assert store.latest_version(spark, path) == 2
    spark.createDataFrame([("9", "Bosch")], "id string, title string").write.mode("append").parquet(source)
    incremental.tagged_submission_stream(stream, models, out, state).awaitTermination()
    rows = {r.id: (r.Hersteller, r.Produktart) for r in incremental.read_batches(spark, out).collect()}
    assert len(made) == 2 and len(rows) == 5 and rows["9"] == ("", "Bosch") and rows["0"] == ("Bosch", "")


def test_samples_train_a_model(spark):
    titles = samples.sample_titles(samples.ids(spark, 20))
    assert titles.columns[:2] == ["id", "title"] and titles.count() == 20
