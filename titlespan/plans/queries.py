"""The registered queries: each takes the session and a folder of tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titlespan.operators import (
    checks,
    errors,
    folds,
    metrics,
    spans,
    submission,
    tagger,
    tokens,
)
from titlespan.plans import inputs, jobs
from titlespan.session import new_path
from titlespan.sources import samples, store, tsv
from titlespan.streaming import incremental
from titlespan.types import decode_label, encode_label, labels

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    _REGISTRY[function.__name__] = function
    return function


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    """Ratios to six places, so that the order of a sum cannot show."""
    return df.withColumns({n: F.round(n, 6) for n in names})


def _true_sequences(spark: SparkSession, d: str) -> DataFrame:
    return inputs.sequences(spark, d).withColumnRenamed("true_tags", "tags")


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    return metrics.token_pairs(inputs.sequences(spark, d))


# --- tokens ------------------------------------------------------------------------------


@query
def token_counts(spark, d):
    titled = tokens.with_tokens(inputs.documents(spark, d))
    return titled.select("record_id", F.size("tokens").alias("n_tokens"))


@query
def tokens_long(spark, d):
    return tokens.tokens_long(inputs.documents(spark, d))


@query
def token_features(spark, d):
    return tokens.token_features(inputs.documents(spark, d)).drop(
        "prev_token", "prev_length", "next_token", "next_length"
    )


@query
def token_context(spark, d):
    return tokens.token_features(inputs.documents(spark, d)).select(
        "record_id", "pos", "token", "prev_token", "prev_length", "next_token", "next_length"
    )


@query
def token_case(spark, d):
    flags = ["is_uppercase", "is_lowercase", "is_title_case"]
    return (
        tokens.token_features(inputs.documents(spark, d))
        .groupBy("token", *flags)
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query
def token_dictionary(spark, d):
    return tokens.token_features(inputs.term_listings(spark, d)).select(
        "record_id", "pos", "token", "is_abbreviation", "is_common_automotive_term"
    )


@query
def training_rows(spark, d):
    wide = inputs.wide_listings(spark, d)
    # Every tenth step is NULL, which reads as `O`.
    holed = wide.withColumns(
        {f"t{i}": F.nullif(F.col(f"t{i}"), F.lit("bad")) for i in range(inputs.WIDE_COLUMNS)}
    )
    return tokens.training_rows(holed)


@query
def label_encode(spark, d):
    tagged = tokens.tagged_long(inputs.sequences(spark, d)).select("record_id", "pos", "tag")
    coded = tagged.selectExpr("*", f"{encode_label('tag')} AS label_id")
    return coded.selectExpr("*", f"{decode_label('label_id')} AS label")


# --- spans -------------------------------------------------------------------------------


@query
def spans_strict(spark, d):
    return spans.spans(_true_sequences(spark, d))


@query
def spans_lenient(spark, d):
    return spans.spans(_true_sequences(spark, d), mode="lenient")


@query
def spans_reference(spark, d):
    return spans.spans(
        inputs.sequences(spark, d), "reference", tag_col="pred_tags", reference_col="true_tags"
    )


@query
def spans_long_form(spark, d):
    return spans.spans_from_long(tokens.tagged_long(inputs.sequences_in_batches(spark, d)))


@query
def tag_spans(spark, d):
    return spans.tag_spans(_true_sequences(spark, d))


def _entity_rows(entities: DataFrame) -> DataFrame:
    rows = entities.select("record_id", F.explode_outer("entities").alias("type", "texts"))
    return rows.select(
        "record_id",
        "type",
        F.size("texts").alias("n_entities"),
        F.array_join("texts", "|").alias("texts"),
    )


@query
def entities_wide(spark, d):
    return _entity_rows(spans.entities(_true_sequences(spark, d)))


@query
def batch_reconstruct(spark, d):
    return _entity_rows(spans.batch_reconstruct(inputs.faulty_sequences(spark, d)))


# --- checks ------------------------------------------------------------------------------


@query
def length_violations(spark, d):
    return checks.length_violations(inputs.faulty_sequences(spark, d))


@query
def input_violations(spark, d):
    table = inputs.table(spark, d, "documents")
    kept = table.withColumn("lang", F.nullif(F.col("lang"), F.lit("de")))
    return checks.validate_input(kept, ["doc_id", "lang", "title", "text", "EAN"])


@query
def bad_tags(spark, d):
    return checks.validate_alignment(inputs.faulty_sequences(spark, d))


@query
def bad_tags_upper(spark, d):
    return checks.validate_alignment(inputs.faulty_sequences(spark, d), pattern="upper")


@query
def bad_transitions(spark, d):
    return checks.validate_sequence(_true_sequences(spark, d))


def _doubtful_entities(spark: SparkSession, d: str) -> DataFrame:
    """Entities of the documents, some of them twice, some with a foreign word."""
    record_id = F.col("record_id")
    texts = F.transform("spans", lambda s: s["text"])
    twice = F.when(record_id % 3 == 0, F.concat(texts, texts)).otherwise(texts)
    foreign = F.array(F.concat(F.lit("fremd§ "), record_id.cast("string")))
    found = F.when(record_id % 4 == 0, F.concat(twice, foreign)).otherwise(twice)
    with_texts = spans.with_spans(_true_sequences(spark, d))
    return with_texts.select(
        "record_id", "tokens", F.create_map(F.lit("Produktart"), found).alias("entities")
    )


@query
def token_overuse(spark, d):
    return checks.token_overuse(_doubtful_entities(spark, d))


@query
def unknown_tokens(spark, d):
    return checks.unknown_tokens(_doubtful_entities(spark, d))


@query
def reconstruction_violations(spark, d):
    return checks.validate_reconstruction(_doubtful_entities(spark, d))


@query
def unknown_types(spark, d):
    return checks.unknown_types(inputs.faulty_sequences(spark, d))


@query
def submission_violations(spark, d):
    table = inputs.table(spark, d, "documents")
    raw = table.select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("text").alias("Hersteller"),
        F.nullif(F.col("lang"), F.lit("de")).alias("Farbe"),
        F.concat(F.col("source"), F.lit("\t")).alias("Material"),
        F.col("n_chars").alias("Anzahl"),
    )
    return checks.validate_submission(raw)


@query
def data_quality(spark, d):
    return checks.data_quality(inputs.table(spark, d, "documents"))


@query
def data_quality_lineitem(spark, d):
    return checks.data_quality(inputs.table(spark, d, "lineitem"))


@query
def validation_summary(spark, d):
    faulty = inputs.faulty_sequences(spark, d)
    found = checks.record_violations(
        faulty,
        checks.length_findings("tokens", "tags"),
        checks.alignment_findings("tokens", "tags"),
        checks.sequence_findings("tags"),
    )
    return checks.validation_summary(found)


# --- metrics -----------------------------------------------------------------------------


@query
def token_pairs(spark, d):
    seqs = inputs.sequences_in_batches(spark, d)
    return metrics.pair_long(
        tokens.tagged_long(seqs, "true_tags"), tokens.tagged_long(seqs, "pred_tags")
    )


@query
def confusion_matrix(spark, d):
    return metrics.confusion(_pairs(spark, d))


@query
def confusion_pivot(spark, d):
    # The tags of the inputs: the labels, blank, and one that is no tag.
    return metrics.confusion_matrix(metrics.confusion(_pairs(spark, d)), [*labels(), "", "bad"])


@query
def labels_seen(spark, d):
    return metrics.labels_seen(_pairs(spark, d))


@query
def per_label_metrics(spark, d):
    scored = metrics.per_label(metrics.confusion(_pairs(spark, d)))
    return _rounded(scored, "precision", "recall", "f1")


@query
def token_metrics(spark, d):
    averages = metrics.token_metrics(_pairs(spark, d))
    return _rounded(averages, *[c for c in averages.columns if c != "support"])


def _type_token_metrics(spark: SparkSession, d: str) -> DataFrame:
    return metrics.type_token_metrics(metrics.label_rates(metrics.confusion(_pairs(spark, d))))


@query
def type_token_metrics(spark, d):
    return _rounded(_type_token_metrics(spark, d), "precision", "recall", "f1")


@query
def mean_f1_by_type(spark, d):
    return _rounded(metrics.mean_f1_by_type(_type_token_metrics(spark, d)), "mean_f1")


@query
def entity_metrics(spark, d):
    found = metrics.entity_metrics(inputs.sequences(spark, d))
    return _rounded(found, "entity_precision", "entity_recall", "entity_f1")


@query
def type_entity_metrics(spark, d):
    rates = metrics.rates(metrics.span_counts(inputs.sequences(spark, d)))
    return _rounded(metrics.type_entity_metrics(rates), "precision", "recall", "f1")


@query
def exact_match(spark, d):
    found = metrics.exact_match(metrics.with_exact_match(inputs.sequences(spark, d)))
    return _rounded(found, "exact_match_accuracy", "partial_match_accuracy")


@query
def exact_match_by_type(spark, d):
    found = metrics.exact_match_by_type(metrics.with_exact_match(inputs.sequences(spark, d)))
    return _rounded(found, "exact_match_rate", "partial_match_rate")


@query
def metrics_long(spark, d):
    counts = metrics.evaluation_counts(inputs.sequences(spark, d))
    return _rounded(metrics.metrics_long(counts), "value")


@query
def metrics_summary(spark, d):
    counts = metrics.evaluation_counts(inputs.sequences(spark, d))
    return _rounded(metrics.summary(counts), "value")


@query
def evaluate_predictions(spark, d):
    seqs = inputs.tagged(inputs.conversations(spark, d))
    return _rounded(metrics.evaluate_predictions(seqs), "value")


@query
def eval_from_wide(spark, d):
    true = inputs.wide_listings(spark, d)
    predicted = inputs.wide_listings(spark, d, inputs.pred_tag, "p").drop("title")
    names = range(inputs.WIDE_COLUMNS)
    seqs = tokens.sequences_from_wide(
        true.join(predicted, "record_id"),
        [f"t{i}" for i in names],
        [f"p{i}" for i in names],
        token_col="title",
    )
    return _rounded(metrics.evaluate_predictions(seqs), "value")


@query
def per_type_report(spark, d):
    counts = metrics.evaluation_counts(inputs.sequences(spark, d))
    report = metrics.per_type_report(metrics.metrics_long(counts))
    return _rounded(report, *[c for c in report.columns if c not in ("type_no", "type")])


# --- errors ------------------------------------------------------------------------------


@query
def error_rows(spark, d):
    return errors.errors(_pairs(spark, d))


@query
def error_types(spark, d):
    return errors.error_counts(_pairs(spark, d))


@query
def confusion_pairs(spark, d):
    return errors.confusion_pairs(_pairs(spark, d))


@query
def error_distribution(spark, d):
    return _rounded(errors.error_distribution(_pairs(spark, d)), "percentage")


@query
def top_confusions(spark, d):
    return _rounded(errors.top_confusion_pairs(_pairs(spark, d)), "percentage")


@query
def error_examples(spark, d):
    return errors.error_examples(inputs.sequences(spark, d))


@query
def entity_error_matrix(spark, d):
    return errors.entity_error_matrix(errors.error_examples(inputs.sequences(spark, d)))


@query
def entity_error_matrix_all(spark, d):
    return errors.entity_error_matrix(errors.errors(_pairs(spark, d)))


# --- submission --------------------------------------------------------------------------


@query
def submission_rows(spark, d):
    return submission.submission(_true_sequences(spark, d))


@query
def format_predictions(spark, d):
    part = inputs.table(spark, d, "part")
    predicted = part.select(
        F.col("p_partkey").alias("record_id"),
        F.split("p_name", " ").alias("Produktart"),
        F.col("p_brand").alias("Hersteller"),
        F.nullif(F.col("p_type"), F.lit("ECONOMY")).alias("Zustand"),
        (F.col("p_size") % 5).alias("Anzahl"),
        F.when(F.col("p_size") > 10, F.array("p_type", "p_brand"))
        .otherwise(F.array().cast("array<string>"))
        .alias("OEM"),
    )
    return submission.format_predictions(predicted)


@query
def submission_stats(spark, d):
    stats = submission.submission_stats(submission.submission(_true_sequences(spark, d)))
    return _rounded(stats, "size_mb")


@query
def submission_with_meta(spark, d):
    meta = inputs.table(spark, d, "labels").select(
        F.col("doc_id").alias("id"), "quality", "toxic"
    )
    return submission.merge_with_metadata(submission.submission(_true_sequences(spark, d)), meta)


@query
def submission_roundtrip(spark, d):
    path = new_path(spark, "submission")
    tsv.save_submission(submission.submission(_true_sequences(spark, d)), path)
    tsv.verify_output(spark, path)
    read = tsv.read_submission(spark, path)
    checks.assert_submission(read)
    return read


# --- tagger ------------------------------------------------------------------------------


def _model(spark: SparkSession, seqs: DataFrame) -> DataFrame:
    path = new_path(spark, "model")
    store.save_model(tagger.fit_sequences(seqs), path)
    return store.load_model(spark, path)


@query
def lexicon_fit(spark, d):
    fitted = tagger.fit_sequences(inputs.sequences_in_batches(spark, d))
    return _rounded(fitted, "confidence")


def _predictions(spark: SparkSession, d: str) -> DataFrame:
    lexicon = _model(spark, inputs.sequences(spark, d))
    return tagger.predict(inputs.conversations(spark, d), lexicon)


@query
def lexicon_predict(spark, d):
    return tokens.tagged_long(_predictions(spark, d), "pred_tags")


@query
def lexicon_confidence(spark, d):
    rows = tokens.tagged_long(_predictions(spark, d), "confidence")
    return _rounded(rows.withColumnRenamed("tag", "confidence"), "confidence")


@query
def align_predictions(spark, d):
    uneven = inputs.sequences(spark, d).select(
        "record_id",
        "tokens",
        F.when(F.col("record_id") % 2 == 0, F.concat("pred_tags", F.array(F.lit("B-EAN"))))
        .otherwise(F.slice("pred_tags", F.lit(1), F.ceil(F.size("pred_tags") / 2).cast("int")))
        .alias("pred_tags"),
    )
    return tokens.tagged_long(tagger.align(uneven), "pred_tags")


@query
def prediction_stats(spark, d):
    return _rounded(tagger.prediction_stats(inputs.sequences(spark, d)), "value")


@query
def evaluate_model(spark, d):
    wide = inputs.wide_listings(spark, d)
    names = [f"t{i}" for i in range(inputs.WIDE_COLUMNS)]
    lexicon = _model(spark, tokens.true_tags(wide, names))
    return _rounded(tagger.evaluate_model(wide, lexicon, names), "value")


def _digits_are_numbers(batch):
    return [["B-Anzahl" if t.isascii() and t.isdigit() else "O" for t in ts] for ts in batch]


@query
def user_model_predict(spark, d):
    titles = tokens.with_tokens(inputs.conversations(spark, d))
    predicted = tagger.predict_with(titles, _digits_are_numbers)
    return tokens.tagged_long(predicted, "pred_tags")


@query
def evaluate_user_model(spark, d):
    names = [f"t{i}" for i in range(inputs.WIDE_COLUMNS)]
    found = tagger.evaluate_model(inputs.wide_listings(spark, d), _digits_are_numbers, names)
    return _rounded(found, "value")


@query
def predict_repeated_ids(spark, d):
    """Titles whose ids repeat or are missing: a row each, told apart by their tags."""
    lexicon = _model(spark, inputs.sequences(spark, d))
    titles = inputs.conversations(spark, d)
    number = F.col("record_id")
    blurred = titles.withColumn("record_id", F.when(number % 5 != 0, number % 3))
    tagged = tagger.predict(blurred, lexicon)
    return tagged.select("record_id", *[F.array_join(c, " ").alias(c) for c in ("tokens", "pred_tags")])


@query
def saved_model_info(spark, d):
    """M7 beside the entries it describes."""
    path = new_path(spark, "model")
    store.save_model(tagger.fit_sequences(inputs.sequences(spark, d)), path)
    entries = store.load_model(spark, path).agg(F.count(F.lit(1)).alias("n_entries"))
    info = store.load_info(spark, path).select("model_class", "num_labels", "is_trained")
    return info.join(entries)


def _gappy(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """True tags without every fifth record, predictions without every seventh and without the
    last tag of every third."""
    seqs = inputs.sequences(spark, d)
    true = seqs.filter("record_id % 5 <> 0").selectExpr("record_id", "tokens", "true_tags AS tags")
    short = "if(record_id % 3 = 0, slice(pred_tags, 1, greatest(size(pred_tags) - 1, 0)), pred_tags) AS tags"
    return true, seqs.filter("record_id % 7 <> 0").selectExpr("record_id", "tokens", short)


@query
def pairs_with_gaps(spark, d):
    """Two taggings that lack records and tokens of each other: a row for every token of either."""
    true, pred = _gappy(spark, d)
    return metrics.pair_long(tokens.tagged_long(true, "tags"), _tags_long(pred))


def _tags_long(seqs: DataFrame) -> DataFrame:
    return seqs.select("record_id", F.posexplode("tags").alias("pos", "tag"))


@query
def unpaired_tokens(spark, d):
    true, pred = _gappy(spark, d)
    pairs = metrics.pair_long(tokens.tagged_long(true, "tags"), _tags_long(pred))
    return metrics.unpaired_tokens(pairs)


@query
def pairing_violations(spark, d):
    """Records that do not pair up, also as their ids repeat."""
    true, pred = _gappy(spark, d)
    twice = pred.unionByName(pred.filter("record_id % 11 = 0"))
    return metrics.pairing_violations(true, twice)


@query
def paired_sequences(spark, d):
    true, pred = _gappy(spark, d)
    return metrics.pair_sequences(true, pred).selectExpr(
        "record_id", "size(tokens) AS n_tokens", "size(true_tags) AS n_true", "size(pred_tags) AS n_pred"
    )


# --- folds -------------------------------------------------------------------------------


def _binned(spark: SparkSession, d: str) -> DataFrame:
    return folds.with_length_bins(tokens.with_tokens(inputs.documents(spark, d)))


@query
def length_bins(spark, d):
    return _binned(spark, d).select("record_id", F.size("tokens").alias("n_tokens"), "bin")


@query
def stratified_folds(spark, d):
    return folds.stratified_folds(_binned(spark, d)).select("record_id", "bin", "fold")


@query
def cv_fold_metrics(spark, d):
    return _rounded(folds.cross_validate(inputs.sequences(spark, d)), "value")


@query
def cv_summary(spark, d):
    return _rounded(folds.cv_summary(folds.cross_validate(inputs.sequences(spark, d))), "mean", "std")


@query
def cv_user_model(spark, d):
    """Cross-validation of a model that its user fits: here the lexicon, once for each fold."""
    seqs = inputs.sequences_in_batches(spark, d).drop("pred_tags")
    scores = folds.cross_validate_with(lambda train: _model(spark, train), seqs)
    return _rounded(scores, "value")


# --- sources, sinks, jobs, streams -------------------------------------------------------


@query
def tsv_roundtrip(spark, d):
    path = new_path(spark, "listings")
    lines = inputs.documents(spark, d).select(
        F.col("record_id").cast("string").alias("id"),
        # One listing per line: line breaks of the text become spaces.
        F.regexp_replace("title", "[\r\n]+", " ").alias("title"),
        F.lit("NA").alias("Farbe"),
        F.lit("").alias("OEM"),
    )
    lines.write.option("sep", "\t").option("header", True).option("compression", "gzip").option(
        "escape", '"'
    ).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return tsv.read_tsv_gz(spark, f"{path}/*.gz")


def _lines_with_surplus(spark: SparkSession, d: str) -> str:
    """Gzip TSV of the parts; large ones carry a field too many."""
    path = new_path(spark, "lines")
    part = inputs.table(spark, d, "part")
    line = F.concat_ws("\t", F.col("p_partkey").cast("string"), "p_name", "p_brand")
    surplus = F.when(F.col("p_size") > 40, F.concat(line, F.lit("\textra"))).otherwise(line)
    # One column, whose name is the header line, under a separator no line holds.
    writer = tsv.write_options(part.select(surplus.alias("id\tname\tbrand")).write)
    writer.option("sep", "\u0001").option("header", True).option("compression", "gzip").csv(path)
    return f"{path}/*.gz"


@query
def tsv_corrupt_rows(spark, d):
    read = tsv.read_tsv_gz(spark, _lines_with_surplus(spark, d), keep_corrupt=True)
    return tsv.corrupt_rows(read).select("line", "n_fields")


@query
def tsv_fallback(spark, d):
    return tsv.read_tsv_gz(spark, _lines_with_surplus(spark, d), on_surplus="drop")


def _messy_lines(spark: SparkSession, d: str) -> list[str]:
    """Gzip TSV of the parts in two folders whose headers differ in order, with stray quotes and
    surplus fields."""
    part = inputs.table(spark, d, "part")
    stray = F.when(F.col("p_size") % 7 == 0, F.concat(F.lit('"'), F.col("p_name"))).otherwise(F.col("p_name"))
    columns = {"id": F.col("p_partkey").cast("string"), "name": stray, "brand": F.col("p_brand")}
    paths = []
    for parity, order in enumerate((["id", "name", "brand"], ["brand", "name", "id"])):
        path = new_path(spark, "messy")
        line = F.concat_ws("\t", *[columns[c] for c in order])
        surplus = F.when(F.col("p_size") > 40, F.concat(line, F.lit("\textra"))).otherwise(line)
        half = part.filter(F.col("p_partkey") % 2 == parity).select(surplus.alias("\t".join(order)))
        writer = tsv.write_options(half.write).option("sep", "\u0001")
        writer.option("header", True).option("compression", "gzip").csv(path)
        paths.append(f"{path}/*.gz")
    return paths


@query
def tsv_messy(spark, d):
    return tsv.read_tsv_gz(spark, _messy_lines(spark, d), on_surplus="drop")


@query
def tsv_surplus(spark, d):
    return tsv.surplus_violations(tsv.read_tsv_gz(spark, _messy_lines(spark, d), keep_corrupt=True))


@query
def file_info(spark, d):
    """Of the parts written as plain files, added up."""
    path = new_path(spark, "plain")
    part = inputs.table(spark, d, "part")
    lines = part.select(F.concat_ws("\t", F.col("p_partkey").cast("string"), "p_name", "p_brand"))
    lines.write.text(path)
    files = tsv.file_info(spark, path).groupBy("is_compressed")
    return files.agg(
        F.sum("file_size_bytes").alias("file_size_bytes"), F.sum("total_lines").alias("total_lines")
    ).withColumn("file_size_mb", F.round(F.col("file_size_bytes") / (1024 * 1024), 2))


@query
def sample_titles(spark, d):
    return samples.sample_titles(inputs.table(spark, d, "part"), "p_partkey")


@query
def sample_submission(spark, d):
    return samples.sample_submission(inputs.table(spark, d, "orders"), "o_orderkey")


@query
def train_job(spark, d):
    names = [f"t{i}" for i in range(inputs.WIDE_COLUMNS)]
    wide = inputs.wide_listings(spark, d)
    return jobs.train(wide, names, new_path(spark, "model"), id_col="record_id")


@query
def evaluate_job(spark, d):
    """The report per type, from metrics written and read back as JSON."""
    names = [f"t{i}" for i in range(inputs.WIDE_COLUMNS)]
    wide, model = inputs.wide_listings(spark, d), new_path(spark, "model")
    jobs.train(wide, names, model, id_col="record_id")
    report = jobs.evaluate(spark, model, wide, names, new_path(spark, "report"), id_col="record_id")
    return _rounded(report, *[c for c in report.columns if c not in ("type_no", "type")])


@query
def predict_submission(spark, d):
    model, out = new_path(spark, "model"), new_path(spark, "predictions")
    store.save_model(tagger.fit_sequences(inputs.sequences(spark, d)), model)
    jobs.predict(spark, model, inputs.conversations(spark, d), out, id_col="record_id")
    return tsv.read_submission(spark, out)


@query
def predict_listings(spark, d):
    """Short product titles end to end: train, save, load, predict, format."""
    wide = inputs.wide_listings(spark, d)
    names = [f"t{i}" for i in range(inputs.WIDE_COLUMNS)]
    lexicon = _model(spark, tokens.true_tags(wide, names))
    predicted = tagger.predict(inputs.listings(spark, d), lexicon)
    return submission.submission(predicted, tag_col="pred_tags")


@query
def stream_submission(spark, d):
    """The flagship on a stream: same expressions, same rows."""
    schema = spark.read.parquet(f"{d}/documents.parquet").schema
    stream = spark.readStream.schema(schema).parquet(f"{d}/documents.parque[t]")
    # The table is one file, hence one task; a folder of many files needs no shuffle here.
    stream = stream.repartition(spark.sparkContext.defaultParallelism)
    titles = stream.select(F.col("doc_id").alias("record_id"), F.col("text").alias("title"))
    seqs = inputs.tagged(titles).withColumnRenamed("true_tags", "tags")
    out = new_path(spark, "stream-out")
    started = incremental.submission_stream(seqs, out, new_path(spark, "stream-state"))
    started.awaitTermination()
    return tsv.read_submission(spark, out)


@query
def stream_titles(spark, d):
    """Titles in TSV files → stream → lexicon → spans → submission rows."""
    source, out = new_path(spark, "titles"), new_path(spark, "stream-out")
    titles = inputs.conversations(spark, d).select(
        F.col("record_id").cast("string").alias("id"),
        F.regexp_replace("title", "[\r\n\t]+", " ").alias("title"),
    )
    titles.write.option("sep", "\t").option("header", True).option("escape", '"').csv(source)
    lexicon = _model(spark, inputs.sequences(spark, d))
    stream = incremental.tsv_stream(spark, source, ["id", "title"])
    state = new_path(spark, "stream-state")
    incremental.tagged_submission_stream(stream, lexicon, out, state).awaitTermination()
    return incremental.read_batches(spark, out)


def _messy_stream(spark: SparkSession, d: str, **options) -> DataFrame:
    """The parts as a stream of gzip TSV files with stray quotes and surplus fields."""
    path = new_path(spark, "messy-stream")
    part = inputs.table(spark, d, "part")
    stray = F.when(F.col("p_size") % 7 == 0, F.concat(F.lit('"'), F.col("p_name"))).otherwise(F.col("p_name"))
    line = F.concat_ws("\t", F.col("p_partkey").cast("string"), stray, "p_brand")
    surplus = F.when(F.col("p_size") > 40, F.concat(line, F.lit("\textra"))).otherwise(line)
    writer = tsv.write_options(part.select(surplus.alias("id\tname\tbrand")).write).option("sep", "\u0001")
    writer.option("header", True).option("compression", "gzip").csv(path)
    return incremental.tsv_stream(spark, path, ["id", "name", "brand"], files_per_trigger=3, **options)


def _ingested(spark: SparkSession, d: str) -> str:
    out = new_path(spark, "ingested")
    raw = _messy_stream(spark, d, keep_corrupt=True)
    incremental.ingest_stream(raw, out, new_path(spark, "stream-state")).awaitTermination()
    return out


@query
def stream_messy(spark, d):
    """Rows of messy files over several micro-batches, as the batch read gives them."""
    return incremental.read_ingested(spark, _ingested(spark, d))


@query
def stream_surplus(spark, d):
    """The lines with surplus fields, beside the rows."""
    return incremental.read_ingested(spark, _ingested(spark, d), "violations")


@query
def stream_quality(spark, d):
    """Quality after the last of several micro-batches; copies of a row come in different ones."""
    source, out = new_path(spark, "quality-in"), new_path(spark, "quality-out")
    table = inputs.table(spark, d, "documents").select("text", "lang", "source")
    table.write.parquet(source)
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 3).parquet(source)
    incremental.quality_stream(stream, out, new_path(spark, "stream-state")).awaitTermination()
    return incremental.running_quality(out, table)


@query
def stream_versions(spark, d):
    """Titles tagged by the newest of two versions of a model, held as one dictionary."""
    model, source, out = (new_path(spark, n) for n in ("models", "titles", "stream-out"))
    seqs = inputs.sequences_in_batches(spark, d)
    store.save_version(tagger.fit_sequences(seqs, "pred_tags"), model)
    store.save_version(tagger.fit_sequences(seqs), model)
    titles = inputs.conversations(spark, d).select(F.col("record_id").cast("string").alias("id"), "title")
    titles.write.parquet(source)
    stream = spark.readStream.schema(titles.schema).option("maxFilesPerTrigger", 3).parquet(source)
    models = incremental.Models(spark, model)
    state = new_path(spark, "stream-state")
    incremental.tagged_submission_stream(stream, models, out, state).awaitTermination()
    return incremental.read_batches(spark, out)


@query
def stream_tag_counts(spark, d):
    """Running counts over a stream, as its last batch leaves them."""
    schema = spark.read.parquet(f"{d}/documents.parquet").schema
    stream = spark.readStream.schema(schema).parquet(f"{d}/documents.parque[t]")
    titles = stream.select(F.col("doc_id").alias("record_id"), F.col("text").alias("title"))
    counts = incremental.running_tag_counts(inputs.tagged(titles), "true_tags")
    out = new_path(spark, "stream-counts")
    incremental.latest(counts, out, new_path(spark, "stream-state")).awaitTermination()
    return spark.read.schema("tag string, n bigint").parquet(out)
