"""Train, evaluate and predict as jobs over TSV or tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from titlespan.operators import checks, metrics, tagger
from titlespan.operators.submission import submission
from titlespan.operators.tokens import true_tags
from titlespan.sources import store
from titlespan.sources.tsv import save_submission, verify_output


def train(
    raw: DataFrame, tag_cols: list[str], model_path: str, id_col: str = "id", title_col: str = "title"
) -> DataFrame:
    """R1 → V1, V3 → M1 → S10. Returns the summary of the input's violations."""
    seqs = true_tags(raw, tag_cols, id_col, title_col)
    in_records = checks.record_violations(
        seqs,
        checks.alignment_findings("tokens", "true_tags"),
        checks.sequence_findings("true_tags"),
    )
    # Ids may be of any type, and the summary needs none.
    found = checks.validate_input(raw, [title_col]).select("rule").unionByName(
        in_records.select("rule")
    )
    store.save_model(tagger.fit_sequences(seqs), model_path)
    return checks.validation_summary(found)


def evaluate(
    spark: SparkSession,
    model_path: str,
    raw: DataFrame,
    tag_cols: list[str],
    report_path: str,
    id_col: str = "id",
    title_col: str = "title",
) -> DataFrame:
    """S10 → M8 → S9 → A14. Writes the metrics as JSON, returns the report per type."""
    lexicon = store.load_model(spark, model_path)
    store.save_json(
        tagger.evaluate_model(raw, lexicon, tag_cols, id_col, title_col), f"{report_path}/metrics"
    )
    # The report reads the few hundred rows just written, not the data again.
    written = spark.read.schema("grain string, key string, metric string, value double").json(
        f"{report_path}/metrics"
    )
    report = metrics.per_type_report(written)
    store.save_json(report, f"{report_path}/per_type")
    return report


def predict(
    spark: SparkSession,
    model_path: str,
    raw: DataFrame,
    out: str,
    id_col: str = "id",
    title_col: str = "title",
) -> int:
    """S10 → T1 → M3 → E1 → F2 → S7, S8. Returns the number of rows written."""
    lexicon = store.load_model(spark, model_path)
    tagged = tagger.predict(raw, lexicon, id_col, title_col)
    save_submission(submission(tagged, tag_col="pred_tags"), out)
    return verify_output(spark, out)
