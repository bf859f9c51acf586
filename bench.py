"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from titlespan.plans.queries import registry

HEADLINES = [
    "submission_rows",
    "token_features",
    "spans_strict",
    "spans_lenient",
    "spans_long_form",
    "confusion_matrix",
    "token_metrics",
    "entity_metrics",
    "exact_match",
    "metrics_long",
    "top_confusions",
    "validation_summary",
    "token_overuse",
    "data_quality",
    "data_quality_lineitem",
    "lexicon_fit",
    "lexicon_predict",
    "predict_submission",
    "predict_listings",
    "stratified_folds",
    "cv_summary",
    "tsv_roundtrip",
    "stream_submission",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("titlespan-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry()
    # One run before the clock starts: session start and class loading belong to no query.
    queries["submission_rows"](spark, folder).write.format("noop").mode("overwrite").save()

    seconds = {}
    for name in HEADLINES:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)

    documents = spark.read.parquet(f"{folder}/documents.parquet").count()
    titles = spark.read.parquet(f"{folder}/part.parquet").count()
    print(
        json.dumps(
            {
                "metric": "titlespan headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                # Whole documents of some 400 words, and short titles including training.
                "documents_per_sec": round(documents / seconds["submission_rows"]),
                "titles_per_sec": round(titles / seconds["predict_listings"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
