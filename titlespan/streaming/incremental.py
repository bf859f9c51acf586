"""Incremental files to submission rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from titlespan.operators.checks import quality_counters, quality_table, row_digest
from titlespan.operators.dictionary import Held
from titlespan.operators.submission import submission
from titlespan.operators.tagger import MAX_BROADCAST_BYTES, held, predict
from titlespan.sources.store import latest_version, load_model
from titlespan.sources.tsv import (
    guarded,
    read_submission,
    surplus_violations,
    with_fallback,
    with_raw_lines,
    write_options,
)


def tsv_stream(
    spark: SparkSession,
    path: str,
    columns: list[str],
    files_per_trigger: int = 1000,
    delimiter: str = "\t",
    quotechar: str = '"',
    encoding: str = "utf-8",
    on_surplus: str = "raise",
    keep_corrupt: bool = False,
) -> DataFrame:
    """New files of a folder as a stream, every column a string, plain or gzip.

    Rows are read as `read_tsv_gz` reads them: a row that the quoted parse cannot place is split on
    the delimiter, a row with more fields than the header fails the stream or, with
    `on_surplus="drop"`, loses its last fields. With `keep_corrupt` the raw line of a row that does
    not fit is kept instead, for `ingest_stream`. A file whose header differs from `columns` fails
    the stream instead of swapping columns.
    """
    if on_surplus not in ("raise", "drop"):
        raise ValueError(f"on_surplus must be 'raise' or 'drop', got {on_surplus!r}")
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_trigger)
    raw = with_raw_lines(reader, path, columns, delimiter, encoding, quotechar)
    return raw if keep_corrupt else with_fallback(raw, delimiter, on_surplus)


def ingest_stream(raw: DataFrame, out: str, checkpoint: str, delimiter: str = "\t") -> StreamingQuery:
    """Every row to `rows`, and every line with surplus fields to `violations` beside it.

    `raw` is a `tsv_stream` with `keep_corrupt`. Each micro-batch has its own folder on either
    side and replaces it when it is repeated; `read_ingested` reads them.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        rows = with_fallback(batch, delimiter, on_surplus="drop")
        rows.write.mode("overwrite").parquet(f"{out}/rows/batch={batch_id}")
        found = surplus_violations(batch, delimiter)
        found.write.mode("overwrite").parquet(f"{out}/violations/batch={batch_id}")

    return (
        raw.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_ingested(spark: SparkSession, out: str, side: str = "rows") -> DataFrame:
    """What `ingest_stream` has written: `rows` or `violations`."""
    return spark.read.parquet(f"{out}/{side}").drop("batch")


def submission_stream(seqs: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """G2 for a stream of `(record_id, tokens, tags)`: E1 and F1 keep no state.

    The file sink commits each batch once; a value that no TSV can hold fails the batch.
    """
    writer = write_options(guarded(submission(seqs)).writeStream.format("csv"))
    return (
        writer.option("header", True)
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


class Models:
    """The newest version of a model below `path`, as a dictionary that tasks have.

    Versions are folders `version=N` that `store.save_version` writes. The folder is listed when a
    batch asks; the lexicon is read and broadcast once a version, not once a batch.
    """

    def __init__(self, spark: SparkSession, path: str, max_broadcast_bytes: int = MAX_BROADCAST_BYTES):
        self.spark, self.path, self.limit = spark, path, max_broadcast_bytes
        self.version: int | None = None
        self.model: DataFrame | Held | None = None

    def current(self) -> DataFrame | Held:
        found = latest_version(self.spark, self.path)
        if found is None:
            raise ValueError(f"no version of a model below {self.path}")
        if found != self.version:
            lexicon = load_model(self.spark, f"{self.path}/version={found}")
            # The dictionary before is not destroyed: a batch that is repeated may still hold it.
            self.model = held(lexicon, self.limit) or lexicon
            self.version = found
        return self.model


def tagged_submission_stream(
    titles: DataFrame,
    lexicon: DataFrame | Held | Models,
    out: str,
    checkpoint: str,
    id_col: str = "id",
    title_col: str = "title",
) -> StreamingQuery:
    """G2 for a stream of titles: T1 → M3 → E1 → F1 per micro-batch.

    The lexicon becomes a dictionary once, when the stream starts; `Models` gives each batch the
    newest version instead. A batch is written to its own folder and replaced when it runs again,
    so a batch that is repeated after a failure leaves one copy. `read_batches` reads the result.
    """
    if isinstance(lexicon, Models):
        current = lexicon.current
    else:
        model = held(lexicon) or lexicon

        def current() -> DataFrame | Held:
            return model

    def run(batch: DataFrame, batch_id: int) -> None:
        tagged = predict(batch, current(), id_col, title_col)
        rows = guarded(submission(tagged, tag_col="pred_tags"))
        writer = write_options(rows.write.mode("overwrite")).option("header", True)
        writer.csv(f"{out}/batch={batch_id}")

    return (
        titles.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_batches(spark: SparkSession, out: str) -> DataFrame:
    """The rows `tagged_submission_stream` has written."""
    return read_submission(spark, out).drop("batch")


def running_tag_counts(tags: DataFrame, tag_col: str = "tags") -> DataFrame:
    """Running count per tag; the state is one row per tag. Use complete output mode."""
    return (
        tags.select(F.posexplode_outer(tag_col).alias("pos", "tag"))
        .filter("pos IS NOT NULL")
        .groupBy(F.coalesce("tag", F.lit("")).alias("tag"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def latest(counts: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """A running aggregate as a table that every micro-batch replaces as a whole."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(out)

    return (
        counts.writeStream.foreachBatch(run)
        .outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def quality_stream(rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """V8 as it stands after every batch: `running_quality` reads it.

    The state store keeps one digest per distinct row, so that copies in different batches count
    as duplicates. A batch adds one row of counters: its rows', and how many of them are the first
    of their kind. The row is replaced when the batch is repeated, as the state is.
    """
    digest = row_digest(rows).alias("_digest")
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema]
    first = rows.select(digest).dropDuplicates(["_digest"]).select(*nothing, F.lit(True).alias("_first"))
    both = rows.withColumn("_first", F.lit(False)).union(first)

    def run(batch: DataFrame, batch_id: int) -> None:
        counters = quality_counters(batch.drop("_first"), "NOT _first")
        distinct = F.count_if("_first").alias("distinct_rows")
        batch.agg(*counters, distinct).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (
        both.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def running_quality(out: str, like: DataFrame, max_length: int = 1000) -> DataFrame:
    """`data_quality` of all rows that `quality_stream` has seen; `like` has their columns."""
    batches = like.sparkSession.read.parquet(out).drop("batch")
    merged = [F.max(c) if c.startswith("longest_") else F.sum(c) for c in batches.columns]
    total = batches.agg(*[m.alias(c) for m, c in zip(merged, batches.columns, strict=True)])
    return quality_table(total, F.col("rows") - F.col("distinct_rows"), like, max_length)
