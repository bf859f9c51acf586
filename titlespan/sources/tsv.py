"""Tab-separated files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from titlespan.types import SUBMISSION_COLUMNS

CORRUPT = "_corrupt"
# A quote character that text does not hold, so that quotes are plain text.
NO_QUOTE = "\u0000"


def string_schema(columns: list[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def _paths(path: str | list[str]) -> list[str]:
    paths = [path] if isinstance(path, str) else list(path)
    for p in paths:
        if not p.endswith(".gz"):
            raise ValueError(f"expected a .gz path, got {p}")
    return paths


def read_tsv_gz(
    spark: SparkSession,
    path: str | list[str],
    delimiter: str = "\t",
    encoding: str = "utf-8",
    quotechar: str = '"',
    keep_corrupt: bool = False,
    multiline: bool = False,
    on_surplus: str = "raise",
    partitions: int | None = None,
) -> DataFrame:
    """Gzip TSV with CSV quoting, header names, every column a string.

    Blank lines are skipped, '' stays '', `NA` and `null` stay text, short rows are filled
    with ''. `path` takes a glob ending in `.gz`, or a list of them. The files of one glob must
    have one header, or the read fails; the globs of a list may have theirs in any order, and
    columns are matched by name. A gzip file is one task; `partitions` deals its rows out.

    A row that the quoted parse cannot place is split on the delimiter (`with_fallback`). A row
    with more fields than the header fails the read; `on_surplus="drop"` leaves its last
    fields out. With `keep_corrupt` neither happens: the raw line of a row whose field count
    differs from the header is kept in `_corrupt`, and `with_fallback`, `corrupt_rows` and
    `surplus_violations` take it from there. `multiline` accepts line breaks inside quotes.
    """
    if on_surplus not in ("raise", "drop"):
        raise ValueError(f"on_surplus must be 'raise' or 'drop', got {on_surplus!r}")
    parts = [
        _read_one(spark, p, delimiter, encoding, quotechar, multiline) for p in _paths(path)
    ]
    if not keep_corrupt:
        parts = [with_fallback(p, delimiter, on_surplus) for p in parts]
    names = sorted(parts[0].columns)
    if any(sorted(p.columns) != names for p in parts):
        raise ValueError(f"files differ in their columns: {[p.columns for p in parts]}")
    read = reduce(DataFrame.unionByName, parts)
    return read.repartition(partitions) if partitions else read


def _quoted(reader, delimiter: str, encoding: str, quotechar: str, multiline: bool):
    """The options of the quoted parse, for a batch reader or a stream's."""
    return (
        reader.option("sep", delimiter)
        .option("header", True)
        .option("quote", quotechar)
        .option("escape", quotechar)
        .option("encoding", encoding)
        .option("multiLine", multiline)
    )


def with_raw_lines(
    reader,
    path: str,
    columns: list[str],
    delimiter: str = "\t",
    encoding: str = "utf-8",
    quotechar: str = '"',
    multiline: bool = False,
) -> DataFrame:
    """The rows of files whose header is `columns`, with the raw line of those that do not fit.

    `reader` is `spark.read` or `spark.readStream`: both parse alike, and a file with another
    header fails either.
    """
    schema = string_schema(columns).add(CORRUPT, StringType())
    # Without column pruning a row is checked in full whichever columns are read.
    scan = _quoted(reader, delimiter, encoding, quotechar, multiline)
    scan = scan.option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False)
    return scan.option("enforceSchema", False).schema(schema).csv(path).na.fill("", columns)


def _read_one(
    spark: SparkSession, path: str, delimiter: str, encoding: str, quotechar: str, multiline: bool
) -> DataFrame:
    """The files of one glob with their common header and the raw line of rows that do not fit."""
    columns = _quoted(spark.read, delimiter, encoding, quotechar, multiline).csv(path).columns
    return with_raw_lines(spark.read, path, columns, delimiter, encoding, quotechar, multiline)


def _data_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != CORRUPT]


def _raw_fields(delimiter: str) -> Column:
    return F.split(CORRUPT, "\\Q" + delimiter + "\\E", -1)


def with_fallback(
    df: DataFrame, delimiter: str = "\t", on_surplus: str = "drop"
) -> DataFrame:
    """A row the quoted parse could not place is split on the delimiter, no quoting.

    Applies to rows with at least as many raw fields as the header; shorter rows are legal.
    Surplus fields are left out here and listed by `corrupt_rows` and `surplus_violations`, or
    fail the read with `on_surplus="raise"`.
    """
    columns = _data_columns(df)
    fields = _raw_fields(delimiter)
    if on_surplus == "raise":
        problem = F.raise_error(F.concat(F.lit("more fields than the header has: "), F.col(CORRUPT)))
        too_many = F.size(fields) > len(columns)
        fields = F.when(too_many, problem.cast("array<string>")).otherwise(fields)
    misread = F.col(CORRUPT).isNotNull() & (F.size(fields) >= len(columns))
    return df.select(
        *[
            F.when(misread, F.get(fields, F.lit(i))).otherwise(F.col(c)).alias(c)
            for i, c in enumerate(columns)
        ]
    )


def corrupt_rows(df: DataFrame, delimiter: str = "\t") -> DataFrame:
    """Rows with more fields than the header: `(line, n_fields, fields)`.

    Spark refuses a scan of the corrupt column alone, so the line falls back to the parsed
    columns; after the filter it never does.
    """
    columns = _data_columns(df)
    line = F.coalesce(F.col(CORRUPT), F.concat_ws(delimiter, *columns))
    fields = _raw_fields(delimiter)
    return (
        df.filter(F.col(CORRUPT).isNotNull())
        .select(line.alias("line"), F.size(fields).alias("n_fields"), fields.alias("fields"))
        .filter(F.col("n_fields") > len(columns))
    )


def surplus_violations(df: DataFrame, delimiter: str = "\t") -> DataFrame:
    """`corrupt_rows` as violations, a row for each line with its number of surplus fields."""
    width = len(_data_columns(df))
    return corrupt_rows(df, delimiter).selectExpr(
        "'surplus_fields' AS rule",
        "CAST(NULL AS STRING) AS col",
        "line AS detail",
        f"CAST(n_fields - {width} AS BIGINT) AS n",
    )


def file_info(spark: SparkSession, path: str) -> DataFrame:
    """Per file its path, bytes, MB, gzip flag, and lines if it is not compressed.

    Sizes come from the file listing; only uncompressed files are read. Spark's scans leave
    out files of zero bytes, and so does this.
    """
    listed = spark.read.format("binaryFile").load(path).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_size_bytes"),
    )
    lines = (
        spark.read.text(path)
        .select(F.col("_metadata.file_path").alias("file_path"))
        .filter(~F.col("file_path").endswith(".gz"))
        .groupBy("file_path")
        .agg(F.count(F.lit(1)).alias("lines"))
    )
    compressed = F.col("file_path").endswith(".gz")
    return listed.join(lines, "file_path", "left").select(
        "file_path",
        "file_size_bytes",
        F.round(F.col("file_size_bytes") / (1024 * 1024), 2).alias("file_size_mb"),
        compressed.alias("is_compressed"),
        F.col("lines").alias("total_lines"),
    )


def guarded(df: DataFrame) -> DataFrame:
    """V7 inside the write: a bad value fails the job, which then commits no file."""
    if df.columns != SUBMISSION_COLUMNS:
        raise ValueError(f"expected columns {SUBMISSION_COLUMNS}, got {df.columns}")
    for field in df.schema:
        if not isinstance(field.dataType, StringType):
            raise ValueError(f"column {field.name} is not a string")

    def checked(c: str) -> Column:
        problem = F.raise_error(F.lit(f"column {c} holds a TAB, a line break or NULL"))
        return F.when(
            F.col(c).isNull() | F.col(c).rlike("[\t\n\r]"), problem.cast("string")
        ).otherwise(F.col(c))

    return df.select(*[checked(c).alias(c) for c in df.columns])


def write_options(writer):
    """TAB, UTF-8, nothing quoted, nothing trimmed, empty for ''."""
    return (
        writer.option("sep", "\t")
        .option("encoding", "UTF-8")
        .option("quote", NO_QUOTE)
        .option("emptyValue", "")
        .option("nullValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )


def save_submission(
    df: DataFrame,
    path: str,
    include_header: bool = True,
    validate: bool = True,
    compression: str = "none",
) -> None:
    """Writes the submission; validation is part of the same pass."""
    rows = guarded(df) if validate else df
    writer = write_options(rows.write.mode("errorifexists"))
    writer.option("header", include_header).option("compression", compression).csv(path)


def read_submission(spark: SparkSession, path: str, has_header: bool = True) -> DataFrame:
    """Reads what `save_submission` wrote, verbatim."""
    reader = spark.read.option("sep", "\t").option("quote", "").option("header", has_header)
    if not has_header:
        reader = reader.schema(string_schema(SUBMISSION_COLUMNS))
    return reader.csv(path).na.fill("")


def verify_output(spark: SparkSession, path: str, has_header: bool = True) -> int:
    """Row count of the written table; raises when its columns are not the expected ones."""
    written = read_submission(spark, path, has_header)
    if written.columns != SUBMISSION_COLUMNS:
        raise ValueError(f"expected columns {SUBMISSION_COLUMNS}, got {written.columns}")
    return written.count()
