"""Entities to the fixed-column submission."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, NumericType

from titlespan.functions.sql import name, quote
from titlespan.operators.spans import entities
from titlespan.types import ENTITY_TYPES

SEPARATOR = "|"


def format_entities(
    df: DataFrame, id_col: str = "record_id", entities_col: str = "entities"
) -> DataFrame:
    """the id as text and, per type, its texts joined by a pipe or ''."""
    entities_map = name(entities_col)
    return df.selectExpr(
        f"CAST({name(id_col)} AS STRING) AS id",
        *[
            f"coalesce(array_join({entities_map}[{quote(t)}], '{SEPARATOR}'), '') AS {name(t)}"
            for t in ENTITY_TYPES
        ],
    )


def _as_text(df: DataFrame, column: str) -> str:
    """lists joined, scalars as text, missing and falsy values as ''."""
    if column not in df.columns:
        return "''"
    data_type, value = df.schema[column].dataType, name(column)
    text = f"CAST({value} AS STRING)"
    if isinstance(data_type, ArrayType):
        text = f"array_join(CAST({value} AS ARRAY<STRING>), '{SEPARATOR}')"
    elif isinstance(data_type, NumericType):
        text = f"if({value} <> 0, {text}, NULL)"
    elif isinstance(data_type, BooleanType):
        text = f"if({value}, 'True', NULL)"
    return f"coalesce({text}, '')"


def format_predictions(df: DataFrame, id_col: str = "record_id") -> DataFrame:
    """Predictions with one column per type → submission columns in order."""
    return df.selectExpr(
        f"CAST({name(id_col)} AS STRING) AS id",
        *[f"{_as_text(df, t)} AS {name(t)}" for t in ENTITY_TYPES],
    )


def submission(
    seqs: DataFrame, tag_col: str = "tags", on_error: str = "raise"
) -> DataFrame:
    """E1 → E4 → F1. Every record gives one row, with or without spans; no shuffle.

    A span of an unknown type fails the job; `empty` leaves such a record empty instead.
    """
    return format_entities(entities(seqs, "strict", tag_col, on_error=on_error))


def submission_stats(df: DataFrame) -> DataFrame:
    """per type the filled, empty and multi-valued rows, beside the table's size as TSV."""
    header_bytes = len("\t".join(df.columns).encode()) + 1
    row = ", ".join(name(c) for c in df.columns)
    blank = r"regexp_replace({}, r'(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$', '') <> ''"
    counters = [
        "count(*) AS total_records",
        f"coalesce(sum(octet_length(concat_ws('\\t', {row})) + 1), 0L) + {header_bytes} AS size_bytes",
    ]
    per_type = []
    for i, t in enumerate(ENTITY_TYPES):
        counters.append(f"count_if({blank.format(name(t))}) AS filled_{i}")
        counters.append(f"count_if(contains({name(t)}, '{SEPARATOR}')) AS multi_{i}")
        per_type.append(
            f"struct({quote(t)} AS type, filled_{i} AS non_empty_count, "
            f"total_records - filled_{i} AS empty_count, multi_{i} AS has_multiple_entities)"
        )
    return (
        df.agg(*map(F.expr, counters))
        .selectExpr(
            f"explode(array({', '.join(per_type)})) AS t",
            "total_records",
            f"{len(df.columns)} AS total_columns",
            "size_bytes",
            "size_bytes / (1024 * 1024) AS size_mb",
        )
        .select("t.*", "total_records", "total_columns", "size_bytes", "size_mb")
    )


def merge_with_metadata(df: DataFrame, metadata: DataFrame | None = None) -> DataFrame:
    """left join of the submission with source columns on all common columns.

    Common columns are compared as text, as the submission holds text only. Without
    metadata or a common column the submission comes back as it is. Metadata that a row finds
    twice is an error, as it would multiply the row.
    """
    if metadata is None:
        return df
    common = [c for c in df.columns if c in metadata.columns]
    if not common:
        return df
    as_text = metadata.withColumns({c: F.col(c).cast("string") for c in common})
    others = [c for c in metadata.columns if c not in common]
    once = as_text.groupBy(*common).agg(
        F.count(F.lit(1)).alias("_n"), *[F.any_value(c).alias(c) for c in others]
    )
    problem = F.raise_error(F.lit("metadata holds a key more than once"))
    joined = df.join(once, common, "left")
    checked = F.when(F.coalesce("_n", F.lit(1)) == 1, F.col(common[0])).otherwise(problem.cast("string"))
    return joined.withColumn(common[0], checked).select(*df.columns, *others)
