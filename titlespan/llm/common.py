"""What the operators share: tables of the driver, joins that survive hot keys, small SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from titlespan.sources.store import written

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A key is hot if it holds more than a thousandth of the rows, so there are fewer than a thousand.
HOT_KEYS = 1000

__all__ = ["HOT_KEYS", "ascii_lower", "documents", "join_groups", "quoted_name", "table", "written"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def quoted_name(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def two_columns(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """`(doc_id, text)`; whatever else the table has, under whatever names, is left behind."""
    return df.select(
        quoted_name(id_col).alias("doc_id"), quoted_name(text_col).cast("string").alias("text")
    )


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; a text without other letters takes the quick way."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """Every row with the columns of its key's group, also if one key holds most of the rows.

    `groups` has one row per key and, in `size`, how many of `rows` it holds. Keys with more
    than a thousandth of the rows are fewer than a thousand whatever the input, so they are
    broadcast; the other keys are joined by a shuffle that no key can skew. Both tables should
    be written ones, as they are read twice. Rows without a group are kept.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    hot = groups.filter(F.col(size) * HOT_KEYS > F.lit(total))
    common = rows.join(F.broadcast(hot), key, "inner")
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return common.unionByName(rest.join(groups, key, "left"))
