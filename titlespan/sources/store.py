"""Metrics as JSON, the model as a table, intermediate tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from titlespan.operators.tagger import model_info
from titlespan.session import written
from titlespan.types import ENTITY_TYPES

__all__ = ["latest_version", "load_info", "load_model", "save_json", "save_model", "save_version", "written"]


def save_json(df: DataFrame, path: str) -> None:
    """Metrics or analysis tables as JSON lines."""
    df.write.mode("errorifexists").option("ignoreNullFields", False).json(path)


def save_model(lexicon: DataFrame, path: str, types: list[str] = ENTITY_TYPES, **params) -> None:
    """The lexicon and, beside it, its description."""
    lexicon.write.mode("errorifexists").parquet(f"{path}/lexicon")
    info = model_info(lexicon.sparkSession, types, **params)
    info.coalesce(1).write.mode("errorifexists").parquet(f"{path}/info")


def _versions(spark: SparkSession, path: str) -> dict[int, bool]:
    """The folders `version=N` below a path, and whether the model in them is complete."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(at(path)):
        return {}
    names = [s.getPath().getName() for s in system.listStatus(at(path))]
    numbers = [int(n.removeprefix("version=")) for n in names if re.fullmatch(r"version=\d+", n)]
    return {n: system.exists(at(f"{path}/version={n}/info/_SUCCESS")) for n in numbers}


def latest_version(spark: SparkSession, path: str) -> int | None:
    """The highest version below a path whose model is complete, None without one."""
    return max((n for n, whole in _versions(spark, path).items() if whole), default=None)


def save_version(lexicon: DataFrame, path: str, types: list[str] = ENTITY_TYPES, **params) -> int:
    """The lexicon as the next version below a path; streams take it up with their next batch.

    The description is written last, and a version without it is not complete.
    """
    version = max(_versions(lexicon.sparkSession, path), default=0) + 1
    save_model(lexicon, f"{path}/version={version}", types, **params)
    return version


def load_model(spark: SparkSession, path: str) -> DataFrame:
    """The lexicon; label ids follow from the types in `load_info`."""
    return spark.read.parquet(f"{path}/lexicon")


def load_info(spark: SparkSession, path: str) -> DataFrame:
    """M7: the model's description."""
    return spark.read.parquet(f"{path}/info")
