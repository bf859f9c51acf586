"""What the library needs from the caller's session: a shared folder and a spread scan."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Settings of `sparing`.
SPARING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it.

    A machine-local folder is only right where driver and executors are one process, so it
    is taken in local mode alone.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR)
    if named:
        return named
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors can reach")
    return _local_folder(spark.sparkContext.applicationId)


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"titlespan-{application}-")


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has used yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def sparing(spark: SparkSession) -> Iterator[None]:
    """For what is written within, Spark deletes a write's shuffle files at its end, rather than when its
    memory is next cleaned, which may be after the query's end; and Arrow batches are small ones."""
    before = {key: spark.conf.get(key, None) for key in SPARING}
    for key, value in SPARING.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def written(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared folder and read back: computed once, lineage cut."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Use every core when the input has fewer files than there are cores.

    Non-splittable files (gzip, one row group) would otherwise leave one task per file.
    Inputs with enough files pass through without a shuffle. A scan of many partitions is
    told by their number, so that the file names of a large table are never listed here.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= 4 * cores or len(df.inputFiles()) >= cores:
        return df
    return df.repartition(cores)
