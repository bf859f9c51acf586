"""From raw documents to packed sequences: five stages, each written as Parquet and read again.

A null or empty text is a document like others until a stage says otherwise: it scores as the
classifier's middle, empty texts are copies of each other, link with nothing, and pack as the
end id alone. Extra columns travel with their documents up to the last stage. Rows that repeat an id
are documents of their own, unless id and text repeat: then one stays. Without enough labels for a
classifier nothing is rejected. An empty table passes all stages and gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from titlespan.llm import exact_dedup, near_dedup, packing, pii, quality
from titlespan.llm.common import documents, written

STAGES = [
    ("quality", quality.stage),
    ("exact_dedup", exact_dedup.stage),
    ("near_dedup", near_dedup.stage),
    ("pii", pii.stage),
    ("packing", packing.stage),
]

#: The classifier and the packing have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
