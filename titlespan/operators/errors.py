"""Error analysis over token pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlespan.operators.metrics import confusion, unzipped, zipped_pairs

# A blank tag is not `O`.
ERROR_TYPE = """CASE WHEN true_tag = 'O' AND pred_tag <> 'O' THEN 'false_positive'
    WHEN true_tag <> 'O' AND pred_tag = 'O' THEN 'false_negative'
    ELSE 'misclassification' END AS error_type"""


def errors(pairs: DataFrame) -> DataFrame:
    """The mismatched pairs with their error type."""
    return pairs.filter("true_tag <> pred_tag").selectExpr("*", ERROR_TYPE)


def _mismatches(pairs: DataFrame) -> DataFrame:
    """Errors per pair of labels: the confusion table without its diagonal."""
    return confusion(pairs.filter("true_tag <> pred_tag"))


def error_counts(pairs: DataFrame) -> DataFrame:
    """Errors per type, and in total under the type `all`."""
    per_type = (
        _mismatches(pairs).selectExpr("*", ERROR_TYPE).groupBy("error_type").agg(F.sum("n").alias("n"))
    )
    # A rollup of no rows has no total; this has.
    total = per_type.agg(F.expr("coalesce(sum(n), 0L) AS n"))
    return per_type.unionByName(total.selectExpr("'all' AS error_type", "n"))


def confusion_pairs(pairs: DataFrame) -> DataFrame:
    """Errors per `true -> pred`."""
    return _mismatches(pairs).selectExpr("concat_ws(' -> ', true_tag, pred_tag) AS pair", "n")


def error_distribution(pairs: DataFrame) -> DataFrame:
    """Count and percentage per error type."""
    shares = error_counts(pairs).selectExpr(
        "*", "n / max(n) OVER (PARTITION BY 1) * 100 AS percentage"
    )
    return shares.filter("error_type <> 'all' AND n > 0")


def top_confusion_pairs(pairs: DataFrame, k: int = 10) -> DataFrame:
    """The k most frequent mismatches with their share of all errors; ties by pair text.

    The window spans the confusion table (at most labels² rows), not the pairs.
    """
    shares = confusion_pairs(pairs).selectExpr(
        "*", "n / sum(n) OVER (PARTITION BY 1) * 100 AS percentage"
    )
    return shares.orderBy(F.desc("n"), "pair").limit(k)


def error_examples(seqs: DataFrame, limit: int | None = None) -> DataFrame:
    """All errors, or with `limit` those of the first records that have any.

    The ids are picked first, so that only 8 bytes per record enter the top-k.
    """
    pairs = zipped_pairs()
    if limit is not None:
        blank = F.lit("")
        differs = F.exists(
            pairs, lambda p: F.coalesce(p["true_tags"], blank) != F.coalesce(p["pred_tags"], blank)
        )
        ids = F.filter(F.array("record_id"), lambda _: differs)
        first = seqs.select(F.explode(ids).alias("record_id")).orderBy("record_id").limit(limit)
        seqs = seqs.join(first, "record_id", "left_semi")
    rows = seqs.select("record_id", F.posexplode(pairs).alias("pos", "p"))
    return errors(rows.selectExpr("record_id", "pos", *unzipped("p")))


def entity_error_matrix(examples: DataFrame) -> DataFrame:
    """Errors per true and predicted type: the text after the last `-`, `O` without one."""


    def short(tag: str) -> str:
        return f"if(contains({tag}, '-'), substring_index({tag}, '-', -1), 'O')"

    return (
        examples.selectExpr(
            f"{short('true_tag')} AS true_type", f"{short('pred_tag')} AS pred_type"
        )
        .groupBy("true_type", "pred_type")
        .agg(F.expr("count(*) AS n"))
    )
