"""K1–K4: length bins, stratified folds and cross-validation."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from titlespan.functions.sql import let
from titlespan.operators import metrics
from titlespan.operators.blocks import by_id
from titlespan.operators.dictionary import Blocks
from titlespan.operators.tagger import (
    MAX_BROADCAST_BYTES,
    BatchModel,
    fit_per_fold,
    held,
    predict_tokens,
    predicted_beside,
)
from titlespan.session import SPARING, sparing, written  # noqa: F401

_PLACES = 9
#: Hexadecimal digits of the digest that the records ranked together share.
PREFIX = 4


def length_edges(df: DataFrame, q: int = 5) -> DataFrame:
    """K1: one row with the distinct quantile edges of the token counts.

    Lengths are counted first, so the quantile sees one row per distinct length.
    """
    lengths = df.groupBy(F.size("tokens").alias("n")).agg(F.count(F.lit(1)).alias("records"))
    steps = F.array(*[F.lit(i / q) for i in range(q + 1)])
    quantiles = F.percentile("n", steps, F.col("records"))
    rounded = F.transform(quantiles, lambda e: F.round(e, _PLACES))
    return lengths.agg(F.array_sort(F.array_distinct(rounded)).alias("edges"))


def with_length_bins(df: DataFrame, q: int = 5) -> DataFrame:
    """K1: adds `bin`, the quantile bin of the token count; duplicate edges are dropped."""
    with_edges = df.select("*", length_edges(df, q).scalar().alias("_edges"))
    below = let("n", "size(tokens)", "size(filter(_edges, e -> e < n))")
    return with_edges.withColumn("bin", F.expr(f"greatest({below} - 1, 0)")).drop("_edges")


def _digest(id_col: str, seed: int) -> Column:
    known = F.coalesce(F.col(id_col).cast("string"), F.lit("NULL"))
    return F.md5(F.concat(known, F.lit(str(seed))))


def stratified_folds(
    df: DataFrame,
    k: int = 5,
    seed: int = 42,
    bin_col: str = "bin",
    id_col: str = "record_id",
    prefix: int = PREFIX,
) -> DataFrame:
    """K2: adds `fold`; within a bin the folds differ by at most one record.

    Records are ranked by the digest of id and seed. A bin may hold a third of all
    records, so the rank is taken in two levels: within the records that share the first
    `prefix` digits of the digest, plus the number of records with smaller first digits.
    A histogram of those digits says how many come before: at most 65,536 counts a bin, whatever
    the input, and the ranks do not depend on it. Give narrow rows: they are sorted.
    """
    placed = df.withColumn("_digest", _digest(id_col, seed)).withColumn(
        "_part", F.substring("_digest", 1, prefix)
    )
    before = W.partitionBy(bin_col).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(bin_col, "_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            bin_col, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
        )
    )
    within = W.partitionBy(bin_col, "_part").orderBy("_digest", id_col)
    ranked = placed.withColumn("_rank", F.row_number().over(within))
    return (
        ranked.join(offsets, [bin_col, "_part"], "inner")
        .withColumn("fold", ((F.col("_offset") + F.col("_rank") - 1) % k).cast("int"))
        .drop("_digest", "_part", "_rank", "_offset")
    )


def cross_validate(
    seqs: DataFrame, k: int = 5, seed: int = 42, max_broadcast_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """K3: A10 per fold, for the lexicon tagger; `(fold, metric, value)`.

    One count table serves all folds: a fold's training counts are the totals without its
    own, so nothing is trained k times over the data. Ids are ranked without their records;
    records that share an id share its fold. The assignment is written once, as fitting and
    predicting both read it. It is written in blocks, with what is read of the records, and what
    was shuffled for a table is deleted once that is written.
    """
    with sparing(seqs.sparkSession):
        folded = _blocks(seqs.select("record_id", "tokens", "true_tags"), k, seed)
        return evaluate_folds(folded, k, max_broadcast_bytes)


def _blocks(seqs: DataFrame, k: int, seed: int) -> Blocks:
    return Blocks.of(with_folds(seqs, k, seed), "folds", "fold")


def with_folds(seqs: DataFrame, k: int = 5, seed: int = 42) -> DataFrame:
    """K1, K2 over whole records: `fold` is found for the ids alone and joined back."""
    binned = with_length_bins(seqs.select("record_id", "tokens"))
    ids = binned.groupBy("record_id").agg(F.min("bin").alias("bin"))
    return by_id(seqs.drop("bin"), stratified_folds(ids, k, seed), "fold")


def cross_validate_with(
    fit: Callable[[DataFrame], DataFrame | BatchModel], seqs: DataFrame, k: int = 5, seed: int = 42
) -> DataFrame:
    """K3 for any model: `fit` is given the records of the other folds and returns a lexicon or
    a user's model, which then predicts the records of the fold; `(fold, metric, value)`.

    A fold is counted before the next one's model is fitted, so that one at a time is on disk."""
    with sparing(seqs.sparkSession):
        folded = _blocks(seqs, k, seed)
        parts = []
        for fold in range(k):
            model = fit(folded.filter(F.col("fold") != fold).records().drop("fold"))
            small = held(model) if isinstance(model, DataFrame) else None
            predicted = predicted_beside(folded.filter(F.col("fold") == fold), small or model, keep=["fold"])
            parts.append(written(metrics.evaluation_counts(predicted, by=["fold"]), "fold-counts"))
            if small:
                small.release()
        return metrics.summary(reduce(DataFrame.unionByName, parts), by=["fold"])


def evaluate_folds(
    folded: DataFrame | Blocks, k: int, max_broadcast_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """K3 over records that already have a `fold`."""
    lexicon = written(fit_per_fold(folded, k), "fold-lexicon")
    predicted = predict_tokens(
        folded,
        lexicon,
        parallel=["true_tags"],
        keep=["fold"],
        fold_col="fold",
        max_broadcast_bytes=max_broadcast_bytes,
    )
    counts = written(metrics.evaluation_counts(predicted, by=["fold"]), "fold-counts")
    return metrics.summary(counts, by=["fold"])


def cv_summary(fold_metrics: DataFrame) -> DataFrame:
    """K4: mean and population standard deviation per metric."""
    return fold_metrics.groupBy("metric").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std")
    )
