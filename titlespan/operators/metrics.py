"""Comparing two taggings.

`evaluation_counts` reads the sequences once and reduces them to a few hundred counters;
every metric is arithmetic on those counters. `by` names extra columns that keep groups
(such as folds) apart.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titlespan.functions.sql import let, quote, quoted
from titlespan.operators.checks import length_findings, record_violations
from titlespan.operators.comparison import counts, with_types
from titlespan.operators.pieces import paired
from titlespan.types import ENTITY_TYPES, type_table

# --- pairs and confusion -----------------------------------------------------------------

_ALIGNED = "size(tokens) <=> size(true_tags) AND size(tokens) <=> size(pred_tags)"


def if_aligned(value: str) -> str:
    """`value`, or an error where a record has not one tag of each side for every token."""
    return f"if({_ALIGNED}, {value}, raise_error('tokens and tags differ in length'))"


def zipped_pairs() -> Column:
    """Column of `(tokens, true_tags, pred_tags)` structs in title order; lengths must agree."""
    return F.expr(if_aligned("arrays_zip(tokens, true_tags, pred_tags)"))


def unzipped(pair: str) -> list[str]:
    """The fields of one of `zipped_pairs`; blanks are the label ''."""
    tags = [f"coalesce({pair}.{t}s, '') AS {t}" for t in ("true_tag", "pred_tag")]
    return [f"{pair}.tokens AS token", *tags]


def token_pairs(seqs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A1: `(record_id, pos, token, true_tag, pred_tag)`; blanks are the label ''."""
    placed = seqs.select(*by, "record_id", F.posexplode(zipped_pairs()).alias("pos", "z"))
    return placed.selectExpr(*by, "record_id", "pos", *unzipped("z"))


def _full_outer(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of either side by null-safe keys; what one side lacks is NULL in its columns."""
    theirs = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    joined = left.withColumn("_left", F.lit(True)).join(theirs, same, "full_outer")
    merged = {k: F.when(F.col("_left"), F.col(k)).otherwise(F.col(f"_{k}")) for k in keys}
    return joined.withColumns(merged).drop("_left", *[f"_{k}" for k in keys])


def pair_long(true: DataFrame, pred: DataFrame) -> DataFrame:
    """A1 over two long tables `(record_id, pos, token, tag)`, paired by key.

    Nothing is lost: a token that one side lacks has NULL there, while a blank tag is ''.
    `unpaired_tokens` lists those. The sides are shuffled in pieces of a block of positions.
    """
    left = true.selectExpr("record_id", "pos", "token", "coalesce(tag, '') AS tag")
    right = pred.selectExpr("record_id", "pos", "coalesce(tag, '') AS tag")
    return paired(left, right)


def unpaired_tokens(pairs: DataFrame) -> DataFrame:
    """Violations for the tokens of `pair_long` that one side lacks, per record and side."""
    lacking = pairs.filter("true_tag IS NULL OR pred_tag IS NULL").selectExpr(
        "if(pred_tag IS NULL, 'missing_prediction', 'missing_truth') AS rule", "record_id", "pos"
    )
    return lacking.groupBy("rule", "record_id").agg(
        F.min("pos").alias("pos"), F.count(F.lit(1)).alias("n")
    )


def pair_sequences(true: DataFrame, pred: DataFrame) -> DataFrame:
    """Two tables `(record_id, tokens, tags)` / `(record_id, tags)` side by side.

    Nothing is lost: a record that one side lacks has NULL there, so that comparing it fails
    instead of leaving it out; `pairing_violations` lists those, and ids that are not unique.
    """
    left = true.selectExpr("record_id", "tokens", "tags AS true_tags")
    return _full_outer(left, pred.selectExpr("record_id", "tags AS pred_tags"), ["record_id"])


def pairing_violations(true: DataFrame, pred: DataFrame) -> DataFrame:
    """`(rule, record_id, n)` for records that do not pair up one to one.

    `missing_prediction` and `missing_truth` are on one side only, n times; `repeated_record` has
    n rows, on the side that has more of them.
    """
    sides = [
        t.groupBy("record_id").agg(F.count(F.lit(1)).alias(n))
        for t, n in ((true, "true_n"), (pred, "pred_n"))
    ]
    counted = _full_outer(*sides, ["record_id"])
    rule = """CASE WHEN pred_n IS NULL THEN 'missing_prediction' WHEN true_n IS NULL THEN 'missing_truth'
        WHEN true_n > 1 OR pred_n > 1 THEN 'repeated_record' END"""
    found = counted.selectExpr(f"{rule} AS rule", "record_id", "greatest(true_n, pred_n) AS n")
    return found.filter("rule IS NOT NULL")


def unpaired_records(true: DataFrame, pred: DataFrame) -> DataFrame:
    """Records that only one side has, as `(record_id, side)`."""
    left = true.selectExpr("record_id", "true AS in_true")
    joined = _full_outer(left, pred.selectExpr("record_id", "true AS in_pred"), ["record_id"])
    return joined.filter("in_true IS NULL OR in_pred IS NULL").selectExpr(
        "record_id", "if(in_true IS NULL, 'pred', 'true') AS side"
    )


def confusion(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A2: `(true_tag, pred_tag, n)`; reduced on the map side to at most labels² rows a task."""
    return pairs.groupBy(*by, "true_tag", "pred_tag").agg(F.expr("count(*) AS n"))


#: Column of the blank label in a matrix, as columns need names.
BLANK_COLUMN = "blank"


def confusion_matrix(confusion_df: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """A2: one row and one column for every label of either side, so that no count is lost.

    Labels are those that occur, sorted, or the given ones; a label that is not among those is
    an error. The driver sees labels only, a few dozen.
    """
    if labels is None:
        both = confusion_df.select(F.explode(F.array("true_tag", "pred_tag")).alias("label"))
        labels = [r["label"] for r in both.distinct().orderBy("label").collect()]

    def listed(c: str) -> Column:
        unknown = F.raise_error(F.concat(F.lit("label is not listed: "), F.col(c)))
        return F.when(F.col(c).isin(labels), F.col(c)).otherwise(unknown.cast("string"))

    known = confusion_df.select(*[listed(c).alias(c) for c in ("true_tag", "pred_tag")], "n")
    spark = confusion_df.sparkSession
    rows = spark.createDataFrame([(x,) for x in labels], "true_tag string")
    cells = known.groupBy("true_tag").pivot("pred_tag", labels).agg(F.sum("n"))
    matrix = rows.join(cells, "true_tag", "left").na.fill(0)
    return matrix.withColumnRenamed("", BLANK_COLUMN)


def labels_seen(pairs: DataFrame) -> DataFrame:
    """Every label of either side, sorted; reduced through the confusion table."""
    return (
        confusion(pairs)
        .select(F.explode(F.array("true_tag", "pred_tag")).alias("label"))
        .distinct()
        .orderBy("label")
    )


# --- scores ------------------------------------------------------------------------------


def with_scores(df: DataFrame) -> DataFrame:
    """Adds precision, recall and f1 to `(support, predicted, hits)`; 0 on empty denominators."""
    return df.selectExpr(
        "*",
        "if(predicted > 0, hits / predicted, 0.0D) AS precision",
        "if(support > 0, hits / support, 0.0D) AS recall",
    ).selectExpr(
        "*",
        "if(precision + recall > 0, 2 * precision * recall / (precision + recall), 0.0D) AS f1",
    )


def _rate(
    grain: str, key: str, support: str = "0L", predicted: str = "0L", hits: str = "0L"
) -> str:
    return (
        f"struct({grain} AS grain, {key} AS key, {support} AS support, "
        f"{predicted} AS predicted, {hits} AS hits)"
    )


def _label_rates_of(true_tag: str, pred_tag: str, n: str) -> str:
    """What one confusion cell adds to its row label and to its column label."""
    row = _rate("'label'", true_tag, support=n, hits=f"if({true_tag} = {pred_tag}, {n}, 0L)")
    return f"array({row}, {_rate(quote('label'), pred_tag, predicted=n)})"


def _sum_rates(df: DataFrame, contributions: str, by: Sequence[str]) -> DataFrame:
    return (
        df.select(*by, F.explode(F.expr(contributions)).alias("c"))
        .groupBy(*by, "c.grain", "c.key")
        .agg(*[F.sum(f"c.{x}").alias(x) for x in ("support", "predicted", "hits")])
    )


def label_rates(confusion_df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per label `(grain, key, support, predicted, hits, precision, recall, f1)`."""
    return with_scores(_sum_rates(confusion_df, _label_rates_of("true_tag", "pred_tag", "n"), by))


def per_label(confusion_df: DataFrame) -> DataFrame:
    """A3: tp, fp, fn, tn, precision, recall and f1 per label.

    The window spans the label table (a few dozen rows), not the data.
    """
    total = "sum(support) OVER (PARTITION BY grain)"
    return label_rates(confusion_df).selectExpr(
        "key AS label",
        "hits AS true_positives",
        "predicted - hits AS false_positives",
        "support - hits AS false_negatives",
        f"{total} - support - predicted + hits AS true_negatives",
        "precision",
        "recall",
        "f1",
    )


def _weighted(metric: str) -> str:
    return f"sum({metric} * support) / nullif(sum(support), 0)"


def token_averages(rates_df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A4: support-weighted and macro averages and accuracy over the label rates."""
    columns = [f"{_weighted(m)} AS token_{m}" for m in ("precision", "recall", "f1")]
    columns.append("sum(hits) / nullif(sum(support), 0) AS token_accuracy")
    columns += [f"avg({m}) AS macro_{m}" for m in ("precision", "recall", "f1")]
    columns.append("sum(support) AS support")
    return rates_df.groupBy(*by).agg(*map(F.expr, columns))


def token_metrics(pairs: DataFrame) -> DataFrame:
    """A4: one row with the weighted and macro averages and accuracy."""
    return token_averages(label_rates(confusion(pairs)))


def type_token_metrics(rates_df: DataFrame, types: list[str] = ENTITY_TYPES) -> DataFrame:
    """A5: the B- and I- rows of the label rates, keyed by type."""
    return rates_df.filter(
        f"key RLIKE '^[BI]-' AND substr(key, 3) IN ({quoted(types)})"
    ).selectExpr("substr(key, 3) AS type", "key AS tag", "precision", "recall", "f1", "support")


def mean_f1_by_type(type_metrics: DataFrame, types: list[str] = ENTITY_TYPES) -> DataFrame:
    """Mean of the B- and I- f1 per type, 0.0 for a type that does not occur."""
    means = type_metrics.groupBy("type").agg(F.avg("f1").alias("mean_f1"))
    return (
        type_table(type_metrics.sparkSession, types)
        .join(means, "type", "left")
        .selectExpr("type_no", "type", "coalesce(mean_f1, 0.0D) AS mean_f1")
    )


# --- one pass over the data --------------------------------------------------------------


def _exact_match(true_entities: str, pred_entities: str, types: list[str]) -> str:
    """A8 inside the row: `(type, exact, partial)` per type, sets compared."""
    sides = "struct(t AS type, array_distinct(te[t]) AS a, array_distinct(pe[t]) AS b)"
    compared = (
        "struct(s.type AS type, size(array_except(s.a, s.b)) = 0 "
        "AND size(array_except(s.b, s.a)) = 0 AS exact, arrays_overlap(s.a, s.b) AS overlap)"
    )
    by_type = (
        f"transform(transform(transform(array({quoted(types)}), t -> {sides}), s -> {compared}), "
        "c -> struct(c.type AS type, c.exact AS exact, c.overlap AND NOT c.exact AS partial))"
    )
    return let("te", true_entities, let("pe", pred_entities, by_type))


def with_exact_match(
    seqs: DataFrame, types: list[str] = ENTITY_TYPES, partial_breaks_exact: bool = False
) -> DataFrame:
    """Adds `by_type`, `exact` and `partial` per record.

    By default a record whose types overlap in part still counts as exact;
    `partial_breaks_exact` asks for equal sets throughout.
    """
    return _with_matches(with_types(seqs, types), partial_breaks_exact)


def _with_matches(compared: DataFrame, partial_breaks_exact: bool) -> DataFrame:
    matched = "c.exact" if partial_breaks_exact else "c.exact OR c.partial"
    return compared.selectExpr(
        "*",
        f"forall(by_type, c -> {matched}) AS exact",
        "exists(by_type, c -> c.partial) AS partial",
    )


def exact_match_of_entities(
    entities: DataFrame, types: list[str] = ENTITY_TYPES, partial_breaks_exact: bool = False
) -> DataFrame:
    """A8 over `true_entities` and `pred_entities` maps."""
    by_type = _exact_match("true_entities", "pred_entities", types)
    return _with_matches(entities.selectExpr("*", f"{by_type} AS by_type"), partial_breaks_exact)


def exact_match(compared: DataFrame) -> DataFrame:
    """Counts and rates over all records; rates are NULL without records."""
    return compared.agg(
        F.expr("count_if(exact) AS exact_matches"),
        F.expr("count_if(partial) AS partial_matches"),
        F.expr("count(*) AS total_examples"),
        F.expr("count_if(exact) / nullif(count(*), 0) AS exact_match_accuracy"),
        F.expr("count_if(partial) / nullif(count(*), 0) AS partial_match_accuracy"),
    )


def exact_match_by_type(compared: DataFrame) -> DataFrame:
    """Rates per type."""
    return (
        compared.select(F.explode_outer("by_type").alias("c"))
        .groupBy("c.type")
        .agg(
            F.expr("count_if(c.exact) / count(*) AS exact_match_rate"),
            F.expr("count_if(c.partial) / count(*) AS partial_match_rate"),
            F.expr("count(*) AS total_examples"),
        )
    )


def span_counts(seqs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counters of true, predicted and matching spans per type."""
    return counts(seqs, by, records=False)


def evaluation_counts(seqs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """`(*by, grain, k1, k2, n)` from one pass over the sequences.

    Records are compared where they are, a batch at a time; only counters reach the shuffle, and
    they are summed before it. Unequal lengths are an error.
    """
    return counts(seqs, by, records=True)


def rates(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Label and type rates from the counters.

    No filter on the grain is used, so that every metric built on it has the same first
    stages and Spark runs them once.
    """

    def spans_in(side: str) -> str:
        return f"if(grain = 'span_{side}', n, 0L)"

    span = _rate("'type'", "k1", spans_in("true"), spans_in("pred"), spans_in("hit"))
    contributions = (
        f"CASE WHEN grain = 'pair' THEN {_label_rates_of('k1', 'k2', 'n')} "
        f"WHEN startswith(grain, 'span_') THEN array({span}) END"
    )
    return with_scores(_sum_rates(counts, contributions, by))


def type_entity_metrics(type_rates: DataFrame) -> DataFrame:
    """Rows per type, and the micro, macro and weighted averages."""
    scores = ("precision", "recall", "f1")
    per_type = type_rates.selectExpr("key AS type", *scores, "support")
    micro = with_scores(
        type_rates.agg(*[F.sum(x).alias(x) for x in ("support", "predicted", "hits")])
    ).selectExpr("'micro avg' AS type", *scores, "support")
    averaged = type_rates.agg(
        *[F.expr(f"avg({m}) AS macro_{m}") for m in scores],
        *[F.expr(f"{_weighted(m)} AS weighted_{m}") for m in scores],
        F.sum("support").alias("support"),
    )
    parts = [
        averaged.selectExpr(
            f"'{kind} avg' AS type", *[f"{kind}_{m} AS {m}" for m in scores], "support"
        )
        for kind in ("macro", "weighted")
    ]
    return per_type.unionByName(micro).unionByName(parts[0]).unionByName(parts[1])


def entity_averages(type_rates: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Micro-averaged span precision, recall and f1."""
    totals = type_rates.groupBy(*by).agg(
        *[F.sum(x).alias(x) for x in ("support", "predicted", "hits")]
    )
    return with_scores(totals).withColumnsRenamed(
        {m: f"entity_{m}" for m in ("precision", "recall", "f1")}
    )


def entity_metrics(seqs: DataFrame) -> DataFrame:
    """One row of span metrics; spans follow the lenient rules, of any type."""
    return entity_averages(rates(span_counts(seqs)))


def _melt(df: DataFrame, by: Sequence[str], grain: str, key: str, names: list[str]) -> DataFrame:
    """Wide metric columns → `(*by, grain, key, metric, value)`."""
    pairs = ", ".join(f"{quote(m)}, CAST({m} AS DOUBLE)" for m in names)
    return df.selectExpr(
        *by,
        f"{grain} AS grain",
        f"{key} AS key",
        f"stack({len(names)}, {pairs}) AS (metric, value)",
    )


# The headline numbers of a summary, in order.
SUMMARY_METRICS = [
    "token_f1",
    "token_precision",
    "token_recall",
    "entity_f1",
    "entity_precision",
    "entity_recall",
    "exact_match_accuracy",
]


def _overall(counts: DataFrame, scored: DataFrame, by: Sequence[str]) -> DataFrame:
    """Every headline number per group, as `(*by, grain, key, metric, value)`."""
    label, span = "FILTER (WHERE grain = 'label')", "FILTER (WHERE grain = 'type')"
    total = f"nullif(sum(support) {label}, 0)"
    columns = [
        *[f"sum({m} * support) {label} / {total} AS token_{m}" for m in ("precision", "recall", "f1")],
        f"sum(hits) {label} / {total} AS token_accuracy",
        f"sum(support) {label} AS total_tokens",
        *[f"coalesce(sum({x}) {span}, 0L) AS {x}" for x in ("support", "predicted", "hits")],
    ]
    totals = scored.groupBy(*by).agg(*map(F.expr, columns))
    scores = with_scores(totals).withColumnsRenamed(
        {m: f"entity_{m}" for m in ("precision", "recall", "f1")}
    )

    def record(kind: str) -> str:
        return f"coalesce(sum(n) FILTER (WHERE grain = 'record' AND k1 = '{kind}'), 0L)"

    n = record("sequences")
    records = counts.groupBy(*by).agg(
        F.expr(f"{n} AS num_sequences"),
        F.expr(f"{record('exact')} / nullif({n}, 0) AS exact_match_accuracy"),
        F.expr(f"{record('partial')} / nullif({n}, 0) AS partial_match_accuracy"),
    )
    score_names = [
        "token_precision",
        "token_recall",
        "token_f1",
        "token_accuracy",
        "total_tokens",
        "entity_precision",
        "entity_recall",
        "entity_f1",
    ]
    record_names = ["num_sequences", "exact_match_accuracy", "partial_match_accuracy"]
    return _melt(scores, by, "'overall'", "''", score_names).unionByName(
        _melt(records, by, "'overall'", "''", record_names)
    )


def _match_rates(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """A8 per type from the counters."""
    kinds = [
        f"coalesce(sum(n) FILTER (WHERE grain = 'match' AND k2 = '{kind}'), 0L) AS {kind}"
        for kind in ("total", "exact", "partial")
    ]
    per_key = counts.groupBy(*by, F.col("k1").alias("type")).agg(*map(F.expr, kinds))
    return per_key.filter("total > 0").selectExpr(
        *by,
        "type",
        "exact / total AS exact_match_rate",
        "partial / total AS partial_match_rate",
        "total AS total_examples",
    )


def metrics_long(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """All metrics as `(*by, grain, key, metric, value)`.

    Grains: `overall`, `label`, `type` (spans) and `exact` (entity sets per type).
    """
    scored = rates(counts, by)
    per_key = _melt(scored, by, "grain", "key", ["precision", "recall", "f1", "support"])
    matched = _melt(
        _match_rates(counts, by),
        by,
        "'exact'",
        "type",
        ["exact_match_rate", "partial_match_rate", "total_examples"],
    )
    return _overall(counts, scored, by).unionByName(per_key).unionByName(matched)


def summary(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A10: the seven headline numbers, as `(*by, metric, value)`."""
    overall = _overall(counts, rates(counts, by), by)
    return overall.filter(f"metric IN ({quoted(SUMMARY_METRICS)})").select(*by, "metric", "value")


def evaluate_predictions(seqs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A9 over `(record_id, tokens, true_tags, pred_tags)`; fails on unequal lengths."""
    return metrics_long(evaluation_counts(seqs, by), by)


def evaluate_tables(true: DataFrame, pred: DataFrame) -> DataFrame:
    """A11 over `(record_id, tokens, tags)` and `(record_id, tags)`; fails if a record is on one
    side only or an id is not unique."""
    sides = [
        t.groupBy("record_id").agg(F.count(F.lit(1)).alias(f"{s}_n"), *columns)
        for s, t, columns in (
            ("true", true, [F.any_value("tokens").alias("tokens"), F.any_value("tags").alias("true_tags")]),
            ("pred", pred, [F.any_value("tags").alias("pred_tags")]),
        )
    ]
    paired = sides[0].join(
        sides[1].withColumnRenamed("record_id", "pred_id"),
        F.col("record_id").eqNullSafe(F.col("pred_id")),
        "full_outer",
    )
    problem = "raise_error('records of the two sides do not pair up')"
    tokens = f"if(true_n = 1 AND pred_n = 1, tokens, {problem})"
    checked = paired.selectExpr("record_id", f"{tokens} AS tokens", "true_tags", "pred_tags")
    return evaluate_predictions(checked)


def misaligned(seqs: DataFrame) -> DataFrame:
    """E7 on both sides of a comparison."""
    return record_violations(
        seqs, length_findings("tokens", "true_tags"), length_findings("tokens", "pred_tags")
    )


def per_type_report(metrics: DataFrame, types: list[str] = ENTITY_TYPES) -> DataFrame:
    """One row per type with its B- and I- label, span and exact-match metrics.

    `metrics` is A9's long table, a few hundred rows.
    """
    is_label = "grain = 'label' AND key RLIKE '^[BI]-'"
    keyed = metrics.selectExpr(
        f"if({is_label}, substr(key, 3), key) AS type",
        f"""CASE WHEN {is_label} THEN concat(lower(substr(key, 1, 1)), '_', metric)
            WHEN grain = 'type' THEN concat('entity_', metric)
            WHEN grain = 'exact' THEN metric END AS name""",
        "value",
    )
    scores = ("precision", "recall", "f1", "support")
    names = [f"{p}_{m}" for p in ("b", "i", "entity") for m in scores]
    names += ["exact_match_rate", "partial_match_rate", "total_examples"]
    wide = keyed.groupBy("type").pivot("name", names).agg(F.first("value"))
    listed = type_table(metrics.sparkSession, types)
    return listed.join(wide, "type", "left").select("type_no", "type", *names)
