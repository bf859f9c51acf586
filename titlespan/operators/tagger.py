"""M1–M8: the lexicon tagger and the hook for user models.

The lexicon gives each token the tag it carries most often. It grows with the vocabulary,
so its size is measured before it is broadcast. Records are tagged where they are, by a
dictionary (`operators/dictionary.py`); long tables of tokens are joined (`lookup`), beyond the
limit by a shuffle with the frequent tokens taken out beforehand.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titlespan.functions.sql import name, quote, quoted
from titlespan.functions.tags import fit_length
from titlespan.operators import dictionary
from titlespan.operators.dictionary import Blocks, Held, lexicon_bytes
from titlespan.operators.metrics import evaluate_predictions
from titlespan.operators.tokens import true_tags, with_tokens
from titlespan.operators.usage import most_frequent, most_frequent_per_fold
from titlespan.types import ENTITY_TYPES, OUTSIDE, labels

MAX_BROADCAST_BYTES = 64 << 20
# A token is frequent when it holds more rows than one in so many of a shuffle task's share.
HOT_SHARE = 20

# A model of the user: token lists in, tag lists out.
BatchModel = Callable[[list[list[str]]], list[list[str]]]


def fit(tagged: DataFrame) -> DataFrame:
    """M1: `(token, tag, n, total, confidence)` from `(…, token, tag)`; ties by tag text.

    Counts are summed before the shuffle, so a frequent token is one row per task and tag.
    """
    counts = tagged.groupBy("token", F.coalesce("tag", F.lit("")).alias("tag")).agg(
        F.count(F.lit(1)).alias("n")
    )
    best = F.min(F.struct((-F.col("n")).alias("neg"), "tag"))
    return (
        counts.groupBy("token")
        .agg(best.alias("best"), F.sum("n").alias("total"))
        .select(
            "token",
            F.col("best.tag").alias("tag"),
            (-F.col("best.neg")).alias("n"),
            "total",
            (-F.col("best.neg") / F.col("total")).alias("confidence"),
        )
    )


def fit_sequences(seqs: DataFrame, tag_col: str = "true_tags") -> DataFrame:
    """M1 over `(record_id, tokens, <tag_col>)`, counted an Arrow batch at a time."""
    return most_frequent(seqs, tag_col)


def fit_per_fold(folded: DataFrame | Blocks, k: int, tag_col: str = "true_tags") -> DataFrame:
    """K3: `(token, tag, confidence)` with one array entry per fold, trained on the others.

    A tag that the other folds never give the token is no candidate there.
    """
    return most_frequent_per_fold(_records(folded), tag_col, k)


def _records(seqs: DataFrame | Blocks) -> DataFrame:
    return seqs.records() if isinstance(seqs, Blocks) else seqs


def lookup(
    tokens: DataFrame, lexicon: DataFrame, max_broadcast_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """M3: left join of `(…, token, …)` with the lexicon on the token."""
    if lexicon_bytes(lexicon) <= max_broadcast_bytes:
        return _looked_up_here(tokens, lexicon)
    return _looked_up_by_shuffle(tokens, lexicon)


def _entries(lexicon: DataFrame) -> DataFrame:
    return lexicon.select("token", F.col("tag").alias("_tag"), F.col("confidence").alias("_c"))


def _looked_up_here(tokens: DataFrame, lexicon: DataFrame) -> DataFrame:
    return tokens.join(F.broadcast(_entries(lexicon)), "token", "left")


def _looked_up_by_shuffle(tokens: DataFrame, lexicon: DataFrame) -> DataFrame:
    """The input's frequent tokens get their entries from a small table, the others by a
    shuffled join, in which the frequent ones carry a salt that no entry has.

    Tokens with more than one in `HOT_SHARE` of a task's share of the rows are fewer than
    `HOT_SHARE` times the tasks, whatever the input; all others are too rare to skew a task.
    """
    entries = _entries(lexicon)
    place = [c for c in ("record_id", "pos") if c in tokens.columns]
    tasks = int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = (
        tokens.filter(F.col("token").isNotNull())
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    total = counted.agg(F.sum("_n").alias("_all"))
    frequent = counted.filter(F.col("_n") * (HOT_SHARE * tasks) > total.scalar()).select("token")
    hot = frequent.join(entries, "token", "left").select(
        "token",
        F.lit(True).alias("_hot"),
        F.col("_tag").alias("_hot_tag"),
        F.col("_c").alias("_hot_c"),
    )
    marked = tokens.join(F.broadcast(hot), "token", "left").withColumn(
        "_salt",
        F.when(
            F.col("_hot") | F.col("token").isNull(), F.xxhash64(*place)
        ),
    )
    cold = entries.withColumnRenamed("token", "_key")
    joined = marked.join(
        cold,
        (F.coalesce(F.concat(F.lit("s"), "_salt"), F.concat(F.lit("t"), "token"))
         == F.concat(F.lit("t"), "_key")),
        "left",
    )
    return joined.withColumns(
        {"_tag": F.coalesce("_hot_tag", "_tag"), "_c": F.coalesce("_hot_c", "_c")}
    ).drop("_hot", "_hot_tag", "_hot_c", "_salt", "_key")


def held(lexicon: DataFrame | Held, max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> Held | None:
    """The lexicon as a dictionary that tasks have, None if it is too large for that."""
    return lexicon if isinstance(lexicon, Held) else dictionary.held(lexicon, max_broadcast_bytes)


def predict_tokens(
    seqs: DataFrame | Blocks,
    lexicon: DataFrame | Held,
    parallel: Sequence[str] = (),
    keep: Sequence[str] = (),
    fold_col: str | None = None,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """M3, M5: `(record_id, *keep, tokens, *parallel, pred_tags, confidence)`.

    A token outside the lexicon is `O` with confidence 1; a record without tokens has none.
    `parallel` names arrays as long as the tokens and `keep` other columns of the record, which
    travel with them. With `fold_col` the lexicon holds one entry per fold. Every input row gives
    one output row, also where ids repeat or are missing.

    A lexicon small enough to be broadcast, or a dictionary made of one before, is probed where
    the records are, so nothing is shuffled. Beyond that records ask in blocks (`in_blocks`), those of
    the table if it is written so, by `fold_col` if that is named.
    """
    tokens = F.coalesce("tokens", F.array().cast("array<string>")).alias("tokens")
    small = held(lexicon, max_broadcast_bytes)
    if small is None:
        records = seqs if isinstance(seqs, Blocks) else seqs.select("record_id", *keep, tokens, *parallel)
        found = dictionary.in_blocks(records, lexicon, fold_col).withColumn("tokens", tokens)
    else:
        records = _records(seqs).select("record_id", *keep, tokens, *parallel)
        found = records.withColumn("_found", small.column("tokens", fold_col)).select("*", "_found.*")
    return found.select("record_id", *keep, "tokens", *parallel, "pred_tags", "confidence")


def predict(
    df: DataFrame, lexicon: DataFrame | Held, id_col: str = "record_id", title_col: str = "title"
) -> DataFrame:
    """M2: T1, then M3; one row for each row, whatever its id."""
    titled = with_tokens(df, title_col).select(F.col(id_col).alias("record_id"), "tokens")
    return predict_tokens(titled, lexicon)


def predict_with(seqs: DataFrame, model: BatchModel, keep: Sequence[str] = ()) -> DataFrame:
    """M3's hook for user models: `(record_id, *keep, tokens, pred_tags, error)` in Arrow batches.

    The model gets a batch of token lists. When a batch fails its records are tried one by
    one; a record that fails is all `O` (M8) and has the failure's text in `error`, which is
    NULL otherwise. Tags are cut or padded to the tokens. `keep` names columns to carry along.
    """

    def one(tokens: list[str]) -> tuple[list[str], str | None]:
        try:
            return list(model([tokens])[0]), None
        except Exception as failure:
            return [OUTSIDE] * len(tokens), f"{type(failure).__name__}: {failure}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            token_lists = [list(t) for t in batch["tokens"]]
            try:
                tags = [(list(t), None) for t in model(token_lists)]
                if len(tags) != len(token_lists):
                    raise ValueError("one tag list per token list is needed")
            except Exception:
                tags = [one(t) for t in token_lists]
            found = pd.Series([t for t, _ in tags], index=batch.index, dtype=object)
            failed = pd.Series([e for _, e in tags], index=batch.index, dtype=object)
            yield batch.assign(pred_tags=found, error=failed)

    narrow = seqs.select("record_id", *keep, "tokens")
    kinds = [f"{name(f.name)} {f.dataType.simpleString()}" for f in narrow.schema]
    tagged = narrow.mapInPandas(run, ", ".join([*kinds, "pred_tags array<string>", "error string"]))
    return align(tagged)


def align(predictions: DataFrame, tag_col: str = "pred_tags") -> DataFrame:
    """M4: as many tags as tokens."""
    return predictions.withColumn(tag_col, F.expr(fit_length(name(tag_col), "size(tokens)")))


def prediction_stats(
    predictions: DataFrame, tag_col: str = "pred_tags", types: list[str] = ENTITY_TYPES
) -> DataFrame:
    """M6: `(metric, value)`: texts, tokens, `O` tags, mean tokens per text, tags per type.

    Counts tagged tokens, not spans. One pass: the tags are counted before the shuffle.
    """
    tags = predictions.select(F.posexplode_outer(tag_col).alias("pos", "tag"))
    counted = tags.groupBy("tag").agg(
        F.count("pos").alias("n"),
        F.count_if(F.col("pos").isNull() | (F.col("pos") == 0)).alias("texts"),
    )

    def total(tags: str) -> str:
        return f"coalesce(sum(n) FILTER (WHERE tag IN ({tags})), 0L)"

    per_type = [f"{total(quoted([f'B-{t}', f'I-{t}']))} AS n_{i}" for i, t in enumerate(types)]
    aggregated = counted.agg(
        F.expr("coalesce(sum(texts), 0L) AS texts"),
        F.expr("coalesce(sum(n), 0L) AS tokens"),
        F.expr(f"{total(quote(OUTSIDE))} AS o_tags"),
        *map(F.expr, per_type),
    )
    metrics = {
        "total_texts": "texts",
        "total_tokens": "tokens",
        "o_tag_count": "o_tags",
        "average_tokens_per_text": "coalesce(tokens / nullif(texts, 0), 0.0D)",
        **{f"entity_count:{t}": f"n_{i}" for i, t in enumerate(types)},
    }
    pairs = ", ".join(f"{quote(m)}, CAST({sql} AS DOUBLE)" for m, sql in metrics.items())
    return aggregated.selectExpr(f"stack({len(metrics)}, {pairs}) AS (metric, value)")


def model_info(spark: SparkSession, types: list[str] = ENTITY_TYPES, **params: str) -> DataFrame:
    """M7: the one-row table that is kept beside a lexicon."""
    row = ("lexicon", types, len(labels(types)), True, {k: str(v) for k, v in params.items()})
    schema = (
        "model_class string, entity_types array<string>, num_labels int, "
        "is_trained boolean, model_params map<string,string>"
    )
    return spark.createDataFrame([row], schema)


def evaluate_model(
    df: DataFrame,
    model: DataFrame | Held | BatchModel,
    tag_cols: list[str],
    id_col: str = "record_id",
    title_col: str = "title",
) -> DataFrame:
    """M8: T1, R2, M3, then A11 over a wide table of titles and tag columns.

    `model` is a lexicon or a user's model.
    """
    if not tag_cols:
        raise ValueError("evaluation needs the columns with the true tags")
    truth = true_tags(df, tag_cols, id_col, title_col)
    return evaluate_predictions(predicted_beside(truth, model))


def predicted_beside(
    truth: DataFrame | Blocks, model: DataFrame | Held | BatchModel, keep: Sequence[str] = ()
) -> DataFrame:
    """`(record_id, *keep, tokens, true_tags, pred_tags, …)` by a lexicon or a user's model."""
    if isinstance(model, DataFrame | Held):
        return predict_tokens(truth, model, parallel=["true_tags"], keep=keep)
    return predict_with(_records(truth), model, keep=[*keep, "true_tags"])
