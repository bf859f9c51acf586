"""Token tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from titlespan.functions.sql import let, name
from titlespan.functions.tokens import features, neighbours, tokenize
from titlespan.types import OUTSIDE


def with_tokens(df: DataFrame, title_col: str = "title") -> DataFrame:
    """Adds the `tokens` array."""
    return df.withColumn("tokens", F.expr(tokenize(name(title_col))))


def tokens_long(df: DataFrame, id_col: str = "record_id", title_col: str = "title") -> DataFrame:
    """`(record_id, pos, token)`; titles without tokens give no rows."""
    return df.select(
        F.col(id_col).alias("record_id"),
        F.posexplode(F.expr(tokenize(name(title_col)))).alias("pos", "token"),
    )


def token_features(
    df: DataFrame, id_col: str = "record_id", title_col: str = "title"
) -> DataFrame:
    """One row per token with all token and context features; no shuffle."""
    placed = df.select(
        F.col(id_col).alias("record_id"),
        F.explode(F.expr(neighbours(tokenize(name(title_col))))).alias("t"),
    ).select("record_id", "t.*")
    return _with_features(placed)


def _with_features(placed: DataFrame) -> DataFrame:
    added = {
        "is_first": "pos = 0",
        **features("token"),
        "prev_length": "if(pos = 0, 0, length(prev_token))",
        "next_length": "if(is_last, 0, length(next_token))",
    }
    return placed.selectExpr("*", *[f"{sql} AS {column}" for column, sql in added.items()])


def positional_tags(tokens: str, tag_cols: list[str]) -> str:
    """Token i takes the value of the i-th tag column, `O` past the end or on NULL."""
    values = f"array({', '.join(name(c) for c in tag_cols)})"
    return let("tags", values, f"transform({tokens}, (t, i) -> coalesce(get(tags, i), '{OUTSIDE}'))")


def default_tag_columns(df: DataFrame, id_col: str, title_col: str) -> list[str]:
    return [c for c in df.columns if c not in (id_col, title_col)]


def true_tags(
    df: DataFrame,
    tag_cols: list[str] | None = None,
    id_col: str = "record_id",
    title_col: str = "title",
) -> DataFrame:
    """R2: `(record_id, tokens, true_tags)` from a wide table of tags."""
    names = tag_cols if tag_cols is not None else default_tag_columns(df, id_col, title_col)
    return with_tokens(df, title_col).select(
        F.col(id_col).alias("record_id"),
        "tokens",
        F.expr(positional_tags("tokens", names)).alias("true_tags"),
    )


def training_rows(
    df: DataFrame,
    tag_cols: list[str] | None = None,
    id_col: str = "record_id",
    title_col: str = "title",
) -> DataFrame:
    """One row per token with its tag and features; titles without tokens give none."""
    tagged = true_tags(df, tag_cols, id_col, title_col)
    placed = tagged.select(
        "record_id",
        F.explode(
            F.arrays_zip(F.expr(neighbours("tokens")).alias("t"), F.col("true_tags"))
        ).alias("z"),
    ).select("record_id", F.col("z.true_tags").alias("tag"), "z.t.*")
    return _with_features(placed)


def tagged_long(seqs: DataFrame, tag_col: str = "true_tags") -> DataFrame:
    """`(record_id, pos, token, tag)` from a table of sequences."""
    zipped = F.arrays_zip(F.col("tokens").alias("token"), F.col(tag_col).alias("tag"))
    return seqs.select("record_id", F.posexplode(zipped).alias("pos", "z")).select(
        "record_id", "pos", "z.token", "z.tag"
    )


def present_tags(tag_cols: list[str]) -> str:
    """The non-NULL values of the tag columns, closed up."""
    return f"array_compact(array({', '.join(name(c) for c in tag_cols)}))"


def token_array(df: DataFrame, token_col: str) -> str:
    """P5: an array as it is; a string split on single spaces, empty tokens kept."""
    if isinstance(df.schema[token_col].dataType, StringType):
        return f"split({name(token_col)}, ' ', -1)"
    return name(token_col)


def sequences_from_wide(
    df: DataFrame,
    true_cols: list[str],
    pred_cols: list[str],
    id_col: str = "record_id",
    token_col: str = "tokens",
) -> DataFrame:
    """`(record_id, tokens, true_tags, pred_tags)` from wide tag columns."""
    return df.select(
        F.col(id_col).alias("record_id"),
        F.expr(token_array(df, token_col)).alias("tokens"),
        F.expr(present_tags(true_cols)).alias("true_tags"),
        F.expr(present_tags(pred_cols)).alias("pred_tags"),
    )
