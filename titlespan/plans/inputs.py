"""The driver's tables in the shapes the operators take.

Texts are used whole. Tags follow from id, position and token length by arithmetic that
any SQL engine repeats exactly.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from titlespan.functions.sql import let, quoted
from titlespan.functions.tokens import ABBREVIATIONS, AUTOMOTIVE_TERMS, tokenize
from titlespan.session import spread
from titlespan.types import ENTITY_TYPES

UNKNOWN_TYPE = "Unbekannt"
WIDE_COLUMNS = 6
#: Records whose tags are made at once.
TAGGED_RECORDS = 256

# Tasks get this module's code with the query, so that executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(record_id, title)`: one long text per record."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("record_id"), F.col("text").alias("title")
    )


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(record_id, title)` of the turns; a conversation must have fewer than 1,000 of them."""
    turn = F.when(F.col("turn").between(0, 999), F.col("turn")).otherwise(
        F.raise_error(F.lit("a conversation has too many turns")).cast("long")
    )
    return table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 1000 + turn).alias("record_id"), F.col("text").alias("title")
    )


def _step(record_id: str, pos: str, token: str) -> str:
    return f"({record_id} * 7 + {pos} * 13 + length({token}) * 5) % 10"


def _moved(record_id: str, pos: str, token: str) -> str:
    """The step of a prediction: one on from the true one for every seventh combination."""
    step = _step(record_id, pos, token)
    moves = f"({record_id} * 3 + {pos} * 5 + length({token})) % 7 = 0"
    return f"if({moves}, ({step} + 1) % 10, {step})"


def _tag(step: str, record_id: str, pos: str, types: list[str] = ENTITY_TYPES) -> str:
    types_sql = f"array({quoted(types)})"
    kind = f"get({types_sql}, CAST(({record_id} + shiftright({pos}, 2)) % {len(types)} AS INT))"
    tag = f"""CASE WHEN m <= 2 THEN 'O' WHEN m <= 4 THEN concat('B-', {kind})
        WHEN m <= 7 THEN concat('I-', {kind}) WHEN m = 8 THEN '' ELSE 'bad' END"""
    return let("m", step, tag)


def true_tag(record_id: str, pos: str, token: str, types: list[str] = ENTITY_TYPES) -> str:
    return _tag(_step(record_id, pos, token), record_id, pos, types)


def pred_tag(record_id: str, pos: str, token: str) -> str:
    return _tag(_moved(record_id, pos, token), record_id, pos)


def _table(types: list[str]) -> list[str]:
    """The tags by step and type."""
    return [
        {3: f"B-{t}", 4: f"B-{t}", 5: f"I-{t}", 6: f"I-{t}", 7: f"I-{t}", 8: "", 9: "bad"}.get(step, "O")
        for step in range(10)
        for t in types
    ]


def _tags(types: list[str], moved: bool) -> str:
    """`_tag` for every token: one look-up by step and type, in small integers.

    A record whose id is NULL or negative has no place in the table and takes `_tag` itself.
    """
    table = _table(types)
    n = len(types)
    step = "(a + i * 3 + length(t) * 5) % 10"
    if moved:
        step = f"if((c + i * 5 + length(t)) % 7 = 0, (a + i * 3 + length(t) * 5 + 1) % 10, {step})"
    place = f"{step} * {n} + (b + shiftright(i, 2)) % {n}"
    rest = {f"CAST(record_id % {m} AS INT)": v for v, m in (("a", 10), ("b", n), ("c", 7))}
    found = f"transform(tokens, (t, i) -> get(array({quoted(table)}), {place}))"
    for value, variable in rest.items():
        times = {"a": " * 7", "c": " * 3"}.get(variable, "")
        found = let(variable, value + times, found)
    rule = _moved if moved else _step
    plain = f"transform(tokens, (t, i) -> {_tag(rule('record_id', 'i', 't'), 'record_id', 'i', types)})"
    return f"if(record_id >= 0, {found}, {plain})"


def _true_tags(types: list[str] = ENTITY_TYPES) -> str:
    return _tags(types, moved=False)


_PRED_TAGS = _tags(ENTITY_TYPES, moved=True)


def _tags_in_batches(types: list[str] = ENTITY_TYPES, moved: bool = False) -> Column:
    """`_tags` for some records of an Arrow batch at a time; ids without a place take `_tags` itself."""
    table, n = pa.array(_table(types)), len(types)

    def some(ids: np.ndarray, lists: pa.Array) -> tuple[np.ndarray, pa.Array]:
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        length = pc.utf8_length(lists.flatten()).to_numpy(zero_copy_only=False)
        pos = np.arange(len(length)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        step = np.repeat(ids % 10 * 7, sizes) + pos * 3 + length * 5
        if moved:
            step += (np.repeat(ids % 7 * 3, sizes) + pos * 5 + length) % 7 == 0
        place = step % 10 * n + (np.repeat(ids % n, sizes) + (pos >> 2)) % n
        return sizes, table.take(pa.array(place))

    def of_batch(ids: pa.Array, lists: pa.Array) -> pa.Array:
        known = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)
        starts = range(0, len(known), TAGGED_RECORDS)
        parts = [some(known[at : at + TAGGED_RECORDS], lists.slice(at, TAGGED_RECORDS)) for at in starts]
        ends = np.cumsum(np.concatenate([[0], *[sizes for sizes, _ in parts]]), dtype=np.int32)
        found = pa.concat_arrays([tags for _, tags in parts]) if parts else table.slice(0, 0)
        return pa.ListArray.from_arrays(pa.array(ends), found)

    found = F.arrow_udf(of_batch, "array<string>")(F.col("record_id").cast("long"), F.col("tokens"))
    return F.when(F.col("record_id") >= 0, found).otherwise(F.expr(_tags(types, moved)))


def tagged(titles: DataFrame) -> DataFrame:
    """`(record_id, tokens, true_tags, pred_tags)`."""
    return titles.selectExpr("record_id", f"{tokenize('title')} AS tokens").selectExpr(
        "record_id", "tokens", f"{_true_tags()} AS true_tags", f"{_PRED_TAGS} AS pred_tags"
    )


def tagged_in_batches(titles: DataFrame) -> DataFrame:
    """`tagged`, quicker. Not for operators that give the tags to a UDF of their own, as Spark may not
    tell the two apart when it plans them."""
    true, pred = _tags_in_batches(), _tags_in_batches(moved=True)
    return titles.selectExpr("record_id", f"{tokenize('title')} AS tokens").select(
        "record_id", "tokens", true.alias("true_tags"), pred.alias("pred_tags")
    )


def sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagged(documents(spark, sf_dir))


def sequences_in_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagged_in_batches(documents(spark, sf_dir))


def faulty_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(record_id, tokens, tags)` with an unknown type in place of the last one for every
    fifth record, and one tag short for every seventh."""
    with_unknown = [*ENTITY_TYPES[:-1], UNKNOWN_TYPE]
    full = documents(spark, sf_dir).selectExpr("record_id", f"{tokenize('title')} AS tokens")
    return full.selectExpr(
        "record_id",
        "tokens",
        f"if(record_id % 5 = 0, {_true_tags(with_unknown)}, {_true_tags()}) AS tags",
    ).selectExpr(
        "record_id",
        "tokens",
        "if(record_id % 7 = 0, slice(tags, 1, greatest(size(tags) - 1, 0)), tags) AS tags",
    )


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(record_id, title)`: short product titles of four words."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("record_id"),
        F.concat_ws(" ", "p_name", "p_brand", "p_type").alias("title"),
    )


def term_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(record_id, title)`: a dictionary word before the part's name, every other in capitals."""
    words = [*ABBREVIATIONS, *AUTOMOTIVE_TERMS]
    key = F.col("p_partkey")
    word = F.get(F.array(*[F.lit(w) for w in words]), (key % len(words)).cast("int"))
    return table(spark, sf_dir, "part").select(
        key.alias("record_id"),
        F.concat_ws(
            " ", F.when(F.shiftright(key, 6) % 2 == 1, F.upper(word)).otherwise(word), "p_name"
        ).alias("title"),
    )


def wide_listings(spark: SparkSession, sf_dir: str, rule=true_tag, prefix: str = "t") -> DataFrame:
    """`listings` with one tag column per position, NULL past the last token."""
    tags = [
        f"if(size(tokens) > {i}, {rule('record_id', str(i), f'get(tokens, {i})')}, NULL)"
        for i in range(WIDE_COLUMNS)
    ]
    titled = listings(spark, sf_dir).selectExpr("*", f"{tokenize('title')} AS tokens").withColumn(
        "tokens",
        F.expr(f"if(size(tokens) <= {WIDE_COLUMNS}, tokens, raise_error('a listing is too long'))"),
    )
    return titled.selectExpr(
        "record_id", "title", *[f"{sql} AS {prefix}{i}" for i, sql in enumerate(tags)]
    )
