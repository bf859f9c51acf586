"""The operators' registered queries and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from titlespan.llm import (
    bpe,
    chat,
    embedding_dedup,
    exact_dedup,
    near_dedup,
    packing,
    pii,
    quality,
    ranked_search,
    repeats,
    spelling_variants,
    token_counts,
    token_files,
)

Query = Callable[[SparkSession, str], DataFrame]


def registry() -> dict[str, Query]:
    found = [
        packing.op1_pack,
        token_files.op2_token_files,
        pii.op3_pii,
        repeats.op4_repeats,
        near_dedup.op5_near_dedup,
        bpe.op6_bpe,
        exact_dedup.op7_exact_dedup,
        quality.op8_quality,
        token_counts.op9_token_counts,
        embedding_dedup.op10_embedding_dedup,
        chat.op11_chat,
        ranked_search.op12_ranked_search,
        spelling_variants.op13_spelling_variants,
    ]
    return {f.__name__: f for f in found}


def oracles() -> dict[str, str]:
    return {
        "op7_exact_dedup": exact_dedup.OP7_SQL,
        "op11_chat": chat.OP11_SQL,
        "op12_ranked_search": ranked_search.OP12_SQL,
        "op13_spelling_variants": spelling_variants.OP13_SQL,
    }
