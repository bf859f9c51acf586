"""Checks as tables of violations; no rows means valid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StringType, StructType

from titlespan.functions.sql import name, quote, quoted
from titlespan.functions.tags import (
    UPPER_PATTERN,
    bad_tag_positions,
    bad_transitions,
    length_matches,
    type_pattern,
    spans_of,
)
from titlespan.operators.usage import token_usage
from titlespan.types import ENTITY_TYPES, INPUT_COLUMNS, SUBMISSION_COLUMNS

def _finding(rule: str, col: str | None, n: str, detail: str | None = None) -> str:
    def text(value: str | None) -> str:
        return "CAST(NULL AS STRING)" if value is None else quote(value)

    return (
        f"struct({quote(rule)} AS rule, {text(col)} AS col, {text(detail)} AS detail, "
        f"CAST({n} AS BIGINT) AS n)"
    )


def _from_findings(aggregated: DataFrame, findings: list[str]) -> DataFrame:
    """One aggregated row with counters → one violation row per counter above zero."""
    return (
        aggregated.select(F.explode(F.expr(f"array({', '.join(findings)})")).alias("f"))
        .filter("f.n > 0")
        .selectExpr(
            "f.rule",
            "CAST(NULL AS BIGINT) AS record_id",
            "CAST(NULL AS INT) AS pos",
            "f.col",
            "f.detail",
            "f.n",
        )
    )


def missing_columns(df: DataFrame, required: list[str] = INPUT_COLUMNS) -> list[str]:
    """Required columns the table lacks, in the order required."""
    return [c for c in required if c not in df.columns]


def validate_input(df: DataFrame, required: list[str] = INPUT_COLUMNS) -> DataFrame:
    """Missing columns, an empty table, NULLs in required columns; one aggregate."""
    missing = missing_columns(df, required)
    present = [c for c in required if c in df.columns]
    counters = [f"count_if({name(c)} IS NULL) AS null_{i}" for i, c in enumerate(present)]
    findings = [_finding("missing_column", c, "1") for c in missing]
    findings.append(_finding("empty_table", None, "if(rows = 0, 1, 0)"))
    findings += [_finding("null_values", c, f"null_{i}") for i, c in enumerate(present)]
    return _from_findings(df.agg(*map(F.expr, ["count(*) AS rows", *counters])), findings)


# Each record check is an array of findings. Exploding the array, rather than filtering on
# it, keeps Spark from pushing the check below the projections it reads and evaluating
# those again; several checks joined into one array share a single pass.

_RECORD_FINDING = "array<struct<rule:string,pos:int,detail:string,n:bigint>>"


def _record_finding(rule: str, pos: str, detail: str, n: str = "1L") -> str:
    return (
        f"struct({rule} AS rule, CAST({pos} AS INT) AS pos, CAST({detail} AS STRING) AS detail, "
        f"CAST({n} AS BIGINT) AS n)"
    )


def length_findings(tokens: str, tags: str) -> str:
    """The record's token and tag counts differ."""
    sizes = f"format_string('%d tokens, %d tags', size({tokens}), size({tags}))"
    finding = _record_finding("'length_mismatch'", "NULL", sizes)
    nothing = f"CAST(array() AS {_RECORD_FINDING})"
    return f"if({length_matches(tokens, tags)}, {nothing}, array({finding}))"


def alignment_findings(
    tokens: str, tags: str, pattern: str | None = None, first_only: bool = False
) -> str:
    """V2: a length mismatch, else every tag that does not match the pattern, or the first one.

    The pattern defaults to the list of types; `upper` is the literal one that takes only
    upper-case type names.
    """
    regex = {None: type_pattern(), "upper": UPPER_PATTERN}.get(pattern, pattern)
    bad_tag = _record_finding("'bad_tag'", "b.pos", "b.tag")
    found = bad_tag_positions(tags, regex)
    if first_only:
        found = f"slice({found}, 1, 1)"
    bad = f"transform({found}, b -> {bad_tag})"
    return f"if({length_matches(tokens, tags)}, {bad}, {length_findings(tokens, tags)})"


def sequence_findings(tags: str) -> str:
    """V3: each `I-X` right after an open span of another type."""
    finding = _record_finding("'bad_transition'", "b.pos", "b.tag")
    return f"transform({bad_transitions(tags)}, b -> {finding})"


def type_findings(entities: str, types: list[str] = ENTITY_TYPES) -> str:
    """V4: entity types that are not in the list."""
    unknown = f"filter(map_keys({entities}), t -> t NOT IN ({quoted(types)}))"
    return f"transform({unknown}, t -> {_record_finding(quote('unknown_type'), 'NULL', 't')})"


def span_type_findings(spans: str, types: list[str] = ENTITY_TYPES) -> str:
    """V4 before the spans become entities: each span whose type is not in the list."""
    finding = _record_finding("'unknown_type'", "s.start_pos", "s.type")
    return f"transform(filter({spans}, s -> s.type NOT IN ({quoted(types)})), s -> {finding})"


def usage_findings(usage: str, overuse: bool = True, unknown: bool = True) -> str:
    """V4, V5: tokens used more often than the title has them; it may not have them at all.

    `usage` names the column of `usage.token_usage`, which is taken inside the row, so nothing is shuffled.
    """
    if not unknown:
        usage = f"filter({usage}, u -> u.have > 0)"
    if not overuse:
        usage = f"filter({usage}, u -> u.have = 0)"
    rule = "if(u.have > 0, 'token_overuse', 'unknown_token')"
    return f"transform({usage}, u -> {_record_finding(rule, 'NULL', 'u.token', 'u.used - u.have')})"


_USAGE = "_usage"


def _with_usage(records: DataFrame, entities_col: str, tokens_col: str) -> DataFrame:
    texts = F.expr(f"flatten(map_values({name(entities_col)}))")
    return records.withColumn(_USAGE, token_usage(texts, F.col(name(tokens_col))))


def record_violations(records: DataFrame, *findings: str) -> DataFrame:
    """The findings of one or more record checks as violations, in one pass."""
    joined = ", ".join(f"CAST({f} AS {_RECORD_FINDING})" for f in findings)
    return records.select("record_id", F.explode(F.expr(f"concat({joined})")).alias("f")).selectExpr(
        "f.rule", "record_id", "f.pos", "CAST(NULL AS STRING) AS col", "f.detail", "f.n"
    )


def length_violations(seqs: DataFrame, tag_col: str = "tags") -> DataFrame:
    """Records whose token and tag counts differ."""
    return record_violations(seqs, length_findings("tokens", name(tag_col)))


def validate_alignment(
    seqs: DataFrame, tag_col: str = "tags", pattern: str | None = None
) -> DataFrame:
    """V2: see `alignment_findings`."""
    return record_violations(seqs, alignment_findings("tokens", name(tag_col), pattern))


def validate_sequence(seqs: DataFrame, tag_col: str = "tags") -> DataFrame:
    """V3: see `sequence_findings`."""
    return record_violations(seqs, sequence_findings(name(tag_col)))


def token_overuse(
    records: DataFrame, entities_col: str = "entities", tokens_col: str = "tokens"
) -> DataFrame:
    """V4: tokens of the title that the entities use more often than they occur."""
    return record_violations(_with_usage(records, entities_col, tokens_col), usage_findings(_USAGE, unknown=False))


def unknown_tokens(
    records: DataFrame, entities_col: str = "entities", tokens_col: str = "tokens"
) -> DataFrame:
    """V5: tokens the entities use that the title does not have."""
    return record_violations(_with_usage(records, entities_col, tokens_col), usage_findings(_USAGE, overuse=False))


def validate_entities(
    records: DataFrame, entities_col: str = "entities", tokens_col: str = "tokens"
) -> DataFrame:
    """V4: unknown types and overused tokens."""
    used = _with_usage(records, entities_col, tokens_col)
    return record_violations(used, type_findings(name(entities_col)), usage_findings(_USAGE, unknown=False))


def unknown_types(seqs: DataFrame, tag_col: str = "tags") -> DataFrame:
    """V4: spans in strict mode of a type that is not in the list, with where they start."""
    return record_violations(seqs, span_type_findings(spans_of("tokens", name(tag_col))))


def validate_reconstruction(
    records: DataFrame, entities_col: str = "entities", tokens_col: str = "tokens"
) -> DataFrame:
    """V5: V4 and tokens that do not occur in the title."""
    used = _with_usage(records, entities_col, tokens_col)
    return record_violations(used, type_findings(name(entities_col)), usage_findings(_USAGE))


def validate_submission(
    df: DataFrame, expected: list[str] = SUBMISSION_COLUMNS
) -> DataFrame:
    """V6: column order, then TABs, line breaks and non-strings per column; one aggregate."""
    present = [c for c in expected if c in df.columns]
    counters, findings = ["count(*) AS rows"], []
    if df.columns != expected:
        detail = f"expected {','.join(expected)}; got {','.join(df.columns)}"
        findings.append(_finding("column_mismatch", None, "1", detail))
    for i, c in enumerate(present):
        text = f"CAST({name(c)} AS STRING)"
        is_string = isinstance(df.schema[c].dataType, StringType)
        checks = {
            "tab": f"contains({text}, '\\t')",
            "line_break": f"{text} RLIKE '[\\n\\r]'",
            "non_string": f"{name(c)} IS NULL" if is_string else "true",
        }
        for rule, hit in checks.items():
            counters.append(f"count_if({hit}) AS {rule}_{i}")
            findings.append(_finding(rule, c, f"{rule}_{i}"))
    return _from_findings(df.agg(*map(F.expr, counters)), findings)


def assert_submission(df: DataFrame, expected: list[str] = SUBMISSION_COLUMNS) -> None:
    """V7: raises when V6 finds anything. At most three findings per column reach the driver."""
    found = validate_submission(df, expected).collect()
    if found:
        lines = [f"{v.rule} {v.col or ''} {v.detail or ''} n={v.n}" for v in found]
        raise ValueError("submission is not valid:\n" + "\n".join(lines))


def _is_text(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, StringType)


def row_digest(df: DataFrame) -> Column:
    """256 bits that tell rows apart; rows with map columns cannot be compared."""

    def has_map(data_type) -> bool:
        if isinstance(data_type, StructType):
            return any(has_map(f.dataType) for f in data_type)
        if isinstance(data_type, ArrayType):
            return has_map(data_type.elementType)
        return isinstance(data_type, MapType)

    if any(has_map(f.dataType) for f in df.schema):
        raise ValueError("rows with map columns cannot be compared; cast them first")
    return F.sha2(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}), 256)


def quality_counters(df: DataFrame, where: str = "true") -> list[Column]:
    """V8's aggregates over the rows `where` holds: rows, and per column NULLs, empties, longest."""
    counters = [f"count_if({where}) AS rows"]
    for i, c in enumerate(df.columns):
        counters.append(f"count_if({where} AND {name(c)} IS NULL) AS nulls_{i}")
        if _is_text(df, c):
            counters.append(f"count_if({where} AND {name(c)} = '') AS empty_{i}")
            counters.append(f"max(if({where}, length({name(c)}), NULL)) AS longest_{i}")
    return [F.expr(c) for c in counters]


def quality_table(
    counted: DataFrame, duplicates: Column, like: DataFrame, max_length: int = 1000
) -> DataFrame:
    """V8's table from one row of `quality_counters` over the columns of `like`."""
    per_column = []
    for i, c in enumerate(like.columns):
        text = _is_text(like, c)
        empty = f"empty_{i}" if text else "0L"
        longest = f"longest_{i}" if text else "CAST(NULL AS INT)"
        per_column.append(
            f"struct({quote(c)} AS col, nulls_{i} AS null_count, {empty} AS empty_count, "
            f"{longest} AS max_length, coalesce({longest} > {max_length}, false) AS very_long)"
        )
    return counted.select(
        F.col("rows").alias("total_records"),
        F.lit(len(like.columns)).alias("total_columns"),
        duplicates.alias("duplicate_rows"),
        F.explode(F.expr(f"array({', '.join(per_column)})")).alias("c"),
    ).select("c.*", "total_records", "total_columns", "duplicate_rows")


def data_quality(df: DataFrame, max_length: int = 1000) -> DataFrame:
    """V8: one row per column with rows, columns, NULLs, empties, longest string, duplicates.

    Duplicates are counted over a 256-bit digest of the row, so the shuffle moves 64
    characters per distinct row instead of the row, and copies collapse before it.
    """
    copies = df.groupBy(row_digest(df).alias("digest")).agg(F.count(F.lit(1)).alias("n"))
    duplicates = copies.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n"))
    return quality_table(df.agg(*quality_counters(df)), duplicates.scalar(), df, max_length)


def validation_summary(violations: DataFrame) -> DataFrame:
    """V9: `(rule, violations, is_valid)` per rule, and in total under the rule `all`."""
    per_rule = violations.groupBy("rule").agg(F.expr("count(*) AS violations"))
    # A rollup of no rows has no total; this has.
    total = per_rule.agg(F.expr("coalesce(sum(violations), 0L) AS violations"))
    rows = per_rule.unionByName(total.selectExpr("'all' AS rule", "violations"))
    return rows.selectExpr("*", "violations = 0 AS is_valid")
