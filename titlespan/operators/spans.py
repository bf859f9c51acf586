"""Spans and entities from tag sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titlespan.functions.sql import let, name
from titlespan.functions.tags import (
    check_mode,
    checked_spans,
    effective_tag,
    entities_of,
    is_event,
    opens_span,
    tag_continues,
    tag_spans_of,
    tag_type,
)
from titlespan.types import ENTITY_TYPES


def _span_sql(mode: str, tag_col: str, reference_col: str | None, on_error: str) -> str:
    reference = name(reference_col) if reference_col else None
    return checked_spans("tokens", name(tag_col), mode, reference, on_error)


def with_spans(
    seqs: DataFrame,
    mode: str = "strict",
    tag_col: str = "tags",
    reference_col: str | None = None,
    on_error: str = "raise_length",
) -> DataFrame:
    """Adds the `spans` array; stateless, so it also runs on a stream."""
    found = _span_sql(mode, tag_col, reference_col, on_error)
    return seqs.withColumn("spans", F.expr(found))


def spans(
    seqs: DataFrame,
    mode: str = "strict",
    tag_col: str = "tags",
    reference_col: str | None = None,
    on_error: str = "raise_length",
) -> DataFrame:
    """`(record_id, span_no, type, start_pos, end_pos, text)`; no shuffle."""
    # The expression is exploded as it stands: over a column Spark would infer a filter on
    # its size and evaluate everything below a second time.
    found = F.expr(_span_sql(mode, tag_col, reference_col, on_error))
    return seqs.select("record_id", F.posexplode(found).alias("span_no", "s")).select(
        "record_id", "span_no", "s.*"
    )


def tag_spans(seqs: DataFrame, mode: str = "lenient", tag_col: str = "tags") -> DataFrame:
    """`(record_id, span_no, type, start_pos, end_pos)` from the tags alone."""
    return seqs.select(
        "record_id", F.posexplode(F.expr(tag_spans_of(name(tag_col), mode))).alias("span_no", "s")
    ).select("record_id", "span_no", "s.*")


def entities(
    seqs: DataFrame,
    mode: str = "strict",
    tag_col: str = "tags",
    reference_col: str | None = None,
    on_error: str = "raise",
) -> DataFrame:
    """`(record_id, entities)`, a map of every type to its texts in title order.

    The map has the listed types only, so a span of another type is an error unless `on_error`
    says otherwise; `checks.unknown_types` lists such spans.
    """
    return with_spans(seqs, mode, tag_col, reference_col, on_error).select(
        "record_id", F.expr(entities_of("spans")).alias("entities")
    )


def batch_reconstruct(seqs: DataFrame, tag_col: str = "tags") -> DataFrame:
    """E5: E4 in strict mode; a record with an error keeps its row with all types empty."""
    return entities(seqs, "strict", tag_col, on_error="empty")


def entities_wide(entities_df: DataFrame, types: list[str] = ENTITY_TYPES) -> DataFrame:
    """One array column per type."""
    return entities_df.select("record_id", *[F.col("entities")[t].alias(t) for t in types])


# --- long tables -------------------------------------------------------------------------
#
# A long table holds one token per row, so a record may be far too big for one task. It is
# cut into blocks of positions, which are handled inside the row like whole sequences. What
# a block needs to know of the ones before it is one tag and the span left open, and these
# come from a window over block summaries, `block` times fewer rows than tokens.


def _events(mode: str) -> str:
    """The tags of a block that may start or end a span, with their place in the block."""
    placed = "transform(items, (x, i) -> struct(i AS at, x.pos AS pos, x.tag AS tag))"
    return f"filter({placed}, e -> {is_event('e.tag', mode)})"


def _breaks(before_first: str) -> str:
    """The events that do not continue the one before; `before_first` precedes the block."""
    continues = tag_continues("e.tag", f"coalesce(get(events, j - 1).tag, {before_first})")
    return f"filter(events, (e, j) -> NOT coalesce({continues}, false))"


def _start(event: str) -> str:
    return f"struct({event}.pos AS start_pos, {tag_type(f'{event}.tag')} AS type)"


def _block_states(blocks: DataFrame) -> DataFrame:
    """Per block the last event before it and the span open at its beginning.

    Only a block's first event depends on the tag carried into it; the last break after
    that event is known from the block alone.
    """
    later = "filter(breaks, b -> b.at > events[0].at)"
    last_later = let("later", later, f"if(size(later) > 0, {_start('element_at(later, -1)')}, NULL)")
    summary = blocks.selectExpr(
        "record_id",
        "block",
        "get(events, 0) AS first",
        "get(events, size(events) - 1).tag AS last_tag",
        f"if(size(events) = 0, NULL, {let('breaks', _breaks('NULL'), last_later)}) AS later",
    )
    before = "PARTITION BY record_id ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    carried = summary.selectExpr("*", f"last(last_tag, true) OVER ({before}) AS carried")
    first_breaks = f"first IS NOT NULL AND NOT coalesce({tag_continues('first.tag', 'carried')}, false)"
    return carried.selectExpr(
        "*", f"coalesce(later, if({first_breaks}, {_start('first')}, NULL)) AS last_break"
    ).selectExpr(
        "record_id", "block", "carried", f"last(last_break, true) OVER ({before}) AS open_span"
    )


def spans_from_long(
    tagged: DataFrame,
    mode: str = "strict",
    reference_col: str | None = None,
    block: int = 4096,
) -> DataFrame:
    """E1–E3 over `(record_id, pos, token, tag)`: `(record_id, type, start_pos, end_pos, text)`.

    For tables that already hold one token per row. Tags are worked on `block` tokens at a time,
    however long the record is; only the text of one span is put together as a whole.
    """
    check_mode(mode, reference_col is not None)
    reference = name(reference_col) if reference_col else None
    effective = tagged.selectExpr("record_id", "pos", f"{effective_tag('tag', mode, reference)} AS tag", "token")
    in_span = f"tag = '' OR {opens_span('tag')}"
    rows = effective.selectExpr(
        "record_id",
        # Never NULL, which spares the two sides of the join below a filter that differs.
        f"coalesce(floor(pos / {block}), 0L) AS block",
        # A token that no span can hold stays behind, only its tag travels.
        f"struct(pos, tag, if({in_span}, token, NULL) AS token) AS item",
    )
    blocks = (
        rows.groupBy("record_id", "block")
        .agg(F.sort_array(F.collect_list("item")).alias("items"))
        .selectExpr("*", f"{_events(mode)} AS events")
    )
    # An inner join asks the same of both sides, so their common shuffle runs once.
    joined = blocks.join(_block_states(blocks), ["record_id", "block"], "inner")

    # The span open at the beginning, then those that start here, as ranges of places.
    bounds = f"""concat(
        array(struct(0 AS at, open_span AS span)),
        transform({_breaks('carried')}, b -> struct(b.at AS at, {_start('b')} AS span)))"""
    stop = "coalesce(get(bounds, k + 1).at, size(items))"
    members = f"""filter(slice(items, b.at + 1, {stop} - b.at),
        m -> m.tag = '' OR {opens_span('m.tag')})"""

    def pieces(which: str) -> str:
        """The pieces of the bounds `k` for which `which` holds, with their last place and text."""
        piece = let("ms", f"if(b.span.type IS NULL OR NOT ({which}), array(), {members})", """struct(
            b.span.type AS type, b.span.start_pos AS start_pos, get(ms, size(ms) - 1).pos AS end_pos,
            size(ms) AS n, array_join(transform(ms, m -> m.token), ' ') AS text)""")
        return let("bounds", bounds, f"filter(transform(bounds, (b, k) -> {piece}), p -> p.n > 0)")

    # A span that starts here and is followed by another bound is whole. Only what is open at
    # either edge of a block meets its other pieces: two pieces a block at most.
    edge = "k = 0 OR k = size(bounds) - 1"
    whole = joined.select("record_id", F.explode(F.expr(pieces(f"NOT ({edge})"))).alias("p"))
    parts = joined.select("record_id", "block", F.explode(F.expr(pieces(edge))).alias("p"))
    put_together = (
        parts.groupBy("record_id", F.col("p.type"), F.col("p.start_pos"))
        .agg(
            F.max("p.end_pos").alias("end_pos"),
            F.sort_array(F.collect_list(F.struct("block", "p.text"))).alias("parts"),
        )
        .selectExpr(
            "record_id",
            "type",
            "start_pos",
            "end_pos",
            "array_join(transform(parts, p -> p.text), ' ') AS text",
        )
    )
    found = whole.select("record_id", "p.type", "p.start_pos", "p.end_pos", "p.text").unionByName(put_together)
    return found.filter(F.col("type").isin(ENTITY_TYPES)) if mode == "lenient" else found
