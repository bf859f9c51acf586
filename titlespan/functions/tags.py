"""Tag sequences, spans and entities as array expressions.

All expressions work inside one row, so none of them shuffles, and each is linear in the
number of tokens .
"""

from __future__ import annotations

from titlespan.functions.sql import let, quote, quoted
from titlespan.types import ENTITY_TYPES, OUTSIDE, SPAN_SCHEMA

MODES = ("strict", "lenient", "reference")

# Stands for a blank prediction where the reference tag is not blank.
_PASSED_OVER = "-"

# Fixed value: the literal tag pattern that accepts upper-case type names only.
UPPER_PATTERN = "^(O|B-[A-Z_]+|I-[A-Z_]+)?$"


def type_pattern(types: list[str] = ENTITY_TYPES) -> str:
    """Pattern of a valid tag over a list of types; blank is valid."""
    return "^(O|[BI]-(" + "|".join(types) + "))?$"


def check_mode(mode: str, has_reference: bool) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    if (mode == "reference") != has_reference:
        raise ValueError("reference tags go with mode='reference' and with no other")


def blank_to_empty(tags: str) -> str:
    """NULL and '' are one state: blank."""
    return f"transform({tags}, t -> coalesce(t, ''))"


def opens_span(tag: str) -> str:
    """`B-` and `I-` tags."""
    return f"(startswith({tag}, 'B-') OR startswith({tag}, 'I-'))"


def tag_type(tag: str) -> str:
    """The type after `B-` / `I-`, NULL for any other tag."""
    return f"if({opens_span(tag)}, substr({tag}, 3), NULL)"


def tag_continues(tag: str, previous: str) -> str:
    """True for `I-X` after a tag of type X; NULL or false otherwise."""
    return (
        f"(startswith({tag}, 'I-') AND ({previous} = {tag} OR "
        f"(startswith({previous}, 'B-') AND substr({tag}, 3) = substr({previous}, 3))))"
    )


def effective_tag(tag: str, mode: str, reference: str | None = None) -> str:
    """One tag with the blank rule of the mode applied.

    The three modes differ only in blank and invalid tags. In the result an empty tag
    belongs to the span that is open, if any; `O` closes it; a tag that is neither empty,
    `O`, `B-` nor `I-` closes it in strict mode and is passed over in the other two.
    """
    if mode == "strict":
        return f"coalesce({tag}, '')"
    if mode == "lenient":
        return f"if(coalesce({tag}, '') = '', '{OUTSIDE}', {tag})"
    return (
        f"CASE WHEN coalesce({reference}, '') = '' THEN '' "
        f"WHEN coalesce({tag}, '') = '' THEN '{_PASSED_OVER}' ELSE {tag} END"
    )


def is_event(tag: str, mode: str) -> str:
    """Effective tags that may start or end a span."""
    if mode == "strict":
        return f"{tag} <> ''"
    return f"({tag} = '{OUTSIDE}' OR {opens_span(tag)})"


def effective_tags(tags: str, mode: str = "strict", reference: str | None = None) -> str:
    """`effective_tag` over arrays."""
    check_mode(mode, reference is not None)
    if reference is None:
        return f"transform({tags}, t -> {effective_tag('t', mode)})"
    return f"zip_with({tags}, {reference}, (t, r) -> {effective_tag('t', mode, 'r')})"


def _ranges(effective: str, mode: str) -> str:
    """Ranges `(type, start, stop, last)` from one span start to the next boundary.

    Tags that never start or end a span are dropped first; then the tag before a token is
    its left neighbour, and no running state is needed. `last` is the place of the range's last
    tag that is left.
    """
    placed = f"transform({effective}, (t, i) -> struct(i AS pos, t AS tag))"
    events = f"filter({placed}, e -> {is_event('e.tag', mode)})"
    continues = tag_continues("e.tag", "get(events, j - 1).tag")
    breaks = f"""filter(
        transform(events, (e, j) -> if(coalesce({continues}, false), NULL,
            struct(e.pos AS pos, e.tag AS tag, get(events, j - 1).pos AS before))),
        b -> b IS NOT NULL)"""
    ranges = f"""filter(
        transform(breaks, (b, k) -> struct(
            {tag_type('b.tag')} AS type,
            b.pos AS start,
            coalesce(get(breaks, k + 1).pos, size({effective})) AS stop,
            coalesce(get(breaks, k + 1).before, get(events, size(events) - 1).pos) AS last)),
        r -> r.type IS NOT NULL)"""
    return let("events", events, let("breaks", breaks, ranges))


def _members(items: str) -> str:
    """The items of range `r` that belong to its span: opening, continuing and empty tags."""
    sliced = f"slice({items}, r.start + 1, r.stop - r.start)"
    return f"filter({sliced}, m -> m.tag = '' OR {opens_span('m.tag')})"


def spans_of(tokens: str, tags: str, mode: str = "strict", reference: str | None = None) -> str:
    """Array of `(type, start_pos, end_pos, text)` in title order.

    strict     blank continues an open span, an invalid tag closes it
    lenient    blank closes, an invalid tag is skipped, unknown types are dropped
    reference  blankness is read from the reference tags, an invalid tag is skipped

    A span ends at its last member token; its text joins the members with one space. Only
    as many tags as there are tokens count; the length check is `length_matches`.
    """
    ranges = _ranges("es", mode)
    if mode == "strict":
        spans = f"""transform({ranges}, r -> struct(
            r.type AS type,
            r.start AS start_pos,
            r.stop - 1 AS end_pos,
            array_join(slice(ts, r.start + 1, r.stop - r.start), ' ') AS text))"""
    else:
        span = """struct(
            r.type AS type,
            r.start AS start_pos,
            get(ms, size(ms) - 1).pos AS end_pos,
            array_join(transform(ms, m -> m.token), ' ') AS text)"""
        placed = "transform(es, (t, i) -> struct(i AS pos, t AS tag, get(ts, i) AS token))"
        spans = let("ps", placed, f"transform({ranges}, r -> {let('ms', _members('ps'), span)})")
    if mode == "lenient":
        spans = f"filter({spans}, s -> s.type IN ({quoted(ENTITY_TYPES)}))"
    used = effective_tags(f"slice({tags}, 1, size(ts))", mode, reference)
    return f"CAST({let('ts', tokens, let('es', used, spans))} AS {SPAN_SCHEMA})"


def tag_spans_of(tags: str, mode: str = "lenient") -> str:
    """Array of `(type, start_pos, end_pos)` from the tags alone, of any type."""
    # Without blanks the last tag that is left is a member; in strict mode blanks are, up to the end.
    last = "r.stop - 1" if mode == "strict" else "r.last"
    spans = f"""transform({_ranges('es', mode)}, r -> struct(
        r.type AS type, r.start AS start_pos, {last} AS end_pos))"""
    return let("es", effective_tags(tags, mode), spans)


def length_matches(tokens: str, tags: str) -> str:
    """One tag per token."""
    return f"size({tokens}) = size({tags})"


def known_types_only(spans: str, types: list[str] = ENTITY_TYPES) -> str:
    """True when every span has one of the listed types."""
    return f"forall({spans}, s -> s.type IN ({quoted(types)}))"


def checked_spans(
    tokens: str,
    tags: str,
    mode: str = "strict",
    reference: str | None = None,
    on_error: str = "raise_length",
) -> str:
    """E1–E3 with E7's length check.

    `raise_length` fails on a length mismatch, `raise` also on an unknown type, `empty`
    gives no spans for such a record. Reference mode checks the reference tags' length.
    """
    checked = reference or tags
    nothing = f"CAST(array() AS {SPAN_SCHEMA})"
    sizes = f"format_string('%d tokens but %d tags', size({tokens}), size({checked}))"
    length_error = f"CAST(raise_error({sizes}) AS {SPAN_SCHEMA})"
    type_error = f"CAST(raise_error('span of an unknown type') AS {SPAN_SCHEMA})"
    found = spans_of(tokens, tags, mode, reference)

    def known_or(fallback: str) -> str:
        return let("found", found, f"if({known_types_only('found')}, found, {fallback})")

    branches = {
        "raise_length": (found, length_error),
        "raise": (known_or(type_error), length_error),
        "empty": (known_or(nothing), nothing),
    }
    if on_error not in branches:
        raise ValueError(f"on_error must be one of {list(branches)}, got {on_error!r}")
    good, bad = branches[on_error]
    return f"if({length_matches(tokens, checked)}, {good}, {bad})"


def entities_of(spans: str, types: list[str] = ENTITY_TYPES) -> str:
    """Map of every type → texts in title order, duplicates kept."""
    texts = ", ".join(
        f"transform(filter(ss, s -> s.type = {quote(t)}), s -> s.text)" for t in types
    )
    return let("ss", spans, f"map_from_arrays(array({quoted(types)}), array({texts}))")


def _placed(tags: str) -> str:
    return f"transform({tags}, (t, i) -> struct(i AS pos, coalesce(t, '') AS tag))"


def bad_tag_positions(tags: str, pattern: str) -> str:
    """V2: `(pos, tag)` of the tags that do not match the pattern; blanks are valid."""
    return f"filter({_placed(tags)}, p -> NOT p.tag RLIKE {quote(pattern)})"


def bad_transitions(tags: str) -> str:
    """V3: `(pos, tag)` of each `I-X` that follows an open span of another type.

    Invalid tags leave the open type as it is, so they are dropped first; `O` and blank
    have no type, so the comparison with them is NULL and nothing is reported.
    """
    events = f"filter({_placed(tags)}, p -> p.tag IN ('', '{OUTSIDE}') OR {opens_span('p.tag')})"
    other_type = (
        f"startswith(e.tag, 'I-') AND {tag_type('get(events, j - 1).tag')} <> {tag_type('e.tag')}"
    )
    return let("events", events, f"filter(events, (e, j) -> coalesce({other_type}, false))")


def fit_length(tags: str, n: str) -> str:
    """M4: cut or pad with `O` to n tags."""
    padding = f"array_repeat('{OUTSIDE}', greatest({n} - size({tags}), 0))"
    return f"slice(concat({tags}, {padding}), 1, {n})"
