"""Small helpers for composing SQL expressions."""

from __future__ import annotations

from collections.abc import Iterable


def quote(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def quoted(values: Iterable[str]) -> str:
    """String literals, separated by commas."""
    return ", ".join(quote(v) for v in values)


def name(column: str) -> str:
    """A column name as an identifier."""
    return "`" + column.replace("`", "``") + "`"


def let(variable: str, value: str, body: str) -> str:
    """Evaluate `value` once per row under the name `variable` and use it in `body`.

    Inside a higher-order function an outer expression is evaluated again for every
    element, which makes neighbour look-ups quadratic. Bound as the only element of an
    array it becomes a lambda variable, whose value is computed once.
    """
    return f"get(transform(array({value}), {variable} -> {body}), 0)"


def multiset(items: str) -> str:
    """Map of item → number of occurrences, by sorting and measuring the runs."""
    heads = (
        "filter(transform(ordered, (x, i) -> struct(i AS at, x AS item, "
        "i = 0 OR x <> get(ordered, i - 1) AS head)), h -> h.head)"
    )
    counts = (
        "map_from_arrays(transform(heads, h -> h.item), "
        "transform(heads, (h, k) -> coalesce(get(heads, k + 1).at, size(ordered)) - h.at))"
    )
    return let("ordered", f"array_sort({items})", let("heads", heads, counts))
