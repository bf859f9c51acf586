"""Tokenisation, token features and neighbours."""

from __future__ import annotations

from titlespan.functions.sql import let, quote, quoted

# Every character Python's str.split() treats as white space: the Unicode property
# (which (?U) gives \s) and the four information separators.
WHITESPACE = r"(?U)[\s\x1c-\x1f]"

# Part abbreviations, matched exactly.
ABBREVIATIONS = ["WaPu", "Bremss", "Brems", "Zahnriemen", "Stossd", "Kuppl"]

# Common automotive terms, matched in lower case.
AUTOMOTIVE_TERMS = [
    "bremsen", "bremse", "bremsbelag", "bremssattel", "bremsflüssigkeit",
    "filter", "luftfilter", "ölfilter", "kraftstofffilter", "innenraumfilter",
    "kupplung", "kupplungsscheibe", "schwungrad", "zahnriemen", "steuerkette",
    "stossdämpfer", "federbein", "querlenker", "spurstange", "lenkgetriebe",
    "wasserpumpe", "thermostat", "kühler", "heizung", "klimaanlage",
    "anlasser", "lichtmaschine", "zündkerze", "glühkerze", "batterie",
    "scheibenwischer", "scheinwerfer", "rücklicht", "blinker", "spiegel",
]

# Markers for the neighbour beyond either end of a title.
START, END = "<START>", "<END>"

_UPPER = r"\p{IsUppercase}"
_LOWER = r"\p{IsLowercase}"
_TITLE = r"\p{Lt}"
_CASED = _UPPER + _LOWER + _TITLE
# Digits str.isdigit() accepts beyond the decimal digits: superscripts, subscripts, the
# circled and parenthesised runs, and the digits of a few historic scripts.
_DIGIT = (
    r"\p{Nd}\x{b2}\x{b3}\x{b9}\x{1369}-\x{1371}\x{19da}\x{2070}\x{2074}-\x{2079}"
    r"\x{2080}-\x{2089}\x{2460}-\x{2468}\x{2474}-\x{247c}\x{2488}-\x{2490}\x{24ea}"
    r"\x{24f5}-\x{24fd}\x{24ff}\x{2776}-\x{277e}\x{2780}-\x{2788}\x{278a}-\x{2792}"
    r"\x{10a40}-\x{10a43}\x{10e60}-\x{10e68}\x{11052}-\x{1105a}\x{1f100}-\x{1f10a}"
)


def tokenize(title: str) -> str:
    """White-space tokens in order, duplicates kept; NULL and blank give an empty array."""
    return f"array_remove(split(coalesce({title}, ''), r'{WHITESPACE}+'), '')"


def neighbours(tokens: str) -> str:
    """One struct `(pos, token, prev_token, next_token, is_last)` per token.

    Built inside the row, so that the explode that follows carries three strings per
    token rather than the whole token array.
    """
    return let(
        "ts",
        tokens,
        f"""transform(ts, (t, i) -> struct(
            i AS pos,
            t AS token,
            coalesce(get(ts, i - 1), {quote(START)}) AS prev_token,
            coalesce(get(ts, i + 1), {quote(END)}) AS next_token,
            i = size(ts) - 1 AS is_last))""",
    )


def is_numeric(token: str) -> str:
    """T5: Python `str.isdigit`."""
    return f"{token} RLIKE r'^[{_DIGIT}]+$'"


def is_alphanumeric(token: str) -> str:
    """ASCII letters and digits only, so umlauts are false."""
    return f"{token} RLIKE '^[a-zA-Z0-9]+$'"


def has_special_chars(token: str) -> str:
    """Any character beyond ASCII letters, digits and white space; umlauts are true."""
    return rf"{token} RLIKE r'(?U)[^a-zA-Z0-9\s\x1c-\x1f]'"


def is_uppercase(token: str) -> str:
    """Python `str.isupper`."""
    return f"{token} RLIKE r'[{_UPPER}]' AND NOT {token} RLIKE r'[{_LOWER}{_TITLE}]'"


def is_lowercase(token: str) -> str:
    """Python `str.islower`."""
    return f"{token} RLIKE r'[{_LOWER}]' AND NOT {token} RLIKE r'[{_UPPER}{_TITLE}]'"


def is_title_case(token: str) -> str:
    """Python `str.istitle`: upper case only after uncased, lower case only after cased."""
    return (
        f"{token} RLIKE r'[{_CASED}]' AND NOT {token} RLIKE r'[{_CASED}][{_UPPER}{_TITLE}]' "
        f"AND NOT {token} RLIKE r'(^|[^{_CASED}])[{_LOWER}]'"
    )


def contains_digit(token: str) -> str:
    """Any Unicode decimal digit."""
    return rf"{token} RLIKE r'\p{{Nd}}'"


def is_abbreviation(token: str, abbreviations: list[str] = ABBREVIATIONS) -> str:
    """Exact, case-sensitive membership."""
    return f"{token} IN ({quoted(abbreviations)})"


def is_automotive_term(token: str, terms: list[str] = AUTOMOTIVE_TERMS) -> str:
    """Membership after lower-casing."""
    return f"lower({token}) IN ({quoted(terms)})"


def features(token: str) -> dict[str, str]:
    """T4–T12, keyed by output column name."""
    return {
        "length": f"length({token})",
        "is_numeric": is_numeric(token),
        "is_alphanumeric": is_alphanumeric(token),
        "has_special_chars": has_special_chars(token),
        "is_uppercase": is_uppercase(token),
        "is_lowercase": is_lowercase(token),
        "is_title_case": is_title_case(token),
        "contains_digit": contains_digit(token),
        "is_abbreviation": is_abbreviation(token),
        "is_common_automotive_term": is_automotive_term(token),
    }
