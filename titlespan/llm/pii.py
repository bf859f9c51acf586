"""Operator 3: format-preserving pseudonyms for personal data, in SQL expressions only.

Numbers that pass their validation (cards, bank accounts, social security numbers, dates,
addresses of machines, telephone numbers) and other identifying strings (mail addresses,
secrets) are replaced by the image of a keyed permutation of the values of the same format.
The permutations are Feistel networks: half of a value is shifted by a keyed digest of the other
half, in turn, modulo what the half may hold. So a pseudonym is as valid as the value was,
equal values stay equal across documents, and different ones stay different.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from titlespan.functions.sql import let, name, quote
from titlespan.llm.common import documents, two_columns

ROUNDS = 8
#: Steps until a walk has failed: less often than once in 10^20 values.
WALK = 60
#: The key of the registered query; callers bring their own.
KEY = "titlespan"

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_KEYWORD = "(?i:token|secret|passwd|password|api_key|api-key|apikey)"
#: By kind: what a value looks like, in the order in which kinds are tried at a place.
PATTERNS = {
    "secret": r"((?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])"
    rf"|(?<={_KEYWORD}[ ]{{0,1}}[=:][ ]{{0,1}}[\"']{{0,1}})"
    r"(?<![ ]{2})[A-Za-z0-9/+_-]{8,}+)",
    "mail": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}+@[A-Za-z0-9][A-Za-z0-9-]{0,62}+"
    r"(?:\.[A-Za-z0-9][A-Za-z0-9-]{0,62}+){1,8}+",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
    "phone": r"(?<![0-9A-Za-z+])\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
    r"|(?<![0-9A-Za-z+])\+[2-9][0-9]{0,2}(?:[ -]?\(?[0-9]{2,4}\)?){2,4}(?![0-9]|\.[0-9])"
    r"|(?<![0-9A-Za-z])\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9])"
    r"|(?<![0-9A-Za-z.-])[0-9]{3}([.-])[0-9]{3}\1[0-9]{4}(?![0-9]|[.-][0-9])",
    "address": rf"(?<![0-9A-Za-z]|[0-9]\.)(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9A-Za-z]|\.[0-9])",
    "date": r"(?<![0-9A-Za-z]|[0-9][./-])(?:(?:19|20)[0-9]{2}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12][0-9]|3[01])"
    r"|(?:0[1-9]|[12][0-9]|3[01])([./])(?:0[1-9]|[12][0-9]|3[01])\1(?:19|20)[0-9]{2})(?![0-9A-Za-z]|[./-][0-9])",
    "social": r"(?<![0-9A-Za-z]|[0-9]-)(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9A-Za-z]|-[0-9])",
    "card": r"(?<![0-9A-Za-z]|[0-9][.-])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}"
    r"|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5})(?![0-9A-Za-z])",
}
KINDS = list(PATTERNS)
#: Every value of every kind holds a digit, an at sign or AKIA, or has a keyword before it.
HINT = f"[0-9@]|AKIA|{_KEYWORD}[ ]?[=:]"

#: Days from 1900-01-01 to 2099-12-31 are 17 times 4297.
FIRST_DAY, DAYS_HIGH, DAYS_LOW = "1900-01-01", 17, 4297
#: Areas 001 to 899 without 666, groups 01 to 99, and serial numbers 0001 to 9999.
AREAS, GROUPS, SERIALS = 898, 99, 9999


def _groups(kinds: list[str]) -> int:
    return sum(len(re.findall(r"(?<!\\)\((?!\?)", PATTERNS[kind])) for kind in kinds)


def _pattern(kinds: list[str]) -> str:
    """One pattern for all kinds; back-references are renumbered to its groups."""
    parts, groups = [], 0
    for kind in kinds:
        own = PATTERNS[kind]
        count = _groups([kind])
        for i in range(count, 0, -1):
            own = own.replace(f"\\{i}", f"\\{groups + i}")
        parts.append(own)
        groups += count
    return "|".join(parts)


def _is(value: str, kind: str) -> str:
    """Whether a match has the shape of a kind; look-arounds saw the text around it before."""
    own = PATTERNS[kind]
    if kind == "secret":
        return f"NOT {value} RLIKE '[@. ]' AND {value} RLIKE '^(AKIA[0-9A-Z]{{16}}|[A-Za-z0-9/+_-]{{8,}})$'"
    return f"{value} RLIKE {quote('^(?:' + own + ')$')}"


def _digest(key: str, kind: str, turn: str, text: str) -> str:
    """128 hexadecimal digits."""
    return f"sha2(concat({quote(key + '|' + kind + '|')}, {turn}, '|', {text}), 512)"


def _number(key: str, kind: str, turn: str, value: str) -> str:
    """A keyed number of 60 bits."""
    digest = _digest(key, kind, turn, f"CAST({value} AS STRING)")
    return f"CAST(conv(substr({digest}, 1, 15), 16, 10) AS BIGINT)"


def permuted_pair(key: str, kind: str, left: str, right: str, lefts: int, rights: int) -> str:
    """SQL of a struct `(l, r)`: a keyed permutation of the pairs below `(lefts, rights)`."""
    to_left = f"(s.l + {_number(key, kind, 'CAST(turn AS STRING)', 's.r')}) % {lefts}L"
    to_right = f"(s.r + {_number(key, kind, 'CAST(turn AS STRING)', 's.l')}) % {rights}L"
    return (
        f"aggregate(sequence(1, {ROUNDS}), "
        f"named_struct('l', CAST({left} AS BIGINT), 'r', CAST({right} AS BIGINT)), "
        f"(s, turn) -> if(turn % 2 = 1, named_struct('l', {to_left}, 'r', s.r), "
        f"named_struct('l', s.l, 'r', {to_right})))"
    )


def _walked(start: str, step: str, there: str) -> str:
    """SQL: `step` applied to `x` from `start` on, once at least, until `there` holds.

    A permutation of a set, walked until the image lies in a part of it, is a permutation of that
    part. One step misses with a probability of four tenths at most, and never more often than the
    other part has members, so a walk that has not ended after `WALK` steps is an error.
    """
    tried = f"aggregate(sequence(0, {WALK}), {start}, (x, n) -> if(n > 0 AND {there}, x, {step}))"
    return let("x", tried, f"if({there}, x, raise_error('a pseudonym was not found'))")


def permuted_text(key: str, kind: str, value: str, apart: str = "false") -> str:
    """SQL of a text of the same shape: digits stay digits, small and capital letters what they
    are, and everything else stays itself. Texts with letters beyond f, small or capital, are
    permuted among themselves, and so are those without, so that hexadecimal ones stay
    hexadecimal. `apart` holds for images `x` that other texts have. Linear in the text."""
    shift = "CAST(conv(substr(d, 1 + 2 * (i % 64), 2), 16, 10) AS INT)"
    moved = (
        "CASE WHEN c >= '0' AND c <= '9' THEN chr(48 + (ascii(c) - 48 + k) % 10) "
        "WHEN c >= 'a' AND c <= 'z' THEN chr(97 + (ascii(c) - 97 + k) % if(low, 26, 6)) "
        "WHEN c >= 'A' AND c <= 'Z' THEN chr(65 + (ascii(c) - 65 + k) % if(high, 26, 6)) ELSE c END"
    )

    def shifted(half: str, other: str) -> str:
        letters = f"array_join(transform(split({half}, ''), (c, i) -> {let('k', shift, moved)}), '')"
        digest = _digest(key, kind, "CAST(turn AS STRING)", other)
        return f"if(length({half}) = 0, '', {let('d', digest, letters)})"

    step = (
        f"aggregate(sequence(1, {ROUNDS}), named_struct("
        "'l', substr(x, 1, length(x) div 2), 'r', substr(x, 1 + length(x) div 2)), "
        f"(s, turn) -> if(turn % 2 = 1, named_struct('l', {shifted('s.l', 's.r')}, 'r', s.r), "
        f"named_struct('l', s.l, 'r', {shifted('s.r', 's.l')})), s -> concat(s.l, s.r))"
    )
    there = f"(x RLIKE '[g-z]') = low AND (x RLIKE '[G-Z]') = high AND NOT ({apart})"
    walked = let("low", "v RLIKE '[g-z]'", let("high", "v RLIKE '[G-Z]'", _walked("v", step, there)))
    return let("v", value, walked)


def _filled(shape: str, digits: str) -> str:
    """SQL: the digits of `shape` replaced, one after another, by `digits`."""
    place = "length(regexp_replace(substr(shape, 1, i), '[^0-9]', ''))"
    each = let("c", "substr(shape, i, 1)", f"if(c >= '0' AND c <= '9', substr(digits, {place}, 1), c)")
    whole = f"array_join(transform(sequence(1, length(shape)), i -> {each}), '')"
    return let("shape", shape, let("digits", digits, whole))


def luhn_sum(digits: str) -> str:
    """SQL: the sum whose last digit is 0 for a valid number; the last digit counts once."""
    value = "CAST(substr(n, length(n) + 1 - i, 1) AS INT)"
    doubled = f"if(i % 2 = 1, {value}, ({value} * 2) div 10 + ({value} * 2) % 10)"
    return let("n", digits, f"aggregate(sequence(1, length(n)), 0L, (s, i) -> s + {doubled})")


def iban_rest(text: str) -> str:
    """SQL: a text of digits and capital letters as a number (A is 10, Z is 35) modulo 97."""
    value = let(
        "c",
        "substr(n, i, 1)",
        "if(c <= '9', (s * 10 + ascii(c) - 48) % 97, (s * 100 + ascii(c) - 55) % 97)",
    )
    return let("n", text, f"aggregate(sequence(1, length(n)), 0L, (s, i) -> {value})")


def _card(key: str) -> str:
    body = permuted_text(key, "card", "substr(d, 1, length(d) - 1)")
    check = f"CAST((10 - {luhn_sum('concat(b, 0)')} % 10) % 10 AS STRING)"
    made = let("b", body, f"concat(b, {check})")
    valid = f"{luhn_sum('d')} % 10 = 0"
    return let("d", "regexp_replace(m, '[^0-9]', '')", f"if({valid}, {_filled('m', made)}, NULL)")


def _iban(key: str) -> str:
    check = f"lpad(CAST(98 - {iban_rest("concat(b, land, '00')")} AS STRING), 2, '0')"
    new = let("b", permuted_text(key, "iban", "substr(d, 5)"), f"concat(land, {check}, b)")
    spaced = "if(m LIKE '% %', rtrim(regexp_replace(made, '(.{4})', '$1 ')), made)"
    valid = f"{iban_rest('concat(substr(d, 5), substr(d, 1, 4))')} = 1"
    result = f"if({valid}, {let('made', new, spaced)}, NULL)"
    return let("d", "replace(m, ' ', '')", let("land", "substr(d, 1, 2)", result))


def _phone(key: str) -> str:
    """The country's number stays, and so does the shape."""
    land = "regexp_extract(m, '^([+](?:1|[0-9]{1,3}))', 1)"
    digits = "regexp_replace(rest, '[^0-9]', '')"
    made = _filled("rest", permuted_text(key, "phone", digits))
    return let("land", land, let("rest", "substr(m, 1 + length(land))", f"concat(land, {made})"))


def _address(key: str) -> str:
    octet = "CAST(get(o, {}) AS BIGINT)"
    left, right = (f"{octet.format(i)} * 256 + {octet.format(i + 1)}" for i in (0, 2))
    pair = permuted_pair(key, "address", left, right, 65536, 65536)
    made = "concat_ws('.', p.l div 256, p.l % 256, p.r div 256, p.r % 256)"
    return let("o", "split(m, '[.]')", let("p", pair, made))


def _day(number: str) -> str:
    return f"date_add(DATE'{FIRST_DAY}', CAST({number} AS INT))"


def _date(key: str) -> str:
    """Year first, or else day before month where that is a date, month before day otherwise.
    What no calendar has is no date."""

    def tried(shape: str, otherwise: str) -> str:
        known = f"try_to_date(m, {quote(shape)})"
        pair = permuted_pair(key, "date", f"x div {DAYS_LOW}", f"x % {DAYS_LOW}", DAYS_HIGH, DAYS_LOW)
        # Month first is what could not be day first, and so it must stay.
        there = f"dayofmonth({_day('x')}) > 12" if shape.startswith("MM") else "true"
        walked = _walked(f"CAST(datediff(day, DATE'{FIRST_DAY}') AS BIGINT)", let("p", pair, f"p.l * {DAYS_LOW} + p.r"), there)
        body = let("day", known, f"date_format({_day(walked)}, {quote(shape)})")
        return f"if({known} IS NOT NULL, {body}, {otherwise})"

    def both(sign: str) -> str:
        return tried(f"dd{sign}MM{sign}yyyy", tried(f"MM{sign}dd{sign}yyyy", "NULL"))

    year_first = tried("yyyy-MM-dd", "NULL")
    return f"CASE WHEN m LIKE '%-%' THEN {year_first} WHEN m LIKE '%.%' THEN {both('.')} ELSE {both('/')} END"


def _social(key: str) -> str:
    area = "CAST(substr(m, 1, 3) AS BIGINT)"
    rank = f"({area} - if({area} > 666, 2, 1)) * {GROUPS} + CAST(substr(m, 5, 2) AS BIGINT) - 1"
    pair = permuted_pair(
        key, "social", rank, "CAST(substr(m, 8) AS BIGINT) - 1", AREAS * GROUPS, SERIALS
    )
    back = f"p.l div {GROUPS} + if(p.l div {GROUPS} >= 665, 2, 1)"
    made = (
        f"concat(lpad(CAST({back} AS STRING), 3, '0'), '-', lpad(CAST(p.l % {GROUPS} + 1 AS STRING), 2, '0'), "
        "'-', lpad(CAST(p.r + 1 AS STRING), 4, '0'))"
    )
    return let("p", pair, made)


def _mail(key: str) -> str:
    """All but the last label."""
    top = "regexp_extract(m, '([.][A-Za-z0-9-]+)$', 1)"
    body = permuted_text(key, "mail", "substr(m, 1, length(m) - length(top))")
    return let("top", top, f"concat({body}, top)")


def _secret(key: str) -> str:
    """The mark of an access key stays, and no other secret gets it."""
    marked = "{0} LIKE 'AKIA%' AND length({0}) = 20"
    body = permuted_text(key, "secret", "substr(m, 1 + length(head))", marked.format("x"))
    return let("head", f"if({marked.format('m')}, 'AKIA', '')", f"concat(head, {body})")


#: SQL of the pseudonym of a match `m` of each kind, null where its validation fails.
_MAKERS = {
    "secret": _secret, "mail": _mail, "iban": _iban, "phone": _phone,
    "address": _address, "date": _date, "social": _social, "card": _card,
}


def pseudonym(key: str, kinds: list[str]) -> str:
    """SQL of the pseudonym of a match `m`, which is `named` if it was found as a secret; a value
    that fails its validation is its own, or else what it is as a secret."""
    # A match is of the first kind whose whole pattern it has, but secrets may look like all.
    cases = " ".join(f"WHEN {_is('m', k)} THEN {_MAKERS[k](key)}" for k in kinds if k != "secret")
    tried = [f"CASE {cases} END"] if cases else []
    if "secret" in kinds:
        tried.append(f"if(named AND {_is('m', 'secret')}, {_MAKERS['secret'](key)}, NULL)")
    return f"coalesce({', '.join([*tried, 'm'])})"


def pseudonymised(text: str, key: str, kinds: list[str] | None = None) -> Column:
    """The text of a column with pseudonyms in place of personal data; null stays null."""
    kinds = [k for k in KINDS if k in (kinds or KINDS)]
    pattern, column = quote(_pattern(kinds)), name(text)
    joined = (
        "array_join(transform(between, (b, i) -> concat(b, coalesce(get(new, i), ''))), '')"
    )
    # The group of the secrets is empty in the matches of other kinds.
    secrets = "array()"
    if "secret" in kinds:
        group = 1 + _groups(kinds[: kinds.index("secret")])
        secrets = f"regexp_extract_all({column}, {pattern}, {group})"
    each = let("named", "coalesce(get(secrets, i) <> '', false)", pseudonym(key, kinds))
    new = let("secrets", secrets, f"transform(found, (m, i) -> {each})")
    changed = let(
        "found",
        f"regexp_extract_all({column}, {pattern}, 0)",
        f"if(size(found) = 0, {column}, "
        + let("between", f"split({column}, {pattern}, -1)", let("new", new, joined))
        + ")",
    )
    return F.expr(f"CASE WHEN {column} RLIKE {quote(HINT)} THEN {changed} ELSE {column} END")


def with_pseudonyms(
    docs: DataFrame, key: str = KEY, text_col: str = "text", kinds: list[str] | None = None
) -> DataFrame:
    """`docs` with the text replaced and every other column as it was.

    Null and empty texts stay; a value that occurs again, in whatever document, gets the same
    pseudonym. One pass without a shuffle; a text is worked on as a whole, in its row, however long.
    Ids are not looked at, so they may repeat; an empty table stays empty.
    """
    return docs.withColumn(text_col, pseudonymised(text_col, key, kinds))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(doc_id, text, n_values)` with the number of values found, valid or not."""
    docs = two_columns(documents(spark, sf_dir), "doc_id", "text")
    count = F.when(F.col("text").rlike(HINT), F.regexp_count("text", F.lit(_pattern(KINDS)))).otherwise(0)
    return docs.select(
        "doc_id", pseudonymised("text", KEY).alias("text"), F.coalesce(count, F.lit(0)).cast("long").alias("n_values")
    )


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms in their texts."""
    return with_pseudonyms(docs)
