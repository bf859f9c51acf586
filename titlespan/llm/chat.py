"""Conversations as training strings: sorted turns, merged blocks, a loss mask, and the way back.

A conversation is `<s>` and its blocks. A block holds neighbouring turns of one role:

    user        [INST] text [/INST]
    system      [SYS] text [/SYS]
    assistant   ␠text</s>
    any other   [ROLE] role[SAYS] text [/ROLE]

Turns merged into one block are divided by `[NEXT]`. A control string inside a text or a role
gets a backslash after its first letter; one that already has backslashes there gets one more, so
that taking one away restores every text. Only Spark expressions are used, and each is linear in
the conversation (offsets: its turns to the power 1.5).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titlespan.functions.sql import let
from titlespan.llm.common import quoted_name, table

#: Role and marks of the blocks without a written role.
BLOCKS = {"user": ("[INST] ", " [/INST]"), "system": ("[SYS] ", " [/SYS]"), "assistant": (" ", "</s>")}
BEGIN, OTHER, SAYS, OTHER_END, NEXT = "<s>", "[ROLE] ", "[SAYS] ", " [/ROLE]", "[NEXT]"
#: The role whose texts are trained on.
TRAINED = "assistant"

_NAMES = "/?(?:INST|SYS|ROLE|SAYS|NEXT)"
_ESCAPE = rf"(<(?=\\*/?s>)|\[(?=\\*{_NAMES}\]))"
_UNESCAPE = rf"(<(?=\\+/?s>)|\[(?=\\+{_NAMES}\]))\\"
#: Where a block ends.
_ENDS = r"(?<=</s>|\[/INST\]|\[/SYS\]|\[/ROLE\])"


def _raw(text: str) -> str:
    return 'r"' + text + '"'


def escaped(text: str) -> str:
    return f"regexp_replace({text}, {_raw(_ESCAPE)}, r'$1\\\\')"


def unescaped(text: str) -> str:
    return f"regexp_replace({text}, {_raw(_UNESCAPE)}, '$1')"


def running_sums(values: str) -> str:
    """The sum of the values before each one; in parts of the root of their number, because a fold
    that grows an array copies it at every step."""
    before = (
        "slice(aggregate({0}, array(0L), (sums, v) -> "
        "concat(sums, array(element_at(sums, -1) + v))), 1, size({0}))"
    )
    total = "aggregate({0}, 0L, (sum, v) -> sum + v)"
    parts = "transform(sequence(0, step - 1), p -> slice(vs, p * step + 1, step))"
    body = let(
        "cut",
        f"filter({parts}, p -> size(p) > 0)",
        let(
            "offsets",
            before.format(f"transform(cut, c -> {total.format('c')})"),
            f"flatten(transform(cut, (c, k) -> transform({before.format('c')}, s -> s + get(offsets, k))))",
        ),
    )
    step = "greatest(CAST(ceil(sqrt(size(vs))) AS INT), 1)"
    return let("vs", values, let("step", step, body))


def _marks(which: int) -> str:
    cases = " ".join(f"WHEN {role!r} THEN {marks[which]!r}" for role, marks in BLOCKS.items())
    other = f"concat('{OTHER}', {escaped('b.role')}, '{SAYS}')" if which == 0 else f"'{OTHER_END}'"
    return f"CASE b.role {cases} ELSE {other} END"


def formatted(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """`(conv_id, formatted, loss)`, one row per conversation.

    `loss` lists the trained stretches of `formatted`, one for each turn of the assistant, as
    `(start, length)` in code points and `(byte_start, byte_length)` in UTF-8, all from 0. Turns
    come in the order of turn, role and text, so that equal turn numbers have a defined order;
    turns without a number come first. A null text is empty, a null role is an empty one, rows
    without a conversation id are one conversation, repeated rows are repeated turns. No rows,
    no conversations; other columns, whatever their names, are left behind.

    A conversation is one row of the result, so its turns meet in one task, as their text does in
    any form that is one string; conversations are dealt out by their id.
    """
    rows = turns.select(
        quoted_name(conv_col).alias("conv_id"),
        F.struct(
            quoted_name(turn_col).alias("turn"),
            F.coalesce(quoted_name(role_col).cast("string"), F.lit("")).alias("role"),
            F.coalesce(quoted_name(text_col).cast("string"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    collected = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    heads = "filter(transform(ts, (t, i) -> if(i = 0 OR t.role <> get(ts, i - 1).role, i, NULL)), i -> i IS NOT NULL)"
    blocks = let(
        "ts",
        "turns",
        let(
            "heads",
            heads,
            """transform(heads, (at, k) -> struct(get(ts, at).role AS role,
                 slice(ts, at + 1, coalesce(get(heads, k + 1), size(ts)) - at) AS members))""",
        ),
    )
    # What stands between texts belongs to the piece before them: its mark, or the divider.
    pieces = f"""flatten(transform(blocks, b -> concat(
        transform(b.members, (t, i) -> struct(
            if(i = 0, {_marks(0)}, '{NEXT}') AS mark, {escaped('t.text')} AS body, b.role = '{TRAINED}' AS trained)),
        array(struct({_marks(1)} AS mark, '' AS body, false AS trained)))))"""
    cut = collected.select("conv_id", F.expr(f"{blocks} AS blocks")).select(
        "conv_id", F.expr(f"{pieces} AS pieces")
    )
    begin = len(BEGIN)
    chars = running_sums("transform(pieces, p -> CAST(length(p.mark) + length(p.body) AS BIGINT))")
    octets = running_sums("transform(pieces, p -> CAST(octet_length(p.mark) + octet_length(p.body) AS BIGINT))")
    spans = let(
        "chars",
        chars,
        let(
            "octets",
            octets,
            f"""filter(transform(pieces, (p, i) -> struct(
                {begin} + get(chars, i) + length(p.mark) AS start,
                CAST(length(p.body) AS BIGINT) AS length,
                {begin} + get(octets, i) + octet_length(p.mark) AS byte_start,
                CAST(octet_length(p.body) AS BIGINT) AS byte_length,
                p.trained AS trained)), s -> s.trained)""",
        ),
    )
    return cut.select(
        "conv_id",
        F.expr(f"concat('{BEGIN}', array_join(transform(pieces, p -> concat(p.mark, p.body)), '')) AS formatted"),
        F.expr(f"transform({spans}, s -> struct(s.start, s.length, s.byte_start, s.byte_length)) AS loss"),
    )


def read_turns(text: str = "formatted") -> str:
    """The turns `(role, text)` of a formatted conversation, in order, from its string alone."""
    blocks = f"filter(split(substr({text}, {len(BEGIN) + 1}), {_raw(_ENDS)}, -1), b -> b <> '')"

    def inner(opening: int, mark: tuple[str, str]) -> str:
        return f"substr(b, {opening + 1}, length(b) - {opening + len(mark[1])})"

    def named(role: str, mark: tuple[str, str]) -> str:
        return f"struct('{role}' AS role, {inner(len(mark[0]), mark)} AS body)"

    user, system, assistant = (BLOCKS[r] for r in ("user", "system", "assistant"))
    role = f"substr(b, {len(OTHER) + 1}, instr(b, '{SAYS}') - {len(OTHER) + 1})"
    body = (
        f"substr(b, instr(b, '{SAYS}') + {len(SAYS)}, "
        f"length(b) - instr(b, '{SAYS}') - {len(SAYS) + len(OTHER_END) - 1})"
    )
    parsed = f"""transform({blocks}, b -> CASE
        WHEN startswith(b, '{user[0]}') THEN {named("user", user)}
        WHEN startswith(b, '{system[0]}') THEN {named("system", system)}
        WHEN startswith(b, '{OTHER}') THEN struct({unescaped(role)} AS role, {body} AS body)
        ELSE {named("assistant", assistant)} END)"""
    turn = f"t -> struct(b.role AS role, {unescaped('t')} AS text)"
    return f"flatten(transform({parsed}, b -> transform(split(b.body, r'\\[NEXT\\]', -1), {turn})))"


def read_loss(text: str = "formatted", loss: str = "loss") -> str:
    """The texts under the loss mask, with their control strings as they were."""
    piece = "decode(substring(octets, CAST(s.byte_start AS INT) + 1, CAST(s.byte_length AS INT)), 'UTF-8')"
    return let("octets", f"CAST({text} AS BINARY)", f"transform({loss}, s -> {unescaped(piece)})")


def digests(conversations: DataFrame) -> DataFrame:
    """What `formatted` holds, read back from its strings and masks:
    `(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)`."""
    read = conversations.select(
        "conv_id",
        F.expr(f"{read_turns()} AS turns"),
        F.expr(f"array_join({read_loss()}, '') AS trained"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    lines = "array_join(transform(turns, t -> concat(t.role, '\\n', t.text, '\\n')), '')"
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.expr(f"sha2(CAST({lines} AS BINARY), 256) AS turns_sha256"),
        F.length("trained").cast("long").alias("loss_chars"),
        F.expr("sha2(CAST(trained AS BINARY), 256) AS loss_sha256"),
        "formatted_chars",
    )


#: The text of conversation -1: control strings of the template itself.
MARKED = "</s>[INST] ok [/INST]"


def op11_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(MARKED).alias("text"),
    )
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return digests(formatted(given.unionByName(own)))


#: The same rows by SQL; marks and escapes are counted instead of written.
OP11_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), m AS (
  SELECT *,
    lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) IS DISTINCT FROM role AS opens,
    len(regexp_extract_all(text, '<\\*/?s>|\[\\*/?(INST|SYS|ROLE|SAYS|NEXT)\]')) AS escapes,
    len(regexp_extract_all(role, '<\\*/?s>|\[\\*/?(INST|SYS|ROLE|SAYS|NEXT)\]')) AS role_escapes
  FROM t
)
SELECT conv_id,
  count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(3 + sum(length(text) + escapes + CASE
    WHEN NOT opens THEN 6
    WHEN role = 'user' THEN 15
    WHEN role = 'system' THEN 13
    WHEN role = 'assistant' THEN 5
    ELSE 22 + length(role) + role_escapes END) AS BIGINT) AS formatted_chars
FROM m GROUP BY conv_id
"""
