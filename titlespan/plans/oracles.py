"""DuckDB SQL with the same results as the registered queries.

The SQL follows another route than the Spark code: spans come from windows and islands
over one row per token, set comparisons from joins.
"""

from __future__ import annotations

from titlespan.functions.tags import UPPER_PATTERN, type_pattern
from titlespan.functions.tokens import ABBREVIATIONS, AUTOMOTIVE_TERMS
from titlespan.operators.metrics import BLANK_COLUMN, SUMMARY_METRICS
from titlespan.plans.inputs import UNKNOWN_TYPE
from titlespan.types import ENTITY_TYPES, SUBMISSION_COLUMNS, labels

# RE2's \s covers ASCII only.
_SPACE = (
    r"[\s\x0b\x1c-\x1f\x{0085}\x{00a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _in(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _types_table() -> str:
    rows = ", ".join(f"({i}, '{t}')" for i, t in enumerate(ENTITY_TYPES))
    return f"types(type_no, type) AS (VALUES {rows})"


DOCUMENTS = "SELECT doc_id AS record_id, text AS title FROM documents"
CONVERSATIONS = "SELECT conv_id * 1000 + turn AS record_id, text AS title FROM conversations"
LISTINGS = (
    "SELECT p_partkey AS record_id, concat_ws(' ', p_name, p_brand, p_type) AS title FROM part"
)


def _tokens(source: str = DOCUMENTS) -> str:
    """CTEs recs(record_id, toks) and tok(record_id, pos, token)."""
    return f"""recs AS (
  SELECT record_id, list_filter(string_split_regex(title, '{_SPACE}+'), lambda x: x <> '') AS toks
  FROM ({source})
), tok AS (
  SELECT record_id, (generate_subscripts(toks, 1) - 1)::INTEGER AS pos, unnest(toks) AS token
  FROM recs
)"""


def _tag(step: str, type_name: str) -> str:
    return (
        f"CASE WHEN {step} <= 2 THEN 'O' WHEN {step} <= 4 THEN 'B-' || {type_name} "
        f"WHEN {step} <= 7 THEN 'I-' || {type_name} WHEN {step} = 8 THEN '' ELSE 'bad' END"
    )


def _type(types: list[str] = ENTITY_TYPES) -> str:
    return f"({_list(types)})[(record_id + pos // 4) % {len(types)} + 1]"


def _tagged(source: str = DOCUMENTS) -> str:
    """CTE ev(record_id, pos, token, true_tag, pred_tag)."""
    return f"""{_tokens(source)}, stepped AS (
  SELECT *, {_type()} AS ty,
    (record_id * 7 + pos * 13 + length(token) * 5) % 10 AS m,
    (record_id * 3 + pos * 5 + length(token)) % 7 = 0 AS moved
  FROM tok
), ev AS (
  SELECT record_id, pos, token, {_tag('m', 'ty')} AS true_tag,
    CASE WHEN moved THEN {_tag('((m + 1) % 10)', 'ty')} ELSE {_tag('m', 'ty')} END AS pred_tag
  FROM stepped
)"""


def _spans(name: str, source: str, tag: str, mode: str, ref: str | None = None) -> str:
    """CTE `name`(record_id, type, start_pos, end_pos, text) over `source`, of any type."""
    if mode == "strict":
        effective, seen = tag, "nullif(e, '')"
    else:
        if mode == "lenient":
            effective = f"CASE WHEN {tag} = '' THEN 'O' ELSE {tag} END"
        else:
            effective = f"CASE WHEN {ref} = '' THEN '' WHEN {tag} = '' THEN 'skip' ELSE {tag} END"
        seen = "CASE WHEN e = 'O' OR e LIKE 'B-%' OR e LIKE 'I-%' THEN e END"
    before = "PARTITION BY record_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING"
    return f"""{name}_e AS (
  SELECT record_id, pos, token, {effective} AS e FROM {source}
), {name}_p AS (
  SELECT *, last_value({seen} IGNORE NULLS) OVER ({before} AND 1 PRECEDING) AS pn FROM {name}_e
), {name}_o AS (
  SELECT *, CASE WHEN pn LIKE 'B-%' OR pn LIKE 'I-%' THEN substr(pn, 3) END AS open_ty
  FROM {name}_p
), {name}_m AS (
  SELECT *,
    e LIKE 'B-%' OR (e LIKE 'I-%' AND (open_ty IS NULL OR open_ty <> substr(e, 3))) AS starts,
    CASE WHEN e LIKE 'B-%' OR e LIKE 'I-%' THEN substr(e, 3) WHEN e = '' THEN open_ty END AS mtype
  FROM {name}_o
), {name}_i AS (
  SELECT *, sum(starts::INTEGER) OVER ({before} AND CURRENT ROW) AS island FROM {name}_m
), {name} AS (
  SELECT record_id, min(mtype) AS type, min(pos)::INTEGER AS start_pos, max(pos)::INTEGER AS end_pos,
    string_agg(token, ' ' ORDER BY pos) AS text
  FROM {name}_i WHERE mtype IS NOT NULL GROUP BY record_id, island
)"""


_SPAN_NO = (
    "(row_number() OVER (PARTITION BY record_id ORDER BY start_pos) - 1)::INTEGER AS span_no"
)


def _spans_query(tag: str, mode: str, ref: str | None = None, text: bool = True) -> str:
    texts = ", text" if text else ""
    return f"""WITH {_tagged()}, {_spans('s', 'ev', tag, mode, ref)}
SELECT record_id, {_SPAN_NO}, type, start_pos, end_pos{texts} FROM s"""


def _submission(ids: str, span_table: str) -> str:
    columns = ", ".join(
        f"coalesce(string_agg(text, '|' ORDER BY start_pos) FILTER (type = '{t}'), '') AS \"{t}\""
        for t in ENTITY_TYPES
    )
    return f"""SELECT r.record_id::VARCHAR AS id, {columns}
FROM {ids} r LEFT JOIN {span_table} s ON s.record_id = r.record_id GROUP BY r.record_id"""


_FAULTY = f"""{_tagged()}, faulty AS (
  SELECT record_id, pos, token,
    CASE WHEN record_id % 5 = 0 THEN
      replace(true_tag, '-{ENTITY_TYPES[-1]}', '-{UNKNOWN_TYPE}') ELSE true_tag END AS tag
  FROM ev
), sizes AS (
  SELECT record_id, len(toks) AS n_tokens,
    CASE WHEN record_id % 7 = 0 THEN greatest(len(toks) - 1, 0) ELSE len(toks) END AS n_tags
  FROM recs
), kept AS (
  SELECT f.* FROM faulty f JOIN sizes s ON s.record_id = f.record_id AND f.pos < s.n_tags
)"""


def _entity_rows(ids: str, span_table: str) -> str:
    return f"""SELECT r.record_id, t.type, count(s.text)::INTEGER AS n_entities,
  coalesce(string_agg(s.text, '|' ORDER BY s.start_pos), '') AS texts
FROM {ids} r CROSS JOIN types t
LEFT JOIN {span_table} s ON s.record_id = r.record_id AND s.type = t.type
GROUP BY r.record_id, t.type"""


_NULLS = {
    "record_id": "NULL::BIGINT",
    "pos": "NULL::INTEGER",
    "col": "NULL::VARCHAR",
    "detail": "NULL::VARCHAR",
}


def _violation(rule: str, source: str, n: str = "1", **values: str) -> str:
    columns = ", ".join(f"{values.get(c, null)} AS {c}" for c, null in _NULLS.items())
    return f"SELECT {rule} AS rule, {columns}, ({n})::BIGINT AS n FROM {source}"


_LENGTHS = _violation(
    "'length_mismatch'",
    "sizes WHERE n_tokens <> n_tags",
    record_id="record_id",
    detail="n_tokens || ' tokens, ' || n_tags || ' tags'",
)


def _alignment(pattern: str) -> str:
    bad = _violation("'bad_tag'", "bad", record_id="record_id", pos="pos", detail="tag")
    return f"""bad AS (
  SELECT k.record_id, k.pos, k.tag
  FROM kept k JOIN sizes s ON s.record_id = k.record_id AND s.n_tokens = s.n_tags
  WHERE NOT regexp_matches(k.tag, '{pattern}')
), misaligned AS ({bad} UNION ALL {_LENGTHS})"""


def _transitions(source: str, tag: str) -> str:
    before = "PARTITION BY record_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    known = f"{tag} IN ('', 'O') OR {tag} LIKE 'B-%' OR {tag} LIKE 'I-%'"
    found = _violation(
        "'bad_transition'",
        "seen WHERE t LIKE 'I-%' AND pn NOT IN ('', 'O') AND substr(pn, 3) <> substr(t, 3)",
        record_id="record_id",
        pos="pos",
        detail="t",
    )
    return f"""seen AS (
  SELECT record_id, pos, {tag} AS t,
    last_value(CASE WHEN {known} THEN {tag} END IGNORE NULLS) OVER ({before}) AS pn
  FROM {source}
), transitions AS ({found})"""


_DOUBTFUL = f"""{_tagged()}, {_spans('s', 'ev', 'true_tag', 'strict')}, used AS (
  SELECT record_id, unnest(string_split(text, ' ')) AS token,
    CASE WHEN record_id % 3 = 0 THEN 2 ELSE 1 END AS times FROM s
  UNION ALL
  SELECT record_id, unnest(['fremd§', record_id::VARCHAR]), 1 FROM recs WHERE record_id % 4 = 0
), u AS (
  SELECT record_id, token, sum(times) AS used FROM used GROUP BY ALL
), h AS (
  SELECT record_id, token, count(*) AS have FROM tok GROUP BY ALL
), usage AS (
  SELECT u.record_id, u.token, u.used, coalesce(h.have, 0) AS have
  FROM u LEFT JOIN h ON h.record_id = u.record_id AND h.token = u.token
)"""


def _quality(table: str, texts: list[str], others: list[str]) -> str:
    order = [*texts, *others]
    names = ", ".join(f'"{c}"' for c in order)
    totals = f"""(SELECT count(*) FROM {table})::BIGINT AS total_records,
  {len(order)}::INTEGER AS total_columns,
  ((SELECT count(*) FROM {table}) - (SELECT count(*) FROM (SELECT DISTINCT {names} FROM {table})))::BIGINT
    AS duplicate_rows"""
    parts = [
        f"""SELECT '{c}' AS col, count(*) FILTER ({c} IS NULL) AS null_count,
  count(*) FILTER ({c} = '') AS empty_count, max(length({c}))::INTEGER AS max_length,
  coalesce(max(length({c})) > 1000, false) AS very_long, {totals} FROM {table}"""
        for c in texts
    ] + [
        f"""SELECT '{c}', count(*) FILTER ({c} IS NULL), 0::BIGINT, NULL::INTEGER, false, {totals}
FROM {table}"""
        for c in others
    ]
    return " UNION ALL ".join(parts)


# --- metrics -----------------------------------------------------------------------------

_F1 = "CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END"


def _scored(name: str, source: str) -> str:
    """CTE with p, r, f over (…, support, predicted, hits)."""
    return f"""{name}_pr AS (
  SELECT *, CASE WHEN predicted > 0 THEN hits / predicted ELSE 0 END AS p,
    CASE WHEN support > 0 THEN hits / support ELSE 0 END AS r FROM {source}
), {name} AS (SELECT *, {_F1} AS f FROM {name}_pr)"""


def _label_ctes() -> str:
    """CTE lab(fold, key, support, predicted, hits, p, r, f) over fev(fold, …)."""
    sides = """conf AS (
  SELECT fold, true_tag, pred_tag, count(*) AS n FROM fev GROUP BY ALL
), lab_s AS (
  SELECT fold, key, sum(support)::DOUBLE AS support, sum(predicted)::DOUBLE AS predicted,
    sum(hits)::DOUBLE AS hits
  FROM (
    SELECT fold, true_tag AS key, n AS support, 0 AS predicted,
      CASE WHEN true_tag = pred_tag THEN n ELSE 0 END AS hits FROM conf
    UNION ALL SELECT fold, pred_tag, 0, n, 0 FROM conf
  ) GROUP BY ALL
)"""
    return f"{sides}, {_scored('lab', 'lab_s')}"


def _type_ctes() -> str:
    """CTE typ(fold, key, …) of spans, lenient, of any type, over fev and folds_of."""
    true = _spans("lt", "ev", "true_tag", "lenient")
    pred = _spans("lp", "ev", "pred_tag", "lenient")
    return f"""{true}, {pred}, both_spans AS (
  SELECT coalesce(a.record_id, b.record_id) AS record_id, coalesce(a.type, b.type) AS key,
    (a.record_id IS NOT NULL)::INTEGER AS in_true, (b.record_id IS NOT NULL)::INTEGER AS in_pred
  FROM lt a FULL JOIN lp b ON a.record_id = b.record_id AND a.type = b.type
    AND a.start_pos = b.start_pos AND a.end_pos = b.end_pos
), typ_s AS (
  SELECT fold, key, sum(in_true)::DOUBLE AS support, sum(in_pred)::DOUBLE AS predicted,
    sum(in_true * in_pred)::DOUBLE AS hits
  FROM both_spans JOIN folds_of USING (record_id) GROUP BY ALL
), {_scored('typ', 'typ_s')}"""


def _match_ctes() -> str:
    """CTEs cmp(record_id, type, exact, partial) and rec(fold, record_id, exact, partial)."""
    true = _spans("xt", "ev", "true_tag", "strict")
    pred = _spans("xp", "ev", "pred_tag", "strict")
    return f"""{_types_table()}, {true}, {pred}, xts AS (
  SELECT record_id, type, list(DISTINCT text) AS a FROM xt GROUP BY ALL
), xps AS (
  SELECT record_id, type, list(DISTINCT text) AS b FROM xp GROUP BY ALL
), cmp_l AS (
  SELECT f.fold, f.record_id, t.type, list_sort(coalesce(a, [])) AS a, list_sort(coalesce(b, [])) AS b
  FROM folds_of f CROSS JOIN types t
  LEFT JOIN xts ON xts.record_id = f.record_id AND xts.type = t.type
  LEFT JOIN xps ON xps.record_id = f.record_id AND xps.type = t.type
), cmp AS (
  SELECT fold, record_id, type, a = b AS exact, a <> b AND list_has_any(a, b) AS partial FROM cmp_l
), rec AS (
  SELECT fold, record_id, bool_and(exact OR partial) AS exact, bool_or(partial) AS partial
  FROM cmp GROUP BY ALL
)"""


_ONE_FOLD = """folds_of AS (SELECT 0 AS fold, record_id FROM recs),
fev AS (SELECT 0 AS fold, * FROM ev)"""


def _overall() -> str:
    """CTE overall(fold, metric, value)."""
    wide = """label_totals AS (
  SELECT fold, sum(p * support) / sum(support) AS token_precision,
    sum(r * support) / sum(support) AS token_recall, sum(f * support) / sum(support) AS token_f1,
    sum(hits) / sum(support) AS token_accuracy, sum(support) AS total_tokens
  FROM lab GROUP BY fold
), span_totals AS (
  SELECT fold, sum(support) AS support, sum(predicted) AS predicted, sum(hits) AS hits
  FROM typ GROUP BY fold
), """ + _scored("span_scores", "span_totals")
    record = """, record_totals AS (
  SELECT fold, count(*)::DOUBLE AS num_sequences, count(*) FILTER (exact) / count(*) AS exact_match_accuracy,
    count(*) FILTER (partial) / count(*) AS partial_match_accuracy
  FROM rec GROUP BY fold
)"""
    parts = [
        f"SELECT fold, '{m}' AS metric, {m} AS value FROM label_totals"
        for m in ("token_precision", "token_recall", "token_f1", "token_accuracy", "total_tokens")
    ]
    parts += [
        f"SELECT fold, 'entity_{m}', {c} FROM span_scores"
        for m, c in (("precision", "p"), ("recall", "r"), ("f1", "f"))
    ]
    parts += [
        f"SELECT fold, '{m}', {m} FROM record_totals"
        for m in ("num_sequences", "exact_match_accuracy", "partial_match_accuracy")
    ]
    return f"{wide}{record}, overall AS ({' UNION ALL '.join(parts)})"


def _metric_ctes(folds: str = _ONE_FOLD) -> str:
    return f"{folds}, {_label_ctes()}, {_type_ctes()}, {_match_ctes()}, {_overall()}"


def _metrics_long() -> str:
    """All rows (grain, key, metric, value), rounded."""
    parts = ["SELECT 'overall' AS grain, '' AS key, metric, value FROM overall"]
    for grain, source in (("label", "lab"), ("type", "typ")):
        parts += [
            f"SELECT '{grain}', key, '{m}', {c} FROM {source}"
            for m, c in (("precision", "p"), ("recall", "r"), ("f1", "f"), ("support", "support"))
        ]
    parts += [
        f"SELECT 'exact', type, '{m}', {e} FROM cmp GROUP BY type"
        for m, e in (
            ("exact_match_rate", "count(*) FILTER (exact) / count(*)"),
            ("partial_match_rate", "count(*) FILTER (partial) / count(*)"),
            ("total_examples", "count(*)"),
        )
    ]
    union = " UNION ALL ".join(parts)
    return f"SELECT grain, key, metric, round(value::DOUBLE, 6) AS value FROM ({union})"


_LABELS = f"{_tagged()}, {_ONE_FOLD}, {_label_ctes()}"
_SPANS_OF_TYPE = f"{_tagged()}, {_ONE_FOLD}, {_type_ctes()}"
_MATCHES = f"{_tagged()}, {_ONE_FOLD}, {_match_ctes()}"
_ERROR = (
    "CASE WHEN true_tag = 'O' THEN 'false_positive' WHEN pred_tag = 'O' THEN 'false_negative' "
    "ELSE 'misclassification' END"
)
_ERRORS = f"""{_tagged()}, err AS (
  SELECT *, {_ERROR} AS error_type FROM ev WHERE true_tag <> pred_tag
)"""

_GAPPY = """gt AS (
  SELECT record_id, pos, token, true_tag AS tag FROM ev WHERE record_id % 5 <> 0
), gp AS (
  SELECT record_id, pos, pred_tag AS tag
  FROM ev JOIN (SELECT record_id, len(toks) AS n FROM recs) USING (record_id)
  WHERE record_id % 7 <> 0 AND (record_id % 3 <> 0 OR pos < n - 1)
)"""


def _short(tag: str) -> str:
    return f"CASE WHEN contains({tag}, '-') THEN string_split({tag}, '-')[-1] ELSE 'O' END"


# --- tagger and folds --------------------------------------------------------------------


def _lexicon(source: str, name: str = "lex") -> str:
    return f"""{name}_c AS (
  SELECT token, tag, count(*) AS n FROM ({source}) GROUP BY ALL
), {name} AS (
  SELECT token, tag, n, sum(n) OVER (PARTITION BY token)::BIGINT AS total FROM {name}_c
  QUALIFY row_number() OVER (PARTITION BY token ORDER BY n DESC, tag) = 1
)"""


# Lexicon of the documents, tokens of the conversations.
_PREDICT = f"""{_tagged()}, {_lexicon('SELECT token, true_tag AS tag FROM ev')},
titles AS ({CONVERSATIONS}), ctok AS (
  SELECT record_id, (generate_subscripts(toks, 1) - 1)::INTEGER AS pos, unnest(toks) AS token
  FROM (SELECT record_id,
      list_filter(string_split_regex(title, '{_SPACE}+'), lambda x: x <> '') AS toks FROM titles)
), predicted AS (
  SELECT c.record_id, c.pos, c.token, coalesce(l.tag, 'O') AS tag, coalesce(l.n / l.total, 1) AS c
  FROM ctok c LEFT JOIN lex l ON l.token = c.token
)"""

_BINS = """lengths AS (SELECT record_id, len(toks)::INTEGER AS n_tokens FROM recs),
edges AS (
  SELECT DISTINCT round(unnest(quantile_cont(n_tokens, [0, 0.2, 0.4, 0.6, 0.8, 1])), 9) AS e
  FROM lengths
), bins AS (
  SELECT record_id, n_tokens,
    greatest((SELECT count(*) FROM edges WHERE e < n_tokens) - 1, 0)::INTEGER AS bin FROM lengths
), folded AS (
  SELECT record_id, bin, ((row_number() OVER (
      PARTITION BY bin ORDER BY md5(record_id::VARCHAR || '42'), record_id) - 1) % 5)::INTEGER AS fold
  FROM bins
)"""

_CV = f"""{_tokens()}, {_BINS}, given AS (
  SELECT record_id, pos, token, {_tag('m', 'ty')} AS true_tag
  FROM (SELECT *, {_type()} AS ty,
      (record_id * 7 + pos * 13 + length(token) * 5) % 10 AS m FROM tok)
), fold_counts AS (
  SELECT f.i AS fold, g.token, g.true_tag AS tag, count(*) AS n
  FROM given g JOIN folded USING (record_id) JOIN range(5) f(i) ON f.i <> folded.fold GROUP BY ALL
), fold_lexicon AS (
  SELECT fold, token, tag FROM fold_counts
  QUALIFY row_number() OVER (PARTITION BY fold, token ORDER BY n DESC, tag) = 1
), folds_of AS (SELECT fold, record_id FROM folded),
fev AS (
  SELECT f.fold, g.record_id, g.pos, g.token, g.true_tag, coalesce(l.tag, 'O') AS pred_tag
  FROM given g JOIN folded f USING (record_id)
  LEFT JOIN fold_lexicon l ON l.fold = f.fold AND l.token = g.token
), ev AS (SELECT record_id, pos, token, true_tag, pred_tag FROM fev)"""
_CV_METRICS = f"""WITH {_CV}, {_label_ctes()}, {_type_ctes()}, {_match_ctes()}, {_overall()}
SELECT fold, metric, value FROM overall WHERE metric IN {_in(SUMMARY_METRICS)}"""




_FEATURES = r"""length(token)::INTEGER AS length,
  regexp_matches(token, '^[\p{Nd}²³¹⁰⁴-⁹₀-₉①-⑨]+$') AS is_numeric,
  regexp_matches(token, '^[a-zA-Z0-9]+$') AS is_alphanumeric,
  regexp_matches(token, '[^a-zA-Z0-9]') AS has_special_chars,
  regexp_matches(token, '\p{Lu}') AND NOT regexp_matches(token, '[\p{Ll}\p{Lt}]') AS is_uppercase,
  regexp_matches(token, '\p{Ll}') AND NOT regexp_matches(token, '[\p{Lu}\p{Lt}]') AS is_lowercase,
  regexp_matches(token, '[\p{Lu}\p{Ll}\p{Lt}]')
    AND NOT regexp_matches(token, '[\p{Lu}\p{Ll}\p{Lt}][\p{Lu}\p{Lt}]')
    AND NOT regexp_matches(token, '(^|[^\p{Lu}\p{Ll}\p{Lt}])\p{Ll}') AS is_title_case,
  regexp_matches(token, '\p{Nd}') AS contains_digit"""
_DICTIONARY = f"""token IN {_in(ABBREVIATIONS)} AS is_abbreviation,
  lower(token) IN {_in(AUTOMOTIVE_TERMS)} AS is_common_automotive_term"""
_FIRST_LAST = """pos = 0 AS is_first,
  pos = max(pos) OVER (PARTITION BY record_id) AS is_last"""
_CONTEXT = """lag(token, 1, '<START>') OVER w AS prev_token,
  coalesce(lag(length(token)) OVER w, 0)::INTEGER AS prev_length,
  lead(token, 1, '<END>') OVER w AS next_token,
  coalesce(lead(length(token)) OVER w, 0)::INTEGER AS next_length"""
_W = "WINDOW w AS (PARTITION BY record_id ORDER BY pos)"


def oracles() -> dict[str, str]:
    words = [*ABBREVIATIONS, *AUTOMOTIVE_TERMS]
    term_listings = f"""SELECT p_partkey AS record_id, concat_ws(' ',
  CASE WHEN (p_partkey // 64) % 2 = 1 THEN upper(({_list(words)})[p_partkey % {len(words)} + 1])
  ELSE ({_list(words)})[p_partkey % {len(words)} + 1] END, p_name) AS title FROM part"""
    label_ids = " ".join(f"WHEN '{x}' THEN {i}" for i, x in enumerate(labels()))
    meta = "SELECT doc_id::VARCHAR AS id, quality, toxic FROM labels"
    submission = f"WITH {_tagged()}, {_spans('s', 'ev', 'true_tag', 'strict')} " + _submission(
        "recs", "s"
    )
    sub_bytes = " + ".join(f'octet_length(encode("{c}"))' for c in SUBMISSION_COLUMNS)
    header = len("\t".join(SUBMISSION_COLUMNS)) + 1
    one_space = r"^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
    stats = " UNION ALL ".join(
        f"""SELECT '{t}' AS type,
  count(*) FILTER (regexp_replace("{t}", '{one_space}', '', 'g') <> '') AS non_empty_count,
  count(*) FILTER (regexp_replace("{t}", '{one_space}', '', 'g') = '') AS empty_count,
  count(*) FILTER (contains("{t}", '|')) AS has_multiple_entities,
  count(*) AS total_records, {len(SUBMISSION_COLUMNS)}::INTEGER AS total_columns,
  (sum({sub_bytes} + {len(SUBMISSION_COLUMNS)}) + {header})::BIGINT AS size_bytes FROM sub"""
        for t in ENTITY_TYPES
    )
    got = ["id", "Hersteller", "Farbe", "Material", "Anzahl"]
    raw = """raw AS (SELECT doc_id::VARCHAR AS id, text AS "Hersteller", nullif(lang, 'de') AS "Farbe",
  source || chr(9) AS "Material", n_chars AS "Anzahl" FROM documents)"""
    bad_cells = []
    for c in got:
        text = f'"{c}"::VARCHAR'
        hits = {
            "tab": f"contains({text}, chr(9))",
            "line_break": f"contains({text}, chr(10)) OR contains({text}, chr(13))",
            "non_string": "true" if c == "Anzahl" else f'"{c}" IS NULL',
        }
        bad_cells += [
            _violation(
                f"'{rule}'", f"(SELECT count(*) AS k FROM raw WHERE {hit}) WHERE k > 0", "k", col=f"'{c}'"
            )
            for rule, hit in hits.items()
        ]
    mismatch = _violation(
        "'column_mismatch'",
        "(SELECT 1)",
        detail=f"'expected {','.join(SUBMISSION_COLUMNS)}; got {','.join(got)}'",
    )
    null_lang = "(SELECT count(*) AS k FROM documents WHERE lang = 'de' OR lang IS NULL) WHERE k > 0"
    input_parts = [
        _violation("'missing_column'", "(SELECT 1)", col="'title'"),
        _violation("'missing_column'", "(SELECT 1)", col="'EAN'"),
        _violation("'null_values'", null_lang, "k", col="'lang'"),
    ]
    all_labels = [*labels(), "", "bad"]
    pivot = ", ".join(
        f"coalesce(sum(n) FILTER (pred_tag = '{x}'), 0)::BIGINT AS \"{x or BLANK_COLUMN}\""
        for x in all_labels
    )
    error_matrix = f"""WITH {_ERRORS}
SELECT {_short('true_tag')} AS true_type, {_short('pred_tag')} AS pred_type, count(*) AS n
FROM err GROUP BY ALL"""
    type_cols = "p AS precision, r AS recall, f AS f1, support"
    rounded_scores = (
        "round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1"
    )
    averages = f"""SELECT key AS type, {type_cols} FROM typ
UNION ALL SELECT 'micro avg', p, r, f, support FROM span_scores
UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(support) FROM typ
UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
  sum(f * support) / sum(support), sum(support) FROM typ"""
    span_totals = """span_totals AS (
  SELECT sum(support) AS support, sum(predicted) AS predicted, sum(hits) AS hits FROM typ
), """ + _scored("span_scores", "span_totals")
    type_tags = f"""SELECT substr(key, 3) AS type, key AS tag, p AS precision, r AS recall, f AS f1,
  support::BIGINT AS support FROM lab WHERE regexp_matches(key, '^[BI]-')
  AND substr(key, 3) IN {_in(ENTITY_TYPES)}"""
    report_scores = (("precision", "p"), ("recall", "r"), ("f1", "f"), ("support", "support"))
    report = ", ".join(
        [
            f"round({prefix}.{c}, 6) AS {prefix}_{m}"
            for prefix in ("b", "i", "entity")
            for m, c in report_scores
        ]
    )
    stat_rows = [
        "SELECT 'total_texts' AS metric, (SELECT count(*) FROM recs)::DOUBLE AS value",
        "SELECT 'total_tokens', (SELECT count(*) FROM ev)::DOUBLE",
        "SELECT 'o_tag_count', (SELECT count(*) FROM ev WHERE pred_tag = 'O')::DOUBLE",
        "SELECT 'average_tokens_per_text', (SELECT count(*) FROM ev) / (SELECT count(*) FROM recs)",
        *[
            f"SELECT 'entity_count:{t}', (SELECT count(*) FROM ev "
            f"WHERE pred_tag IN ('B-{t}', 'I-{t}'))::DOUBLE"
            for t in ENTITY_TYPES
        ],
    ]
    samples = ", ".join(
        f"""CASE o_orderkey % 3 WHEN 0 THEN 'Sample{t}_' || o_orderkey
  WHEN 1 THEN 'Sample{t}_' || o_orderkey || '|Sample{t}_' || (o_orderkey + 1) ELSE '' END AS "{t}\""""
        for t in ENTITY_TYPES
    )
    per_type = f"""x AS (
  SELECT type, round(count(*) FILTER (exact) / count(*), 6) AS exact_match_rate,
    round(count(*) FILTER (partial) / count(*), 6) AS partial_match_rate,
    count(*)::DOUBLE AS total_examples FROM cmp GROUP BY type
) SELECT types.type_no::INTEGER AS type_no, types.type, {report},
  x.exact_match_rate, x.partial_match_rate, x.total_examples
FROM types LEFT JOIN lab b ON b.key = 'B-' || types.type LEFT JOIN lab i ON i.key = 'I-' || types.type
LEFT JOIN typ entity ON entity.key = types.type LEFT JOIN x ON x.type = types.type"""
    tagged_listings = f"""{_tokens(LISTINGS)}, given AS (
  SELECT record_id, pos, token, {_tag('m', 'ty')} AS true_tag
  FROM (SELECT *, {_type()} AS ty,
      (record_id * 7 + pos * 13 + length(token) * 5) % 10 AS m FROM tok)
)"""
    listing_model = f"""{tagged_listings}, {_lexicon('SELECT token, true_tag AS tag FROM given')}, ev AS (
  SELECT g.*, coalesce(l.tag, 'O') AS pred_tag FROM given g LEFT JOIN lex l ON l.token = g.token
)"""
    cv_folds = f"""WITH m AS ({_CV_METRICS})
SELECT fold::INTEGER AS fold, metric, round(value, 6) AS value FROM m"""
    train_tag = "CASE WHEN true_tag = 'bad' THEN 'O' ELSE true_tag END"

    return {
        "token_counts": f"WITH {_tokens()} SELECT record_id, len(toks)::INTEGER AS n_tokens FROM recs",
        "tokens_long": f"WITH {_tokens()} SELECT record_id, pos, token FROM tok",
        "token_features": f"""WITH {_tokens()}
SELECT record_id, pos, token, {_FIRST_LAST}, {_FEATURES}, {_DICTIONARY} FROM tok""",
        "token_context": f"WITH {_tokens()} SELECT record_id, pos, token, {_CONTEXT} FROM tok {_W}",
        "token_case": f"""WITH {_tokens()}, f AS (SELECT token, {_FEATURES} FROM tok)
SELECT token, is_uppercase, is_lowercase, is_title_case, count(*) AS n FROM f GROUP BY ALL""",
        "token_dictionary": f"""WITH {_tokens(term_listings)}
SELECT record_id, pos, token, {_DICTIONARY} FROM tok""",
        "training_rows": f"""WITH {_tagged(LISTINGS)}
SELECT record_id, {train_tag} AS tag, pos, token, {_FIRST_LAST}, {_FEATURES}, {_DICTIONARY}, {_CONTEXT}
FROM ev {_W}""",
        "label_encode": f"""WITH {_tagged()}, coded AS (
  SELECT record_id, pos, true_tag AS tag, (CASE true_tag {label_ids} END)::INTEGER AS label_id FROM ev
) SELECT *, CASE WHEN label_id IS NOT NULL THEN tag END AS label FROM coded""",
        "spans_strict": _spans_query("true_tag", "strict"),
        "spans_lenient": _spans_query("true_tag", "lenient"),
        "spans_reference": _spans_query("pred_tag", "reference", "true_tag"),
        "spans_long_form": f"""WITH {_tagged()}, {_spans('s', 'ev', 'true_tag', 'strict')}
SELECT record_id, type, start_pos, end_pos, text FROM s""",
        "tag_spans": _spans_query("true_tag", "lenient", text=False),
        "entities_wide": f"""WITH {_tagged()}, {_types_table()}, {_spans('s', 'ev', 'true_tag', 'strict')}
{_entity_rows('recs', 's')}""",
        "batch_reconstruct": f"""WITH {_FAULTY}, {_types_table()}, {_spans('s', 'kept', 'tag', 'strict')},
failed AS (
  SELECT record_id FROM sizes WHERE n_tokens <> n_tags
  UNION SELECT record_id FROM s WHERE type NOT IN {_in(ENTITY_TYPES)}
), sound AS (SELECT * FROM s WHERE record_id NOT IN (SELECT record_id FROM failed))
{_entity_rows('recs', 'sound')}""",
        "length_violations": f"WITH {_FAULTY} {_LENGTHS}",
        "input_violations": " UNION ALL ".join(input_parts),
        "bad_tags": f"WITH {_FAULTY}, {_alignment(type_pattern())} SELECT * FROM misaligned",
        "bad_tags_upper": f"WITH {_FAULTY}, {_alignment(UPPER_PATTERN)} SELECT * FROM misaligned",
        "bad_transitions": f"WITH {_tagged()}, {_transitions('ev', 'true_tag')} SELECT * FROM transitions",
        "token_overuse": f"WITH {_DOUBTFUL} "
        + _violation(
            "'token_overuse'",
            "usage WHERE used > have AND have > 0",
            "used - have",
            record_id="record_id",
            detail="token",
        ),
        "unknown_tokens": f"WITH {_DOUBTFUL} "
        + _violation(
            "'unknown_token'", "usage WHERE have = 0", "used", record_id="record_id", detail="token"
        ),
        "reconstruction_violations": f"WITH {_DOUBTFUL} "
        + _violation(
            "'token_overuse'",
            "usage WHERE used > have AND have > 0",
            "used - have",
            record_id="record_id",
            detail="token",
        )
        + " UNION ALL "
        + _violation(
            "'unknown_token'", "usage WHERE have = 0", "used", record_id="record_id", detail="token"
        ),
        "unknown_types": f"WITH {_FAULTY}, {_spans('s', 'kept', 'tag', 'strict')} "
        + _violation(
            "'unknown_type'",
            f"s WHERE type NOT IN {_in(ENTITY_TYPES)}",
            record_id="record_id",
            pos="start_pos",
            detail="type",
        ),
        "submission_violations": f"WITH {raw} " + " UNION ALL ".join([mismatch, *bad_cells]),
        "data_quality": _quality("documents", ["text", "lang", "source"], ["doc_id", "n_chars"]),
        "data_quality_lineitem": _quality(
            "lineitem",
            ["l_returnflag", "l_linestatus"],
            ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
             "l_extendedprice", "l_discount", "l_tax", "l_shipdate"],
        ),
        "validation_summary": f"""WITH {_FAULTY}, {_alignment(type_pattern())},
{_transitions('kept', 'tag')}, found AS (
  {_LENGTHS} UNION ALL SELECT * FROM misaligned UNION ALL SELECT * FROM transitions
) SELECT coalesce(rule, 'all') AS rule, count(*) AS violations, count(*) = 0 AS is_valid
FROM found GROUP BY ROLLUP (rule)""",
        "token_pairs": f"WITH {_tagged()} SELECT record_id, pos, token, true_tag, pred_tag FROM ev",
        "confusion_matrix": f"""WITH {_tagged()}
SELECT true_tag, pred_tag, count(*) AS n FROM ev GROUP BY ALL""",
        "confusion_pivot": f"""WITH {_tagged()}, conf AS (
  SELECT true_tag, pred_tag, count(*) AS n FROM ev GROUP BY ALL
) SELECT l.true_tag, {pivot} FROM (SELECT unnest({_list(all_labels)}) AS true_tag) l
LEFT JOIN conf ON conf.true_tag = l.true_tag GROUP BY l.true_tag""",
        "labels_seen": f"""WITH {_tagged()}
SELECT true_tag AS label FROM ev UNION SELECT pred_tag FROM ev""",
        "per_label_metrics": f"""WITH {_LABELS}
SELECT key AS label, hits::BIGINT AS true_positives, (predicted - hits)::BIGINT AS false_positives,
  (support - hits)::BIGINT AS false_negatives,
  (sum(support) OVER () - support - predicted + hits)::BIGINT AS true_negatives,
  round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1 FROM lab""",
        "token_metrics": f"""WITH {_LABELS}
SELECT round(sum(p * support) / sum(support), 6) AS token_precision,
  round(sum(r * support) / sum(support), 6) AS token_recall,
  round(sum(f * support) / sum(support), 6) AS token_f1,
  round(sum(hits) / sum(support), 6) AS token_accuracy, round(avg(p), 6) AS macro_precision,
  round(avg(r), 6) AS macro_recall, round(avg(f), 6) AS macro_f1, sum(support)::BIGINT AS support
FROM lab""",
        "type_token_metrics": f"""WITH {_LABELS}, t AS ({type_tags})
SELECT type, tag, {rounded_scores}, support FROM t""",
        "mean_f1_by_type": f"""WITH {_LABELS}, {_types_table()}, t AS ({type_tags})
SELECT type_no::INTEGER AS type_no, types.type, round(coalesce(avg(f1), 0.0), 6) AS mean_f1
FROM types LEFT JOIN t ON t.type = types.type GROUP BY ALL""",
        "entity_metrics": f"""WITH {_SPANS_OF_TYPE}, {span_totals}
SELECT support::BIGINT AS support, predicted::BIGINT AS predicted, hits::BIGINT AS hits,
  round(p, 6) AS entity_precision, round(r, 6) AS entity_recall, round(f, 6) AS entity_f1
FROM span_scores""",
        "type_entity_metrics": f"""WITH {_SPANS_OF_TYPE}, {span_totals}, a AS ({averages})
SELECT type, {rounded_scores}, support::BIGINT AS support FROM a""",
        "exact_match": f"""WITH {_MATCHES}
SELECT count(*) FILTER (exact) AS exact_matches, count(*) FILTER (partial) AS partial_matches,
  count(*) AS total_examples, round(count(*) FILTER (exact) / count(*), 6) AS exact_match_accuracy,
  round(count(*) FILTER (partial) / count(*), 6) AS partial_match_accuracy FROM rec""",
        "exact_match_by_type": f"""WITH {_MATCHES}
SELECT type, round(count(*) FILTER (exact) / count(*), 6) AS exact_match_rate,
  round(count(*) FILTER (partial) / count(*), 6) AS partial_match_rate, count(*) AS total_examples
FROM cmp GROUP BY type""",
        "metrics_long": f"WITH {_tagged()}, {_metric_ctes()} {_metrics_long()}",
        "metrics_summary": f"""WITH {_tagged()}, {_metric_ctes()}
SELECT metric, round(value, 6) AS value FROM overall WHERE metric IN {_in(SUMMARY_METRICS)}""",
        "evaluate_predictions": f"WITH {_tagged(CONVERSATIONS)}, {_metric_ctes()} {_metrics_long()}",
        "eval_from_wide": f"WITH {_tagged(LISTINGS)}, {_metric_ctes()} {_metrics_long()}",
        "per_type_report": f"WITH {_tagged()}, {_metric_ctes()}, {per_type}",
        "error_rows": f"""WITH {_ERRORS}
SELECT record_id, pos, token, true_tag, pred_tag, error_type FROM err""",
        "error_types": f"""WITH {_ERRORS}
SELECT coalesce(error_type, 'all') AS error_type, count(*) AS n FROM err GROUP BY ROLLUP (error_type)""",
        "confusion_pairs": f"""WITH {_ERRORS}
SELECT true_tag || ' -> ' || pred_tag AS pair, count(*) AS n FROM err GROUP BY ALL""",
        "error_distribution": f"""WITH {_ERRORS}
SELECT error_type, count(*) AS n,
  round(count(*) / (SELECT count(*) FROM err) * 100, 6) AS percentage FROM err GROUP BY error_type""",
        "top_confusions": f"""WITH {_ERRORS}
SELECT true_tag || ' -> ' || pred_tag AS pair, count(*) AS n,
  round(count(*) / (SELECT count(*) FROM err) * 100, 6) AS percentage
FROM err GROUP BY pair ORDER BY n DESC, pair LIMIT 10""",
        "error_examples": f"""WITH {_ERRORS}
SELECT record_id, pos, token, true_tag, pred_tag, error_type FROM err""",
        "entity_error_matrix": error_matrix,
        "entity_error_matrix_all": error_matrix,
        "submission_rows": submission,
        "submission_roundtrip": submission,
        "stream_submission": submission,
        "format_predictions": """SELECT p_partkey::VARCHAR AS id, coalesce(p_brand, '') AS "Hersteller",
  '' AS "Kompatible_Fahrzeug_Marke", '' AS "Kompatibles_Fahrzeug_Modell",
  replace(p_name, ' ', '|') AS "Produktart", '' AS "Herstellernummer", '' AS "EAN",
  coalesce(nullif(p_type, 'ECONOMY'), '') AS "Zustand", '' AS "Farbe", '' AS "Material",
  CASE WHEN p_size % 5 = 0 THEN '' ELSE (p_size % 5)::VARCHAR END AS "Anzahl",
  CASE WHEN p_size > 10 THEN p_type || '|' || p_brand ELSE '' END AS "OEM" FROM part""",
        "submission_stats": f"""WITH sub AS ({submission}), s AS ({stats})
SELECT *, round(size_bytes / (1024 * 1024), 6) AS size_mb FROM s""",
        "submission_with_meta": f"""WITH sub AS ({submission}), meta AS ({meta})
SELECT sub.*, meta.quality, meta.toxic FROM sub LEFT JOIN meta ON meta.id = sub.id""",
        "lexicon_fit": f"""WITH {_tagged()}, {_lexicon('SELECT token, true_tag AS tag FROM ev')}
SELECT token, tag, n, total, round(n / total, 6) AS confidence FROM lex""",
        "lexicon_predict": f"WITH {_PREDICT} SELECT record_id, pos, token, tag FROM predicted",
        "lexicon_confidence": f"""WITH {_PREDICT}
SELECT record_id, pos, token, round(c, 6) AS confidence FROM predicted""",
        "align_predictions": f"""WITH {_tagged()}
SELECT record_id, pos, token, CASE WHEN record_id % 2 = 0 OR pos < ceil(n / 2) THEN pred_tag
  ELSE 'O' END AS tag FROM ev JOIN (SELECT record_id, len(toks) AS n FROM recs) USING (record_id)""",
        "prediction_stats": f"""WITH {_tagged()}, s AS ({' UNION ALL '.join(stat_rows)})
SELECT metric, round(value, 6) AS value FROM s""",
        "evaluate_model": f"WITH {listing_model}, {_metric_ctes()} {_metrics_long()}",
        "evaluate_user_model": f"""WITH {tagged_listings}, ev AS (
  SELECT *, CASE WHEN regexp_matches(token, '^[0-9]+$') THEN 'B-Anzahl' ELSE 'O' END AS pred_tag FROM given
), {_metric_ctes()} {_metrics_long()}""",
        "predict_repeated_ids": f"""WITH {_PREDICT}
SELECT CASE WHEN t.record_id % 5 <> 0 THEN t.record_id % 3 END AS record_id,
  coalesce(string_agg(token, ' ' ORDER BY pos), '') AS tokens,
  coalesce(string_agg(tag, ' ' ORDER BY pos), '') AS pred_tags
FROM titles t LEFT JOIN predicted p ON p.record_id = t.record_id GROUP BY t.record_id""",
        "saved_model_info": f"""WITH {_tagged()}, {_lexicon('SELECT token, true_tag AS tag FROM ev')}
SELECT 'lexicon' AS model_class, {len(labels())}::INTEGER AS num_labels, true AS is_trained,
  count(*) AS n_entries FROM lex""",
        "train_job": f"""WITH {tagged_listings}, {_transitions('given', 'true_tag')}, found AS (
  SELECT 'bad_tag' AS rule FROM given WHERE NOT regexp_matches(true_tag, '{type_pattern()}')
  UNION ALL SELECT rule FROM transitions
) SELECT coalesce(rule, 'all') AS rule, count(*) AS violations, count(*) = 0 AS is_valid
FROM found GROUP BY ROLLUP (rule)""",
        "evaluate_job": f"WITH {listing_model}, {_metric_ctes()}, {per_type}",
        "predict_listings": f"""WITH {listing_model}, {_spans('s', 'ev', 'pred_tag', 'strict')}
{_submission('recs', 's')}""",
        "user_model_predict": f"""WITH {_tokens(CONVERSATIONS)}
SELECT record_id, pos, token,
  CASE WHEN regexp_matches(token, '^[0-9]+$') THEN 'B-Anzahl' ELSE 'O' END AS tag FROM tok""",
        "length_bins": f"WITH {_tokens()}, {_BINS} SELECT record_id, n_tokens, bin FROM bins",
        "stratified_folds": f"WITH {_tokens()}, {_BINS} SELECT record_id, bin, fold FROM folded",
        "cv_fold_metrics": cv_folds,
        "cv_user_model": cv_folds,
        "cv_summary": f"""WITH m AS ({_CV_METRICS})
SELECT metric, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std FROM m GROUP BY metric""",
        "tsv_roundtrip": r"""SELECT doc_id::VARCHAR AS id, regexp_replace(text, '[\r\n]+', ' ', 'g') AS title,
  'NA' AS "Farbe", '' AS "OEM" FROM documents""",
        "tsv_corrupt_rows": """SELECT p_partkey || chr(9) || p_name || chr(9) || p_brand || chr(9) || 'extra'
  AS line, 4 AS n_fields FROM part WHERE p_size > 40""",
        "tsv_fallback": "SELECT p_partkey::VARCHAR AS id, p_name AS name, p_brand AS brand FROM part",
        "tsv_messy": """SELECT p_partkey::VARCHAR AS id,
  CASE WHEN p_size % 7 = 0 THEN chr(34) ELSE '' END || p_name AS name, p_brand AS brand FROM part""",
        "tsv_surplus": """SELECT 'surplus_fields' AS rule, NULL::VARCHAR AS col,
  CASE WHEN p_partkey % 2 = 0 THEN p_partkey || chr(9) || name || chr(9) || p_brand
    ELSE p_brand || chr(9) || name || chr(9) || p_partkey END || chr(9) || 'extra' AS detail, 1::BIGINT AS n
FROM (SELECT *, CASE WHEN p_size % 7 = 0 THEN chr(34) ELSE '' END || p_name AS name FROM part)
WHERE p_size > 40""",
        "stream_messy": """SELECT p_partkey::VARCHAR AS id,
  CASE WHEN p_size % 7 = 0 THEN chr(34) ELSE '' END || p_name AS name, p_brand AS brand FROM part""",
        "stream_surplus": """SELECT 'surplus_fields' AS rule, NULL::VARCHAR AS col,
  p_partkey || chr(9) || CASE WHEN p_size % 7 = 0 THEN chr(34) ELSE '' END || p_name || chr(9) || p_brand
    || chr(9) || 'extra' AS detail, 1::BIGINT AS n FROM part WHERE p_size > 40""",
        "stream_quality": _quality("documents", ["text", "lang", "source"], []),
        "stream_versions": f"""WITH {_PREDICT}, {_spans('s', 'predicted', 'tag', 'strict')}
{_submission('titles', 's')}""",
        "pairs_with_gaps": f"""WITH {_tagged()}, {_GAPPY}
SELECT record_id, pos, t.token, t.tag AS true_tag, p.tag AS pred_tag FROM gt t FULL JOIN gp p USING (record_id, pos)""",
        "unpaired_tokens": f"""WITH {_tagged()}, {_GAPPY}, lacking AS (
  SELECT record_id, pos, CASE WHEN p.tag IS NULL THEN 'missing_prediction' ELSE 'missing_truth' END AS rule
  FROM gt t FULL JOIN gp p USING (record_id, pos) WHERE p.tag IS NULL OR t.tag IS NULL
) SELECT rule, record_id, min(pos)::INTEGER AS pos, count(*) AS n FROM lacking GROUP BY rule, record_id""",
        "pairing_violations": """SELECT CASE WHEN doc_id % 7 = 0 THEN 'missing_prediction'
    WHEN doc_id % 5 = 0 THEN 'missing_truth' ELSE 'repeated_record' END AS rule,
  doc_id AS record_id, (CASE WHEN doc_id % 7 <> 0 AND doc_id % 11 = 0 THEN 2 ELSE 1 END)::BIGINT AS n
FROM documents WHERE (doc_id % 5 = 0) <> (doc_id % 7 = 0) OR (doc_id % 11 = 0 AND doc_id % 7 <> 0)""",
        "paired_sequences": f"""WITH {_tokens()}, sizes AS (SELECT record_id, len(toks) AS n FROM recs)
SELECT record_id, CASE WHEN record_id % 5 <> 0 THEN n END::INTEGER AS n_tokens,
  CASE WHEN record_id % 5 <> 0 THEN n END::INTEGER AS n_true,
  CASE WHEN record_id % 7 <> 0 THEN CASE WHEN record_id % 3 = 0 THEN greatest(n - 1, 0) ELSE n END END::INTEGER AS n_pred
FROM sizes WHERE record_id % 5 <> 0 OR record_id % 7 <> 0""",
        "file_info": """SELECT sum(b)::BIGINT AS file_size_bytes, round(sum(b) / (1024 * 1024), 2) AS file_size_mb,
  false AS is_compressed, count(*) AS total_lines
FROM (SELECT octet_length(encode(p_partkey || chr(9) || p_name || chr(9) || p_brand)) + 1 AS b FROM part)""",
        "stream_titles": f"""WITH {_PREDICT}, {_spans('s', 'predicted', 'tag', 'strict')}
{_submission('titles', 's')}""",
        "stream_tag_counts": f"WITH {_tagged()} SELECT true_tag AS tag, count(*) AS n FROM ev GROUP BY true_tag",
        "sample_submission": f"SELECT o_orderkey::VARCHAR AS id, {samples} FROM orders",
        "predict_submission": f"""WITH {_PREDICT}, {_spans('s', 'predicted', 'tag', 'strict')}
{_submission('titles', 's')}""",
    }
