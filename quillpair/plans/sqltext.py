"""DuckDB spellings of the column functions in ``functions.text``.

Used only to build the oracle SQL that the driver runs next to the Spark
queries. The regex constants are shared with the Spark side, so both
engines see the same patterns.
"""

from __future__ import annotations

from .. import resources as R
from ..functions import stem as STEM
from ..functions import text as T


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def rep(java_replacement: str) -> str:
    """Java ``$n`` group references to RE2 ``\\n``."""
    return java_replacement.replace("$", "\\")


def ws_tokens(e: str) -> str:
    return f"list_filter(regexp_split_to_array({e}, {q(T.WS)}), lambda x: x <> '')"


def word_count(e: str) -> str:
    return f"CAST(len({ws_tokens(e)}) AS BIGINT)"


def lower_collapse(e: str) -> str:
    return f"trim(regexp_replace(lower({e}), {q(T.WS)}, ' ', 'g'), ' ')"


def word_runs(e: str) -> str:
    return f"regexp_extract_all({e}, {q(T.WORD_RUN)})"


def question_words(e: str) -> str:
    words = ", ".join(q(w) for w in R.QUESTION_WORDS)
    return f"list_filter({word_runs(e)}, lambda x: x IN ({words}))"


def alpha_words(e: str) -> str:
    return f"list_filter({word_runs(e)}, lambda x: regexp_full_match(x, '[a-zA-Z]{{2,}}'))"


def anchored_phrases(e: str, anchor: str = "what", n_after: int = 3) -> str:
    body = " ".join([anchor] + [T.WORD_RUN] * n_after)
    pattern = f"(?:^|[^\\p{{L}}\\p{{N}}_])({body})"
    return f"regexp_extract_all({e}, {q(pattern)}, 1)"


def contraction_map() -> str:
    items = ", ".join(f"{q(k)}: {q(v)}" for k, v in R.CONTRACTIONS.items())
    return f"MAP {{{items}}}"


def expand_contractions(e: str) -> str:
    m = f"({contraction_map()})"

    def cased(x: str) -> str:
        key = f"{m}[lower(replace({x}, '’', ''''))]"
        return (f"CASE WHEN {key} IS NULL THEN NULL WHEN {x} = upper({x}) AND length({x}) > 1 AND {x} <> lower({x}) "
                f"THEN upper({key}) WHEN regexp_matches({x}, '^[^A-Za-z]*[A-Z]') "
                f"THEN upper(substr({key}, 1, 1)) || substr({key}, 2) ELSE {key} END")

    inner = "substr(x, 2)"
    fix = (f"lambda x: coalesce({cased('x')}, CASE WHEN regexp_matches(x, '^[''’].') THEN substr(x, 1, 1) || "
           f"coalesce({cased(inner)}, {inner}) END, x)")
    pieces = f"regexp_extract_all({e}, {q(T.CONTRACTION_PIECE)}, 1)"
    return f"array_to_string(list_transform({pieces}, {fix}), '')"


def normalise_text(e: str) -> str:
    x = f"replace({e}, ' ''', '''')"
    x = expand_contractions(x)
    x = f"regexp_replace({x}, {q(T.NON_ASCII)}, '', 'g')"
    x = f"regexp_replace({x}, {q(T.URL)}, '', 'g')"
    x = f"regexp_replace({x}, {q(T.HTML)}, '', 'g')"
    return f"lower({x})"


def sentences(e: str) -> str:
    return f"regexp_extract_all({e}, {q(T.SENTENCE)})"


def rouge_tokens(e: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({e}), {q(T.ROUGE_SPLIT)}), lambda x: x <> '')"


def treebank_tokens(e: str, one_sentence: bool = False) -> str:
    x = f"lower({e})"
    for pat, r in T.TREEBANK_SENTENCE_RULES if one_sentence else T.TREEBANK_RULES:
        x = f"regexp_replace({x}, {q(pat)}, {q(rep(r))}, 'g')"
    x = f"(' ' || {x} || ' ')"
    for pat, r in T.TREEBANK_PADDED_RULES:
        x = f"regexp_replace({x}, {q(pat)}, {q(rep(r))}, 'g')"
    return ws_tokens(x)


def stop_words_list() -> str:
    return ", ".join(q(w) for w in sorted(set(R.STOP_WORDS)))


def top_terms(base_sql: str, row_col: str, terms_expr: str, term_name: str = "term",
              k: int = R.TOP_K, exclude: str | None = None) -> str:
    """Top-k terms with first-seen tie order, as a SQL block."""
    where = f"WHERE t NOT IN ({exclude})" if exclude else ""
    return f"""
    (WITH b AS (SELECT {row_col} AS r_, {terms_expr} AS ts FROM ({base_sql})),
     e AS (SELECT r_, unnest(ts) AS t, unnest(range(1, len(ts) + 1)) AS p_ FROM b),
     c AS (SELECT t, count(*) AS n, min(r_) AS fr, arg_min(p_, r_ * 1000000000 + p_) AS fp,
                  min(r_ * 1000000000 + p_) AS f_ FROM e {where} GROUP BY t),
     top AS (SELECT * FROM c ORDER BY n DESC, f_ LIMIT {k})
     SELECT CAST(row_number() OVER (ORDER BY n DESC, f_) AS BIGINT) AS rank, t AS {term_name},
            n, round(100.0 * n / sum(n) OVER (), 6) AS share_pct FROM top)
    """


# ---------------------------------------------------------------- Porter stems, one sub-query per step

def _shape(w: str) -> str:
    plain = f"regexp_replace(regexp_replace({w}, '[^aeiouy]', '1', 'g'), '[aeiou]', '0', 'g')"
    return (f"list_reduce(list_concat([''], string_split({plain}, '')), lambda d, c: d || CASE WHEN c <> 'y' THEN c "
            f"WHEN d = '' OR ends_with(d, '0') THEN '1' ELSE '0' END)")


def _cases(rules: list[tuple[str, str, str]]) -> str:
    """First suffix that fits decides; a condition reads the stem as s and its shape as fs."""
    arms = []
    for suffix, new, cond in rules:
        cut = f"length(w) - {len(suffix)}"
        test = cond.replace("{s}", f"left(w, {cut})").replace("{fs}", f"left(f, {cut})")
        arms.append(f"WHEN ends_with(w, {q(suffix)}) THEN CASE WHEN {test} THEN left(w, {cut}) || {q(new)} ELSE w END")
    return "CASE " + " ".join(arms) + " ELSE w END"


_ONE, _TWO = "contains({fs}, '01')", "regexp_matches({fs}, '01.*01')"


def _short(s: str, fs: str) -> str:
    return f"((ends_with({fs}, '101') AND NOT regexp_matches({s}, '[wxy]$')) OR {fs} = '01')"


def _stem_steps() -> list[str]:
    bare, fb = "left(w, length(w) - 1)", "left(f, length(w) - 1)"
    once = f"contains({fb}, '01') AND NOT regexp_matches({fb}, '01.*01')"
    repair = (f"CASE WHEN NOT ends_with(w, chr(1)) THEN w WHEN regexp_matches({bare}, '(at|bl|iz)$') THEN {bare} || 'e' "
              f"WHEN right({bare}, 1) = left(right({bare}, 2), 1) AND length({bare}) > 1 AND ends_with({fb}, '1') THEN "
              f"CASE WHEN regexp_matches({bare}, '[lsz]$') THEN {bare} ELSE left(w, length(w) - 2) END "
              f"WHEN {once} AND {_short(bare, fb)} THEN {bare} || 'e' ELSE {bare} END")
    past = ("CASE WHEN ends_with(w, 'ied') THEN left(w, length(w) - 3) || CASE WHEN length(w) = 4 THEN 'ie' ELSE 'i' END "
            "WHEN ends_with(w, 'eed') THEN CASE WHEN contains(left(f, length(w) - 3), '01') THEN left(w, length(w) - 1) "
            "ELSE w END WHEN ends_with(w, 'ed') AND contains(left(f, length(w) - 2), '0') THEN left(w, length(w) - 2) || chr(1) "
            "WHEN ends_with(w, 'ing') AND contains(left(f, length(w) - 3), '0') THEN left(w, length(w) - 3) || chr(1) ELSE w END")
    plural = ("CASE WHEN length(w) = 4 AND ends_with(w, 'ies') THEN left(w, 1) || 'ie' ELSE "
              + _cases([("sses", "ss", "true"), ("ies", "i", "true"), ("ss", "ss", "true"), ("s", "", "true")]) + " END")
    logi = "contains(left(f, length(w) - 3), '01')"
    final_e = f"({_TWO} OR ({_ONE} AND NOT {_short('{s}', '{fs}')}))"
    return [
        plural, past, repair, _cases([("y", "i", "length({s}) > 1 AND ends_with({fs}, '1')")]),
        _cases([("alli", "al", _ONE)]),
        _cases([(s, r, logi if s == "logi" else _ONE) for s, r in STEM.STEP_2.items()]),
        _cases([(s, r, _ONE) for s, r in STEM.STEP_3.items()]),
        _cases([(s, "", f"{_TWO} AND regexp_matches({{s}}, '[st]$')" if s == "ion" else _TWO) for s in STEM.STEP_4]),
        _cases([("e", "", final_e)]),
        f"CASE WHEN ends_with(w, 'll') AND regexp_matches({fb}, '01.*01') THEN {bare} ELSE w END",
    ]


def stem_ctes(name: str, tokens_sql: str) -> list[tuple[str, str]]:
    """CTEs ending in ``name`` (t, stem) for the distinct tokens t of a query."""
    ctes = [(f"{name}_0", f"SELECT t, lower(t) AS w FROM ({tokens_sql})")]
    for i, step in enumerate(_stem_steps()):
        ctes.append((f"{name}_{i + 1}", f"SELECT t, {step} AS w FROM (SELECT t, w, {_shape('w')} AS f FROM {name}_{i})"))
    irregular = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in STEM.IRREGULAR.items())
    ctes.append((name, f"SELECT t, CASE lower(t) {irregular} ELSE CASE WHEN length(t) <= 2 THEN lower(t) ELSE w END END "
                       f"AS stem FROM {name}_{len(_stem_steps())}"))
    return ctes
