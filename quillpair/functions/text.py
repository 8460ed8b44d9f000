"""Column-level text functions (JVM-side, no Python in the hot path).

Regex classes are spelled so that Java (Spark) and RE2 agree with the
Python behaviour of the original scripts:

* ``WS`` is the set of characters ``str.split()`` breaks on.
* ``WORD`` is Python's Unicode ``\\w``; word boundaries are found as
  maximal runs of ``WORD`` instead of ``\\b`` (Java treats combining marks
  differently at ``\\b``).
* ``.`` is written ``[^\\n]`` (Java's ``.`` also stops at ``\\r``).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import resources as R

# --- FIXED VALUES: character classes ---
WS_CLASS = (r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
            r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
WS = f"[{WS_CLASS}]+"
NOT_WS = f"[^{WS_CLASS}]"
WORD = r"[\p{L}\p{N}_]"
WORD_RUN = WORD + "+"
ASCII_WS = r"\x09-\x0d\x1c-\x20"
NON_ASCII = r"[^\x00-\x7f]"
URL = rf"https?://[^{ASCII_WS}]+|www\.[^{ASCII_WS}]+"
HTML = r"<[^\n]*?>|&([a-z0-9]+|#[0-9]{1,6}|#x[0-9a-f]{1,6});"
CONTRACTION_PIECE = r"(['’]?[A-Za-z]+(?:['’][A-Za-z]+)*|[^A-Za-z'’]+|['’])"
SENTENCE = r"[^ .!?\n][^.!?\n]*[.!?]*"
ROUGE_SPLIT = r"[^a-z0-9]+"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ws_tokens(c: Column | str) -> Column:
    """``s.split()``: whitespace tokens, no empty strings."""
    return F.filter(F.split(_c(c), WS), lambda x: x != F.lit(""))


def word_count(c: Column | str) -> Column:
    """``len(s.split())`` as bigint (H9)."""
    return F.size(ws_tokens(c)).cast("bigint")


def lower_collapse(c: Column | str) -> Column:
    """``' '.join(s.lower().split())`` (H8)."""
    return F.trim(F.regexp_replace(F.lower(_c(c)), WS, " "))


def word_runs(c: Column | str) -> Column:
    """Maximal runs of word characters, in order."""
    return F.regexp_extract_all(_c(c), F.lit(WORD_RUN), F.lit(0))


def question_words(c: Column | str, words=R.QUESTION_WORDS) -> Column:
    """All whole-word question words, in order."""
    lit = F.array(*[F.lit(w) for w in words])
    return F.filter(word_runs(c), lambda x: F.array_contains(lit, x))


def alpha_words(c: Column | str) -> Column:
    """All ASCII words of 2+ letters bounded by non-word characters."""
    return F.filter(word_runs(c), lambda x: x.rlike("^[a-zA-Z]{2,}$"))


def anchored_phrases(c: Column | str, anchor: str = "what", n_after: int = 3) -> Column:
    """Non-overlapping ``anchor`` + n words phrases, left to right.

    The input is expected to be whitespace-collapsed (single spaces).
    """
    body = " ".join([anchor] + [WORD_RUN] * n_after)
    pattern = f"(?:^|[^\\p{{L}}\\p{{N}}_])({body})"
    return F.regexp_extract_all(_c(c), F.lit(pattern), F.lit(1))


def _contraction_map() -> Column:
    keys, vals = zip(*R.CONTRACTIONS.items())
    return F.map_from_arrays(F.array(*[F.lit(k) for k in keys]),
                             F.array(*[F.lit(v) for v in vals]))


def expand_contractions(c: Column | str) -> Column:
    """Dictionary expansion of English contractions, case-preserving (H2).

    The text is cut into letter words (with apostrophes) and the rest; each
    word is looked up lower-cased (curly apostrophe folded). A word with a
    leading apostrophe that is no key itself keeps the apostrophe and is
    looked up without it. An upper-case word gets an upper-case expansion, a
    capitalised word a capitalised one.
    """
    cmap = _contraction_map()

    def expansion(x: Column) -> Column:
        e = F.try_element_at(cmap, F.lower(F.replace(x, F.lit("’"), F.lit("'"))))
        first = F.regexp_extract(x, "[A-Za-z]", 0)
        return (
            F.when((x == F.upper(x)) & (F.length(x) > 1) & (x != F.lower(x)), F.upper(e))
            .when(first != F.lower(first),
                  F.concat(F.upper(F.substring(e, 1, 1)), F.substr(e, F.lit(2))))
            .otherwise(e)
        )

    def fix(x: Column) -> Column:
        inner = F.substr(x, F.lit(2))
        bare = F.when(x.rlike("^['’]."), F.concat(F.substring(x, 1, 1), F.coalesce(expansion(inner), inner)))
        return F.coalesce(expansion(x), bare, x)

    pieces = F.regexp_extract_all(_c(c), F.lit(CONTRACTION_PIECE), F.lit(1))
    # The pieces cover the whole text, so a text holding no key is returned
    # as it is; the guard skips the per-piece map lookups for such texts.
    return F.when(_c(c).rlike(_contraction_guard()), F.array_join(F.transform(pieces, fix), "")
                  ).otherwise(_c(c))


def _contraction_guard() -> str:
    """A pattern every text holding a contraction key matches: an apostrophe
    (straight or curly), or one of the keys written without one."""
    bare = sorted(k for k in R.CONTRACTIONS if "'" not in k and "’" not in k)
    return "(?i)['’]" + "".join(f"|{re.escape(k)}" for k in bare)


def normalise_text(c: Column | str) -> Column:
    """The cleaning chain, in this order (H7): apostrophes (H1), contractions
    (H2), non-ASCII (H3), URLs (H4), tags and entities (H5), lower case (H6)."""
    x = F.replace(_c(c), F.lit(" '"), F.lit("'"))
    x = expand_contractions(x)
    x = F.regexp_replace(x, NON_ASCII, "")
    x = F.regexp_replace(x, URL, "")
    x = F.regexp_replace(x, HTML, "")
    return F.lower(x)


def sentences(c: Column | str) -> Column:
    """Sentences in order: a run up to the next ``.!?`` or newline, with its
    closing punctuation."""
    return F.regexp_extract_all(_c(c), F.lit(SENTENCE), F.lit(0))


def rouge_tokens(c: Column | str) -> Column:
    """ROUGE tokens: lower case, split on anything but ``[a-z0-9]``."""
    return F.filter(F.split(F.lower(_c(c)), ROUGE_SPLIT), lambda x: x != F.lit(""))


# --- FIXED VALUES: Treebank-style word tokenizer rules (Java replacement syntax) ---
# Applied in order to lower-cased text; the result is split on whitespace. Of a sentence
# alone only the last period is split off.
TREEBANK_PERIOD = r"([^.])\.([\])}>\"'»”’]*)([\x09-\x0d ]|$)"
TREEBANK_LAST_PERIOD = r"([^.])\.([\])}>\"'»”’]*)$"
TREEBANK_RULES = [
    (r"([«“‘„]|`+)", " $1 "),
    (r'^"', "``"),
    (r"(``)", " $1 "),
    (r'([ (\[{<])("|\'\')', "$1 `` "),
    (r"\.\.\.", " ... "),
    (TREEBANK_PERIOD, "$1 .$2 "),
    (r"([:,])([^\d])", " $1 $2"),
    (r"([:,])$", " $1 "),
    (r"[;@#$%&]", " $0 "),
    (r"[?!]", " $0 "),
    (r"([^'])' ", "$1 ' "),
    (r"[\]\[(){}<>]", " $0 "),
    (r"--", " -- "),
]
# Ending quotes and contractions, on the text with a space at both ends.
TREEBANK_PADDED_RULES = [
    (r"([»”’])", " $1 "),
    (r'"', " '' "),
    (r"([^\x09-\x0d ])('')", "$1 $2 "),
    (r"([^' ])('[sSmMdD]|') ", "$1 $2 "),
    (r"([^' ])('ll|'LL|'re|'RE|'ve|'VE|n't|N'T) ", "$1 $2 "),
    (r"(^|[^\p{L}\p{N}_])(can)(not)($|[^\p{L}\p{N}_])", "$1$2 $3$4"),
    (r"(^|[^\p{L}\p{N}_])(d)('ye)($|[^\p{L}\p{N}_])", "$1$2 $3$4"),
    (r"(^|[^\p{L}\p{N}_])(gim)(me)($|[^\p{L}\p{N}_])", "$1$2 $3$4"),
    (r"(^|[^\p{L}\p{N}_])(gon)(na)($|[^\p{L}\p{N}_])", "$1$2 $3$4"),
    (r"(^|[^\p{L}\p{N}_])(got)(ta)($|[^\p{L}\p{N}_])", "$1$2 $3$4"),
    (r"(^|[^\p{L}\p{N}_])(lem)(me)($|[^\p{L}\p{N}_])", "$1$2 $3$4"),
    (r"(^|[^\p{L}\p{N}_])(more)('n)($|[^\p{L}\p{N}_])", "$1$2 $3$4"),
    (r"(^|[^\p{L}\p{N}_])(wan)(na)($|[^\p{L}\p{N}_])", "$1$2 $3$4"),
    (r"(^| )('t)(is)($|[^\p{L}\p{N}_])", "$1$2 $3$4"),
    (r"(^| )('t)(was)($|[^\p{L}\p{N}_])", "$1$2 $3$4"),
]


# Marks of which all rules but those for periods, colons, commas, ? and !, and six joined words need one; and the
# strings those six and the ellipsis need.
TREEBANK_MARKS = r"""["'`«»“”‘’„;@#$%&\[\](){}<>-]"""
TREEBANK_STRINGS = ("...", "cannot", "gimme", "gonna", "gotta", "lemme", "wanna")
TREEBANK_UNMARKED = (TREEBANK_PERIOD, TREEBANK_LAST_PERIOD, r"([:,])([^\d])", r"([:,])$", r"[?!]")
TREEBANK_SENTENCE_RULES = [(TREEBANK_LAST_PERIOD if p == TREEBANK_PERIOD else p, r) for p, r in TREEBANK_RULES]


def treebank_tokens(c: Column | str, one_sentence: bool = False) -> Column:
    """Lower-cased Treebank-style word tokens.

    A period is split off where whitespace or the end follows; with
    ``one_sentence`` only at the end, so abbreviations inside keep theirs
    (``operators.sentences`` finds the sentences).
    """
    rules = TREEBANK_SENTENCE_RULES if one_sentence else TREEBANK_RULES

    def applied(x: Column, first, padded) -> Column:
        for pat, rep in first:
            x = F.regexp_replace(x, pat, rep)
        x = F.concat(F.lit(" "), x, F.lit(" "))
        for pat, rep in padded:
            x = F.regexp_replace(x, pat, rep)
        return x

    x = F.lower(_c(c))
    some = x.rlike(TREEBANK_MARKS)
    for t in TREEBANK_STRINGS:
        some = some | F.contains(x, F.lit(t))
    # most texts need four rules only
    return ws_tokens(F.when(some, applied(x, rules, TREEBANK_PADDED_RULES)).otherwise(
        applied(x, [r for r in rules if r[0] in TREEBANK_UNMARKED], [])))


_PY_END = r"(?:\Z|(?=\r\n\Z)|(?<!\r)(?=\n\Z)|(?=[\r\x85\u2028\u2029]\Z))"  # Java's $


def _py_rules(rules: list[tuple[str, str]]) -> list:
    """The rules as Python's substitutions."""
    def pattern(p: str) -> str:
        return p.replace(r"[^\d]", "[^0-9]").replace(r"[^\p{L}\p{N}_]", r"\W").replace("$)", _PY_END + ")").replace(
            "[;@#$%&]", r"[;@#\x24%&]").removesuffix("$") + (_PY_END if p.endswith("$") else "")
    return [(re.compile(pattern(p)).sub, re.sub(r"\$(\d)", r"\\g<\1>", new)) for p, new in rules]


class Treebank:
    """``treebank_tokens`` of one lower-cased text, for steps that hold the texts in Python."""

    def __init__(self, one_sentence: bool = False) -> None:
        rules = TREEBANK_SENTENCE_RULES if one_sentence else TREEBANK_RULES
        self.rules, self.padded = _py_rules(rules), _py_rules(TREEBANK_PADDED_RULES)
        self.few = _py_rules([r for r in rules if r[0] in TREEBANK_UNMARKED])
        self.some = re.compile("|".join([TREEBANK_MARKS, *map(re.escape, TREEBANK_STRINGS)])).search

    def __call__(self, lowered: str) -> list[str]:
        marked = self.some(lowered)
        for sub, new in self.rules if marked else self.few:
            lowered = sub(new, lowered)
        if marked:
            lowered = f" {lowered} "
            for sub, new in self.padded:
                lowered = sub(new, lowered)
        return lowered.split()
