"""Porter stems (Porter 1980, with the usual extensions) as SQL expressions, for METEOR's stem stage.

``with_stems`` works on a table of distinct tokens. A word's shape writes each letter as a consonant (1) or a vowel
(0), so the conditions of the algorithm are patterns on the shape of what stands before a suffix: the measure is the
number of "01" in it. Each step is one projection over the columns of the step before.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise

# --- FIXED VALUES: irregular words and their stems ---
IRREGULAR = {
    "skies": "sky", "sky": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing", "cannings": "canning",
    "canning": "canning", "howe": "howe", "proceed": "proceed", "exceed": "exceed", "succeed": "succeed",
}
# --- FIXED VALUES: suffix tables of the published algorithm, in its order: suffix -> replacement ---
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "bli": "ble", "alli": "al",
    "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al",
    "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
    "fulli": "ful", "lessli": "less", "logi": "log",
}
STEP_3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP_4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate",
          "iti", "ous", "ive", "ize"]

_MARK = "\x01"
ONCE, TWICE = "01", "01.*01"  # measure above 0, above 1


def shape(w: Column) -> Column:
    """Consonants as 1, vowels as 0; y is a consonant at the start and after a vowel."""
    plain = F.regexp_replace(F.regexp_replace(w, "[^aeiouy]", "1"), "[aeiou]", "0")
    single = F.replace(F.regexp_replace(plain, "(^|0)y", "$11"), F.lit("y"), F.lit("0"))
    # y after y depends on the one before: only such words are walked letter by letter
    walked = F.aggregate(F.split(plain, ""), F.lit(""), lambda done, c: F.concat(done, F.when(
        c == "y", F.when((done == "") | done.endswith("0"), "1").otherwise("0")).otherwise(c)))
    return F.when(F.contains(w, F.lit("yy")), walked).otherwise(single)



def _first(w: Column, f: Column, rules: Sequence[tuple[str, str, Callable[[Column, Column], Column] | None]]) -> Column:
    """The first rule whose suffix the word has decides: (suffix, replacement, condition on stem and its shape)."""
    out = None
    for suffix, new, cond in rules:
        stem = F.left(w, F.length(w) - len(suffix))
        done = F.concat(stem, F.lit(new))
        if cond is not None:
            done = F.when(cond(stem, F.left(f, F.length(w) - len(suffix))), done).otherwise(w)
        test = w.endswith(suffix)
        out = F.when(test, done) if out is None else out.when(test, done)
    return out.otherwise(w)


def _measure(pattern: str) -> Callable[[Column, Column], Column]:
    return lambda stem, f: f.rlike(pattern)


def _short_end(w: Column, f: Column) -> Column:
    """Consonant, vowel, consonant other than w, x, y; or a word of vowel and consonant."""
    return (f.rlike("101$") & ~w.rlike("[wxy]$")) | (f == "01")


def _plurals(w: Column, f: Column) -> Column:
    return F.when(w.endswith("ies") & (F.length(w) == 4), F.concat(F.left(w, F.length(w) - 3), F.lit("ie"))).otherwise(
        _first(w, f, [("sses", "ss", None), ("ies", "i", None), ("ss", "ss", None), ("s", "", None)]))


def _past(w: Column, f: Column) -> Column:
    """Takes -ed and -ing off; the bare stem is marked for the repair that follows."""
    vowel = _measure("0")
    ied = F.concat(F.left(w, F.length(w) - 3), F.when(F.length(w) == 4, "ie").otherwise("i"))
    return (F.when(w.endswith("ied"), ied)
            .when(w.endswith("eed"), _first(w, f, [("eed", "ee", _measure(ONCE))]))
            .when(w.endswith("ed") & vowel(w, F.left(f, F.length(w) - 2)), F.concat(F.left(w, F.length(w) - 2), F.lit(_MARK)))
            .when(w.endswith("ing") & vowel(w, F.left(f, F.length(w) - 3)), F.concat(F.left(w, F.length(w) - 3), F.lit(_MARK)))
            .otherwise(w))


def _repair(w: Column, f: Column) -> Column:
    bare = F.left(w, F.length(w) - 1)
    fb = F.left(f, F.length(w) - 1)
    fixed = (F.when(bare.rlike("(at|bl|iz)$"), F.concat(bare, F.lit("e")))
             .when(bare.rlike(r"(.)\1$") & fb.endswith("1"),
                   F.when(bare.rlike("[lsz]$"), bare).otherwise(F.left(bare, F.length(bare) - 1)))
             .when(fb.rlike(ONCE) & ~fb.rlike(TWICE) & _short_end(bare, fb), F.concat(bare, F.lit("e")))
             .otherwise(bare))
    return F.when(w.endswith(_MARK), fixed).otherwise(w)


def _final_y(w: Column, f: Column) -> Column:
    return _first(w, f, [("y", "i", lambda stem, fs: (F.length(stem) > 1) & fs.endswith("1"))])


def _step_2(w: Column, f: Column) -> Column:
    def cond(suffix: str):
        if suffix == "logi":  # measured with the l
            return lambda stem, fs: F.left(f, F.length(w) - 3).rlike(ONCE)
        return _measure(ONCE)
    return _first(w, f, [(s, r, cond(s)) for s, r in STEP_2.items()])


def _step_2_alli(w: Column, f: Column) -> Column:
    """-alli becomes -al before the table is read."""
    return _first(w, f, [("alli", "al", _measure(ONCE))])


def _step_3(w: Column, f: Column) -> Column:
    return _first(w, f, [(s, r, _measure(ONCE)) for s, r in STEP_3.items()])


def _step_4(w: Column, f: Column) -> Column:
    ion = lambda stem, fs: fs.rlike(TWICE) & stem.rlike("[st]$")
    return _first(w, f, [(s, "", ion if s == "ion" else _measure(TWICE)) for s in STEP_4])


def _final_e(w: Column, f: Column) -> Column:
    drop = lambda stem, fs: fs.rlike(TWICE) | (fs.rlike(ONCE) & ~_short_end(stem, fs))
    return _first(w, f, [("e", "", drop)])


def _final_l(w: Column, f: Column) -> Column:
    return F.when(w.endswith("ll") & F.left(f, F.length(w) - 1).rlike(TWICE), F.left(w, F.length(w) - 1)).otherwise(w)


STEPS = (_plurals, _past, _repair, _final_y, _step_2_alli, _step_2, _step_3, _step_4, _final_e, _final_l)


def with_stems(tokens: DataFrame, col: str, out: str = "stem") -> DataFrame:
    """Add the stem of each token in ``col`` (words of one or two letters are their own stems).

    The table is written once: a filter on the stem, inferred from a join,
    must not be pushed through the steps, where it would grow with each.
    """
    x = tokens.withColumn("_w", F.lower(col))
    for step in STEPS:
        x = x.withColumn("_f", shape(F.col("_w"))).withColumn("_w", step(F.col("_w"), F.col("_f")))
    irregular = F.create_map(*[F.lit(v) for kv in IRREGULAR.items() for v in kv])
    word = F.lower(F.col(col))
    stem = F.coalesce(F.try_element_at(irregular, word), F.when(F.length(word) <= 2, word), F.col("_w"))
    return materialise(x.withColumn(out, stem).drop("_w", "_f"), "stems")
