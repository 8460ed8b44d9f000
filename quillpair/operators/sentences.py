"""Sentence boundaries learned from a corpus (H21), after Kiss and Strunk (2006).

Nothing is annotated by hand. One pass counts adjacent word types (with the mark
after the first and the case of the second); every statistic is an aggregate of
that table, whose size is the number of distinct adjacent types.

* Abbreviations: log-likelihood that a type is (almost) always followed by a
  period, weighed by its length, its inner periods and its occurrences without
  a period.
* Frequent sentence starters and collocations across a period: Dunning's
  log-likelihood ratio of the pair, where the pair is commoner than chance.
* Orthography: whether a type is ever lower-case, and upper-case inside a
  sentence or at its start.

A period ends a sentence unless it follows an abbreviation, a single letter or a
number (or is an ellipsis) and the next word does not show a start. Words are
whitespace tokens without surrounding quotes, brackets and ``,;:``; a mark
followed by one of ``,;:`` ends nothing; line breaks are white space. Null, empty
and blank texts have no sentences.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from ..functions import text as T
from ..session import materialise

# --- FIXED VALUES: the paper's thresholds, and the character classes of a word ---
ABBREVIATION_SCORE = 0.3
ALWAYS = 0.99
COLLOCATION_SCORE = 7.88
STARTER_SCORE = 30.0
OPENING = r"""^["'“”‘’«»(\[{]+"""
CLOSING = r"""["'“”‘’«»)\]},;:]+$"""
SOFT = r"""[,;:]["'“”‘’«»)\]}]*$"""
QUOTES = "\"'“”‘’«»"
OPENS, CLOSES = QUOTES + "([{", QUOTES + ")]},;:"  # a token without one of these at its end is its own core
SHUT = QUOTES + ")]}"  # what may follow one of ,;: that makes a mark soft
MARKED = frozenset(".!?" + SHUT)  # the last characters of tokens that may carry a mark
STOPS = ("", ".", "..", "!")
#: Bytes of text whose tokens are counted together.
SLICE_BYTES = 16_000_000
NUMBER = r"^[0-9]+([.,:/-][0-9]+)*$"
LETTER = r"\p{L}"
INITIAL = r"^\p{L}$"


@dataclass(frozen=True)
class SentenceModel:
    """``abbreviations`` (word, n, n_period, score), ``collocations`` (word, next, n, score) and ``words`` (word, n,
    lower, upper_mid, upper_start, lower_start, n_start, starter, score)."""

    abbreviations: DataFrame
    collocations: DataFrame
    words: DataFrame


def _bare(t: Column) -> Column:
    closed = F.contains(F.lit(CLOSES), F.right(t, F.lit(1)))
    core = F.regexp_replace(F.regexp_replace(t, OPENING, ""), CLOSING, "")
    core = F.when(closed | F.contains(F.lit(OPENS), F.left(t, F.lit(1))), core).otherwise(t)
    return F.struct(core.alias("core"), F.when(closed, t.rlike(SOFT)).otherwise(F.lit(False)).alias("soft"))


def _typed(x: Column) -> Column:
    """A token's word type, whether a period closes it, its sentence mark and the case of its first character."""
    core, last, first = x["core"], F.right(x["core"], F.lit(1)), F.left(x["core"], F.lit(1))
    word = F.lower(F.rtrim(core, F.lit(".!?")))
    period = (last == ".") & ~core.endswith("..")
    stop = F.when(x["soft"], "").when(period, ".").when(last == ".", "..").when(last.isin("!", "?"), "!").otherwise("")
    case = F.when(first.between("a", "z"), "L").when(first.between("A", "Z"), "U").when(first.rlike(r"\p{Lu}"), "U").when(first.rlike(r"\p{Ll}"), "L").otherwise("N")
    return F.struct(F.when(first.between("0", "9") & word.rlike(NUMBER), "#").otherwise(word).alias("word"),
                    period.alias("period"), stop.alias("stop"), case.alias("kase"))


def token_stop(t: str) -> str:
    """A token's sentence mark: the ``stop`` of ``_typed``."""
    if t.rstrip(SHUT)[-1:] in (",", ";", ":"):
        return ""
    core = t.lstrip(OPENS).rstrip(CLOSES)
    last = core[-1:]
    if last == ".":
        return ".." if core.endswith("..") else "."
    return "!" if last in ("!", "?") else ""


def marks_of(tokens: Sequence[str]) -> list[tuple[int, str]]:
    """(place from 1, mark) of the tokens that carry one."""
    found = [(i, token_stop(t)) for i, t in enumerate(tokens, 1) if t[-1] in MARKED]
    return [x for x in found if x[1]]


def text_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Array]:
    """The texts of all batches in arrays of about SLICE_BYTES, or one text."""
    held, size = [], 0
    for batch in batches:
        texts = batch.column(0).drop_null()
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        first = 0
        while first < len(texts):
            before = int(ends[first - 1]) if first else 0
            last = max(int(np.searchsorted(ends, before + SLICE_BYTES - size, "right")), first + (not held))
            held.append(texts.slice(first, last - first))
            size += int(ends[last - 1]) - before if last > first else 0
            if last < len(texts):
                yield pa.concat_arrays(held)
                held, size = [], 0
            first = last
    if held:
        yield pa.concat_arrays(held)


def _count_adjacent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(ptoken, pstop, token, n): how often a token follows a mark or none; the token before is kept at a period."""
    for texts in text_slices(batches):
        lists = pc.utf8_split_whitespace(texts)  # breaks where str.split does, but leaves empty strings at the ends
        flat = lists.flatten()
        real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
        text = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))[real]
        tokens = pc.dictionary_encode(flat.filter(pa.array(real)))
        code, words = tokens.indices.to_numpy().astype(np.int64), tokens.dictionary
        if not len(code):
            continue
        marked = np.flatnonzero(pc.is_in(pc.utf8_slice_codeunits(words, -1), pa.array(sorted(MARKED))).to_numpy(zero_copy_only=False))
        stop_of = np.zeros(len(words), np.int64)
        stop_of[marked] = [STOPS.index(token_stop(t)) for t in words.take(pa.array(marked)).to_pylist()]
        first = np.append(True, text[1:] != text[:-1])
        stop = np.where(first, len(STOPS), np.append(0, stop_of[code[:-1]]))
        plain = np.bincount(code[stop == 0], minlength=len(words))
        at = np.flatnonzero(stop)
        stop, code, before = stop[at], code[at], np.append(0, code)[at]
        key = (np.where(stop == 1, before + 1, 0) * (len(STOPS) + 1) + stop) * len(words) + code
        key, n = np.unique(key, return_counts=True)
        rest, code = np.divmod(key, len(words))
        before, stop = np.divmod(rest, len(STOPS) + 1)
        some = np.flatnonzero(plain)
        yield pa.RecordBatch.from_arrays([
            words.take(pa.array(np.append(before - 1, np.full(len(some), -1)), mask=np.append(before == 0, np.full(len(some), True)))),
            pa.array([*STOPS, "start"]).take(pa.array(np.append(stop, np.zeros(len(some), np.int64)))),
            words.take(pa.array(np.append(code, some))), pa.array(np.append(n, plain[some]), pa.int64())],
            names=["ptoken", "pstop", "token", "n"])


def _times_log(k: Column, x: Column) -> Column:
    """k ln x, 0 where k is 0."""
    return F.when(k > 0, k * F.log(x)).otherwise(0.0)


def _binomial(k: Column, n: Column, p: Column) -> Column:
    return _times_log(k, p) + _times_log(n - k, 1 - p)


def _ratio(c1: Column, c2: Column, c12: Column, n: Column) -> Column:
    """Dunning's log-likelihood ratio: does the second event follow the first more or less often than elsewhere?"""
    c1, c2, c12, n = (c.cast("double") for c in (c1, c2, c12, n))
    p, p1, p2 = c2 / n, F.try_divide(c12, c1), F.coalesce(F.try_divide(c2 - c12, n - c1), F.lit(0.0))
    return 2 * (_binomial(c12, c1, p1) + _binomial(c2 - c12, n - c1, p2)
                - _binomial(c12, c1, p) - _binomial(c2 - c12, n - c1, p))


def adjacent_types(df: DataFrame, text: str) -> DataFrame:
    """(pword, pstop, word, period, kase, n): counts of a type after another. ``pstop`` is the mark between them
    (``start`` at the first word), ``pword`` the type before a period, else null."""
    x = df.select(F.col(text).alias("text")).mapInArrow(_count_adjacent, "ptoken string, pstop string, token string, n bigint")
    x = x.select("pstop", "n", _bare(F.col("token")).alias("i"), _bare(F.col("ptoken")).alias("b"))
    x = x.select("pstop", "n", _typed(F.col("i")).alias("i"), F.when(F.col("pstop") == ".", _typed(F.col("b"))["word"]).alias("pword"))
    return x.groupBy("pword", "pstop", "i.word", "i.period", "i.kase").agg(F.sum("n").alias("n"))


def _abbreviations(types: DataFrame, total: int, periods: int) -> DataFrame:
    types = types.select("word", "n", "n_period").filter((F.col("n_period") > 0) & F.col("word").rlike(LETTER))
    n, k = F.col("n").cast("double"), F.col("n_period").cast("double")
    letters = F.replace("word", F.lit("."), F.lit(""))
    length, inner = F.length(letters), F.length("word") - F.length(letters) + 1
    chance = F.lit(periods / total) if total else F.lit(1.0)
    gain = 2 * (_binomial(k, n, F.lit(ALWAYS)) - _binomial(k, n, chance))
    score = F.when(chance < 1, gain * F.exp(-length) * inner * F.pow(length.cast("double"), k - n))
    return types.withColumn("score", score).filter(F.col("score") >= ABBREVIATION_SCORE)


def learn_sentences(df: DataFrame, text: str) -> SentenceModel:
    """The model of a corpus; its tables are written once in the shared folder."""
    pairs = materialise(adjacent_types(df, text), "adjacent-types")

    def where(cond: Column) -> Column:
        return F.sum(F.when(cond, F.col("n")).otherwise(0))

    upper, lower = F.col("kase") == "U", F.col("kase") == "L"
    begun = F.col("pstop").isin("start", ".", "!")
    # Types once, as if each period ended a sentence; what stands behind an open one is taken off below.
    types = materialise(pairs.groupBy("word").agg(
        F.sum("n").alias("n"), where(F.col("period")).alias("n_period"), where(lower).alias("lower"),
        where(upper & (F.col("pstop") == "")).alias("upper_mid"), where(upper & begun).alias("upper_start"),
        where(lower & begun).alias("lower_start"), where(F.col("pstop").isin(".", "!")).alias("n_start")), "types")
    count = types.agg(F.sum("n").alias("n"), F.sum("n_period").alias("k"), F.sum("n_start").alias("b")).first()
    total, periods = count["n"] or 0, count["k"] or 0
    abbreviations = materialise(_abbreviations(types, total, periods), "abbreviations")

    known = abbreviations.select(F.col("word").alias("pword"), F.lit(True).alias("known"))
    open_ = pairs.filter("pstop = '.'").select("pword", "word", "kase", "n").join(known, "pword", "left")
    open_ = open_.filter(F.col("known").isNotNull() | (F.col("pword") == "#") | F.col("pword").rlike(INITIAL))
    open_ = materialise(open_.drop("known"), "open-types")
    breaks = (count["b"] or 0) - (open_.agg(F.sum("n").alias("b")).first()["b"] or 0)
    off = open_.groupBy("word").agg(F.sum("n").alias("_n"), where(upper).alias("_upper"), where(lower).alias("_lower"))
    less = lambda c, d: (F.col(c) - F.coalesce(d, F.lit(0))).alias(c)
    words = types.join(off, "word", "left").select(
        "word", "n", "lower", "upper_mid", less("upper_start", "_upper"), less("lower_start", "_lower"), less("n_start", "_n"))
    ratio = _ratio(F.lit(breaks), F.col("n"), F.col("n_start"), F.lit(total))
    starter = ((ratio >= STARTER_SCORE) & F.col("word").rlike(LETTER)
               & (F.col("n_start") * F.lit(float(total)) > F.col("n") * F.lit(float(breaks))))
    words = materialise(words.withColumns({"score": ratio, "starter": F.coalesce(starter, F.lit(False))}), "word-types")

    over = open_.groupBy("pword", "word").agg(F.sum("n").alias("n"))
    first = over.groupBy("pword").agg(F.sum("n").alias("c1"))
    second = words.filter(~F.col("starter")).select("word", F.col("n").alias("c2"))
    both = over.join(first, "pword").join(second, "word")
    both = both.withColumn("score", _ratio(F.col("c1"), F.col("c2"), F.col("n"), F.lit(total)))
    both = both.filter((F.col("score") >= COLLOCATION_SCORE) & F.col("word").rlike(LETTER + "|#")
                       & (F.col("n") * F.lit(float(total)) > F.col("c1").cast("double") * F.col("c2")))
    collocations = materialise(both.select(F.col("pword").alias("word"), F.col("word").alias("next"), "n", "score"),
                               "collocations")
    return SentenceModel(abbreviations, collocations, words)


def model_rows(model: SentenceModel) -> DataFrame:
    """The learned types as one table (kind, word, next, n, score)."""
    nothing = F.lit(None).cast("string")
    return (model.abbreviations.select(F.lit("abbreviation").alias("kind"), "word", nothing.alias("next"), "n", "score")
            .unionByName(model.words.filter("starter").select(
                F.lit("starter").alias("kind"), "word", nothing.alias("next"), F.col("n_start").alias("n"), "score"))
            .unionByName(model.collocations.select(F.lit("collocation").alias("kind"), "word", "next", "n", "score")))


_PLACES = ArrayType(StructType([StructField("at", IntegerType()), StructField("x", StringType()), StructField("y", StringType())]))


@F.arrow_udf(_PLACES)
def _open_marks(texts: pa.Array) -> pa.Array:
    """Places (from 1) of the marks that may end no sentence, the token of a single period and the token after it."""
    kind = pa.struct([("at", pa.int32()), ("x", pa.string()), ("y", pa.string())])
    ends, at, x, y = [0], [], [], []
    for text in texts:
        tokens = (text.as_py() or "").split()
        for i, stop in marks_of(tokens):
            if stop != "!" and i < len(tokens):
                at.append(i)
                x.append(tokens[i - 1] if stop == "." else None)
                y.append(tokens[i])
        ends.append(len(at))
    rows = pa.StructArray.from_arrays([pa.array(at, pa.int32()), pa.array(x, pa.string()), pa.array(y, pa.string())], fields=list(kind))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)


def _sentences(text: str | None, held: Sequence[int] | None) -> list[str]:
    """A text is cut behind its marks but the held ones, and at its end."""
    tokens, stay, first, out = (text or "").split(), set(held or ()), 0, []
    for i, _ in marks_of(tokens):
        if i not in stay:
            out.append(" ".join(tokens[first:i]))
            first = i
    if first < len(tokens):
        out.append(" ".join(tokens[first:]))
    return out


def _lists(texts: pa.Array, held: pa.Array, of: Callable[[list[str]], list[str]]) -> pa.ListArray:
    ends, values = [0], []
    for text, places in zip(texts, held):
        values += of(_sentences(text.as_py(), places.as_py()))
        ends.append(len(values))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.string()))


@F.arrow_udf(ArrayType(StringType()))
def _cut(texts: pa.Array, held: pa.Array) -> pa.Array:
    return _lists(texts, held, lambda sentences: sentences)


@F.arrow_udf(ArrayType(StringType()))
def _cut_words(texts: pa.Array, held: pa.Array) -> pa.Array:
    words = T.Treebank(one_sentence=True)
    return _lists(texts, held, lambda sentences: [w for s in sentences for w in words(s)])


def _held(df: DataFrame, keys: list[str], text: str, model: SentenceModel) -> DataFrame:
    """(keys, held): places (from 1) whose mark ends no sentence."""
    x = df.select(*keys, _open_marks(text).alias("_places")).select(*keys, F.inline("_places"))
    x = x.select(*keys, "at", "y", _bare(F.col("x")).alias("x"), F.col("x").isNotNull().alias("single"))
    x = x.select(*keys, "at", "y", F.when(F.col("single"), _typed(F.col("x"))["word"]).alias("word"))
    known = model.abbreviations.select("word", F.lit("abbreviation").alias("known"))
    kind = (F.when(F.col("word").isNull(), "abbreviation").when(F.col("known").isNotNull(), F.col("known"))
            .when(F.col("word") == "#", "number").when(F.col("word").rlike(INITIAL), "initial"))
    x = x.join(known, "word", "left").withColumn("kind", kind).filter("kind IS NOT NULL")
    x = x.withColumn("y", _bare(F.col("y"))).withColumn("y", _typed(F.col("y")))
    x = x.select(*keys, "at", "word", "kind", F.col("y.word").alias("next"), F.col("y.kase").alias("kase"))
    x = x.join(model.collocations.select("word", "next", F.lit(True).alias("together")), ["word", "next"], "left")
    x = x.join(model.words.select(F.col("word").alias("next"), "lower", "upper_mid", "upper_start", "lower_start",
                                  "starter"), "next", "left")
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    upper = F.col("kase") == "U"
    begins = upper & (n("lower") > 0) & (n("upper_mid") == 0)
    goes_on = (F.col("kase") == "L") & ((n("upper_start") + n("upper_mid") > 0) | (n("lower_start") == 0))
    starter = upper & F.coalesce("starter", F.lit(False))
    name = (F.col("kind") == "initial") & upper & (n("lower") == 0)
    held = F.col("together").isNotNull() | F.when(F.col("kind") == "abbreviation", ~begins & ~starter).otherwise(goes_on | name)
    return x.filter(held).groupBy(*keys).agg(F.collect_list("at").alias("held"))


def sentence_arrays(df: DataFrame, keys: Sequence[str], text: str, model: SentenceModel, out: str = "sentences") -> DataFrame:
    """(keys, out): the sentences of every text that has words, in order, their words joined by one space. ``keys``
    are unique and not null, and none is called as ``out``."""
    return _with_held(df, keys, text, model, _cut, out)


def sentence_words(df: DataFrame, keys: Sequence[str], text: str, model: SentenceModel, out: str = "words") -> DataFrame:
    """(keys, out): the Treebank tokens of each sentence of a lower-cased text, in order."""
    return _with_held(df, keys, text, model, _cut_words, out)


def _with_held(df: DataFrame, keys: Sequence[str], text: str, model: SentenceModel, cut: Callable[..., Column], out: str) -> DataFrame:
    names, keys = list(keys), [f"_key{i}" for i in range(len(keys))]
    # The join takes texts and places; an array of tokens is a multiple of its text.
    x = df.select(*[F.col(n).alias(k) for n, k in zip(names, keys)], F.col(text).alias("_joined")).filter(F.col("_joined").rlike(T.NOT_WS))
    x = x.join(_held(x, keys, "_joined", model), keys, "left")
    return x.select(*[F.col(k).alias(n) for n, k in zip(names, keys)], cut("_joined", "held").alias(out))


def split_sentences(df: DataFrame, keys: Sequence[str], text: str, model: SentenceModel) -> DataFrame:
    """(keys, pos, sentence), pos from 1."""
    x = sentence_arrays(df, keys, text, model).select(*keys, F.posexplode_outer("sentences").alias("pos", "sentence"))
    return x.withColumn("pos", (F.col("pos") + 1).cast("bigint"))
