"""Text-generation metrics per (hypothesis, reference) row and over a corpus.

The rows to score are grouped once; a row's n-grams and words are counted and
aligned inside it, linear in the text length, so no token and no n-gram is
shuffled. Rows that share their keys are scored together, and one step cuts the
words of a group and measures all metrics.

* BLEU-1..4 (J6): the n-grams of both sides are counted per row; clipping is
  the lesser of the two.
* METEOR (J7): the greedy alignment from the end pairs the k-th last
  occurrence of a word in the hypothesis with its k-th last occurrence in
  the reference. What stays single goes on to the stem stage, then to the
  synonym stage, where a word may belong to several sets. Stems and sets are
  joined to the distinct words of blocks of rows, not to each row's words.
* ROUGE-L (J5) needs a longest common subsequence, a sequential DP with no
  built-in expression; it runs in the Arrow batches with the bit-parallel LCS of Hyyro (2004): O(|a| * |b| / wordsize) per row.

Formulas follow the public descriptions of the libraries the original used
(rouge_score, NLTK BLEU with smoothing method 4, NLTK METEOR); small
differences from those libraries in the third decimal are possible.
"""

from __future__ import annotations

import math
import re
import sys
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from .. import resources as R
from ..functions import text as T
from ..functions.stem import with_stems
from ..session import materialise
from .sentences import SentenceModel, sentence_words


def _empty() -> Column:
    return F.array().cast("array<string>")


#: Rows (two to this power) whose distinct words are looked up together.
BLOCK_BITS = 9


def _tasks(df: DataFrame) -> int:
    """Tasks for rows whose work is heavy per byte: adaptive execution would fold a small table into one."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _rows_of(df: DataFrame, keys: Sequence[str], h: str, r: str, by: Sequence[str] | None = None) -> DataFrame:
    """(keys, _rows): the two sides of the rows of each key, almost always one row; dealt out by ``by``."""
    return df.select(*keys, h, r).repartition(_tasks(df), *(by or keys)).groupBy(*keys).agg(F.collect_list(F.struct(F.col(h).alias("h"), F.col(r).alias("r"))).alias("_rows"))


def _tokenised(df: DataFrame, keep: Sequence[str], of: Callable[[Column], Column], sizes: str) -> DataFrame:
    """(keep, _hs, _rs, sizes): per row of ``_rows`` the tokens of both sides joined by spaces (a token has none), and
    their numbers."""
    x = df.select("*", F.transform("_rows", lambda x: F.struct(of(x["h"]).alias("h"), of(x["r"]).alias("r"))).alias("_t"))
    side = lambda c: F.transform("_t", lambda x: F.array_join(x[c], " "))
    return x.select(*keep, side("h").alias("_hs"), side("r").alias("_rs"), F.transform(
        "_t", lambda x: F.struct(F.size(x["h"]).alias("_nh"), F.size(x["r"]).alias("_nr"))).alias(sizes))


def _split(joined: str | None) -> list[str]:
    return joined.split(" ") if joined else []


# ------------------------------------------------------------------ ROUGE-L

def lcs_len(a, b) -> int:
    """Bit-parallel LCS length (Hyyro 2004): bits index the shorter sequence."""
    if a is None or b is None or len(a) == 0 or len(b) == 0:
        return 0
    if len(a) < len(b):
        a, b = b, a
    masks: dict = {}
    for j, t in enumerate(b):
        masks[t] = masks.get(t, 0) | (1 << j)
    full = (1 << len(b)) - 1
    v = full
    for t in a:
        u = v & masks.get(t, 0)
        v = ((v + u) | (v - u)) & full
    return len(b) - v.bit_count()


@F.pandas_udf(LongType())
def lcs_length(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(np.fromiter((lcs_len(x, y) for x, y in zip(a, b)), dtype=np.int64,
                                 count=len(a)))


def rouge_columns(df: DataFrame, h: str, r: str) -> DataFrame:
    """Add ``rouge_p``, ``rouge_r``, ``rouge_f``: ROUGE-L on ROUGE-token
    arrays ``h``/``r`` (J5, H22); 0 when either side is empty."""
    x = df.withColumn("_lcs", lcs_length(F.col(h), F.col(r)).cast("double"))
    return _rouge(x, F.size(F.col(h)), F.size(F.col(r)))


def _rouge(x: DataFrame, nh: Column, nr: Column) -> DataFrame:
    lcs = F.col("_lcs")
    x = x.withColumns({"rouge_p": F.coalesce(F.try_divide(lcs, nh), F.lit(0.0)),
                       "rouge_r": F.coalesce(F.try_divide(lcs, nr), F.lit(0.0))})
    p, rc = F.col("rouge_p"), F.col("rouge_r")
    return x.withColumn("rouge_f", F.when(p + rc > 0, F.try_divide(2 * p * rc, p + rc))
                        .otherwise(0.0)).drop("_lcs")


# ------------------------------------------------------------------ BLEU

def gram_counts(tokens: Sequence[Sequence[str]], max_n: int) -> list[Counter]:
    """Per order 1..max_n the number of each n-gram in the texts."""
    return [Counter(g for t in tokens for g in zip(*(t[i:] for i in range(n)))) for n in range(1, max_n + 1)]


def clipped_matches(tokens: Sequence[Sequence[str]], there: Sequence[Counter]) -> list[int]:
    """Per order the n-grams of the hypotheses that the references hold, clipped to their number ``there``; an order
    without match has none in the orders above it."""
    nums = [0] * len(there)
    for n, known in enumerate(there, 1):
        own = Counter(g for t in tokens for g in zip(*(t[i:] for i in range(n))) if g in known)
        nums[n - 1] = sum(min(c, known[g]) for g, c in own.items())
        if not nums[n - 1]:
            break
    return nums


SMOOTHING = ("method0", "method1", "method4")


def bleu_scores(df: DataFrame, keys: Sequence[str], h: str, r: str, max_n: int = R.BLEU_MAX_N,
                prefix: str = "bleu", smoothing: str = "method4") -> DataFrame:
    """(keys, bleu1..bleuN): sentence BLEU with uniform weights 1/N, single
    reference (C7, J6, H24, D15), smoothing chosen by name (L4). ``h``/``r``
    name token-array columns, ``keys`` columns unique per row.

    An order with no match gets, by ``smoothing``:

    * ``method0`` (none): precision = the smallest positive double, so the
      score collapses towards 0 instead of failing on log(0);
    * ``method1``: numerator 0.1 (epsilon) instead of 0;
    * ``method4`` (default, as the original): numerator ln|h| / (2^k * 5),
      k = 1 + number of lower orders already smoothed (only when |h| > 1).
    """
    if smoothing not in SMOOTHING:
        raise ValueError(f"smoothing must be one of {SMOOTHING}")
    keys = list(keys)
    x = _tokenised(_rows_of(df, keys, h, r), keys, lambda c: c, "_sizes")

    @F.pandas_udf(ArrayType(LongType()))
    def clipped(hs: pd.Series, rs: pd.Series) -> pd.Series:
        lists = lambda texts: [_split(t) for t in texts]
        return pd.Series([clipped_matches(lists(h), gram_counts(lists(r), max_n)) for h, r in zip(hs, rs)], dtype=object)

    return _bleu(x.withColumn("_nums", clipped("_hs", "_rs")), keys, max_n, prefix, smoothing)


def _bleu(df: DataFrame, keep: Sequence[str], max_n: int, prefix: str, smoothing: str) -> DataFrame:
    """(keep, bleu1..bleuN) of each row of (keep, _sizes, _nums)."""
    orders = range(1, max_n + 1)
    x = df.select(*keep, "_nums", F.inline("_sizes")).select(
        *keep, F.col("_nh").cast("double").alias("_nh"), F.col("_nr").cast("double").alias("_nr"),
        *[F.col("_nums")[n - 1].alias(f"_num{n}") for n in orders])
    nh, nr = F.col("_nh"), F.col("_nr")
    ps = {}
    smoothed_before = F.lit(0)
    for n in orders:
        num = F.col(f"_num{n}")
        den = F.greatest(nh - n + 1, F.lit(1.0))
        zero = num == 0
        if smoothing == "method4":
            smoothed = (F.when(nh > 1, F.log(nh) / (F.pow(F.lit(2.0), smoothed_before + 1)
                                                     * R.BLEU_METHOD4_K) / den)
                        .otherwise(F.lit(0.0)))
        elif smoothing == "method1":
            smoothed = F.lit(R.BLEU_METHOD1_EPSILON) / den
        else:
            smoothed = F.lit(sys.float_info.min)
        ps[f"_p{n}"] = F.when(~zero, num.cast("double") / den).otherwise(smoothed)
        smoothed_before = smoothed_before + F.when(zero & (nh > 1), 1).otherwise(0)
    ps["_bp"] = F.when(nh > nr, 1.0).when(nh == 0, 0.0).otherwise(F.exp(1 - F.try_divide(nr, nh)))
    x = x.withColumns(ps)
    outs = []
    for big_n in orders:
        logs = sum((F.when(F.col(f"_p{i}") > 0, F.log(F.col(f"_p{i}")) / big_n).otherwise(0.0)
                    for i in range(1, big_n + 1)), F.lit(0.0))
        outs.append(F.when(F.col("_num1") == 0, 0.0).otherwise(F.col("_bp") * F.exp(logs)).alias(f"{prefix}{big_n}"))
    return x.select(*keep, *outs)


# ------------------------------------------------------------------ METEOR

Item = tuple[int, str]  # place and token


def align(h: list[Item], r: list[Item], of: Callable[[str], str]) -> tuple[list[tuple[int, int]], list[Item], list[Item]]:
    """Pair the k-th last item of one side with that of the other that is the same by ``of`` (E4): the pairs of places,
    and the items without partner. Places ascend."""
    free: dict[str, list[Item]] = {}
    for item in r:
        free.setdefault(of(item[1]), []).append(item)
    pairs, single = [], []
    for item in reversed(h):
        stack = free.get(of(item[1]))
        if stack:
            pairs.append((item[0], stack.pop()[0]))
        else:
            single.append(item)
    return pairs, single[::-1], sorted(x for stack in free.values() for x in stack)


def _places(texts: Sequence[Sequence[str]]) -> list[Item]:
    if len(texts) == 1:
        return list(enumerate(texts[0]))
    return sorted(item for t in texts for item in enumerate(t))


def meteor_counts(hs: Sequence[Sequence[str]], rs: Sequence[Sequence[str]], stems: dict[str, str] | None = None,
                  sets: dict[str, list[str]] | None = None) -> list[int]:
    """Matches and chunks, runs of matches adjacent on both sides (E5). ``stems`` holds the tokens that are not their
    own stem, ``sets`` the synonym sets of a token."""
    pairs, h, r = align(_places(hs), _places(rs), lambda t: t)
    if stems is not None:
        more, h, r = align(h, r, lambda t: stems.get(t, t))
        pairs += more
    if sets:
        of = lambda side: sorted((p, s) for p, t in side for s in sets.get(t, ()))
        left, right = of(h), of(r)
        if left and right:
            pairs += map(tuple, greedy_pairs(*zip(*left), *zip(*right)))
    pairs.sort()
    near = sum(a[0] + 1 == b[0] and a[1] + 1 == b[1] for a, b in zip(pairs, pairs[1:]))
    return [len(pairs), len(pairs) - near]


def greedy_pairs(h_at, h_set, r_at, r_set) -> list[list[int]]:
    """The walk from both ends: the last hypothesis word takes the last free reference word that shares a set with it,
    then the word before it, and so on. Places ascend, one entry per place and set; time is linear in the entries."""
    free: dict = {}
    for place, s in zip(r_at, r_set):
        free.setdefault(s, []).append(place)
    used, out, at = set(), [], len(h_at) - 1
    while at >= 0:
        place, best = h_at[at], -1
        while at >= 0 and h_at[at] == place:
            stack = free.get(h_set[at], ())
            while stack and stack[-1] in used:
                stack.pop()
            if stack:
                best = max(best, stack[-1])
            at -= 1
        if best >= 0:
            used.add(best)
            out.append([int(place), int(best)])
    return out


_MEASURES = StructType([
    StructField("_rouge", ArrayType(StructType([StructField(c, LongType()) for c in ("_lcs", "_nh", "_nr")]))),
    StructField("_sizes", ArrayType(StructType([StructField(c, LongType()) for c in ("_nh", "_nr")]))),
    StructField("_nums", ArrayType(LongType())),
    StructField("_meteor_sizes", ArrayType(StructType([StructField(c, LongType()) for c in ("_nh", "_nr")]))),
    StructField("_counts", ArrayType(LongType()))])
_ROUGE_WORD = re.compile("[a-z0-9]+")
#: Grouped rows taken into Python at once.
SLICE_ROWS = 256


class _Texts:
    """The texts of one grouped row: each is cut into words once, and equal rows are measured once."""

    def __init__(self, of: dict[str, Callable[[str], list[str]]], metrics: Sequence[str], stems: dict | None, sets: dict | None) -> None:
        self.of, self.metrics, self.stems, self.sets = of, metrics, stems, sets
        self.words: dict = {}
        self.grams: dict = {}
        self.done: dict = {}

    def cut(self, metric: str, text: str | None) -> list[str]:
        if (metric, text) not in self.words:
            self.words[metric, text] = self.of[metric](text) if text is not None else []
        return self.words[metric, text]

    def sizes(self, metric: str, rows: Sequence[tuple]) -> list[tuple]:
        return [tuple(None if t is None else len(self.cut(metric, t)) for t in row) for row in rows]

    def measured(self, rows: tuple) -> tuple:
        """The values of ``_MEASURES`` of the rows of one key, null for a metric that was not asked."""
        if rows not in self.done:
            rouge = sizes = nums = meteor_sizes = counts = None
            if "rouge" in self.metrics:
                rouge = [(lcs_len(*(self.cut("rouge", t) for t in row)), *n) for row, n in zip(rows, self.sizes("rouge", rows))]
            if "bleu" in self.metrics:
                rs = tuple(r for _, r in rows)
                if rs not in self.grams:
                    self.grams[rs] = gram_counts([self.cut("bleu", r) for r in rs], R.BLEU_MAX_N)
                sizes, nums = self.sizes("bleu", rows), clipped_matches([self.cut("bleu", h) for h, _ in rows], self.grams[rs])
            if "meteor" in self.metrics:
                meteor_sizes = self.sizes("meteor", rows)
                counts = meteor_counts(*([self.cut("meteor", t) for t in side] for side in zip(*rows)), self.stems, self.sets)
            self.done[rows] = rouge, sizes, nums, meteor_sizes, counts
        return self.done[rows]


_ARROW = [pa.list_(pa.struct([(c, pa.int64()) for c in ("_lcs", "_nh", "_nr")])),
          pa.list_(pa.struct([(c, pa.int64()) for c in ("_nh", "_nr")])), pa.list_(pa.int64()),
          pa.list_(pa.struct([(c, pa.int64()) for c in ("_nh", "_nr")])), pa.list_(pa.int64())]


def _measure(batch: pa.RecordBatch | pa.Table, by: Sequence[str], rest: Sequence[str], metrics: Sequence[str],
             stems: dict | None = None, sets: dict | None = None) -> Iterator[pa.RecordBatch]:
    """(by, rest, _MEASURES) of grouped rows (by, _items)."""
    of = {"rouge": _ROUGE_WORD.findall, "bleu": T.Treebank(), "meteor": str.split}
    names = [*by, *rest, *_MEASURES.names]
    batches = batch.to_batches() if isinstance(batch, pa.Table) else [batch]
    for part in (b.slice(i, SLICE_ROWS) for b in batches for i in range(0, b.num_rows, SLICE_ROWS)):
        lists = part.column("_items")
        *others, rows = lists.flatten().flatten()
        values = list(zip(*(c.to_pylist() for c in rows.flatten().flatten())))
        ends = np.cumsum(np.append(0, np.diff(rows.offsets.to_numpy()))).tolist()
        groups = [tuple(values[a:b]) for a, b in zip(ends, ends[1:])]
        sizes = np.diff(lists.offsets.to_numpy())
        out, first = [], 0
        for n in sizes.tolist():
            texts = _Texts(of, metrics, stems, sets)
            out += [texts.measured(g) for g in groups[first:first + n]]
            first += n
        parent = pa.array(np.repeat(np.arange(len(sizes)), sizes))
        columns = zip(*out) if out else [[]] * len(_ARROW)
        yield pa.RecordBatch.from_arrays([
            *(part.column(k).take(parent) for k in by), *others,
            *(_column(list(c), kind) for c, kind in zip(columns, _ARROW))], names=names)


def _column(values: list, kind: pa.ListType) -> pa.Array:
    if not pa.types.is_struct(kind.value_type) or not values or values[0] is None:
        return pa.array(values, kind)
    fields = list(kind.value_type)
    columns = zip(*(row for v in values for row in v))
    rows = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields)], fields=fields)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, values)]), pa.int32()), rows)


def _block_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_block, token): the distinct words of blocks of grouped rows, once a batch."""
    for batch in batches:
        block = batch.column("_block").to_numpy()
        starts = np.flatnonzero(np.append(True, block[1:] != block[:-1])) if len(block) else []
        for first, last in zip(starts, np.append(starts[1:], len(block)).astype(int) if len(block) else []):
            rows = batch.column("_items").slice(first, last - first).flatten().field("_rows").flatten()
            texts = pc.unique(pa.concat_arrays(rows.flatten())).drop_null()
            words = pc.unique(pc.utf8_split_whitespace(texts).flatten())
            words = words.filter(pc.not_equal(words, ""))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(words), block[first])), words], names=["_block", "token"])


def _measured(df: DataFrame, keys: list[str], by: list[str], h: str, r: str, stems: bool, synonyms: DataFrame | None,
              metrics: Sequence[str]) -> DataFrame:
    """(keys, _MEASURES) of the rows of each key, read by the rows of ``by``."""
    rest = [k for k in keys if k not in by]
    x = _rows_of(df, keys, h, r, by)
    if rest:
        x = x.groupBy(*by).agg(F.collect_list(F.struct(*rest, "_rows")).alias("_items"))
    else:
        x = x.select(*by, F.array(F.struct("_rows")).alias("_items"))
    kinds = {f.name: f for f in df.schema}
    schema = StructType([*(StructField(k, kinds[k].dataType) for k in [*by, *rest]), *_MEASURES])

    def in_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield from _measure(b, by, rest, metrics)

    if "meteor" not in metrics or not stems:
        return x.mapInArrow(in_batches, schema)
    known, x = _known_stems(x, synonyms, BLOCK_BITS - 2 if rest and BLOCK_BITS > 2 else BLOCK_BITS)

    def measured(rows: pa.Table, words: pa.Table) -> pa.Table:
        token, stem, of = (words[c].to_pylist() for c in ("token", "stem", "sets"))
        found = dict(zip(token, stem)), {t: s for t, s in zip(token, of) if s}
        return pa.Table.from_batches([*_measure(rows, by, rest, metrics, *found)]) if rows.num_rows else _nothing(rows, by, rest)

    x, known = (y.repartition(_tasks(df), "_block") for y in (x, known))
    return x.groupBy("_block").cogroup(known.groupBy("_block")).applyInArrow(measured, schema)


def _nothing(rows: pa.Table, by: Sequence[str], rest: Sequence[str]) -> pa.Table:
    kinds = [*(rows.schema.field(k).type for k in by), *(rows.schema.field("_items").type.value_type.field(k).type for k in rest), *_ARROW]
    return pa.table([pa.array([], k) for k in kinds], names=[*by, *rest, *_MEASURES.names])


def _known_stems(rows: DataFrame, synonyms: DataFrame | None, bits: int) -> tuple[DataFrame, DataFrame]:
    """(_block, token, stem, sets) of the words that are not their own stem or have sets, and ``rows`` in blocks. The
    rows are written once; a block's distinct words meet their stems and sets."""
    rows = materialise(rows.withColumn("_block", F.shiftright(F.monotonically_increasing_id(), bits)), "score-rows")
    words = materialise(rows.mapInArrow(_block_words, "_block bigint, token string"), "block-words")
    table = with_stems(words.select("token").distinct(), "token")
    if synonyms is None:
        table = table.select("token", "stem", F.array().cast("array<string>").alias("sets"))
    else:
        sets = (synonyms.select(F.col("word").alias("stem"), F.col("set_id").cast("string").alias("set_id"))
                .filter("set_id IS NOT NULL").groupBy("stem").agg(F.collect_set("set_id").alias("sets")))
        table = table.join(sets, "stem", "left").select("token", "stem", "sets")
    return words.join(table.filter("stem <> token OR size(sets) > 0"), "token").select("_block", "token", "stem", "sets"), rows


def meteor_scores(df: DataFrame, keys: Sequence[str], h: str, r: str, stems: bool = False,
                  synonyms: DataFrame | None = None) -> DataFrame:
    """(keys, matches, chunks, meteor): METEOR's exact stage, with ``stems``
    its Porter-stem stage, and with a ``synonyms`` table (word, set_id: the
    word, as a stem, belongs to that synonym set, and to any number of sets)
    a third stage on what the stem stage left (C8, J7): from the end, each
    hypothesis word takes the last free reference word of any of its sets.
    ``h``/``r`` name lower-cased token-array columns, ``keys`` columns unique
    per row.

    With several sets per word the order of the walk decides, so the third
    stage walks each text pair's lists. Stems are made once per distinct word.
    """
    _check_stages(stems, synonyms)
    keys = list(keys)
    texts = df.select(*keys, F.array_join(h, " ").alias("_h"), F.array_join(r, " ").alias("_r"))  # a token has no space
    x = _measured(texts, keys, keys, "_h", "_r", stems, synonyms, ("meteor",))
    return _meteor(x, keys, "_meteor_sizes", "_counts")


def _check_stages(stems: bool, synonyms: DataFrame | None) -> None:
    if synonyms is not None and not stems:
        raise ValueError("the synonym stage runs after the stem stage: set stems")


def _meteor(df: DataFrame, keep: Sequence[str], sizes: str, counts: str) -> DataFrame:
    """(keep, matches, chunks, meteor) of each row of ``sizes``."""
    x = df.select(*keep, F.col(counts)[0].alias("matches"), F.col(counts)[1].alias("chunks"), F.inline(sizes))
    md = F.col("matches").cast("double")
    p, rcl = F.try_divide(md, F.col("_nh")), F.try_divide(md, F.col("_nr"))
    fmean = F.try_divide(p * rcl, R.METEOR_ALPHA * p + (1 - R.METEOR_ALPHA) * rcl)
    penalty = R.METEOR_GAMMA * F.pow(F.try_divide(F.col("chunks"), md), R.METEOR_BETA)
    score = F.when(F.col("matches") > 0, (1 - penalty) * fmean).otherwise(0.0)
    return x.select(*keep, "matches", "chunks", score.alias("meteor"))


# ------------------------------------------------------------------ corpus level

METRICS = ("rouge", "meteor", "bleu")


def score_rows(df: DataFrame, keys: Sequence[str], hyp_col: str = "generated", ref_col: str = "question",
               stems: bool = True, synonyms: DataFrame | None = None, smoothing: str = "method4",
               metrics: Sequence[str] = METRICS, sentences: SentenceModel | None = None,
               by: Sequence[str] | None = None) -> DataFrame:
    """(keys, and per asked metric rouge_p, rouge_r, rouge_f | matches, chunks, meteor | bleu1..4)
    per row; ``keys`` are unique per row.

    With a model of ``sentences`` BLEU's words are those of each sentence, so
    abbreviations keep their period (H21).
    Only the asked ``metrics`` are computed. The rows are grouped once, on
    ``by`` (some of the keys; all where unset), and measured in one step: the
    rows of a group are cut into words once for each text.
    """
    if not metrics or set(metrics) - set(METRICS):
        raise ValueError(f"metrics must be some of {METRICS}")
    _check_stages(stems or "meteor" not in metrics, synonyms)
    keys = list(keys)
    by = [k for k in keys if k in set(by or keys)]
    in_row = [m for m in metrics if m != "bleu" or sentences is None]
    done = list(keys)
    x = df.select(*keys, F.lower(hyp_col).alias("_h"), F.lower(ref_col).alias("_r"))
    x = _measured(x, keys, by, "_h", "_r", stems, synonyms, in_row) if in_row else None
    meteor = ["_meteor_sizes", "_counts"] if "meteor" in metrics else []
    rouge = ["_rouge"] if "rouge" in metrics else []
    if "bleu" in in_row:
        x = _bleu(x, [*done, *rouge, *meteor], R.BLEU_MAX_N, "bleu", smoothing)
        done += [f"bleu{n}" for n in range(1, R.BLEU_MAX_N + 1)]
    if rouge:
        x = x.select(*done, *meteor, F.inline("_rouge")).withColumn("_lcs", F.col("_lcs").cast("double"))
        x = _rouge(x, F.col("_nh"), F.col("_nr")).drop("_nh", "_nr")
        done += ["rouge_p", "rouge_r", "rouge_f"]
    if meteor:
        x = _meteor(x, done, *meteor)
        done += ["matches", "chunks", "meteor"]
    if "bleu" in metrics and sentences is not None:
        rows = materialise(df.select(*keys, hyp_col, ref_col), "sentence-rows")  # read five times
        words = _sentence_words(rows.repartition(_tasks(rows), *keys), keys, hyp_col, ref_col, sentences)
        by_sentence = bleu_scores(words, keys, "_h", "_r", smoothing=smoothing)
        x = by_sentence if tuple(metrics) == ("bleu",) else x.select(*done).join(by_sentence, keys)
        done += [f"bleu{n}" for n in range(1, R.BLEU_MAX_N + 1)]
    asked = {"rouge": ["rouge_p", "rouge_r", "rouge_f"], "meteor": ["matches", "chunks", "meteor"],
             "bleu": [f"bleu{n}" for n in range(1, R.BLEU_MAX_N + 1)]}
    return x.select(*keys, *[c for m in METRICS if m in metrics for c in asked[m]])


def _sentence_words(df: DataFrame, keys: list[str], hyp_col: str, ref_col: str, model: SentenceModel) -> DataFrame:
    """(keys, _h, _r): Treebank tokens of each lower-cased sentence, in order."""
    out = df.select(*keys)
    for name, col in (("_h", hyp_col), ("_r", ref_col)):
        lower = df.select(*keys, F.lower(col).alias(name))
        out = out.join(sentence_words(lower, keys, name, model, name), keys, "left").withColumn(name, F.coalesce(name, _empty()))
    return out


def leaderboard(scored: DataFrame, id_col: str, group_col: str = "variant", digits: int = 6,
                replicates: int = R.BOOTSTRAP_REPLICATES) -> DataFrame:
    """Corpus scores x100 per variant, ranked by METEOR (D15-D17, D19, H23);
    ``rouge_mid`` is the bootstrap median of ROUGE-L over ``id_col`` (D18)."""
    agg = scored.groupBy(group_col).agg(
        F.count(F.lit(1)).alias("n"),
        (100 * F.avg("rouge_f")).alias("rouge_l"),
        (100 * F.avg("meteor")).alias("meteor"),
        *[(100 * F.avg(f"bleu{n}")).alias(f"bleu{n}") for n in range(1, R.BLEU_MAX_N + 1)])
    f = scored.select(id_col, group_col, (100 * F.col("rouge_f")).alias("f"))
    mid = bootstrap_mean(f, id_col, "f", group_col, replicates).select(group_col, F.col("mid").alias("rouge_mid"))
    cols = ["rouge_l", "rouge_mid", "meteor"] + [f"bleu{n}" for n in range(1, R.BLEU_MAX_N + 1)]
    rounded = agg.join(mid, group_col).select(group_col, "n", *[F.round(c, digits).alias(c) for c in cols])
    w = Window.orderBy(F.desc("meteor"), F.asc(group_col))  # one row per variant
    return rounded.withColumn("rank", F.rank().over(w).cast("bigint"))


def _poisson1_cdf(kmax: int = 16) -> list[float]:
    acc, out = 0.0, []
    for k in range(kmax + 1):
        acc += math.exp(-1.0) / math.factorial(k)
        out.append(acc)
    return out


POISSON1_CDF = _poisson1_cdf()


#: The cumulative Poisson(1) distribution as 32-bit hex thresholds; a draw is compared as text, without conversion.
POISSON1_HEX = [f"{math.ceil(c * 2 ** 32):08x}" for c in POISSON1_CDF if c * 2 ** 32 <= 2 ** 32 - 1]
DRAWS_PER_HASH = 4


def hashed_draws(seed: int, unit: Column, block: Column) -> Column:
    """The four 32-bit draws, as hex text, of a unit and a block of replicates."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), unit.cast("string"), block.cast("string")).cast("binary"))


def poisson1_weight(draw: Column) -> Column:
    """Poisson(1) draw by inverse CDF of a 32-bit draw in hex."""
    out = F.when(draw < POISSON1_HEX[0], 0)
    for k, c in enumerate(POISSON1_HEX[1:], 1):
        out = out.when(draw < c, k)
    return out.otherwise(len(POISSON1_HEX))


def bootstrap_mean(df: DataFrame, id_col: str, value_col: str, group_col: str,
                   replicates: int = R.BOOTSTRAP_REPLICATES,
                   percentiles=R.BOOTSTRAP_PERCENTILES, seed: int = 0) -> DataFrame:
    """(group, low, mid, high) of the mean over a seeded Poisson bootstrap.

    The resampled unit is the id: its rows are averaged per group first, and
    all groups of an id share its draws, so groups are compared on the same
    resamples. An id gets an independent Poisson(1) weight per replicate from
    a hash of (seed, id, block of four replicates), computed once. The replicate explode
    feeds straight into a partial aggregate, so each task ships one row per
    (replicate, group); the N * replicates rows are never shuffled.
    """
    # Small rows, much work each: adaptive execution would fold the ids into few tasks.
    unit = df.select(id_col, group_col, value_col).repartition(_tasks(df), id_col)
    unit = unit.groupBy(id_col, group_col).agg(F.avg(F.col(value_col).cast("double")).alias("_x"))
    unit = unit.groupBy(F.col(id_col).alias("_id")).agg(F.collect_list(F.struct(F.col(group_col).alias("_g"), "_x"))
                                                        .alias("_gs"))  # a row per group
    blocks = F.sequence(F.lit(0), F.lit((replicates - 1) // DRAWS_PER_HASH))
    hashed = unit.select("_id", "_gs", F.explode(blocks).alias("_block"))
    hashed = hashed.withColumn("_hash", hashed_draws(seed, F.col("_id"), F.col("_block")))
    draws = hashed.select("_gs", F.inline(F.array(*[
        F.struct((F.col("_block") * DRAWS_PER_HASH + j + 1).alias("rep"),
                 F.substring("_hash", 8 * j + 1, 8).alias("_draw")) for j in range(DRAWS_PER_HASH)])))
    draws = draws.filter(F.col("rep") <= replicates).withColumn("_w", poisson1_weight(F.col("_draw"))).filter("_w > 0")
    per_rep = (draws.select("rep", "_w", F.inline("_gs")).groupBy("rep", "_g")
               .agg(F.try_divide(F.sum(F.col("_w") * F.col("_x")), F.sum("_w")).alias("mean")))
    q = F.percentile("mean", F.array(*[F.lit(p) for p in percentiles]))  # over the replicates
    return per_rep.groupBy("_g").agg(q.alias("q")).select(
        F.col("_g").alias(group_col), *[F.col("q")[i].alias(n) for i, n in enumerate(("low", "mid", "high"))])
